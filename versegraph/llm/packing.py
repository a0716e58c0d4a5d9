"""Problem 6: texts into containers of fixed capacity, by variable-capacity best-fit over a histogram of sizes.

Sizes are whole numbers of at most the largest capacity, so however many texts there are, their histogram has at most that
many entries: it is counted on the executors and planned on the driver, in counts, not texts.

1. Texts are measured in tokens of a public tokenizer (path and kind are parameters). A text longer than the largest capacity
   alone is cut: full containers of that capacity, and a rest that is an item like any other.
2. Items are placed from the largest to the smallest, all items of a size at once: as many as there are go to the open
   containers whose free space fits them best (the least space left), class of equal containers by class. What is left opens
   new containers: of the permitted capacities, the one with the least cost, that is, with the least space that the items
   still unplaced could not fill (estimated over whole numbers of the same item, then the smaller capacity).
3. At the end every container is downsized to the smallest permitted capacity that holds its contents.
4. A plan row says: of the items of this size, those with ranks from..to go to containers first.., so many each. Items get their
   ranks without one task seeing a whole size: counts by partition and size are added up on the executors, and each partition numbers its own.

Defined results: null and empty texts have no tokens and are placed nowhere; a capacity that is null or under 1 is no container;
no container at all places nothing; ties go by (size, partition, key); repeated rows are items of their own, repeated deliveries of
one key with one text are one item; extra columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.session import checkpointed, table

#: Where the public vocabularies lie, and the one used.
TOKENIZERS, VOCABULARY = "/opt/tokenizers", "byte_bpe_50k.tiktoken"
#: The pre-tokenization of byte-level BPE vocabularies of this kind, as published with them.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(2)
def token_counter(path: str):
    """A function from texts to numbers of tokens, made once for each Python worker."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in Path(path).read_bytes().splitlines() if line)}
    encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [len(encoding.encode_ordinary(t)) for t in texts]


def measured(df: DataFrame, key: str, text: str, vocabulary: str) -> DataFrame:
    """(key, tokens) of each distinct record; only the numbers leave the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = token_counter(vocabulary)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count(batch.column(1).to_pylist()), pa.int64())], ["key", "tokens"])

    picked = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("t")).filter("key is not null and t is not null and t <> ''")
    return picked.mapInArrow(run, "key long, tokens long").dropDuplicates(["key"])


@dataclass
class Group:
    """Equal containers: capacity, free space, numbers from ``first`` on, and how many."""

    capacity: int
    free: int
    first: int
    count: int


def plan(histogram: dict[int, int], capacities: list[int]) -> tuple[list[tuple[int, int, int, int, int]], list[Group]]:
    """Rows (size, first rank, items, first container, items a container) and the containers, downsized.

    Each size splits at most one group for the rest and opens at most two for what fits nowhere, so there are at most three times as many
    groups as sizes.
    """
    capacities = sorted(set(capacities))
    open_groups: dict[int, list[Group]] = defaultdict(list)
    frees: list[int] = []
    rows: list[tuple[int, int, int, int, int]] = []
    full: list[Group] = []
    opened = 0
    left = dict(histogram)

    def put(g: Group) -> None:
        if g.free <= 0:
            full.append(g)
            return
        if not open_groups[g.free]:
            bisect.insort(frees, g.free)
        open_groups[g.free].append(g)

    def take(free: int) -> Group:
        g = open_groups[free].pop()
        if not open_groups[free]:
            frees.pop(bisect.bisect_left(frees, free))
        return g

    def cost(capacity: int, size: int, smaller: list[int]) -> tuple[float, int]:
        """Space a container keeps empty, as a share: whole copies of the item, then the best single smaller item that is left."""
        free = capacity % size
        i = bisect.bisect_right(smaller, free)
        while i and free:
            filled = smaller[i - 1]
            free -= filled * min(free // filled, left[filled])
            i = bisect.bisect_right(smaller, free, 0, i - 1)
        return free / capacity, capacity

    for size in sorted(histogram, reverse=True):
        n, rank = histogram[size], 0
        left.pop(size)
        while n:
            i = bisect.bisect_left(frees, size)
            if i == len(frees):
                break
            g = take(frees[i])
            each = min(g.free // size, n)
            use = min(g.count, n // each)
            rows.append((size, rank, use * each, g.first, each))
            rank, n = rank + use * each, n - use * each
            put(Group(g.capacity, g.free - each * size, g.first, use))
            if use < g.count:
                put(Group(g.capacity, g.free, g.first + use, g.count - use))
        if n:
            smaller = sorted(left)
            capacity = min((c for c in capacities if c >= size), key=lambda c: cost(c, size, smaller))
            each = capacity // size
            for use, many in ((n // each, each), (1 if n % each else 0, n % each)):
                if use:
                    rows.append((size, rank, use * many, opened, many))
                    put(Group(capacity, capacity - many * size, opened, use))
                    rank, opened = rank + use * many, opened + use
    groups = full + [g for gs in open_groups.values() for g in gs]
    for g in groups:
        used = g.capacity - g.free
        g.capacity = next(c for c in capacities if c >= used)
        g.free = g.capacity - used
    return rows, groups


def ranked(items: DataFrame) -> DataFrame:
    """``items`` with ``rank``: numbers from 0 within (profile, size), without gathering a size in one task."""
    spread = checkpointed(items.withColumn("part", F.spark_partition_id()))
    from pyspark.sql import Window

    counts = spread.groupBy("profile", "size", "part").agg(F.count("*").alias("n"))
    offsets = counts.withColumn("start", F.sum("n").over(Window.partitionBy("profile", "size").orderBy("part")) - F.col("n")).select("profile", "size", "part", "start")
    # parts of a size are as many as tasks, items of a part and size as many as a task held
    local = spread.withColumn("at", F.row_number().over(Window.partitionBy("profile", "size", "part").orderBy("key", "piece")) - 1)
    return local.join(offsets, ["profile", "size", "part"]).select("profile", "key", "piece", "start_token", "size", (F.col("start") + F.col("at")).alias("rank"))


def packed(sizes: DataFrame, profiles: dict[str, list[int]]) -> tuple[DataFrame, DataFrame]:
    """Assignment (profile, container, key, piece, start_token, size, capacity) and fills (profile, container, capacity, n_items, fill).

    sizes: (key, tokens). profiles: name -> permitted capacities; each profile packs all texts by itself.
    """
    spark = sizes.sparkSession
    largest = F.create_map(*(x for p, c in profiles.items() for x in (F.lit(p), F.lit(max(c)).cast("long"))))
    per = sizes.filter("tokens > 0").select(F.explode(F.array(*map(F.lit, profiles))).alias("profile"), "key", "tokens").withColumn("cap", largest[F.col("profile")])
    pieces = F.sequence(F.lit(0).cast("long"), F.floor((F.col("tokens") - 1) / F.col("cap")))
    items = per.select("profile", "key", "tokens", "cap", F.explode(pieces).alias("piece"))
    items = items.select("profile", "key", F.col("piece").cast("int").alias("piece"), (F.col("piece") * F.col("cap")).alias("start_token"), F.least("cap", F.col("tokens") - F.col("piece") * F.col("cap")).alias("size"))
    items = checkpointed(items)
    # at most profiles times largest capacity rows
    histogram: dict[str, dict[int, int]] = {p: {} for p in profiles}
    for r in items.groupBy("profile", "size").count().collect():
        histogram[r.profile][r["size"]] = r["count"]
    rows, groups = [], []
    for p, capacities in profiles.items():
        planned, containers = plan(histogram[p], capacities)
        rows += [(p, *r) for r in planned]
        groups += [(p, g.first, g.capacity) for g in containers]
    # the plan grows with the sizes that occur, not with the texts; looked up by binary search
    tops = {p: np.array(sorted(g[1:] for g in groups if g[0] == p), np.int64).reshape(-1, 2).T for p in profiles}
    steps = {p: np.array(sorted(r[1:] for r in rows if r[0] == p), np.int64).reshape(-1, 5) for p in profiles}
    sent = spark.sparkContext.broadcast((steps, tops))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (4, 5))
            names = np.asarray(batch.column(0).to_pylist(), dtype=object)
            container, capacity = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for p in set(names):
                at, table, (firsts, capacities) = names == p, sent.value[0][p], sent.value[1][p]
                row = table[np.searchsorted((table[:, 0] << 40) + table[:, 1], (size[at] << 40) + rank[at], side="right") - 1]
                container[at] = row[:, 3] + (rank[at] - row[:, 1]) // row[:, 4]
                capacity[at] = capacities[np.searchsorted(firsts, container[at], side="right") - 1]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(container), *batch.columns[1:5], pa.array(capacity)], ["profile", "container", "key", "piece", "start_token", "size", "capacity"])

    columns = ranked(items).select("profile", "key", "piece", F.col("start_token").cast("long"), F.col("size").cast("long"), F.col("rank").cast("long"))
    assigned = columns.mapInArrow(place, "profile string, container long, key long, piece int, start_token long, size long, capacity long")
    # what is in each container, added up from where the items went
    fills = assigned.groupBy("profile", "container").agg(F.max("capacity").alias("capacity"), F.count("*").alias("n_items"), F.sum("size").alias("fill"))
    return assigned, fills


def _profiles(spark: SparkSession, d: str) -> dict[str, list[int]]:
    """Each capacity by itself, and ``joint``: all of them permitted together. The table of containers is fixed (3 rows)."""
    rows = table(spark, d, "containers").filter("profile is not null and capacity >= 1").distinct().limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("the table of containers is small and fixed")
    own = {r.profile: [r.capacity] for r in sorted(rows)}
    return own | ({"joint": sorted({r.capacity for r in rows})} if rows else {})


def _packed(spark: SparkSession, d: str, vocabulary: str) -> tuple[DataFrame, DataFrame]:
    sizes = checkpointed(measured(table(spark, d, "documents"), "doc_id", "text", vocabulary))
    return packed(sizes, _profiles(spark, d))


EMPTY = "profile string, container_id long, doc_id long, piece int, start_token long, n_tokens long"


def containers_query(spark: SparkSession, d: str, vocabulary: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """Where every text, or piece of a text longer than a container, goes."""
    if not _profiles(spark, d):
        return spark.createDataFrame([], EMPTY)
    assigned, _ = _packed(spark, d, vocabulary)
    return assigned.select("profile", F.col("container").alias("container_id"), F.col("key").alias("doc_id"), "piece", "start_token", F.col("size").alias("n_tokens"))


def fills_query(spark: SparkSession, d: str, vocabulary: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """Capacity and fill of every container, summed up from the assignment."""
    if not _profiles(spark, d):
        return spark.createDataFrame([], "profile string, container_id long, capacity long, n_items long, n_tokens long, unused long")
    _, fills = _packed(spark, d, vocabulary)
    return fills.select("profile", F.col("container").alias("container_id"), "capacity", "n_items", F.col("fill").alias("n_tokens"), (F.col("capacity") - F.col("fill")).alias("unused"))


def waste_query(spark: SparkSession, d: str, vocabulary: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """Share of unused space by profile."""
    return fills_query(spark, d, vocabulary).groupBy("profile").agg(F.count("*").alias("n_containers"), F.sum("n_tokens").alias("n_tokens"), (F.sum("unused") / F.sum("capacity")).alias("unused_share"))


queries = {"p6_containers": containers_query, "p6_fills": fills_query, "p6_waste": waste_query}
oracles: dict[str, str] = {}
