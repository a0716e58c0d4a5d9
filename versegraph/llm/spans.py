"""Problem 1: passages of at least ``least`` characters that stand verbatim in more than one record.

Content-defined chunking with a gear rolling hash. The hash of the last ``GEAR`` characters is rolled over the text; the text
is cut where a hash is the smallest among the ``least - GEAR + 1`` hashes of some passage of ``least`` characters. Every such
passage therefore holds a cut that depends on nothing outside it, whatever was inserted before: two records that share
a passage share the cut. Chunks run from the gear window of one cut to that of the next, so neighbouring chunks overlap by the
window that cut them.

1. Cells. All passages of ``least`` characters that have one cut in a row make up its cell: a variable chunk around the cut, some 25 passages wide,
   whose ends depend on the content alone. Each record is read once and leaves, for each of its cells, the digests of the cut and of the whole cell.
2. Cuts of two different keys are shared (minima and maxima before the shuffle, so a passage that a third of all records contain is a few rows a task). Cells are
   deduplicated by digest: a cell that two keys have is shared whole, however many copies there are, and is never looked into.
3. At the ends of a shared passage cells of one cut differ. Each of these cells is looked into once, in one record that has it: its passages are
   matched by the digests of cut and passage, and what two keys have holds for every record with that cell.
4. Shared passages that touch or overlap become one maximal run.

The plan is the same at every size. Two filters of fixed size (16 MB), of shared cuts and of records with cells to look into, only spare rows and texts the exact
joins that follow; the fuller they are, the less they spare. Joins keep one side with one row for each cut or cell, so that the skew join can split a hot one.

Method note: deduplicating whole chunks alone finds no passage that lies within the differing cells at its ends; hence step 3.
``p1_chunks`` reports the chunks from cut to cut, deduplicated by digest.

Defined results: null texts and texts under ``least`` characters share nothing; several deliveries of one key count as one
record, whose text is that of its first row met (all rows of a key have one text); records with equal texts share them whole;
extra columns are ignored. Digests have 64 bits for cuts (which only propose) and 128 bits for passages (64 of the cut, 64 of the passage).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.session import stored, table

#: Characters that the gear hash looks back on.
GEAR = 32
#: Characters handled at once.
MOST_CHARS = 1 << 21

U = np.uint64


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit value for each 64-bit value (the finalizer of splitmix64)."""
    x = x + U((salt * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _windows(gears: np.ndarray, n: int, base: int) -> np.ndarray:
    """out[t]: sum of gears[t + j] * base ** (n - 1 - j) for j < n, rolled by doubling; base 2 makes it the gear hash."""
    out, have = None, 0
    power, size = gears, 1
    rest = n
    # binary digits of n from the lowest: blocks of 1, 2, 4 ... values are joined from right to left
    end = len(gears)
    while rest:
        if rest & 1:
            if out is None:
                out, have = power, size
            else:
                m = end - have - size + 1
                if m <= 0:
                    return np.zeros(0, U)
                out, have = power[:m] * U(pow(base, have, 1 << 64)) + out[size : size + m], have + size
        rest >>= 1
        if rest:
            m = end - 2 * size + 1
            if m <= 0:
                return np.zeros(0, U)
            power, size = power[:m] * U(pow(base, size, 1 << 64)) + power[size : size + m], 2 * size
    return out


def _lowest(x: np.ndarray, n: int) -> np.ndarray:
    """out[t] = min(x[t : t + n])."""
    if len(x) < n:
        return np.zeros(0, U)
    size = 1
    while 2 * size <= n:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    m = len(x) - (n - size)
    return np.minimum(x[:m], x[n - size : n - size + m]) if n > size else x


class Rolled:
    """The texts of a batch as one array of code points with the cuts of every passage of ``least`` characters."""

    def __init__(self, texts: list[str], least: int):
        self.least = least
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.at = np.concatenate([[0], np.cumsum(lengths)])
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(U)
        self.gears = _mixed(codes, 1)
        gear = _mixed(_windows(self.gears, GEAR, 2), 2)
        cut = _lowest(gear, least - GEAR + 1)
        # passages that begin in one text and end in another are no passages
        owner = np.repeat(np.arange(len(texts)), np.maximum(lengths - least + 1, 0))
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(np.maximum(lengths - least + 1, 0)) - np.maximum(lengths - least + 1, 0), np.maximum(lengths - least + 1, 0))
        self.owner, self.offset = owner, offset
        self.cut = cut[self.at[owner] + offset] if len(owner) else np.zeros(0, U)

    def cuts(self) -> tuple[np.ndarray, np.ndarray]:
        """Owners and digests of the cuts; neighbouring passages mostly have the same."""
        if not len(self.cut):
            return self.owner, self.cut
        new = np.ones(len(self.cut), bool)
        new[1:] = (self.cut[1:] != self.cut[:-1]) | (self.owner[1:] != self.owner[:-1])
        return self.owner[new], self.cut[new]

    def cells(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Owner, cut, first passage, number of passages and digest of each cell."""
        if not len(self.cut):
            return self.owner, self.cut, self.offset, self.offset, self.cut
        new = np.ones(len(self.cut), bool)
        new[1:] = (self.cut[1:] != self.cut[:-1]) | (self.owner[1:] != self.owner[:-1])
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(new)))
        start = self.at[self.owner[first]] + self.offset[first]
        return self.owner[first], self.cut[first], self.offset[first], n, _slices(self.gears, start, start + n - 1 + self.least)

    def chunks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Owner, start and end (in the whole array) of each chunk: from the gear window of one cut to the end of that of the next, and the ends of the texts."""
        owner, cut = self.cuts()
        gear = _mixed(_windows(self.gears, GEAR, 2), 2)
        whose = np.searchsorted(self.at, np.arange(len(gear)), side="right") - 1
        tag = lambda o, c: _mixed(c ^ _mixed(o.astype(U), 5), 6)
        place = np.flatnonzero(np.isin(tag(whose, gear), tag(owner, cut)))
        texts = np.arange(len(self.at) - 1)
        starts = np.concatenate([self.at[:-1], place])
        owners = np.concatenate([texts, whose[place]])
        order = np.lexsort((starts, owners))
        starts, owners = starts[order], owners[order]
        last = np.ones(len(owners), bool)
        last[:-1] = owners[1:] != owners[:-1]
        ends = np.where(last, self.at[owners + 1], np.append(starts[1:], 0) + GEAR)
        some = ends > starts
        return owners[some], starts[some], ends[some]


_POWERS: list[np.ndarray] = []


def _slices(gears: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A digest of each slice: a polynomial hash from prefix sums, whose powers are kept."""
    if not _POWERS or len(_POWERS[0]) <= len(gears):
        base = 0x9E3779B97F4A7C15
        _POWERS[:] = [np.cumprod(np.append(U(1), np.full(max(len(gears), MOST_CHARS + 4096), b, U)), dtype=U) for b in (base, pow(base, -1, 1 << 64))]
    up, down = _POWERS
    total = np.concatenate([np.zeros(1, U), np.cumsum(gears * up[: len(gears)], dtype=U)])
    return _mixed((total[ends] - total[starts]) * down[starts], 7)


def _parts(texts: list[str]) -> Iterator[tuple[int, int]]:
    size, i = 0, 0
    for j, t in enumerate(texts):
        size += len(t)
        if size > MOST_CHARS or j == len(texts) - 1:
            yield i, j + 1
            size, i = 0, j + 1


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


#: Words of 64 bits in a filter (16 MB).
FILTER_WORDS = 1 << 21


def _places(digest: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Word and bit of each digest, three times."""
    return [(((m := _mixed(digest, 11 + k)) & U(FILTER_WORDS - 1)).astype(np.int64), m >> U(58)) for k in range(3)]


def _filter(values: DataFrame) -> np.ndarray:
    """A Bloom filter of FILTER_WORDS words, whatever the number of values (longs); its words are put together by an aggregation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_WORDS, U)
        for batch in batches:
            for word, bit in _places(batch.column(0).to_numpy(zero_copy_only=False).view(U)):
                np.bitwise_or.at(bits, word, U(1) << bit)
        some = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), _signed(bits[some])], ["word", "bits"])

    words = values.mapInArrow(run, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(FILTER_WORDS, U)
    out[words.column(0).to_numpy()] = words.column(1).to_numpy().view(U)
    return out


def _in_filter(bits: np.ndarray, digest: np.ndarray) -> np.ndarray:
    inside = np.ones(len(digest), bool)
    for word, bit in _places(digest):
        inside &= (bits[word] >> bit) & U(1) > 0
    return inside


def _passing(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``column`` may be among ``values``: a filter spares the others the join that follows."""
    sent, i = df.sparkSession.sparkContext.broadcast(_filter(values)), df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_in_filter(sent.value, batch.column(i).to_numpy(zero_copy_only=False).view(U))))

    return df.mapInArrow(run, df.schema)


CELL = "k long, p int, n int, cut long, d long"


def _cells(records: DataFrame, least: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            for i, j in _parts(texts):
                owner, cut, first, n, digest = Rolled(texts[i:j], least).cells()
                yield pa.RecordBatch.from_arrays([pa.array(keys[i:j][owner]), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32)), _signed(cut), _signed(digest)], ["k", "p", "n", "cut", "d"])

    return records.mapInArrow(run, CELL)


def _looked_into(cells: DataFrame, records: DataFrame, least: int) -> DataFrame:
    """(cut, d, off, h, a, b): the passages of each of ``cells`` (cut, d, k, p, n, b), read in the record k; b: another key that has the cell, or k."""
    own = cells.groupBy("k").agg(F.collect_list(F.struct("cut", "d", "p", "n", "b")).alias("cells"))
    # several deliveries of a record have one text
    texts = own.join(_passing(records, "k", cells.select("k")), "k").dropDuplicates(["k"]).select("k", "t", "cells")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist(), batch.column(2)
            bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            flat = lists.flatten()
            cut, d, p, n, b = (flat.field(f).to_numpy(zero_copy_only=False) for f in range(5))
            for i, j in _parts(texts):
                at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts[i:j]), np.int64, j - i))])
                codes = np.frombuffer("".join(texts[i:j]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(U)
                passages = _windows(_mixed(_mixed(codes, 1), 3), least, 0xD1342543DE82EF95)
                of = slice(bounds[i], bounds[j])
                owner = np.repeat(np.arange(j - i), np.diff(bounds[i : j + 1]))
                each = np.repeat(np.arange(len(owner)), n[of])
                off = np.arange(len(each)) - np.repeat(np.cumsum(n[of]) - n[of], n[of])
                h = passages[at[owner][each] + p[of][each] + off]
                yield pa.RecordBatch.from_arrays([pa.array(cut[of][each]), pa.array(d[of][each]), pa.array(off.astype(np.int32)), _signed(h), pa.array(keys[i:j][owner][each]), pa.array(b[of][each])], ["cut", "d", "off", "h", "a", "b"])

    return texts.mapInArrow(run, "cut long, d long, off int, h long, a long, b long")


def _merged(ranges: Column) -> Column:
    """Ranges (s, e) of one record that touch or overlap as one."""

    def add(done: Column, r: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joined = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(last["s"].alias("s"), F.greatest(last["e"], r["e"]).alias("e"))))
        return F.when((F.size(done) > 0) & (r["s"] <= last["e"]), joined).otherwise(F.concat(done, F.array(r)))

    return F.aggregate(F.array_sort(ranges), F.array().cast("array<struct<s:int,e:int>>"), add)


def shared_spans(df: DataFrame, key: str, text: str, least: int = 80) -> DataFrame:
    """(key, start_pos, end_pos): maximal runs of characters in passages of ``least`` characters that another key's text has too."""
    if least < GEAR + 1:
        raise ValueError(f"passages have more than {GEAR} characters")
    records = df.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).filter(F.col("k").isNotNull() & (F.length("t") >= least))
    cells = stored(_cells(records, least), "cells")
    cuts = stored(cells.groupBy("cut").agg(F.min("k").alias("a"), F.max("k").alias("b")).filter("a <> b").select("cut"), "cuts")
    kept = stored(_passing(cells, "cut", cuts).join(cuts, "cut", "left_semi"), "shared-cells")
    whole = kept.groupBy("cut", "d").agg(F.min("k").alias("a"), F.max("k").alias("b"), F.max("n").alias("e")).filter("a <> b").select("cut", "d", F.lit(0).alias("s"), "e")
    # cells of one cut that differ: each is looked into in the record with the smallest key that has it
    mixed = kept.groupBy("cut").agg(F.min("d").alias("a"), F.max("d").alias("b")).filter("a <> b").select("cut")
    unlike = kept.join(mixed, "cut", "left_semi").groupBy("cut", "d").agg(F.min(F.struct("k", "p", "n")).alias("r"), F.max("k").alias("b"))
    passages = stored(_looked_into(stored(unlike.select("cut", "d", "r.k", "r.p", "r.n", "b"), "unlike"), records, least), "passages")
    common = passages.groupBy("cut", "h").agg(F.min("a").alias("a"), F.max("b").alias("b")).filter("a <> b").select("cut", "h")
    inside = passages.select("cut", "d", "h", "off").join(common, ["cut", "h"], "left_semi").groupBy("cut", "d").agg(F.array_sort(F.collect_set(F.struct(F.col("off").alias("s"), (F.col("off") + 1).alias("e")))).alias("r"))
    parts = inside.select("cut", "d", F.explode(_merged(F.col("r"))).alias("r")).select("cut", "d", "r.s", "r.e")
    # of a cell shared whole, parts say nothing new
    ranges = kept.select("k", "p", "cut", "d").join(whole.unionByName(parts), ["cut", "d"]).select("k", F.struct((F.col("p") + F.col("s")).alias("s"), (F.col("p") + F.col("e") - 1 + least).alias("e")).alias("r"))
    # the ranges of a record are as many as its text is long
    runs = ranges.groupBy("k").agg(F.collect_set("r").alias("rs")).select("k", F.explode(_merged(F.col("rs"))).alias("r"))
    return runs.select(F.col("k").alias(key), F.col("r.s").cast("int").alias("start_pos"), F.col("r.e").cast("int").alias("end_pos"))


def found(spark: SparkSession, d: str) -> DataFrame:
    """Shared runs of every verse."""
    return shared_spans(table(spark, d, "verses").select("verse_id", "text"), "verse_id", "text")


def shared_chunks(df: DataFrame, key: str, text: str, least: int = 80) -> DataFrame:
    """(digest, n_chars, n_records): the variable chunks that more than one record has, deduplicated by digest."""
    records = df.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).filter(F.col("k").isNotNull() & (F.length("t") >= least))

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            for i, j in _parts(texts):
                rolled = Rolled(texts[i:j], least)
                owner, starts, ends = rolled.chunks()
                digest = _slices(rolled.gears, starts, ends)
                yield pa.RecordBatch.from_arrays([pa.array(keys[i:j][owner]), _signed(digest), pa.array((ends - starts).astype(np.int32))], ["k", "digest", "n"])

    chunks = records.mapInArrow(chunk, "k long, digest long, n int")
    return chunks.distinct().groupBy("digest").agg(F.max("n").alias("n_chars"), F.count("*").cast("long").alias("n_records")).filter("n_records > 1")


def chunks_query(spark: SparkSession, d: str) -> DataFrame:
    """Chunks that several verses have whole."""
    return shared_chunks(table(spark, d, "verses").select("verse_id", "text"), "verse_id", "text")


def shares(spark: SparkSession, d: str) -> DataFrame:
    """For each verse with shared passages, how much of its text stands elsewhere too."""
    runs = found(spark, d).groupBy("verse_id").agg(F.count("*").cast("long").alias("n_runs"), F.sum(F.col("end_pos") - F.col("start_pos")).cast("long").alias("shared_chars"))
    texts = table(spark, d, "verses").groupBy("verse_id").agg(F.max(F.length("text")).cast("long").alias("n_chars"))
    return runs.join(texts, "verse_id").select("verse_id", "n_runs", "shared_chars", "n_chars", (F.col("shared_chars") / F.col("n_chars")).alias("shared_share"))


queries = {"p1_found": found, "p1_shares": shares, "p1_chunks": chunks_query}

_SQL = """
WITH v AS (SELECT DISTINCT verse_id, text FROM verses WHERE length(text) >= 80),
w AS (SELECT verse_id, p, substr(text, p + 1, 80) AS s FROM (SELECT verse_id, text, unnest(range(0, length(text) - 79)) AS p FROM v)),
g AS (SELECT s FROM w GROUP BY s HAVING min(verse_id) <> max(verse_id)),
h AS (SELECT verse_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY verse_id ORDER BY p) <= 80 THEN 0 ELSE 1 END AS fresh FROM w WHERE s IN (SELECT s FROM g)),
r AS (SELECT verse_id, p, sum(fresh) OVER (PARTITION BY verse_id ORDER BY p) AS run FROM h),
f AS (SELECT verse_id, CAST(min(p) AS INT) AS start_pos, CAST(max(p) + 80 AS INT) AS end_pos FROM r GROUP BY verse_id, run)
"""

oracles = {
    "p1_found": _SQL + "SELECT * FROM f",
    "p1_shares": _SQL + """SELECT verse_id, count(*) AS n_runs, CAST(sum(end_pos - start_pos) AS BIGINT) AS shared_chars, max(n_chars) AS n_chars, sum(end_pos - start_pos) / max(n_chars) AS shared_share
FROM f JOIN (SELECT verse_id, max(length(text)) AS n_chars FROM verses GROUP BY 1) USING (verse_id) GROUP BY 1""",
}
