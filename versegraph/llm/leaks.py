"""Problem 7: evaluation passages inside training documents, by a stored positional inverted index.

Index. ``store_index`` writes the postings of all terms of all documents once, as a Parquet table in the shared folder: a row holds a term,
a shard of documents (about ``SHARD_CHARS`` characters, whole documents) and the sorted token places of the term in the shard. Rows are
partitioned by term and sorted by it, so that a search reads the pages of its terms only; the rows of a hot term (``HOT`` postings or more in
a shard) are spread by shard, so that no partition holds a term that fills a third of the corpus. Any set of items is asked of the stored
index (``search``); the documents are read and tokenized once.

Phrase. Every window of ``words`` consecutive item words starts from the list of its globally rarest term and is intersected with the lists of
the others, from the rarer to the more frequent, each shifted by its term's place in the window, until no start is left or all terms agreed.
Only the lists of terms that occur in some possible window are read; those of one shard meet in one task, which is the bound of what a task
holds. Proximity asks the same lists for most of a window's terms near their places.

The items are sent to the executors in parts of ``PART_BYTES``; however many there are, every part is asked.

Words are maximal runs of letters (Unicode L*) and decimal digits (Nd), in lower case.

Defined results: null or empty texts contain nothing; items of fewer than ``words`` words have no window and are never
found by phrase; repeated documents or items give one row; ties between equally rare terms are broken by place; texts are
indexed whole, whatever their length; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.session import shared_folder, table

#: What stands between words.
GAPS = r"[^\p{L}\p{Nd}]+"
#: Characters of a shard of documents; a longer document is a shard alone.
SHARD_CHARS = 1 << 22
#: Postings in one shard from which on a term is spread over partitions by shard.
HOT = 5_000
#: Bytes of item text asked at once, and candidates verified at once.
PART_BYTES, MOST_CANDIDATES = 32 << 20, 1 << 21
INDEX = "term string, shard long, n int, places binary, docs binary"


def words_of(texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts one after another, and where each text's begin (with the end as the last entry)."""
    lists = pc.split_pattern_regex(pa.array([t.lower() if t else "" for t in texts], pa.large_string()), GAPS)
    words = lists.flatten()
    full = pc.not_equal(words, "")
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    return words.filter(full), kept[bounds]


def postings(texts: list[str | None]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(terms, bounds of each term's places, places, starts of the texts): places count words, with one left free after each text, which keeps windows apart."""
    words, bounds = words_of(texts)
    coded = words.dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False)
    sizes = np.diff(bounds)
    places = np.arange(len(ids)) + np.repeat(np.arange(len(texts)), sizes)
    order = np.argsort(ids, kind="stable")
    return coded.dictionary, np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=len(coded.dictionary)))]), places[order].astype(np.int32), bounds + np.arange(len(texts) + 1)


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(np.ascontiguousarray(bounds * values.itemsize, np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[str]]]:
    """Documents of the batches in shards."""
    keys, texts, size = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if texts and size + len(text) > SHARD_CHARS:
                yield keys, texts
                keys, texts, size = [], [], 0
            keys.append(key)
            texts.append(text)
            size += len(text)
    if texts:
        yield keys, texts


def store_index(documents: DataFrame, doc_key: str, doc_text: str, folder: str | None = None) -> str:
    """Writes the index of the documents to ``folder`` (a new one in the shared folder by default) and returns it. A row without a term holds the ids and starts of a shard's documents."""
    folder = folder or shared_folder(documents.sparkSession, "postings")

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, (keys, texts) in enumerate(_shards(batches)):
            terms, bounds, places, starts = postings(texts)
            gaps = np.diff(places, prepend=np.int32(0))
            begin = bounds[:-1]
            gaps[begin] = places[begin]
            ids, starts = np.array(keys, np.int64), starts.astype(np.int64)
            n = len(terms) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([terms.cast(pa.string()), pa.nulls(1, pa.string())]),
                    pa.array(np.full(n, (task << 32) + number, np.int64)),
                    pa.array(np.append(np.diff(bounds), len(keys)).astype(np.int32)),
                    pa.concat_arrays([_binary(gaps, bounds), pa.array([starts.tobytes()], pa.binary())]),
                    pa.concat_arrays([pa.nulls(n - 1, pa.binary()), pa.array([ids.tobytes()], pa.binary())]),
                ],
                ["term", "shard", "n", "places", "docs"],
            )

    texts = documents.select(F.col(doc_key).cast("long").alias("k"), F.col(doc_text).alias("t")).filter("k is not null and t is not null")
    rows = texts.mapInArrow(post, INDEX)
    spread = F.when(F.col("term").isNull() | (F.col("n") >= HOT), F.col("shard")).otherwise(0)
    rows.repartition("term", spread).sortWithinPartitions("term", "shard").write.option("compression", "zstd").parquet(folder)
    return folder


class Shard:
    """The lists of some terms over one shard's documents."""

    def __init__(self, terms: np.ndarray, lists: list[np.ndarray], starts: np.ndarray, n_terms: int):
        self.starts = starts
        sizes = np.zeros(n_terms + 1, np.int64)
        by_term = np.argsort(terms)
        sizes[terms + 1] = [len(x) for x in lists]
        self.bounds = np.cumsum(sizes)
        self.order = np.concatenate([lists[i] for i in by_term]) if lists else np.zeros(0, np.int32)
        # membership in a list, place by place
        self.stream = np.full(starts[-1], -1, np.int32)
        self.stream[self.order] = np.repeat(np.arange(n_terms, dtype=np.int32), np.diff(self.bounds))

    def frequency(self) -> np.ndarray:
        return np.diff(self.bounds)

    def postings(self, term: int) -> np.ndarray:
        return self.order[self.bounds[term] : self.bounds[term + 1]]

    def phrases(self, windows: np.ndarray, rarity: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, start) of every place where a window's terms stand one after another. rarity: for each window its places from the rarest term on."""
        own = self.frequency()
        row = np.arange(len(windows))
        alive = np.flatnonzero((own[windows] > 0).all(axis=1))
        seeds = own[windows[row, rarity[:, 0]]]
        # lists of at most MOST_CANDIDATES at once, or one list
        cuts = np.flatnonzero(np.diff(np.cumsum(seeds[alive]) // MOST_CANDIDATES, prepend=0)) if len(alive) else []
        for part in np.split(alive, cuts):
            if not len(part):
                continue
            first = rarity[part, 0]
            which = np.repeat(part, seeds[part])
            at = np.concatenate([self.postings(t) for t in windows[part, first]]) - np.repeat(first, seeds[part])
            inside = (at >= 0) & (at <= len(self.stream) - windows.shape[1])
            which, at = which[inside], at[inside]
            for r in range(1, windows.shape[1]):
                place = rarity[which, r]
                agreed = self.stream[at + place] == windows[which, place]
                which, at = which[agreed], at[agreed]
            if len(which):
                yield which, at

    def regions(self, windows: Iterable[np.ndarray], least: Iterable[int], span: int) -> Iterator[np.ndarray | None]:
        """For each window of distinct terms a mask over blocks of ``span`` places, or None: only these can lie in ``span`` places with ``least`` of the terms.

        Counted are the terms of every two neighbouring blocks; from one window to the next only the terms that differ are.
        """
        size = len(self.stream) // span + 1
        rows: dict[int, np.ndarray] = {}
        held = np.zeros(size, np.min_scalar_type(span))
        for window, enough in zip(windows, least):
            terms = set(window.tolist())
            for gone in rows.keys() - terms:
                held -= rows.pop(gone)
            for new in terms - rows.keys():
                one = np.zeros(size + 1, bool)
                one[self.postings(new) // span] = True
                rows[new] = one[:-1] | one[1:]
                held += rows[new]
            pair = held >= enough
            if pair.any():
                pair[1:] |= pair[:-1].copy()
                yield pair
            else:
                yield None

    def near(self, distinct: np.ndarray, first: np.ndarray, frequency: np.ndarray, slack: int, least: int, region: np.ndarray | None = None, span: int = 1) -> np.ndarray:
        """Numbers of the documents with a place around which at least ``least`` of the ``distinct`` terms stand within ``slack`` of where the phrase has them (``first``).

        region: which blocks of ``span`` places to look at (None: all).
        """
        present = self.frequency()[distinct] > 0
        distinct, first = distinct[present], first[present]
        spare = len(distinct) - least
        if spare < 0:
            return np.zeros(0, np.int64)
        order = np.argsort(frequency[distinct], kind="stable")
        # a match lacks at most len - least terms, so one of the rarest that many + 1 is there
        starts = []
        for s in order[: spare + 1]:
            at = self.postings(distinct[s])
            at = at if region is None else at[region[at // span]]
            starts.append(np.stack([at - first[s], self.document(at)]))
        starts, hits = np.concatenate(starts, axis=1), []
        # the anchor may itself be off by the slack: places of each term for each shift, in a stretch that begins twice the slack before
        around = np.arange(first.max() + 4 * slack + 1) - 2 * slack
        places = first[:, None, None] + np.arange(2 * slack + 1)[None, :, None] + np.arange(2 * slack + 1)
        for i in range(0, starts.shape[1], 10_000):
            at, doc = starts[:, i : i + 10_000]
            position = at[:, None] + around
            own = (position >= self.starts[doc][:, None]) & (position < self.starts[doc + 1][:, None])
            words = np.where(own, self.stream[np.clip(position, 0, len(self.stream) - 1)], -1)
            there = words[:, None, :] == distinct[None, :, None]
            kept = there.any(axis=2).sum(axis=1) >= least
            score = there[kept][:, np.arange(len(distinct))[:, None, None], places].any(axis=3).sum(axis=1)
            hits.append(doc[kept][(score >= least).any(axis=1)])
        return np.unique(np.concatenate(hits)) if hits else np.zeros(0, np.int64)

    def document(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, side="right") - 1


def _parts(items: DataFrame, item_key: str, item_text: str) -> Iterator[list[tuple[int, list[str]]]]:
    """Keys and words of all items, in parts of about PART_BYTES."""
    picked = items.select(F.col(item_key).alias("k"), F.col(item_text).alias("t")).filter("k is not null and t is not null").distinct()
    size = picked.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    n = size // PART_BYTES + 1
    for i in range(n):
        rows = sorted((r.k, r.t) for r in picked.filter(F.pmod(F.xxhash64("k"), F.lit(n)) == i).collect())
        words, bounds = words_of([t for _, t in rows])
        words = words.to_pylist()
        yield [(k, words[a:b]) for (k, _), a, b in zip(rows, bounds, bounds[1:])]


def _search(spark: SparkSession, folder: str, asked: list[tuple[int, list[str]]], words: int, mode: str, slack: int, share: float) -> DataFrame:
    """(doc_id, item_id, window) of the documents that hold a window of one part of the items."""
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, ws in asked for w in ws}))}
    windows: dict[tuple[int, ...], list[int]] = {}
    for key, ws in asked:
        ids = [vocabulary[w] for w in ws]
        for i in range(len(ids) - words + 1):
            windows.setdefault(tuple(ids[i : i + words]), []).append(key)
    index = spark.read.schema(INDEX).parquet(folder)
    # bounded by PART_BYTES
    numbered = F.broadcast(spark.createDataFrame(pa.table({"term": pa.array(list(vocabulary), pa.string()), "tid": pa.array(list(vocabulary.values()), pa.int32())})))
    counted = index.join(numbered, "term").groupBy("tid").agg(F.sum("n").alias("n")).toArrow()
    frequency = np.zeros(len(vocabulary), np.int64)
    frequency[counted.column(0).to_numpy()] = counted.column(1).to_numpy()
    asked_windows, owners = np.array(list(windows), np.int32).reshape(-1, words), list(windows.values())
    if mode == "phrase":  # a window with a term that no document has is nowhere
        possible = (frequency[asked_windows] > 0).all(axis=1)
        asked_windows, owners = asked_windows[possible], [o for o, p in zip(owners, possible) if p]
    needed = np.unique(asked_windows)
    sent = spark.sparkContext.broadcast((asked_windows, owners, frequency))

    def ask(group: pa.Table) -> pa.Table:
        asked_windows, owners, frequency = sent.value
        tids, places, docs = (group.column(c) for c in ("tid", "places", "docs"))
        head = tids.to_pylist().index(None)
        ids, starts = np.frombuffer(docs[head].as_py(), np.int64), np.frombuffer(places[head].as_py(), np.int64)
        rows = [i for i in range(len(group)) if i != head]
        shard = Shard(np.array([tids[i].as_py() for i in rows], np.int64), [np.cumsum(np.frombuffer(places[i].as_py(), np.int32)) for i in rows], starts, len(frequency))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        if mode == "phrase":
            rarity = np.argsort(frequency[asked_windows], axis=1, kind="stable")
            for which, at in shard.phrases(asked_windows, rarity):
                pairs = np.unique(np.stack([which, shard.document(at)]), axis=1)
                found.append((pairs[0], pairs[1]))
        else:
            span = words + 2 * slack
            terms = [np.unique(w, return_index=True) for w in asked_windows]
            least = [int(np.ceil(share * len(t))) for t, _ in terms]
            for q, mask in enumerate(shard.regions((t for t, _ in terms), least, span)):
                if mask is not None:
                    there = shard.near(*terms[q], frequency, slack, least[q], mask, span)
                    found.append((np.full(len(there), q), there))
        which = np.concatenate([w for w, _ in found] or [np.zeros(0, np.int64)])
        there = np.concatenate([x for _, x in found] or [np.zeros(0, np.int64)])
        n = np.fromiter((len(owners[q]) for q in which), np.int64, len(which))
        return pa.table({"doc_id": pa.array(np.repeat(ids[there], n)), "item_id": pa.array([o for q in which for o in owners[q]], pa.int64()), "window": pa.array(np.repeat(which, n).astype(np.int32))})

    wanted = F.broadcast(spark.createDataFrame(pa.table({"term": pa.array([w for w, i in vocabulary.items() if i in set(needed.tolist())], pa.string()), "tid": pa.array(needed.astype(np.int32))})))
    lists = index.join(wanted, "term", "left").filter("tid is not null or term is null").select("shard", "tid", "places", "docs")
    # by number, so that shards, whose work is in Python, aren't put together by their bytes
    return lists.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard").groupBy("shard").applyInArrow(ask, "doc_id long, item_id long, window int")


def search(spark: SparkSession, folder: str, items: DataFrame, item_key: str, item_text: str, *, words: int = 13, mode: str = "phrase", slack: int = 3, share: float = 0.8) -> DataFrame:
    """Distinct (doc_id, item_id, n_windows) from a stored index: the number of the item's windows of ``words`` words that the document contains.

    mode ``phrase``: the window's words stand one after another. ``proximity``: laid at some place of the document, at least ``share``
    of the window's distinct terms stand in the document within ``slack`` places of where the window has them (the first, of a repeated term).
    """
    hits = None
    for asked in _parts(items, item_key, item_text):
        part = _search(spark, folder, asked, words, mode, slack, share).groupBy("doc_id", "item_id").agg(F.countDistinct("window").alias("n_windows"))
        hits = part if hits is None else hits.unionAll(part)
    return hits


def matches(documents: DataFrame, items: DataFrame, doc_key: str, doc_text: str, item_key: str, item_text: str, **how) -> DataFrame:
    """Stores the index of ``documents`` and searches it for ``items``."""
    return search(documents.sparkSession, store_index(documents, doc_key, doc_text), items, item_key, item_text, **how)


def _matches(spark: SparkSession, d: str, **how) -> DataFrame:
    return matches(table(spark, d, "documents"), table(spark, d, "eval_items"), "doc_id", "text", "item_id", "text", **how)


def found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with at least 13 consecutive words of an item."""
    return _matches(spark, d).select("doc_id", "item_id")


def proximity(spark: SparkSession, d: str) -> DataFrame:
    """Documents with most terms of a 13-word window of an item near their places."""
    return _matches(spark, d, mode="proximity")


def per_item(spark: SparkSession, d: str) -> DataFrame:
    """For each item, how many documents leak it and how many of its windows the fullest leak has."""
    leaks = _matches(spark, d).groupBy("item_id").agg(F.count("*").cast("long").alias("n_documents"), F.max("n_windows").alias("most_windows"))
    items = table(spark, d, "eval_items").select("item_id", "task").distinct()
    return items.join(F.broadcast(leaks), "item_id", "left").select("item_id", "task", F.coalesce("n_documents", F.lit(0).cast("long")).alias("n_documents"), F.coalesce("most_windows", F.lit(0).cast("long")).alias("most_windows"))


queries = {"p7_found": found, "p7_proximity": proximity, "p7_per_item": per_item}

_SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{Nd}]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{Nd}]+') AS w FROM eval_items),
dg AS (SELECT doc_id, array_to_string(w[i:i+12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM dw)),
ig AS (SELECT DISTINCT item_id, array_to_string(w[i:i+12], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS i FROM iw)),
m AS (SELECT doc_id, item_id, count(DISTINCT g) AS n_windows FROM dg JOIN ig USING (g) GROUP BY 1, 2)
"""

oracles = {
    "p7_found": _SQL + "SELECT doc_id, item_id FROM m",
    "p7_per_item": _SQL + "SELECT e.item_id, e.task, count(m.doc_id) AS n_documents, coalesce(max(n_windows), 0) AS most_windows FROM (SELECT DISTINCT item_id, task FROM eval_items) e LEFT JOIN m USING (item_id) GROUP BY 1, 2",
}
