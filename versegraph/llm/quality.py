"""Problem 8: per-document text statistics and fixed-threshold rules with a recorded reason for each failure.

All statistics are vectorized over the code points of an Arrow batch of documents, in one scan without a shuffle. The list of
common words is a fixed table; it is sent to the executors only if it has at most ``MOST_COMMON`` words, else it raises.

Defined results: a null text has null statistics and no reasons (it is not judged); an empty or blank text has zero counts,
zero shares and no reasons; texts of any length are measured whole; repeated documents give a row each, as delivered; columns of the input other
than the two named are kept out of the result, so clashing names do no harm.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.session import table

MOST_COMMON = 5000

#: Fixed thresholds. Those from "gopher" are the published rules of Rae et al. 2021 (arXiv:2112.11446, table A1), whose words are what stands between whitespace;
#: those from "c4" of Raffel et al. 2020 (arXiv:1910.10683); "form" are our own: the share of common words that acquits a text (natural prose of the four
#: languages keeps more than a third of its words common, lists and tables under a sixth), and the most words of a lone sentence, which needn't have two stop words.
THRESHOLDS = {
    "gopher_words_min": 50,
    "gopher_words_max": 100_000,
    "gopher_mean_word_min": 3.0,
    "gopher_mean_word_max": 10.0,
    "gopher_symbol_ratio": 0.1,
    "gopher_bullet_share": 0.9,
    "gopher_ellipsis_share": 0.3,
    "gopher_alpha_share": 0.8,
    "gopher_stop_words": 2,
    "c4_terminal_share": 0.5,
    "form_common_share": 0.18,
    "form_sentence_words": 12,
}

#: Whitespace is ASCII whitespace; letters, marks, numbers are the Unicode classes L, M, N.
SPACE, LETTER, MARK, NUMBER, DIGIT, TERMINAL, CLOSER, BULLET, BREAK, OTHER = (1 << k for k in range(10))
_CLASSES = np.full(sys.maxunicode + 1, 0xFFFF, np.uint16)  # 0xFFFF: not looked up yet
#: Multiplier of the word hash; odd, so that its powers can be undone modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def _class_of(c: str) -> int:
    kind = unicodedata.category(c)[0]
    return (
        SPACE * (c in " \t\n\v\f\r")
        | {"L": LETTER, "M": MARK, "N": NUMBER}.get(kind, 0)
        | DIGIT * (c in "0123456789")
        | TERMINAL * (c in ".!?")
        | CLOSER * (c in "'\"”’)")
        | BULLET * (c in "•*‣◦-")
        | BREAK * (c in "\n\r")
        | OTHER * (kind not in "LMN" and c not in " \t\n\v\f\r")
    )


def classes(codes: np.ndarray) -> np.ndarray:
    """The class bits of each code point; new code points are looked up once a process."""
    out = _CLASSES[codes]
    if (new := out == 0xFFFF).any():
        for c in np.unique(codes[new]):
            _CLASSES[c] = _class_of(chr(c))
        out = _CLASSES[codes]
    return out


def codes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points, each text followed by a line feed, and where each text starts (with the end as the last entry)."""
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32) if texts else np.zeros(0, np.uint32)
    return codes, np.concatenate([[0], np.cumsum(lengths)])


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of true."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return edges[::2], edges[1::2]


def _hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of each slice."""
    n = len(codes) + 1
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n + 1, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _POWERS["up"][: len(codes)], dtype=np.uint64)])
    return (total[ends] - total[starts]) * _POWERS["down"][starts]


def measure(texts: list[str], common: np.ndarray) -> dict[str, np.ndarray]:
    """Counts for each text; ``common``: sorted hashes of the common words."""
    lowered = [t.lower() for t in texts]
    codes, at = codes_of(lowered)
    kind = classes(codes)
    of = lambda places: np.searchsorted(at, places, side="right") - 1
    count = lambda places: np.bincount(of(places), minlength=len(texts))[: len(texts)]
    out = {"n_chars": np.fromiter(map(len, texts), np.int64, len(texts))}
    starts, ends = _runs((kind & LETTER) > 0)
    owner = of(starts)
    out["n_words"] = np.bincount(owner, minlength=len(texts))
    out["word_chars"] = np.bincount(owner, weights=ends - starts, minlength=len(texts)).astype(np.int64)
    h = _hashes(codes, starts, ends)
    spot = np.minimum(np.searchsorted(common, h), max(0, len(common) - 1))
    out["n_common"] = np.bincount(owner[common[spot] == h], minlength=len(texts)) if len(common) else np.zeros(len(texts), np.int64)
    # pieces between whitespace
    ink = (kind & SPACE) == 0
    starts, ends = _runs(ink)
    letters = np.concatenate([[0], np.cumsum((kind & LETTER) > 0)])
    out["n_chunks"], out["n_alpha"] = count(starts), count(starts[letters[ends] > letters[starts]])
    # lines: from a break to the next; those without ink don't count
    breaks = np.flatnonzero(kind & BREAK)
    begin, end = np.concatenate([[0], breaks[:-1] + 1]).astype(np.int64), breaks
    inked = np.concatenate([[0], np.cumsum(ink)])
    full = inked[end] > inked[begin]
    begin, end = begin[full], end[full]
    index = np.arange(len(codes))
    last = np.maximum.accumulate(np.where(ink, index, -1))[end]  # the last ink of each line
    final = last
    # a block id (``^v1``) at the end of a line is a mark of the layout: what stands before it counts
    chunk = starts[np.searchsorted(starts, last, side="right") - 1] if len(starts) else last
    marked = (codes[chunk] == ord("^")) & (chunk > begin)
    last = np.where(marked, np.maximum.accumulate(np.where(ink, index, -1))[np.maximum(chunk - 1, 0)], last)
    before = np.maximum.accumulate(np.where((kind & CLOSER) == 0, index, -1))[last]
    out["n_lines"] = count(begin)
    out["n_ink"] = inked[at[1:]] - inked[at[:-1]]
    out["n_terminal"] = count(begin[(before >= begin) & ((kind[np.maximum(before, 0)] & TERMINAL) > 0)])
    dots = codes == ord(".")
    three = final >= begin + 2
    three &= dots[final] & dots[np.maximum(final - 1, 0)] & dots[np.maximum(final - 2, 0)]
    out["n_ellipsis"] = count(begin[three | (codes[final] == ord("…"))])
    first = np.minimum.accumulate(np.where(ink, index, len(codes))[::-1])[::-1][begin]
    past = np.minimum.accumulate(np.where((kind & DIGIT) == 0, index, len(codes))[::-1])[::-1][first]  # the end of digits there
    after = np.minimum(past + 1, len(codes) - 1)
    numbered = (past > first) & ((codes[past] == ord(".")) | (codes[past] == ord(")"))) & ((kind[after] & SPACE) > 0) & (past + 1 < end)
    bulleted = ((kind[first] & BULLET) > 0) & ((kind[np.minimum(first + 1, len(codes) - 1)] & SPACE) > 0) & (first + 1 < end)
    out["n_bullets"] = count(begin[numbered | bulleted])
    starts, ends = _runs(dots)
    out["n_symbols"] = count(np.flatnonzero((codes == ord("#")) | (codes == ord("…")))) + np.bincount(of(starts), weights=(ends - starts) // 3, minlength=len(texts)).astype(np.int64)
    out["n_marks"] = count(np.flatnonzero(kind & OTHER))
    return out


COUNTS = ["n_chars", "n_words", "n_lines", "n_chunks", "word_chars", "n_ink", "n_common", "n_alpha", "n_terminal", "n_bullets", "n_ellipsis", "n_symbols", "n_marks"]
#: Most characters measured at once; longer batches are cut between texts.
MOST_CHARS = 1 << 22


def statistics(df: DataFrame, key: str, text: str, common: list[str]) -> DataFrame:
    """One row of statistics for each row of ``df``."""
    sent = df.sparkSession.sparkContext.broadcast([w.lower() for w in common])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, at = codes_of(sent.value)
        known = np.unique(_hashes(codes, at[:-1], at[1:] - 1))
        for batch in batches:
            texts, null = batch.column(1).to_pylist(), np.asarray(batch.column(1).is_null())
            parts, size, i = [], 0, 0
            for j, t in enumerate(texts):
                texts[j] = t or ""
                size += len(texts[j])
                if size > MOST_CHARS or j == len(texts) - 1:
                    parts.append(measure(texts[i : j + 1], known))
                    size, i = 0, j + 1
            columns = [pa.array(np.concatenate([p[c] for p in parts]) if parts else [], pa.int64(), mask=null if parts else None) for c in COUNTS]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [key, *COUNTS])

    kind = df.schema[key].dataType.simpleString()
    counted = df.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"{c} long" for c in COUNTS))
    share = lambda part, whole: F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).when(F.col(whole) == 0, F.lit(0.0))
    return counted.select(
        key,
        "n_chars",
        "n_words",
        "n_lines",
        share("word_chars", "n_words").alias("mean_word_length"),
        share("n_ink", "n_chunks").alias("mean_piece_length"),
        share("n_symbols", "n_chunks").alias("symbol_ratio"),
        share("n_marks", "n_chars").alias("mark_share"),
        share("n_terminal", "n_lines").alias("terminal_share"),
        share("n_bullets", "n_lines").alias("bullet_share"),
        share("n_ellipsis", "n_lines").alias("ellipsis_share"),
        share("n_alpha", "n_chunks").alias("alpha_share"),
        share("n_common", "n_words").alias("common_share"),
        "n_common",
        "n_chunks",
    )


def rules() -> dict[str, Column]:
    """Reason -> condition of failure."""
    c, t = F.col, THRESHOLDS
    sentence = (c("n_words") <= t["form_sentence_words"]) & (c("n_words") >= 2) & (c("n_lines") <= 2) & (c("terminal_share") >= 0.5) & (c("alpha_share") >= 0.7)
    return {
        "too_few_words": c("n_words") < t["gopher_words_min"],
        "too_many_words": c("n_words") > t["gopher_words_max"],
        "short_words": c("mean_piece_length") < t["gopher_mean_word_min"],
        "long_words": c("mean_piece_length") > t["gopher_mean_word_max"],
        "symbols": c("symbol_ratio") > t["gopher_symbol_ratio"],
        "bullets": c("bullet_share") > t["gopher_bullet_share"],
        "ellipses": c("ellipsis_share") > t["gopher_ellipsis_share"],
        "few_alphabetic": c("alpha_share") < t["gopher_alpha_share"],
        "no_stop_words": (c("n_common") < t["gopher_stop_words"]) & ~sentence,
        "open_lines": c("terminal_share") < t["c4_terminal_share"],
        "few_common_words": c("common_share") < t["form_common_share"],
    }


#: The published rules about form; those about length and line ends say nothing about it, since a sentence or a wrapped paragraph is prose too.
FORM = ["short_words", "long_words", "symbols", "bullets", "ellipses", "few_alphabetic", "no_stop_words"]


def judged(stats: DataFrame) -> DataFrame:
    """``stats`` with ``reasons``: the names of the failed rules, joined with commas; null for a null text."""
    blank = F.col("n_chunks") == 0
    reasons = F.concat_ws(",", *(F.when(condition, F.lit(name)) for name, condition in rules().items()))
    return stats.withColumn("reasons", F.when(blank, "").when(F.col("n_chunks").isNotNull(), reasons))


def common_words(spark: SparkSession, d: str) -> list[str]:
    """The fixed list of common words of all languages; its size is checked."""
    rows = table(spark, d, "word_list").filter("is_common").select("word").distinct().limit(MOST_COMMON + 1).collect()
    if len(rows) > MOST_COMMON:
        raise ValueError(f"more than {MOST_COMMON} common words")
    return sorted(r.word for r in rows if r.word is not None)


def stats_query(spark: SparkSession, d: str) -> DataFrame:
    return judged(statistics(table(spark, d, "documents"), "doc_id", "text", common_words(spark, d))).drop("n_chunks", "n_common")


def not_prose(reasons: Column) -> Column:
    """Whether a text fails a published rule about form, unless its common words acquit it (verse with a stroke after every third word is prose)."""
    failed = F.split(reasons, ",")
    return F.arrays_overlap(failed, F.array(*map(F.lit, FORM))) & F.array_contains(failed, "few_common_words")


def found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that are no running prose as a whole."""
    return judged(statistics(table(spark, d, "documents"), "doc_id", "text", common_words(spark, d))).filter(not_prose(F.col("reasons"))).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()


def reasons_query(spark: SparkSession, d: str) -> DataFrame:
    """How many documents fail each rule; a document delivered twice counts twice."""
    stats = judged(statistics(table(spark, d, "documents"), "doc_id", "text", common_words(spark, d))).select(F.explode(F.split("reasons", ",")).alias("reason"))
    return stats.filter("reason <> ''").groupBy("reason").agg(F.count("*").cast("long").alias("n_documents"))


queries = {"p8_found": found, "p8_stats": stats_query, "p8_reasons": reasons_query}

_SQL = r"""
WITH cm AS (SELECT list(DISTINCT word) AS l FROM word_list WHERE is_common),
b AS (
  SELECT doc_id, text, l, list_filter(regexp_split_to_array(lower(text), '[^\p{L}]+'), lambda x: x <> '') AS w,
    list_filter(regexp_split_to_array(text, '\r\n|\r|\n'), lambda x: regexp_matches(x, '[^\s\x0b]')) AS n,
    list_filter(regexp_split_to_array(text, '[\s\x0b]+'), lambda x: x <> '') AS c
  FROM documents, cm),
k AS (
  SELECT doc_id, length(text) AS n_chars, len(w) AS n_words, len(n) AS n_lines, len(c) AS n_chunks, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
    coalesce(list_sum(list_transform(c, lambda x: length(x))), 0) AS n_ink, len(list_filter(w, lambda x: list_contains(l, x))) AS n_common, len(list_filter(c, lambda x: regexp_matches(x, '\p{L}'))) AS n_alpha,
    len(list_filter(n, lambda x: regexp_matches(x, '[.!?][''"”’)]*([\s\x0b]+\^[^\s\x0b]*)?\s*$'))) AS n_terminal,
    len(list_filter(n, lambda x: regexp_matches(x, '^\s*([•*‣◦-]|\d+[.)])\s'))) AS n_bullets,
    len(list_filter(n, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS n_ellipsis,
    len(regexp_extract_all(text, '#|\.\.\.|…')) AS n_symbols, len(regexp_extract_all(text, '[^\p{L}\p{M}\p{N}\s\x0b]')) AS n_marks
  FROM b),
s AS (
  SELECT doc_id, n_chars, n_words, n_lines, n_chunks, n_common,
    CASE WHEN n_words > 0 THEN word_chars / n_words WHEN n_words = 0 THEN 0.0 END AS mean_word_length,
    CASE WHEN n_chunks > 0 THEN n_ink / n_chunks WHEN n_chunks = 0 THEN 0.0 END AS mean_piece_length,
    CASE WHEN n_chunks > 0 THEN n_symbols / n_chunks WHEN n_chunks = 0 THEN 0.0 END AS symbol_ratio,
    CASE WHEN n_chars > 0 THEN n_marks / n_chars WHEN n_chars = 0 THEN 0.0 END AS mark_share,
    CASE WHEN n_lines > 0 THEN n_terminal / n_lines WHEN n_lines = 0 THEN 0.0 END AS terminal_share,
    CASE WHEN n_lines > 0 THEN n_bullets / n_lines WHEN n_lines = 0 THEN 0.0 END AS bullet_share,
    CASE WHEN n_lines > 0 THEN n_ellipsis / n_lines WHEN n_lines = 0 THEN 0.0 END AS ellipsis_share,
    CASE WHEN n_chunks > 0 THEN n_alpha / n_chunks WHEN n_chunks = 0 THEN 0.0 END AS alpha_share,
    CASE WHEN n_words > 0 THEN n_common / n_words WHEN n_words = 0 THEN 0.0 END AS common_share
  FROM k),
j AS (
  SELECT *, CASE WHEN n_chunks = 0 THEN '' WHEN n_chunks IS NULL THEN NULL ELSE concat_ws(',',
    CASE WHEN n_words < 50 THEN 'too_few_words' END, CASE WHEN n_words > 100000 THEN 'too_many_words' END,
    CASE WHEN mean_piece_length < 3 THEN 'short_words' END, CASE WHEN mean_piece_length > 10 THEN 'long_words' END,
    CASE WHEN symbol_ratio > 0.1 THEN 'symbols' END, CASE WHEN bullet_share > 0.9 THEN 'bullets' END, CASE WHEN ellipsis_share > 0.3 THEN 'ellipses' END,
    CASE WHEN alpha_share < 0.8 THEN 'few_alphabetic' END, CASE WHEN n_common < 2 AND NOT (n_words <= 12 AND n_words >= 2 AND n_lines <= 2 AND terminal_share >= 0.5 AND alpha_share >= 0.7) THEN 'no_stop_words' END,
    CASE WHEN terminal_share < 0.5 THEN 'open_lines' END,
    CASE WHEN common_share < 0.18 THEN 'few_common_words' END) END AS reasons
  FROM s)
"""

oracles = {
    "p8_found": _SQL + "SELECT DISTINCT doc_id FROM j WHERE list_has_any(string_split(reasons, ','), ['short_words', 'long_words', 'symbols', 'bullets', 'ellipses', 'few_alphabetic', 'no_stop_words']) AND list_contains(string_split(reasons, ','), 'few_common_words')",
    "p8_stats": _SQL + "SELECT doc_id, n_chars, n_words, n_lines, CAST(mean_word_length AS DOUBLE) AS mean_word_length, CAST(mean_piece_length AS DOUBLE) AS mean_piece_length, CAST(symbol_ratio AS DOUBLE) AS symbol_ratio, CAST(mark_share AS DOUBLE) AS mark_share, CAST(terminal_share AS DOUBLE) AS terminal_share, CAST(bullet_share AS DOUBLE) AS bullet_share, CAST(ellipsis_share AS DOUBLE) AS ellipsis_share, CAST(alpha_share AS DOUBLE) AS alpha_share, CAST(common_share AS DOUBLE) AS common_share, reasons FROM j",
    "p8_reasons": _SQL + "SELECT reason, count(*) AS n_documents FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM j) WHERE reason <> '' GROUP BY 1",
}
