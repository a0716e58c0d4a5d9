"""Problem 4: references to records that do not exist."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.session import small, table
from ..operators.relational import FEW
from ..operators.references import orphans

MONTH = "yyyy-MM"


def _presence(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "verses").select("source", "book", "chapter", "verse", "loaded_at", "deleted_at")


def _reported(df: DataFrame, name: str, ref_id: str, key: str, at: str) -> DataFrame:
    return df.select(F.lit(name).alias("ref_table"), F.col(ref_id).cast("long").alias("ref_id"), F.col(key).cast("string").alias("ref_key"), F.date_format(at, MONTH).alias("ref_month"))


def _canonical(spark: SparkSession, d: str, df: DataFrame) -> DataFrame:
    """Records whose book is a canonical name; the canon is a fixed table of 56 rows."""
    return df.join(small(table(spark, d, "canon_books").select("book").distinct(), FEW), "book", "left_semi")


VERSE_KEY = [("source", "source"), ("book", "book"), ("chapter", "chapter"), ("verse", "verse")]


def _chapters(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chapters").select("chapter_id", "source", "book", "number", "verses", "built_at")


def _entries(chapters: DataFrame) -> DataFrame:
    return chapters.select("chapter_id", "source", "book", F.col("number").alias("chapter"), F.explode(F.array_distinct("verses")).alias("verse"), "built_at")


def found(spark: SparkSession, d: str) -> DataFrame:
    """Every dangling reference of ``verse_refs``, ``chapters`` and ``findings``."""
    refs = _canonical(spark, d, table(spark, d, "verse_refs").select("ref_id", "source", "book", "chapter", "verse", "noted_at"))
    refs = refs.filter("source is not null and verse is not null")
    # both kinds of verse reference go through one anti-join, so that the verses are shuffled once
    both = refs.select(F.lit("verse_refs").alias("ref_table"), F.col("ref_id"), "source", "book", "chapter", "verse", F.col("noted_at").alias("at")).unionByName(
        _entries(_canonical(spark, d, _chapters(spark, d))).filter("source is not null and verse is not null").select(F.lit("chapters").alias("ref_table"), F.col("chapter_id").alias("ref_id"), "source", "book", "chapter", "verse", F.col("built_at").alias("at"))
    )
    # a reference without a chapter has nothing it could refer to
    lost = orphans(both, _presence(spark, d), VERSE_KEY, at="at", since="loaded_at", until="deleted_at").unionByName(both.filter("chapter is null"))
    verses = lost.select("ref_table", "ref_id", F.col("verse").cast("string").alias("ref_key"), F.date_format("at", MONTH).alias("ref_month"))
    return verses.unionByName(_codes(spark, d)).distinct()


def _codes(spark: SparkSession, d: str) -> DataFrame:
    findings = table(spark, d, "findings").select("finding_id", "code", "found_at").filter("code is not null")
    rules = small(table(spark, d, "rule_codes").select("code", "introduced_at", "retired_at"), FEW)  # fixed, about 45 rows
    return _reported(orphans(findings, rules, [("code", "code")], at="found_at", since="introduced_at", until="retired_at"), "findings", "finding_id", "code", "found_at")


def report(spark: SparkSession, d: str) -> DataFrame:
    """Number of orphans per table and month."""
    return found(spark, d).groupBy("ref_table", "ref_month").agg(F.count("*").cast("long").alias("n_orphans"), F.countDistinct("ref_id").alias("n_records"))


def _masked(spark: SparkSession, d: str, refs: DataFrame) -> DataFrame:
    """Orphans under MATCH PARTIAL with their null mask: each mask that occurs is anti-joined on its non-null columns (a null verse cites the whole chapter)."""
    lost = orphans(refs, _presence(spark, d), VERSE_KEY, semantics="partial", at="at", since="loaded_at", until="deleted_at")
    mask = F.concat(*(F.when(F.col(k).isNull(), "0").otherwise("1") for k, _ in VERSE_KEY))
    return lost.select("ref_table", "ref_id", F.col("verse").cast("string").alias("ref_key"), mask.alias("null_mask"), F.date_format("at", MONTH).alias("ref_month"))


def _citations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "verse_refs").select(F.lit("verse_refs").alias("ref_table"), "ref_id", "source", "book", "chapter", "verse", F.col("noted_at").alias("at"))


def masked(spark: SparkSession, d: str) -> DataFrame:
    """References of all three tables under MATCH PARTIAL, whichever key columns are null; only those with no column at all aren't checked. Books are compared as stored."""
    entries = _entries(_chapters(spark, d)).select(F.lit("chapters").alias("ref_table"), F.col("chapter_id").alias("ref_id"), "source", "book", "chapter", "verse", F.col("built_at").alias("at"))
    codes = _codes(spark, d).select("ref_table", "ref_id", "ref_key", F.lit("1").alias("null_mask"), "ref_month")
    return _masked(spark, d, _citations(spark, d).unionByName(entries)).unionByName(codes).distinct()


def partial(spark: SparkSession, d: str) -> DataFrame:
    """Citations under MATCH PARTIAL that name a chapter, as the SQL takes them; ``masked`` has the others too."""
    return _masked(spark, d, _citations(spark, d).filter("chapter is not null")).select("ref_id", "null_mask", "ref_month").distinct()


queries = {"p4_found": found, "p4_report": report, "p4_partial": partial, "p4_masks": masked}

_SQL = """
WITH canon AS (SELECT DISTINCT book FROM canon_books),
refs AS (
  SELECT 'verse_refs' AS ref_table, ref_id, source, book, chapter, verse, noted_at AS ts FROM verse_refs WHERE verse IS NOT NULL
  UNION ALL
  SELECT 'chapters', chapter_id, source, book, number, unnest(verses), built_at FROM chapters
), lost AS (
  SELECT DISTINCT ref_table, ref_id, CAST(verse AS VARCHAR) AS ref_key, strftime(ts, '%Y-%m') AS ref_month
  FROM refs r
  WHERE source IS NOT NULL AND verse IS NOT NULL AND book IN (SELECT book FROM canon)
    AND NOT EXISTS (SELECT 1 FROM verses v WHERE v.source = r.source AND v.book = r.book AND v.chapter = r.chapter AND v.verse = r.verse
                    AND r.ts >= v.loaded_at AND (v.deleted_at IS NULL OR r.ts < v.deleted_at))
  UNION
  SELECT DISTINCT 'findings', finding_id, code, strftime(found_at, '%Y-%m')
  FROM findings f
  WHERE code IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM rule_codes c WHERE c.code = f.code AND f.found_at >= c.introduced_at AND (c.retired_at IS NULL OR f.found_at < c.retired_at))
)"""

_MASKS = """
WITH refs AS (
  SELECT 'verse_refs' AS ref_table, ref_id, source, book, chapter, verse, noted_at AS ts FROM verse_refs
  UNION ALL
  SELECT 'chapters', chapter_id, source, book, number, unnest(verses), built_at FROM chapters
), lost AS (
  SELECT * FROM refs r
  WHERE chapter IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM verses v WHERE (r.source IS NULL OR v.source = r.source) AND (r.book IS NULL OR v.book = r.book) AND v.chapter = r.chapter
      AND (r.verse IS NULL OR v.verse = r.verse) AND r.ts >= v.loaded_at AND (v.deleted_at IS NULL OR r.ts < v.deleted_at))
  UNION ALL
  SELECT * FROM refs r
  WHERE chapter IS NULL AND coalesce(source, book, CAST(verse AS VARCHAR)) IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM verses v WHERE (r.source IS NULL OR v.source = r.source) AND (r.book IS NULL OR v.book = r.book)
      AND (r.verse IS NULL OR v.verse = r.verse) AND r.ts >= v.loaded_at AND (v.deleted_at IS NULL OR r.ts < v.deleted_at))
)
SELECT DISTINCT ref_table, ref_id, CAST(verse AS VARCHAR) AS ref_key,
  concat(CAST(source IS NOT NULL AS INT), CAST(book IS NOT NULL AS INT), CAST(chapter IS NOT NULL AS INT), CAST(verse IS NOT NULL AS INT)) AS null_mask,
  strftime(ts, '%Y-%m') AS ref_month
FROM lost
UNION
SELECT 'findings', finding_id, code, '1', strftime(found_at, '%Y-%m')
FROM findings f
WHERE code IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM rule_codes c WHERE c.code = f.code AND f.found_at >= c.introduced_at AND (c.retired_at IS NULL OR f.found_at < c.retired_at))"""

oracles = {
    "p4_masks": _MASKS,
    "p4_found": _SQL + " SELECT * FROM lost",
    "p4_report": _SQL + " SELECT ref_table, ref_month, count(*) AS n_orphans, count(DISTINCT ref_id) AS n_records FROM lost GROUP BY 1, 2",
    "p4_partial": """
SELECT DISTINCT ref_id,
  CASE WHEN source IS NULL THEN '0' ELSE '1' END || CASE WHEN book IS NULL THEN '0' ELSE '1' END || '1' || CASE WHEN verse IS NULL THEN '0' ELSE '1' END AS null_mask,
  strftime(noted_at, '%Y-%m') AS ref_month
FROM verse_refs r
WHERE chapter IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM verses v WHERE (r.source IS NULL OR v.source = r.source) AND (r.book IS NULL OR v.book = r.book) AND v.chapter = r.chapter
    AND (r.verse IS NULL OR v.verse = r.verse) AND r.noted_at >= v.loaded_at AND (v.deleted_at IS NULL OR r.noted_at < v.deleted_at))""",
}
