"""Queries of the constraint engine and the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify as c
from ..functions.session import table
from ..operators import validation as v
from .ordered import _NOW, boxes
from .render import hubs


def _files(spark: SparkSession, d: str) -> DataFrame:
    """Hubs rendered from the verses as files, one edition a tree."""
    return hubs(spark, d).select(F.concat(F.col("source"), F.lit("/"), F.col("rel_path")).alias("path"), F.col("content").alias("text"))


def validate_hubs(spark: SparkSession, d: str) -> DataFrame:
    """Findings of the hub rules over all rendered hubs, by code."""
    return v.hub_findings(_files(spark, d), table(spark, d, "canon_books")).groupBy("severity", "code").agg(F.count("*").alias("n_findings"))


def anchor_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Rule HUB007 over all rendered hubs: anchors that skip a verse."""
    return v.hub_findings(_files(spark, d), table(spark, d, "canon_books"), ["HUB007"]).select("path", F.col("expected").cast("int").alias("expected"), F.col("actual").cast("int").alias("actual"))


def validate_run(spark: SparkSession, d: str) -> DataFrame:
    """Hubs without companions, by edition."""
    f = v.run_findings(_files(spark, d), table(spark, d, "canon_books"))
    return f.groupBy(F.split_part("path", F.lit("/"), F.lit(1)).alias("source"), "code").agg(F.count("*").alias("n_findings"))


def note_types(spark: SparkSession, d: str) -> DataFrame:
    """Documents by the type that their opening shows, as study notes."""
    kind = c.study_note_type(F.col("text"))
    return table(spark, d, "documents").select("doc_id", kind.alias("note_type"))


def box_classes(spark: SparkSession, d: str) -> DataFrame:
    """Class of every page box."""
    return boxes(spark, d).select("box_id", c.page_box(F.col("x"), F.col("y_top"), F.col("sz"), F.col("text"), F.col("page_width")).alias("class"))


queries = {f.__name__: f for f in (validate_hubs, anchor_gaps, validate_run, note_types, box_classes)}

_FOLDER = "CASE WHEN testament = 'NT' THEN '02 - New Testament' ELSE '01 - Old Testament' END"
_PATH = f"source || '/' || {_FOLDER} || '/' || lpad(CAST(book_order AS VARCHAR), 2, '0') || ' - ' || n.book || '/Chapter ' || CASE WHEN chapter < 100 THEN lpad(CAST(chapter AS VARCHAR), 2, '0') ELSE CAST(chapter AS VARCHAR) END || '/' || n.book || ' ' || chapter || '.md'"

oracles = {
    "validate_hubs": f"""WITH {_NOW}, h AS (SELECT DISTINCT source, n.book, chapter FROM now n JOIN canon_books b ON n.book = b.book WHERE text <> ''),
g AS (SELECT n.book, verse, coalesce(lag(verse) OVER (PARTITION BY source, n.book, chapter ORDER BY verse, verse_id) + 1, 1) AS want FROM now n JOIN canon_books b ON n.book = b.book WHERE text <> '')
SELECT * FROM (SELECT 'ERROR' AS severity, 'HUB001' AS code, count(*) AS n_findings FROM h UNION ALL SELECT 'WARN', 'HUB007', count(*) FROM g WHERE verse <> want) WHERE n_findings > 0""",
    "anchor_gaps": f"""WITH {_NOW}, g AS (SELECT source, book, chapter, verse, verse_id, coalesce(lag(verse) OVER (PARTITION BY source, book, chapter ORDER BY verse, verse_id) + 1, 1) AS want FROM now WHERE text <> '')
SELECT {_PATH} AS path, want AS expected, verse AS actual FROM g n JOIN canon_books b ON n.book = b.book WHERE verse <> want""",
    "validate_run": f"WITH {_NOW}, h AS (SELECT DISTINCT source, n.book, chapter FROM now n JOIN canon_books b ON n.book = b.book WHERE text <> '') SELECT source, code, count(*) AS n_findings FROM h, (VALUES ('RUN001'), ('RUN003')) r(code) GROUP BY 1, 2",
    "box_classes": r"""SELECT box_id, CASE WHEN text IS NULL THEN 'empty' WHEN sz >= 15 THEN 'verse' WHEN regexp_matches(trim(regexp_replace(text, '\s+', ' ', 'g')), '^(?:Page )?[-\[·]? ?(?:[0-9l]{1,4}|[ivxlc]+) ?[-\]·]?$') AND y_top < 50 THEN 'page_num'
WHEN y_top > 560 THEN 'header' WHEN sz < 6.2 THEN 'superscript' WHEN y_top < 70 AND sz < 8 THEN 'footnote' WHEN sz < 8.8 AND sz >= 8 THEN 'pericope' ELSE 'verse' END AS class FROM (SELECT DISTINCT * FROM page_boxes)""",
    "note_types": r"""WITH b AS (SELECT doc_id, regexp_split_to_array(lower(regexp_replace(text, '^\[\d+\w*\]\s*', '')), '\s+') AS w, ' ' || trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')) || ' ' AS said FROM documents)
SELECT doc_id, CASE """
    + " ".join(f"WHEN {c.opening_sql('w', openings)}" + (f" OR regexp_matches(said, ' was (a|an|the) ({'|'.join(c.PLACES)}) ')" if label == "background_note" else "") + f" THEN '{label}'" for label, openings in c.STUDY_OPENINGS)
    + " ELSE 'footnote' END AS note_type FROM b",
}
