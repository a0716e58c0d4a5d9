"""Queries of the constraint engine over a tree of files with one known fault each, made from the canon.

Every chapter of the canon gets a hub and notes; which fault a file has follows from its book's and chapter's numbers, so the SQL says
what must be found without reading a file. Chapters whose number ends the count of eleven have no hub, those that end the count of seven no notes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.canon import chapter_path
from ..functions.session import table
from ..operators import validation as v
from .render import _canon, verse_line

#: Faults of hubs by number; 0 and those beyond have none.
HUB_FAULTS, NOTE_FAULTS = 14, 9


def _chapters(spark: SparkSession, d: str) -> DataFrame:
    c = _canon(spark, d).select("*", F.explode(F.sequence(F.lit(1), F.col("chapter_count"))).alias("chapter"))
    return c.withColumns({"m": (F.col("book_order") + F.col("chapter")) % HUB_FAULTS, "n": (F.col("book_order") * 3 + F.col("chapter")) % NOTE_FAULTS})


def _path(suffix: Column | None = None) -> Column:
    folder = F.when((F.col("m") == 4) & F.lit(suffix is None), F.when(F.col("testament") == "NT", "01 - Old Testament").otherwise("02 - New Testament")).otherwise(F.col("folder"))
    order = F.when((F.col("m") == 5) & F.lit(suffix is None), F.col("book_order") % 40 + 57).otherwise(F.col("book_order"))
    return chapter_path(folder, order, F.col("book"), t.file_prefix(F.col("book")), F.col("chapter"), *([] if suffix is None else [suffix]))


def faulty_hubs(spark: SparkSession, d: str) -> DataFrame:
    """(path, text): the hubs of the canon's chapters, each with its fault."""
    c = _chapters(spark, d).filter("chapter % 11 <> 10")
    m = F.col("m")
    link = lambda n: F.concat(F.lit("[["), F.col("book"), F.lit(" "), n.cast("string"), F.lit("]]"))
    fields = {
        "testament": F.when((m == 10) & (F.col("testament") != "NT"), "Deuterocanon").otherwise(F.col("testament")),
        "genre": F.when(m != 13, F.col("genre")),
        "book_id": F.col("abbreviation"),
        "aliases": F.when(m == 2, F.lit("one, two")).otherwise(F.lit("[one, two]")),
        "up": F.col("book"),
        "prev": F.when((F.col("chapter") > 1) | (F.col("book_order") % 2 == 0), link(F.col("chapter") - 1)).otherwise(F.lit("")),
        "next": F.when(F.col("chapter") < F.col("chapter_count"), link(F.col("chapter") + 1)).otherwise(F.lit("")),
        "mt_ref": F.when(m == 3, F.lit("3")),
    }
    text = F.lit("The lamp stood there.")
    verse = lambda n: verse_line(F.lit(n), text)
    second = F.when(m == 8, F.lit("###### v2\n")).when(m == 11, F.lit("###### v2\nThe lamp stood there.")).when(m == 12, F.lit('###### v2\n<span class="vn">2</span> The lamp stood there. ^v9')).when(m != 7, verse(2))
    body = F.concat_ws("\n\n", verse(1), second, verse(3), F.when(m == 6, F.lit("###### verse 4\nThe lamp stood there.")))
    return c.select(_path().alias("path"), F.concat_ws("\n\n", F.when(m != 1, t.front_matter(fields)), body).alias("text"))


def faulty_notes(spark: SparkSession, d: str) -> DataFrame:
    """(path, text): notes beside the hubs, each with its fault, and texts beside some chapters without notes."""
    c = _chapters(spark, d)
    n, place = F.col("n"), F.concat(t.file_prefix(F.col("book")), F.lit(" "), F.col("chapter").cast("string"))
    link = lambda anchor, shown: F.concat(F.lit("[["), place, F.lit(f"#v{anchor}|"), F.col("book"), F.lit(" "), F.col("chapter").cast("string"), F.lit(f":{shown}]]"))
    head = lambda anchor: F.concat(F.lit("### "), link(anchor, anchor))
    lines = F.concat_ws(
        "\n",
        F.when(n != 1, t.front_matter({"hub": place, "source": F.lit("S")})),
        F.when(n == 8, head(3)).otherwise(head(1)),
        F.concat(F.lit("See "), F.when(n == 3, link(9, 9)).when(n == 4, link(1, "5-3")).when(n == 7, F.lit("[[]]")).otherwise(link(3, 3)), F.lit(".")),
        F.when(n == 8, head(1)).when(n == 5, head(8)).when(n == 6, head(1)).otherwise(head(3)),
    )
    notes = c.filter("chapter % 7 <> 6").select(_path(F.lit("S Notes")).alias("path"), lines.alias("text"))
    return notes.unionByName(c.filter("chapter % 14 = 6").select(_path(F.lit("S")).alias("path"), F.lit("---\nhub: x\nsource: S\n---\n").alias("text")))


def _codes(findings: DataFrame) -> DataFrame:
    return findings.select("severity", "code", "path")


def rule_hubs(spark: SparkSession, d: str) -> DataFrame:
    """Findings of HUB001-HUB012 over hubs with known faults."""
    return _codes(v.hub_findings(faulty_hubs(spark, d), table(spark, d, "canon_books")))


def rule_notes(spark: SparkSession, d: str) -> DataFrame:
    """Findings of CMP001-CMP008 over notes with known faults, and the hubs they rest on."""
    return _codes(v.companion_findings(faulty_hubs(spark, d).unionByName(faulty_notes(spark, d))))


def rule_runs(spark: SparkSession, d: str) -> DataFrame:
    """Findings of RUN001-RUN003 over the whole tree."""
    return _codes(v.run_findings(faulty_hubs(spark, d).unionByName(faulty_notes(spark, d)), table(spark, d, "canon_books"), full=True))


def rule_verdict(spark: SparkSession, d: str) -> DataFrame:
    """Counts by severity over the whole tree, and the verdict."""
    files = faulty_hubs(spark, d).unionByName(faulty_notes(spark, d))
    canon = table(spark, d, "canon_books")
    return v.verdict(v.hub_findings(files, canon).unionByName(v.companion_findings(files)).unionByName(v.run_findings(files, canon, full=True)))


queries = {f.__name__: f for f in (rule_hubs, rule_notes, rule_runs, rule_verdict)}

_NAME = "'/Chapter ' || CASE WHEN ch < 100 THEN lpad(CAST(ch AS VARCHAR), 2, '0') ELSE CAST(ch AS VARCHAR) END || '/' || CASE WHEN book = 'Psalms' THEN 'Psalm' ELSE book END || ' ' || ch"
_TREE = f"""WITH c AS (SELECT book, testament, book_order, chapter_count, CAST(unnest(range(1, chapter_count + 1)) AS INTEGER) AS ch FROM canon_books),
g AS (SELECT *, mod(book_order + ch, {HUB_FAULTS}) AS m, mod(book_order * 3 + ch, {NOTE_FAULTS}) AS n, ch % 11 <> 10 AS has_hub, testament = 'NT' AS nt FROM c),
f AS (SELECT *, CASE WHEN (m = 4) = nt THEN '01 - Old Testament' ELSE '02 - New Testament' END || '/' || lpad(CAST(CASE WHEN m = 5 THEN book_order % 40 + 57 ELSE book_order END AS VARCHAR), 2, '0') || ' - ' || book || {_NAME} || '.md' AS hub,
  CASE WHEN nt THEN '02 - New Testament' ELSE '01 - Old Testament' END || '/' || lpad(CAST(book_order AS VARCHAR), 2, '0') || ' - ' || book || {_NAME} || ' — S Notes.md' AS notes FROM g)
"""
_HUBS = """SELECT 'ERROR' AS severity, 'HUB001' AS code, hub AS path FROM f WHERE has_hub AND m IN (1, 13)
UNION ALL SELECT 'ERROR', 'HUB002', hub FROM f WHERE has_hub AND m = 2
UNION ALL SELECT 'ERROR', 'HUB003', hub FROM f WHERE has_hub AND m = 3 AND book <> 'Psalms'
UNION ALL SELECT 'ERROR', 'HUB004', hub FROM f WHERE has_hub AND m = 4
UNION ALL SELECT 'ERROR', 'HUB005', hub FROM f WHERE has_hub AND m = 5
UNION ALL SELECT 'ERROR', 'HUB006', hub FROM f WHERE has_hub AND m = 6
UNION ALL SELECT 'WARN', 'HUB007', hub FROM f WHERE has_hub AND m = 7
UNION ALL SELECT 'ERROR', 'HUB008', hub FROM f WHERE has_hub AND m = 8
UNION ALL SELECT 'WARN', 'HUB009', hub FROM f WHERE has_hub AND m <> 1 AND ch = 1 AND book_order % 2 = 0
UNION ALL SELECT 'ERROR', 'HUB010', hub FROM f WHERE has_hub AND m = 10 AND testament NOT IN ('NT', 'Deuterocanon')
UNION ALL SELECT 'ERROR', 'HUB011', hub FROM f WHERE has_hub AND m = 11
UNION ALL SELECT 'ERROR', 'HUB012', hub FROM f WHERE has_hub AND m = 12"""
_NOTES = """SELECT 'ERROR' AS severity, 'CMP001' AS code, notes AS path FROM f WHERE ch % 7 <> 6 AND n = 1
UNION ALL SELECT 'WARN', 'CMP002', notes FROM f WHERE ch % 7 <> 6 AND n <> 1 AND NOT has_hub
UNION ALL SELECT 'WARN', 'CMP003', notes FROM f WHERE ch % 7 <> 6 AND n IN (3, 5) AND has_hub
UNION ALL SELECT 'WARN', 'CMP004', notes FROM f WHERE ch % 7 <> 6 AND n = 4
UNION ALL SELECT 'WARN', 'CMP005', notes FROM f WHERE ch % 7 <> 6 AND n = 5 AND has_hub
UNION ALL SELECT 'WARN', 'CMP006', notes FROM f WHERE ch % 7 <> 6 AND n = 6
UNION ALL SELECT 'WARN', 'CMP007', notes FROM f WHERE ch % 7 <> 6 AND n = 7
UNION ALL SELECT 'ERROR', 'CMP008', notes FROM f WHERE ch % 7 <> 6 AND n = 8"""
_RUNS = """SELECT 'WARN' AS severity, 'RUN001' AS code, hub AS path FROM f WHERE has_hub AND ch % 7 = 6 AND ch % 14 <> 6
UNION ALL SELECT 'WARN', 'RUN003', hub FROM f WHERE has_hub AND ch % 7 = 6
UNION ALL SELECT 'ERROR', 'RUN002', book || ' ' || ch FROM f WHERE NOT has_hub"""

oracles = {
    "rule_hubs": _TREE + _HUBS,
    "rule_notes": _TREE + _NOTES,
    "rule_runs": _TREE + _RUNS,
    "rule_verdict": _TREE + f"SELECT count_if(severity = 'ERROR') AS n_errors, count_if(severity = 'WARN') AS n_warnings, CAST(0 AS BIGINT) AS n_infos, CASE WHEN count_if(severity = 'ERROR') > 0 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM ({_HUBS} UNION ALL {_NOTES} UNION ALL {_RUNS})",
}
