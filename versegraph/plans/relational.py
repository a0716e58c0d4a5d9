"""Queries of lookups, scopes, groups and sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.session import table
from ..operators import relational as r
from .ordered import _NOW, boxes, verses_now


def scope_semi_join(spark: SparkSession, d: str) -> DataFrame:
    """Verses of the chapters that an edition holds."""
    c = table(spark, d, "chapters").select("source", "book", F.col("number").alias("chapter"))
    return r.in_scope(table(spark, d, "verses").select("verse_id", "source", "book", "chapter").distinct(), c, ["source", "book", "chapter"]).select("verse_id")


def canon_range_filter(spark: SparkSession, d: str) -> DataFrame:
    """Citations within the canon: chapters up to the book's count, verses up to 176."""
    canon = F.broadcast(table(spark, d, "canon_books").select("book", "chapter_count"))  # fixed, 56 rows
    refs = table(spark, d, "verse_refs").distinct()
    return refs.join(canon, "book").filter("chapter between 1 and chapter_count and (verse is null or verse between 1 and 176)").select("ref_id", "book", "chapter", "verse")


def missing_expected(spark: SparkSession, d: str) -> DataFrame:
    """Canonical chapters that no edition holds."""
    expected = r.expanded(table(spark, d, "canon_books").select("book", "chapter_count"), F.lit(1), F.col("chapter_count"), "number").select("book", "number")
    return r.missing(expected, table(spark, d, "chapters").filter("book is not null"), ["book", "number"])


def flag_left_join(spark: SparkSession, d: str) -> DataFrame:
    """Chapters with flags: is it cited, has it a pericope."""
    c = table(spark, d, "chapters").filter("book is not null").select("chapter_id", "source", "book", F.col("number").alias("chapter"), F.col("pericope").isNotNull().alias("has_title")).distinct()
    return r.flagged(c, table(spark, d, "verse_refs"), ["source", "book", "chapter"], "is_cited").select("chapter_id", "has_title", "is_cited")


def precedence_pick(spark: SparkSession, d: str) -> DataFrame:
    """The gravest severity of each code."""
    f = table(spark, d, "findings").filter("code is not null")
    return r.preferred(f, ["code"], "severity", ["ERROR", "WARN", "INFO"], "gravest")


def first_match_case(spark: SparkSession, d: str) -> DataFrame:
    """Documents by the first layout that their text shows."""
    t = F.col("text")
    kind = r.first_match(
        [
            (t.rlike(r"^\*\*\d+:\d+\*\*"), "verse_marked"),
            (t.rlike(r"^# "), "titled"),
            (t.rlike(r"(?m)^\|"), "table"),
            (t.rlike(r"(?m)^[-•] "), "list"),
            (t.rlike(r"\(\d? ?[A-Za-z]+ \d+:\d+\)"), "citing"),
        ],
        "plain",
    )
    return table(spark, d, "documents").select("doc_id", kind.alias("kind"))


def range_dimension_join(spark: SparkSession, d: str) -> DataFrame:
    """Orders by price band."""
    bands = spark.createDataFrame([("low", 0.0, 50_000.0), ("middle", 50_000.0, 150_000.0), ("high", 150_000.0, 1e12)], "band string, low double, high double")
    return r.banded(table(spark, d, "orders"), bands, "o_totalprice", "low", "high").groupBy("band").agg(F.count("*").alias("n_orders"))


def fallback_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Citations with the book of their abbreviation, else as typed, else 'unknown'."""
    canon = table(spark, d, "canon_books")
    alias = canon.select(F.lower("abbreviation").alias("alias"), "book").unionByName(canon.select(F.lower("book").alias("alias"), "book"))
    refs = table(spark, d, "verse_refs").select("ref_id", F.lower(F.trim("book")).alias("typed")).distinct()
    return r.looked_up(refs, alias, "typed", "alias", "book", "resolved", F.coalesce("typed", F.lit("unknown"))).select("ref_id", "resolved")


def resolve_refs(spark: SparkSession, d: str) -> DataFrame:
    """Citations with the verse that they name, if it is there."""
    refs = table(spark, d, "verse_refs").filter("verse is not null").select("ref_id", "source", "book", "chapter", "verse").distinct()
    v = table(spark, d, "verses").select("source", "book", "chapter", "verse", "verse_id").distinct()
    return refs.join(v, ["source", "book", "chapter", "verse"], "left").select("ref_id", "verse_id")


def noted_index(spark: SparkSession, d: str) -> DataFrame:
    """Kinds of citation for each cited verse, sorted."""
    refs = table(spark, d, "verse_refs").filter("source is not null and book is not null and verse is not null")
    kinds = F.array_sort(F.collect_set("origin"))
    return refs.groupBy("source", "book", "chapter", "verse").agg(F.array_join(kinds, ",").alias("origins"))


def self_pairs(spark: SparkSession, d: str) -> DataFrame:
    """For each nation the other nations of its region."""
    n = table(spark, d, "nation")
    return r.others_in_group(n, "n_regionkey", "n_name", "others").select("n_name", "others")


def genre_grouping(spark: SparkSession, d: str) -> DataFrame:
    """Books by testament and genre, in canonical order."""
    rows = table(spark, d, "canon_books").groupBy("testament", "genre").agg(F.array_sort(F.collect_list(F.struct("book_order", "book"))).alias("b"))
    return rows.select("testament", "genre", F.array_join(F.transform("b", lambda x: x["book"]), " · ").alias("books"), F.size("b").cast("long").alias("n_books"))


def counters_verdict(spark: SparkSession, d: str) -> DataFrame:
    """Counts by severity and the verdict: FAIL with any error."""
    f = table(spark, d, "findings").distinct()
    counts = f.agg(F.count_if(F.col("severity") == "ERROR").alias("n_errors"), F.count_if(F.col("severity") == "WARN").alias("n_warnings"), F.count_if(F.col("severity") == "INFO").alias("n_infos"))
    return counts.withColumn("verdict", F.when(F.col("n_errors") > 0, "FAIL").otherwise("PASS"))


def findings_by_file(spark: SparkSession, d: str) -> DataFrame:
    """Findings of each file by severity, with the first and last line concerned."""
    f = table(spark, d, "findings").distinct()
    return f.groupBy("path", "severity").agg(F.count("*").alias("n_findings"), F.min("line").alias("first_line"), F.max("line").alias("last_line"))


def class_pivot(spark: SparkSession, d: str) -> DataFrame:
    """Boxes of each page by class."""
    t, sz, y = F.col("text"), F.col("sz"), F.col("y_top")
    kind = r.first_match(
        [(t.isNull(), "empty"), (y > 570, "header"), ((y < 50) & (sz < 9), "page_num"), ((y < 70) & (sz < 8), "note"), (t.rlike(r"^\d{1,3}$"), "verse"), ((sz < 9) & (sz >= 8), "pericope")],
        "body",
    )
    classes = ["empty", "header", "page_num", "note", "verse", "pericope", "body"]
    return boxes(spark, d).withColumn("class", kind).groupBy("source", "page").agg(*(F.count_if(F.col("class") == c).alias(f"n_{c}") for c in classes))


def line_box_stats(spark: SparkSession, d: str) -> DataFrame:
    """Mean size and extent of the boxes of each page."""
    return boxes(spark, d).groupBy("source", "page").agg(F.round(F.avg("sz"), 6).alias("mean_size"), F.min("x").alias("left_edge"), F.max("y_top").alias("top_edge"), F.min("y_bot").alias("foot_edge"))


def max_chapter(spark: SparkSession, d: str) -> DataFrame:
    """Highest chapter of each canonical book, 0 without any."""
    have = table(spark, d, "chapters").filter("book is not null").groupBy("book").agg(F.max("number").alias("m"))
    return F.broadcast(table(spark, d, "canon_books").select("book")).join(have, "book", "left").select("book", F.coalesce("m", F.lit(0)).alias("max_chapter"))


def union_passes(spark: SparkSession, d: str) -> DataFrame:
    """All keys that any of three passes names, once."""
    a = table(spark, d, "chapters").select("source", "book")
    b = table(spark, d, "verse_refs").select("source", "book")
    c = table(spark, d, "verses").select("source", "book")
    return a.unionByName(b).unionByName(c).distinct()


def except_canon(spark: SparkSession, d: str) -> DataFrame:
    """Books that are cited or held but not canonical as typed."""
    typed = table(spark, d, "chapters").select("book").union(table(spark, d, "verse_refs").select("book")).filter("book is not null")
    return typed.distinct().join(F.broadcast(table(spark, d, "canon_books").select("book")), "book", "left_anti")


def intersect_keys(spark: SparkSession, d: str) -> DataFrame:
    """Chapters that are both held and cited."""
    held = table(spark, d, "chapters").select("source", "book", "number")
    return held.intersect(table(spark, d, "verse_refs").select("source", "book", F.col("chapter").alias("number")))


def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    """Natural keys of verses that were delivered more than once."""
    v = table(spark, d, "verses")
    return v.groupBy("source", "book", "chapter", "verse").agg(F.count("*").alias("n_rows"), F.count_distinct("verse_id").alias("n_ids")).filter("n_rows > 1")


def wide_to_long(spark: SparkSession, d: str) -> DataFrame:
    """Abbreviation, alternative title and genre of each book as rows, up to the first that is missing."""
    return r.wide_to_long(table(spark, d, "canon_books"), ["book"], [("abbreviation", "book_order"), ("alt_title", "book_order"), ("genre", "chapter_count")], ["name", "number"])


def range_explode(spark: SparkSession, d: str) -> DataFrame:
    """Verses that a citation of a whole chapter stands for, up to the edition's last verse."""
    last = table(spark, d, "verses").groupBy("source", "book", "chapter").agg(F.max("verse").alias("last"))
    refs = table(spark, d, "verse_refs").filter("verse is null").select("ref_id", "source", "book", "chapter").distinct().join(last, ["source", "book", "chapter"])
    return r.expanded(refs, F.lit(1), F.col("last"), "verse").select("ref_id", "verse")


def top_cited(spark: SparkSession, d: str) -> DataFrame:
    """The ten most cited chapters."""
    return table(spark, d, "verse_refs").distinct().filter("book is not null").groupBy("source", "book", "chapter").agg(F.count("*").alias("n_refs")).orderBy(F.desc("n_refs"), "source", "book", "chapter").limit(10)


def pricing_summary(spark: SparkSession, d: str) -> DataFrame:
    """Sums and means of line items by flag and status."""
    l = table(spark, d, "lineitem").filter("l_shipdate <= timestamp_ntz'1998-09-02'")  # noqa: E741
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return l.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(net), 2).alias("sum_net"), F.count("*").alias("n_lines"))


queries = {f.__name__: f for f in (scope_semi_join, canon_range_filter, missing_expected, flag_left_join, precedence_pick, first_match_case, range_dimension_join, fallback_lookup, resolve_refs, noted_index, self_pairs, genre_grouping, counters_verdict, findings_by_file, class_pivot, line_box_stats, max_chapter, union_passes, except_canon, intersect_keys, duplicate_keys, wide_to_long, range_explode, top_cited, pricing_summary)}

oracles = {
    "scope_semi_join": "SELECT DISTINCT verse_id FROM verses v WHERE EXISTS (SELECT 1 FROM chapters c WHERE c.source = v.source AND c.book = v.book AND c.number = v.chapter)",
    "canon_range_filter": "SELECT ref_id, r.book, chapter, verse FROM (SELECT DISTINCT * FROM verse_refs) r JOIN canon_books c ON r.book = c.book WHERE chapter BETWEEN 1 AND chapter_count AND (verse IS NULL OR verse BETWEEN 1 AND 176)",
    "missing_expected": "SELECT book, CAST(n AS INTEGER) AS number FROM (SELECT book, unnest(range(1, chapter_count + 1)) AS n FROM canon_books) e WHERE NOT EXISTS (SELECT 1 FROM chapters c WHERE c.book = e.book AND c.number = e.n)",
    "flag_left_join": "SELECT chapter_id, has_title, EXISTS (SELECT 1 FROM verse_refs r WHERE r.source = c.source AND r.book = c.book AND r.chapter = c.number) AS is_cited FROM (SELECT DISTINCT chapter_id, source, book, number, pericope IS NOT NULL AS has_title FROM chapters WHERE book IS NOT NULL) c",
    "precedence_pick": "SELECT code, min_by(severity, CASE severity WHEN 'ERROR' THEN 1 WHEN 'WARN' THEN 2 WHEN 'INFO' THEN 3 ELSE 4 END) AS gravest FROM findings WHERE code IS NOT NULL AND severity IS NOT NULL GROUP BY 1",
    "first_match_case": r"""SELECT doc_id, CASE WHEN regexp_matches(text, '^\*\*\d+:\d+\*\*') THEN 'verse_marked' WHEN regexp_matches(text, '^# ') THEN 'titled' WHEN regexp_matches(text, '(?m)^\|') THEN 'table'
WHEN regexp_matches(text, '(?m)^[-•] ') THEN 'list' WHEN regexp_matches(text, '\(\d? ?[A-Za-z]+ \d+:\d+\)') THEN 'citing' ELSE 'plain' END AS kind FROM documents""",
    "range_dimension_join": "SELECT CASE WHEN o_totalprice >= 0 AND o_totalprice < 50000 THEN 'low' WHEN o_totalprice >= 50000 AND o_totalprice < 150000 THEN 'middle' WHEN o_totalprice >= 150000 AND o_totalprice < 1e12 THEN 'high' END AS band, count(*) AS n_orders FROM orders GROUP BY 1",
    "fallback_lookup": """WITH a AS (SELECT lower(abbreviation) AS alias, book FROM canon_books UNION SELECT lower(book), book FROM canon_books)
SELECT ref_id, coalesce(a.book, typed, 'unknown') AS resolved FROM (SELECT DISTINCT ref_id, lower(trim(book)) AS typed FROM verse_refs) t LEFT JOIN a ON t.typed = a.alias""",
    "resolve_refs": "SELECT ref_id, verse_id FROM (SELECT DISTINCT ref_id, source, book, chapter, verse FROM verse_refs WHERE verse IS NOT NULL) r LEFT JOIN (SELECT DISTINCT source, book, chapter, verse, verse_id FROM verses) v USING (source, book, chapter, verse)",
    "noted_index": "SELECT source, book, chapter, verse, array_to_string(list_sort(list(DISTINCT origin)), ',') AS origins FROM verse_refs WHERE source IS NOT NULL AND book IS NOT NULL AND verse IS NOT NULL GROUP BY 1, 2, 3, 4",
    "self_pairs": "SELECT a.n_name, coalesce(string_agg(b.n_name, ', ' ORDER BY b.n_name), '') AS others FROM nation a LEFT JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_name <> b.n_name GROUP BY a.n_name",
    "genre_grouping": "SELECT testament, genre, string_agg(book, ' · ' ORDER BY book_order) AS books, count(*) AS n_books FROM canon_books GROUP BY 1, 2",
    "counters_verdict": "SELECT count_if(severity = 'ERROR')::BIGINT AS n_errors, count_if(severity = 'WARN')::BIGINT AS n_warnings, count_if(severity = 'INFO')::BIGINT AS n_infos, CASE WHEN count_if(severity = 'ERROR') > 0 THEN 'FAIL' ELSE 'PASS' END AS verdict FROM (SELECT DISTINCT * FROM findings)",
    "findings_by_file": "SELECT path, severity, count(*) AS n_findings, min(line) AS first_line, max(line) AS last_line FROM (SELECT DISTINCT * FROM findings) GROUP BY 1, 2",
    "class_pivot": r"""WITH b AS (SELECT source, page, CASE WHEN text IS NULL THEN 'empty' WHEN y_top > 570 THEN 'header' WHEN y_top < 50 AND sz < 9 THEN 'page_num' WHEN y_top < 70 AND sz < 8 THEN 'note' WHEN regexp_matches(text, '^\d{1,3}$') THEN 'verse' WHEN sz < 9 AND sz >= 8 THEN 'pericope' ELSE 'body' END AS k FROM (SELECT DISTINCT * FROM page_boxes))
SELECT source, page, count(*) FILTER (k = 'empty') AS n_empty, count(*) FILTER (k = 'header') AS n_header, count(*) FILTER (k = 'page_num') AS n_page_num, count(*) FILTER (k = 'note') AS n_note, count(*) FILTER (k = 'verse') AS n_verse, count(*) FILTER (k = 'pericope') AS n_pericope, count(*) FILTER (k = 'body') AS n_body FROM b GROUP BY 1, 2""",
    "line_box_stats": "SELECT source, page, round(avg(sz), 6) AS mean_size, min(x) AS left_edge, max(y_top) AS top_edge, min(y_bot) AS foot_edge FROM (SELECT DISTINCT * FROM page_boxes) GROUP BY 1, 2",
    "max_chapter": "SELECT b.book, coalesce(max(number), 0) AS max_chapter FROM canon_books b LEFT JOIN chapters c ON b.book = c.book GROUP BY 1",
    "union_passes": "SELECT source, book FROM chapters UNION SELECT source, book FROM verse_refs UNION SELECT source, book FROM verses",
    "except_canon": "(SELECT book FROM chapters WHERE book IS NOT NULL UNION SELECT book FROM verse_refs WHERE book IS NOT NULL) EXCEPT SELECT book FROM canon_books",
    "intersect_keys": "SELECT source, book, number FROM chapters INTERSECT SELECT source, book, chapter FROM verse_refs",
    "duplicate_keys": "SELECT source, book, chapter, verse, count(*) AS n_rows, count(DISTINCT verse_id) AS n_ids FROM verses GROUP BY 1, 2, 3, 4 HAVING count(*) > 1",
    "wide_to_long": """SELECT book, 1 AS pos, abbreviation AS name, book_order AS number FROM canon_books WHERE coalesce(abbreviation, '') <> '' UNION ALL SELECT book, 2, alt_title, book_order FROM canon_books WHERE coalesce(abbreviation, '') <> '' AND coalesce(alt_title, '') <> ''
UNION ALL SELECT book, 3, genre, chapter_count FROM canon_books WHERE coalesce(abbreviation, '') <> '' AND coalesce(alt_title, '') <> '' AND coalesce(genre, '') <> ''""",
    "range_explode": "WITH l AS (SELECT source, book, chapter, max(verse) AS last FROM verses GROUP BY 1, 2, 3) SELECT ref_id, CAST(unnest(range(1, last + 1)) AS INTEGER) AS verse FROM (SELECT DISTINCT ref_id, source, book, chapter FROM verse_refs WHERE verse IS NULL) JOIN l USING (source, book, chapter)",
    "top_cited": "SELECT source, book, chapter, count(*) AS n_refs FROM (SELECT DISTINCT * FROM verse_refs) WHERE book IS NOT NULL GROUP BY 1, 2, 3 ORDER BY n_refs DESC, source NULLS FIRST, book, chapter LIMIT 10",
    "pricing_summary": "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_net, count(*) AS n_lines FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2",
}
