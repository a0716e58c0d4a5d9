"""Queries of the order-dependent operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.session import small, table
from ..operators import ordered as o
from ..operators.relational import FEW

CHAPTER = ["source", "book", "chapter"]


def verses_now(spark: SparkSession, d: str) -> DataFrame:
    """The last delivery of each verse; all deliveries of a verse have one text."""
    rows = table(spark, d, "verses").groupBy("verse_id", "source", "book", "chapter", "verse").agg(F.max("text").alias("text"))
    return rows


_NOW = "now AS (SELECT verse_id, source, book, chapter, verse, max(text) AS text FROM verses GROUP BY ALL)"


def boxes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_boxes").distinct()


_BOXES = "boxes AS (SELECT DISTINCT * FROM page_boxes)"
NUMBER = r"^\s*(\d{1,3})(?:  |$)"


def forward_fill(spark: SparkSession, d: str) -> DataFrame:
    """The verse that each box of a page belongs to: the last verse number in reading order."""
    b = boxes(spark, d).withColumn("number", F.regexp_extract("text", NUMBER, 1).try_cast("int"))
    marked = (F.col("y_top") > 60) & F.col("number").isNotNull()
    return o.forward_fill(b, ["source", "page"], ["box_id"], marked, F.col("number"), "verse").select("box_id", "verse")


def islands(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of a user's events, cut before each ``click``-like first type by a boundary event."""
    e = table(spark, d, "events")
    return o.islands(e, ["user_id"], ["ts", "event_id"], F.col("event_type") == "purchase", "island", inclusive=False).groupBy("user_id", "island").agg(F.count("*").alias("n_events"), F.max("value").alias("top_value"))


def monotonic_cursor(spark: SparkSession, d: str) -> DataFrame:
    """Line items whose (part, supplier) key goes back in their order."""
    l = table(spark, d, "lineitem")  # noqa: E741
    out = o.monotonic_cursor(l, ["l_orderkey"], ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber"], ["l_partkey", "l_suppkey"], "forward")
    return out.groupBy("l_orderkey").agg(F.count_if("forward").alias("n_forward"), F.count_if(~F.col("forward")).alias("n_back"))


def gap_check(spark: SparkSession, d: str) -> DataFrame:
    """Verse numbers that a chapter skips or does not start with."""
    return o.gaps(table(spark, d, "verses").filter("deleted_at is null"), CHAPTER, "verse")


def order_check(spark: SparkSession, d: str) -> DataFrame:
    """Boxes whose verse number is under that of the box before it in its page."""
    b = boxes(spark, d).withColumn("number", F.regexp_extract("text", NUMBER, 1).try_cast("int")).filter("number is not null and y_top > 60")
    return o.out_of_order(b, ["source", "page"], ["box_id"], "number").select("box_id", "number", "previous")


def repeated_headings(spark: SparkSession, d: str) -> DataFrame:
    """Running headers of an edition that an earlier page has too: every repeat after the first."""
    b = boxes(spark, d).filter("y_top > 570 and text is not null").select("source", "text", "page", "box_id")
    return o.repeats(b, ["source", "text"], ["page", "box_id"])


def dedup_first(spark: SparkSession, d: str) -> DataFrame:
    """The first finding of each path, line and code."""
    f = table(spark, d, "findings").select("finding_id", "path", "line", "code", "found_at").distinct()
    return o.first_of(f, ["path", "line", "code"], ["found_at", "finding_id"]).select("finding_id")


def chapter_links(spark: SparkSession, d: str) -> DataFrame:
    """Chapters before and after each chapter of a canonical book, by the canon's count: a gap in an edition still links."""
    c = table(spark, d, "chapters").filter("book is not null").select("source", "book", "number").distinct()
    return o.neighbours(c.join(small(table(spark, d, "canon_books").select("book", "chapter_count"), FEW), "book"), "number", "chapter_count").select("source", "book", "number", "previous", "following")


def ordered_concat(spark: SparkSession, d: str) -> DataFrame:
    """The running text of every chapter; a chapter has at most some hundred verses."""
    v = verses_now(spark, d).filter("text is not null and text <> ''")
    return o.ordered_text(v, CHAPTER, ["verse", "verse_id"], "text", " ", "chapter_text")


def dropcap_concat(spark: SparkSession, d: str) -> DataFrame:
    """Page text in reading order, where a single capital joins the next part without a space."""
    b = boxes(spark, d).filter("text is not null and y_top > 60 and y_top < 570")
    from pyspark.sql import Window

    before = F.lag("text").over(Window.partitionBy("source", "page").orderBy("box_id"))
    b = b.withColumn("sep", F.when(before.rlike("^[0-9]{1,3}$"), F.lit("")).otherwise(F.lit(" ")))
    return o.ordered_text(b, ["source", "page"], ["box_id"], "text", F.col("sep"), "page_text")


def merge_split_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Line numbers followed by a one on the same date read as one number."""
    l = table(spark, d, "lineitem").select("l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")  # noqa: E741
    from pyspark.sql import Window

    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    nxt = F.lead("l_linenumber").over(Window.partitionBy("l_orderkey").orderBy(*order))
    joins = (F.col("l_linenumber") == 1) & (nxt == 2)
    return o.merged_splits(l, ["l_orderkey"], order, "l_linenumber", joins, "number").groupBy("l_orderkey").agg(F.count("*").alias("n_numbers"), F.sum("number").alias("sum_numbers"))


def two_column_order(spark: SparkSession, d: str) -> DataFrame:
    """Reading order of the boxes of every page."""
    return o.reading_order(boxes(spark, d), ["source", "page"], "x", "y_top", F.col("page_width"), ["box_id"], "place").select("box_id", "place")


def sequential_fold(spark: SparkSession, d: str) -> DataFrame:
    """Verse numbers that a reader of the page accepts: increasing, in steps of at most 25, at most 176."""
    b = boxes(spark, d).filter("y_top > 60").withColumn("number", F.regexp_extract("text", NUMBER, 1).try_cast("int"))
    out = o.plausible(b, ["source", "page"], ["box_id"], "number", 176, 25, "numbers")
    return out.select("source", "page", F.array_join(F.col("numbers").cast("array<string>"), ",").alias("numbers"))


def anchored_titles(spark: SparkSession, d: str) -> DataFrame:
    """Pericope titles attached to the first verse of their chapter that is there."""
    c = table(spark, d, "chapters").filter("pericope is not null and book is not null").groupBy("source", "book", "number").agg(F.min_by("pericope", "chapter_id").alias("pericope"))
    v = table(spark, d, "verses").groupBy("source", "book", F.col("chapter").alias("number")).agg(F.min("verse").alias("verse"))
    return c.join(v, ["source", "book", "number"]).select("source", "book", "number", "verse", "pericope")


queries = {f.__name__: f for f in (forward_fill, islands, monotonic_cursor, gap_check, order_check, repeated_headings, dedup_first, chapter_links, ordered_concat, dropcap_concat, merge_split_numbers, two_column_order, sequential_fold, anchored_titles)}

_NUM = r"TRY_CAST(regexp_extract(text, '^\s*(\d{1,3})(?:  |$)', 1) AS INTEGER)"

oracles = {
    "forward_fill": f"WITH {_BOXES}, m AS (SELECT *, CASE WHEN y_top > 60 THEN {_NUM} END AS number FROM boxes) SELECT box_id, last_value(number IGNORE NULLS) OVER (PARTITION BY source, page ORDER BY box_id) AS verse FROM m",
    "islands": """WITH i AS (SELECT *, CAST(coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS island FROM events)
SELECT user_id, island, count(*) AS n_events, max(value) AS top_value FROM i GROUP BY 1, 2""",
    "monotonic_cursor": """WITH m AS (SELECT l_orderkey, l_partkey, l_suppkey, max({'a': l_partkey, 'b': l_suppkey}) OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM lineitem)
SELECT l_orderkey, count(*) FILTER (b IS NULL OR {'a': l_partkey, 'b': l_suppkey} >= b) AS n_forward, count(*) FILTER (NOT (b IS NULL OR {'a': l_partkey, 'b': l_suppkey} >= b)) AS n_back FROM m GROUP BY 1""",
    "gap_check": """WITH v AS (SELECT DISTINCT source, book, chapter, verse FROM verses WHERE deleted_at IS NULL AND verse IS NOT NULL),
g AS (SELECT *, CAST(coalesce(lag(verse) OVER (PARTITION BY source, book, chapter ORDER BY verse) + 1, 1) AS INTEGER) AS expected FROM v) SELECT * FROM g WHERE verse <> expected""",
    "order_check": f"WITH {_BOXES}, m AS (SELECT *, {_NUM} AS number FROM boxes WHERE y_top > 60), l AS (SELECT box_id, number, lag(number) OVER (PARTITION BY source, page ORDER BY box_id) AS previous FROM m WHERE number IS NOT NULL) SELECT * FROM l WHERE number < previous",
    "repeated_headings": f"WITH {_BOXES} SELECT source, text, page, box_id FROM (SELECT *, row_number() OVER (PARTITION BY source, text ORDER BY page, box_id) AS n FROM boxes WHERE y_top > 570 AND text IS NOT NULL) WHERE n > 1",
    "dedup_first": "SELECT finding_id FROM (SELECT *, row_number() OVER (PARTITION BY path, line, code ORDER BY found_at, finding_id) AS n FROM (SELECT DISTINCT finding_id, path, line, code, found_at FROM findings)) WHERE n = 1",
    "chapter_links": """SELECT DISTINCT source, c.book, number, CASE WHEN number BETWEEN 2 AND chapter_count + 1 THEN number - 1 END AS previous, CASE WHEN number BETWEEN 0 AND chapter_count - 1 THEN number + 1 END AS following FROM chapters c JOIN canon_books b ON b.book = c.book""",
    "ordered_concat": f"WITH {_NOW} SELECT source, book, chapter, string_agg(text, ' ' ORDER BY verse, verse_id) AS chapter_text FROM now WHERE text <> '' GROUP BY 1, 2, 3",
    "dropcap_concat": f"""WITH {_BOXES}, s AS (SELECT *, lag(text) OVER (PARTITION BY source, page ORDER BY box_id) AS b FROM boxes WHERE text IS NOT NULL AND y_top > 60 AND y_top < 570),
j AS (SELECT source, page, box_id, CASE WHEN row_number() OVER (PARTITION BY source, page ORDER BY box_id) = 1 OR coalesce(regexp_matches(b, '^[0-9]{{1,3}}$'), false) THEN '' ELSE ' ' END || text AS t FROM s)
SELECT source, page, string_agg(t, '' ORDER BY box_id) AS page_text FROM j GROUP BY 1, 2""",
    "merge_split_numbers": """WITH f AS (SELECT *, lead(l_linenumber) OVER w AS nx FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)),
m AS (SELECT *, coalesce(l_linenumber = 1 AND nx = 2, false) AS j FROM f),
u AS (SELECT *, coalesce(lag(j) OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice), false) AS used FROM m)
SELECT l_orderkey, count(*) AS n_numbers, CAST(sum(CASE WHEN j THEN l_linenumber * 10 + nx ELSE l_linenumber END) AS BIGINT) AS sum_numbers FROM u WHERE NOT used GROUP BY 1""",
    "two_column_order": f"WITH {_BOXES} SELECT box_id, row_number() OVER (PARTITION BY source, page ORDER BY CASE WHEN x < page_width / 2 THEN 0 ELSE 1 END, y_top DESC, x, box_id) AS place FROM boxes",
    "sequential_fold": f"""WITH {_BOXES}, n AS (SELECT source, page, box_id, {_NUM} AS v FROM boxes WHERE y_top > 60),
l AS (SELECT source, page, list(v ORDER BY box_id) AS vs FROM n WHERE v IS NOT NULL GROUP BY 1, 2),
f AS (SELECT source, page, list_reduce(list_prepend([]::INTEGER[], list_transform(vs, lambda x: [x])), lambda a, x: CASE WHEN x[1] > coalesce(a[-1], 0) AND x[1] <= coalesce(a[-1], 0) + 25 AND x[1] <= 176 THEN list_concat(a, x) ELSE a END) AS r FROM l)
SELECT source, page, array_to_string(r, ',') AS numbers FROM f""",
    "anchored_titles": """WITH c AS (SELECT source, book, number, min_by(pericope, chapter_id) AS pericope FROM chapters WHERE pericope IS NOT NULL AND book IS NOT NULL GROUP BY 1, 2, 3),
v AS (SELECT source, book, chapter AS number, min(verse) AS verse FROM verses GROUP BY 1, 2, 3) SELECT source, book, number, verse, pericope FROM c JOIN v USING (source, book, number)""",
}
