"""Tables on disk: tab- and comma-separated texts, wide reading tables, YAML lists, Markdown trees, scanned text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify, text as t
from ..operators.relational import FEW
from ..functions.session import small


def tagged_tsv(spark: SparkSession, path: str, books: DataFrame) -> DataFrame:
    """Headerless rows (book id, chapter, verse, tagged text); rows with a bad number, an unknown id, verse 0 or no text are dropped, the last of repeated verses wins. books: book_id, book (small)."""
    raw = spark.read.text(path, wholetext=False).select(F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("at"), F.split("value", "\t").alias("p")).filter(F.size("p") >= 4)
    rows = raw.select("f", "at", F.col("p")[0].try_cast("int").alias("book_id"), F.col("p")[1].try_cast("int").alias("chapter"), F.col("p")[2].try_cast("int").alias("verse"), t.stripped_tags(F.col("p")[3]).alias("text"))
    kept = rows.filter("book_id is not null and chapter is not null and verse > 0 and text <> ''").join(small(books, FEW), "book_id")
    return kept.groupBy("book", "chapter", "verse").agg(F.max_by("text", F.struct("f", "at")).alias("text"))


def verse_csv(spark: SparkSession, path: str) -> DataFrame:
    """Files ``Book.csv`` with columns chapter, verse, text; a leading pilcrow is stripped, short rows are dropped."""
    rows = spark.read.csv(path, header=True, schema="chapter string, verse string, text string", mode="PERMISSIVE").select("*", F.col("_metadata.file_name").alias("file"))
    book = F.regexp_replace(F.regexp_replace("file", r"\.csv$", ""), "%20|_", " ")
    out = rows.select(book.alias("book"), F.col("chapter").try_cast("int").alias("chapter"), F.col("verse").try_cast("int").alias("verse"), F.trim(F.regexp_replace("text", r"^\s*¶\s*", "")).alias("text"))
    return out.filter("chapter is not null and verse is not null and text <> ''")


BLOCK = "array<struct<book:string,chapter:int,verse_from:int,verse_to:int>>"


def readings(spark: SparkSession, path: str, books: DataFrame) -> DataFrame:
    """Wide reading rows (``topic~key``, Citation, bk1..6, c1..6, vf1..6, vt1..6) with their blocks and links.

    Blocks end at the first empty book; unknown books and bad numbers are skipped; rows without blocks are dropped.
    books: name -> book (small).
    """
    raw = spark.read.csv(path, header=True).withColumn("row", F.monotonically_increasing_id())
    entry = lambda n: F.struct(F.coalesce(F.trim(F.col(f"bk{n}")), F.lit("")).alias("name"), F.lit(n).alias("pos"), *(F.col(f"{c}{n}").try_cast("int").alias(k) for c, k in (("c", "chapter"), ("vf", "verse_from"), ("vt", "verse_to"))))
    wide = F.array(*map(entry, range(1, 7)))
    end = F.array_position(F.transform(wide, lambda e: e["name"] == ""), True)
    kept = F.slice(wide, 1, F.when(end == 0, 6).otherwise(end - 1).cast("int"))
    keys = raw.select("row", F.split_part("topic~key", F.lit("~"), F.lit(1)).alias("key"), F.trim(F.coalesce("Citation", F.lit(""))).alias("citation"), kept.alias("e"))
    blocks = keys.select("row", F.explode("e").alias("b")).select("row", "b.*").join(small(books, FEW), "name").filter("chapter is not null and verse_from is not null and verse_to is not null")
    grouped = blocks.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pos", "book", "chapter", "verse_from", "verse_to"))).alias("s"))
    rows = keys.join(grouped, "row").withColumn("blocks", F.transform("s", lambda b: F.struct(b["book"].alias("book"), b["chapter"].alias("chapter"), b["verse_from"].alias("verse_from"), b["verse_to"].alias("verse_to"))))
    parts = F.split("key", r"\.")
    return rows.select(
        "key",
        F.coalesce(F.try_element_at(parts, F.lit(3)), F.lit("")).alias("cycle"),
        classify.reading_type(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(""))).alias("reading_type"),
        F.slice(parts, 4, 100).alias("date_parts"),
        "citation",
        "blocks",
        visible_link(F.col("blocks")).alias("wikilink"),
        hidden_links(F.col("blocks")).alias("hidden_links"),
    )


def _link(book, chapter, verse, label):
    return F.concat(F.lit("[["), book, F.lit(" "), chapter.cast("string"), F.lit("#v"), verse.cast("string"), F.lit("|"), label, F.lit("]]"))


def visible_link(blocks):
    """One link for one block (with its range), two joined by a dash for more; books are named where they differ."""
    first, last = blocks[0], F.element_at(blocks, -1)
    at = lambda b, v: F.concat(b["chapter"].cast("string"), F.lit(":"), v.cast("string"))
    one = F.when(first["verse_from"] == last["verse_to"], at(first, first["verse_from"])).otherwise(F.concat(at(first, first["verse_from"]), F.lit("-"), last["verse_to"].cast("string")))
    named = lambda b, v: F.when(first["book"] == last["book"], at(b, v)).otherwise(F.concat(b["book"], F.lit(" "), at(b, v)))
    two = F.concat(_link(first["book"], first["chapter"], first["verse_from"], named(first, first["verse_from"])), F.lit("–"), _link(last["book"], last["chapter"], last["verse_to"], named(last, last["verse_to"])))
    return F.when(F.size(blocks) == 1, _link(first["book"], first["chapter"], first["verse_from"], one)).otherwise(two)


def hidden_links(blocks):
    """A link to every verse of the blocks but the very first; ranges that end before they start have none."""
    def numbers(b, i):
        start = b["verse_from"] + F.when(i == 0, 1).otherwise(0)
        ns = F.when(start <= b["verse_to"], F.sequence(start, b["verse_to"])).otherwise(F.array().cast("array<int>"))
        return F.transform(ns, lambda n: F.concat(F.lit("[["), b["book"], F.lit(" "), b["chapter"].cast("string"), F.lit("#v"), n.cast("string"), F.lit("]]")))

    return F.array_join(F.flatten(F.transform(blocks, numbers)), "")


def parallels(spark: SparkSession, path: str) -> DataFrame:
    """Passages of a YAML list of groups: (group_id, title, pos, book, chapter, verse_start, verse_end). The list is curated and small: a driver-side file."""
    import yaml

    with open(path, encoding="utf-8") as f:
        groups = (yaml.safe_load(f) or {}).get("parallels") or []
    rows = [(i, g.get("title"), j, p["book"], p["chapter"], p["verse_start"], p.get("verse_end")) for i, g in enumerate(groups) for j, p in enumerate(g.get("passages") or [])]
    return spark.createDataFrame(rows, "group_id int, title string, pos int, book string, chapter int, verse_start int, verse_end int")


def parallel_notes(passages: DataFrame) -> DataFrame:
    """For each passage of a group of two or more a note that links the others: (book, chapter, verse, title, content)."""
    end = F.when(F.col("verse_end").isNotNull() & (F.col("verse_end") != F.col("verse_start")), F.concat(F.lit("-"), F.col("verse_end").cast("string"))).otherwise("")
    label = F.concat(F.col("book"), F.lit(" "), F.col("chapter").cast("string"), F.lit(":"), F.col("verse_start").cast("string"), end)
    link = F.concat(F.lit("[["), t.file_prefix(F.col("book")), F.lit(" "), F.col("chapter").cast("string"), F.lit("#v"), F.col("verse_start").cast("string"), F.lit("|"), label, F.lit("]]"))
    own = passages.withColumn("link", link)
    groups = own.groupBy("group_id").agg(F.array_sort(F.collect_list(F.struct("pos", "link"))).alias("all")).filter(F.size("all") >= 2)
    others = F.array_join(F.transform(F.filter("all", lambda x: x["pos"] != F.col("pos")), lambda x: x["link"]), "; ")
    return own.join(groups, "group_id").select("book", "chapter", F.col("verse_start").alias("verse"), "title", others.alias("content"))


def registry(spark: SparkSession, path: str) -> DataFrame:
    """The registry of editions (YAML): key, label, path, format, testament, status, notes."""
    import yaml

    with open(path, encoding="utf-8") as f:
        entries = (yaml.safe_load(f) or {}).get("sources") or {}
    names = ["label", "path", "format", "testament", "status", "notes"]
    return spark.createDataFrame([(k, *((v or {}).get(n) for n in names)) for k, v in entries.items()], "key string, " + ", ".join(f"{n} string" for n in names))


def markdown_tree(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of all Markdown files below ``path``, their paths relative to it."""
    root = "file:" + path.rstrip("/") if path.startswith("/") else path.rstrip("/")
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md").select(F.col("_metadata.file_path").alias("p"), F.col("value").alias("text"))
    plain = F.url_decode(F.replace("p", F.lit("+"), F.lit("%2B")))
    return files.select(F.regexp_replace(plain, "^(?:file:/*)?" + "/?" + root.removeprefix("file:").lstrip("/") + "/", "").alias("path"), "text")


def blocks(spark: SparkSession, path: str, source: str) -> DataFrame:
    """(source, path, blk, raw): a scanned text cut at blank lines; form feeds count as blank lines."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), t.plain_marks(F.col("value")).alias("v"))
    rows = whole.select("path", F.posexplode(F.split(F.regexp_replace("v", "\f", "\n\n"), r"\n[ \t]*\n\s*")).alias("blk", "raw"))
    return rows.select(F.lit(source).alias("source"), "path", "blk", F.trim("raw").alias("raw")).filter("raw <> ''")
