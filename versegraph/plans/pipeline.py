"""Jobs: an edition's verses to hubs, companions, parallels and fathers as files, with counters, and their check.

A job isolates bad input: rows that cannot be rendered are counted as errors with their reason, the rest is written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.canon import canon, chapter_path
from ..operators import validation
from ..operators.ordered import ordered_text
from ..operators.relational import in_scope
from ..sources.sink import write_files
from .render import verse_line


@dataclass
class Job:
    """What to build and where: a sample restricts to (book, chapter) pairs."""

    root: str
    source: str
    sample: DataFrame | None = None
    hub: bool = True


def _known(spark: SparkSession, verses: DataFrame, job: Job) -> tuple[DataFrame, DataFrame]:
    """Verses of canonical books in scope, and the others as errors."""
    v = verses.filter("text is not null and text <> ''")
    if job.sample is not None:
        v = in_scope(v, job.sample, ["book", "chapter"])
    known = v.join(F.broadcast(canon(spark)), "book", "left")
    return known.filter("folder is not null and chapter is not null and verse is not null"), known.filter("folder is null or chapter is null or verse is null").select("book", "chapter", F.when(F.col("folder").isNull(), "unknown book").otherwise("no chapter or verse").alias("reason"))


def pages(spark: SparkSession, verses: DataFrame, job: Job) -> tuple[DataFrame, DataFrame]:
    """(rel_path, content) of the hub or text companion of every chapter, and errors. verses: book, chapter, verse, text."""
    known, errors = _known(spark, verses, job)
    lines = known.withColumn("line", verse_line(F.col("verse"), t.collapsed(F.col("text"))))
    group = ["book", "chapter", "folder", "book_order", "testament", "genre", "abbreviation", "chapter_count"]
    body = ordered_text(lines, group, ["verse"], "line", "\n\n", "body")
    prefix = t.file_prefix(F.col("book"))
    link = lambda n: F.concat(prefix, F.lit(" "), n.cast("string"))
    psalm = F.col("book") == "Psalms"
    stasis = t.kathisma(F.col("chapter"))
    head = t.front_matter(
        {
            "testament": F.col("testament"),
            "genre": F.col("genre"),
            "book_id": F.col("book"),
            "aliases": F.concat(F.lit("["), F.col("abbreviation"), F.lit(" "), F.col("chapter").cast("string"), F.lit("]")),
            "up": F.col("book"),
            "prev": F.when(F.col("chapter") > 1, link(F.col("chapter") - 1)).otherwise(""),
            "next": F.when(F.col("chapter") < F.col("chapter_count"), link(F.col("chapter") + 1)).otherwise(""),
            "lxx_ref": F.when(psalm, F.col("chapter")),
            "mt_ref": F.when(psalm, t.psalm_in_mt(F.col("chapter"))),
            "kathisma": F.when(psalm, stasis["kathisma"]),
            "stasis": F.when(psalm & (stasis["stasis"] > 0), stasis["stasis"]),
        }
        if job.hub
        else {"hub": link(F.col("chapter")), "source": F.lit(job.source)}
    )
    suffix = None if job.hub else F.lit(job.source)
    path = chapter_path(F.col("folder"), F.col("book_order"), F.col("book"), prefix, F.col("chapter"), suffix)
    return body.select(path.alias("rel_path"), F.concat(head, F.lit("\n\n"), F.col("body"), F.lit("\n")).alias("content")), errors


def note_pages(spark: SparkSession, notes: DataFrame, job: Job) -> DataFrame:
    """(rel_path, content) of a notes companion for every chapter. notes: book, chapter, verse, note_type, content, ins; verse 0 is the introduction."""
    n = notes if job.sample is None else in_scope(notes, job.sample, ["book", "chapter"])
    n = n.join(F.broadcast(canon(spark)), "book").filter("chapter <= chapter_count")
    prefix = t.file_prefix(F.col("book"))
    entry = n.withColumn("entry", t.quoted_block(F.concat(F.lit("[!"), F.col("note_type"), F.lit("]\n"), F.col("content"))))
    group = ["book", "chapter", "folder", "book_order"]
    per_verse = ordered_text(entry, [*group, "verse"], ["note_type", "ins"], "entry", "\n\n", "block")
    ref = F.concat(prefix, F.lit(" "), F.col("chapter").cast("string"))
    heading = F.when(F.col("verse") == 0, "### Introduction").otherwise(F.concat(F.lit("### [["), ref, F.lit("#v"), F.col("verse").cast("string"), F.lit("|"), F.col("chapter").cast("string"), F.lit(":"), F.col("verse").cast("string"), F.lit("]]")))
    body = ordered_text(per_verse.withColumn("block", F.concat(heading, F.lit("\n\n"), F.col("block"))), group, ["verse"], "block", "\n\n", "body")
    head = t.front_matter({"hub": ref, "source": F.lit(job.source)})
    path = chapter_path(F.col("folder"), F.col("book_order"), F.col("book"), prefix, F.col("chapter"), F.lit(f"{job.source} Notes"))
    return body.select(path.alias("rel_path"), F.concat(head, F.lit("\n\n"), F.col("body"), F.lit("\n")).alias("content"))


def father_pages(spark: SparkSession, excerpts: DataFrame, job: Job) -> DataFrame:
    """(rel_path, content) of a catena for every chapter. excerpts: book, chapter, father, work, verse_start, content, ins."""
    e = excerpts if job.sample is None else in_scope(excerpts, job.sample, ["book", "chapter"])
    e = e.join(F.broadcast(canon(spark)), "book")
    prefix = t.file_prefix(F.col("book"))
    ref = F.concat(prefix, F.lit(" "), F.col("chapter").cast("string"))
    block = F.concat(F.lit("### [["), ref, F.lit("#v"), F.col("verse_start").cast("string"), F.lit("|"), F.col("chapter").cast("string"), F.lit(":"), F.col("verse_start").cast("string"), F.lit("]] — "), F.col("father"), F.lit("\n\n"), F.col("content"), F.lit("\n\n*"), F.col("work"), F.lit("*"))
    body = ordered_text(e.withColumn("block", block), ["book", "chapter", "folder", "book_order"], ["verse_start", "ins"], "block", "\n\n", "body")
    path = chapter_path(F.col("folder"), F.col("book_order"), F.col("book"), prefix, F.col("chapter"), F.lit("Fathers"))
    return body.select(path.alias("rel_path"), F.concat(t.front_matter({"hub": ref, "source": F.lit(job.source)}), F.lit("\n\n"), F.col("body"), F.lit("\n")).alias("content"))


def run(spark: SparkSession, files: DataFrame, errors: DataFrame | None, job: Job) -> dict[str, int]:
    """Writes files and returns counters: files as the sink counted them."""
    return {"files": write_files(files, job.root), "errors": 0 if errors is None else errors.distinct().count()}


def check(spark: SparkSession, files: DataFrame, full: bool = False) -> DataFrame:
    """Findings of all rules over (path, text) files."""
    books = canon(spark)
    return validation.hub_findings(files, books).unionByName(validation.companion_findings(files)).unionByName(validation.run_findings(files, books, full))
