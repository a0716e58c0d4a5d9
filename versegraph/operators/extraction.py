"""Books, chapters, verses, notes and excerpts out of event and block tables, by cursors and joins.

A layout says by column expressions which events open a chapter, open a verse, and hold text; the cursor operators do the rest.
Scopes are documents or books, never a whole source. Text before any verse is dropped; repeated verses are joined in order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import anchors, classify, text as t
from ..functions.session import small
from .ordered import forward_fill, islands, ordered_text
from .relational import FEW, overridden, two_step


@dataclass
class Layout:
    """chapter, verse: number that an event opens (else null). text: whether a text event belongs to a verse. drop_cap: whether no space follows the event."""

    chapter: Column
    verse: Column
    text: Column
    scope: tuple[str, ...] = ("source", "path")


def verses(events: DataFrame, layout: Layout, separator: str = " ") -> DataFrame:
    """(scope..., chapter, verse, text). A chapter's opening resets the verse, since both travel as one cursor."""
    order = ["spine_idx", "ev"]
    e = events.withColumns({"__c": layout.chapter, "__v": layout.verse, "__t": layout.text & (F.col("kind") == "text")})
    e = forward_fill(e, layout.scope, order, F.col("__c").isNotNull(), F.col("__c"), "chapter")
    opens = F.col("__c").isNotNull() | F.col("__v").isNotNull()
    e = forward_fill(e, layout.scope, order, opens, F.col("__v"), "verse")
    texts = e.filter(F.col("__t") & F.col("chapter").isNotNull() & F.col("verse").isNotNull()).withColumn("text", t.collapsed(F.col("text"))).filter("text <> ''")
    joined = ordered_text(texts, [*layout.scope, "chapter", "verse"], order, "text", separator, "text")
    return joined.withColumn("text", t.tight_marks(t.collapsed(F.col("text"))))


def in_span(cls: str, tag: str = "span") -> Column:
    return F.exists("ancestors", lambda a: (a["tag"] == tag) & F.array_contains(a["classes"], cls))


def bracket_layout() -> Layout:
    """``<div osisID="Book.C">``, ``<span class="verse">[N]</span>``."""
    number = F.when((F.col("kind") == "text") & in_span("verse"), F.regexp_extract("text", r"(\d+)", 1).try_cast("int"))
    chapter = F.when(F.col("kind") == "open", F.regexp_extract(F.coalesce(F.col("attrs")["osisid"], F.lit("")), r"\.(\d+)$", 1).try_cast("int"))
    return Layout(chapter, number, ~in_span("verse"))


def colon_layout() -> Layout:
    """``<span class="verse">C:V</span>``; a verse opens its chapter too."""
    ref = F.when((F.col("kind") == "text") & in_span("verse"), t.reference(F.col("text")))
    return Layout(ref["chapter"], ref["verse"], ~in_span("verse") & ~F.exists("ancestors", lambda a: a["tag"] == "sup"))


def anchor_layout(classes: list[str]) -> Layout:
    """Ids ``{P}_vchap{C}-{V}``; text only in paragraphs of the given classes."""
    i = F.when(F.col("kind") == "open", F.col("id"))
    part = lambda n: F.regexp_extract(i, r"^[A-Za-z0-9]+_vchap(\d+)-(\d+)$", n).try_cast("int")
    inside = F.exists("ancestors", lambda a: (a["tag"] == "p") & F.arrays_overlap(a["classes"], F.array(*map(F.lit, classes))))
    return Layout(part(1), part(2), inside & ~F.exists("ancestors", lambda a: a["tag"] == "sup"))


def superscript_layout(sup_class: str | None = None) -> Layout:
    """A paragraph that is a plain number opens a chapter at verse 1; ``sup`` numbers open verses."""
    in_sup = in_span(sup_class, "sup") if sup_class else F.exists("ancestors", lambda a: a["tag"] == "sup")
    number = F.regexp_extract(F.trim("text"), r"^(\d{1,3})(?:\(\d+\))?$", 1).try_cast("int")  # of a dual number the first counts
    text = F.col("kind") == "text"
    chapter = F.when(text & ~in_sup & F.exists("ancestors", lambda a: a["tag"] == "p") & number.between(1, 151), number)
    return Layout(chapter, F.when(text & in_sup, number).when(chapter.isNotNull(), F.lit(1)), ~in_sup & chapter.isNull())


def definitions(events: DataFrame, pattern: str) -> DataFrame:
    """(source, anchor_id, content): the text from each element whose id matches to the next one's, without its label."""
    opens = (F.col("kind") == "open") & F.col("id").rlike(pattern)
    e = forward_fill(events, ["source", "path"], ["spine_idx", "ev"], opens, F.col("id"), "anchor_id").filter("kind = 'text' and anchor_id is not null")
    rows = ordered_text(e, ["source", "anchor_id"], ["spine_idx", "ev"], "text", "", "content")
    return rows.withColumn("content", t.collapsed(F.regexp_replace(t.collapsed(F.col("content")), r"^(?:\[?\d+[a-z]?\]?\.?|[a-z]\b)\s+", "")))


def references(events: DataFrame, layout: Layout) -> DataFrame:
    """(scope..., chapter, verse, anchor_id, ev): links to notes at their verse."""
    order = ["spine_idx", "ev"]
    e = events.withColumns({"__c": layout.chapter, "__v": layout.verse})
    e = forward_fill(e, layout.scope, order, F.col("__c").isNotNull(), F.col("__c"), "chapter")
    e = forward_fill(e, layout.scope, order, F.col("__c").isNotNull() | F.col("__v").isNotNull(), F.col("__v"), "verse")
    href = F.coalesce(F.col("attrs")["href"], F.lit(""))
    return e.filter((F.col("kind") == "open") & (F.col("tag") == "a") & href.contains("#") & F.col("verse").isNotNull()).select(*layout.scope, "chapter", "verse", F.regexp_extract(href, "#(.+)$", 1).alias("anchor_id"), "ev")


def notes(refs: DataFrame, defs: DataFrame, kind: Column) -> DataFrame:
    """References with their definitions and types; the first of equal notes at a verse is kept. kind: over ``content``."""
    joined = refs.join(defs, ["source", "anchor_id"]).withColumn("note_type", kind).filter("note_type is not null")
    first = Window.partitionBy("source", "path", "chapter", "verse", "note_type", "content").orderBy("ev")
    return joined.withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n")


def back_linked(notes: DataFrame, files: DataFrame, overrides: DataFrame, canon: DataFrame) -> DataFrame:
    """(note_id, book, chapter, verse, verse_end, content): notes (note_id, href, ref, content) placed by the file they link back to and the reference they begin with.

    The file's book is looked up by its name (files: file, book), then by its name without the number at its end; overrides (note_id, book)
    go first, for books that lie within another's file. Notes without a book, and those on chapters that the canon (book, chapter_count) hasn't, are dropped.
    """
    n = notes.withColumn("__file", F.split_part(F.split_part("href", F.lit("#"), F.lit(1)), F.lit("/"), F.lit(-1)))
    n = overridden(two_step(n, files, "__file", anchors.book_key(F.col("__file")), "file", "book", "book"), overrides, "note_id", "book")
    at = t.reference(t.heading_reference(F.col("ref")))
    n = n.filter("book is not null").withColumns({"chapter": at["chapter"], "verse": at["verse"], "verse_end": at["verse_end"]})
    counts = small(canon.select("book", "chapter_count").distinct(), FEW)
    return n.join(counts, "book").filter("chapter between 1 and chapter_count and verse is not null").select("note_id", "book", "chapter", "verse", "verse_end", "content")


def promoted(notes: DataFrame) -> DataFrame:
    """The notes that name a Father, as excerpts: with father and work."""
    named = notes.withColumn("__who", classify.attributed(F.col("content"), F.col("book"))).filter("__who is not null")
    return named.withColumns({"father": F.col("__who.father"), "work": F.col("__who.work")}).drop("__who")


def referred(notes: DataFrame) -> DataFrame:
    """Notes that name a Father end with a pointer to his excerpts."""
    who = classify.father(F.col("content"))
    return notes.withColumn("content", F.when(who.isNotNull(), F.concat("content", F.lit(" → See Fathers"))).otherwise(F.col("content")))


def catena(blocks: DataFrame, headings: list[str], source_scope: tuple[str, ...] = ("source", "path"), blocked: tuple[str, ...] = ()) -> DataFrame:
    """Excerpts of a scanned anthology: (scope..., book, chapter, father, work, ptype, verse_start, verse_end, content, ins).

    A heading ``BOOK N`` opens a chapter; blocks that start with a number are scripture; a block with ``B#`` closes the
    excerpt; its text runs from its first title in capitals, which no context header (week, feast, service) is. The verse is that of
    ``... on Book C, v, v``, else the last scripture's. From a bibliography's first entry (``B1. ...``) to the next heading nothing is an
    excerpt. headings: names of books; blocked: parts of authors' names in lower case that are left out.
    """
    order = ["blk"]
    b = blocks.withColumn("norm", t.collapsed(t.scan_repaired(F.col("raw"))))
    words = F.split(F.upper("norm"), " ")
    name = F.array_join(F.slice(words, 1, F.size(words) - 1), " ")
    number = F.try_element_at(words, F.lit(-1)).try_cast("int")
    head = F.when(name.isin([h.upper() for h in headings]) & number.between(1, 999), F.struct(F.initcap(F.lower(name)).alias("book"), number.alias("chapter")))
    first = F.try_element_at(F.split("norm", " "), F.lit(1))
    b = b.withColumns({"__head": head, "__cite": F.col("norm").contains("B#"), "__page": F.col("norm").rlike(r"^\d{1,4}$"), "__verse": F.when((F.length(first) <= 3) & (F.size(words) > 1), first.try_cast("int"))})
    b = b.withColumns({"__h": F.col("__head").isNotNull(), "__scripture": F.col("__verse").isNotNull() & ~F.col("__cite"), "__entry": F.col("norm").rlike(r"^[A-Z]\d+\.\s")})
    b = b.withColumn("__title", anchors.title_line(F.col("norm")) & ~F.col("__h"))
    b = forward_fill(b, source_scope, order, F.col("__h"), F.col("__head"), "at")
    b = forward_fill(b, source_scope, order, F.col("__h") | F.col("__scripture"), F.col("__verse"), "scripture_verse")
    b = forward_fill(b, source_scope, order, F.col("__h") | F.col("__entry"), F.col("__entry"), "__listed").filter(~F.coalesce(F.col("__listed"), F.lit(False)))
    b = islands(b.filter("not __page"), source_scope, order, F.col("__h") | F.col("__cite"), "island", inclusive=False)
    titled = Window.partitionBy(*source_scope, "island").orderBy("blk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    b = b.withColumn("__in", F.max(F.col("__title").cast("int")).over(titled) == 1)
    body = ordered_text(b.filter("__in and not __cite and not __h and not __scripture"), [*source_scope, "island"], ["blk"], "raw", "\n\n", "content")
    cites = b.filter("__cite and at.book is not null").withColumn("__who", anchors.attribution(F.col("norm")))
    cites = cites.withColumns({"father": F.col("__who.father"), "work": F.col("__who.work")}).withColumn("__ref", anchors.work_reference(F.col("work")))
    cites = cites.filter(classify.plausible_author(F.col("father")) & ~F.exists(F.array(*map(F.lit, blocked)).cast("array<string>"), lambda x: F.lower("father").contains(x)))
    start, end = (F.coalesce(F.col(f"__ref.{c}"), F.col("scripture_verse")) for c in ("verse_start", "verse_end"))
    out = cites.join(body, [*source_scope, "island"])
    return out.select(*source_scope, F.col("at.book").alias("book"), F.col("at.chapter").alias("chapter"), "father", "work", classify.patristic_type(F.concat_ws(" ", "work", "content")).alias("ptype"), start.alias("verse_start"), end.alias("verse_end"), "content", F.col("blk").alias("ins"))
