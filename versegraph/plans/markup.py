"""Queries of the HTML sources: pages in each layout, made from the verses and citations of the tables, read back through the tokenizer, the layouts' cursors and the joins of notes.

A page is a chapter of an edition, so no page grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.session import table
from ..operators import extraction as x
from ..sources.html import html_events
from .ordered import _NOW, verses_now

CHAPTER = ["source", "book", "chapter"]


def _pages(rows: DataFrame, order: list[str], piece: Column, before: Column, after: Column) -> DataFrame:
    """(source, path, spine_idx, html): the pieces of each chapter in order, between what stands before and after."""
    joined = rows.select(*CHAPTER, F.struct(*order, piece.alias("piece")).alias("r")).groupBy(*CHAPTER).agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["piece"]), "\n").alias("body"))
    return joined.select("source", F.concat_ws("/", "book", F.col("chapter").cast("string")).alias("path"), F.lit(0).alias("spine_idx"), F.concat(before, F.col("body"), after).alias("html"))


def _escaped(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def _read(layout: Callable[[], x.Layout], piece: str, before: str = "", after: str = "") -> Callable[[SparkSession, str], DataFrame]:
    """A query that writes every chapter in a layout and reads its verses back. {c}, {v}, {t}: chapter, verse, text."""

    def filled(pattern: str) -> Column:
        parts = F.split(F.lit(pattern), r"(?=\{[cvt]\})|(?<=\{[cvt]\})")
        values = F.create_map(F.lit("{c}"), F.col("chapter").cast("string"), F.lit("{v}"), F.col("verse").cast("string"), F.lit("{t}"), _escaped(F.col("text"))) if "{v}" in pattern else F.create_map(F.lit("{c}"), F.col("chapter").cast("string"))
        return F.array_join(F.transform(parts, lambda p: F.coalesce(values[p], p)), "")

    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = verses_now(spark, d).filter("text is not null")
        pages = _pages(rows, ["verse", "verse_id"], filled(piece), filled(before), filled(after))
        read = x.verses(html_events(pages), layout())
        return read.select("source", "path", "chapter", "verse", F.md5(F.encode("text", "utf-8")).alias("digest"))

    return run


def html_notes(spark: SparkSession, d: str) -> DataFrame:
    """Citations as notes of a page: links at their verses, definitions on a page of their own, joined by anchor; the first of equal notes at a verse is kept."""
    refs = table(spark, d, "verse_refs").filter("source is not null and book is not null and verse is not null").distinct()
    anchor = F.concat(F.lit("n"), F.col("ref_id").cast("string"))
    link = F.concat(F.lit('<p><span class="verse">'), F.concat_ws(":", F.col("chapter").cast("string"), F.col("verse").cast("string")), F.lit('</span> word <sup><a href="notes#'), anchor, F.lit('">a</a></sup></p>'))
    note = F.concat(F.lit('<p id="'), anchor, F.lit('">12. See the <i>'), F.coalesce("origin", F.lit("place")), F.lit("</i> there.</p>"))
    empty = F.lit("")
    events = html_events(_pages(refs, ["verse", "ref_id"], link, empty, empty))
    defs = x.definitions(html_events(_pages(refs, ["verse", "ref_id"], note, empty, empty)), r"^n\d+$")
    found = x.notes(x.references(events, x.colon_layout()), defs, F.lit("footnote"))
    return found.select("source", "path", "chapter", "verse", "anchor_id", "content")


def html_introductions(spark: SparkSession, d: str) -> DataFrame:
    """What stands before the first verse of each page, and how much of it."""
    from ..functions.anchors import before_first

    rows = verses_now(spark, d).filter("text is not null and text <> ''")
    piece = F.concat(F.lit('<p class="'), F.when(F.col("verse") <= 2, "lead").otherwise("attribute"), F.lit('">'), _escaped(t.collapsed(F.col("text"))), F.lit("</p>"))
    events = html_events(_pages(rows, ["verse", "verse_id"], piece, F.lit(""), F.lit("")))
    lead, _ = before_first(events, (F.col("kind") == "open") & F.array_contains("classes", "attribute"))
    return lead.filter("kind = 'text' and trim(text) <> '' and text <> '\\n'").groupBy("source", "path").agg(F.count("*").alias("n_texts"))


queries = {
    "html_bracket_verses": _read(x.bracket_layout, '<p><span class="verse">[{v}]</span> {t}</p>', '<div type="chapter" osisID="Bk.{c}">', "</div>"),
    "html_colon_verses": _read(x.colon_layout, '<p><span class="verse">{c}:{v}</span> {t}</p>'),
    "html_anchor_verses": _read(lambda: x.anchor_layout(["rindent"]), '<p class="rindent"><a id="Bk_vchap{c}-{v}"></a>{t}</p>'),
    "html_superscript_verses": _read(x.superscript_layout, "<p><sup>{v}</sup> {t}</p>", "<p>{c}</p>"),
    "html_notes": html_notes,
    "html_introductions": html_introductions,
}

_SPACED = r"trim(regexp_replace(text, '[\s\x0b\x{85}\p{Z}]+', ' ', 'g'))"
_VERSES = rf"""WITH {_NOW} SELECT source, book || '/' || chapter AS path, chapter, verse, md5(regexp_replace({_SPACED}, '\s+([,;:.!?])', '\1', 'g')) AS digest FROM now WHERE trim(text) <> '' AND trim({_SPACED}) <> ''"""

oracles = {name: _VERSES for name in ("html_bracket_verses", "html_colon_verses", "html_anchor_verses", "html_superscript_verses")} | {
    "html_notes": "SELECT source, book || '/' || chapter AS path, chapter, verse, 'n' || min(ref_id) AS anchor_id, 'See the ' || coalesce(origin, 'place') || ' there.' AS content FROM verse_refs WHERE source IS NOT NULL AND book IS NOT NULL AND verse IS NOT NULL GROUP BY source, book, chapter, verse, coalesce(origin, 'place')",
    "html_introductions": rf"WITH {_NOW} SELECT source, book || '/' || chapter AS path, count_if(verse <= 2) AS n_texts FROM now WHERE text <> '' AND {_SPACED} <> '' GROUP BY source, book, chapter HAVING count_if(verse <= 2) > 0",
}
