"""Renderers: pure string projections, one output row for each chapter or book."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.canon import chapter_path
from ..functions.session import table
from .ordered import _NOW, verses_now


def _canon(spark: SparkSession, d: str) -> DataFrame:
    """The fixed table of 56 books with folders."""
    c = table(spark, d, "canon_books")
    return F.broadcast(c.select("book", "abbreviation", "testament", "genre", "book_order", "chapter_count", F.when(F.col("testament") == "NT", "02 - New Testament").otherwise("01 - Old Testament").alias("folder")))


def verse_line(number: Column, text: Column) -> Column:
    """An anchor heading and the verse's body with its block id."""
    n = number.cast("string")
    return F.concat(F.lit("###### v"), n, F.lit('\n<span class="vn">'), n, F.lit("</span> "), text, F.lit(" ^v"), n)


def nav(*parts: Column) -> Column:
    """Navigation links joined by middle dots; null parts are left out."""
    return F.concat_ws(" · ", *parts)


def _to(prefix: Column, chapter: Column, suffix: str | None, shown: str) -> Column:
    file = F.concat(prefix, F.lit(" "), chapter.cast("string"), F.lit(f" — {suffix}" if suffix else ""))
    return t.wikilink(file, label=F.lit(shown))


def hub_nav(book: Column, chapter: Column, old: Column, greek: Column, notes: Column, fathers: Column) -> Column:
    """The ways to read a chapter, in the order of the slots: own text, a translation by testament, Greek by testament, a modern text, all of them, notes, Fathers; the last flags say what is there."""
    to = lambda suffix, shown: _to(t.file_prefix(book), chapter, suffix, shown)
    # fixed values: names of the editions in the slots, by which files are found
    slots = [to(None, "OSB"), F.when(old, to("Lexham", "Lexham")).otherwise(to("EOB", "EOB")), F.when(greek, F.when(old, to("LXX", "LXX")).otherwise(to("Greek NT", "Greek NT")))]
    slots += [to("NET", "NET"), to("Translations", "+"), F.when(notes, to("OSB Notes", "Study Notes")), F.when(fathers, to("Fathers", "Fathers"))]
    return F.concat(F.lit("> **Modes:** "), nav(*slots))


def companion_nav(book: Column, chapter: Column, notes: str | None, text: str | None, net: bool, fathers: Column) -> Column:
    """The ways from a companion: hub, its own notes, its own text, the modern text or its notes, Fathers."""
    to = lambda suffix, shown: _to(t.file_prefix(book), chapter, suffix, shown)
    slots = [to(None, "Hub"), *(to(x, x) for x in (notes, text) if x), to("NET", "NET text") if net else to("NET Notes", "NET Notes"), F.when(fathers, to("Fathers", "Fathers"))]
    return F.concat(F.lit("> **Nav:** "), nav(*slots))


def navigation(spark: SparkSession, d: str) -> DataFrame:
    """Navigation of every canonical chapter that an edition has, in its hub and in two companions; Greek where at least two editions have it, notes and Fathers where it is cited so."""
    have = table(spark, d, "verses").groupBy("book", "chapter").agg((F.count_distinct("source") >= 2).alias("greek"))
    cited = table(spark, d, "verse_refs").groupBy("book", "chapter").agg((F.count_if(F.col("origin") == "note") > 0).alias("notes"), (F.count_if(F.col("origin") == "catena") > 0).alias("fathers"))
    c = have.join(cited, ["book", "chapter"], "left").join(_canon(spark, d).select("book", "testament"), "book")
    flag = lambda name: F.coalesce(name, F.lit(False))
    at = (F.col("book"), F.col("chapter"))
    return c.select("book", "chapter", hub_nav(*at, F.col("testament") != "NT", F.col("greek"), flag("notes"), flag("fathers")).alias("hub"), companion_nav(*at, "EOB Notes", None, False, flag("fathers")).alias("text"), companion_nav(*at, None, None, True, flag("fathers")).alias("net_notes"))


def hubs(spark: SparkSession, d: str) -> DataFrame:
    """(source, book, chapter, rel_path, content): the hub of every chapter with front matter, navigation, titles and verses."""
    v = verses_now(spark, d).filter("text is not null and text <> ''")
    lines = v.select("source", "book", "chapter", F.struct("verse", "verse_id", verse_line(F.col("verse"), t.collapsed(F.col("text"), r"[ \n\t]+")).alias("line")).alias("r"))
    # a chapter holds some hundred verses at most
    chapters = lines.groupBy("source", "book", "chapter").agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["line"]), "\n\n").alias("body"))
    titles = table(spark, d, "chapters").filter("pericope is not null").groupBy("source", "book", F.col("number").alias("chapter")).agg(F.min("pericope").alias("pericope"))
    rows = chapters.join(titles, ["source", "book", "chapter"], "left").join(_canon(spark, d), "book")
    link = lambda n: t.wikilink(F.concat(F.col("book"), F.lit(" "), n.cast("string")))
    around = nav(F.when(F.col("chapter") > 1, F.concat(F.lit("← "), link(F.col("chapter") - 1))), F.when(F.col("chapter") < F.col("chapter_count"), F.concat(link(F.col("chapter") + 1), F.lit(" →"))))
    head = t.front_matter({"testament": F.col("testament"), "genre": F.col("genre"), "book": F.col("book"), "chapter": F.col("chapter"), "source": F.col("source"), "aliases": F.concat(F.lit("["), F.col("abbreviation"), F.lit(" "), F.col("chapter").cast("string"), F.lit("]"))})
    content = F.concat_ws("\n\n", head, F.nullif(around, F.lit("")), F.concat(F.lit("*"), F.col("pericope"), F.lit("*")), "body")
    path = chapter_path(F.col("folder"), F.col("book_order"), F.col("book"), F.col("book"), F.col("chapter"))
    return rows.select("source", "book", "chapter", path.alias("rel_path"), F.concat(content, F.lit("\n")).alias("content"))


def hub_render(spark: SparkSession, d: str) -> DataFrame:
    """Paths and digests of all hubs."""
    return hubs(spark, d).select("source", "book", "chapter", "rel_path", F.length("content").cast("long").alias("n_chars"), F.md5(F.encode("content", "utf-8")).alias("digest"))


def nested_notes(spark: SparkSession, d: str) -> DataFrame:
    """Citations of every chapter as notes: a heading for each verse once, its citations below, in order."""
    refs = table(spark, d, "verse_refs").filter("source is not null and book is not null and verse is not null").distinct()
    verses = refs.groupBy("source", "book", "chapter", "verse").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ref_id", "origin"))), lambda r: F.concat(F.lit("> "), F.coalesce(r["origin"], F.lit("note")), F.lit(" "), r["ref_id"].cast("string"))), "\n").alias("notes"))
    blocks = verses.select("source", "book", "chapter", F.struct("verse", F.concat(F.lit("### Verse "), F.col("verse").cast("string"), F.lit("\n"), F.col("notes")).alias("block")).alias("r"))
    return blocks.groupBy("source", "book", "chapter").agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["block"]), "\n\n").alias("content"), F.count("*").alias("n_verses"))


def marked_text(spark: SparkSession, d: str) -> DataFrame:
    """Verses with a marker for each kind of citation, in the order of the kinds' names."""
    kinds = table(spark, d, "verse_refs").filter("source is not null and book is not null and verse is not null").groupBy("source", "book", "chapter", "verse").agg(F.array_sort(F.collect_set("origin")).alias("kinds"))
    v = verses_now(spark, d).filter("text is not null and text <> ''").join(kinds, ["source", "book", "chapter", "verse"], "left")
    marks = F.array_join(F.transform("kinds", lambda k: F.concat(F.lit("<sup>"), F.substring(k, 1, 1), F.lit("</sup>"))), "")
    return v.select("verse_id", F.concat(F.col("text"), F.coalesce(marks, F.lit(""))).alias("marked"))


def book_index(spark: SparkSession, d: str) -> DataFrame:
    """Index page of every book: links to all its chapters."""
    links = F.transform(F.sequence(F.lit(1), F.col("chapter_count")), lambda n: F.concat(F.lit("[["), F.col("book"), F.lit(" "), n.cast("string"), F.lit("|"), n.cast("string"), F.lit("]]")))
    return _canon(spark, d).select("book", F.concat(F.lit("# "), F.col("book"), F.lit("\n\n"), F.array_join(links, " · ")).alias("content"))


def section_index(spark: SparkSession, d: str) -> DataFrame:
    """Page of each testament: genres as headings, books below."""
    b = _canon(spark, d).groupBy("testament", "genre").agg(F.array_sort(F.collect_list(F.struct("book_order", "book"))).alias("b"))
    block = F.struct(F.col("b")[0]["book_order"].alias("o"), F.concat(F.lit("## "), F.col("genre"), F.lit("\n"), F.array_join(F.transform("b", lambda x: F.concat(F.lit("- [["), x["book"], F.lit("]]"))), "\n")).alias("t"))
    return b.select("testament", block.alias("r")).groupBy("testament").agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["t"]), "\n\n").alias("content"))


def translations_hub(spark: SparkSession, d: str) -> DataFrame:
    """For each chapter the editions that hold it, in the order of their registration."""
    c = table(spark, d, "chapters").filter("book is not null").select("source", "book", "number").distinct()
    s = table(spark, d, "sources").select(F.col("label").alias("source"), "registered_at")
    slots = c.join(s, "source").groupBy("book", "number").agg(F.array_sort(F.collect_list(F.struct("registered_at", "source"))).alias("s"))
    return slots.select("book", "number", F.array_join(F.transform("s", lambda x: F.concat(F.lit("- [["), F.col("book"), F.lit(" "), F.col("number").cast("string"), F.lit(" — "), x["source"], F.lit("]]"))), "\n").alias("content"))


def frontmatter_emit(spark: SparkSession, d: str) -> DataFrame:
    """Front matter of every book; an alternative title only where there is one."""
    return table(spark, d, "canon_books").select("book", t.front_matter({"book": F.col("book"), "abbreviation": F.col("abbreviation"), "alt_title": F.col("alt_title"), "chapters": F.col("chapter_count")}).alias("content"))


def path_template(spark: SparkSession, d: str) -> DataFrame:
    """File paths of all chapters of the canon."""
    c = _canon(spark, d).select("*", F.explode(F.sequence(F.lit(1), F.col("chapter_count"))).alias("chapter"))
    return c.select("book", "chapter", chapter_path(F.col("folder"), F.col("book_order"), F.col("book"), F.col("book"), F.col("chapter"), F.lit("Notes")).alias("rel_path"))


def finding_lines(spark: SparkSession, d: str) -> DataFrame:
    """Findings as lines of a report; missing parts are left out."""
    f = table(spark, d, "findings").distinct()
    where = F.concat(F.col("path"), F.coalesce(F.concat(F.lit(":"), F.col("line").cast("string")), F.lit("")))
    return f.select("finding_id", F.concat_ws(" ", F.concat(F.lit("["), F.col("severity"), F.lit("]")), "code", where, F.concat(F.lit("— "), F.col("message")), F.concat(F.lit("(expected "), F.col("expected"), F.lit(", got "), F.coalesce("actual", F.lit("nothing")), F.lit(")")), F.concat(F.lit("→ "), F.col("suggestion"))).alias("entry"))


queries = {f.__name__: f for f in (hub_render, navigation, nested_notes, marked_text, book_index, section_index, translations_hub, frontmatter_emit, path_template, finding_lines)}

_REFS = "(SELECT DISTINCT * FROM verse_refs WHERE source IS NOT NULL AND book IS NOT NULL AND verse IS NOT NULL)"
_FOLDER = "CASE WHEN testament = 'NT' THEN '02 - New Testament' ELSE '01 - Old Testament' END"

_P = "CASE WHEN h.book = 'Psalms' THEN 'Psalm' ELSE h.book END || ' ' || h.chapter"
oracles = {
    "navigation": f"""WITH h AS (SELECT book, chapter, count(DISTINCT source) >= 2 AS greek FROM verses GROUP BY 1, 2), r AS (SELECT book, chapter, count_if(origin = 'note') > 0 AS notes, count_if(origin = 'catena') > 0 AS fathers FROM verse_refs GROUP BY 1, 2),
n AS (SELECT h.book, h.chapter, {_P} AS p, c.testament <> 'NT' AS old, greek, coalesce(notes, false) AS notes, CASE WHEN fathers THEN ' · [[' || {_P} || ' — Fathers|Fathers]]' ELSE '' END AS f FROM h LEFT JOIN r ON h.book = r.book AND h.chapter = r.chapter JOIN canon_books c ON c.book = h.book)
SELECT book, chapter, '> **Modes:** [[' || p || '|OSB]] · [[' || p || CASE WHEN old THEN ' — Lexham|Lexham]]' ELSE ' — EOB|EOB]]' END || CASE WHEN NOT greek THEN '' WHEN old THEN ' · [[' || p || ' — LXX|LXX]]' ELSE ' · [[' || p || ' — Greek NT|Greek NT]]' END
  || ' · [[' || p || ' — NET|NET]] · [[' || p || ' — Translations|+]]' || CASE WHEN notes THEN ' · [[' || p || ' — OSB Notes|Study Notes]]' ELSE '' END || f AS hub,
  '> **Nav:** [[' || p || '|Hub]] · [[' || p || ' — EOB Notes|EOB Notes]] · [[' || p || ' — NET Notes|NET Notes]]' || f AS text, '> **Nav:** [[' || p || '|Hub]] · [[' || p || ' — NET|NET text]]' || f AS net_notes FROM n""",
    "hub_render": rf"""WITH {_NOW}, l AS (SELECT source, book, chapter, verse, verse_id, '###### v' || verse || chr(10) || '<span class="vn">' || verse || '</span> ' || trim(regexp_replace(text, '[ \n\t]+', ' ', 'g')) || ' ^v' || verse AS line FROM now WHERE text <> ''),
b AS (SELECT source, book, chapter, string_agg(line, chr(10) || chr(10) ORDER BY verse, verse_id) AS body FROM l GROUP BY 1, 2, 3),
p AS (SELECT source, book, number AS chapter, min(pericope) AS pericope FROM chapters WHERE pericope IS NOT NULL GROUP BY 1, 2, 3),
r AS (SELECT b.*, pericope, testament, genre, abbreviation, chapter_count, {_FOLDER} || '/' || lpad(CAST(book_order AS VARCHAR), 2, '0') || ' - ' || b.book || '/Chapter ' || CASE WHEN b.chapter < 100 THEN lpad(CAST(b.chapter AS VARCHAR), 2, '0') ELSE CAST(b.chapter AS VARCHAR) END || '/' || b.book || ' ' || b.chapter || '.md' AS rel_path,
  nullif(concat_ws(' · ', CASE WHEN b.chapter > 1 THEN '← [[' || b.book || ' ' || (b.chapter - 1) || ']]' END, CASE WHEN b.chapter < chapter_count THEN '[[' || b.book || ' ' || (b.chapter + 1) || ']] →' END), '') AS nav
  FROM b LEFT JOIN p USING (source, book, chapter) JOIN canon_books c ON c.book = b.book),
o AS (SELECT source, book, chapter, rel_path, concat_ws(chr(10) || chr(10), '---' || chr(10) || concat_ws(chr(10), 'testament: ' || testament, 'genre: ' || genre, 'book: ' || book, 'chapter: ' || chapter, 'source: ' || source, 'aliases: [' || abbreviation || ' ' || chapter || ']') || chr(10) || '---', nav, '*' || pericope || '*', body) || chr(10) AS content FROM r)
SELECT source, book, chapter, rel_path, length(content) AS n_chars, md5(content) AS digest FROM o""",
    "nested_notes": f"""WITH n AS (SELECT source, book, chapter, verse, string_agg('> ' || coalesce(origin, 'note') || ' ' || ref_id, chr(10) ORDER BY ref_id, origin) AS notes FROM {_REFS} GROUP BY 1, 2, 3, 4)
SELECT source, book, chapter, string_agg('### Verse ' || verse || chr(10) || notes, chr(10) || chr(10) ORDER BY verse) AS content, count(*) AS n_verses FROM n GROUP BY 1, 2, 3""",
    "marked_text": f"""WITH {_NOW}, k AS (SELECT source, book, chapter, verse, list_sort(list(DISTINCT origin)) AS ks FROM {_REFS} GROUP BY 1, 2, 3, 4)
SELECT verse_id, text || coalesce(array_to_string(list_transform(ks, lambda x: '<sup>' || left(x, 1) || '</sup>'), ''), '') AS marked FROM now LEFT JOIN k USING (source, book, chapter, verse) WHERE text <> ''""",
    "book_index": "SELECT book, '# ' || book || chr(10) || chr(10) || array_to_string(list_transform(range(1, chapter_count + 1), lambda n: '[[' || book || ' ' || n || '|' || n || ']]'), ' · ') AS content FROM canon_books",
    "section_index": "WITH g AS (SELECT testament, genre, min(book_order) AS o, '## ' || genre || chr(10) || string_agg('- [[' || book || ']]', chr(10) ORDER BY book_order) AS t FROM canon_books GROUP BY 1, 2) SELECT testament, string_agg(t, chr(10) || chr(10) ORDER BY o) AS content FROM g GROUP BY 1",
    "translations_hub": "SELECT book, number, string_agg('- [[' || book || ' ' || number || ' — ' || source || ']]', chr(10) ORDER BY registered_at, source) AS content FROM (SELECT DISTINCT source, book, number FROM chapters WHERE book IS NOT NULL) c JOIN sources s ON c.source = s.label GROUP BY 1, 2",
    "frontmatter_emit": "SELECT book, '---' || chr(10) || concat_ws(chr(10), 'book: ' || book, 'abbreviation: ' || abbreviation, 'alt_title: ' || alt_title, 'chapters: ' || chapter_count) || chr(10) || '---' AS content FROM canon_books",
    "path_template": f"SELECT book, CAST(n AS INTEGER) AS chapter, {_FOLDER} || '/' || lpad(CAST(book_order AS VARCHAR), 2, '0') || ' - ' || book || '/Chapter ' || CASE WHEN n < 100 THEN lpad(CAST(n AS VARCHAR), 2, '0') ELSE CAST(n AS VARCHAR) END || '/' || book || ' ' || n || ' — Notes.md' AS rel_path FROM (SELECT *, unnest(range(1, chapter_count + 1)) AS n FROM canon_books)",
    "finding_lines": "SELECT finding_id, concat_ws(' ', '[' || severity || ']', code, path || coalesce(':' || line, ''), '— ' || message, '(expected ' || expected || ', got ' || coalesce(actual, 'nothing') || ')', '→ ' || suggestion) AS entry FROM (SELECT DISTINCT * FROM findings)",
}
