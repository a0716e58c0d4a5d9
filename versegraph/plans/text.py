"""Queries of the text functions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.session import table
from .ordered import _BOXES, boxes


def scan_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of every document with their numbers from 1."""
    lines = F.split(t.plain_marks(F.col("text")), "\n")
    return table(spark, d, "documents").select("doc_id", F.posexplode(lines).alias("at", "line")).select("doc_id", (F.col("at") + 1).cast("long").alias("line_no"), "line")


def noise_line_filter(spark: SparkSession, d: str) -> DataFrame:
    """Lines of boxes that are noise: under half letters, or at most three words with under five letters."""
    lines = boxes(spark, d).select("box_id", F.posexplode(F.split("text", "\n")).alias("at", "line")).filter(F.trim("line") != "")
    letters = F.length(F.regexp_replace("line", r"[^\p{L}]", ""))
    few = (F.size(F.split(F.trim("line"), " +")) <= 3) & (letters < 5)
    return lines.filter((letters < 0.5 * F.length("line")) | few).select("box_id", "line")


def title_case_filter(spark: SparkSession, d: str) -> DataFrame:
    """Lines that can be titles: ten letters or more, all capitals."""
    lines = boxes(spark, d).select("box_id", F.explode(F.split("text", "\n")).alias("line"))
    letters = F.regexp_replace("line", "[^A-Za-z]", "")
    return lines.filter((F.length(letters) >= 10) & (letters == F.upper(letters))).select("box_id", "line").distinct()


def citations(spark: SparkSession, d: str) -> DataFrame:
    """Citations inside documents, as rows."""
    return _citations(spark, d).select("doc_id", "alias", "chapter", "verse", "n").groupBy("doc_id", "alias", "chapter", "verse").agg(F.sum("n").alias("n"))


CITATION = r"((?:[1-4] )?[A-Z][A-Za-z]{2,5}) (\d{1,3}):(\d{1,3})"


def _citations(spark: SparkSession, d: str) -> DataFrame:
    """Matches of the pattern; its groups are taken from each match, so that every text is scanned once."""
    m = table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(CITATION), F.lit(0))).alias("m"))
    part = lambda i: F.regexp_extract("m", f"^{CITATION}$", i)
    return m.select("doc_id", part(1).alias("alias"), part(2).cast("int").alias("chapter"), part(3).cast("int").alias("verse"), F.lit(1).cast("long").alias("n"))


def citation_books(spark: SparkSession, d: str) -> DataFrame:
    """Citations by book, through the canon's abbreviations; unknown ones apart."""
    canon = F.broadcast(table(spark, d, "canon_books").select(F.col("abbreviation").alias("alias"), "book"))  # fixed, 56 rows
    return _citations(spark, d).join(canon, "alias", "left").groupBy("book").agg(F.count("*").alias("n_citations"), F.count_distinct("doc_id").alias("n_documents"))


def linkify(spark: SparkSession, d: str) -> DataFrame:
    """Documents' citations as wikilinks to verse anchors, where they are no links yet."""
    out = t.linked(F.col("text"), CITATION, "[[$1 $2#v$3|$1 $2:$3]]")
    return table(spark, d, "documents").select("doc_id", F.length(out).cast("long").alias("n_chars"), F.md5(F.encode(out, "utf-8")).alias("digest"))


def _aliases(spark: SparkSession, d: str, columns: tuple[str, ...]) -> tuple[str, Column, Column]:
    """A pattern of the canon's names in ``columns``, longest first, and maps from them as written, and in lower case, to the book. The canon is fixed, 56 rows."""
    rows = table(spark, d, "canon_books").select("book", *(F.col(c).alias(f"n{i}") for i, c in enumerate(columns))).filter("book is not null").distinct().orderBy("book").collect()
    names: dict[str, str] = {}
    for i in range(len(columns)):
        for r in rows:
            if name := " ".join((r[f"n{i}"] or "").split()):
                names.setdefault(name, r.book)
    lower: dict[str, str] = {}
    for name, of in names.items():
        lower.setdefault(name.lower(), of)
    to_map = lambda m: F.create_map(*(F.lit(x) for kv in m.items() for x in kv)).cast("map<string,string>")
    spelt = sorted(names, key=lambda n: (-len(n), n))
    if not names:
        return "(?!)", to_map({}), to_map({})
    return "(?:" + "|".join(r"\s+".join(map(re.escape, n.split())) for n in spelt) + ")", to_map(names), to_map(lower)


def _replaced(c: Column, pattern: str, link: Callable[[Column], Column]) -> Column:
    """The text with every match of ``pattern`` as ``link`` makes it; the list of matches is interleaved with what stands between."""
    found = F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), link)
    return F.array_join(F.zip_with(F.split(c, pattern), found, lambda between, m: F.concat(between, F.coalesce(m, F.lit("")))), "")


def linkify_books(spark: SparkSession, d: str) -> DataFrame:
    """Abbreviations between spaces, of one or several words, linked to the book that they name, in every document."""
    names, book, _ = _aliases(spark, d, ("abbreviation",))
    pattern = rf"(?<!\S){names}(?!\S)"
    named = lambda m: book[F.regexp_replace(m, r"\s+", " ")]
    docs = table(spark, d, "documents").filter("text is not null")
    links = F.size(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).cast("long")
    out = _replaced(F.col("text"), pattern, lambda m: F.concat(F.lit("[["), named(m), F.lit("]]")))
    return docs.select("doc_id", links.alias("n_links"), F.md5(F.encode(out, "utf-8")).alias("digest"))


#: What follows a name: a chapter, and a verse with the end of a range.
_PLACE = r"\s+(\d{1,3})(?::(\d{1,3})(?:\s*[-–—]\s*(\d{1,3}))?)?"


def _cited(spark: SparkSession, d: str) -> tuple[str, Callable[[Column], Column]]:
    """Pattern of citations by any name of a book, and a match's struct(book, chapter, verse, verse_end); book is null if a chapter alone follows a name that isn't as the canon writes it."""
    names, book, lower = _aliases(spark, d, ("book", "abbreviation", "alt_title"))
    pattern = rf"(?iU)(?<![\w\[|#]){names}{_PLACE}(?![\w\]|]|:\d)"

    def parts(m: Column) -> Column:
        part = lambda i: F.regexp_extract(m, f"(?iU)^(.*?){_PLACE}$", i)
        name = F.regexp_replace(part(1), r"(?U)\s+", " ")
        start, end = part(3).try_cast("int"), part(4).try_cast("int")
        named = F.coalesce(book[name], F.when(start.isNotNull(), lower[F.lower(name)]))
        return F.struct(named.alias("book"), part(2).try_cast("int").alias("chapter"), start.alias("verse"), F.when(end >= start, end).alias("verse_end"))

    return pattern, parts


def linkify_aliases(spark: SparkSession, d: str) -> DataFrame:
    """Documents' citations by any name of a book, in any case, as wikilinks to the book's file: ``[[File C#vV|as written]]``, or ``[[File C|as written]]`` of a chapter."""
    pattern, parts = _cited(spark, d)

    def link(m: Column) -> Column:
        p = parts(m)
        anchor = F.coalesce(F.concat(F.lit("#v"), p["verse"].cast("string")), F.lit(""))
        return F.coalesce(F.concat(F.lit("[["), t.file_prefix(p["book"]), F.lit(" "), p["chapter"].cast("string"), anchor, F.lit("|"), m, F.lit("]]")), m)

    out = _replaced(F.col("text"), pattern, link)
    return table(spark, d, "documents").filter("text is not null").select("doc_id", F.length(out).cast("long").alias("n_chars"), F.md5(F.encode(out, "utf-8")).alias("digest"))


def citation_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Citations inside documents by any name of a book: (doc_id, book, chapter, verse, verse_end, n); a null verse is the whole chapter, an end before the start is null."""
    pattern, parts = _cited(spark, d)
    m = table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("m"))
    return m.select("doc_id", parts(F.col("m")).alias("p")).filter("p.book is not null").groupBy("doc_id", "p.book", "p.chapter", "p.verse", "p.verse_end").agg(F.count("*").alias("n"))


def segment_labels(spark: SparkSession, d: str) -> DataFrame:
    """Documents with ``**C:V**`` labels cut into labelled segments."""
    docs = table(spark, d, "documents").filter(F.col("text").rlike(r"^\*\*\d+:\d+\*\*"))
    labels = F.regexp_extract_all("text", F.lit(r"\*\*(\d+:\d+)\*\*"), F.lit(1))
    bodies = F.slice(F.split("text", r"\*\*\d+:\d+\*\*"), 2, 100_000_000)
    rows = docs.select("doc_id", F.posexplode(F.arrays_zip(labels.alias("l"), bodies.alias("b"))).alias("at", "s"))
    ref = t.reference(F.col("s.l"))
    return rows.select("doc_id", F.col("at").cast("long").alias("at"), ref["chapter"].alias("chapter"), ref["verse"].alias("verse"), F.length(F.trim("s.b")).cast("long").alias("n_chars"))


def whitespace_dialects(spark: SparkSession, d: str) -> DataFrame:
    """Lengths of the verses' texts under the three dialects of whitespace."""
    v = table(spark, d, "verses").select("verse_id", "text").distinct().filter("text is not null")
    size = lambda dialect: F.length(t.collapsed(F.col("text"), dialect)).cast("long")
    return v.select("verse_id", size(r"[\s\x{a0}]+").alias("n_all"), size(t.BLANKS_NBSP).alias("n_nbsp"), size(t.BLANKS).alias("n_blanks"))


def blockquote(spark: SparkSession, d: str) -> DataFrame:
    """Boxes as block quotes."""
    return boxes(spark, d).filter("text is not null").select("box_id", t.quoted_block(F.col("text")).alias("quote"))


def letter_spaced(spark: SparkSession, d: str) -> DataFrame:
    """Running headers with letter-spacing closed up."""
    return boxes(spark, d).filter("y_top > 570 and text is not null").select("box_id", t.letters_together(F.col("text")).alias("heading"))


def roman_pages(spark: SparkSession, d: str) -> DataFrame:
    """Page numbers in digits or Roman numerals as numbers."""
    b = boxes(spark, d).filter("y_top < 50 and text is not null")
    return b.select("box_id", t.from_roman(F.col("text")).alias("number")).filter("number is not null")


def key_split(spark: SparkSession, d: str) -> DataFrame:
    """Parts of the editions' paths and labels."""
    s = table(spark, d, "sources")
    return s.select("label", F.split_part("path", F.lit("/"), F.lit(1)).alias("kind"), F.split_part("path", F.lit("/"), F.lit(2)).alias("name"), F.regexp_extract("label", r"(\d+)-(\d+)$", 2).try_cast("int").alias("serial"))


def json_props(spark: SparkSession, d: str) -> DataFrame:
    """A field of the events' JSON, summed by type."""
    e = table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").try_cast("long"))
    return e.groupBy("event_type").agg(F.count("k").alias("n"), F.sum("k").alias("sum_k"))


def hidden_range_links(spark: SparkSession, d: str) -> DataFrame:
    """Verse links of every chapter that an edition holds but the first, joined."""
    c = table(spark, d, "chapters").filter("book is not null and verses is not null").select("chapter_id", "book", "number", "verses").distinct()
    rest = F.array_sort(F.array_distinct("verses"))
    links = F.transform(F.slice(rest, F.lit(2), F.size(rest)), lambda v: F.concat(F.lit("[["), t.file_prefix(F.col("book")), F.lit(" "), F.col("number").cast("string"), F.lit("#v"), v.cast("string"), F.lit("]]")))
    return c.select("chapter_id", F.array_join(links, "").alias("links"))


def ocr_repair(spark: SparkSession, d: str) -> DataFrame:
    """Boxes after the ordered repairs of a scanned text: marks to spaces, words hyphenated across lines joined, spaces collapsed."""
    c = F.regexp_replace("text", r"[|~^¬]", " ")
    c = F.regexp_replace(c, r"([a-z])- *\n *([a-z])", "$1$2")
    return boxes(spark, d).filter("text is not null").select("box_id", t.tight_marks(t.collapsed(c, r"[ \n\t]+")).alias("repaired"))


queries = {f.__name__: f for f in (scan_lines, noise_line_filter, title_case_filter, citations, citation_books, linkify, linkify_books, linkify_aliases, citation_ranges, segment_labels, whitespace_dialects, blockquote, letter_spaced, roman_pages, key_split, json_props, hidden_range_links, ocr_repair)}

_CITE = f"""m AS (SELECT doc_id, unnest(regexp_extract_all(text, '{CITATION}')) AS m FROM documents),
c AS (SELECT doc_id, regexp_extract(m, '{CITATION}', 1) AS alias, CAST(regexp_extract(m, '{CITATION}', 2) AS INTEGER) AS chapter, CAST(regexp_extract(m, '{CITATION}', 3) AS INTEGER) AS verse FROM m)"""
# without look-around: what stands before and after is kept; marks but spaces are doubled by a control character, so that two citations
# don't share one, and the pattern's own colon may be followed by it
_OPEN = rf"(^|[^\p{{L}}\p{{N}}_\[|#]){CITATION}($|[^\p{{L}}\p{{N}}_\]|])".replace(":(", ":\x01?(")
_LINK = r"\1[[\2 \3#v\4|\2 \3:\4]]\5"

# the names of the canon one after another, the longest first, each replaced twice, since two citations may share the space between them; only names that a text holds are tried
_NAMED = r"""WITH b AS (SELECT book, abbreviation, alt_title, CASE WHEN book = 'Psalms' THEN 'Psalm' ELSE book END AS f FROM canon_books),
n AS (SELECT DISTINCT alias, replace(alias, ' ', '[\s\x0b\x{85}\p{Z}]+') AS p, f, book FROM (SELECT unnest(ALIASES) AS alias, f, book FROM b) WHERE alias IS NOT NULL),
l AS (SELECT list({'s': '', 'a': lower(alias), 'p': p, 'f': f, 'b': book} ORDER BY length(alias) DESC, alias) AS al FROM n),
d AS (SELECT doc_id, text, list_filter(al, lambda x: contains(lower(regexp_replace(text, '[\s\x0b\x{85}\p{Z}]+', ' ', 'g')), x.a)) AS al FROM documents, l WHERE text IS NOT NULL),
r AS (SELECT doc_id, text, list_reduce(list_prepend({'s': text, 'a': '', 'p': '', 'f': '', 'b': ''}, al), lambda t, x: {'s': REPLACED, 'a': '', 'p': '', 'f': '', 'b': ''}).s AS out FROM d) """


def _one_by_one(aliases: str, passes: list[tuple[str, str]]) -> str:
    out = "t.s"
    for pattern, target in passes:
        for _ in range(2):
            out = f"regexp_replace({out}, {pattern}, {target}, 'g')"
    return _NAMED.replace("ALIASES", aliases).replace("REPLACED", out)


_BEFORE, _AFTER, _GAP = r"(^|[^\p{L}\p{N}_\[|#])", r"($|[^\p{L}\p{N}_\]|:]|:$|:[^0-9])", r"[\s\x0b\x{85}\p{Z}]"
_VERSE = rf"'(?i){_BEFORE}(' || x.p || '{_GAP}+0{{0,2}}(\d{{1,3}}):0{{0,2}}(\d{{1,3}})(?:{_GAP}*[-–—]{_GAP}*\d{{1,3}})?){_AFTER}'"
_WHOLE = rf"'{_BEFORE}(' || x.p || '{_GAP}+0{{0,2}}(\d{{1,3}})){_AFTER}'"

oracles = {
    "linkify_books": _one_by_one("[abbreviation]", [(r"'(^|[\s\x0b])(' || x.p || ')($|[\s\x0b])'", r"'\1[[' || x.b || ']]\3'")]) + "SELECT doc_id, len(regexp_extract_all(out, '\\[\\[')) - len(regexp_extract_all(text, '\\[\\[')) AS n_links, md5(out) AS digest FROM r",
    "linkify_aliases": _one_by_one("[book, abbreviation, alt_title]", [(_VERSE, r"'\1[[' || x.f || ' \3#v\4|\2]]\5'"), (_WHOLE, r"'\1[[' || x.f || ' \3|\2]]\4'")]) + "SELECT doc_id, length(out) AS n_chars, md5(out) AS digest FROM r",
    "scan_lines": r"WITH l AS (SELECT doc_id, string_split(replace(replace(translate(text, chr(160) || '„', ' “'), chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)) AS ls FROM documents) SELECT doc_id, unnest(range(1, len(ls) + 1)) AS line_no, unnest(ls) AS line FROM l",
    "noise_line_filter": rf"""WITH {_BOXES}, l AS (SELECT box_id, unnest(string_split(text, chr(10))) AS line FROM boxes), n AS (SELECT *, length(regexp_replace(line, '[^\p{{L}}]', '', 'g')) AS k FROM l WHERE trim(line) <> '')
SELECT box_id, line FROM n WHERE k < 0.5 * length(line) OR (len(regexp_split_to_array(trim(line), ' +')) <= 3 AND k < 5)""",
    "title_case_filter": f"WITH {_BOXES}, l AS (SELECT box_id, unnest(string_split(text, chr(10))) AS line FROM boxes), n AS (SELECT *, regexp_replace(line, '[^A-Za-z]', '', 'g') AS k FROM l) SELECT DISTINCT box_id, line FROM n WHERE length(k) >= 10 AND k = upper(k)",
    "citations": f"WITH {_CITE} SELECT doc_id, alias, chapter, verse, count(*) AS n FROM c GROUP BY 1, 2, 3, 4",
    "citation_books": f"WITH {_CITE} SELECT b.book, count(*) AS n_citations, count(DISTINCT doc_id) AS n_documents FROM c LEFT JOIN canon_books b ON c.alias = b.abbreviation GROUP BY 1",
    "linkify": rf"""WITH s AS (SELECT doc_id, regexp_replace(text, '([^\p{{L}}\p{{N}}_ ])', '\1' || chr(1), 'g') AS text FROM documents),
l AS (SELECT doc_id, replace(regexp_replace(regexp_replace(text, '{_OPEN}', '{_LINK}', 'g'), '{_OPEN}', '{_LINK}', 'g'), chr(1), '') AS t FROM s) SELECT doc_id, length(t) AS n_chars, md5(t) AS digest FROM l""",
    "letter_spaced": rf"WITH {_BOXES} SELECT box_id, regexp_replace(regexp_replace(text, '([A-Z]) ([A-Z])', '\1\2', 'g'), '([A-Z]) ([A-Z])', '\1\2', 'g') AS heading FROM boxes WHERE y_top > 570 AND text IS NOT NULL",
    "segment_labels": r"""WITH s AS (SELECT doc_id, regexp_extract_all(text, '\*\*(\d+:\d+)\*\*', 1) AS ls, regexp_split_to_array(text, '\*\*\d+:\d+\*\*') AS bs FROM documents WHERE regexp_matches(text, '^\*\*\d+:\d+\*\*')),
u AS (SELECT doc_id, unnest(range(0, len(ls))) AS at0, unnest(ls) AS l, unnest(bs[2:]) AS b FROM s)
SELECT doc_id, at0 AS "at", CAST(split_part(l, ':', 1) AS INTEGER) AS chapter, CAST(split_part(l, ':', 2) AS INTEGER) AS verse, length(trim(b)) AS n_chars FROM u""",
    "whitespace_dialects": r"""SELECT verse_id, length(trim(regexp_replace(text, '[\s\x0b\x{a0}]+', ' ', 'g'))) AS n_all, length(trim(regexp_replace(text, '[ \t\x{a0}]+', ' ', 'g'))) AS n_nbsp, length(trim(regexp_replace(text, '[ \t]+', ' ', 'g'))) AS n_blanks FROM (SELECT DISTINCT verse_id, text FROM verses WHERE text IS NOT NULL)""",
    "blockquote": f"WITH {_BOXES} SELECT box_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x: CASE WHEN x = '' THEN '>' ELSE '> ' || x END), chr(10)) AS quote FROM boxes WHERE text IS NOT NULL",
    "roman_pages": rf"""WITH {_BOXES}, r AS (SELECT box_id, trim(text) AS t FROM boxes WHERE y_top < 50 AND text IS NOT NULL),
v AS (SELECT *, list_transform(string_split(upper(t), ''), lambda x: CASE x WHEN 'I' THEN 1 WHEN 'V' THEN 5 WHEN 'X' THEN 10 WHEN 'L' THEN 50 WHEN 'C' THEN 100 WHEN 'D' THEN 500 WHEN 'M' THEN 1000 ELSE 0 END) AS ds FROM r)
SELECT box_id, CAST(CASE WHEN regexp_matches(t, '^\d+$') THEN CAST(t AS INTEGER) ELSE list_sum(list_transform(range(1, len(ds) + 1), lambda i: CASE WHEN ds[i] < coalesce(list_max(ds[i+1:]), 0) THEN -ds[i] ELSE ds[i] END)) END AS INTEGER) AS number
FROM v WHERE regexp_matches(t, '^\d+$') OR regexp_matches(upper(t), '^[IVXLCDM]+$')""",
    "key_split": r"SELECT label, split_part(path, '/', 1) AS kind, split_part(path, '/', 2) AS name, TRY_CAST(regexp_extract(label, '(\d+)-(\d+)$', 2) AS INTEGER) AS serial FROM sources",
    "json_props": "SELECT event_type, count(k) AS n, CAST(sum(k) AS BIGINT) AS sum_k FROM (SELECT event_type, TRY_CAST(props->>'$.k' AS BIGINT) AS k FROM events) GROUP BY 1",
    "hidden_range_links": """SELECT chapter_id, array_to_string(list_transform(list_sort(list_distinct(verses))[2:], lambda v: '[[' || CASE WHEN book = 'Psalms' THEN 'Psalm' ELSE book END || ' ' || number || '#v' || v || ']]'), '') AS links
FROM (SELECT DISTINCT chapter_id, book, number, verses FROM chapters WHERE book IS NOT NULL AND verses IS NOT NULL)""",
    "ocr_repair": rf"""WITH {_BOXES} SELECT box_id, regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(text, '[|~^¬]', ' ', 'g'), '([a-z])- *\n *([a-z])', '\1\2', 'g'), '[ \n\t]+', ' ', 'g')), '\s+([,;:.!?])', '\1', 'g') AS repaired FROM boxes WHERE text IS NOT NULL""",
}
