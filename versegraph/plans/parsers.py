"""Queries of parsers, classifiers and joins whose inputs (ids, labels, headings, attributions) the tables don't hold: they are written from the tables' numbers, so the SQL knows what must be read from them.

Inputs are SQL that both engines run: ``{name}`` is a table.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import anchors as a, classify as c, text as t
from ..functions.session import table
from ..operators import extraction as x, ordered as o, relational as r
from ..operators.relational import FEW
from ..sources.html import html_events, markdown
from .ordered import _BOXES, NUMBER, boxes, verses_now

queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
oracles: dict[str, str] = {}


def given(spark: SparkSession, d: str, sql: str) -> DataFrame:
    """The rows of ``sql`` over the tables that it names in braces."""
    return spark.sql(sql, **{n: table(spark, d, n) for n in set(re.findall(r"\{(\w+)\}", sql))})


def _query(name: str, doc: str, sql: str, columns: Callable[[], dict[str, Column] | list[Column]], expected: str) -> None:
    """Registers ``columns`` over the rows of ``sql`` against ``expected`` over the same rows, named i."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        return given(spark, d, sql).select(*(v.alias(k) for k, v in columns().items()))

    run.__name__, run.__doc__ = name, doc
    queries[name] = run
    oracles[name] = f"WITH i AS ({re.sub(r'[{}]', '', sql)}) {expected}"


def _registered(expected: str) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        queries[f.__name__], oracles[f.__name__] = f, expected
        return f

    return add


col = F.col

_query(
    "verse_anchors", "Anchor ids of two layouts.",
    "SELECT ref_id, chapter, verse, CASE ref_id % 3 WHEN 0 THEN 'Bk_vchap' || chapter || '-' || verse WHEN 1 THEN 'BK.' || chapter || '_Text2_' || chapter || '_' || verse ELSE 'plain' END AS s FROM {verse_refs} WHERE verse IS NOT NULL",
    lambda: {"ref_id": col("ref_id")} | {k: a.verse_anchor(col("s"))[k] for k in ("prefix", "chapter", "verse")},
    "SELECT ref_id, CASE ref_id % 3 WHEN 0 THEN 'Bk' WHEN 1 THEN 'BK' END AS prefix, CASE WHEN ref_id % 3 < 2 THEN chapter END AS chapter, CASE WHEN ref_id % 3 < 2 THEN verse END AS verse FROM i",
)
_query(
    "note_ids", "Numbers of note ids and of chapters in book ids.",
    "SELECT finding_id, finding_id % 100000 AS n, CASE finding_id % 4 WHEN 0 THEN '_ednref' WHEN 1 THEN 'footnote-' WHEN 2 THEN 'fn' ELSE 'z' END || (finding_id % 100000) AS s FROM {findings}",
    lambda: {"finding_id": col("finding_id"), "number": a.note_number(col("s")), "chapter": a.chapter_of_osis(F.concat(F.lit("Bk."), col("n").cast("string")))},
    "SELECT finding_id, CAST(CASE WHEN finding_id % 4 < 3 THEN n END AS INTEGER) AS number, CAST(n AS INTEGER) AS chapter FROM i",
)
_query(
    "file_names", "Names and chapters of chapters' files.",
    "SELECT book, chapter_count AS n, 'Text/' || lower(replace(book, ' ', '_')) || lpad(CAST(chapter_count AS STRING), 3, '0') || '.xhtml' AS s FROM {canon_books}",
    lambda: {"book": col("book"), "name": a.file_key(col("s"))["name"], "chapter": a.file_key(col("s"))["chapter"]},
    "SELECT book, CASE WHEN NOT starts_with(lower(book), 'ps') THEN lower(book) END AS name, CASE WHEN NOT starts_with(lower(book), 'ps') THEN n END AS chapter FROM i",
)
_query(
    "attributions", "Fathers and works of attributions.",
    "SELECT book, book_order AS n, CASE book_order % 3 WHEN 0 THEN 'St. ' WHEN 1 THEN 'Rev. T. ' ELSE '' END || book || ' of Vantry. Sermon ' || book_order || ' on ' || book || '. B#' || book_order AS s FROM {canon_books}",
    lambda: {"book": col("book"), "father": a.attribution(col("s"))["father"], "work": a.attribution(col("s"))["work"]},
    "SELECT book, CASE WHEN n % 3 = 1 THEN 'Rev. T. ' ELSE '' END || book || ' of Vantry' AS father, 'Sermon ' || n || ' on ' || book AS work FROM i",
)
_query(
    "work_references", "Works on chapters and verses of books.",
    "SELECT book, book_order AS n, CASE WHEN book_order % 4 = 0 THEN 'Sermon ' || book ELSE 'Sermon on ' || book || ' ' || CASE WHEN book_order % 2 = 0 THEN 'XIV' ELSE CAST(chapter_count AS STRING) END || CASE WHEN book_order % 3 = 0 THEN '' ELSE ', ' || book_order || ', 7-' || (book_order + 9) END END AS s, chapter_count FROM {canon_books}",
    lambda: {"book": col("book")} | {k: a.work_reference(col("s"))[k] for k in ("work", "chapter", "verse_start", "verse_end", "section")},
    "SELECT book, CASE WHEN n % 4 > 0 THEN 'Sermon on ' || book || ' ' || h END AS work, CASE WHEN n % 4 > 0 THEN h END AS chapter, CASE WHEN n % 4 > 0 AND n % 3 > 0 THEN n END AS verse_start, CASE WHEN n % 4 > 0 AND n % 3 > 0 THEN n + 9 END AS verse_end, CASE WHEN n % 4 > 0 AND n % 3 > 0 THEN n || ', 7-' || (n + 9) END AS section FROM (SELECT *, CASE WHEN n % 2 = 0 THEN 14 ELSE chapter_count END AS h FROM i)",
)
_query(
    "same_book_references", "Verses that a text cites of its own book, by the longest name.",
    "SELECT ref_id, verse, CASE ref_id % 3 WHEN 0 THEN 'Theb 9:9, see 1 theb. ' || chapter || ':' || verse || '-' || (verse + 2) WHEN 1 THEN 'with Theb ' || chapter || ':' || verse ELSE 'Thebes 3:4' END AS s FROM {verse_refs} WHERE verse IS NOT NULL",
    lambda: {"ref_id": col("ref_id")} | {k: a.same_book_reference(col("s"), ["Theb", "1 Theb"])[k] for k in ("verse_start", "verse_end")},
    "SELECT ref_id, CASE WHEN ref_id % 3 < 2 THEN verse END AS verse_start, CASE ref_id % 3 WHEN 0 THEN verse + 2 WHEN 1 THEN verse END AS verse_end FROM i",
)
_query(
    "heading_references", "References of headings, with letters and ranges that go backwards.",
    "SELECT ref_id, chapter, verse, greatest(verse + CAST(ref_id % 5 AS INT) - 2, 0) AS e, chapter || ':' || verse || '–' || greatest(verse + CAST(ref_id % 5 AS INT) - 2, 0) || 'b' AS s FROM {verse_refs} WHERE verse IS NOT NULL",
    lambda: {"ref_id": col("ref_id"), "heading": t.heading_reference(col("s")), "chapter": t.reference(col("s"))["chapter"], "verse": t.reference(col("s"))["verse"], "verse_end": t.reference(col("s"))["verse_end"]},
    "SELECT ref_id, chapter || ':' || verse || CASE WHEN e >= verse THEN '–' || e ELSE '' END AS heading, chapter, verse, CASE WHEN e >= verse THEN e END AS verse_end FROM i",
)
_query(
    "book_headings", "Headings of books, brought to the canon's form.",
    "SELECT book, 'According  to ' || book || ' (part ' || chapter_count || ')' AS s FROM {canon_books}",
    lambda: {"book": col("book"), "heading": t.book_heading(col("s"))},
    "SELECT book, upper(book) AS heading FROM i",
)
_query(
    "tagged_texts", "Texts without their tags.",
    "SELECT DISTINCT verse_id, text FROM {verses} WHERE text IS NOT NULL AND text NOT LIKE '%<%'",
    lambda: {"verse_id": col("verse_id"), "digest": F.md5(F.encode(t.stripped_tags(F.concat(F.lit("<S>12</S>"), col("text"), F.lit(" <m>end</m>"))), "utf-8"))},
    r"SELECT verse_id, md5(trim(regexp_replace(text || ' end', '[\s\x0b\x{85}\p{Z}]+', ' ', 'g'))) AS digest FROM i",
)
_query(
    "joint_books", "Chapters of a joint book, and books that headings name.",
    "SELECT DISTINCT number, CASE number % 3 WHEN 0 THEN 'The book of JOEL' WHEN 1 THEN 'Joel after Hosea' ELSE 'none' END AS s FROM {chapters}",
    lambda: {"number": col("number"), "book": a.split_ezra(col("number"))["book"], "chapter": a.split_ezra(col("number"))["chapter"], "named": a.named_book(col("s"), ["Hosea", "Joel"])},
    "SELECT number, CASE WHEN number <= 10 THEN 'Ezra' ELSE 'Nehemiah' END AS book, CASE WHEN number <= 10 THEN number ELSE number - 10 END AS chapter, CASE number % 3 WHEN 0 THEN 'Joel' WHEN 1 THEN 'Hosea' END AS named FROM i",
)
_query(
    "psalm_numbers", "Hebrew numbers, kathisma and stasis of Greek psalms.",
    "SELECT DISTINCT number FROM {chapters} WHERE number BETWEEN 1 AND 151",
    lambda: {"number": col("number"), "mt": t.psalm_in_mt(col("number")).cast("int"), "kathisma": t.kathisma(col("number"))["kathisma"], "stasis": t.kathisma(col("number"))["stasis"]},
    f"""SELECT number, CASE WHEN number < 10 OR number BETWEEN 148 AND 150 THEN number WHEN number BETWEEN 10 AND 112 OR number BETWEEN 116 AND 145 THEN number + 1 WHEN number = 113 THEN 114 WHEN number IN (114, 115) THEN 116 WHEN number IN (146, 147) THEN 147 END AS mt,
CASE WHEN number = 151 THEN NULL WHEN number = 118 THEN 17 WHEN k > 48 THEN (k - 1) // 3 + 2 ELSE (k - 1) // 3 + 1 END AS kathisma, CASE WHEN number = 151 THEN NULL WHEN number = 118 THEN 0 ELSE (k - 1) % 3 + 1 END AS stasis
FROM (SELECT number, CAST(len(list_filter({t.STASIS_ENDS}, lambda e: e < number)) + 1 AS INTEGER) AS k FROM i)""",
)
_query(
    "inline_verses", "Texts cut at verse numbers that stand directly before a letter.",
    "SELECT ref_id, verse, CASE ref_id % 2 WHEN 0 THEN 'lead ' ELSE '' END || verse || 'First, of 12 men. ' || (verse + 1) || 'Then so.' AS s FROM {verse_refs} WHERE verse IS NOT NULL",
    lambda: {"ref_id": col("ref_id"), "fragments": F.array_join(F.transform(t.inline_fragments(col("s")), lambda f: F.concat_ws("=", f["verse"].cast("string"), f["text"])), "|")},
    "SELECT ref_id, CASE ref_id % 2 WHEN 0 THEN 'lead|' ELSE '' END || verse || '=First, of 12 men.|' || (verse + 1) || '=Then so.' AS fragments FROM i",
)
_query(
    "note_codes", "Types of note codes, in books and in print, of files, and their markers.",
    "SELECT finding_id, CASE finding_id % 5 WHEN 0 THEN 'tn' WHEN 1 THEN 'tc' WHEN 2 THEN 'sn' WHEN 3 THEN 'map' ELSE 'zz' END AS s, CASE finding_id % 3 WHEN 0 THEN 'variant.html' WHEN 1 THEN 'x-liturgical.html' ELSE 'study3.html' END AS f FROM {findings}",
    lambda: {"finding_id": col("finding_id"), "kind": c.code_type(col("s")), "printed": c.code_type(col("s"), printed=True), "of_file": c.file_type(col("f")), "marker": c.marker(c.file_type(col("f")))},
    """SELECT finding_id, CASE s WHEN 'tn' THEN 'translator_note' WHEN 'tc' THEN 'variant' WHEN 'sn' THEN 'footnote' WHEN 'map' THEN 'background_note' END AS kind, CASE s WHEN 'tn' THEN 'translator_note' WHEN 'tc' THEN 'variant' WHEN 'sn' THEN 'footnote' WHEN 'map' THEN 'cross_reference' END AS printed,
CASE finding_id % 3 WHEN 0 THEN 'variant' WHEN 1 THEN 'liturgical' ELSE 'footnote' END AS of_file, CASE finding_id % 3 WHEN 0 THEN '<sup class="nt-tc">‡</sup>' WHEN 1 THEN '<sup class="nt-lit">☩</sup>' ELSE '<sup class="nt-fn">†</sup>' END AS marker FROM i""",
)
_query(
    "translation_note_types", "Translators' notes by their opening.",
    "SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'Or, so' WHEN 1 THEN 'Lit. so' WHEN 2 THEN 'Some manuscripts: ' || book WHEN 3 THEN 'See there' WHEN 4 THEN 'Job, too' WHEN 5 THEN 'i.e., so' ELSE text END AS s FROM {documents} WHERE text IS NOT NULL",
    lambda: {"doc_id": col("doc_id"), "note_type": c.translation_note_type(col("s"))},
    r"SELECT doc_id, CASE " + " ".join(f"WHEN {c.opening_sql('w', openings)} THEN '{label}'" for label, openings in c.TRANSLATION_OPENINGS) + r" ELSE 'translator_note' END AS note_type FROM (SELECT doc_id, regexp_split_to_array(lower(s), '\s+') AS w FROM i)",
)
_query(
    "fathers_named", "Fathers that notes name, their works, and the genre of what is said.",
    "SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'as JohnChr says' WHEN 1 THEN 'so THEOPHYLACT, in a homily' WHEN 2 THEN 'AmbM and Iren, stichera' WHEN 3 THEN '(Irenaeus)' WHEN 4 THEN 'Ambrosed' ELSE NULL END AS s FROM {documents}",
    lambda: {"doc_id": col("doc_id"), "father": c.father(col("s")), "work": c.attributed(col("s"), F.lit("Luke"))["work"], "genre": c.patristic_type(F.coalesce("s", F.lit("")))},
    "SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'John Chrysostom' WHEN 1 THEN 'Theophylact of Ohrid' WHEN 2 THEN 'Ambrose of Milan' WHEN 3 THEN 'Irenaeus of Lyons' END AS father, CASE doc_id % 6 WHEN 0 THEN 'Homilies on Luke' WHEN 1 THEN 'Commentary on Luke' WHEN 2 THEN 'Commentary on Luke' WHEN 3 THEN 'Against Heresies' END AS work, CASE doc_id % 6 WHEN 1 THEN 'homily' WHEN 2 THEN 'liturgical' ELSE 'commentary' END AS genre FROM i",
)
_query(
    "plausible_authors", "Names that can be an author's.",
    "SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'St. Orsolo of Vantry' WHEN 1 THEN 'orsolo' WHEN 2 THEN 'Orsolo 3' WHEN 3 THEN 'Orsolo, Rev.' WHEN 4 THEN '—' WHEN 5 THEN 'Orsolo and ' || repeat('x ', 12) ELSE NULL END AS s FROM {documents}",
    lambda: {"doc_id": col("doc_id"), "plausible": c.plausible_author(col("s"))},
    "SELECT doc_id, doc_id % 7 = 0 AS plausible FROM i",
)
_query(
    "ordinals_and_months", "Ordinal words, parts of a sequence, months and reading types.",
    "SELECT DISTINCT number, CASE number % 4 WHEN 0 THEN 'one' WHEN 1 THEN 'TWELVE' WHEN 2 THEN 'Twenty-Eight' ELSE 'THIRTY' END AS s, 'm' || lpad(CAST(number % 14 AS STRING), 2, '0') AS m, CASE number % 3 WHEN 0 THEN 'ep' WHEN 1 THEN 'go' ELSE 'le' END AS k FROM {chapters}",
    lambda: {"number": col("number"), "ordinal": c.ordinal(col("s")), "part": c.part_of_sequence(col("number"))["part"], "place": c.part_of_sequence(col("number"))["number"], "month": c.month(col("m")), "reading": c.reading_type(col("k"))},
    f"""SELECT number, CASE number % 4 WHEN 0 THEN 1 WHEN 1 THEN 12 WHEN 2 THEN 28 END AS ordinal, CASE WHEN number <= 25 THEN 'Visions' WHEN number <= 49 THEN 'Commandments' WHEN number <= 114 THEN 'Parables' END AS part,
CASE WHEN number <= 25 THEN number WHEN number <= 49 THEN number - 25 WHEN number <= 114 THEN number - 49 END AS place, coalesce({c.MONTHS}[CASE WHEN number % 14 > 0 THEN number % 14 END], m) AS month, CASE number % 3 WHEN 0 THEN 'Epistle' WHEN 1 THEN 'Gospel' ELSE 'le' END AS reading FROM i""",
)
_query(
    "excerpt_titles", "Excerpts from their first title on, which no context header is.",
    "SELECT book, 'He said so.' || chr(10) || CASE WHEN book_order % 2 = 0 THEN 'SUNDAY OF THE SECOND LAMP' || chr(10) ELSE '' END || CASE WHEN book_order % 3 = 0 THEN 'no title' ELSE 'THE TITLE OF ' || upper(book) || chr(10) || 'Body.' END AS s FROM {canon_books}",
    lambda: {"book": col("book"), "excerpt": a.from_title(col("s"))},
    "SELECT book, CASE WHEN s LIKE '%no title' THEN '' ELSE 'THE TITLE OF ' || upper(book) || chr(10) || 'Body.' END AS excerpt FROM i",
)
_query(
    "context_headers", "Lines that name a week, feast or service.",
    "SELECT book, CASE book_order % 5 WHEN 0 THEN 'Sunday of ' || book WHEN 1 THEN 'in the GREAT  LENT of ' || book WHEN 2 THEN book || ' (OGL) 3' WHEN 3 THEN '7th WEEK,' ELSE 'A great lamp of ' || book END AS s FROM {canon_books}",
    lambda: {"book": col("book"), "header": a.context_header(col("s"))},
    "SELECT book, s NOT LIKE 'A great lamp%' AS header FROM i",
)
_query(
    "scan_repairs", "Ordered repairs of a scan's known misreadings and broken words.",
    "SELECT book, 'sce the Corin- thians | and Jobn, Hom-bom ilies of ' || book || ' a moun- x tain; seckers sceptre' AS s FROM {canon_books}",
    lambda: {"book": col("book"), "repaired": t.scan_repaired(col("s"))},
    "SELECT book, 'see the Corinthians and John, Homilies of ' || book || ' a mountain; seckers sceptre' AS repaired FROM i",
)


@_registered("SELECT DISTINCT ref_id, CASE WHEN ref_id % 5 = 4 THEN 'shown' WHEN c.book IS NULL THEN 'shown' ELSE '[[' || CASE WHEN c.book = 'Psalms' THEN 'Psalm' ELSE c.book END || ' ' || chapter || '#v' || verse || '|shown]]' END AS link FROM verse_refs v LEFT JOIN canon_books c ON c.book = v.book WHERE verse IS NOT NULL AND v.book IS NOT NULL")
def verse_hrefs(spark: SparkSession, d: str) -> DataFrame:
    """Links to verses in files, as wikilinks; other links and unknown files show their text alone."""
    refs = given(spark, d, "SELECT DISTINCT ref_id, '../t/' || replace(book, ' ', '_') || CASE WHEN ref_id % 2 = 0 THEN '2' ELSE '' END || '.html#' || CASE WHEN ref_id % 5 = 4 THEN 'top' ELSE 'Bk_vchap' || chapter || '-' || verse END AS href FROM {verse_refs} WHERE verse IS NOT NULL AND book IS NOT NULL")
    files = given(spark, d, "SELECT DISTINCT replace(book, ' ', '_') || '.html' AS file, book FROM {canon_books}")
    at = a.verse_href(col("href"))
    known = r.two_step(refs.withColumns({"at": at, "file_name": at["file"]}), files, "file_name", a.book_key(col("file_name")), "file", "book", "book")
    return known.select("ref_id", a.verse_link(col("book"), col("at.chapter"), col("at.verse"), F.lit("shown")).alias("link"))


_NOTES = "SELECT DISTINCT ref_id AS note_id, 't/' || replace(book, ' ', '_') || CASE WHEN ref_id % 2 = 0 THEN CAST(chapter AS STRING) ELSE '' END || '.html#n' || ref_id AS href, chapter || ':' || verse || '-' || (verse + 1) AS ref, CASE ref_id % 4 WHEN 0 THEN 'As JohnChr says' WHEN 1 THEN 'Iren has it' ELSE 'A lamp' END AS content FROM {verse_refs} WHERE verse IS NOT NULL AND book IS NOT NULL"
_PLACED = """WITH p AS (SELECT DISTINCT ref_id AS note_id, CASE WHEN ref_id % 50 = 0 THEN (SELECT min(book) FROM canon_books) ELSE c.book END AS book, chapter, verse, verse + 1 AS verse_end, CASE ref_id % 4 WHEN 0 THEN 'As JohnChr says' WHEN 1 THEN 'Iren has it' ELSE 'A lamp' END AS content
FROM verse_refs v LEFT JOIN canon_books c ON c.book = v.book WHERE verse IS NOT NULL AND v.book IS NOT NULL), k AS (SELECT p.* FROM p JOIN canon_books c ON c.book = p.book WHERE chapter BETWEEN 1 AND chapter_count) """


def _placed(spark: SparkSession, d: str) -> DataFrame:
    files = given(spark, d, "SELECT DISTINCT replace(book, ' ', '_') || '.html' AS file, book FROM {canon_books}")
    overrides = given(spark, d, "SELECT DISTINCT ref_id AS note_id, (SELECT min(book) FROM {canon_books}) AS book FROM {verse_refs} WHERE ref_id % 50 = 0")
    return x.back_linked(given(spark, d, _NOTES), files, overrides, table(spark, d, "canon_books"))


@_registered(_PLACED + "SELECT note_id, book, chapter, verse, verse_end, content || CASE WHEN content = 'A lamp' THEN '' ELSE ' → See Fathers' END AS content FROM k")
def back_linked_notes(spark: SparkSession, d: str) -> DataFrame:
    """Notes placed by the files they link back to, with pointers to the Fathers they name."""
    return x.referred(_placed(spark, d))


@_registered(_PLACED + "SELECT note_id, book, chapter, verse, verse_end, content, CASE note_id % 4 WHEN 0 THEN 'John Chrysostom' ELSE 'Irenaeus of Lyons' END AS father, CASE note_id % 4 WHEN 0 THEN 'Homilies on ' || book ELSE 'Against Heresies' END AS work FROM k WHERE note_id % 4 < 2")
def promoted_notes(spark: SparkSession, d: str) -> DataFrame:
    """The same notes, those that name a Father, as his excerpts."""
    return x.promoted(_placed(spark, d))


_KINDS = "CASE ref_id % 6 WHEN 0 THEN 'footnote' WHEN 1 THEN 'variant' WHEN 2 THEN 'cross_reference' WHEN 3 THEN 'translator_note' WHEN 4 THEN 'background_note' ELSE 'citation' END"
_TYPED = f"SELECT DISTINCT ref_id, source, book, chapter, verse, ref_id % 3 AS sort_key, {_KINDS} AS kind FROM {{verse_refs}} WHERE verse IS NOT NULL AND book IS NOT NULL AND source IS NOT NULL"
# Types of notes as they are declared, and those of a modern text's notes.
DECLARED = ["footnote", "variant", "cross_reference", "liturgical", "citation", "translator_note", "alternative", "background_note"]
MODERN = ["footnote", "variant", "translator_note", "background_note"]


def _ranking(kinds: list[str]) -> str:
    return f"WITH i AS ({_TYPED.replace('{verse_refs}', 'verse_refs')}) SELECT ref_id, kind, row_number() OVER (PARTITION BY source, book, chapter ORDER BY verse, sort_key, list_position({kinds}, kind), ref_id) AS place FROM i WHERE list_contains({kinds}, kind)"


@_registered(_ranking(DECLARED))
def note_order(spark: SparkSession, d: str) -> DataFrame:
    """Places of the notes of every chapter: by verse, sort key, type as declared, and id."""
    return r.ranked(given(spark, d, _TYPED), ["source", "book", "chapter"], ["verse", "sort_key"], "kind", DECLARED, ["ref_id"], "place").select("ref_id", "kind", "place")


@_registered(_ranking(MODERN))
def modern_note_order(spark: SparkSession, d: str) -> DataFrame:
    """The same of the types that a modern text's notes keep, in their order."""
    return r.ranked(given(spark, d, _TYPED), ["source", "book", "chapter"], ["verse", "sort_key"], "kind", MODERN, ["ref_id"], "place").select("ref_id", "kind", "place")


@_registered("""WITH f AS (SELECT book, min(chapter_id) AS first FROM chapters GROUP BY 1)
SELECT c.book, row_number() OVER (ORDER BY book_order) AS canonical, row_number() OVER (ORDER BY c.book) AS alphabetical, row_number() OVER (ORDER BY first NULLS LAST, book_order) AS in_document, row_number() OVER (ORDER BY testament = 'NT', book_order) AS by_testament FROM canon_books c LEFT JOIN f ON f.book = c.book""")
def book_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders of books that sources use: the canon's, the alphabet's, a document's, and by testament; the canon is one small table."""
    from pyspark.sql import Window

    first = table(spark, d, "chapters").groupBy("book").agg(F.min("chapter_id").alias("first"))
    books = F.broadcast(table(spark, d, "canon_books").select("book", "book_order", "testament"))
    place = lambda *order: F.row_number().over(Window.orderBy(*order)).cast("long")
    return books.join(first, "book", "left").select("book", place("book_order").alias("canonical"), place("book").alias("alphabetical"), place(col("first").asc_nulls_last(), "book_order").alias("in_document"), place(col("testament") == "NT", "book_order").alias("by_testament"))


@_registered("WITH n AS (SELECT book AS alias, book FROM canon_books UNION SELECT abbreviation, book FROM canon_books UNION SELECT alt_title, book FROM canon_books) SELECT book, string_agg(alias, '|' ORDER BY length(alias) DESC, alias) AS pattern FROM n WHERE alias IS NOT NULL GROUP BY 1")
def alias_patterns(spark: SparkSession, d: str) -> DataFrame:
    """The names of every book as alternatives, the longest first."""
    names = table(spark, d, "canon_books").select("book", F.explode(F.array_distinct(F.array_compact(F.array("book", "abbreviation", "alt_title")))).alias("alias"))
    return names.groupBy("book").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.length("alias")).alias("n"), "alias"))), lambda e: e["alias"]), "|").alias("pattern"))


@_registered(rf"""WITH {_BOXES}, m AS (SELECT source, page, box_id, text, TRY_CAST(regexp_extract(text, '^\s*(\d{{1,3}})(?:  |$)', 1) AS INTEGER) AS v FROM boxes WHERE text IS NOT NULL AND y_top BETWEEN 60 AND 560),
o AS (SELECT *, min(v) OVER (PARTITION BY source, page ORDER BY box_id) AS seen FROM m), h AS (SELECT source, page + 1 AS page, last(v ORDER BY box_id) AS v FROM m WHERE v IS NOT NULL GROUP BY 1, 2)
SELECT o.source, o.page, h.v AS verse, md5(string_agg(text, ' ' ORDER BY box_id)) AS digest FROM o JOIN h ON h.source = o.source AND h.page = o.page WHERE seen IS NULL GROUP BY 1, 2, 3""")
def continued_verses(spark: SparkSession, d: str) -> DataFrame:
    """Text at the head of a page before its first verse number, as the rest of the last verse of the page before; pages meet by their number."""
    b = boxes(spark, d).filter("text is not null and y_top between 60 and 560").withColumn("v", F.regexp_extract("text", NUMBER, 1).try_cast("int"))
    head = o.forward_fill(b, ["source", "page"], ["box_id"], col("v").isNotNull(), col("v"), "seen").filter("seen is null")
    last = b.filter("v is not null").groupBy("source", (col("page") + 1).alias("page")).agg(F.max_by("v", "box_id").alias("verse"))
    rest = o.ordered_text(head, ["source", "page"], ["box_id"], "text", " ", "rest")
    return rest.join(last, ["source", "page"]).select("source", "page", "verse", F.md5(F.encode("rest", "utf-8")).alias("digest"))


_SEQ = r"^\s*([\dlIOoSB]{1,3})  "


@_registered(rf"""WITH {_BOXES}, n AS (SELECT source, page, list(translate(regexp_extract(text, '{_SEQ}', 1), '{o.AS_DIGITS[0]}', '{o.AS_DIGITS[1]}') ORDER BY box_id) AS ts FROM boxes WHERE y_top > 60 AND regexp_matches(text, '{_SEQ}') GROUP BY 1, 2),
f AS (SELECT source, page, list_reduce(list_prepend({{'at': 0, 's': '', 't': ''}}, list_transform(ts, lambda x: {{'at': 0, 's': '', 't': x}})), lambda p, x: CASE
  WHEN TRY_CAST(x.t AS INTEGER) > p.at AND TRY_CAST(x.t AS INTEGER) <= p.at + 25 AND TRY_CAST(x.t AS INTEGER) <= 176 THEN {{'at': TRY_CAST(x.t AS INTEGER), 's': p.s || ' next ' || TRY_CAST(x.t AS INTEGER), 't': ''}}
  WHEN TRY_CAST(x.t AS INTEGER) IN (1, 2) AND p.at >= 3 THEN {{'at': TRY_CAST(x.t AS INTEGER), 's': p.s || ' reset ' || TRY_CAST(x.t AS INTEGER), 't': ''}}
  WHEN p.at < 176 AND levenshtein(x.t, CAST(p.at + 1 AS VARCHAR)) = 1 THEN {{'at': p.at + 1, 's': p.s || ' repaired ' || (p.at + 1), 't': ''}} ELSE p END) AS r FROM n)
SELECT source, page, trim(r.s) AS accepted FROM f""")
def verse_sequences(spark: SparkSession, d: str) -> DataFrame:
    """Verse numbers that a reader of each page accepts, with resets and repairs by the expected number."""
    b = boxes(spark, d).filter("y_top > 60").withColumn("token", F.nullif(F.regexp_extract("text", _SEQ, 1), F.lit("")))
    out = o.verse_sequence(b, ["source", "page"], ["box_id"], "token")
    return out.select("source", "page", F.array_join(F.transform("accepted", lambda e: F.concat_ws(" ", e["how"], e["number"].cast("string"))), " ").alias("accepted"))


@_registered("SELECT DISTINCT chapter_id, n.c AS chapter, n.v AS verse, n.t AS content FROM (SELECT chapter_id, unnest([{'c': number, 'v': 2, 't': 'first note'}, {'c': number, 'v': 3, 't': 'second one'}, {'c': number + 1, 'v': 1, 't': 'third'}]) AS n FROM chapters)")
def displaced_notes(spark: SparkSession, d: str) -> DataFrame:
    """Notes displaced to a page's end, cut at their labels."""
    pages = given(spark, d, "SELECT DISTINCT chapter_id, 'lead ' || number || '.2 first note. ' || number || '.3–5 second' || chr(10) || 'one ' || (number + 1) || '.1 third' AS s FROM {chapters}")
    return a.labelled_notes(pages, ["chapter_id"], "s")


@_registered("""WITH c AS (SELECT DISTINCT source, chapter, verse, book FROM verse_refs WHERE source IS NOT NULL AND book IS NOT NULL AND verse IS NOT NULL), n AS (SELECT verse_id, source, book, chapter, verse, max(text) AS text FROM verses GROUP BY ALL)
SELECT c.book, c.chapter + 1 AS chapter, c.source AS father, c.chapter || '.' || c.verse AS work, c.verse AS verse_start, c.verse + 1 AS verse_end, md5(text) AS digest FROM c JOIN n ON n.source = c.source AND n.chapter = c.chapter AND n.verse = c.verse AND n.book = c.book WHERE text IS NOT NULL""")
def citing_excerpts(spark: SparkSession, d: str) -> DataFrame:
    """Citations with the texts of the verses that make them, as excerpts on what they cite."""
    refs = table(spark, d, "verse_refs").filter("source is not null and book is not null and verse is not null").select("source", "book", "chapter", "verse").distinct()
    cites = refs.select(F.concat_ws("/", "source", "book").alias("document"), col("chapter").alias("d_chapter"), col("verse").alias("d_verse"), "book", (col("chapter") + 1).alias("chapter"), col("verse").alias("verse_start"), (col("verse") + 1).alias("verse_end"))
    own = verses_now(spark, d).filter("text is not null").select(F.concat_ws("/", "source", "book").alias("document"), "chapter", "verse", "text")
    found = a.citing_texts(cites, own)
    return found.select("book", "chapter", F.split_part("father", F.lit("/"), F.lit(1)).alias("father"), "work", "verse_start", "verse_end", F.md5(F.encode("content", "utf-8")).alias("digest"))


@_registered("SELECT book, chapter_count AS chapter, 'Orsolo of Vantry' AS father, 'Homily on ' || book || ' 3, 7, 9-11' AS work, 'homily' AS ptype, 7 AS verse_start, 11 AS verse_end, 'THE SHEAF LEFT BEHIND' || chr(10) || chr(10) || 'It lay there.' AS content FROM canon_books WHERE book_order % 4 < 2 UNION ALL SELECT book, chapter_count, 'Adeltrud', 'Deep Things', 'commentary', 6, 6, 'A LAMP IN THE BARN' || chr(10) || chr(10) || 'It shone.' FROM canon_books WHERE book_order % 4 < 3")
def anthology(spark: SparkSession, d: str) -> DataFrame:
    """Excerpts of an anthology with a section for every book of the canon: headings, scripture, context headers, blocked authors and bibliographies among them."""
    canon = table(spark, d, "canon_books").select("book", "book_order", "chapter_count")
    n, s = col("book_order"), lambda *p: F.concat(*(F.lit(x) if isinstance(x, str) else x for x in p))
    parts = [s(F.upper("book"), " ", col("chapter_count").cast("string")), s("6 The lamp was lit."), s("SUNDAY OF THE LAMP"), s("THE SHEAF LEFT BEHIND"), s("It lay there."), s(F.when(n % 4 < 2, "St. Orsolo of Vantry").otherwise("Nobody"), ". Homily on ", col("book"), " 3, 7, 9-11. B#3, p. 2."), s("17"), F.when(n % 4 == 3, s("B2. A List. x B#1")), s("A LAMP IN THE BARN"), s("It shone."), s("Adeltrud. Deep Things. B#4.")]
    blocks = canon.select(F.lit("S").alias("source"), col("book").alias("path"), F.posexplode(F.array_compact(F.array(*parts))).alias("blk", "raw"))
    books = [b for (b,) in canon.select("book").distinct().limit(FEW + 1).collect()]
    if len(books) > FEW:
        raise ValueError("the canon is a small fixed table")
    found = x.catena(blocks, books, blocked=("nobody",)).join(F.broadcast(canon.select(F.lower("book").alias("low"), col("book").alias("name"))), F.lower("book") == col("low"))
    return found.select(col("name").alias("book"), "chapter", "father", "work", "ptype", "verse_start", "verse_end", "content")


@_registered("SELECT DISTINCT ref_id, coalesce(origin, 'none') || ' *' || ref_id || '* **b** SMALL' AS md FROM verse_refs")
def html_markdown(spark: SparkSession, d: str) -> DataFrame:
    """Inline markup as Markdown."""
    pages = given(spark, d, "SELECT DISTINCT 'S' AS source, CAST(ref_id AS STRING) AS path, 0 AS spine_idx, '<p>' || coalesce(origin, 'none') || ' <i>' || ref_id || '</i> <b>b</b> <small>small</small></p>' AS html FROM {verse_refs}")
    return markdown(html_events(pages), ["path"]).select(col("path").cast("long").alias("ref_id"), "md")
