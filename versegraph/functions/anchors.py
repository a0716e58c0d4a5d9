"""Parsers of ids, file names, labels and attributions, as column expressions, and joins that rest on them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as t
from .classify import TITLES


def verse_anchor(c: Column) -> Column:
    """struct(prefix, chapter, verse) of ``{P}_vchap{C}-{V}`` or ``{CODE}.{C}_..._{C}_{V}``; null parts where it is neither."""
    one, two = r"^([A-Za-z0-9]+)_vchap(\d+)-(\d+)$", r"^([A-Z0-9]+)\.(\d+)_.*_(\d+)$"
    part = lambda i: F.coalesce(F.nullif(F.regexp_extract(c, one, i), F.lit("")), F.nullif(F.regexp_extract(c, two, i), F.lit("")))
    return F.struct(part(1).alias("prefix"), part(2).try_cast("int").alias("chapter"), part(3).try_cast("int").alias("verse"))


def note_number(c: Column) -> Column:
    """Number of a note id: ``_ednrefN``, ``footnote-N``, ``fnN``."""
    return F.regexp_extract(c, r"^(?:_edn(?:ref)?|footnote-|fn)(\d+)$", 1).try_cast("int")


def chapter_of_osis(c: Column) -> Column:
    return F.regexp_extract(c, r"\.(\d+)$", 1).try_cast("int")


def file_key(c: Column) -> Column:
    """struct(name, chapter) of a chapter's file such as ``john03.html`` or ``2_john_3.xhtml``; psalm files, which have their own layout, are null."""
    stem = F.regexp_replace(F.regexp_extract(c, r"([^/]+)\.x?html?$", 1), r"[_-]", " ")
    m = r"^(.*?[A-Za-z])\s*0*(\d+)$"
    name = F.trim(F.regexp_extract(stem, m, 1))
    valid = stem.rlike(m) & ~F.lower(name).startswith("ps")
    return F.when(valid, F.struct(name.alias("name"), F.regexp_extract(stem, m, 2).cast("int").alias("chapter")))


def book_key(c: Column) -> Column:
    """A note file's name without its trailing digits, for a second lookup."""
    return F.regexp_replace(c, r"\d+(?=\.[a-z]+$)|\d+$", "")


def verse_href(c: Column) -> Column:
    """struct(file, chapter, verse) of a link to a verse, ``john2.html#John_vchap3-19``; null for other links."""
    target = verse_anchor(F.split_part(c, F.lit("#"), F.lit(-1)))
    file = F.split_part(F.split_part(c, F.lit("#"), F.lit(1)), F.lit("/"), F.lit(-1))
    return F.when(c.contains("#") & target["verse"].isNotNull(), F.struct(file.alias("file"), target["chapter"].alias("chapter"), target["verse"].alias("verse")))


def verse_link(book: Column, chapter: Column, verse: Column, shown: Column) -> Column:
    """The wikilink of a verse, as shown; without a book what is shown alone."""
    link = t.wikilink(F.concat(t.file_prefix(book), F.lit(" "), chapter.cast("string")), F.concat(F.lit("v"), verse.cast("string")), shown)
    return F.coalesce(link, shown)


def note_marker(book: Column, chapter: Column, source: Column, note_id: Column, symbol: Column, css: Column) -> Column:
    """A superscript link to a note in the source's companion."""
    return F.concat(F.lit('<sup class="'), css, F.lit('">[['), t.file_prefix(book), F.lit(" "), chapter.cast("string"), F.lit(" — "), source, F.lit(" Notes#^"), note_id, F.lit("|"), symbol, F.lit("]]</sup>"))


def split_ezra(chapter: Column) -> Column:
    """struct(book, chapter) of the joint book of Ezra and Nehemiah: the first ten chapters are Ezra's."""
    return F.when(chapter <= 10, F.struct(F.lit("Ezra").alias("book"), chapter.cast("int").alias("chapter"))).otherwise(F.struct(F.lit("Nehemiah").alias("book"), (chapter - 10).cast("int").alias("chapter")))


def named_book(c: Column, books: list[str]) -> Column:
    """The first book of the list that a heading names."""
    low = F.lower(c)
    return F.coalesce(*(F.when(low.contains(b.lower()), F.lit(b)) for b in books))


def repaired_controls(c: Column) -> Column:
    """Control codes that a PDF left: 0x18 stands for 2."""
    return F.translate(c, "\x18", "2")


def control_parts(c: Column) -> Column:
    """array of struct(code, text): notes joined by 0x04, each with its type prefix (tn, tc, sn, map)."""
    parts = F.filter(F.split(repaired_controls(c), "\x04"), lambda x: F.trim(x) != "")
    return F.transform(parts, lambda x: F.struct(F.nullif(F.regexp_extract(F.trim(x), r"^(tn|tc|sn|map)\b", 1), F.lit("")).alias("code"), F.trim(F.regexp_replace(x, r"^\s*(?:tn|tc|sn|map)\b\s*", "")).alias("text")))


def attribution(c: Column) -> Column:
    """struct(father, work) of ``Author. Work B#...``: the author ends at the first word with a full stop that is neither an initial nor a title; the title St. before the name is dropped."""
    words = F.split(F.trim(F.substring_index(t.collapsed(c), "B#", 1)), " ")
    stop = F.array_position(F.transform(words, lambda w: w.endswith(".") & (F.length(w) > 2) & ~F.rtrim(w, F.lit(".")).isin(TITLES)), True).cast("int")
    saint = F.lower(words[0]).isin("st.", "saint").cast("int")
    whole = (stop > 0) & (stop < F.size(words))
    author = F.array_join(F.slice(words, saint + 1, F.greatest(stop - saint, F.lit(0))), " ")
    work = F.array_join(F.slice(words, F.greatest(stop + 1, F.lit(1)), F.size(words)), " ")
    shown = lambda x: F.nullif(F.when(whole, F.rtrim(x, F.lit(" ."))), F.lit(""))
    return F.struct(shown(author).alias("father"), shown(work).alias("work"))


def work_reference(c: Column) -> Column:
    """struct(work, chapter, verse_start, verse_end, section) of ``Work on Book CHAPTER, v, v-v``, by its parts between commas: the first ends with the chapter, the others are verses; null otherwise."""
    parts = F.transform(F.split(c, ","), lambda p: F.trim(p))
    head = F.split(parts[0], r"\s+")
    on = F.array_position(F.transform(head, lambda w: F.lower(w)), "on").cast("int")
    chapter = t.from_roman(F.try_element_at(head, F.lit(-1)))
    verses = F.slice(parts, 2, 1_000_000)
    numbers = F.flatten(F.transform(verses, lambda p: F.transform(F.split(p, "-"), lambda n: F.trim(n).try_cast("int"))))
    fits = (on > 1) & (F.size(head) - on >= 2) & chapter.isNotNull() & ~F.exists(numbers, lambda n: n.isNull())
    work = F.concat_ws(" ", F.slice(head, 1, F.greatest(F.size(head) - 1, F.lit(0))), chapter.cast("string"))
    ends = (F.try_element_at(numbers, F.lit(i)) for i in (1, -1))
    return F.when(fits, F.struct(work.alias("work"), chapter.alias("chapter"), next(ends).alias("verse_start"), next(ends).alias("verse_end"), F.nullif(F.array_join(verses, ", "), F.lit("")).alias("section")))


def same_book_reference(c: Column, aliases: list[str]) -> Column:
    """struct(verse_start, verse_end) of the longest alias that the text cites with chapter and verse: what follows each mention of it is read as a reference, the first that is one counts."""
    found = []
    for alias in sorted(aliases, key=len, reverse=True):
        after = F.slice(F.split(F.lower(c), rf"(?<![\p{{L}}\p{{N}}]){re.escape(alias.lower())}(?:\.\s+|\s+)"), 2, 1_000_000)
        ref = F.filter(F.transform(after, t.reference), lambda r: r["verse"].isNotNull())
        first = F.try_element_at(ref, F.lit(1))
        found.append(F.when(first.isNotNull(), F.struct(first["verse"].alias("verse_start"), F.coalesce(first["verse_end"], first["verse"]).alias("verse_end"))))
    return F.coalesce(*found)


# Words of a calendar that stand over an excerpt, not in it.
CALENDAR = "WEEK SUNDAY MONDAY TUESDAY WEDNESDAY THURSDAY FRIDAY SATURDAY LITURGY MATINS TRIODION TRIODIAN PASCHA PENTECOST APPENDIX".split()
SIGLA = ["OGL)", "APE)", "OPA)", "CFW)", "OPE)"]


def context_header(line: Column) -> Column:
    """Whether a line names a week, feast or service, or carries the siglum of one."""
    words = F.split(F.upper(F.trim(line)), r"\s+")
    bare = F.transform(words, lambda w: F.regexp_replace(w, r"^\W+|\W+$", ""))
    lent = F.exists(F.zip_with(bare, F.slice(bare, 2, 1_000_000), lambda a, b: F.coalesce((a == "GREAT") & (b == "LENT"), F.lit(False))), lambda x: x)
    return F.arrays_overlap(bare, F.array(*map(F.lit, CALENDAR))) | lent | F.exists(words, lambda w: F.regexp_extract(w, r"[A-Z]+\)", 0).isin(SIGLA))


def title_line(line: Column) -> Column:
    """Whether a line can be an excerpt's title: ten letters or more, none of them small, and no context header."""
    return (F.length(F.regexp_replace(line, "[^A-Za-z]", "")) >= 10) & ~line.rlike(r"\p{Ll}") & ~context_header(line)


def from_title(c: Column) -> Column:
    """A body from its first title on; empty without one."""
    lines = F.split(c, "\n")
    place = F.array_position(F.transform(lines, title_line), True).cast("int")
    return F.when(place > 0, F.trim(F.array_join(F.slice(lines, place, F.size(lines)), "\n"))).otherwise("")


def labelled_notes(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys..., chapter, verse, content): notes displaced to a page's end, cut at their ``N.M`` or ``N.M-K`` labels."""
    label = r"\b(\d+\.\d+)(?:–\d+)?\s+"
    labels = F.regexp_extract_all(text, F.lit(label), F.lit(1))
    bodies = F.slice(F.split(text, label), 2, 100_000_000)
    rows = df.select(*keys, F.explode(F.arrays_zip(labels.alias("l"), bodies.alias("b"))).alias("s"))
    return rows.select(*keys, F.split_part("s.l", F.lit("."), F.lit(1)).cast("int").alias("chapter"), F.split_part("s.l", F.lit("."), F.lit(2)).cast("int").alias("verse"), F.regexp_replace(t.collapsed(F.col("s.b")), r"\.$", "").alias("content"))


def citing_texts(citations: DataFrame, verses: DataFrame) -> DataFrame:
    """Citations (document, d_chapter, d_verse, book, chapter, verse_start, verse_end) with the texts of the verses that make them, as excerpts on the cited chapter."""
    own = verses.select("document", F.col("chapter").alias("d_chapter"), F.col("verse").alias("d_verse"), "text")
    joined = citations.join(own, ["document", "d_chapter", "d_verse"])
    return joined.select("book", "chapter", F.col("document").alias("father"), F.concat(F.col("d_chapter").cast("string"), F.lit("."), F.col("d_verse").cast("string")).alias("work"), "verse_start", "verse_end", F.col("text").alias("content"))


def before_first(events: DataFrame, opens: Column) -> tuple[DataFrame, DataFrame]:
    """Events of each document before and from the first that ``opens``: introduction and text."""
    starts = events.filter(opens).groupBy("source", "path").agg(F.min(F.struct("spine_idx", "ev")).alias("__at"))
    marked = events.join(starts, ["source", "path"], "left")
    at = F.struct("spine_idx", "ev")
    before = F.col("__at").isNull() | (at < F.col("__at"))
    return marked.filter(before).drop("__at"), marked.filter(~before).drop("__at")


def body_boxes(boxes: DataFrame, note_size: float, note_top: float) -> DataFrame:
    """Boxes of each page above its notes: over the top of the highest small box in the page's foot."""
    cut = boxes.filter((F.col("sz") < note_size) & (F.col("y_top") < note_top)).groupBy("source", "page").agg(F.max("y_top").alias("__cut"))
    return boxes.join(cut, ["source", "page"], "left").filter(F.col("__cut").isNull() | (F.col("y_top") > F.col("__cut"))).drop("__cut")


# Titles of other editions and the canon's names.
OTHER_TITLES = {"1 Samuel": "I Kingdoms", "2 Samuel": "II Kingdoms", "1 Kings": "III Kingdoms", "2 Kings": "IV Kingdoms", "1 Chronicles": "I Chronicles", "2 Chronicles": "II Chronicles", "Song of Songs": "Song of Solomon"}


def canonical_title(c: Column) -> Column:
    """The canon's name of a title of another edition; other numbered titles get Roman numerals."""
    known = F.create_map(*(F.lit(x) for kv in OTHER_TITLES.items() for x in kv))[c]
    n = F.regexp_extract(c, r"^([1-4]) ", 1)
    numeral = F.create_map(*(F.lit(x) for kv in (("1", "I"), ("2", "II"), ("3", "III"), ("4", "IV")) for x in kv))[n]
    return F.coalesce(known, F.concat(numeral, F.lit(" "), F.regexp_replace(c, r"^[1-4] ", "")), c)
