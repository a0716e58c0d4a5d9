"""First-match classifiers as CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.relational import first_match

# Names that open a cross-reference.
OLD_NAMES = "Genesis Exodus Leviticus Numbers Deuteronomy Joshua Judges Ruth Samuel Kings Chronicles Ezra Nehemiah Tobit Judith Esther Maccabees Job Psalm Proverb Ecclesiastes Song Wisdom Sirach Isaias Isaiah Jeremiah Lamentations Baruch Ezekiel Daniel Hosea Joel Amos Obadiah Jonah Micah Nahum Habakkuk Zephaniah Haggai Zechariah Malachi".split()
NEW_NAMES = "Matthew Mark Luke John Acts Romans Corinthians Galatians Ephesians Philippians Colossians Thessalonians Timothy Titus Philemon Hebrews James Peter Jude Revelation".split()

# How notes of each type begin, in order of precedence. An opening is a row of words in lower case: a slash parts
# alternatives, ``~`` stands for a word's end with or without marks after it, ``*`` for any rest of a word, ``_`` for any word, ``@`` for one that begins with a letter.
STUDY_OPENINGS = [
    ("variant", ["ct/tr/pt read*/omit*/add*/has~/end*/include*/refer*", "other/some/several/many/most manuscripts~", "a few manuscripts~", "other ancient _", "nt agrees with~"]),
    ("alternative", ["or _", "lit. _", "literally _", "other translation/translations _", "also translated _"]),
    ("translator_note", ["greek _", "the greek _"]),
    ("cross_reference", ["see/compare/cf. !appendix~", "/".join(f"{n.lower()}~" for n in OLD_NAMES + NEW_NAMES)]),
    ("citation", ["st./saint @", "according to st./saint @", "st./saint _ say*/write*/interpret*/comment*/note*/explain*"]),
    ("background_note", ["in ancient*/early*/biblical*", "in the ancient*/early*/biblical*", "in first century*", "in the first century*", "the _ river/sea/mountain/city/province/region/desert was~"]),
]
TRANSLATION_OPENINGS = [
    ("variant", ["some/other manuscripts*", "other mss*"]),
    ("alternative", ["or/or,*", "lit. _", "literally _", "i.e.*"]),
    ("cross_reference", ["see/compare/cf. _", "/".join(f"{n.lower()}~" for n in OLD_NAMES)]),
]
# What a note about a place says, wherever it stands.
PLACES = ["city", "town", "region", "river", "sea", "mountain", "province", "area", "place"]
# Note codes, file names and inline markers.
CODE_TYPES = {"tn": "translator_note", "tc": "variant", "sn": "footnote", "map": "background_note"}
#: In print a map's code marks a cross-reference.
PRINTED_CODE_TYPES = CODE_TYPES | {"map": "cross_reference"}
FILE_TYPES = {"variant.html": "variant", "x-liturgical.html": "liturgical", "citation.html": "citation", "alternative.html": "alternative", "translation.html": "translator_note", "background.html": "background_note", "crossReference.html": "cross_reference"}
MARKERS = {"footnote": ("†", "nt-fn"), "variant": ("‡", "nt-tc"), "liturgical": ("☩", "nt-lit"), "citation": ("¶", "nt-cit"), "alternative": ("⁺", "nt-alt"), "translator_note": ("*", "nt-tn"), "background_note": ("◦", "nt-bg"), "cross_reference": ("§", "nt-cross")}
CODE_PRECEDENCE = ["tc", "tn", "sn"]
# The Fathers, the names and sigla they are cited by, and the work meant where none is named.
FATHERS = {"John Chrysostom": ["john chrysostom", "johnchr"], "Theophylact of Ohrid": ["theophylact", "theoph"], "Ambrose of Milan": ["ambrose", "ambm"], "Irenaeus of Lyons": ["irenaeus", "iren"]}
WORKS = {"John Chrysostom": "Homilies on ", "Theophylact of Ohrid": "Commentary on ", "Ambrose of Milan": "Commentary on ", "Irenaeus of Lyons": "Against Heresies"}
# Stems by which a work is liturgical or a homily.
GENRES = [("liturgical", ["stichera", "tropar", "liturgy", "prayer ", "canon"]), ("homily", ["homily", "homilies"])]
TITLES = ["St", "Rev", "Bp", "Dr"]
ORDINALS = ["ONE", "TWO", "THREE", "FOUR", "FIVE", "SIX", "SEVEN", "EIGHT", "NINE", "TEN", "ELEVEN", "TWELVE", "THIRTEEN", "FOURTEEN", "FIFTEEN", "SIXTEEN", "SEVENTEEN", "EIGHTEEN", "NINETEEN", "TWENTY"]
PARTS = [(1, 25, "Visions"), (26, 49, "Commandments"), (50, 114, "Parables")]
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
READINGS = {"ep": "Epistle", "go": "Gospel"}


def _fits(word: Column, slot: str) -> Column:
    """Whether a word (null past the end) is one of the alternatives of a slot."""
    if slot == "_":
        return F.coalesce(word != "", F.lit(False))
    if slot == "@":
        return F.coalesce(word.rlike("^[a-z]"), F.lit(False))
    if slot.startswith("!"):
        return F.coalesce((word != "") & ~_fits(word, slot[1:]), F.lit(False))
    exact, ends, stems = [], [], []
    for x in slot.split("/"):
        (ends if x.endswith("~") else stems if x.endswith("*") else exact).append(x.rstrip("~*"))
    # the word up to its first mark
    bare = F.regexp_extract(word, r"^\w*", 0)
    out = word.isin(exact) | bare.isin(ends)
    for stem in stems:
        out = out | word.startswith(stem)
    return F.coalesce(out, F.lit(False))


def _opens(c: Column, openings: list[str]) -> Column:
    """Whether a text begins with one of the openings, compared word by word."""
    words = F.split(F.lower(c), r"\s+")
    any_of = F.lit(False)
    for opening in openings:
        whole = F.lit(True)
        for i, slot in enumerate(opening.split(" ")):
            whole = whole & _fits(F.try_element_at(words, F.lit(i + 1)), slot)
        any_of = any_of | whole
    return any_of


def _spoken(c: Column) -> Column:
    """The words in lower case between single spaces, with one before and after."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))


def _typed(c: Column, table: list[tuple[str, list[str]]], more: dict[str, Column], default: str) -> Column:
    return first_match([(_opens(c, openings) | more[label] if label in more else _opens(c, openings), label) for label, openings in table], default)


def study_note_type(c: Column) -> Column:
    """Type of a study note by its opening, its ``[N]`` label aside; a note that says somewhere that something was a place is about the background."""
    body = F.regexp_replace(c, r"^\[\d+\w*\]\s*", "")
    about = F.lit(False)
    for article in ("a", "an", "the"):
        for place in PLACES:
            about = about | _spoken(body).contains(f" was {article} {place} ")
    return _typed(body, STUDY_OPENINGS, {"background_note": about}, "footnote")


def translation_note_type(c: Column) -> Column:
    """Type of a translator's note by its opening."""
    return _typed(c, TRANSLATION_OPENINGS, {}, "translator_note")


def _looked_up(c: Column, table: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in table.items() for x in kv))[c]


def code_type(c: Column, printed: bool = False) -> Column:
    """Type of a note code; null for unknown codes."""
    return _looked_up(c, PRINTED_CODE_TYPES if printed else CODE_TYPES)


def file_type(c: Column) -> Column:
    return F.coalesce(_looked_up(c, FILE_TYPES), F.lit("footnote"))


def marker(kind: Column) -> Column:
    """``<sup class=...>symbol</sup>`` of a note type."""
    symbol, css = _looked_up(kind, {k: v[0] for k, v in MARKERS.items()}), _looked_up(kind, {k: v[1] for k, v in MARKERS.items()})
    return F.concat(F.lit('<sup class="'), css, F.lit('">'), symbol, F.lit("</sup>"))


def father(c: Column) -> Column:
    """The first Father, in the list's order, whom a note names; null without one."""
    said = _spoken(c)
    named = [F.when(F.greatest(*(said.contains(f" {n} ") for n in [*names, "\0"])), F.lit(who)) for who, names in FATHERS.items()]
    return F.coalesce(*named)


def attributed(c: Column, book: Column) -> Column:
    """struct(father, work) of a note on a book: the Father it names, and his work on that book; null without one."""
    who = father(c)
    work = _looked_up(who, WORKS)
    return F.when(who.isNotNull(), F.struct(who.alias("father"), F.when(work.endswith(" "), F.concat(work, book)).otherwise(work).alias("work")))


def patristic_type(c: Column) -> Column:
    """Genre by the first stem list of which the text has one; commentary by default."""
    return first_match([(F.exists(F.array(*map(F.lit, stems)), lambda s: F.lower(c).contains(s)), genre) for genre, stems in GENRES], "commentary")


def plausible_author(c: Column) -> Column:
    """Whether a text can be a name: up to 12 words in up to 80 characters, one of them capitalised, none with a digit, the last no title."""
    words = F.filter(F.split(F.regexp_replace(c, r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")
    name = F.exists(words, lambda w: w.rlike(r"^\p{Lu}")) & ~F.exists(words, lambda w: w.rlike(r"\d"))
    return F.coalesce(F.size(words).between(1, 12) & (F.length(F.trim(c)) <= 80) & name & ~F.try_element_at(words, F.lit(-1)).isin(TITLES), F.lit(False))


def ordinal(c: Column) -> Column:
    """``TWENTY-ONE`` -> 21; null for other words."""
    word = F.upper(F.trim(c))
    table = F.array(*map(F.lit, ORDINALS))
    unit = F.array_position(table, F.regexp_replace(word, "^TWENTY-", ""))
    return F.nullif(F.when(word.startswith("TWENTY-"), F.when(unit.between(1, 8), unit + 20).otherwise(0)).otherwise(unit).cast("int"), F.lit(0))


def part_of_sequence(seq: Column) -> Column:
    """struct(part, number) of a sequential chapter of a work in three parts; null outside 1-114."""
    out = F.lit(None)
    for first, last, name in reversed(PARTS):
        out = F.when(seq.between(first, last), F.struct(F.lit(name).alias("part"), (seq - first + 1).cast("int").alias("number"))).otherwise(out)
    return out


def month(c: Column) -> Column:
    """``m08`` -> August; the code itself if unknown."""
    n = F.regexp_extract(c, "^m(\\d{2})$", 1).try_cast("int")
    return F.coalesce(F.try_element_at(F.array(*map(F.lit, MONTHS)), F.when(n > 0, n)), c)


def reading_type(c: Column) -> Column:
    return F.coalesce(_looked_up(c, READINGS), c)


def opening_sql(words: str, openings: list[str]) -> str:
    """``_opens`` in DuckDB's SQL over a list of words; for the queries' oracles."""

    def fits(i: int, slot: str) -> str:
        w = f"coalesce({words}[{i + 1}], '')"
        if slot == "_":
            return f"{w} <> ''"
        if slot == "@":
            return f"regexp_matches({w}, '^[a-z]')"
        if slot.startswith("!"):
            return f"({w} <> '' AND NOT {fits(i, slot[1:])})"
        return f"regexp_matches({w}, '^(?:" + "|".join(x[:-1] + r"(?:\W|$)" if x[-1] == "~" else x[:-1].replace(".", "[.]") if x[-1] == "*" else x.replace(".", "[.]") + "$" for x in slot.split("/")) + ")')"

    return "(" + " OR ".join("(" + " AND ".join(fits(i, slot) for i, slot in enumerate(o.split(" "))) + ")" for o in openings) + ")"


def page_box(x: Column, y_top: Column, size: Column, text: Column, width: Column) -> Column:
    """Class of a page box by size, place and text."""
    t = F.trim(F.regexp_replace(text, r"\s+", " "))
    return first_match(
        [
            (text.isNull(), "empty"),
            (size >= 15, "verse"),
            (t.rlike(r"^(?:Page )?[-\[·]? ?(?:[0-9l]{1,4}|[ivxlc]+) ?[-\]·]?$") & (y_top < 50), "page_num"),
            (y_top > 560, "header"),
            (size < 6.2, "superscript"),
            ((y_top < 70) & (size < 8), "footnote"),
            ((size < 8.8) & (size >= 8), "pericope"),
        ],
        "verse",
    )
