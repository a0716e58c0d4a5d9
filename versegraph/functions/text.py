"""Text functions as column expressions. Patterns follow Java's syntax; ``(?U)`` makes classes Unicode-aware."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def collapsed(c: Column, spaces: str = r"(?U)\s+") -> Column:
    """Runs of whitespace as one space, trimmed."""
    return F.trim(F.regexp_replace(c, spaces, " "))


#: The three dialects of whitespace that sources need kept apart.
ALL_SPACE, BLANKS_NBSP, BLANKS = r"(?U)\s+", r"[ \t\x{a0}]+", r"[ \t]+"


def plain_marks(c: Column) -> Column:
    """No-break spaces as spaces, line ends as line feeds, low quotes as opening quotes."""
    return F.translate(F.regexp_replace(c, "\r\n?", "\n"), " „", " “")


def quoted_block(c: Column) -> Column:
    """Every line as a block quote; empty lines keep the bare mark."""
    return F.array_join(F.transform(F.split(c, "\n"), lambda x: F.when(x == "", F.lit(">")).otherwise(F.concat(F.lit("> "), x))), "\n")


def tight_marks(c: Column) -> Column:
    """No space before punctuation."""
    return F.regexp_replace(c, r"\s+([,;:.!?])", "$1")


def reference(c: Column) -> Column:
    """``C:V``, ``C:V-W`` (any dash) as struct(chapter, verse, verse_end); an end before the start is null."""
    pattern = r"^\s*(\d+):(\d+)(?:\s*[-–—]\s*(\d+))?"
    part = lambda i: F.expr("null").cast("int") if i is None else F.regexp_extract(c, pattern, i).try_cast("int")
    start, end = part(2), part(3)
    return F.struct(part(1).alias("chapter"), start.alias("verse"), F.when(end >= start, end).alias("verse_end"))


def heading_reference(c: Column) -> Column:
    """A heading's reference without a trailing letter; a range that goes backwards loses its end."""
    plain = F.regexp_replace(F.trim(c), r"(?<=[0-9])[a-z]$", "")
    ref = reference(plain)
    return F.when(ref["verse_end"].isNull(), F.regexp_replace(plain, r"\s*[-–—].*$", "")).otherwise(plain)


def from_roman(c: Column) -> Column:
    """The value of a Roman numeral or of plain digits; null for anything else."""
    digits = F.transform(F.split(F.upper(F.trim(c)), ""), lambda x: F.coalesce(_ROMAN_VALUES()[x], F.lit(0)))
    sums = F.aggregate(
        F.reverse(digits),
        F.struct(F.lit(0).alias("sum"), F.lit(0).alias("top")),
        lambda a, v: F.struct((a["sum"] + F.when(v < a["top"], -v).otherwise(v)).alias("sum"), F.greatest(a["top"], v).alias("top")),
    )["sum"]
    text = F.trim(c)
    return F.when(text.rlike(r"^\d+$"), text.try_cast("int")).when(F.upper(text).rlike("^[IVXLCDM]+$"), sums)


def _ROMAN_VALUES() -> Column:
    # fixed values
    return F.create_map(*(F.lit(x) for kv in (("I", 1), ("V", 5), ("X", 10), ("L", 50), ("C", 100), ("D", 500), ("M", 1000)) for x in kv))


def front_matter(pairs: dict[str, Column]) -> Column:
    """YAML front matter; null values leave their line out."""
    lines = [F.concat(F.lit(f"{k}: "), v.cast("string")) for k, v in pairs.items()]
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *lines), F.lit("\n---"))


def front_matter_of(c: Column) -> Column:
    """Map of the front matter's plain ``key: value`` lines; empty if the first line is not ``---``."""
    body = F.regexp_extract(c, r"(?s)^---\n(.*?)\n---(?:\n|$)", 1)
    pairs = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"^[A-Za-z_][\w-]*:"))
    return F.map_from_entries(F.array_distinct(F.transform(pairs, lambda x: F.struct(F.split_part(x, F.lit(":"), F.lit(1)).alias("k"), F.trim(F.regexp_replace(x, "^[^:]*:", "")).alias("v")))))


def body_of(c: Column) -> Column:
    """The text after the front matter."""
    return F.regexp_replace(c, r"(?s)^---\n.*?\n---(?:\n|$)", "")


def linked(c: Column, pattern: str, target: str) -> Column:
    """Every match of ``pattern`` as a wikilink, but for those inside brackets or words already."""
    return F.regexp_replace(c, rf"(?U)(?<![\w\[|#]){pattern}(?![\w\]|])", target)


def stripped_tags(c: Column) -> Column:
    """Text without ``<S>n</S>`` and with the content of other tags."""
    return collapsed(F.regexp_replace(F.regexp_replace(c, r"<S>[^<]*</S>", ""), r"</?[A-Za-z][^>]*>", ""))


def book_heading(c: Column) -> Column:
    """A heading in capitals without parentheses and the leading ``ACCORDING TO``."""
    return F.regexp_replace(F.upper(collapsed(F.regexp_replace(c, r"\([^)]*\)", " "))), "^ACCORDING TO ", "")


def letters_together(c: Column) -> Column:
    """Letter-spaced capitals closed up."""
    return F.regexp_replace(c, r"(?<=[A-Z]) (?=[A-Z])", "")


def file_prefix(book: Column) -> Column:
    """The name of a book in its chapters' file names."""
    return F.when(book == "Psalms", "Psalm").otherwise(book)


def book_of_prefix(prefix: Column) -> Column:
    """The inverse of ``file_prefix``."""
    return F.when(prefix == "Psalm", "Psalms").otherwise(prefix)


def wikilink(file: Column, anchor: Column | None = None, label: Column | None = None) -> Column:
    """``[[file#anchor|label]]``; null parts are left out."""
    a = F.coalesce(F.concat(F.lit("#"), anchor), F.lit("")) if anchor is not None else F.lit("")
    b = F.coalesce(F.concat(F.lit("|"), label), F.lit("")) if label is not None else F.lit("")
    return F.concat(F.lit("[["), file, a, b, F.lit("]]"))


def psalm_in_mt(lxx: Column) -> Column:
    """Hebrew number of a Greek psalm; 151 has none."""
    n = lxx
    return (
        F.when(n.between(1, 9) | n.between(148, 150), n)
        .when(n.between(10, 112) | n.between(116, 145), n + 1)
        .when(n == 113, 114)
        .when(n.isin(114, 115), 116)
        .when(n.isin(146, 147), 147)
    )


# Last psalm of each stasis, in order; kathisma 17 is Psalm 118 alone.
STASIS_ENDS = [3, 6, 8, 10, 13, 16, 17, 20, 23, 26, 29, 31, 33, 35, 36, 39, 42, 45, 48, 50, 54, 57, 60, 63, 66, 67, 69, 71, 73, 76, 77, 80, 84, 87, 88, 90, 93, 96, 100, 102, 103, 104, 105, 106, 108, 111, 114, 117, 123, 128, 133, 136, 139, 142, 144, 147, 150]


def kathisma(psalm: Column) -> Column:
    """struct(kathisma, stasis) of a Greek psalm; stasis 0 in Psalm 118, null outside 1-150."""
    ends = F.array(*map(F.lit, STASIS_ENDS))
    place = F.size(F.filter(ends, lambda e: e < psalm))
    group = (place / 3).cast("int") + 1
    number = F.when(psalm == 118, 17).when(psalm.between(1, 150), F.when(group >= 17, group + 1).otherwise(group))
    return F.when(number.isNotNull(), F.struct(number.cast("int").alias("kathisma"), F.when(psalm == 118, 0).otherwise(place % 3 + 1).cast("int").alias("stasis")))


# What a scan of one anthology reads, and what stands there, in the order of the repairs.
SCAN_REPAIRS = [("B¥", "B#"), ("begotton", "begotten"), ("DOVETING", "DOUBTING"), ("Jobn", "John"), ("Hom-bom ilies", "Homilies"), ("Dis-Ii courses", "Discourses"), ("Hea ABA!", ""), ("k Myst. Cat.II,", "Myst. Cat.II,"), ("sce", "see"), ("seck", "seek"), ("Velimirovíć", "Velimirovic"), ("Velimirović", "Velimirovic")]
#: Characters that only a scan puts there.
SCAN_MARKS = "|{}@=£$"


def scan_repaired(c: Column) -> Column:
    """A scanned text without stray marks, with known misreadings put right as whole words, and with words broken by a mark and a space put together (a stray letter between the halves is dropped)."""
    out = F.translate(c, SCAN_MARKS, " " * len(SCAN_MARKS))
    for seen, right in SCAN_REPAIRS:
        spaced = r"\s*".join(re.escape(w) for w in seen.replace("-", "- ").split())
        out = F.regexp_replace(out, rf"(?iU)(?<!\w){spaced}(?!\w)" if seen != seen.upper() else rf"(?U)(?<!\w){spaced}(?!\w)", right)
    halves = r"(?<=[A-Za-z]{2})-\s+(?:[A-Za-z]\s+)?(?=[A-Za-z]{2})"
    return F.regexp_replace(F.regexp_replace(out, halves, ""), " {2,}", " ")


def inline_fragments(c: Column) -> Column:
    """array of struct(verse, text): a text cut at the verse numbers that stand directly before a letter (``18text``); what stands before the first has a null verse."""
    cut = F.split(F.regexp_replace(c, r"(?<!\d)(\d+)(?=\p{L})", "\x00$1\x01"), "\x00")
    parts = F.transform(cut, lambda p: F.struct(F.when(p.contains("\x01"), F.split_part(p, F.lit("\x01"), F.lit(1))).try_cast("int").alias("verse"), F.trim(F.split_part(p, F.lit("\x01"), F.lit(-1))).alias("text")))
    return F.filter(parts, lambda x: x["verse"].isNotNull() | (x["text"] != ""))
