"""Problem 3: texts that look the same but differ in their characters.

Every text is brought to one form:

1. characters without width go (a soft hyphen stays before a line end, where it shows); odd spaces become the ordinary one,
   hyphens that look alike the ASCII one, full-width forms their ASCII characters, Latin ligatures their letters;
2. each token's letters are resolved: a letter's script set holds every script that has a letter of its look, and the sets
   of a token are intersected. Latin is taken if the intersection has it (so mixed-script tokens and whole-script
   confusables are spelt in Latin), else Greek, else Cyrillic; the token is spelt in that script. A token without a common script keeps
   its letters but for those with a Latin look-alike, so that equal looks stay equal;
3. the rest is composed (NFC). Superscripts, fractions and other compatibility characters look different and stay.

Pairs are found by the 128-bit digest of that form. Copies are one class: classes of one form are paired, not records,
and records join only the pairs of their class, so the work is the size of the result even if a third of all records repeat
one refrain.

Defined results: null texts have no form and no pairs; empty texts are equal to each other as stored, hence no pair, but
an empty text and one of invisible characters look the same; a line feed is not a space; several deliveries of one key count
as one record; extra columns are ignored; texts are treated whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.session import stored, table
from .lookalikes import CYRILLIC, GREEK, HYPHENS, INVISIBLE, SPACES, compatible, fullwidth

# Latin ligatures and their letters.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}

_PLAIN = str.maketrans(dict.fromkeys(INVISIBLE.replace("­", ""), "") | dict.fromkeys(SPACES, " ") | dict.fromkeys(HYPHENS, "-") | fullwidth() | compatible() | LIGATURES)
_SOFT = re.compile(r"­(?!\s*(?:\n|$))")
#: Texts without any of these are left alone: ASCII, composed Latin letters, and marks that have no look-alike.
_SUSPECT = re.compile(r"[^\x00-\x9f¡-¬®-ʯ—–‘’“”•…]")
_TOKEN = re.compile(r"[^\W\d_]+(?:[̀-ͯ]+[^\W\d_]*)*")

LATIN, GREEK_SCRIPT, CYRILLIC_SCRIPT = 1, 2, 4
_CYRILLIC = {k: v for k, v in CYRILLIC.items() if v.isalpha()}


def _tables() -> tuple[dict[str, int], dict[int, dict[int, str]]]:
    """Script set of each look-alike letter, and for each script the translation into it."""
    to_greek = {v: k for k, v in GREEK.items()}
    to_cyrillic = {v: k for k, v in _CYRILLIC.items()}
    sets: dict[str, int] = {}
    into: dict[int, dict[int, str]] = {LATIN: {}, GREEK_SCRIPT: {}, CYRILLIC_SCRIPT: {}}
    for look in sorted({*GREEK.values(), *_CYRILLIC.values()}):
        members = [look, *(k for k, v in GREEK.items() if v == look), *(k for k, v in _CYRILLIC.items() if v == look)]
        scripts = LATIN | GREEK_SCRIPT * (look in to_greek) | CYRILLIC_SCRIPT * (look in to_cyrillic)
        for m in members:
            sets[m] = scripts
            into[LATIN][ord(m)] = look
            into[GREEK_SCRIPT][ord(m)] = to_greek.get(look, m)
            into[CYRILLIC_SCRIPT][ord(m)] = to_cyrillic.get(look, m)
    return sets, into


_SETS, _INTO = _tables()
_OWN: dict[str, int] = {}


def scripts(c: str) -> int:
    """Scripts that have a letter of the look of ``c``; 0 for letters of other scripts, which agree with none."""
    if c not in _OWN:
        base = unicodedata.normalize("NFD", c)[0]
        if base in _SETS and base == c:
            _OWN[c] = _SETS[c]
        elif unicodedata.combining(c):
            _OWN[c] = LATIN | GREEK_SCRIPT | CYRILLIC_SCRIPT
        else:
            name = unicodedata.name(base, "")
            _OWN[c] = LATIN * name.startswith("LATIN") | GREEK_SCRIPT * name.startswith("GREEK") | CYRILLIC_SCRIPT * name.startswith("CYRILLIC")
    return _OWN[c]


def resolved(token: str) -> tuple[str, str]:
    """The token in its consistent script, and what it was: '', 'mixed' or 'whole' (another script spelt all of a Latin look)."""
    if token.isascii():
        return token, ""
    own = {"L" if unicodedata.name(c, "").startswith("LATIN") else "G" if unicodedata.name(c, "").startswith("GREEK") else "C" for c in token if c.isalpha()}
    if own == {"L"}:
        return token, ""
    common = LATIN | GREEK_SCRIPT | CYRILLIC_SCRIPT
    for c in token:
        common &= scripts(c)
    for script in (LATIN, GREEK_SCRIPT, CYRILLIC_SCRIPT):
        if common & script:
            out = token.translate(_INTO[script])
            return out, "" if out == token else "mixed" if len(own) > 1 else "whole"
    return token.translate(_INTO[LATIN]), "mixed"


def form(text: str) -> tuple[str, str]:
    """The one form of ``text`` and the kinds of difference, joined with commas."""
    if not _SUSPECT.search(text):
        return text, ""
    kinds = []
    soft = _SOFT.sub("", text)
    plain = soft.translate(_PLAIN)
    if plain != text:
        kinds += ["width"] * any("！" <= c <= "～" for c in text) + ["space"] * any(c in SPACES for c in text) + ["invisible"] * (soft != text or any(c in INVISIBLE for c in text))
        kinds += ["ligature"] * any(c in LIGATURES for c in text) + ["hyphen"] * any(c in HYPHENS for c in text)
    seen = set()

    def spell(m: re.Match) -> str:
        out, what = resolved(m.group())
        seen.add(what)
        return out

    spelt = _TOKEN.sub(spell, plain)
    kinds += ["mixed_script"] * ("mixed" in seen) + ["whole_script"] * ("whole" in seen)
    composed = unicodedata.normalize("NFC", spelt)
    kinds += ["accent"] * (composed != spelt)
    return composed, ",".join(kinds)


def _records(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).filter("k is not null and t is not null")


def digests(df: DataFrame, key: str, text: str) -> DataFrame:
    """(k, h, l, raw): digest of the form in two halves, and of the text as stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms, raws = [], []
            for t in batch.column(1).to_pylist():
                raw = t.encode("utf-8", "surrogatepass")
                f, _ = form(t)
                raws.append(xxhash.xxh3_64_intdigest(raw))
                forms.append(xxhash.xxh3_128_digest(raw if f is t else f.encode("utf-8", "surrogatepass")))
            halves = np.frombuffer(b"".join(forms), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.ascontiguousarray(halves[:, 0])), pa.array(np.ascontiguousarray(halves[:, 1])), pa.array(np.array(raws, np.uint64).view(np.int64))], ["k", "h", "l", "raw"])

    return _records(df, key, text).mapInArrow(run, "k long, h long, l long, raw long")


FORM = ["h", "l"]


def _several(rows: DataFrame) -> DataFrame:
    """Rows of forms that are stored in several ways; partial minima and maxima keep hot forms small."""
    forms = rows.groupBy(*FORM).agg(F.min("raw").alias("a"), F.max("raw").alias("b")).filter("a <> b").select(*FORM)
    return rows.join(forms, FORM, "left_semi").distinct()


def lookalike_pairs(df: DataFrame, key: str, text: str) -> DataFrame:
    """(a, b): keys, the smaller first, whose texts differ as stored and have one form."""
    rows = stored(_several(stored(digests(df, key, text), "digests")), "lookalikes")
    classes = rows.select(*FORM, "raw").distinct()
    pairs = classes.withColumnRenamed("raw", "ra").join(classes.withColumnRenamed("raw", "rb"), FORM).filter("ra < rb")
    left = pairs.join(rows.select(*FORM, F.col("raw").alias("ra"), F.col("k").alias("ka")), [*FORM, "ra"])
    both = left.join(rows.select(*FORM, F.col("raw").alias("rb"), F.col("k").alias("kb")), [*FORM, "rb"])
    return both.filter("ka <> kb").select(F.least("ka", "kb").alias("a"), F.greatest("ka", "kb").alias("b"))


def normalized(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, form, kinds) of each distinct record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [form(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f for f, _ in both], pa.string()), pa.array([k for _, k in both], pa.string())], ["k", "form", "kinds"])

    return _records(df, key, text).mapInArrow(run, "k long, form string, kinds string").withColumnRenamed("k", key)


def _verses(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "verses").select("verse_id", "text")


def found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of verses that look the same."""
    return lookalike_pairs(_verses(spark, d), "verse_id", "text").select(F.col("a").alias("verse_id_a"), F.col("b").alias("verse_id_b")).distinct()


def forms_query(spark: SparkSession, d: str) -> DataFrame:
    """The one form of every verse that is stored otherwise, and how it differed."""
    return normalized(_verses(spark, d), "verse_id", "text").filter("kinds <> ''").distinct()


def classes_query(spark: SparkSession, d: str) -> DataFrame:
    """For each verse with look-alikes its class (the smallest verse_id) and the number of its stored forms."""
    rows = _several(stored(digests(_verses(spark, d), "verse_id", "text"), "digests"))
    sizes = rows.groupBy(*FORM).agg(F.min("k").alias("class_id"), F.countDistinct("raw").alias("n_forms"))
    return rows.select("k", *FORM).distinct().join(sizes, FORM).select(F.col("k").alias("verse_id"), "class_id", "n_forms")


queries = {"p3_found": found, "p3_forms": forms_query, "p3_classes": classes_query}


def _oracle(tail: str) -> str:
    """Every look-alike spelt in Latin, whatever its token: the same pairs unless two tokens differ in script alone."""
    pairs = GREEK | _CYRILLIC | {k: v for k, v in fullwidth().items() if v not in "'\\"} | dict.fromkeys(SPACES, " ") | dict.fromkeys(HYPHENS, "-")
    keys = sorted(pairs)
    invisible = INVISIBLE.replace("­", "")
    plain = f"translate(regexp_replace(text, '­(\\s*[^\\s\\n])', '\\1', 'g'), '{''.join(keys)}{invisible}', '{''.join(pairs[k] for k in keys)}')"
    for k, v in LIGATURES.items():
        plain = f"replace({plain}, '{k}', '{v}')"
    return f"""WITH v AS (SELECT DISTINCT verse_id, text, nfc_normalize({plain}) AS form FROM verses WHERE text IS NOT NULL),
s AS (SELECT form, min(verse_id) AS class_id, count(DISTINCT text) AS n_forms FROM v GROUP BY form HAVING count(DISTINCT text) > 1)
{tail}"""


oracles = {
    "p3_found": _oracle("SELECT DISTINCT a.verse_id AS verse_id_a, b.verse_id AS verse_id_b FROM v a JOIN v b ON a.form = b.form AND a.verse_id < b.verse_id AND a.text <> b.text"),
    "p3_classes": _oracle("SELECT DISTINCT verse_id, class_id, n_forms FROM v JOIN s USING (form)"),
}
