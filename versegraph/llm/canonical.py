"""Problem 2: freely typed values mapped to a canonical list, by a partition-based pigeonhole join. SQL only.

A value within k edits of a reference string leaves at least one of the string's k + 1 segments whole, so segments joined by
equality on (length of the reference, segment number, substring) find every pair that the built-in ``levenshtein`` then
verifies; whatever no stage resolves comes out by an anti-join as ``UNMATCHED``.

Stages, over the distinct values only: (1) equal after normalisation (look-alike letters, invisible characters, case,
"Book of", numerals in every style, letters misread as digits), to a name, abbreviation or alternative title; (2) a unique
beginning of at least five letters; (3) the pigeonhole join on names and alternative titles, with k by the reference's length. The
numeral of a series must agree in every stage (only a title whose ordinal tells nothing apart is also looked up whole). The best distance wins; two books at the best distance, or a beginning of
several books, mean no book: the value is unmatched.

The canon is a fixed table: its strings, beginnings and segments are broadcast only if it has at most ``MOST_ROWS`` forms;
beyond that the same joins shuffle. Distinct values are joined back to the records by value, which the skew join of
adaptive execution splits if one value fills a third of the rows.

Defined results: null values are not mapped and give no row; values that equal a canonical name exactly are left out of
``p2_found`` and map to themselves in ``p2_mapping``; empty or blank values, and all values if the canon is empty, are
unmatched; values longer than the longest canonical string and its edits can only match exactly;
repeated records give one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.session import checkpointed, table
from .lookalikes import INVISIBLE, to_latin

MOST_ROWS = 10_000
UNMATCHED = "UNMATCHED"
#: Greatest number of edits by the length of a reference string: (least length, k).
EDITS = [(12, 4), (9, 3), (6, 2), (5, 1)]
LEAST_PREFIX = 5

# Words and styles of numerals.
ORDINALS = {"first": 1, "second": 2, "third": 3, "fourth": 4}


def slips(word: str) -> list[str]:
    """``word`` and its forms with one letter lost or doubled, or two neighbours swapped."""
    out = {word} | {word[:i] + word[i + 1 :] for i in range(len(word))} | {word[:i] + word[i] + word[i:] for i in range(len(word))}
    return sorted(out | {word[:i] + word[i + 1] + word[i] + word[i + 2 :] for i in range(len(word) - 1)})


WORDS = "|".join(s for w in ORDINALS for s in slips(w))
NUMERAL = WORDS + "|[1-4](?:st|nd|rd|th)?|[il1][il1]?[il1]?|[il1]v"


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "''") + "'"


def normal_forms(source: str, value: str, duck: bool = False) -> str:
    """SQL (without braces, which ``spark.sql`` would read as names): ``source`` with num (0: none), name (letters of the value without the numeral) and raw (with it)."""
    q = (lambda s: "'" + s.replace("'", "''") + "'") if duck else (lambda s: "r'" + s.replace("'", "''") + "'")
    g = ", 'g'" if duck else ""
    ref = (lambda n: f"\\{n}") if duck else (lambda n: f"${n}")
    pairs = to_latin()
    pairs.pop("'", None)
    keys = sorted(k for k in pairs if pairs[k].isalnum() or pairs[k] in " .,:()-")
    look, latin = "".join(keys) + INVISIBLE, "".join(pairs[k] for k in keys)
    sub = lambda e, pattern, to: f"regexp_replace({e}, {q(pattern)}, {q(to)}{g})"
    plain = f"lower(translate({value}, '{look}', '{latin}'))"
    plain = sub(plain, r"\([^)]*\)", " ")
    plain = sub(plain, r"[\s]+ch[.]?[\s]*$", "")
    plain = sub(plain, r"^[\s]*(?:the book of|book of|liber)[\s]+", "")
    plain = sub(plain, r"^[\s]*(.*?),[\s]*(" + WORDS + r") book of[\s.:]*$", f"{ref(2)} {ref(1)}")
    plain = f"trim({sub(plain, r'[^a-z0-9]+', ' ')})"
    plain = sub(plain, r"^([1-4](?:st|nd|rd|th)?)([a-z][a-z][a-z])", f"{ref(1)} {ref(2)}")
    letters = lambda e: f"replace(replace(translate({e}, '015 ', 'ols'), 'rn', 'm'), 'vv', 'w')"
    head, tail = f"^({NUMERAL}) +(.+)$", f"^(.*[a-z][a-z][a-z].*?) +({NUMERAL})$"
    style = f"CASE WHEN {_matches('plain', head, duck)} THEN regexp_extract(plain, {q(head)}, 1) WHEN {_matches('plain', tail, duck)} THEN regexp_extract(plain, {q(tail)}, 2) ELSE '' END"
    rest = f"CASE WHEN {_matches('plain', head, duck)} THEN regexp_extract(plain, {q(head)}, 2) WHEN {_matches('plain', tail, duck)} THEN regexp_extract(plain, {q(tail)}, 1) ELSE plain END"
    words = " ".join(f"WHEN style IN ({', '.join(repr(x) for x in slips(w))}) THEN {n}" for w, n in ORDINALS.items())
    number = f"CASE {words} WHEN style = '' THEN 0 WHEN {_matches('style', '^[2-4]', duck)} THEN CAST(substr(style, 1, 1) AS INT) WHEN {_matches('style', '^1(st)?$', duck)} THEN 1 WHEN {_matches('style', 'v$', duck)} THEN 4 ELSE CAST(length(style) AS INT) END"
    return f"""(SELECT *, {number} AS num, {letters('rest')} AS name, {letters('plain')} AS raw FROM (
      SELECT *, {style} AS style, {rest} AS rest FROM (SELECT *, {plain} AS plain FROM {source})))"""


def _matches(e: str, pattern: str, duck: bool) -> str:
    return f"regexp_matches({e}, '{pattern}')" if duck else f"({e} RLIKE r'{pattern}')"


def edits(length: str) -> str:
    return "CASE " + " ".join(f"WHEN {length} >= {n} THEN {k}" for n, k in EDITS) + " ELSE 0 END"


def mapping(values: DataFrame, canon: DataFrame) -> DataFrame:
    """(value, book, stage) for each distinct non-null ``values.value``; canon has book, abbreviation and alt_title."""
    spark = values.sparkSession
    run = lambda sql, **views: spark.sql(sql, **views)
    value = run("SELECT DISTINCT value FROM {values} WHERE value IS NOT NULL", values=values)
    # a checkpoint, since filters pushed into these expressions would outgrow the limit of generated code
    forms = checkpointed(run(f"SELECT value, num, name, raw FROM {normal_forms('{value}', 'value')}", value=value))
    typed = run(
        """SELECT DISTINCT book, s, full FROM {canon} LATERAL VIEW explode(array(
             named_struct('s', book, 'full', true), named_struct('s', alt_title, 'full', true), named_struct('s', abbreviation, 'full', false))) t AS e
           LATERAL VIEW explode(array(e.s)) u AS s LATERAL VIEW explode(array(e.full)) w AS full WHERE s IS NOT NULL AND book IS NOT NULL""",
        canon=canon,
    )
    refs = checkpointed(run(f"SELECT DISTINCT book, num, name, raw, full FROM {normal_forms('{typed}', 's')}", typed=typed))
    # at most 2 strings a row, a beginning a letter and 5 segments a string: what follows from a few rows stays few
    few = refs.limit(MOST_ROWS + 1).count() <= MOST_ROWS
    small = F.broadcast if few else lambda df: df
    strings = small(run("SELECT num, name AS s, book, full FROM {refs} WHERE name <> '' UNION SELECT 0, raw, book, full FROM {refs} WHERE name IN (SELECT name FROM {refs} GROUP BY name HAVING count(DISTINCT num) = 1) AND name <> ''", refs=refs))
    # a value is looked up with its numeral taken off and, as a whole, without one
    keys = run("SELECT DISTINCT value, k.num, k.s FROM {forms} LATERAL VIEW explode(array(named_struct('num', num, 's', name), named_struct('num', 0, 's', raw))) t AS k WHERE k.s <> ''", forms=forms)
    exact = checkpointed(run(
        "SELECT k.value, min(r.book) AS book, count(DISTINCT r.book) AS n, 'equal' AS stage FROM {keys} k JOIN {strings} r ON k.num = r.num AND k.s = r.s GROUP BY k.value",
        keys=keys, strings=strings,
    ))
    left = run("SELECT k.* FROM {keys} k LEFT ANTI JOIN {exact} e ON k.value = e.value", keys=keys, exact=exact)
    heads = small(run(f"SELECT DISTINCT num, substr(s, 1, n) AS head, book FROM {{strings}} LATERAL VIEW explode(sequence({LEAST_PREFIX}, greatest({LEAST_PREFIX}, length(s)))) t AS n WHERE full AND length(s) > {LEAST_PREFIX}", strings=strings))
    begun = checkpointed(run(
        "SELECT k.value, min(h.book) AS book, count(DISTINCT h.book) AS n, 'beginning' AS stage FROM {left} k JOIN {heads} h ON k.num = h.num AND k.s = h.head GROUP BY k.value",
        left=left, heads=heads,
    ))
    rest = run("SELECT k.* FROM {left} k LEFT ANTI JOIN {begun} b ON k.value = b.value", left=left, begun=begun)
    # segments: k + 1 pieces of nearly equal length; the first pieces are the shorter ones
    pieces = small(
        run(
            f"""SELECT num, s, book, len, k, i, pos, substr(s, pos, size) AS piece, size FROM (
                  SELECT *, floor(len / (k + 1)) + CASE WHEN i >= (k + 1) - len % (k + 1) THEN 1 ELSE 0 END AS size,
                    i * floor(len / (k + 1)) + greatest(0, i - ((k + 1) - len % (k + 1))) + 1 AS pos
                  FROM (SELECT num, s, book, length(s) AS len, {edits('length(s)')} AS k FROM {{strings}} WHERE full)
                  LATERAL VIEW explode(sequence(0, k)) t AS i WHERE k > 0)""",
            strings=strings,
        )
    )
    # positions at which a piece of a reference of this length can stand in the value
    shapes = small(run("SELECT DISTINCT len, k, i, CAST(pos AS INT) AS pos, CAST(size AS INT) AS size FROM {pieces}", pieces=pieces))
    probes = run(
        f"""SELECT DISTINCT r.value, r.num, r.s, r.len, h.i, substr(r.s, p, h.size) AS piece
            FROM (SELECT * FROM {{rest}} LATERAL VIEW explode(sequence(length(s) - {EDITS[0][1]}, length(s) + {EDITS[0][1]})) t AS len WHERE length(s) <= (SELECT max(len) FROM {{shapes}}) + {EDITS[0][1]}) r
            JOIN {{shapes}} h ON r.len = h.len AND abs(length(r.s) - h.len) <= h.k
            LATERAL VIEW explode(sequence(h.pos - h.k, h.pos + h.k)) t AS p
            WHERE p >= 1 AND p + h.size - 1 <= length(r.s)""",
        rest=rest, shapes=shapes,
    )
    pairs = run(
        "SELECT DISTINCT p.value, p.s, r.s AS ref, r.book, r.k FROM {probes} p JOIN {pieces} r ON p.num = r.num AND p.len = r.len AND p.i = r.i AND p.piece = r.piece",
        probes=probes, pieces=pieces,
    )
    near = run("SELECT value, book, min(dist) AS dist FROM (SELECT value, book, levenshtein(s, ref, k) AS dist FROM {pairs}) WHERE dist >= 0 GROUP BY value, book", pairs=pairs)
    close = checkpointed(run(
        """SELECT value, min_by(book, dist) AS book, CASE WHEN min(dist) < coalesce(min(CASE WHEN rk > 1 THEN dist END), 99) THEN 1 ELSE 2 END AS n, 'near' AS stage
           FROM (SELECT *, row_number() OVER (PARTITION BY value ORDER BY dist, book) AS rk FROM {near}) GROUP BY value""",
        near=near,
    ))
    # concat keeps the union from pairing partitions of its sides, whose numbers can differ
    parts = " UNION ALL ".join(f"SELECT concat(value, '') AS value, book, stage FROM {{{x}}} WHERE n = 1" for x in ("exact", "begun", "close"))
    matched = run(parts, exact=exact, begun=begun, close=close)
    lost = run(f"SELECT concat(v.value, '') AS value, '{UNMATCHED}' AS book, 'none' AS stage FROM {{forms}} v LEFT ANTI JOIN {{matched}} m ON v.value = m.value", forms=forms, matched=matched)
    return run("SELECT * FROM {matched} UNION ALL SELECT * FROM {lost}", matched=matched, lost=lost)


def _records(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(
        "SELECT 'chapters' AS rec_table, chapter_id AS rec_id, book AS value FROM {c} UNION ALL SELECT 'verse_refs', ref_id, book FROM {r}",
        c=table(spark, d, "chapters"), r=table(spark, d, "verse_refs"),
    )


def mapped(spark: SparkSession, d: str) -> DataFrame:
    records, canon = _records(spark, d), table(spark, d, "canon_books")
    # values that are canonical as they stand need no mapping; the canon's books are few
    books = canon.select("book").distinct()
    books = F.broadcast(books) if books.limit(MOST_ROWS + 1).count() <= MOST_ROWS else books
    typed = spark.sql("SELECT r.* FROM {records} r LEFT ANTI JOIN {books} b ON r.value = b.book WHERE r.value IS NOT NULL", records=records, books=books)
    to = checkpointed(mapping(typed.select("value"), canon))
    return spark.sql("SELECT t.rec_table, CAST(t.rec_id AS BIGINT) AS rec_id, t.value, m.book, m.stage FROM {typed} t JOIN {to} m ON t.value = m.value", typed=typed, to=to)


def found(spark: SparkSession, d: str) -> DataFrame:
    """The canonical book, or UNMATCHED, of every record whose book is not written canonically."""
    return mapped(spark, d).select("rec_table", "rec_id", "book").distinct()


def values_query(spark: SparkSession, d: str) -> DataFrame:
    """Every distinct value with its book, the stage that found it and its number of records."""
    return spark.sql("SELECT value, book, stage, count(DISTINCT rec_table, rec_id) AS n_records FROM {m} GROUP BY value, book, stage", m=mapped(spark, d))


def unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Unmatched values and their number of records."""
    return spark.sql("SELECT value, n_records FROM {v} WHERE book = 'UNMATCHED'", v=values_query(spark, d))


queries = {"p2_found": found, "p2_values": values_query, "p2_unmatched": unmatched}


def _oracle(tail: str) -> str:
    """The same stages without the pigeonhole join: every value is compared with every string."""
    return f"""
WITH recs AS (
  SELECT * FROM (SELECT 'chapters' AS rec_table, chapter_id AS rec_id, book AS value FROM chapters UNION ALL SELECT 'verse_refs', ref_id, book FROM verse_refs)
  WHERE value IS NOT NULL AND value NOT IN (SELECT book FROM canon_books)),
vals AS (SELECT DISTINCT value FROM recs),
forms AS (SELECT value, num, name, raw FROM {normal_forms('vals', 'value', True)}),
typed AS (SELECT book, book AS s, true AS ful FROM canon_books UNION SELECT book, alt_title, true FROM canon_books WHERE alt_title IS NOT NULL UNION SELECT book, abbreviation, false FROM canon_books WHERE abbreviation IS NOT NULL),
refs AS (SELECT DISTINCT book, num, name, raw, ful FROM {normal_forms('typed', 's', True)} WHERE name <> ''),
strs AS (SELECT num, name AS s, book, ful FROM refs UNION SELECT 0, raw, book, ful FROM refs WHERE name IN (SELECT name FROM refs GROUP BY name HAVING count(DISTINCT num) = 1)),
keys AS (SELECT value, num, name AS s FROM forms WHERE name <> '' UNION SELECT value, 0, raw FROM forms WHERE raw <> ''),
exact AS (SELECT value, min(book) AS book, count(DISTINCT book) AS n, 'equal' AS stage FROM keys JOIN strs USING (num, s) GROUP BY value),
lft AS (SELECT * FROM keys WHERE value NOT IN (SELECT value FROM exact)),
begun AS (SELECT value, min(book) AS book, count(DISTINCT book) AS n, 'beginning' AS stage FROM lft k JOIN strs r ON k.num = r.num AND length(k.s) >= {LEAST_PREFIX} AND r.ful AND length(r.s) > {LEAST_PREFIX} AND starts_with(r.s, k.s) GROUP BY value),
near AS (
  SELECT value, book, min(levenshtein(k.s, r.s)) AS dist FROM lft k JOIN strs r ON k.num = r.num AND r.ful AND {edits('length(r.s)')} > 0 AND levenshtein(k.s, r.s) <= {edits('length(r.s)')}
  WHERE length(k.s) <= 200 AND value NOT IN (SELECT value FROM begun) GROUP BY value, book),
close AS (
  SELECT value, min_by(book, dist) AS book, CASE WHEN min(dist) < coalesce(min(CASE WHEN rk > 1 THEN dist END), 99) THEN 1 ELSE 2 END AS n, 'near' AS stage
  FROM (SELECT *, row_number() OVER (PARTITION BY value ORDER BY dist, book) AS rk FROM near) GROUP BY value),
matched AS (SELECT value, book, stage FROM (SELECT * FROM exact UNION ALL SELECT * FROM begun UNION ALL SELECT * FROM close) WHERE n = 1),
m AS (SELECT * FROM matched UNION ALL SELECT value, '{UNMATCHED}', 'none' FROM vals WHERE value NOT IN (SELECT value FROM matched)),
v AS (SELECT value, m.book, stage, count(*) AS n_records FROM (SELECT DISTINCT * FROM recs) JOIN m USING (value) GROUP BY ALL)
{tail}"""


oracles = {
    "p2_found": _oracle("SELECT DISTINCT rec_table, rec_id, m.book FROM recs JOIN m USING (value)"),
    "p2_values": _oracle("SELECT * FROM v"),
    "p2_unmatched": _oracle(f"SELECT value, n_records FROM v WHERE book = '{UNMATCHED}'"),
}
