"""Core operators on the edge cases that their docstrings define, and every query against its SQL on the smallest tables."""

import datetime as dt
import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from versegraph.functions import classify as c, text as t
from versegraph.operators import ordered as o, references, relational as r
from versegraph.plans import markup, orphans, ordered, pages, parsers, relational, render, rules, text, validate

D = "/root/testdata/sf0.001"
CORE = {name: f for m in (orphans, ordered, relational, text, render, validate, pages, rules, markup, parsers) for name, f in m.queries.items()}
SQL = {name: sql for m in (orphans, ordered, relational, text, render, validate, pages, rules, markup, parsers) for name, sql in m.oracles.items()}


def cell(x):
    if isinstance(x, float):
        return f"{x:.6g}"
    return "~" if x is None else str(x)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{D}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = CORE[name](spark, D)
    names = sorted(df.columns)
    mine = sorted(tuple(cell(row[n]) for n in names) for row in df.collect())
    out = duck.sql(SQL[name])
    assert sorted(out.columns) == names
    theirs = sorted(tuple(cell(dict(zip(out.columns, row))[n]) for n in names) for row in out.fetchall())
    assert mine == theirs


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_orphans(spark):
    refs = spark.createDataFrame([(1, "a", 1, 5, "x"), (2, "a", 1, 1, "x"), (3, "a", None, 5, "x"), (4, None, 9, 5, "x"), (5, None, None, 5, "x"), (6, "b", 1, 5, "x"), (6, "b", 1, 5, "x"), (7, "a", 1, None, "x"), (8, "a", 1, 8, "x")], "id int, k string, n int, at int, since string")
    targets = spark.createDataFrame([("a", 1, 3, 8), ("a", 1, 3, 8), ("a", 2, 0, None), (None, 1, 0, None), ("c", 1, None, None)], "k string, n int, since int, until int")
    ids = lambda **how: sorted(row.id for row in references.orphans(refs, targets, [("k", "k"), ("n", "n")], at="at", since="since", until="until", **how).collect())
    assert ids() == [2, 6, 6, 7, 8]
    assert ids(semantics="partial") == [2, 4, 6, 6, 7, 8]
    assert ids(semantics="full") == [2, 3, 4, 6, 6, 7, 8]
    always = references.orphans(refs, targets, [("k", "k"), ("n", "n")])
    assert sorted(row.id for row in always.collect()) == [6, 6]
    assert sorted({row.id for row in references.orphans(refs, targets.limit(0), [("k", "k"), ("n", "n")]).collect()}) == [1, 2, 6, 7, 8]
    assert references.orphans(refs.limit(0), targets, [("k", "k"), ("n", "n")]).count() == 0
    with pytest.raises(ValueError):
        references.masks(["k"], "other")


def test_every_null_mask(spark, tmp_path):
    at = lambda day: None if day is None else dt.datetime(2024, 1, day)
    verses = [("a", "Ruth", 1, 1, at(3), at(8)), ("a", "Ruth", 1, 1, at(10), None), ("a", "Ruth", 2, 5, at(8), at(10)), ("b", "Ezra", 1, 2, at(1), at(5)), ("b", "Ezra", 1, 2, at(6), at(4))]
    refs = [
        (1, None, "Ruth", None, 1, at(4)), (2, None, "Ruth", None, 1, at(9)), (3, None, None, None, 5, at(9)), (4, None, None, None, 5, at(10)), (5, "a", None, None, None, at(9)), (6, "b", None, None, None, at(6)),
        (7, "a", "Ezra", None, None, at(4)), (8, None, None, None, None, at(4)), (9, "a", "Ruth", None, 5, None), (10, None, None, 2, None, at(4)), (10, None, None, 2, None, at(4)), (11, "b", "Ezra", 1, 2, at(5)),
    ]
    chapters = [(1, "a", None, None, [1, 5, 5], at(9)), (2, None, None, 1, [2, None], at(7)), (3, "b", "Ezra", 1, None, at(4))]
    findings, rules = [(1, "A", at(2)), (2, "A", at(4)), (3, None, at(2))], [("A", at(3), None)]
    key = "source string, book string, chapter int, verse int"
    tables = {
        "verses": (verses, f"{key}, loaded_at timestamp_ntz, deleted_at timestamp_ntz"), "verse_refs": (refs, f"ref_id long, {key}, noted_at timestamp_ntz"),
        "chapters": (chapters, "chapter_id long, source string, book string, number int, verses array<int>, built_at timestamp_ntz"),
        "findings": (findings, "finding_id long, code string, found_at timestamp_ntz"), "rule_codes": (rules, "code string, introduced_at timestamp_ntz, retired_at timestamp_ntz"),
    }
    con = duckdb.connect()
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    both = {}
    for name in ("p4_masks", "p4_partial"):
        df = orphans.queries[name](spark, str(tmp_path))
        both[name] = sorted(tuple(map(cell, r)) for r in df.collect())
        assert both[name] == sorted(tuple(map(cell, r)) for r in con.sql(orphans.oracles[name]).select(*df.columns).fetchall())
    m = "2024-01"
    want = [("verse_refs", 2, 1, "0101"), ("verse_refs", 4, 5, "0001"), ("verse_refs", 6, None, "1000"), ("verse_refs", 7, None, "1100"), ("verse_refs", 10, None, "0010"), ("verse_refs", 11, 2, "1111"), ("chapters", 1, 1, "1001"), ("chapters", 2, 2, "0011"), ("findings", 1, "A", "1")]
    assert both["p4_masks"] == sorted([(*map(cell, w), m) for w in want] + [("verse_refs", "9", "5", "1101", "~")])
    assert both["p4_partial"] == [("10", "0010", m), ("11", "1111", m)]


def test_cursors_and_text(spark):
    df = spark.createDataFrame([("s", 1, "c", 1), ("s", 2, "v", 1), ("s", 3, "t", None), ("s", 4, "c", None), ("s", 5, "t", None), ("s", 6, "v", 2), ("z", 1, "t", None)], "s string, i int, k string, v int")
    filled = {(x.s, x.i): x.out for x in o.forward_fill(df, ["s"], ["i"], F.col("k").isin("c", "v"), F.when(F.col("k") == "v", F.col("v")), "out").collect()}
    assert filled == {("s", 1): None, ("s", 2): 1, ("s", 3): 1, ("s", 4): None, ("s", 5): None, ("s", 6): 2, ("z", 1): None}
    joined = o.ordered_text(spark.createDataFrame([("s", 2, "b"), ("s", 1, "a"), ("s", 3, None), ("e", 1, None)], "s string, i int, t string"), ["s"], ["i"], "t", "-", "out")
    assert {x.s: x.out for x in joined.collect()} == {"s": "a-b-", "e": ""}
    gaps = o.gaps(spark.createDataFrame([("s", 2), ("s", 3), ("s", 6), ("s", 6), ("s", None)], "s string, n int"), ["s"], "n")
    assert sorted((x.n, x.expected) for x in gaps.collect()) == [(2, 1), (6, 4)]
    assert o.gaps(df.limit(0), ["s"], "v").count() == 0


def test_scalars(spark):
    one = lambda column: spark.range(1).select(column.alias("x")).first().x
    assert tuple(one(t.reference(F.lit("3:16–18")))) == (3, 16, 18) and tuple(one(t.reference(F.lit("3:16-2")))) == (3, 16, None) and one(t.reference(F.lit("x")))["chapter"] is None
    assert one(t.heading_reference(F.lit("3:16a"))) == "3:16" and one(t.heading_reference(F.lit("3:16-2"))) == "3:16"
    assert [one(t.from_roman(F.lit(x))) for x in ("xiv", "MCMXC", "12", "ab", "")] == [14, 1990, 12, None, None]
    assert [one(t.psalm_in_mt(F.lit(n))) for n in (8, 9, 10, 113, 114, 115, 116, 146, 147, 148, 151)] == [8, 9, 11, 114, 116, 116, 117, 147, 147, 148, None]
    assert [one(t.kathisma(F.lit(n))) for n in (1, 50, 118, 119, 150, 151)] == [(1, 1), (7, 2), (17, 0), (18, 1), (20, 3), None]
    assert one(t.quoted_block(F.lit("a\n\nb"))) == "> a\n>\n> b"
    assert one(t.book_heading(F.lit(" According to  Luke (x)"))) == "LUKE" and one(t.letters_together(F.lit("T H E  E N D"))) == "THE  END"
    assert one(t.front_matter_of(F.lit("---\na: 1\nb:\n---\nx"))) == {"a": "1", "b": ""} and one(t.front_matter_of(F.lit("x"))) == {} and one(t.body_of(F.lit("---\na: 1\n---\nx"))) == "x"
    assert one(t.linked(F.lit("see John 3:16, [[John 3:16]]"), r"John (\d+):(\d+)", "[[John $1#v$2]]")) == "see [[John 3#v16]], [[John 3:16]]"
    assert one(t.stripped_tags(F.lit("a<S>12</S> <m>b</m>"))) == "a b"
    assert [one(c.ordinal(F.lit(x))) for x in ("ONE", "twenty-eight", "THIRTY")] == [1, 28, None]
    assert tuple(one(c.part_of_sequence(F.lit(26)))) == ("Commandments", 1) and one(c.part_of_sequence(F.lit(115))) is None
    assert [one(c.month(F.lit(x))) for x in ("m08", "m13", "tri")] == ["August", "m13", "tri"]


def test_classifiers(spark):
    notes = {"[12] Or salvation": "alternative", "TR reads this": "variant", "Greek word": "translator_note", "See John 1": "cross_reference", "See Appendix": "footnote", "St. Basil writes so": "citation", "Nain was a town": "background_note", "Plain": "footnote"}
    got = {x.s: x.k for x in spark.createDataFrame([(n,) for n in notes], "s string").select("s", c.study_note_type(F.col("s")).alias("k")).collect()}
    assert got == notes
    assert spark.range(1).select(c.father(F.lit("as Theoph says")), c.father(F.lit("none")), c.patristic_type(F.lit("Homily 3")), c.marker(F.lit("variant")), c.code_type(F.lit("zz"))).first()[:] == ("Theophylact of Ohrid", None, "homily", '<sup class="nt-tc">‡</sup>', None)
    assert tuple(spark.range(1).select(c.attributed(F.lit("as AmbM says"), F.lit("Luke")).alias("a")).first().a) == ("Ambrose of Milan", "Commentary on Luke")
    assert [x.k for x in spark.createDataFrame([("Or, so",), ("Some manuscripts,",), ("Job 3",), ("Acts 2",), ("i.e., so",)], "s string").select(c.translation_note_type(F.col("s")).alias("k")).collect()] == ["alternative", "variant", "cross_reference", "translator_note", "alternative"]
    assert spark.range(1).select(c.code_type(F.lit("map")), c.code_type(F.lit("map"), printed=True)).first()[:] == ("background_note", "cross_reference")
    assert spark.range(1).select(t.scan_repaired(F.lit("sce the Corin- thians | and Jobn, Hom-bom ilies of a moun- x tain"))).first()[0] == "see the Corinthians and John, Homilies of a mountain"
    names = {"St. Basil": True, "basil": False, "Basil 3": False, "Rev": False, "": False}
    assert {x.s: x.k for x in spark.createDataFrame([(n,) for n in names], "s string").select("s", c.plausible_author(F.col("s")).alias("k")).collect()} == names


def test_relational(spark):
    df = spark.createDataFrame([("g", "a"), ("g", "b"), ("g", "b"), ("h", "c"), (None, "d")], "g string, m string")
    assert sorted((x.m, x.o) for x in r.others_in_group(df, "g", "m", "o").collect()) == [("a", "b"), ("b", "a"), ("b", "a"), ("c", "")]
    picks = r.preferred(spark.createDataFrame([(1, "z"), (1, "sn"), (1, "tc"), (2, "z"), (2, None)], "k int, v string"), ["k"], "v", ["tc", "tn", "sn"], "p")
    assert {x.k: x.p for x in picks.collect()} == {1: "tc", 2: "z"}
    wide = spark.createDataFrame([(1, "a", 1, None, 2, "c", 3), (2, "", 1, "b", 2, "c", 3)], "k int, b1 string, c1 int, b2 string, c2 int, b3 string, c3 int")
    assert sorted(tuple(x) for x in r.wide_to_long(wide, ["k"], [("b1", "c1"), ("b2", "c2"), ("b3", "c3")], ["b", "c"]).collect()) == [(1, 1, "a", 1)]
    spread = r.expanded(spark.createDataFrame([(1, 3), (3, 2), (None, 2)], "a int, b int"), F.col("a"), F.col("b"), "n")
    assert sorted(x.n for x in spread.collect()) == [1, 2, 3]
