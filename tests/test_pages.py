"""Further pages and edits."""

from versegraph.functions.canon import canon
from versegraph.plans import pages as g


def test_titles(spark):
    df = spark.createDataFrame([(1, "First Corinthians 5:3-5, 7; 6:1; Luke 2:4"), (2, "no reference"), (3, None), (4, "; 3:1")], "k int, title string")
    rows = sorted((r.k, r.pos, r.book, r.chapter, r.verse, r.link) for r in g.title_links(df, "k", "title").collect())
    assert [x[2:5] for x in rows] == [("I Corinthians", 5, 3), ("I Corinthians", 5, 7), ("I Corinthians", 6, 1), ("Luke", 2, 4)]
    assert rows[0][5] == "[[I Corinthians 5#v3|5:3-5]]"


def test_outline_and_intro(spark):
    items = spark.createDataFrame([("b", 1, 1, "One", "x"), ("b", 2, 2, None, "y"), ("b", 3, 2, None, "z"), ("b", 4, 1, "Two", None)], "book string, pos int, level int, label string, text string")
    assert g.outline(items, ["book"]).first().outline == "I. **One** x\n    A. y\n    B. z\nII. **Two** "
    intros = spark.createDataFrame([("Ruth", "S", "second", 2), ("Ruth", "S", "first", 1), ("None Such", "S", "odd", 1)], "book string, source string, content string, ins int")
    paths = {r.rel_path: r.content for r in g.intro_pages(intros, canon(spark)).collect()}
    assert "first" in paths["01 - Old Testament/08 - Ruth/Ruth — S Intro.md"] and "01 - Old Testament/99 - None Such/None Such — S Intro.md" in paths


def test_days_and_chapters(spark):
    readings = spark.createDataFrame([("le.go.me.m08.d06", "me", "Gospel", ["m08", "d06"], "c", "[[x]]", ""), ("le/a:b", "pe", "Epistle", [], "", "[[y]]", "[[z]]"), ("k", "zz", "Gospel", [], "", "w", "")], "key string, cycle string, reading_type string, date_parts array<string>, citation string, wikilink string, hidden_links string")
    assert {r.rel_path: r.content for r in g.day_pages(readings).collect()} == {"Menaion/August/le.go.me.m08.d06.md": "# Gospel\n\nc\n\n[[x]]\n", "Movable/le-ab.md": "# Epistle\n\n[[y]]\n\n%%[[z]]%%\n", "Other/k.md": "# Gospel\n\nw\n"}
    verses = spark.createDataFrame([("D", 1, 2, "b"), ("D", 1, 1, "a")], "document string, chapter int, verse int, text string")
    notes = spark.createDataFrame([("D", 1, 1, 2, "n2"), ("D", 1, 1, 1, "n1")], "document string, chapter int, verse int, ins int, content string")
    assert g.patristic_chapters(verses, notes).first().content == "**1** a ^1-1\n\n> n1\n> n2\n\n**2** b ^1-2"


def test_migration_is_idempotent(spark):
    files = spark.createDataFrame([("x/John 1.md", "---\nup: John\n---\nb"), ("x/John 1 — N.md", "---\nup: J\n---\n"), ("x/Zed 1.md", "---\na: 1\n---\n"), ("x/John 2.md", "none")], "path string, text string")
    once = g.migrated(files, canon(spark))
    got = {r.path: r.text for r in once.collect()}
    assert got["x/John 1.md"] == "---\ntestament: NT\ngenre: Gospel\nbook_id: John\nup: John\n---\nb"
    assert {k: v for k, v in got.items() if k != "x/John 1.md"} == {r.path: r.text for r in files.collect() if r.path != "x/John 1.md"}
    assert {r.path: r.text for r in g.migrated(once, canon(spark)).collect()} == got
