"""Parsers and the joins that rest on them."""

from pyspark.sql import functions as F

from versegraph.functions import anchors as a


def test_parsers(spark):
    def one(column):
        row = spark.range(1).select(column.alias("x")).first().x
        return tuple(row) if hasattr(row, "asDict") else row

    s = F.lit
    assert one(a.verse_anchor(s("Gen_vchap3-16"))) == ("Gen", 3, 16) and one(a.verse_anchor(s("GEN.3_Bible_3_16"))) == ("GEN", 3, 16) and one(a.verse_anchor(s("x"))) == (None, None, None)
    assert [one(a.note_number(s(x))) for x in ("_ednref7", "footnote-8", "fn9", "z1")] == [7, 8, 9, None] and one(a.chapter_of_osis(s("John.12"))) == 12
    assert one(a.file_key(s("t/john03.html"))) == ("john", 3) and one(a.file_key(s("psalm_3.xhtml"))) is None and one(a.book_key(s("john2.html"))) == "john.html"
    assert one(a.split_ezra(s(10))) == ("Ezra", 10) and one(a.split_ezra(s(11))) == ("Nehemiah", 1)
    assert one(a.named_book(s("The Prophecy of JOEL"), ["Hosea", "Joel"])) == "Joel" and one(a.named_book(s("none"), ["Hosea"])) is None
    assert [tuple(x) for x in one(a.control_parts(s("tn chapter \x18\x04sn note\x04 ")))] == [("tn", "chapter 2"), ("sn", "note")]
    assert one(a.attribution(s("St. Orsolo of Vantry. Sermon IV on Ruth. B#3"))) == ("Orsolo of Vantry", "Sermon IV on Ruth") and one(a.attribution(s("none"))) == (None, None)
    assert one(a.work_reference(s("Sermon IV on Ruth III, 4, 5-7"))) == ("Sermon IV on Ruth 3", 3, 4, 7, "4, 5-7") and one(a.work_reference(s("Sermon on Ruth III, x"))) is None and one(a.work_reference(s("Homily"))) is None
    assert one(a.same_book_reference(s("see 1 Jn 3:4-6"), ["Jn", "1 Jn"])) == (4, 6) and one(a.same_book_reference(s("no"), ["Jn"])) is None
    assert one(a.from_title(s("said\nTHE TITLE OF ALL\nbody"))) == "THE TITLE OF ALL\nbody" and one(a.from_title(s("body"))) == ""
    assert [one(a.context_header(s(x))) for x in ("Sunday of the Lamp", "in the GREAT LENT", "7th week", "x (OGL) y", "A GREAT LAMP")] == [True, True, True, True, False]
    assert one(a.from_title(s("MONDAY OF THE SECOND WEEK\nTHE TITLE OF ALL"))) == "THE TITLE OF ALL"
    assert [one(a.canonical_title(s(x))) for x in ("1 Samuel", "2 Peter", "Ruth")] == ["I Kingdoms", "II Peter", "Ruth"]
    assert one(a.note_marker(s("Psalms"), s(3), s("S"), s("n1"), s("*"), s("nt"))) == '<sup class="nt">[[Psalm 3 — S Notes#^n1|*]]</sup>'


def test_joins(spark):
    notes = a.labelled_notes(spark.createDataFrame([("d", "lead 1.2 first note. 1.3–5 second\nnote 2.1 third"), ("e", "none")], "d string, t string"), ["d"], "t")
    assert sorted(tuple(r) for r in notes.collect()) == [("d", 1, 2, "first note"), ("d", 1, 3, "second note"), ("d", 2, 1, "third")]
    cites = spark.createDataFrame([("D", 1, 2, "John", 3, 4, 5)], "document string, d_chapter int, d_verse int, book string, chapter int, verse_start int, verse_end int")
    verses = spark.createDataFrame([("D", 1, 2, "as it says")], "document string, chapter int, verse int, text string")
    assert tuple(a.citing_texts(cites, verses).first()) == ("John", 3, "D", "1.2", 4, 5, "as it says")
    events = spark.createDataFrame([("s", "p", 0, k, x) for k, x in enumerate("aaXb")] + [("s", "q", 0, 0, "a")], "source string, path string, spine_idx int, ev long, text string")
    before, after = a.before_first(events, F.col("text") == "X")
    assert (before.count(), after.count()) == (3, 2)
    boxes = spark.createDataFrame([("s", 1, 9.0, 400.0), ("s", 1, 7.0, 60.0), ("s", 1, 9.0, 50.0), ("s", 2, 9.0, 50.0)], "source string, page int, sz double, y_top double")
    assert a.body_boxes(boxes, 8.0, 230.0).count() == 2
