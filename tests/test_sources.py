"""Sources, extraction and the sink on small files of the reference's shapes, with texts of our own."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from versegraph.operators import extraction as x
from versegraph.functions import classify
from versegraph.sources import epub, html, sink, tabular

PAGE = """<html><body><div type="chapter" osisID="John.1">
<p><span class="verse">[1]</span></p><div class='linegroup'><div class='lineitem'>First line,</div><div class='lineitem'>second line.</div></div>
<p><span class="verse">[6]</span>Sixth verse <i>here</i>; <span class="verse">[7]</span>seventh verse.</p></div>
<div type="chapter" osisID="John.2"><p><span class="verse">[1]</span>Next chapter.</p></div><script>no text</script></body></html>"""


def docs(spark, *pages):
    return spark.createDataFrame([("S", f"p{i}.html", i, p) for i, p in enumerate(pages)], "source string, path string, spine_idx int, html string")


def test_bracket_verses(spark):
    rows = {(r.chapter, r.verse): r.text for r in x.verses(html.html_events(docs(spark, PAGE)), x.bracket_layout()).collect()}
    assert rows == {(1, 1): "First line, second line.", (1, 6): "Sixth verse here;", (1, 7): "seventh verse.", (2, 1): "Next chapter."}


def test_colon_verses_and_notes(spark):
    page = '<p><span class="verse">1:1</span> In the<sup><a href="n.html#n1">1</a></sup> start <span class="verse">1:2</span> more.</p>'
    note = '<p id="n1">1. Or <i>at</i> the start.</p><p id="n2">2. unused</p>'
    events = html.html_events(docs(spark, page, note))
    got = {(r.chapter, r.verse): r.text for r in x.verses(events.filter("path = 'p0.html'"), x.colon_layout()).collect()}
    assert got == {(1, 1): "In the start", (1, 2): "more."}
    refs = x.references(events.filter("path = 'p0.html'"), x.colon_layout())
    defs = x.definitions(events.filter("path = 'p1.html'"), "^n\\d+$")
    rows = x.notes(refs, defs, classify.study_note_type(F.col("content"))).collect()
    assert [(r.chapter, r.verse, r.note_type, r.content) for r in rows] == [(1, 1, "alternative", "Or at the start.")]


def test_anchor_and_superscript_verses(spark):
    page = '<p class="rindent"><a id="Gen_vchap1-1"></a>One. <a id="Gen_vchap1-2"></a>Two.</p><p class="note">no</p>'
    rows = {(r.chapter, r.verse): r.text for r in x.verses(html.html_events(docs(spark, page)), x.anchor_layout(["rindent"])).collect()}
    assert rows == {(1, 1): "One.", (1, 2): "Two."}
    page = "<p>3</p><p>First <sup>2(1)</sup>second</p>"
    rows = {(r.chapter, r.verse): r.text for r in x.verses(html.html_events(docs(spark, page)), x.superscript_layout()).collect()}
    assert rows == {(3, 1): "First", (3, 2): "second"}


def test_dialects_and_markdown(spark):
    page = "<p>a<p>b <b>c</b> <em>d</em><br/>e"
    depth = lambda d: [len(r.ancestors) for r in html.html_events(docs(spark, page), d).filter("kind = 'text'").orderBy("ev").collect()]
    assert depth("lenient")[1] == 1 and depth("xml")[1] == 2
    md = html.markdown(html.html_events(docs(spark, page)), ["path"]).first().md
    assert md == "ab **c** *d*\n\ne"
    assert html.html_events(spark.createDataFrame([("S", "p", 0, None)], "source string, path string, spine_idx int, html string")).count() == 0


def test_epub(spark, tmp_path):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("META-INF/container.xml", '<container xmlns="urn:c"><rootfiles><rootfile full-path="OEBPS/content.opf"/></rootfiles></container>')
        z.writestr("OEBPS/content.opf", '<package xmlns="urn:o"><manifest><item id="b" href="file2.xhtml" media-type="application/xhtml+xml"/><item id="a" href="file1.xhtml" media-type="application/xhtml+xml"/><item id="g" href="gone.xhtml" media-type="text/html"/></manifest><spine><itemref idref="a"/><itemref idref="b"/><itemref idref="g"/><itemref idref="none"/></spine></package>')
        z.writestr("OEBPS/file1.xhtml", "<p>one</p>")
        z.writestr("OEBPS/file2.xhtml", "<p>two</p>")
        z.writestr("OEBPS/toc.ncx", '<ncx xmlns="urn:n"><navMap><navPoint><navLabel><text>John</text></navLabel><content src="file1.xhtml"/></navPoint></navMap></ncx>')
    (tmp_path / "b.epub").write_bytes(buffer.getvalue())
    rows = epub.epub_documents(spark, str(tmp_path), "S").orderBy("spine_idx").collect()
    assert [(r.path, r.spine_idx) for r in rows] == [("OEBPS/file1.xhtml", 0), ("OEBPS/file2.xhtml", 1)]
    (tmp_path / "broken.epub").write_bytes(b"no archive")
    assert epub.epub_documents(spark, str(tmp_path), "S").count() == 2 and epub.epub_errors(spark, str(tmp_path), "S").first().error.startswith("BadZipFile")
    (tmp_path / "broken.epub").unlink()
    titles = spark.createDataFrame([("John", "John")], "title string, book string")
    counts = spark.createDataFrame([("John", 2)], "book string, chapter_count int")
    files = epub.numbered_files(epub.epub_contents(spark, str(tmp_path)), titles, counts).orderBy("chapter").collect()
    assert [r.path for r in files] == ["file2.xhtml", "file3.xhtml"]


def test_tsv_and_csv(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("1\t1\t1\told\n1\t1\t1\tnew <S>12</S><m>x</m>word\n1\t1\t0\tzero\n9\t1\t1\tunknown\nx\t1\t1\tbad\n1\t1\n")
    books = spark.createDataFrame([(1, "Genesis")], "book_id int, book string")
    rows = tabular.tagged_tsv(spark, str(tmp_path / "t.tsv"), books).collect()
    assert [tuple(r) for r in rows] == [("Genesis", 1, 1, "new xword")]
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "John.csv").write_text("chapter,verse,text\n1,1,¶ Word\n1\n")
    assert [tuple(r) for r in tabular.verse_csv(spark, str(tmp_path / "csv")).collect()] == [("John", 1, 1, "Word")]


def test_readings(spark, tmp_path):
    head = "topic~key,Citation," + ",".join(f"{c}{n}" for n in range(1, 7) for c in ("bk", "c", "vf", "vt"))
    row = lambda key, *b: ",".join([key, "cit", *(str(v) for x in b for v in x), *[""] * (24 - 4 * len(b))])
    lines = [head, row("le.go.me.m08.d06~x", ("Jn", 1, 1, 3)), row("le.ep.pe", ("Jn", 1, 5, 5)), row("le.go.z", ("Jn", 1, 2, 3), ("Mk", 2, 1, 2)), row("le.go.none", ("??", 1, 1, 1))]
    (tmp_path / "r.csv").write_text("\n".join(lines))
    books = spark.createDataFrame([("Jn", "John"), ("Mk", "Mark")], "name string, book string")
    got = {r.key: r for r in tabular.readings(spark, str(tmp_path / "r.csv"), books).collect()}
    assert set(got) == {"le.go.me.m08.d06", "le.ep.pe", "le.go.z"}
    one = got["le.go.me.m08.d06"]
    assert (one.reading_type, one.cycle, one.date_parts) == ("Gospel", "me", ["m08", "d06"])
    assert one.wikilink == "[[John 1#v1|1:1-3]]" and one.hidden_links == "[[John 1#v2]][[John 1#v3]]"
    assert got["le.ep.pe"].wikilink == "[[John 1#v5|1:5]]" and got["le.ep.pe"].hidden_links == ""
    assert got["le.go.z"].wikilink == "[[John 1#v2|John 1:2]]–[[Mark 2#v2|Mark 2:2]]"


def test_parallels_and_registry(spark, tmp_path):
    (tmp_path / "p.yaml").write_text("parallels:\n- title: T\n  passages:\n  - {book: Matthew, chapter: 1, verse_start: 2, verse_end: 2}\n  - {book: Psalms, chapter: 3, verse_start: 4, verse_end: 6}\n- title: Lone\n  passages:\n  - {book: Mark, chapter: 1, verse_start: 1}\n")
    rows = sorted(tuple(r) for r in tabular.parallel_notes(tabular.parallels(spark, str(tmp_path / "p.yaml"))).collect())
    assert rows == [("Matthew", 1, 2, "T", "[[Psalm 3#v4|Psalms 3:4-6]]"), ("Psalms", 3, 4, "T", "[[Matthew 1#v2|Matthew 1:2]]")]
    (tmp_path / "s.yaml").write_text("sources:\n  a:\n    label: A\n    status: new\n")
    assert tabular.registry(spark, str(tmp_path / "s.yaml")).first().label == "A"


def test_catena(spark, tmp_path):
    blocks = [
        "RUTH 3",
        "6 And the harvest lay in heaps,",
        "SUNDAY OF THE SECOND GLEANING",
        "THE SHEAF THAT WAS LEFT BEHIND",
        "Nobody would call a gleaner id-\nle who bends so often.",
        "St. Orsolo of Vantry. Sermon IV on Ruth III, 7, 9-11. B#3, p. 2.",
        "17",
        "A LAMP IN THE BARN AT NIGHT",
        "This excerpt has no known author.",
        "9. Some Almanac. B#8.",
        "ON THE KINDNESS OF STRANGERS",
        "Kin is whoever stays.",
        "Rev. T. Ilbury. Prayers at Dusk, 3.1. B#4.",
        "JONAH 2",
        "10 The fish was patient.",
        "BELOW THE KEEL OF THE SHIP",
        "He sang, of all things.",
        "Mother Adeltrud. The Deep Homilies. B#5, p. 9.",
        "B1. A List of Works, with a note B#1",
        "WORKS THAT ARE LISTED HERE",
        "St. Nobody. Nothing at All. B#6.",
    ]
    (tmp_path / "o.txt").write_text("\n\n".join(blocks))
    rows = x.catena(tabular.blocks(spark, str(tmp_path / "o.txt"), "M"), ["RUTH", "JONAH"], blocked=("nobody",)).orderBy("ins").collect()
    assert [(r.book, r.chapter, r.father, r.work, r.verse_start, r.verse_end, r.ptype) for r in rows] == [
        ("Ruth", 3, "Orsolo of Vantry", "Sermon IV on Ruth III, 7, 9-11", 7, 11, "commentary"),
        ("Ruth", 3, "Rev. T. Ilbury", "Prayers at Dusk, 3.1", 6, 6, "commentary"),
        ("Jonah", 2, "Mother Adeltrud", "The Deep Homilies", 10, 10, "homily"),
    ]
    assert rows[0].content.startswith("THE SHEAF") and "SECOND" not in rows[0].content


def test_sink_and_tree(spark, tmp_path):
    df = spark.createDataFrame([("a b/One 1.md", "---\nhub: x\n---\ntext"), ("Two 2.md", "é")], "rel_path string, content string")
    assert sink.write_files(df, str(tmp_path / "out")) == 2
    assert not list((tmp_path / "out" / "_staged").iterdir())
    bad = spark.createDataFrame([("../x.md", "")], "rel_path string, content string")
    with pytest.raises(Exception, match="leaves the output folder"):
        sink.write_files(bad, str(tmp_path / "out"))
    tree = {r.path: r.text for r in tabular.markdown_tree(spark, str(tmp_path / "out")).collect()}
    assert tree == {"a b/One 1.md": "---\nhub: x\n---\ntext", "Two 2.md": "é"}
