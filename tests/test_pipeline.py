"""From verses to files to findings, and the streaming forms."""

import shutil

from pyspark.sql import functions as F

from versegraph.functions import canon as c
from versegraph.operators import validation as v
from versegraph.plans import pipeline as p
from versegraph.sources import tabular
from versegraph.streaming import incremental as i


def verses(spark):
    rows = [("John", 1, 1, "In the start."), ("John", 1, 2, " He  was."), ("Psalms", 50, 1, "Have mercy."), ("Nowhere", 1, 1, "lost"), ("John", None, 1, "no chapter"), ("John", 2, 1, "")]
    return spark.createDataFrame(rows, "book string, chapter int, verse int, text string")


def test_hub_files_pass_their_check(spark, tmp_path):
    job = p.Job(str(tmp_path / "v"), "OSB")
    files, errors = p.pages(spark, verses(spark), job)
    assert p.run(spark, files, errors, job) == {"files": 2, "errors": 2}
    tree = tabular.markdown_tree(spark, job.root)
    texts = {r.path: r.text for r in tree.collect()}
    psalm = texts["01 - Old Testament/24 - Psalms/Chapter 50/Psalm 50.md"]
    assert "mt_ref: 51\nkathisma: 7\nstasis: 2" in psalm and "###### v1" in psalm
    assert v.hub_findings(tree, c.canon(spark)).count() == 0
    assert {r.code for r in p.check(spark, tree).collect()} == {"RUN001", "RUN003"}


def test_notes_and_fathers(spark, tmp_path):
    job = p.Job(str(tmp_path / "v"), "OSB")
    notes = spark.createDataFrame([("John", 1, 2, "variant", "Other [[John 1#v9|1:9]]", 1), ("John", 1, 1, "footnote", "b", 2), ("John", 1, 1, "footnote", "a", 1), ("John", 99, 1, "footnote", "beyond", 1)], "book string, chapter int, verse int, note_type string, content string, ins int")
    files, _ = p.pages(spark, verses(spark), job)
    pages = p.note_pages(spark, notes, job)
    row = pages.collect()
    assert len(row) == 1 and row[0].content.index("[[John 1#v1|1:1]]") < row[0].content.index("> a") < row[0].content.index("> b") < row[0].content.index("#v2|")
    both = files.unionByName(pages).withColumnsRenamed({"rel_path": "path", "content": "text"})
    assert sorted((r.code, r.actual) for r in v.companion_findings(both).collect()) == [("CMP003", "John 1#v9|1:9")]
    fathers = spark.createDataFrame([("John", 1, "Basil", "On", 2, "text", 1)], "book string, chapter int, father string, work string, verse_start int, content string, ins int")
    assert p.father_pages(spark, fathers, job).first().rel_path.endswith("John 1 — Fathers.md")


HUB = '---\ntestament: NT\ngenre: Gospel\nbook_id: John\naliases: [Jn 1]\nup: John\nprev:\nnext: John 2\n---\n\n###### v1\n<span class="vn">1</span> a ^v1\n'
AT = "02 - New Testament/04 - John/Chapter 01/John 1.md"


HUB_CASES = (
    [
        ("HUB001", AT, "no front matter"),
        ("HUB001", AT, HUB.replace("genre: Gospel\n", "")),
        ("HUB002", AT, HUB.replace("[Jn 1]", "Jn 1")),
        ("HUB002", AT, HUB.replace("testament: NT", "testament: XX")),
        ("HUB003", AT, HUB.replace("up: John", "up: John\nmt_ref: 3")),
        ("HUB004", AT.replace("02 - New", "01 - Old"), HUB),
        ("HUB005", AT.replace("04 - John", "05 - John"), HUB),
        ("HUB006", AT, HUB + "###### verse 2\nx\n"),
        ("HUB007", AT, HUB.replace("v1\n<", "v2\n<").replace('vn">1', 'vn">2').replace("^v1", "^v2")),
        ("HUB007", AT, HUB + '###### v3\n<span class="vn">3</span> a ^v3\n'),
        ("HUB008", AT, HUB + "###### v2\n\n"),
        ("HUB009", AT, HUB.replace("prev:", "prev: John 0")),
        ("HUB010", AT, HUB.replace("testament: NT", "testament: OT")),
        ("HUB011", AT, HUB + "###### v2\nplain\n"),
        ("HUB012", AT, HUB + '###### v2\n<span class="vn">2</span> a ^v3\n'),
    ]
)


def test_hub_rules(spark):
    files = spark.createDataFrame([(f"{n}/{path}", text) for n, (_, path, text) in enumerate(HUB_CASES)], "path string, text string")
    found = {(int(r.path.partition("/")[0]), r.code) for r in v.hub_findings(files, c.canon(spark)).collect()}
    assert not {(n, code) for n, (code, _, _) in enumerate(HUB_CASES)} - found


NOTES = "---\nhub: John 1\nsource: OSB\n---\n\n### [[John 1#v1|1:1]]\nx\n"
NOTES_AT = AT.replace("John 1.md", "John 1 — OSB Notes.md")


NOTE_CASES = (
    [
        (None, NOTES, True),
        ("CMP001", "no front matter", True),
        ("CMP001", NOTES.replace("source: OSB\n", ""), True),
        ("CMP002", NOTES, False),
        ("CMP003", NOTES + "see [[John 1#v7|1:7]]\n", True),
        ("CMP004", NOTES + "see [[John 1#v1|1:5-2]]\n", True),
        ("CMP005", NOTES + "### [[John 1#v9|1:9]]\n", True),
        ("CMP006", NOTES + "### [[John 1#v1|1:1]]\n", True),
        ("CMP007", NOTES + "[[]]\n", True),
        ("CMP008", NOTES.replace("#v1|1:1", "#v2|1:2") + "### [[John 1#v1|1:1]]\n", True),
    ]
)


def test_companion_rules(spark):
    moved = lambda s, n: s.replace("John 1", f"John {n}").replace("1:", f"{n}:")
    rows = [(moved(NOTES_AT, n), moved(text, n)) for n, (_, text, _) in enumerate(NOTE_CASES, 1)] + [(moved(AT, n), HUB) for n, (_, _, hub) in enumerate(NOTE_CASES, 1) if hub]
    found = {(r.path, r.code) for r in v.companion_findings(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert not {(moved(NOTES_AT, n), code) for n, (code, _, _) in enumerate(NOTE_CASES, 1) if code} - found
    assert not [x for x in found if x[0] == moved(NOTES_AT, 1)]


def test_full_run_lists_missing_chapters(spark):
    files = spark.createDataFrame([(AT, HUB)], "path string, text string")
    assert v.run_findings(files, c.canon(spark), full=True).filter("code = 'RUN002'").count() == 1343
    assert v.verdict(v.run_findings(files, c.canon(spark))).first().verdict == "PASS"


def test_canon(spark):
    books = c.canon(spark)
    assert books.agg(F.sum("chapter_count")).first()[0] == 1344
    assert {r.testament: r["count"] for r in books.groupBy("testament").count().collect()} == {"OT": 39, "Deuterocanon": 12, "NT": 27}


def test_streams(spark, tmp_path):
    source = "/root/testdata/sf0.001/events.parquet"
    (tmp_path / "in").mkdir()
    shutil.copy(source, tmp_path / "in" / "a.parquet")
    shutil.copy(source, tmp_path / "in" / "b.parquet")
    batch = spark.read.parquet(source)
    stream = lambda: i.stream_of(spark, str(tmp_path / "in"), batch.schema)
    counts = i.collected(i.windowed_counts(stream(), "ts", "event_type", "value"), "counts", str(tmp_path / "c1"), "complete")
    assert counts.agg(F.sum("n_events")).first()[0] == 2 * batch.count()
    once = i.collected(i.first_deliveries(stream(), ["event_id"], "ts", "1000 days"), "once", str(tmp_path / "c2"))
    assert once.count() == batch.count()
    numbered = stream().select(F.col("event_type").alias("k"), F.col("event_id").alias("o"), (F.col("event_id") % 7).cast("int").alias("n"))
    moved = i.collected(i.cursors(numbered, "k", "o", "n"), "moved", str(tmp_path / "c3"))
    timed = stream().withWatermark("ts", "1 day").select("ts", F.col("event_type").alias("k"), F.col("event_id").alias("o"), (F.col("event_id") % 7).cast("int").alias("n"))
    assert i.collected(i.cursors(timed, "k", "o", "n", time="ts"), "timed", str(tmp_path / "c5")).count() == 2 * batch.count()
    rows = moved.filter("accepted").groupBy("key").agg(F.count("*").alias("a"), F.max("number").alias("m")).collect()
    assert rows and all(r.a <= 6 and r.m == 6 for r in rows)
    seen = []
    q = i.rerendered(stream(), ["event_type"], lambda keys: keys, lambda df, n: seen.append((n, df.count())), str(tmp_path / "c4"))
    q.awaitTermination()
    assert [n for n, _ in seen] == [0, 1]
