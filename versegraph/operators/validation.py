"""Constraint engine over Markdown files: (path, text) in, findings out. Every rule is a filter, a window or an anti-join.

Lines and links are exploded once; windows run within a file, which is one value of the table. Files whose path fits no
layout give no findings. Null texts count as empty. Repeated files are reported once each.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.session import small
from .relational import FEW

# Fields that front matter needs, and testaments.
HUB_FIELDS = ["testament", "genre", "book_id", "aliases", "up", "prev", "next"]
COMPANION_FIELDS = ["hub", "source"]
TESTAMENTS = ["OT", "NT", "Deuterocanon"]
FILE = r"([^/]+?) (\d+)(?: — (.+?))?\.md$"
FINDING = ["severity", "code", "path", "line", "message", "expected", "actual", "suggestion"]


def parsed(files: DataFrame) -> DataFrame:
    """Files with book, chapter, companion name, kind, front matter and body."""
    f = files.select("path", F.coalesce("text", F.lit("")).alias("text"))
    name = lambda i: F.regexp_extract("path", FILE, i)
    f = f.withColumns({"book": t.book_of_prefix(name(1)), "chapter": name(2).try_cast("int"), "companion": name(3), "fm": t.front_matter_of(F.col("text")), "has_fm": F.col("text").rlike(r"(?s)^---\n.*?\n---(?:\n|$)"), "folder": F.regexp_extract("path", r"(\d\d - (?:Old|New) Testament)/", 1), "book_dir": F.regexp_extract("path", r"/(\d\d) - [^/]+/Chapter", 1).try_cast("int")})
    kind = F.when(F.col("companion") == "", "hub").when(F.col("companion").endswith("Notes"), "notes").otherwise("text")
    return f.filter(F.col("chapter").isNotNull()).withColumn("kind", kind)


def lines_of(files: DataFrame) -> DataFrame:
    """(path, kind, book, chapter, line, content, following): the lines of each file from 1."""
    rows = files.select("path", "kind", "book", "chapter", F.posexplode(F.split("text", "\n")).alias("at", "content"))
    rows = rows.withColumn("line", (F.col("at") + 1).cast("int")).drop("at")
    return rows.withColumn("following", F.lead("content").over(Window.partitionBy("path").orderBy("line")))


def rule(condition: Column, severity: str, code: str, message: Column | str, line: Column | None = None, expected: Column | None = None, actual: Column | None = None) -> tuple[str, Column]:
    """A rule's code and the finding of a row where ``condition`` holds, else null."""
    text = lambda c: F.lit(None).cast("string") if c is None else c.cast("string")
    values = (F.lit(severity), F.lit(code), (F.lit(None) if line is None else line).cast("int"), F.lit(message) if isinstance(message, str) else message, text(expected), text(actual), F.lit(None).cast("string"))
    names = [n for n in FINDING if n != "path"]
    return code, F.when(F.coalesce(condition, F.lit(False)), F.struct(*(v.alias(n) for v, n in zip(values, names))))


def report(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Findings of several rules over one reading of ``df``."""
    found = df.select("path", F.explode(F.array_compact(F.array(*(r for _, r in rules)))).alias("f"))
    return found.select("f.severity", "f.code", "path", *(f"f.{n}" for n in FINDING[3:]))


def hub_findings(files: DataFrame, canon: DataFrame, codes: Collection[str] | None = None) -> DataFrame:
    """Rules HUB001-HUB012: one pass over the files, one over their lines. canon: book, testament, book_order, chapter_count (small). codes: the rules wanted (all); a pass without any isn't made."""
    hubs = parsed(files).filter("kind = 'hub'")
    fm = lambda k: F.try_element_at("fm", F.lit(k))
    known = hubs.join(small(canon.select("book", F.col("testament").alias("c_testament"), F.col("book_order").alias("c_order"), F.col("chapter_count").alias("c_chapters")), FEW), "book", "left")
    lacking = F.array_join(F.filter(F.array(*map(F.lit, HUB_FIELDS)), lambda k: ~F.map_contains_key("fm", k)), ", ")
    folder = F.when(fm("testament") == "NT", "02 - New Testament").otherwise("01 - Old Testament")
    by_file = [
        rule(~F.col("has_fm"), "ERROR", "HUB001", "front matter is missing"),
        rule(F.col("has_fm") & (lacking != ""), "ERROR", "HUB001", F.concat(F.lit("fields are missing: "), lacking)),
        rule(~fm("aliases").rlike(r"^(\[.*\])?$"), "ERROR", "HUB002", "aliases are no list", actual=fm("aliases")),
        rule(~fm("testament").isin(TESTAMENTS), "ERROR", "HUB002", "unknown testament", actual=fm("testament")),
        rule((F.col("book") != "Psalms") & (fm("mt_ref").isNotNull() | fm("lxx_ref").isNotNull()), "ERROR", "HUB003", "psalm numbers outside the psalms"),
        rule((F.col("folder") != "") & (F.col("folder") != folder) & fm("testament").isin(TESTAMENTS), "ERROR", "HUB004", "wrong folder", expected=folder, actual=F.col("folder")),
        rule(F.col("book_dir") != F.col("c_order"), "ERROR", "HUB005", "wrong place of the book", expected=F.col("c_order"), actual=F.col("book_dir")),
        rule((F.col("chapter") == 1) & (F.coalesce(fm("prev"), F.lit("")) != ""), "WARN", "HUB009", "the first chapter has a previous one", actual=fm("prev")),
        rule((F.col("chapter") == F.col("c_chapters")) & (F.coalesce(fm("next"), F.lit("")) != ""), "WARN", "HUB009", "the last chapter has a next one", actual=fm("next")),
        rule(fm("testament").isin(TESTAMENTS) & (fm("testament") != F.col("c_testament")), "ERROR", "HUB010", "not the book's testament", expected=F.col("c_testament"), actual=fm("testament")),
    ]
    lines = lines_of(hubs).filter(F.col("content").rlike("^######(?!#)"))
    anchor = F.regexp_extract("content", r"^###### v(\d+)$", 1).try_cast("int")
    lines = lines.withColumn("v", anchor)
    order = Window.partitionBy("path", F.col("v").isNotNull()).orderBy("line")
    lines = lines.withColumn("want", F.coalesce(F.lag("v").over(order) + 1, F.lit(1)))
    body, v = F.coalesce("following", F.lit("")), F.col("v")
    is_anchor, empty = v.isNotNull(), F.trim(body) == ""
    shaped = body.rlike(r'^<span class="vn">\d+</span> .+ \^v\d+$')
    ids = F.regexp_extract(body, r'^<span class="vn">\d+</span> .+ \^v(\d+)$', 1).try_cast("int")
    by_line = [
        rule(~is_anchor, "ERROR", "HUB006", "malformed verse heading", F.col("line"), actual=F.col("content")),
        rule(is_anchor & (v != F.col("want")), "WARN", "HUB007", "verse anchors skip or do not start at 1", F.col("line"), F.col("want"), v),
        rule(is_anchor & empty, "ERROR", "HUB008", "no body after the anchor", F.col("line")),
        rule(is_anchor & ~empty & ~shaped, "ERROR", "HUB011", "the body has not the verse's form", F.col("line") + 1, actual=F.substring(body, 1, 80)),
        rule(is_anchor & shaped & (ids != v), "ERROR", "HUB012", "block id and anchor differ", F.col("line") + 1, v, ids),
    ]
    wanted = [(df, [r for r in rules if codes is None or r[0] in codes]) for df, rules in ((known, by_file), (lines, by_line))]
    return _all([report(df, rules) for df, rules in wanted if rules])


def companion_findings(files: DataFrame) -> DataFrame:
    """Rules CMP001-CMP008 of notes; anchors are looked up in the hubs among ``files``."""
    both = parsed(files)
    notes = both.filter("kind = 'notes'")
    fm = lambda k: F.try_element_at("fm", F.lit(k))
    hub_lines = lines_of(both.filter("kind = 'hub'")).withColumn("v", F.regexp_extract("content", r"^###### v(\d+)$", 1).try_cast("int"))
    # a hub's anchors travel as one sorted set: a chapter has some hundred verses at most
    hubs = hub_lines.groupBy("book", "chapter").agg(F.array_sort(F.collect_set("v")).alias("anchors"))
    lacking = F.array_join(F.filter(F.array(*map(F.lit, COMPANION_FIELDS)), lambda k: ~F.map_contains_key("fm", k)), ", ")
    by_file = [
        rule(~F.col("has_fm"), "ERROR", "CMP001", "front matter is missing"),
        rule(F.col("has_fm") & (lacking != ""), "ERROR", "CMP001", F.concat(F.lit("fields are missing: "), lacking)),
        rule(fm("hub").isNotNull() & F.col("anchors").isNull(), "WARN", "CMP002", "hub file not found"),
    ]
    lines = lines_of(notes).join(hubs, ["book", "chapter"], "left")
    heading = F.regexp_extract("content", r"^### \[\[.+?#v(\d+)\|.+?\]\]", 1).try_cast("int")
    known = lambda v: (F.size("anchors") > 0) & ~F.array_contains("anchors", v)
    heads = lines.withColumn("v", heading).filter("v is not null")
    order = Window.partitionBy("path").orderBy("line")
    heads = heads.withColumns({"before": F.lag("v").over(order), "n": F.row_number().over(Window.partitionBy("path", "content").orderBy("line"))})
    by_heading = [
        rule(known(F.col("v")), "WARN", "CMP005", "the note's verse is not in the hub", F.col("line"), actual=F.col("v")),
        rule(F.col("n") > 1, "WARN", "CMP006", "repeated heading", F.col("line"), actual=F.col("content")),
        rule(F.col("v") < F.col("before"), "ERROR", "CMP008", "headings out of order", F.col("line"), F.col("before"), F.col("v")),
    ]
    links = lines.select("path", "book", "chapter", "line", "anchors", F.explode(F.regexp_extract_all("content", F.lit(r"\[\[([^\]]*)\]\]"), F.lit(1))).alias("link"))
    part = lambda i: F.regexp_extract("link", r"^([^#|]+?) (\d+)#v(\d+)\|", i)
    shown = [F.regexp_extract("link", r"#v\d+\|[^:]+:(\d+)-(\d+)$", i).try_cast("int") for i in (1, 2)]
    here = (t.book_of_prefix(part(1)) == F.col("book")) & (part(2).try_cast("int") == F.col("chapter"))
    by_link = [
        rule(here & known(part(3).try_cast("int")), "WARN", "CMP003", "the anchor is not in the hub", F.col("line"), actual=F.col("link")),
        rule(shown[1] < shown[0], "WARN", "CMP004", "the shown range ends before it starts", F.col("line"), actual=F.col("link")),
        rule(F.trim(F.regexp_replace("link", r"[#|].*$", "")) == "", "WARN", "CMP007", "empty or malformed link", F.col("line"), actual=F.col("link")),
    ]
    return _all([report(notes.join(hubs, ["book", "chapter"], "left"), by_file), report(heads, by_heading), report(links, by_link)])


def run_findings(files: DataFrame, canon: DataFrame, full: bool = False) -> DataFrame:
    """RUN001 hub without any companion, RUN002 canonical chapter without hub (full runs), RUN003 hub without notes."""
    f = parsed(files)
    hubs = f.filter("kind = 'hub'").select("path", "book", "chapter").distinct()
    out = [
        report(hubs.join(f.filter("kind <> 'hub'").select("book", "chapter").distinct(), ["book", "chapter"], "left_anti"), [rule(F.lit(True), "WARN", "RUN001", "hub without companion")]),
        report(hubs.join(f.filter("kind = 'notes'").select("book", "chapter").distinct(), ["book", "chapter"], "left_anti"), [rule(F.lit(True), "WARN", "RUN003", "hub without notes")]),
    ]
    if full:
        expected = canon.select("book", F.explode(F.sequence(F.lit(1), "chapter_count")).alias("chapter")).join(hubs.select("book", "chapter"), ["book", "chapter"], "left_anti")
        out.append(report(expected.select(F.concat_ws(" ", "book", F.col("chapter").cast("string")).alias("path")), [rule(F.lit(True), "ERROR", "RUN002", "canonical chapter without hub")]))
    return _all(out)


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def verdict(findings: DataFrame) -> DataFrame:
    """Counts by severity and PASS (no error) or FAIL."""
    counts = findings.agg(*(F.count_if(F.col("severity") == s).alias(n) for s, n in (("ERROR", "n_errors"), ("WARN", "n_warnings"), ("INFO", "n_infos"))))
    return counts.withColumn("verdict", F.when(F.col("n_errors") > 0, "FAIL").otherwise("PASS"))
