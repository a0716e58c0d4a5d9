"""HTML and XHTML as event tables: one row for each opening tag, closing tag and text, in document order.

The tokenizer keeps the stack of open elements, so that every event carries its ancestors and ancestor predicates are plain
column expressions. Three dialects: ``html`` leaves unclosed tags open, ``lenient`` closes ``p`` and ``li`` where HTML implies
it, ``xml`` nests as written and closes self-closing tags. Documents are tokenized where they are read, a document at a time.

Null documents give no events; text of scripts, styles and comments is no text.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements without content, elements that an opening p or li ends, and elements whose text is code.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
ENDS_P = {"p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "table", "blockquote", "section", "hr"}
CODE = {"script", "style"}

EVENTS = "source string, path string, spine_idx int, ev long, kind string, tag string, id string, classes array<string>, attrs map<string,string>, text string, ancestors array<struct<tag:string,id:string,classes:array<string>,ev:long>>"

_STRINGS = pa.list_(pa.string())
ARROW = pa.schema(
    [
        *((n, pa.string()) for n in ("source", "path")),
        ("spine_idx", pa.int32()),
        ("ev", pa.int64()),
        *((n, pa.string()) for n in ("kind", "tag", "id")),
        ("classes", _STRINGS),
        ("attrs", pa.map_(pa.string(), pa.string())),
        ("text", pa.string()),
        ("ancestors", pa.list_(pa.struct([("tag", pa.string()), ("id", pa.string()), ("classes", _STRINGS), ("ev", pa.int64())]))),
    ]
)


class Tokenizer(HTMLParser):
    def __init__(self, dialect: str):
        super().__init__(convert_charrefs=True)
        self.dialect, self.rows, self.stack = dialect, [], []

    def emit(self, kind: str, tag: str | None, attrs: dict, text: str | None) -> None:
        self.rows.append((len(self.rows), kind, tag, attrs.get("id"), (attrs.get("class") or "").split(), attrs, text, [(t, i, c, e) for t, i, c, e in self.stack]))

    def handle_starttag(self, tag: str, attrs: list) -> None:
        got = {k: v or "" for k, v in attrs}
        if self.dialect == "lenient" and tag in ENDS_P | {"li"}:
            target = "li" if tag == "li" else "p"
            if any(t == target for t, *_ in self.stack):
                self.close(target)
        self.emit("open", tag, got, None)
        if not (tag in VOID and self.dialect != "xml"):
            self.stack.append((tag, got.get("id"), (got.get("class") or "").split(), len(self.rows) - 1))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.emit("open", tag, {k: v or "" for k, v in attrs}, None)
        self.emit("close", tag, {}, None)

    def close(self, tag: str) -> None:
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                for t, *_ in reversed(self.stack[k:]):
                    self.stack.pop()
                    self.emit("close", t, {}, None)
                return

    def handle_endtag(self, tag: str) -> None:
        self.close(tag)

    def handle_data(self, data: str) -> None:
        if not any(t in CODE for t, *_ in self.stack):
            self.emit("text", None, {}, data)


def html_events(docs: DataFrame, dialect: str = "lenient") -> DataFrame:
    """Events of documents (source, path, spine_idx, html)."""
    if dialect not in ("html", "lenient", "xml"):
        raise ValueError(f"unknown dialect {dialect!r}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, path, idx, html in zip(*(batch.column(i).to_pylist() for i in range(4))):
                t = Tokenizer(dialect)
                t.feed(html)
                t.goahead(True)
                rows = [(source, path, idx, ev, kind, tag, i, classes, list(attrs.items()), text, [dict(zip(("tag", "id", "classes", "ev"), a)) for a in up]) for ev, kind, tag, i, classes, attrs, text, up in t.rows]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(ARROW)], schema=ARROW)

    return docs.select("source", "path", F.col("spine_idx").cast("int").alias("spine_idx"), "html").filter("html is not null").mapInArrow(run, EVENTS)


def inside(tag: str | None = None, cls: str | None = None) -> Column:
    """Whether an event has an ancestor of this tag and class."""
    is_tag = (lambda a: a["tag"] == tag) if tag else (lambda a: F.lit(True))
    has_class = (lambda a: F.array_contains(a["classes"], cls)) if cls else (lambda a: F.lit(True))
    return F.exists("ancestors", lambda a: is_tag(a) & has_class(a))


def markdown(events: DataFrame, keys: list[str], italic: str = "*") -> DataFrame:
    """Inline Markdown of the texts of each key, in order: i/em, b/strong, br and small."""
    mark = (
        F.when(F.col("tag").isin("i", "em"), italic)
        .when(F.col("tag").isin("b", "strong"), "**")
        .when((F.col("tag") == "br") & (F.col("kind") == "open"), "\n\n")
        .otherwise("")
    )
    piece = F.when(F.col("kind") == "text", F.when(inside("small"), F.upper("text")).otherwise(F.col("text"))).otherwise(mark)
    rows = events.select(*keys, F.struct("spine_idx", "ev", piece.alias("p")).alias("r")).filter("r.p <> ''")
    joined = rows.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["p"]), "").alias("md"))
    return joined.withColumn("md", F.trim(F.regexp_replace("md", r"[ \t\x{a0}]+", " ")))
