"""EPUB files as documents in spine order. Archives are read as binary files and opened where they are read."""

from __future__ import annotations

import io
import posixpath
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCS = "source string, container string, path string, spine_idx int, html string"
NCX = "container string, position int, label string, href string"
HTML_TYPES = {"application/xhtml+xml", "text/html"}


def _tag(e: ElementTree.Element) -> str:
    return e.tag.rpartition("}")[2]


def package(z: zipfile.ZipFile) -> tuple[str, ElementTree.Element]:
    """Folder and root of the package document that the container names, else of the first one."""
    try:
        root = ElementTree.fromstring(z.read("META-INF/container.xml"))
        name = next(e.get("full-path") for e in root.iter() if _tag(e) == "rootfile")
    except (KeyError, StopIteration):
        name = next(n for n in z.namelist() if n.endswith(".opf"))
    return posixpath.dirname(name), ElementTree.fromstring(z.read(name))


def spine(z: zipfile.ZipFile) -> list[str]:
    """Paths of the HTML documents in reading order; references to nothing are dropped."""
    folder, root = package(z)
    items = {e.get("id"): (e.get("href"), e.get("media-type")) for e in root.iter() if _tag(e) == "item"}
    order = [items[r] for e in root.iter() if _tag(e) == "itemref" and (r := e.get("idref")) in items]
    paths = [posixpath.normpath(posixpath.join(folder, href)) for href, kind in order if kind in HTML_TYPES or kind is None]
    have = set(z.namelist())
    return [p for p in paths if p in have]


def _opened(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Documents of every archive; of an archive that can't be read one row with the error in place of the text and no path."""

    def documents(name: str, content: bytes) -> Iterator[tuple]:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for i, p in enumerate(spine(z)):
                yield source, name, p, i, z.read(p).decode("utf-8", "replace")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for name, content in zip(pdf.path, pdf.content):
                try:
                    rows = list(documents(name, content))
                except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, StopIteration, OSError, EOFError, zlib.error, NotImplementedError) as e:
                    rows = [(source, name, None, -1, f"{type(e).__name__}: {e}")]
                yield pd.DataFrame(rows, columns=["source", "container", "path", "spine_idx", "html"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, DOCS)


def epub_documents(spark: SparkSession, path: str, source: str) -> DataFrame:
    """(source, container, path, spine_idx, html) of every document in the archives at ``path``; those that can't be read are in ``epub_errors``."""
    return _opened(spark, path, source).filter("path is not null")


def epub_errors(spark: SparkSession, path: str, source: str) -> DataFrame:
    """(container, error) of the archives that can't be read; they don't end the job."""
    return _opened(spark, path, source).filter("path is null").select("container", F.col("html").alias("error"))


def epub_contents(spark: SparkSession, path: str) -> DataFrame:
    """(container, position, label, href): entries of the table of contents (NCX)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for name, content in zip(pdf.path, pdf.content):
                rows = []
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for n in z.namelist():
                        if n.endswith(".ncx"):
                            for i, point in enumerate(e for e in ElementTree.fromstring(z.read(n)).iter() if _tag(e) == "navPoint"):
                                label = next((t.text for t in point.iter() if _tag(t) == "text"), None)
                                href = next((c.get("src") for c in point.iter() if _tag(c) == "content"), None)
                                rows.append((name, i, (label or "").strip(), href))
                yield pd.DataFrame(rows, columns=["container", "position", "label", "href"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, NCX)


def numbered_files(contents: DataFrame, titles: DataFrame, chapters: DataFrame) -> DataFrame:
    """(container, book, chapter, path): chapter files numbered on from a book's entry. titles: title -> book; chapters: book, chapter_count (small)."""
    base = F.regexp_extract("href", r"^(.*?)(\d+)\.", 2).cast("int")
    books = contents.join(F.broadcast(titles), F.col("label") == F.col("title")).join(F.broadcast(chapters), "book")
    rows = books.select("container", "book", F.regexp_extract("href", r"^(.*?)(\d+)\.", 1).alias("stem"), F.regexp_extract("href", r"\.(\w+)", 1).alias("ext"), base.alias("base"), F.explode(F.sequence(F.lit(1), "chapter_count")).alias("chapter"))
    return rows.select("container", "book", "chapter", F.concat("stem", (F.col("base") + F.col("chapter")).cast("string"), F.lit("."), "ext").alias("path"))
