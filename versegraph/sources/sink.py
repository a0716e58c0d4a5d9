"""Sinks: one file for each row, JSON reports. Files are written by the tasks that hold the rows and moved to their places when the job ends; a repeated path is overwritten."""

from __future__ import annotations

import os
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


#: Where tasks put their files before the job's end, and the file that says how many there are.
STAGED, COUNT = "_staged", "_written"


class FileWriter(DataSourceWriter):
    """Tasks write to a folder of their own below the root; the job's end moves what its tasks wrote, its failure removes it."""

    def __init__(self, root: str):
        self.root, self.job = root, uuid.uuid4().hex

    def _open(self) -> tuple[fs.FileSystem, str]:
        """The file system of the root (a URI that pyarrow knows, or a local path) and the path there."""
        system, path = fs.FileSystem.from_uri(self.root) if "://" in self.root or self.root.startswith("file:") else (fs.LocalFileSystem(), os.path.abspath(self.root))
        return system, path.rstrip("/")

    def write(self, rows: Iterator[Row]) -> Written:
        system, root = self._open()
        folder = f"{root}/{STAGED}/{self.job}/{uuid.uuid4().hex}"
        system.create_dir(folder)
        files = []
        for row in rows:
            path = posixpath.normpath(f"{root}/{row.rel_path}")
            if not path.startswith(root + "/"):
                raise ValueError(f"path leaves the output folder: {row.rel_path}")
            staged = f"{folder}/{len(files)}"
            with system.open_output_stream(staged) as f:
                f.write((row.content or "").encode("utf-8"))
            files.append((staged, path))
        return Written(files)

    def commit(self, messages: list) -> None:
        system, root = self._open()
        made, n = set(), 0
        for staged, path in (x for m in messages if m is not None for x in m.files):
            folder = posixpath.dirname(path)
            if folder not in made:
                system.create_dir(folder)
                made.add(folder)
            system.move(staged, path)
            n += 1
        with system.open_output_stream(f"{root}/{COUNT}") as f:
            f.write(str(n).encode())
        self.abort(messages)

    def abort(self, messages: list) -> None:
        system, root = self._open()
        if system.get_file_info(f"{root}/{STAGED}/{self.job}").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/{STAGED}/{self.job}")


class FilePerRow(DataSource):
    """``df.write.format("file_per_row").option("path", root)``: columns rel_path and content."""

    @classmethod
    def name(cls) -> str:
        return "file_per_row"

    def schema(self) -> str:
        return "rel_path string, content string"

    def writer(self, schema, overwrite: bool) -> FileWriter:
        return FileWriter(self.options["path"])


def write_files(df: DataFrame, root: str, overwrite: bool = True) -> int:
    """Writes (rel_path, content) as files below ``root``, a folder that all executors share, and returns how many."""
    df.sparkSession.dataSource.register(FilePerRow)
    rows = df.select("rel_path", "content").filter("rel_path is not null")
    rows.write.format("file_per_row").mode("overwrite" if overwrite else "append").save(root)
    system, path = FileWriter(root)._open()
    with system.open_input_stream(f"{path}/{COUNT}") as f:
        return int(f.read())


def safe_name(c):
    """A title as a file name."""
    return F.replace(F.regexp_replace(c, ":", ""), F.lit("/"), F.lit("-"))


def report_json(findings: DataFrame) -> DataFrame:
    """Findings of each path as one JSON line."""
    names = [c for c in findings.columns if c != "path"]
    return findings.groupBy("path").agg(F.to_json(F.array_sort(F.collect_list(F.struct(*names)))).alias("findings"))
