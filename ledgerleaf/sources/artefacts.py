"""A sink of files by name: a Python data source whose writers stage what they write, and whose commit shows it.

``write(df, path)`` writes df (target, content): the content of every row as the file ``target`` below path.  Tasks write into a staging folder
below path, each attempt into one of its own; when all tasks are done the driver moves the files of the attempts that
succeeded to their names, and the staging folder goes.  A task that is tried again, or a job that fails, leaves no file.  Paths are URIs of any
file system that Arrow knows (hdfs, s3, gs, file); a plain path is one that all executors share.

A target is relative and stays below path.  Of rows with one target the last moved holds.  A null content is an empty file.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

NAME = "artefacts"


def file_system(path: str):
    """(file system, path in it)"""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if colon else path).lstrip("/")
    return fs.FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    folder: str
    targets: list


class ArtefactWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path, self.staging = path.rstrip("/"), f"_staging-{uuid.uuid4().hex}"

    def write(self, rows: Iterator[Row]) -> Written:
        from pyspark import TaskContext

        task = TaskContext.get()
        fs, root = file_system(self.path)
        folder = f"{root}/{self.staging}/{task.partitionId()}-{task.taskAttemptId()}"
        targets = []
        for row in rows:
            target = posixpath.normpath(row.target)
            if target.startswith(("/", "..")) or target == ".":
                raise ValueError(f"no name below the sink: {row.target!r}")
            fs.create_dir(posixpath.dirname(f"{folder}/{target}"), recursive=True)
            with fs.open_output_stream(f"{folder}/{target}") as out:
                out.write(bytes(row.content or b""))
            targets.append(target)
        return Written(folder, targets)

    def commit(self, messages: list) -> None:
        fs, root = file_system(self.path)
        for m in messages:
            for target in dict.fromkeys(m.targets if m else []):
                fs.create_dir(posixpath.dirname(f"{root}/{target}"), recursive=True)
                fs.move(f"{m.folder}/{target}", f"{root}/{target}")
        self._clear(fs, root)

    def abort(self, messages: list) -> None:
        self._clear(*file_system(self.path))

    def _clear(self, fs, root: str) -> None:
        from pyarrow.fs import FileType

        if fs.get_file_info(f"{root}/{self.staging}").type == FileType.Directory:
            fs.delete_dir(f"{root}/{self.staging}")


class Artefacts(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "target string, content binary"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return ArtefactWriter(self.options["path"])


def write(rows: DataFrame, path: str) -> None:
    """Writes rows (target, content) as files below path."""
    rows.sparkSession.dataSource.register(Artefacts)
    rows.select("target", "content").write.format(NAME).mode("append").option("path", path).save()
