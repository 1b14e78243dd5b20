"""Files with names of their own, written as one commit.

Spark's writers name their files ``part-...`` and leave what a failed job got
done. ``write_named`` writes lines to files whose names the rows carry: tasks
write to a staging folder beside the target, the commit moves whole files to
their names and puts ``_SUCCESS`` last, an abort removes the staging folder. So
a reader never meets half a file, and a failed job leaves the target as it was.

Rows are range-partitioned by file and order. A file that spans several tasks
comes as ``name.csv``, ``name.2.csv``, ... in order, so no task has to write a
whole category. The header, where there is one, starts every piece.

The target may be a local path or a URI that pyarrow can write (``file``,
``hdfs``, ``s3``, ``gs``).
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

STAGING = "_staging"


@dataclass
class Pieces(WriterCommitMessage):
    """(file, staged piece) of one task, in order."""

    partition: int
    pieces: list[tuple[str, str]]


def _checked(name: str | None) -> str:
    if not name or "/" in name or name.startswith((".", "_")):
        raise ValueError(f"not a file name: {name!r}")
    return name


def numbered(name: str, k: int) -> str:
    """Name of the k-th piece of a file."""
    stem, ext = posixpath.splitext(name)
    return name if k == 0 else f"{stem}.{k + 1}{ext}"


class NamedFilesWriter(DataSourceArrowWriter):
    def __init__(self, path: str, header: str | None, overwrite: bool):
        self.path, self.header, self.overwrite = path, header, overwrite
        self.run = uuid.uuid4().hex

    def _target(self) -> tuple[fs.FileSystem, str]:
        system, root = fs.FileSystem.from_uri(self.path)
        return system, root.rstrip("/")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Pieces:
        system, root = self._target()
        task = TaskContext.get()
        folder = f"{root}/{STAGING}/{self.run}/{task.partitionId()}-{task.taskAttemptId()}"
        system.create_dir(folder, recursive=True)
        pieces, out = [], None
        try:
            for batch in batches:
                for name, line in zip(batch.column("file").to_pylist(), batch.column("line").to_pylist()):
                    if not pieces or pieces[-1][0] != name:
                        if out is not None:
                            out.close()
                        pieces.append((_checked(name), f"{folder}/{len(pieces)}"))
                        out = system.open_output_stream(pieces[-1][1])
                        if self.header is not None:
                            out.write(f"{self.header}\n".encode())
                    if line is not None:
                        out.write(f"{line}\n".encode())
        finally:
            if out is not None:
                out.close()
        return Pieces(task.partitionId(), pieces)

    def commit(self, messages: list[Pieces | None]) -> None:
        system, root = self._target()
        system.create_dir(root, recursive=True)
        if self.overwrite:
            for info in system.get_file_info(fs.FileSelector(root)):
                if info.type == fs.FileType.File:
                    system.delete_file(info.path)
        seen: dict[str, int] = {}
        for message in sorted((m for m in messages if m is not None), key=lambda m: m.partition):
            for name, staged in message.pieces:
                system.move(staged, f"{root}/{numbered(name, seen.get(name, 0))}")
                seen[name] = seen.get(name, 0) + 1
        system.delete_dir(f"{root}/{STAGING}/{self.run}") if seen else None
        with system.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def abort(self, messages: list[Pieces | None]) -> None:
        system, root = self._target()
        staged = f"{root}/{STAGING}/{self.run}"
        if system.get_file_info(staged).type == fs.FileType.Directory:
            system.delete_dir(staged)


class NamedFiles(DataSource):
    """``df.write.format("named_files")`` for rows ``(file, line)``; options
    ``path`` and ``header``."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def writer(self, schema, overwrite: bool) -> NamedFilesWriter:
        if [f.name for f in schema.fields] != ["file", "line"]:
            raise ValueError("named files need the columns file and line")
        return NamedFilesWriter(self.options["path"], self.options.get("header"), overwrite)


def write_named(
    df: DataFrame, path: str, file: Column, line: Column, order: Sequence[Column | str], header: str | None = None,
    mode: str = "overwrite", partitions: int | None = None,
) -> None:
    """Write ``line`` of every row to ``file`` in ``order``, as one commit. A
    null line only makes sure that its file is there (with the header)."""
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be overwrite or append")
    df.sparkSession.dataSource.register(NamedFiles)
    keys = [F.col("file"), *[F.col(f"_o{i}") for i in range(len(order))]]
    rows = df.select(file.alias("file"), line.alias("line"), *[
        (F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order)
    ])
    ranged = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
    out = ranged.sortWithinPartitions(*keys).select("file", "line").write.format("named_files").mode(mode).option("path", path)
    (out if header is None else out.option("header", header)).save()


def category_files(cats: DataFrame, suffix: str = ".csv") -> DataFrame:
    """``(category_id, file)``: the category's title as a file name (``/`` as
    ``_``), with the id where two categories share a title."""
    name = F.replace(F.col("title"), F.lit("/"), F.lit("_"))
    shared = F.count(F.lit(1)).over(Window.partitionBy(name)) > 1  # the dimension: a few dozen rows
    label = F.when(shared, F.concat(name, F.lit(" ("), F.col("category_id").cast("string"), F.lit(")"))).otherwise(name)
    return cats.select("category_id", F.concat(label, F.lit(suffix)).alias("file"))
