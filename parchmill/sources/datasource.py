"""Documents as a Spark data source: ``spark.read.format("parchmill").load(folder)``, and the same as a stream of new files.

Files are listed and read through pyarrow's file systems, so folders can lie on
local disks, HDFS or object stores; files of about PART_BYTES are one task.
Rows are those of ``files.PARSED``: paged formats have printed lines in place of
blocks, from which ``files.laid`` makes the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from . import files

#: Bytes of files that one task reads, roughly; files of one micro-batch at most.
PART_BYTES, BATCH_FILES = 32 << 20, 10_000


@dataclass
class Files(InputPartition):
    paths: list[str]


def wanted(path: str) -> bool:
    """The same rule as ``files.wanted``, for a path."""
    name = path.rsplit("/", 1)[-1]
    return "." + name.rsplit(".", 1)[-1].lower() in files.LOADERS and name not in files.SKIPPED and not name.startswith(".")


def listed(folder: str) -> list[tuple[int, str, int]]:
    """(time in nanoseconds, path, size) of the documents below a folder, in order."""
    system, path = pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("/") else f"/{folder}")
    found = [system.get_file_info(path)]
    if found[0].type == pafs.FileType.Directory:
        found = [f for f in system.get_file_info(pafs.FileSelector(path, recursive=True)) if f.type == pafs.FileType.File and wanted(f.path)]
    elif found[0].type != pafs.FileType.File:
        raise files.ConfigurationError(f"no such file or folder: {folder}")
    return sorted((f.mtime_ns or 0, f.path, f.size) for f in found)


def parts(found: list[tuple[int, str, int]], most: int) -> list[Files]:
    """Files dealt into tasks of about so many bytes."""
    out, size = [], most
    for _, path, n in found:
        if size >= most:
            out.append(Files([]))
            size = 0
        out[-1].paths.append(path)
        size += n
    return out


def read(folder: str, part: Files) -> Iterator[pa.RecordBatch]:
    """A batch per file."""
    system, _ = pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("/") else f"/{folder}")
    for path in part.paths:
        with system.open_input_stream(path) as f:
            content = f.read()
        yield files.parsed_batch(pa.array([path]), [files.parse_file(path, content, files.LOADERS)])


class Documents(DataSource):
    """Options: path, and partBytes."""

    @classmethod
    def name(cls) -> str:
        return "parchmill"

    def schema(self) -> str:
        return files.PARSED

    def reader(self, schema) -> DataSourceReader:
        return Reader(self.options["path"], int(self.options.get("partBytes", PART_BYTES)))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return StreamReader(self.options["path"], int(self.options.get("partBytes", PART_BYTES)))


class Reader(DataSourceReader):
    def __init__(self, folder: str, part_bytes: int):
        self.folder, self.part_bytes = folder, part_bytes

    def partitions(self) -> list[Files]:
        return parts(listed(self.folder), self.part_bytes)

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return read(self.folder, partition)


class StreamReader(DataSourceStreamReader):
    """An offset is the time and path of the last file taken, so a batch that runs again takes the same files."""

    def __init__(self, folder: str, part_bytes: int):
        self.folder, self.part_bytes, self.taken = folder, part_bytes, (-1, "")

    def initialOffset(self) -> dict:
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:
        new = [f[:2] for f in listed(self.folder) if f[:2] > self.taken][:BATCH_FILES]
        self.taken = new[-1] if new else self.taken
        return {"time": self.taken[0], "path": self.taken[1]}

    def partitions(self, start: dict, end: dict) -> list[Files]:
        low, high = ((o["time"], o["path"]) for o in (start, end))
        self.taken = max(self.taken, high)
        return parts([f for f in listed(self.folder) if low < f[:2] <= high], self.part_bytes)

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return read(self.folder, partition)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Documents)
