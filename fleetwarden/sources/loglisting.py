"""The log listing as a data source: one row a file, from names, sizes and times alone.

    spark.dataSource.register(LogListing)
    spark.read.format("log_listing").load(path)             # every file
    spark.readStream.format("log_listing").load(path)       # new and changed files

``path`` holds a ``server_id=<n>`` folder for each server, on a file system that is mounted on
every executor. A task lists the folders of some servers, so that a fleet of any size is
listed in parallel and no file is opened. A stream goes by modification times: a file is
reported when it appears and again whenever it has grown. ``settle`` (seconds, 2 unless
given) leaves the youngest files for the next batch, so that a file that appears while a
folder is being listed is not passed over.
"""

from __future__ import annotations

import datetime as dt
import os
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "server_id int, name string, size long, modification timestamp_ntz"
#: The folder of lines without a server, as Spark names it.
NO_SERVER = "__HIVE_DEFAULT_PARTITION__"
#: Folders that a task lists at least, and of a large fleet at most.
FOLDERS, MOST_FOLDERS = 64, 512


def write_log_folders(logs: DataFrame, path: str) -> None:
    """Log lines (``server_id, line``) as one text file a server, in the layout that the source
    lists. Each task writes the files of its servers straight into the mounted folder: a
    writer of Spark's opens a file for every folder by a temporary one, a checksum and two
    renames, the last of them in the driver. A file appears whole; a task that runs again
    replaces its files."""
    root = _mounted(path)

    def write(batches):
        import pyarrow as pa
        server, part, file = None, None, None

        def close() -> None:
            if file is not None:
                file.close()
                os.replace(part, os.path.join(os.path.dirname(part), "postgresql.txt"))

        for batch in batches:
            for sid, line in zip(batch.column("server_id").to_pylist(), batch.column("line").to_pylist()):
                if file is None or sid != server:
                    close()
                    server, folder = sid, os.path.join(root, f"server_id={NO_SERVER if sid is None else sid}")
                    os.makedirs(folder, exist_ok=True)
                    part = os.path.join(folder, f"_{uuid.uuid4().hex}")
                    file = open(part, "wb")
                file.write((line or b"") + b"\n")
        close()
        yield pa.RecordBatch.from_pydict({"done": pa.array([True])})

    os.makedirs(root, exist_ok=True)
    (logs.select("server_id", F.col("line").cast("binary").alias("line")).repartition("server_id").sortWithinPartitions("server_id")
     .mapInArrow(write, "done boolean").agg(F.count("done")).first())


def _mounted(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


class Folders(InputPartition):
    def __init__(self, folders: list[str], after: int = -1, upto: int = 1 << 63) -> None:
        super().__init__(None)
        self.folders, self.after, self.upto = folders, after, upto


def _folders(path: str) -> list[str]:
    with os.scandir(path) as entries:
        return sorted(e.path for e in entries if e.name.startswith("server_id=") and e.is_dir())


def _files(folder: str) -> Iterator[tuple[str, int, int]]:
    """Name, size and modification time (microseconds) of the files in a folder."""
    with os.scandir(folder) as entries:
        for e in entries:
            if e.is_file() and not e.name.startswith((".", "_")):
                yield e.name, e.stat().st_size, e.stat().st_mtime_ns // 1000


def _rows(part: Folders) -> Iterator[tuple]:
    for folder in part.folders:
        server = int(os.path.basename(folder).removeprefix("server_id="))
        for name, size, micros in _files(folder):
            if part.after < micros <= part.upto:
                yield server, name, size, dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=micros)


def _dealt(path: str, *span: int) -> list[Folders]:
    found = _folders(path)
    n = min(MOST_FOLDERS, max(FOLDERS, len(found) // FOLDERS))
    return [Folders(found[k: k + n], *span) for k in range(0, len(found), n)]


class _Batch(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[Folders]:
        return _dealt(self.path) or [Folders([])]

    def read(self, partition: Folders) -> Iterator[tuple]:
        return _rows(partition)


class _Stream(DataSourceStreamReader):
    """Offsets are modification times; the files between two of them are a batch."""

    def __init__(self, path: str, settle: float) -> None:
        self.path, self.settle = path, settle

    def initialOffset(self) -> dict:
        return {"upto": -1}

    def latestOffset(self) -> dict:
        young = int((time.time() - self.settle) * 1e6)
        return {"upto": max((m for f in _folders(self.path) for _, _, m in _files(f) if m <= young), default=-1)}

    def partitions(self, start: dict, end: dict) -> list[Folders]:
        return _dealt(self.path, start["upto"], end["upto"]) or [Folders([])]

    def read(self, partition: Folders) -> Iterator[tuple]:
        return _rows(partition)


class LogListing(DataSource):
    @classmethod
    def name(cls) -> str:
        return "log_listing"

    def schema(self) -> str:
        return SCHEMA

    def _path(self) -> str:
        return _mounted(self.options["path"])

    def reader(self, schema) -> _Batch:
        return _Batch(self._path())

    def streamReader(self, schema) -> _Stream:
        return _Stream(self._path(), float(self.options.get("settle", 2)))
