"""Recorded services as a data source: what services answered, kept in turns, read as a table or as a stream.

A turn is a folder of what was recorded at once, by service: root/turn=0000000001/service=ocr/*.parquet. It counts when its _SUCCESS mark is there, so
half a turn is never read. Which services are read, and whether only good answers are, is told to the source: files of other services aren't opened, and row
groups without wanted rows aren't read. A stream's offset is a number of turns; a batch is the turns since the last one, a partition for each file.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "service string, request string, ok boolean, answer string, error string, turn long"
FIELDS = ("request", "ok", "answer", "error")


def record(rows: DataFrame, root: str, turn: int) -> None:
    """rows (service, request, ok, answer, error) as a turn. A turn that is recorded again is written anew."""
    named = rows.select(F.coalesce("service", F.lit("")).alias("service"), *[F.col(c).cast("boolean" if c == "ok" else "string") for c in FIELDS])
    named.write.mode("overwrite").partitionBy("service").parquet(f"{root.rstrip('/')}/turn={turn:010d}")


def _store(root: str):
    from pyarrow import fs

    uri = root.replace("file:/", "file:///", 1) if root.startswith("file:/") and not root.startswith("file://") else root
    return fs.FileSystem.from_uri(uri)


def turns(root: str) -> list[int]:
    """The turns that are whole, in order."""
    from pyarrow import fs

    store, base = _store(root)
    found = store.get_file_info(fs.FileSelector(base, allow_not_found=True))
    numbers = sorted(int(f.base_name.removeprefix("turn=")) for f in found if f.base_name.startswith("turn="))
    marks = store.get_file_info([f"{base}/turn={n:010d}/_SUCCESS" for n in numbers])
    return [n for n, m in zip(numbers, marks, strict=True) if m.type != fs.FileType.NotFound]


@dataclass
class Recording(InputPartition):
    path: str
    service: str
    turn: int


def recordings(root: str, numbers: list[int], services: set[str] | None) -> list[Recording]:
    from urllib.parse import unquote

    from pyarrow import fs

    store, base = _store(root)
    out = []
    for n in numbers:
        folder = f"{base}/turn={n:010d}"
        for f in store.get_file_info(fs.FileSelector(folder, recursive=True)):
            if f.type == fs.FileType.File and f.path.endswith(".parquet"):
                service = unquote(f.path.removeprefix(folder).split("service=")[1].split("/")[0])
                service = "" if service == "__HIVE_DEFAULT_PARTITION__" else service
                if services is None or service in services:
                    out.append(Recording(f.path, service, n))
    return sorted(out, key=lambda r: r.path)


def rows_of(root: str, part: Recording, ok: bool | None) -> Iterator[pa.RecordBatch]:
    import pyarrow.dataset as ds

    store, _ = _store(root)
    wanted = None if ok is None else ds.field("ok") == ok
    for b in ds.dataset(part.path, filesystem=store, format="parquet", partitioning=None).to_batches(columns=list(FIELDS), filter=wanted, batch_size=1024):
        if b.num_rows:
            fixed = [pa.array([part.service] * b.num_rows, pa.string()), *(b.column(c) for c in FIELDS), pa.array([part.turn] * b.num_rows, pa.int64())]
            yield pa.RecordBatch.from_arrays(fixed, names=["service", *FIELDS, "turn"])


class RecordedReader(DataSourceReader):
    def __init__(self, root: str, services: set[str] | None, ok: bool | None):
        self.root, self.services, self.ok = root, services, ok

    def partitions(self) -> list[Recording]:
        return recordings(self.root, turns(self.root), self.services) or [Recording("", "", 0)]

    def read(self, partition: Recording) -> Iterator[pa.RecordBatch]:
        if partition.path:
            yield from rows_of(self.root, partition, self.ok)


class RecordedStream(DataSourceStreamReader):
    """An offset counts the turns that were whole in a row from the first one on, so none is passed by that is finished late."""

    def __init__(self, root: str, first: int = 1):
        self.root, self.first = root, first

    def initialOffset(self) -> dict:
        return {"turns": 0}

    def latestOffset(self) -> dict:
        n = 0
        for turn in turns(self.root):
            if turn != self.first + n:
                break
            n += 1
        return {"turns": n}

    def partitions(self, start: dict, end: dict) -> list[Recording]:
        return recordings(self.root, list(range(self.first + start["turns"], self.first + end["turns"])), None) or [Recording("", "", 0)]

    def read(self, partition: Recording) -> Iterator[pa.RecordBatch]:
        if partition.path:
            yield from rows_of(self.root, partition, None)


class Recorded(DataSource):
    """spark.read.format("recorded").load(folder), spark.readStream.format("recorded").load(folder). Turns are numbered from 1.

    Options: services, a JSON list of those to read, and ok, true or false. They are options and not filters that Spark pushes: Spark 4.1 keeps a Python
    source's first plan for its relation, so a DataFrame that was filtered once would give later uses without that filter too few rows.
    """

    @classmethod
    def name(cls) -> str:
        return "recorded"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> RecordedReader:
        services, ok = json.loads(self.options.get("services", "null")), json.loads(self.options.get("ok", "null"))
        return RecordedReader(self.options["path"], None if services is None else set(services), ok)

    def streamReader(self, schema: StructType) -> RecordedStream:
        return RecordedStream(self.options["path"])


def register(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(Recorded)
    return spark


def read(spark: SparkSession, root: str, services: list[str] | None = None, ok: bool | None = None) -> DataFrame:
    """What was recorded, of some services, answered well or not."""
    reader = register(spark).read.format("recorded")
    if services is not None:
        reader = reader.option("services", json.dumps(services))
    if ok is not None:
        reader = reader.option("ok", json.dumps(ok))
    return reader.load(root)
