"""Results of stages kept as tables, by key and stage, and put in place by manifests."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sheaf.streaming.events import folder


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows written below spark.checkpoint.dir and read again: what is used twice is computed once, and a lost executor costs a task."""
    path = folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Manifests:
    """Small JSON documents by number below a folder: the newest whole one counts.

    A manifest ends with the digest of what stands before it, so one that a crash cut short counts for nothing. No manifest is written over: whoever finds
    the next number taken reads again and takes the one after, so two writers don't lose each other's change.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.path = spark._jvm.org.apache.hadoop.fs.Path(root)
        self.fs = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        if not self.fs.exists(self.path):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(self.path)]
        return sorted((int(n.removeprefix("manifest-")) for n in names if n.startswith("manifest-")), reverse=True)

    def _file(self, number: int):
        return self.spark._jvm.org.apache.hadoop.fs.Path(self.path, f"manifest-{number:010d}")

    def _read(self, number: int) -> dict | None:
        stream = self.fs.open(self._file(number))
        try:
            raw = bytes(stream.readAllBytes())
        finally:
            stream.close()
        body, _, digest = raw.rpartition(b"\n")
        return json.loads(body) if hashlib.sha256(body).hexdigest().encode() == digest else None

    def newest(self) -> dict:
        for number in self._numbers():
            if (found := self._read(number)) is not None:
                return found
        return {}

    def change(self, change: Callable[[dict], dict]) -> dict:
        """The newest manifest changed and put in place as one step."""
        while True:
            number = max(self._numbers(), default=0) + 1
            new = change(self.newest())
            body = json.dumps(new, sort_keys=True).encode()
            self.fs.mkdirs(self.path)
            try:
                stream = self.fs.create(self._file(number), False)
            except Py4JJavaError as error:
                if "exist" not in str(error.java_exception):
                    raise
                continue
            try:
                stream.write(bytearray(body + b"\n" + hashlib.sha256(body).hexdigest().encode()))
            finally:
                stream.close()
            return new


class StageCache:
    """Results of stages by key, in folders that are never written twice; a manifest for each key says which one is a stage's result.

    A result takes the old one's place when its manifest is there, not before: a crash at any moment leaves the old result or the new one. `stage` is what
    makes a run resumable: it gives a stage's result if that was made from the same inputs, else makes and keeps it.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.ran: list[str] = []  # stages that this object has run, in order

    def _folder(self, key: str) -> str:
        return f"{self.root}/{quote(key, safe='')}"

    def _manifests(self, key: str) -> Manifests:
        return Manifests(self.spark, f"{self._folder(key)}/manifests")

    def save(self, key: str, stage: str, rows: DataFrame, inputs: str = "") -> DataFrame:
        """Written to a folder of its own, so that rows may be made from what they replace."""
        version = f"{quote(stage, safe='')}/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self._folder(key)}/{version}")
        entry = {"version": version, "inputs": inputs, "schema": rows.schema.jsonValue()}
        self._manifests(key).change(lambda old: old | {stage: entry})
        return self.load(key, stage)

    def load(self, key: str, stage: str) -> DataFrame | None:
        """The rows, or none if the stage has no result."""
        entry = self._manifests(key).newest().get(stage)
        if entry is None:
            return None
        return self.spark.read.schema(StructType.fromJson(entry["schema"])).parquet(f"{self._folder(key)}/{entry['version']}")

    def stage(self, key: str, inputs: str) -> Callable[[str, Callable[[], DataFrame]], DataFrame]:
        """A function of a stage's name and how to make its rows. A stage's inputs are those named here and the results of the stages that this run has passed before it."""
        passed: list[str] = [inputs]

        def run(name: str, make: Callable[[], DataFrame]) -> DataFrame:
            from_what = hashlib.sha256("\n".join(passed).encode()).hexdigest()
            entry = self._manifests(key).newest().get(name)
            if entry is None or entry["inputs"] != from_what:
                self.save(key, name, make(), from_what)
                self.ran.append(name)
                entry = self._manifests(key).newest()[name]
            passed.append(entry["version"])
            return self.load(key, name)

        return run

    def clean(self, key: str) -> int:
        """Deletes what no stage's newest result is; to be called when no run is under way. Returns how many folders."""
        manifests, n = self._manifests(key), 0
        kept = {entry["version"] for entry in manifests.newest().values()}
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        for stage in manifests.fs.listStatus(path(self._folder(key))):
            if stage.getPath().getName() == "manifests":
                continue
            for version in manifests.fs.listStatus(stage.getPath()):
                if f"{stage.getPath().getName()}/{version.getPath().getName()}" not in kept:
                    manifests.fs.delete(version.getPath(), True)
                    n += 1
        return n


def keep_all(name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What a run does with its stages that nobody asked to resume: each is written once."""
    return saved(make(), name)


METRIC = "key string, date string, total int, text_accuracy double, answer_accuracy double, topic_accuracy double, options_accuracy double, errors int"


class Metrics:
    """An append-only history of accuracies."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def append(self, rows: DataFrame) -> None:
        rows.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in METRIC.split(", ")]).write.mode("append").json(self.path)

    def read(self) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(METRIC).json(self.path) if there else self.spark.createDataFrame([], METRIC)
