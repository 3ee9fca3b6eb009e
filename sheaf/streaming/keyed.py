"""Keyed state in streams: a table of the latest row of each key, debounced changes, and a bounded history.

State lies in Spark's state store (RocksDB with a checkpoint of changes), a key's own row only, so a batch costs what it holds and not what the
table holds. Each batch writes what it gives out to a folder of its own, which a batch that is run again writes anew: after a crash the
stream goes on from its checkpoint and nothing is lost or doubled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sheaf.streaming.events import folder

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


def upserts(stream: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The stream of rows that are the latest of their key by `order` when their batch ends; each key once a batch at most, and only if a row of that batch took its place.

    Of equal rows that of the earlier batch stays; nulls come first. Rows are compared by Spark's own aggregation, which combines before the shuffle.
    """
    prepare(stream.sparkSession)
    now = F.unix_micros(F.current_timestamp())  # one time for a batch, the same one if it is run again
    best = F.max_by(F.struct(F.struct(*stream.columns).alias("row"), "_since"), F.struct(*order, -F.col("_since")))
    latest = stream.withColumn("_since", now).groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(best.alias("best"))
    return latest.where(F.col("best._since") == now).select("best.row.*")


def table_of(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The table that a log of changes (..., batch) stands for: of each key what its last batch gave out."""
    names = [c for c in changes.columns if c not in keys and c != "batch"]
    return changes.groupBy(*keys).agg(F.max_by(F.struct(*names), "batch").alias("r")).select(*keys, "r.*")


#: For whoever keeps changes by hand.
Stretch = tuple[int, int, tuple, tuple]  # first and last time of changes with no gap between them, the last change's place and row


def joined(a: list[Stretch], b: list[Stretch], gap: int) -> list[Stretch]:
    """Two lists of stretches in order as one; stretches with less than a gap between them become one, which keeps the later change."""
    out: list[Stretch] = []
    for s in sorted([*a, *b], key=lambda s: (s[0], s[2])):
        if out and s[0] - out[-1][1] < gap:
            first, last, place, row = out[-1]
            later = max((last, place, row), (s[1], s[2], s[3]), key=lambda x: x[:2])
            out[-1] = (first, *later)
        else:
            out.append(s)
    return out


def debounced(stream: DataFrame, keys: list[str], time: str, order: list[str], gap_ms: int, late: str = "0 seconds") -> DataFrame:
    """A key's changes that nothing follows for gap_ms, given out when the watermark (`late` behind the latest time) has passed that gap. Changes without a time are left out.

    They are the last rows of session windows, so the state holds a row for each stretch that is still open. Spark also joins
    rows that are a window's gap apart, so that is a microsecond less.
    """
    prepare(stream.sparkSession)
    marked = stream.where(F.col(time).isNotNull()).withWatermark(time, late)
    last = F.max_by(F.struct(*stream.columns), F.struct(time, *order))
    return marked.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys], F.session_window(time, f"{gap_ms * 1000 - 1} microseconds")).agg(last.alias("last")).select("last.*")


class History:
    """The newest `most` rows of all batches, a table for each batch: the newest of a batch and of the table before it."""

    def __init__(self, root: str, schema: StructType, order: list[str], most: int = 500):
        self.root, self.schema, self.order, self.most = root, schema, order, most

    def path(self, batch: int) -> str:
        return f"{self.root}/batch={batch}"

    def add(self, rows: DataFrame, batch: int) -> None:
        """A batch that is run again finds the same table before it, and writes the same one."""
        spark = rows.sparkSession
        old = self.read(spark, batch)
        rows = rows.select(*self.schema.names)
        newest = (rows if old is None else rows.unionByName(old)).orderBy(*[F.desc(c) for c in self.order]).limit(self.most)
        newest.write.mode("overwrite").parquet(self.path(batch))

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame | None:
        """The table of the last batch, or of the last one before a batch."""
        root = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return None
        done = [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(root) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
        done = [b for b in done if before is None or b < before]
        return spark.read.schema(self.schema).parquet(self.path(max(done))) if done else None


class Fed:
    """A stream over a folder that is filled slice by slice; each run takes what is new and ends, and the next one goes on from its checkpoint."""

    def __init__(self, spark: SparkSession, label: str, schema: StructType):
        self.spark, self.schema = spark, schema
        self.root, self.state, self.out = (folder(spark, f"{label}-{part}") for part in ("feed", "state", "out"))

    def feed(self, rows: DataFrame, number: int) -> None:
        rows.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.root}/slice={number}")

    def run(self, change: Callable[[DataFrame], DataFrame], mode: str, also: Callable[[DataFrame, int], None] | None = None) -> None:
        """`change` makes the stream that is written, a folder for each batch; `also` sees each batch of it."""
        rows = self.spark.readStream.schema(StructType([*self.schema.fields, StructField("slice", LongType())])).parquet(self.root).drop("slice")

        def write(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{self.out}/batch={number}")
            if also is not None:
                also(self.spark.read.schema(batch.schema).parquet(f"{self.out}/batch={number}"), number)

        stream = change(rows)
        self.given = stream.schema
        stream.writeStream.outputMode(mode).option("checkpointLocation", self.state).trigger(availableNow=True).foreachBatch(write).start().awaitTermination()

    def log(self) -> DataFrame:
        """All that the batches gave out, each with its batch."""
        return self.spark.read.schema(StructType([*self.given.fields, StructField("batch", LongType())])).parquet(self.out)


def slices_by(rows: DataFrame, time: str, n: int) -> list[DataFrame]:
    """The rows in n slices of equal width by a time; the first one also has those without."""
    first, last = rows.agg(F.min(time), F.max(time)).first()
    step = (last - first) / n if first is not None else None
    t = F.col(time)
    kind = rows.schema[time].dataType
    edge = lambda k: F.lit(first + step * k).cast(kind)
    if step is None:
        return [rows]
    return [rows.where(t.isNull() | (t < edge(1)) if k == 0 else t >= edge(k) if k == n - 1 else (t >= edge(k)) & (t < edge(k + 1))) for k in range(n)] if n > 1 else [rows]


