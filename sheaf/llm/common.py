"""Shared plumbing of the corpus operators: shared folders, written tables, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in an Arrow batch: bounds what a Python worker holds when texts are long.
BATCH_ROWS = 256


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, as one row can be a very long text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once for each Spark context."""
    context = spark.sparkContext
    if getattr(context, "_sheaf_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp()) / "sheaf_package.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(str(target))
    context._sheaf_shipped = True


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder that driver and executors share, under spark.checkpoint.dir.

    If that is unset, a local session gets a temporary one; on a cluster there is no folder that could be guessed.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='sheaf-checkpoints-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    folder = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _folders.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


_folders: dict[str, list[str]] = {}


def mark(spark: SparkSession) -> int:
    """How many shared folders this application has so far, for a later release of those that come after."""
    return len(_folders.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, since: int = 0, keep: int = 0) -> int:
    """Deletes what this application has written to shared folders since a mark, but for the last `keep` of them; to be called when the results that read it are stored. Returns how many folders."""
    folders = _folders.get(spark.sparkContext.applicationId, [])
    gone = folders[since : len(folders) - keep]
    for folder in gone:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        folders.remove(folder)
    return len(gone)


TEXTS = "zstd"  # compression of tables that hold whole texts
#: Nobody looks for a mark of success in tables that are read where they were written; the driver starts a process for each on some file systems.
UNMARKED = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}


def written(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """The rows written to a shared folder and read again: later stages don't recompute what an executor loses."""
    path = shared_folder(df.sparkSession, label)
    df.write.options(**UNMARKED).parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def dealt_out(df: DataFrame) -> DataFrame:
    """One side of a join that is to be shuffled. For rows that grow with the input: what Spark takes their size to be, after an explode or by a compressed file, says little about what a broadcast would hold in the driver."""
    return df.hint("merge")


def texts(docs: DataFrame, *more: str, column: str = "text") -> DataFrame:
    """doc_id and text only, so that columns with clashing names can't disturb; a null text stays null."""
    return docs.select("doc_id", F.col(column).alias("text"), *more)


def to_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def columns_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[list, ...]]:
    for b in batches:
        yield tuple(b.column(b.schema.get_field_index(n)).to_pylist() for n in names)
