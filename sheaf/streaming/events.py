"""Event streams: tumbling counts, sessions, deduplication."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under spark.checkpoint.dir, which executors share; only a local session gets a temporary one if that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.gettempdir()}/sheaf-streams"
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def event_stream(spark: SparkSession, path: str) -> DataFrame:
    """A stream of a table of events (a folder, or a file in one), its time as a timestamp so that watermarks work."""
    schema = spark.read.parquet(path).schema
    up, _, name = path.rstrip("/").rpartition("/")
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(jpath).isDirectory()
    rows = reader.parquet(path) if whole else reader.option("pathGlobFilter", name).parquet(up)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, width: str = "1 day", late: str = "10 minutes") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", F.round("total", 2).alias("total"))


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    return events.withWatermark("ts", "10 minutes").groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))


def deduplicated(events: DataFrame, keys: list[str], within: str = "1 day") -> DataFrame:
    return events.withWatermark("ts", within).dropDuplicatesWithinWatermark(keys)


def run_to_end(stream: DataFrame, mode: str, label: str) -> DataFrame:
    """Runs a stream over what is there; its last result, written by foreachBatch to a shared folder."""
    spark = stream.sparkSession
    out, schema = folder(spark, label), stream.schema
    overwrite = mode == "complete"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(out if overwrite else f"{out}/batch={number}")  # a batch run again writes the same folder

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", folder(spark, f"{label}-state")).trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    return spark.read.schema(schema).parquet(out)
