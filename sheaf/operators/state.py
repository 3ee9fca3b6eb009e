"""Run state as logs and the latest row of each key: checkpoints, catalogue, review, metrics, rate windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheaf.functions.vocabulary import STAGES


def stage_number(column: str = "stage"):
    return F.create_map(*[F.lit(v) for i, s in enumerate(STAGES) for v in (s, i)])[F.col(column)]


def latest(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key, combined before the shuffle."""
    names = [c for c in log.columns if c not in keys]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*names), F.struct(*order)).alias("r")).select(*keys, "r.*")


def resume_points(stages: DataFrame) -> DataFrame:
    """(key, stage, status) of latest stages: the first stage in order that isn't completed; none if all are. Keys without stages count as completed."""
    done = stages.groupBy("key").agg(F.collect_set(F.when(F.col("status") == "completed", F.col("stage"))).alias("done"))
    todo = F.filter(F.array(*[F.lit(s) for s in STAGES]), lambda s: ~F.array_contains("done", s))
    return done.select("key", F.get(todo, F.lit(0)).alias("resume_stage"), F.when(F.size(todo) > 0, F.get(F.array(*[F.lit(s) for s in STAGES]), stage_of(todo) - 1)).alias("previous_stage"))


def stage_of(todo):
    """Place of the first stage to do in the order of all."""
    return F.array_position(F.array(*[F.lit(s) for s in STAGES]), F.get(todo, F.lit(0))).cast("int") - 1


def pending(files: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Files whose export isn't completed."""
    return files.join(checkpoints.where("stage = 'export' and status = 'completed'").select("key"), "key", "left_anti")


def checkpoint_summary(checkpoints: DataFrame) -> DataFrame:
    """Of each exam the number of papers and its years, newest first."""
    return checkpoints.groupBy("exam").agg(F.count("*").alias("papers"), F.array_join(F.sort_array(F.collect_set("year"), False), ",").alias("years"))


def upsert(current: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """New rows in place of old ones with their key. For a new path: never written over what is being read."""
    return current.join(changes.select(*keys), keys, "left_anti").unionByName(changes)


def review_state(log: DataFrame) -> DataFrame:
    """(paper, number, action, seq): the last action on each question, counted for each paper, and the share that is done."""
    last = latest(log, ["paper", "number"], ["seq"])
    out = last.groupBy("paper").agg(F.count("*").alias("reviewed"), *(F.count_if(F.col("action") == a).alias(n) for a, n in (("accept", "accepted"), ("edit", "edited"), ("skip", "skipped"), ("flag", "flagged"))))
    return out.withColumn("done_percent", F.round(100 * (F.col("accepted") + F.col("edited")) / F.col("reviewed"), 1))


def signoff(state: DataFrame) -> DataFrame:
    """verified if something was accepted or edited and nothing skipped, needs-review if something was skipped, else unverified."""
    return state.select("paper", F.when(F.col("accepted") + F.col("edited") == 0, "unverified").when(F.col("skipped") > 0, "needs-review").otherwise("verified").alias("status"))


def rate_window(calls: DataFrame, limit: int, seconds: int = 60) -> DataFrame:
    """(provider, ts, seq): calls of the last minute up to each, and whether it would have been admitted. The window is open on the left, so it is a microsecond shorter."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    w = Window.partitionBy("provider").orderBy(micros).rangeBetween(-(seconds * 1_000_000 - 1), Window.currentRow)
    out = calls.withColumn("in_window", F.count("*").over(w))
    return out.withColumn("admitted", F.col("in_window") <= limit)


def log_tail(log: DataFrame, n: int = 100) -> DataFrame:
    """The newest n rows: a bounded ring."""
    return log.orderBy(F.desc("ts"), F.desc("seq")).limit(n)


def failover(attempts: DataFrame) -> DataFrame:
    """(chunk, attempt, provider, ok): of each chunk the first attempt that went well."""
    return attempts.where("ok").groupBy("chunk").agg(F.min_by("provider", "attempt").alias("provider"), F.min("attempt").alias("attempt"))


def integrity(files: DataFrame) -> DataFrame:
    """(path, stated, computed): ok, mismatch, or missing for files without a checksum; metadata files are left out."""
    rows = files.where(~F.col("path").endswith("metadata.json"))
    status = F.when(F.coalesce("stated", F.lit("")) == "", "missing").when(F.col("stated") == F.col("computed"), "ok").otherwise("mismatch")
    return rows.groupBy(status.alias("status")).agg(F.count("*").alias("files"))
