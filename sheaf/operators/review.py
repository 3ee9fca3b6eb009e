"""Review sessions as a state machine over an event log: start, actions, current, cancel.

An event is a function from a session's state to the next. What a stretch of events does is one of two things: if it has a start or a
cancel, the state after it doesn't depend on the one before, but on the last of these and on the number of actions since; if not, it moves the
cursor by its actions. So a stretch is summed up as (last start or cancel, actions since), two stretches in a row are one again, and that is
associative: the log is cut into ranges, each is run through for itself, and the ranges' sums are carried on, one row for each. One
session that holds most of the log is run by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaf.operators.places import ranged

NO_SESSION, NOT_FOUND = "no active review session", "paper not found"


def replayed(log: DataFrame) -> DataFrame:
    """(reviewer, seq, kind, total) with what each event did.

    kind: start opens a session over `total` questions (null: the paper isn't there, so it is refused and changes nothing), in place of any
    other; cancel ends it, also if there is none; current asks; all else is an action on the question at the cursor, a blank or null one
    an accept. Added: `action` (null but for actions), `refused` (why, or null), `question` (from 0: what the action was recorded for),
    `position`, `of` and `state` (none, active, done) after the event, `progress` in percent, rounded. A session over no questions is active until
    an action closes it. Events of one reviewer with equal seq follow each other by kind, then total; null reviewers are one.
    """
    kind = F.coalesce(F.col("kind"), F.lit(""))
    opens = (kind == "start") & F.col("total").isNotNull()
    acts = ~kind.isin("start", "cancel", "current")
    marked = log.select("reviewer", "seq", "kind", F.col("total").cast("long").alias("total"))
    by = [F.asc_nulls_first(c) for c in ("reviewer", "seq", "kind", "total")]
    rows = ranged(marked, *by)  # _range and _nth, written
    resets = opens | (kind == "cancel")
    here = Window.partitionBy("reviewer", "_range").orderBy("_nth")
    done = here.rowsBetween(Window.unboundedPreceding, -1)
    count = F.coalesce(F.sum(acts.cast("long")).over(done), F.lit(0).cast("long"))  # actions before this event in its range
    rows = rows.withColumns({"_count": count, "_opens": opens, "_acts": acts, "_resets": resets})
    reset = F.struct(F.when(F.col("_opens"), F.col("total")).alias("of"), F.col("_count").alias("at"))
    rows = rows.withColumn("_reset", F.last(F.when(F.col("_resets"), reset), ignorenulls=True).over(done))
    sums = rows.groupBy("reviewer", "_range").agg(
        F.max_by(F.when(F.col("_resets"), reset), F.when(F.col("_resets"), F.col("_nth"))).alias("reset"), F.count_if("_acts").alias("acts")
    )
    # A row for each range that begins inside a session: what the ranges before it sum up to.
    before = Window.partitionBy("reviewer").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum("acts").over(before), F.lit(0).cast("long"))
    sums = sums.withColumn("_total", total).withColumn("_carry", F.last(F.when(F.col("reset").isNotNull(), F.struct(F.col("reset.of").alias("of"), (F.col("_total") + F.col("reset.at")).alias("at"))), ignorenulls=True).over(before))
    carried = sums.withColumn("_first", F.row_number().over(Window.partitionBy("reviewer").orderBy("_range"))).where("_first > 1")
    carried = carried.select(F.col("reviewer").alias("_reviewer"), F.col("_range").alias("_in"), "_carry", F.col("_total").alias("_before"))
    rows = rows.join(F.broadcast(carried), F.col("reviewer").eqNullSafe(F.col("_reviewer")) & (F.col("_range") == F.col("_in")), "left")
    known, carry = F.col("_reset").isNotNull(), F.col("_carry").isNotNull()
    of = F.when(known, F.col("_reset.of")).when(carry, F.col("_carry.of"))
    acted = F.when(known, F.col("_count") - F.col("_reset.at")).when(carry, F.col("_before") + F.col("_count") - F.col("_carry.at")).otherwise(0)
    return _told(rows.withColumns({"_of": of, "_acted": acted}))


def _active(of: Column, acted: Column) -> Column:
    """Actions beyond the last question are refused, so a session is over when it had as many as questions, and one at least."""
    return of.isNotNull() & (acted < F.greatest(of, F.lit(1)))  # greatest skips nulls


def _told(rows: DataFrame) -> DataFrame:
    """What each event did, from the questions of the session before it (null: none) and the actions that came since it began."""
    of, acted = F.col("_of"), F.col("_acted")
    active = _active(of, acted)
    new_of = F.when(F.col("_opens"), F.col("total")).when(F.col("_resets"), None).otherwise(of)
    new_acted = F.when(F.col("_resets"), 0).otherwise(acted + F.col("_acts").cast("long"))
    position = F.when(new_of.isNotNull(), F.least(new_acted, new_of))
    refused = F.when((F.col("kind") == "start") & ~F.col("_opens"), NOT_FOUND).when((F.col("_acts") | (F.col("kind") == "current")) & ~active, NO_SESSION)
    return rows.select(
        "reviewer",
        "seq",
        "kind",
        "total",
        F.when(F.col("_acts"), F.when(F.trim(F.coalesce("kind", F.lit(""))) == "", "accept").otherwise(F.col("kind"))).alias("action"),
        refused.alias("refused"),
        F.when(F.col("_acts") & active & (of > 0), acted).alias("question"),
        position.alias("position"),
        new_of.alias("of"),
        F.when(new_of.isNull(), "none").when(_active(new_of, new_acted), "active").otherwise("done").alias("state"),
        F.when(new_of > 0, F.floor(100 * position / new_of + 0.5)).alias("progress"),
    )


def sessions(replay: DataFrame) -> DataFrame:
    """Of each reviewer the state after the last event, and the recorded actions of all sessions by kind."""
    last = F.max_by(F.struct("state", "position", "of", "progress"), F.struct("seq", F.coalesce("kind", F.lit("")), F.coalesce("total", F.lit(-1))))
    kinds = ("accept", "edit", "skip", "flag")
    return replay.groupBy("reviewer").agg(
        last.alias("l"), *[F.count_if((F.col("action") == k) & F.col("question").isNotNull()).alias(f"n_{k}") for k in kinds], F.count("refused").alias("n_refused")
    ).select("reviewer", "l.*", *[f"n_{k}" for k in kinds], "n_refused")


def recorded_edits(replay: DataFrame, edits: DataFrame) -> DataFrame:
    """Edits (reviewer, seq, field, value) of actions that were recorded, each for its question: what `curate.applied_edits` takes, with the question as number."""
    took = replay.where((F.col("action") == "edit") & F.col("question").isNotNull()).select(F.col("reviewer").alias("paper"), F.col("question").alias("number"), "seq")
    named = edits.select(F.col("reviewer").alias("_reviewer"), F.col("seq").alias("_seq"), "field", "value")
    return took.join(named, F.col("paper").eqNullSafe(F.col("_reviewer")) & (F.col("seq") == F.col("_seq"))).drop("_reviewer", "_seq")
