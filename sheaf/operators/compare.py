"""Two versions of a paper side by side, and accuracy against a golden one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaf.functions.text import escape_html, plain

FIELDS = ("type", "subject", "number", "text", "options", "answer", "answers", "marks", "negative_marks", "topic", "section", "passage_id", "tags")


def told_apart(x: Column) -> Column:
    """A value that stands for a text where only equality counts: the text itself up to 64 bytes, else its digest, which is one byte longer."""
    return F.when(F.octet_length(x) <= 64, x).otherwise(F.concat(F.lit("\x01"), F.sha2(x, 256)))


def sided(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two versions as one table, `is_a` telling whose row it is. Both from one source are better marked where they are read, in one pass."""
    return a.withColumn("is_a", F.lit(True)).unionByName(b.withColumn("is_a", F.lit(False)))


def paired_diff(rows: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(paper, place) of rows of two versions: match, diff, missing-a or missing-b, and the fields that differ, comma-joined.

    One grouping brings a place's two rows together, and only short values or digests of long ones travel. A version has a place once; of
    several rows the greatest counts.
    """
    kind = dict(rows.dtypes)
    shape = F.struct(*[told_apart(plain(f, "array" if kind[f].startswith("array") else "string")).alias(f) for f in fields])
    side = F.col("is_a")
    both = rows.select("paper", "place", side, shape.alias("v")).groupBy("paper", "place").agg(F.max(F.when(side, F.col("v"))).alias("a"), F.max(F.when(~side, F.col("v"))).alias("b"))
    differs = F.array_compact(F.array(*[F.when(F.col(f"a.{f}") != F.col(f"b.{f}"), F.lit(f)) for f in fields]))
    status = F.when(F.col("a").isNull(), "missing-a").when(F.col("b").isNull(), "missing-b").when(F.size(differs) == 0, "match").otherwise("diff")
    fields_of = F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), F.array_join(differs, ",")).otherwise("")
    return both.select("paper", "place", status.alias("status"), fields_of.alias("fields"))


def positional_diff(a: DataFrame, b: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Two versions (paper, place, ...) place by place; see paired_diff."""
    keep = ("paper", "place", *fields)
    return paired_diff(sided(a.select(*keep), b.select(*keep)), fields)


def passage_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """By (paper, id); texts compared as they are, a null one only with a null one."""
    text = F.struct(told_apart(F.col("text")).alias("t"))
    rows = sided(a.select("paper", "id", "text"), b.select("paper", "id", "text")).select("paper", "id", "is_a", text.alias("v"))
    both = rows.groupBy("paper", "id").agg(F.max(F.when(F.col("is_a"), F.col("v"))).alias("a"), F.max(F.when(~F.col("is_a"), F.col("v"))).alias("b"))
    same = F.col("a.t").eqNullSafe(F.col("b.t"))
    return both.select("paper", "id", F.when(F.col("a").isNull(), "missing-a").when(F.col("b").isNull(), "missing-b").when(same, "match").otherwise("diff").alias("status"))


def diff_summary(diff: DataFrame) -> DataFrame:
    """Counts of each status for each paper, and whether it can be accepted as it is."""
    names = {"match": "matched", "diff": "differing", "missing-a": "missing_a", "missing-b": "missing_b"}
    out = diff.groupBy("paper").agg(F.count("*").alias("total"), *(F.count_if(F.col("status") == s).alias(n) for s, n in names.items()))
    return out.withColumns({"auto_acceptable": F.col("matched") == F.col("total"), "match_percent": F.round(100 * F.col("matched") / F.col("total"), 1)})


def overridden(a: DataFrame, b: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Places of both; a before b; a resolution's answer (paper, place, answer) before both."""
    one = a.select("paper", "place", F.struct("text", "answer").alias("x"))
    two = b.select("paper", "place", F.struct("text", "answer").alias("y"))
    both = one.join(two, ["paper", "place"], "full_outer").withColumn("q", F.coalesce("x", "y"))
    fixed = both.join(resolutions.select("paper", "place", F.col("answer").alias("fixed")), ["paper", "place"], "left")
    return fixed.select("paper", "place", "q.text", F.coalesce("fixed", "q.answer").alias("answer"))


def last_of_each(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key."""
    names = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*names), order).alias("r")).select(*keys, "r.*")


def golden_metrics(extracted: DataFrame, golden: DataFrame) -> DataFrame:
    """Accuracy of texts, answers, topics and options over the numbers both have; 0 if none."""
    e = extracted.select("paper", "number", *[F.col(c).alias(f"e_{c}") for c in ("text", "answer", "topic", "options")])
    g = golden.select("paper", "number", "text", "answer", "topic", "options")
    key = lambda c: F.lower(F.trim(F.substring(c, 1, 100)))
    right = {
        "text": key("text") == key("e_text"),
        "answer": (F.coalesce("answer", F.lit("")) != "") & (F.col("answer") == F.col("e_answer")),
        "topic": (F.col("topic") != "") & (F.lower("topic") == F.lower("e_topic")),
        "options": F.col("options").eqNullSafe(F.col("e_options")),
    }
    rate = {f"{k}_accuracy": F.round(F.coalesce(F.avg(F.coalesce(v, F.lit(False)).cast("int")) * 100, F.lit(0.0)), 4) for k, v in right.items()}
    out = g.join(e, ["paper", "number"]).groupBy("paper").agg(F.count("*").alias("checked"), *(c.alias(n) for n, c in rate.items()))
    return out.withColumn("overall_accuracy", F.round(sum((F.col(n) for n in rate), F.lit(0.0)) / 4, 4))


def accuracy_trends(history: DataFrame) -> DataFrame:
    """Of each key the number of runs, the last accuracy in order of seq, and the mean."""
    return history.groupBy("key").agg(F.count("*").alias("runs"), F.round(F.max_by("accuracy", "seq"), 4).alias("latest"), F.round(F.avg("accuracy"), 4).alias("average"))


def html_rows(diff: DataFrame) -> DataFrame:
    """Table rows of a report, one for each place that differs."""
    cell = lambda c: F.concat(F.lit("<td>"), escape_html(F.col(c).cast("string")), F.lit("</td>"))
    return diff.where("status <> 'match'").select("paper", "place", F.concat(F.lit("<tr>"), cell("place"), cell("status"), cell("fields"), F.lit("</tr>")).alias("html"))


def section_headers(questions: DataFrame) -> DataFrame:
    """Questions that begin a new section: the section isn't the last one that was named before."""
    before = F.last(F.nullif("section", F.lit("")), ignorenulls=True).over(Window.partitionBy("paper").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    return questions.withColumn("before", before).where("coalesce(section, '') <> '' and not section <=> before").drop("before")
