"""Votes of several extractors on each question.

The candidates of a question, one of each provider, meet in one array: as many as there are providers. All fields are voted
on in that array, so a paper takes one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.text import wide_trim
from sheaf.functions.vocabulary import PROVIDER_RANK

KEY = ("paper", "number")


def majority(values: Column) -> Column:
    """The most frequent value that isn't null; of equally frequent ones the first. Null if all are."""
    known = F.filter(values, lambda v: v.isNotNull())
    ranked = F.transform(known, lambda v, i: F.struct(F.size(F.filter(known, lambda w: w == v)).alias("n"), (-i).alias("first"), v.alias("v")))
    return F.array_max(ranked)["v"]


def provider_rank(provider: Column | str) -> Column:
    ranks = F.create_map(*[F.lit(v) for kv in PROVIDER_RANK.items() for v in kv])
    return F.coalesce(ranks[F.col(provider) if isinstance(provider, str) else provider], F.lit(-1))


def consensus(candidates: DataFrame) -> DataFrame:
    """From (paper, provider, rank, number, text, options, answer, subject), in order of rank: a row for each number from 1 on.

    Of a provider's candidates with one number the first (by pos, if there is such a column) counts.
    """
    pos = F.col("pos") if "pos" in candidates.columns else F.lit(0)
    row = F.struct("rank", pos.alias("pos"), "provider", "text", "options", "answer", "subject", provider_rank("provider").alias("trust"))
    groups = candidates.where("number >= 1").groupBy(*KEY).agg(F.array_sort(F.collect_list(row)).alias("all"))
    first = F.filter("all", lambda c, i: ~F.exists(F.slice("all", 1, i), lambda d: d["provider"] == c["provider"]))
    groups = groups.select(*KEY, first.alias("c"))
    answers = F.filter(F.transform("c", lambda c: c["answer"]), lambda a: F.coalesce(a, F.lit("")) != "")
    best = F.reduce(F.slice("c", 2, F.size("c")), F.get("c", F.lit(0)), lambda a, b: F.when(b["trust"] > a["trust"], b).otherwise(a))
    voted = groups.select(
        *KEY,
        "c",
        answers.alias("answers"),
        best.alias("best"),
        F.size("c").alias("n_providers"),
        majority(F.transform("c", lambda c: c["text"])).alias("text"),
        majority(F.transform("c", lambda c: c["options"])).alias("options"),
        F.coalesce(majority(answers), F.lit("")).alias("answer"),
        majority(F.transform("c", lambda c: c["subject"])).alias("subject"),
    )
    same = lambda a, b: F.coalesce(wide_trim(a), F.lit("")) == F.coalesce(wide_trim(b), F.lit(""))
    voted = voted.withColumns({"text_agreement": F.size(F.filter("c", lambda c: same(c["text"], F.col("text")))), "n_answers": F.size("answers"), "answer_agreement": F.size(F.filter("answers", lambda a: same(a, F.col("answer"))))})
    text_share = F.col("text_agreement") / F.col("n_providers")
    share = F.when(F.col("n_answers") > 0, (text_share + F.col("answer_agreement") / F.col("n_answers")) / 2).otherwise(text_share)
    return voted.withColumn("agreement", share).select(
        *KEY,
        "text",
        F.coalesce("options", F.col("best.options")).alias("options"),
        F.when(F.col("answer") != "", F.col("answer")).otherwise(F.coalesce("best.answer", F.lit(""))).alias("answer"),
        "subject",
        F.col("best.provider").alias("best_provider"),
        F.when((F.col("agreement") >= 0.8) & (F.col("n_providers") >= 2), "high").when(F.col("agreement") >= 0.5, "medium").otherwise("low").alias("confidence"),
        F.round("agreement", 6).alias("agreement"),
        "n_providers",
        "text_agreement",
        "n_answers",
        "answer_agreement",
    )


def conflicts(voted: DataFrame) -> DataFrame:
    """Numbers that no provider has, up to the paper's largest, and those with little agreement."""
    little = ((F.col("text_agreement") < 2) & (F.col("n_providers") > 2)) | ((F.col("answer_agreement") < 2) & (F.col("n_answers") > 2))
    return voted.where(little).select(*KEY, F.lit("low_agreement").alias("reason")).unionByName(gaps(voted).select(*KEY, F.lit("missing_from_all").alias("reason")))


def gaps(voted: DataFrame) -> DataFrame:
    """Missing numbers, each from the hole between two neighbours, in runs of at most GAP_RUN: no array grows with a hole, however wrong a number is read."""
    from pyspark.sql import Window

    before = F.coalesce(F.lag("number").over(Window.partitionBy("paper").orderBy("number")), F.lit(0))
    holes = voted.select("paper", F.col("number").cast("long").alias("number"), before.cast("long").alias("before")).where("number - before > 1")
    runs = holes.select("paper", "number", F.explode(F.sequence(F.col("before") + 1, F.col("number") - 1, F.lit(GAP_RUN * GAP_RUN))).alias("far"))
    runs = runs.select("paper", "number", F.explode(F.sequence("far", F.least(F.col("far") + GAP_RUN * GAP_RUN, F.col("number")) - 1, F.lit(GAP_RUN))).alias("near"))
    return runs.select("paper", F.explode(F.sequence("near", F.least(F.col("near") + GAP_RUN, F.col("number")) - 1)).alias("number"))


GAP_RUN = 4096


def merged_passages(passages: DataFrame) -> DataFrame:
    """(paper, id, text, rank): the first provider's passage of each id."""
    inner = [c for c in passages.columns if c not in ("paper", "id", "rank")]
    return passages.groupBy("paper", "id").agg(F.min_by(F.struct(*inner), "rank").alias("p")).select("paper", "id", "p.*")


def answer_key_found(flags: DataFrame) -> DataFrame:
    return flags.groupBy("paper").agg(F.bool_or("answer_key_found").alias("answer_key_found"))


def provider_agreement(candidates: DataFrame) -> DataFrame:
    """Share of equal texts and answers of each two providers, over the numbers both have."""
    one = candidates.select("paper", "number", F.col("provider").alias("a"), F.col("rank").alias("ra"), F.col("text").alias("ta"), F.col("answer").alias("aa"))
    two = candidates.select("paper", "number", F.col("provider").alias("b"), F.col("rank").alias("rb"), F.col("text").alias("tb"), F.col("answer").alias("ab"))
    both = one.join(two, ["paper", "number"]).where("ra < rb")
    return both.groupBy("a", "b").agg(F.count("*").alias("n"), F.round(F.avg(F.col("ta").eqNullSafe(F.col("tb")).cast("int")), 6).alias("text_share"), F.round(F.avg(F.col("aa").eqNullSafe(F.col("ab")).cast("int")), 6).alias("answer_share"))
