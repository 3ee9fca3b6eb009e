"""Texts, answers, topics and ids of questions, and the shape in which papers are exported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaf.functions.text import assign_section, normalize_answer, normalize_latex, prefix_int, question_id, wide_trim
from sheaf.operators.stages import saved


def normalize_texts(questions: DataFrame, columns: tuple[str, ...] = ("text",), compat: bool = False) -> DataFrame:
    return questions.withColumns({c: F.when(F.coalesce(c, F.lit("")) == "", F.col(c)).otherwise(normalize_latex(c, compat)) for c in columns})


def normalize_answers(questions: DataFrame) -> DataFrame:
    """Answers to indexes, sections by number. options: an array or null. Done once: a second time would shift answers again.

    A blank answer takes the first of `answers`, if there is such a column, which then is null; numbers in text become integers.
    """
    if "answers" in questions.columns:
        moved = (F.coalesce("answer", F.lit("")) == "") & (F.coalesce(F.size("answers"), F.lit(0)) > 0)
        first = F.get("answers", F.lit(0)).cast("string")
        questions = questions.withColumns({"answer": F.when(moved, F.coalesce(first, F.lit(""))).otherwise(F.col("answer")), "answers": F.when(~moved, F.col("answers"))})
    if dict(questions.dtypes)["number"] == "string":
        questions = questions.withColumn("number", prefix_int("number"))
    n = F.when(F.col("options").isNotNull(), F.size("options"))
    out = questions.withColumns({"answer": normalize_answer("answer", n), "section": assign_section("section", "number")})
    return out.withColumn("options", F.when(F.col("type") == "assertion-reason", None).otherwise(F.col("options")))


MOST_BROADCAST = 100_000  # rows of an alias table: some megabytes


def words(x: Column) -> Column:
    return F.filter(F.split(F.lower(x), "[^a-z0-9]+"), lambda w: w != "")


def word_counts_cosine(a: Column, b: Column) -> Column:
    """Cosine of two texts' word counts; 0 if either has no words."""
    x, y = words(a), words(b)
    count = lambda ws, w: F.size(F.filter(ws, lambda v: v == w))
    dot = F.aggregate(F.array_intersect(x, y), F.lit(0), lambda s, w: s + count(x, w) * count(y, w))
    square = lambda ws: F.aggregate(F.array_distinct(ws), F.lit(0), lambda s, w: s + count(ws, w) * count(ws, w))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(dot / F.sqrt((square(x) * square(y)).cast("double")))


def deletions(x: Column, most: int) -> Column:
    """The text and all that is left of it when up to `most` letters are taken out, each once."""
    shorter = lambda t: F.when(
        F.char_length(t) > 0, F.transform(F.sequence(F.lit(1), F.char_length(t)), lambda i: F.concat(F.substring(t, 1, i - 1), F.substring(t, i + 1, F.char_length(t))))
    ).otherwise(F.array().cast("array<string>"))
    out = level = F.array(x)
    for _ in range(most):
        level = F.array_distinct(F.flatten(F.transform(level, shorter)))
        out = F.array_union(out, level)
    return out


def near_strings(left: DataFrame, right: DataFrame, a: str, b: str, most: int) -> DataFrame:
    """(a, b, d) of the distinct strings of two columns that are at most `most` edits apart.

    Strings that near have a neighbour in common that both become by taking out up to `most` letters: these are the join's key, and the distance is verified
    after. A string of n letters has about n ** most / most! of them, so those too long for any partner are left out before. Nulls are near nothing.
    """
    x, y = left.select(a).where(F.col(a).isNotNull()).distinct(), right.select(b).where(F.col(b).isNotNull()).distinct()
    longest = y.agg(F.max(F.char_length(b))).first()[0]
    if longest is None:
        return x.crossJoin(y).select(a, b, F.lit(0).alias("d")).limit(0)
    x = x.where(F.char_length(a) <= longest + most)
    keyed = lambda d, c: d.select(c, F.explode(deletions(F.col(c), most)).alias("_v"))
    met = keyed(x, a).join(keyed(y, b), "_v").select(a, b).distinct()
    return met.withColumn("d", F.levenshtein(a, b, most)).where("d >= 0")


def normalize_topics(questions: DataFrame, aliases: DataFrame, tags: DataFrame, fuzzy: int = 2, least_cosine: float = 0.3, compat: bool = False) -> DataFrame:
    """A `topic_norm` for each (topic, subject): alias, then near alias, then like words, then the subject's tags, then a default.

    Only distinct topics that no exact alias explains are looked up among the aliases: near ones by what is left of both without a few letters, like ones
    by the words that both have. No topic is compared with all aliases, so the table can be long; up to MOST_BROADCAST rows it is broadcast. Unless compat
    is set, a topic that is one of its subject's tags stays, instead of being taken for a near alias of another, and of like
    words a canonical name that the topic holds as a whole goes before names and aliases that it shares a part with.
    """
    key = F.lower(wide_trim("topic"))
    few = aliases.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    spread = F.broadcast if few else lambda d: d
    asked = questions.select("topic", "subject").distinct().withColumn("key", key)
    blank = F.coalesce("key", F.lit("")) == ""
    aliases = aliases.select(F.col("alias"), F.col("canonical"), F.col("ord"))
    exact = asked.join(spread(aliases), F.col("key") == F.col("alias"), "left").select("topic", "subject", "key", F.col("canonical").alias("exact"))
    tagged = exact.join(F.broadcast(tags.select(F.col("subject").alias("s"), "tag")), (F.col("subject") == F.col("s")) & (F.col("key") == F.col("tag")), "left").drop("s")
    open_keys = tagged.where(F.col("exact").isNull() & ~blank & (F.lit(compat) | F.col("tag").isNull())).select("key").distinct()
    names = F.initcap(F.replace("canonical", F.lit("-"), F.lit(" ")))
    open_keys = saved(open_keys, "open-topics")
    close = near_strings(open_keys, aliases, "key", "alias", fuzzy).join(spread(aliases), "alias").select("key", "ord", "d")
    asked_words = open_keys.select("key", F.explode(F.array_distinct(words(F.col("key")))).alias("_w"))
    known_words = aliases.select("ord", F.explode(F.array_union(words(names), words(F.col("alias")))).alias("_w"))
    alike = asked_words.join(known_words, "_w").select("key", "ord").distinct()
    near = close.join(alike, ["key", "ord"], "full").join(spread(aliases), "ord")
    near = near.withColumns({"d": F.coalesce("d", F.lit(-1)), "by_name": word_counts_cosine(F.col("key"), names), "by_alias": word_counts_cosine(F.col("key"), F.col("alias"))})
    held = ~F.lit(compat) & (F.col("by_name") > least_cosine) & (F.size(F.array_except(words(names), words(F.col("key")))) == 0)
    near = near.groupBy("key").agg(
        F.min_by(F.when(F.col("d") >= 0, F.col("canonical")), F.when(F.col("d") >= 0, F.col("ord"))).alias("fuzzy"),
        F.max_by("canonical", F.struct("by_name", -F.col("ord"))).alias("like_name"),
        F.max("by_name").alias("name_score"),
        F.max_by("canonical", F.struct("by_alias", -F.col("ord"))).alias("like_alias"),
        F.max("by_alias").alias("alias_score"),
        F.max_by(F.when(held, F.col("canonical")), F.when(held, F.struct("by_name", -F.col("ord")))).alias("held"),
    )
    like = F.when(F.greatest("name_score", "alias_score") > least_cosine, F.coalesce("held", F.when(F.col("name_score") >= F.col("alias_score"), F.col("like_name")).otherwise(F.col("like_alias"))))
    found = tagged.join(near, "key", "left").withColumn("vocab", F.coalesce("exact", "fuzzy", like, "key"))
    near_tag = found.where(~blank & (F.col("vocab") == F.col("key"))).select("key", "subject").distinct()
    near_tag = near_tag.join(F.broadcast(tags.select(F.col("subject").alias("s"), F.col("tag").alias("t"), "ord")), F.col("subject") == F.col("s")).where(F.levenshtein(F.col("key"), F.col("t"), fuzzy) >= 0)
    near_tag = near_tag.groupBy("key", "subject").agg(F.min_by("t", "ord").alias("near_tag"))
    default = F.concat(F.lit("general-"), F.col("subject"))
    found = found.join(near_tag, ["key", "subject"], "left").select(
        "topic", "subject", F.when(blank, default).when(F.col("vocab") != F.col("key"), F.col("vocab")).otherwise(F.coalesce("tag", "near_tag", default)).alias("topic_norm")
    )
    mapped = found.select(F.col("topic").alias("_t"), F.col("subject").alias("_s"), "topic_norm")
    return questions.join(mapped, F.col("topic").eqNullSafe(F.col("_t")) & F.col("subject").eqNullSafe(F.col("_s")), "left").drop("_t", "_s")


def assign_ids(questions: DataFrame, tombstones: DataFrame | None = None) -> DataFrame:
    """id from the number within paper and subject, in order of pos. Ids in the tombstone table (id) get the first free suffix -r1, -r2, ..."""
    w = Window.partitionBy("exam", "year", "shift", "subject").orderBy("pos")
    out = questions.withColumn("subject_number", F.row_number().over(w)).withColumn("id", question_id("exam", "year", "shift", "subject", "subject_number"))
    if tombstones is None:
        return out
    dead = tombstones.select(F.regexp_replace("id", r"-r\d+$", "").alias("base"), F.coalesce(F.regexp_extract("id", r"-r(\d+)$", 1).try_cast("int"), F.lit(0)).alias("k")).distinct()
    dead = dead.groupBy("base").agg(F.sort_array(F.collect_set("k")).alias("ks"))
    free = F.element_at(F.array_except(F.sequence(F.lit(0), F.size("ks")), F.col("ks")), 1)
    joined = out.join(dead, F.col("id") == F.col("base"), "left").withColumn("k", F.coalesce(free, F.lit(0)))
    return joined.withColumn("id", F.when(F.col("k") == 0, F.col("id")).otherwise(F.concat("id", F.lit("-r"), F.col("k").cast("string")))).drop("base", "ks", "k")


def content_checksum(questions: DataFrame) -> DataFrame:
    """A checksum of each paper's whole content, whatever the order of its rows: a hash of the sorted hashes of its questions."""
    row = F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(questions.columns)])), 256)
    return questions.groupBy("exam", "year", "shift").agg(F.count("*").alias("total"), F.sha2(F.array_join(F.array_sort(F.collect_list(row)), ""), 256).alias("content_checksum"))


def legacy_checksum(papers: DataFrame) -> DataFrame:
    """The checksum that covers headers only: nested objects keep no keys, so questions count, but their content doesn't."""
    body = F.to_json(F.struct(*[F.col(c) for c in sorted(c for c in papers.columns if c != "checksum")]))
    return papers.withColumn("legacy_checksum", F.sha2(body, 256))


def export_shape(questions: DataFrame) -> DataFrame:
    """Defaults of exported questions, and the number within the subject's file."""
    w = Window.partitionBy("exam", "year", "shift", "subject").orderBy("pos")
    return questions.withColumns({"topic": F.coalesce("topic", F.lit("unknown")), "answer": F.coalesce("answer", F.lit("")), "subject_number": F.row_number().over(w)})
