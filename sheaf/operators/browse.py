"""The query interface: filters, pages, catalogues, statistics."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class QuestionQuery:
    """limit: 100 if not given or 0, 500 at most."""

    exam: str | None = None
    year: int | None = None
    shift: str | None = None
    subject: str | None = None
    section: str | None = None
    type: str | None = None
    difficulty: str | None = None
    topics: tuple[str, ...] = ()
    tags: tuple[str, ...] = ()
    sort: str | None = None
    descending: bool = False
    random: int | None = None
    offset: int = 0
    limit: int = 100
    extra: dict = field(default_factory=dict)

    @classmethod
    def parse(cls, text: str) -> QuestionQuery:
        """From the query part of a URL."""
        from urllib.parse import parse_qs

        q = {k: v[-1] for k, v in parse_qs(text.lstrip("?")).items()}
        number = lambda k, d: int(q[k]) if q.get(k, "").lstrip("-").isdigit() else d
        csv = lambda k: tuple(x for x in q.get(k, "").split(",") if x)
        return cls(q.get("exam"), number("year", None), q.get("shift"), q.get("subject"), q.get("section"), q.get("type"), q.get("difficulty"), csv("topic"), csv("tags"), q.get("sort"), q.get("order") == "desc", number("random", None), max(0, number("offset", 0)), min(number("limit", 100) or 100, 500))


def filter_questions(questions: DataFrame, q: QuestionQuery, compat: bool = False) -> DataFrame:
    """Filters go to the scan. compat: only those that the published interface applies."""
    equal = ("subject", "type", "difficulty") if compat else ("exam", "year", "shift", "subject", "section", "type", "difficulty")
    for c in equal:
        if (v := getattr(q, c)) is not None:
            questions = questions.where(F.col(c) == v)
    if q.topics:
        questions = questions.where(F.col("topic").isin(*q.topics))
    if q.tags and not compat:
        questions = questions.where(F.arrays_overlap("tags", F.array(*[F.lit(t) for t in q.tags])))
    return questions


def page(questions: DataFrame, q: QuestionQuery, compat: bool = False) -> DataFrame:
    """One page in a total order: the feature's own limit of 500 rows at most."""
    rows = filter_questions(questions, q, compat)
    order = [F.xxhash64(F.lit(q.random), "pos")] if q.random is not None else [F.desc(q.sort) if q.descending else F.asc(q.sort)] if q.sort else []
    return rows.orderBy(*order, "pos").offset(q.offset).limit(q.limit)


def papers(headers: DataFrame) -> DataFrame:
    """Headers with missing fields taken from the path exam/year/shift; rows without any of the three go."""
    part = lambda k: F.nullif(F.get(F.split("path", "/"), F.lit(k)), F.lit(""))
    out = headers.withColumns({"exam": F.coalesce(F.nullif("exam", F.lit("")), part(0)), "year": F.coalesce(F.col("year"), part(1).try_cast("int")), "shift": F.coalesce(F.nullif("shift", F.lit("")), part(2))})
    return out.where("exam is not null and year is not null and year <> 0 and shift is not null")


def statistics(questions: DataFrame) -> DataFrame:
    """Counts by exam, exam and subject, exam and type, subject, type, and in all, in one pass."""
    sets = [["exam"], ["exam", "subject"], ["exam", "type"], ["subject"], ["type"], []]
    return questions.groupingSets([[F.col(c) for c in s] for s in sets], "exam", "subject", "type").agg(F.grouping_id("exam", "subject", "type").alias("level"), F.count("*").alias("n"))


def totals(questions: DataFrame) -> DataFrame:
    return questions.agg(F.count_distinct("paper").alias("datasets"), F.count("*").alias("questions"), F.count_distinct("subject").alias("subjects"))


def open_export(questions: DataFrame, verified: DataFrame, internal: tuple[str, ...]) -> DataFrame:
    """Questions of verified papers, each once, without internal columns."""
    return questions.join(verified.where("status = 'verified'").select("paper").distinct(), "paper", "left_semi").drop(*internal)


def file_tree(files: DataFrame) -> DataFrame:
    """(path, size): a row for each directory that holds a shown file, with counts; hidden ones and other kinds are left out."""
    parts = F.split("path", "/")
    shown = files.where(F.lower("path").rlike(r"\.(json|pdf|png)$") & ~F.exists(parts, lambda p: p.startswith(".")))
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    return shown.where(F.size(parts) > 1).select("size", F.explode(above).alias("dir")).groupBy("dir").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))
