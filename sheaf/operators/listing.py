"""Orders in which things are listed. Each adds a `place` from 1, so that the order is part of the result.

A listing of all rows is numbered range by range (`places`), so it can be as long as the table. The first or last few rows of each group are
cut by a window, which Spark limits in each task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaf.operators.places import numbered, numbered_values

#: Subjects that go first, in this order; the others follow by name.
SUBJECTS_FIRST = ("physics", "chemistry", "biology")
#: The states of a file listing's order, in the order in which they follow each other.
FILE_ORDERS = (("name", "asc"), ("name", "desc"), ("size", "desc"), ("size", "asc"))


def first_of(rows: DataFrame, n: int, *order: Column, within: tuple[str, ...]) -> DataFrame:
    """The first n rows of each group; no task gets more than n of a group from each other task."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*within).orderBy(*order))).where(F.col("place") <= n)


def checkpoints(rows: DataFrame) -> DataFrame:
    """(exam, year, shift, ...): by exam, the latest year first, then by shift."""
    return numbered(rows, F.asc("exam"), F.desc("year"), F.asc("shift"))


def counts(rows: DataFrame, column: str, order: str) -> DataFrame:
    """(value, n): how often each value occurs, the most frequent first, and of equal ones that which came first by `order`."""
    n = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return numbered(n, F.desc("n"), F.asc("first")).select("value", "n", "place")


def next_order(field: str, direction: str) -> tuple[str, str]:
    """The order that follows this one in the cycle; the first one after an unknown one."""
    k = FILE_ORDERS.index((field, direction)) if (field, direction) in FILE_ORDERS else -1
    return FILE_ORDERS[(k + 1) % len(FILE_ORDERS)]


def files(rows: DataFrame, field: str = "size", direction: str = "desc", *then: Column) -> DataFrame:
    """(name, size, ...): by one of FILE_ORDERS; of equal sizes by name, of equal names by `then`. Rows without a size or a name come last."""
    if (field, direction) not in FILE_ORDERS:
        raise ValueError(f"no such order: {field} {direction}")
    by = F.desc_nulls_last(field) if direction == "desc" else F.asc_nulls_last(field)
    return numbered(rows, by, F.asc_nulls_last("name"), *then)


def subjects(rows: DataFrame) -> DataFrame:
    """(subject, ...): SUBJECTS_FIRST in their order, then the others by name."""
    known = F.array_position(F.array(*[F.lit(s) for s in SUBJECTS_FIRST]), F.coalesce("subject", F.lit("")))
    return numbered(rows, F.when(known > 0, known).otherwise(len(SUBJECTS_FIRST) + 1), F.asc_nulls_last("subject"))


def cascade(papers: DataFrame) -> DataFrame:
    """(exam, year, shift): the places in three menus, exams by name, an exam's years from the latest, a year's shifts by name."""
    out = numbered_values(papers.select("exam", "year", "shift").distinct(), "exam", F.asc("exam"), "exam_place")
    menu = lambda within, order: F.dense_rank().over(Window.partitionBy(*within).orderBy(order)).cast("long")  # noqa: E731  an exam's years and a year's shifts are few
    return out.withColumn("year_place", menu(("exam",), F.desc("year"))).withColumn("shift_place", menu(("exam", "year"), F.asc("shift")))


def first_errors(errors: DataFrame, n: int = 5) -> DataFrame:
    """The first n errors of each paper, by number and kind; those of the whole paper first. The limit is the feature."""
    return first_of(errors, n, F.asc_nulls_first("number"), F.asc("error"), within=("paper",))


def last_pages(pages: DataFrame, n: int = 3) -> DataFrame:
    """The last n pages of each paper, where answer keys are looked for. The limit is the feature."""
    return first_of(pages, n, F.desc("page"), within=("paper",)).drop("place")
