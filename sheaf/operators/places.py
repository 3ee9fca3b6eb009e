"""Places in one order over all rows, without one task that sees them all.

Rows are dealt into ranges of the order, sorted in their range and numbered there; the ranges' sizes, a number for each partition,
are summed up into where each range begins. A tie-break by a hash of the row lies behind the order, so rows that are equal by the order have one result and
are spread over ranges as well. Places within groups are the places overall less that of the group's first row, so a group that holds most
rows is spread like all others.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from sheaf.operators.stages import saved

IN_RANGE = (1 << 33) - 1  # bits of Spark's increasing ids that number the rows of a partition


def ranged(rows: DataFrame, *order: Column) -> DataFrame:
    """The rows dealt into ranges of the order: `_range`, ascending with it, and `_nth`, from 0 in the range. Rows that are equal by the order follow by their hash.

    The ranges are written, so whoever counts or reads them sees the same ones, also after an executor is lost.
    """
    columns = [F.col(f"`{c}`") for c in rows.columns]
    hashed = [F.col(f"`{f.name}`") for f in rows.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    by = [*order, F.xxhash64(*hashed)]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *by).sortWithinPartitions(*by).select(*columns, F.monotonically_increasing_id().alias("_id"))
    return saved(dealt.select(*columns, F.shiftright("_id", 33).cast("int").alias("_range"), F.col("_id").bitwiseAND(IN_RANGE).alias("_nth")), "ranges")


def numbered(rows: DataFrame, *order: Column, within: tuple[str, ...] = (), name: str = "place") -> DataFrame:
    """Each row with its place from 1 by the order, or within its group; of rows that are equal by it, those with the smaller hash go first.

    Orders are columns or sort orders (F.asc, F.desc). The driver gets one number for each range. Nulls in a group's columns are a group. An empty table stays empty.
    """
    columns = [F.col(f"`{c}`") for c in rows.columns]
    dealt = ranged(rows, *[F.asc_nulls_first(f"`{c}`") for c in within], *order)
    sizes = sorted((r["_range"], r["n"]) for r in dealt.groupBy("_range").agg(F.count("*").alias("n")).collect())  # a row for each range
    begins = list(zip([r for r, _ in sizes], accumulate([0, *(c for _, c in sizes)]), strict=False))
    starts = rows.sparkSession.createDataFrame(begins, "_r int, _begin long")
    out = dealt.join(F.broadcast(starts), F.col("_range") == F.col("_r")).select(*columns, (F.col("_begin") + F.col("_nth") + 1).alias(name))
    if not within:
        return out
    firsts = out.groupBy(*[F.col(f"`{c}`").alias(f"_g{k}") for k, c in enumerate(within)]).agg(F.min(name).alias("_first"))
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"_g{k}")) for k, c in enumerate(within)]
    return out.join(firsts, reduce(lambda a, b: a & b, same)).select(*columns, (F.col(name) - F.col("_first") + 1).alias(name))


def numbered_values(rows: DataFrame, column: str, order: Column, name: str) -> DataFrame:
    """Each row with the place of its value among the distinct values of a column. Nulls are a value; they are placed as the order says."""
    values = numbered(rows.select(column).distinct(), order, name=name).withColumnRenamed(column, "_value")
    return rows.join(values, F.col(f"`{column}`").eqNullSafe(F.col("_value"))).select(*rows.columns, name)
