"""Best-fit decreasing packing (operator 2).

Token counts are whole numbers up to the sequence length, so best-fit decreasing needs only the number of pieces of each
length: equal pieces go one after another, and bins in equal states are kept as runs. A segment tree over the remaining
capacities finds the tightest open run in logarithmic time. The driver holds a histogram and the runs, both bounded by the
sequence length; which piece goes where follows from its rank among the pieces of its length.

Defined results: a null or empty text is one piece, the end id; repeated rows are packed each for itself; an empty table
gives no rows; further columns are not looked at. Only documents longer than a sequence are cut; their first piece is the
shorter one.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheaf.llm.common import prepare, table, to_batch, written
from sheaf.llm.tokens import encoder, tokenizer_path


class CapacityTree:
    """Which remaining capacities have an open bin: a segment tree of flags, asked for the least capacity of at least x."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.tree = bytearray(2 * self.leaves)

    def set(self, capacity: int, there: bool) -> None:
        k = self.leaves + capacity
        self.tree[k] = there
        while k > 1:
            k >>= 1
            self.tree[k] = self.tree[2 * k] | self.tree[2 * k + 1]

    def at_least(self, capacity: int) -> int | None:
        k = self.leaves + capacity
        if self.tree[k]:
            return capacity
        while k > 1:
            if not k & 1 and self.tree[k + 1]:
                k += 1
                while k < self.leaves:
                    k = 2 * k if self.tree[2 * k] else 2 * k + 1
                return k - self.leaves
            k >>= 1
        return None


def best_fit_plan(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, first bin, pieces a bin, offset): ranks from first rank on fill bins from first bin on.

    The same bins as best-fit decreasing piece by piece: within a length, a bin takes pieces as long as they fit, as it is
    the tightest until then. Each row leaves at most two runs of bins in new states.
    """
    tree, open_runs, plan, bins = CapacityTree(size), {}, [], 0
    for length in sorted((x for x in histogram if x > 0), reverse=True):
        left, rank = histogram[length], 0
        while left:
            capacity = tree.at_least(length)
            if capacity is None:
                each = size // length
                first, count, capacity = bins, -(-left // each), size
                bins += count
            else:
                first, count = open_runs[capacity].pop()
                if not open_runs[capacity]:
                    tree.set(capacity, False)
            each = capacity // length
            used = min(count, -(-left // each))
            placed = min(left, used * each)
            plan.append((length, rank, first, each, size - capacity))
            full, rest = divmod(placed, each)
            for at, n, remaining in ((first, full, capacity - each * length), (first + full, int(rest > 0), capacity - rest * length), (first + used, count - used, capacity)):
                if n > 0 and remaining > 0:
                    open_runs.setdefault(remaining, []).append((at, n))
                    tree.set(remaining, True)
            rank += placed
            left -= placed
    return plan


BROADCAST_ROWS = 200_000  # of four numbers each: some megabytes
PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("task", pa.int64()), ("rank", pa.int64())])
PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, rank long"


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of n ids: whole sequences but for the first."""
    first = n % size or min(n, size)
    starts = [0, *range(first, n, size)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n], strict=True)]


def _pieces(path: str, size: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, seen = encoder(path), TaskContext.get().partitionId(), Counter()
        for b in batches:
            rows: dict[str, list] = {c: [] for c in PIECES.names}
            for doc, ids in zip(b.column(0).to_pylist(), encode([t or "" for t in b.column(1).to_pylist()]), strict=True):
                raw = ids.tobytes() + end_id.to_bytes(4, "little")
                for k, (start, length) in enumerate(cut(len(raw) // 4, size)):
                    for c, v in zip(PIECES.names, (doc, k, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)]), task, seen[length]), strict=True):
                        rows[c].append(v)
                    seen[length] += 1
            yield to_batch(rows, PIECES)

    return run


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 2) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. size: under 2048."""
    spark = prepare(docs.sparkSession)
    # Ranks count within a task, so the rows are written before anything is derived from them.
    pieces = written(docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer, size, end_id), PIECES_DDL), "pieces")
    counts = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(counts.select(F.col("task").alias("_task"), F.col("length").alias("_length"), "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "piece-ranks")
    histogram = {r["_length"]: r["n"] for r in bases.groupBy("_length").agg(F.sum("n").alias("n")).collect()}  # at most `size` rows
    plan = np.array(best_fit_plan(histogram, size), np.int64).reshape(-1, 5)
    placed = PlacedBy(plan).columns
    # The bases grow with the tasks and compress well, so their file size says little: their rows decide about a broadcast.
    how = "broadcast" if bases.count() <= BROADCAST_ROWS else "merge"
    ranked = pieces.join(bases.hint(how), (F.col("task") == F.col("_task")) & (F.col("length") == F.col("_length"))).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("rank")).alias("rank"))
    schema = pa.schema([*[f for f in PIECES if f.name not in ("task", "rank")], ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = {n: b.column(k) for k, n in enumerate(b.schema.names)}
            rows["sequence_id"], rows["offset"] = placed(rows["length"].to_numpy(), rows["rank"].to_numpy())
            yield to_batch({f.name: rows[f.name] for f in schema}, schema)

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


class PlacedBy:
    """Looks up (length, rank) in a plan by binary search."""

    def __init__(self, plan: np.ndarray):
        self.plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
        self.key = (self.plan[:, 0] << 52) + self.plan[:, 1]  # lengths under 2048, ranks under 2**52

    def columns(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = self.plan
        at = np.searchsorted(self.key, (length << 52) + rank, side="right") - 1
        q = rank - p[at, 1]
        return p[at, 2] + q // p[at, 3], p[at, 4] + (q % p[at, 3]) * length


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())
