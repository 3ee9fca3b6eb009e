"""MinHash near duplicates with tensored banding (operator 9).

Two collections of `tables` small hashes are computed, each from `rows` minhashes; every pair of one of each keys a table, so
tables x tables tables need only 2 x tables hashes. Documents with equal shingle sets are one class from the start. The buckets
of all tables with the same smallest class are one group, so a class meets another once and not in each table. Groups are
compared on their full sets, by matrix products over blocks of members: no pair becomes a row. Members of a large group that
their block joins to its smallest are done after one look; only pairs with one of the others follow, by pairs of blocks.
Only links that join components are returned.

With 85 percent, 8 and 2: a linked pair shares no table with probability 2 * (1 - 0.85**2)**8 < 0.00008 at the limit, less above.

Classes have numbers of their own, so nothing is joined by document id: rows that share an id, or have none, are signed, linked and
judged each by its own text.

Defined results: a document without words has an empty set, is its own component, is linked with nothing and is kept; component_id is the
smallest id among the rows of a component, null if none has an id; kept are all rows that carry it, and of components without any
id the row that comes first in the written table of signatures; an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sheaf.llm.common import TEXTS, dealt_out, partitions, prepare, table, to_batch, written
from sheaf.llm.components import components
from sheaf.llm.rolling import mix, shingles

U = np.uint64
SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("left", pa.list_(pa.int64())), ("right", pa.list_(pa.int64())), ("fetch", pa.int64()), ("row", pa.int64())])
SIGNED_DDL = "doc_id long, n_shingles long, digest binary, left array<long>, right array<long>, fetch long, row long"


def small_hashes(s: np.ndarray, tables: int, rows: int) -> np.ndarray:
    """2 x tables hashes, each of `rows` minhashes of the set."""
    rng = np.random.default_rng(974711)
    a = rng.integers(0, 1 << 63, 2 * tables * rows, dtype=np.uint64) * U(2) + U(1)
    b = rng.integers(0, 1 << 64, 2 * tables * rows, dtype=np.uint64)
    low = np.array([(s * x + y).min() for x, y in zip(a, b, strict=True)], np.uint64).reshape(2 * tables, rows)
    h = np.arange(2 * tables, dtype=np.uint64)
    for k in range(rows):
        h = mix(h * U(0x9E3779B97F4A7C15) + low[:, k])
    return h.view(np.int64)


def digest_of(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _sign(width: int, tables: int, rows: int, carried: bool):
    """Rows (doc_id, fetch, more) signed by the text in `more`, which goes on if it is carried; the row's number is unique, and fixed once the result is written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            out: dict[str, list] = {c: [] for c in SIGNED.names[:5]}
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(2).field("text").to_pylist(), strict=True):
                s = shingles(text, width)
                h = small_hashes(s, tables, rows) if len(s) else np.zeros(0, np.int64)
                for c, v in zip(SIGNED.names, (doc_id, len(s), digest_of(s), h[:tables].tolist(), h[tables:].tolist())):
                    out[c].append(v)
            signed = to_batch(out | {"fetch": b.column(1), "row": np.arange(row, row + b.num_rows)}, SIGNED)
            row += b.num_rows
            yield pa.RecordBatch.from_arrays([*signed.columns, b.column(2)], names=[*SIGNED.names, "more"]) if carried else signed

    return run


FILTER_BITS = 1 << 16, 1 << 26  # least and most bits of a filter, which is at most 8 MB
STRETCH = 1 << 20  # bits of a filter that come to the driver as one row


class IdFilter:
    """Which ids may be wanted: a bitmap of eight bits an id. It only spares the shuffle texts that surely aren't; a join decides.

    Where so many ids are wanted that the largest bitmap would be half full, nothing is filtered: the rows that a filter could
    spare are then few beside the wanted ones.
    """

    def __init__(self, ids: DataFrame, column: str):
        least, most = FILTER_BITS
        n = ids.count()
        self.size = min(max(least, 1 << (8 * n).bit_length()), most)
        self.bits = None
        if n <= self.size // 2:
            self.bits = np.zeros(self.size // 32, np.uint32)
            for r in self.stretches(ids, column).collect():  # at most size / STRETCH rows
                part = np.frombuffer(r["bits"], "<u4")
                first = r["stretch"] * (STRETCH // 32)
                self.bits[first : first + len(part)] = part

    def stretches(self, ids: DataFrame, column: str) -> DataFrame:
        """(stretch, bits): the bitmap in rows of STRETCH bits, put together by tasks."""
        length = min(STRETCH, self.size)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            maps: dict[int, np.ndarray] = {}
            for b in batches:
                bit = b.column(0).to_numpy()
                for s in np.unique(bit // length).tolist():
                    maps.setdefault(s, np.zeros(length, bool))[bit[bit // length == s] % length] = True
            for s, m in maps.items():
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([np.packbits(m, bitorder="little").tobytes()], pa.binary())], names=["stretch", "bits"])

        bits = ids.select(F.pmod(F.xxhash64(column), F.lit(self.size)).cast("int").alias("bit")).distinct()
        return bits.repartition(-(-self.size // STRETCH), F.floor(F.col("bit") / length)).mapInArrow(run, "stretch int, bits binary")

    def keep(self, rows: DataFrame, column: str) -> DataFrame:
        if self.bits is None:
            return rows
        shared = rows.sparkSession.sparkContext.broadcast(self.bits)
        names = rows.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                bit = b.column(len(names)).to_numpy()
                yield pa.RecordBatch.from_arrays(b.columns[: len(names)], names).filter(pa.array((shared.value[bit >> 5] >> (bit & 31).astype(np.uint32) & 1).astype(bool)))

        return rows.withColumn("_bit", F.pmod(F.xxhash64(F.col(column)), F.lit(self.size))).mapInArrow(run, rows.schema)


SETS = pa.schema([("id", pa.int64()), ("shingles", pa.binary())])


def _sets(width: int):
    """Sets of the classes' texts. A text of another class that has the same fetch number is told by its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(i, s) for i, t, d in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True) if digest_of(s := shingles(t, width)) == d]
            yield to_batch({"id": [i for i, _ in found], "shingles": [s.tobytes() for _, s in found]}, SETS)

    return run


LINKS = pa.schema([("low", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    at = np.searchsorted(y, x)
    return int((y[np.minimum(at, len(y) - 1)] == x).sum())


BLOCK = 512  # members of a group that are compared at once
COLUMNS = 4096  # shingles of a block that are counted at once
ELEMENTS = 1_000_000  # of its sets that are sorted at once


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairs' intersections: products of the 0/1 matrix of members and shared shingles, some columns at a time.

    Sets are sorted, so they are cut into ranges of hashes of about ELEMENTS elements, which bounds memory for long texts.
    """
    out = np.zeros((len(sets), len(sets)), np.float64)
    ranges = max(1, -(-sum(map(len, sets)) // ELEMENTS))
    for r in range(ranges):
        low, high = ((1 << 64) * k // ranges for k in (r, r + 1))
        part = [x[np.searchsorted(x, U(low)) : (np.searchsorted(x, U(high)) if high < 1 << 64 else len(x))] for x in sets]
        member = np.repeat(np.arange(len(sets)), [len(x) for x in part])
        _, column, counts = np.unique(np.concatenate(part), return_inverse=True, return_counts=True)
        shared = counts > 1
        number = np.cumsum(shared) - 1
        use = shared[column]
        member, column = member[use], number[column[use]]
        order = np.argsort(column, kind="stable")
        member, column = member[order], column[order]
        for first in range(0, int(shared.sum()), COLUMNS):
            lo, hi = np.searchsorted(column, [first, first + COLUMNS])
            m = np.zeros((len(sets), COLUMNS), np.float32)
            m[member[lo:hi], column[lo:hi] - first] = 1
            out += m @ m.T
    return out.astype(np.int64)


def links_of(ids: list[int], blocks: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between members that the exact sets confirm; of those that say nothing new about components, none. With two blocks only pairs across them."""
    n = np.array([len(x) for x in sets], np.int64)
    block = np.array(blocks)
    if len(sets) <= 6:
        both = np.zeros((len(sets), len(sets)), np.int64)
        for i in range(len(sets)):
            for j in range(i):
                if 100 * min(n[i], n[j]) >= percent * max(n[i], n[j]):
                    both[i, j] = common(sets[i], sets[j])
    else:
        both = intersections(sets)
    linked = (100 * both >= percent * (n[:, None] + n[None, :] - both)) & (both > 0)
    if len(set(blocks)) > 1:
        linked &= block[:, None] != block[None, :]
    root = list(range(len(ids)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in np.argwhere(np.tril(linked, -1)).tolist():
        x, y = find(i), find(j)
        if x != y:
            root[x] = y
            out.append((ids[i], ids[j]))
    return out


def apart(ids: list[int], links: list[tuple[int, int]], low: int) -> list[int]:
    """The ids that no path of links leads to from low."""
    near: dict[int, list[int]] = {}
    for a, b in links:
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)
    todo = [low]
    reached = {low}
    while todo:
        for y in near.get(todo.pop(), ()):
            if y not in reached:
                reached.add(y)
                todo.append(y)
    return [i for i in ids if i not in reached]


def _links(percent: int):
    """Links (a, b) of each (low, one, two); of groups that are not whole there also rows (low, a, null): members that low doesn't reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, blocks, sets = None, [], [], []
        found: list[tuple[int | None, int, int | None]] = []

        def compare() -> None:
            if len(ids) > 1:
                links = links_of(ids, blocks, sets, percent)
                found.extend((None, a, b) for a, b in links)
                if not key[3]:
                    found.extend((key[0], i, None) for i in apart(ids, links, key[0]))

        def out() -> pa.RecordBatch:
            return to_batch(dict(zip(LINKS.names, zip(*found, strict=True), strict=True)), LINKS)

        for b in batches:
            mine, member = b.column(4), b.column(5)
            raw = [np.frombuffer(x.as_buffer(), np.uint64) for x in b.column(6)]
            for k, m, i, s in zip(zip(*(b.column(c).to_pylist() for c in range(4)), strict=True), mine.to_pylist(), member.to_pylist(), raw, strict=True):
                if k != key:
                    compare()
                    key, ids, blocks, sets = k, [], [], []
                ids.append(i)
                blocks.append(m)
                sets.append(s.copy())
            if found:
                yield out()
                found.clear()
        compare()
        if found:
            yield out()

    return run


def compared(dealt: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """What _links finds in members dealt out as (low, one, two, whole, mine, id)."""
    rows = dealt.join(dealt_out(sets), "id").select("low", "one", "two", "whole", "mine", "id", "shingles")
    rows = rows.repartition(partitions(dealt.sparkSession), "low", "one", "two").sortWithinPartitions("low", "one", "two")
    return written(rows.mapInArrow(_links(percent), "low long, a long, b long"), "links")


def blocks_of(n: Column) -> Column:
    return F.ceil(n / BLOCK).cast("int")


def confirmed(groups: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Links (a, b) that join the components of groups (low, id, tables).

    A group of at most BLOCK members is compared whole. A larger one is dealt out in blocks, each with two leaders: the smallest
    member and the one that shares the most tables with it. Members that their block's links join to the smallest are in one
    component, so no pair of them is looked at again: its rows grow with the group. Only pairs with a member that was
    not reached follow, by pairs of blocks.
    """
    sizes = groups.groupBy("low").agg(blocks_of(F.count("*")).alias("n_blocks"), F.max_by("id", F.when(F.col("id") != F.col("low"), F.col("tables"))).alias("hub"))
    leads = (F.col("id") == F.col("low")) | (F.col("id") == F.col("hub"))
    block = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    everywhere = F.sequence(F.lit(0), F.col("n_blocks") - 1)
    dealt = groups.join(dealt_out(sizes), "low").withColumn("mine", F.explode(F.when(leads, everywhere).otherwise(F.array(block(F.col("n_blocks"))))))
    first = compared(dealt.select("low", F.col("mine").alias("one"), F.col("mine").alias("two"), (F.col("n_blocks") == 1).alias("whole"), "mine", "id"), sets(groups), percent)

    rest = first.where("b is null").select("low", F.col("a").alias("id"), F.lit(True).alias("apart")).distinct()
    links = first.where("b is not null").select("a", "b")
    if rest.isEmpty():
        return links
    rest = written(rest, "apart")
    counts = groups.groupBy("low").agg(F.count("*").alias("n")).join(dealt_out(rest.groupBy("low").agg(F.count("*").alias("n_apart"))), "low")
    counts = counts.select("low", blocks_of(F.col("n_apart")).alias("n_one"), blocks_of(F.col("n") - F.col("n_apart")).alias("n_two"))
    # Blocks of members apart come first; each meets all blocks. Blocks of the others meet only those.
    members = written(groups.select("low", "id").join(dealt_out(counts), "low").join(dealt_out(rest), ["low", "id"], "left"), "open-groups")
    mine = F.when(F.col("apart"), block(F.col("n_one"))).otherwise(F.col("n_one") + block(F.col("n_two")))
    last = F.col("n_one") - 1 + F.when(F.col("apart"), F.col("n_two")).otherwise(0)
    dealt = members.select("low", "id", mine.alias("mine"), F.explode(F.sequence(F.lit(0), last)).alias("other"))
    dealt = dealt.select("low", F.least("mine", "other").alias("one"), F.greatest("mine", "other").alias("two"), F.lit(True).alias("whole"), "mine", "id")
    return links.union(compared(dealt, sets(members), percent).select("a", "b"))


MOST_BROADCAST = 500_000  # rows that go, a number each: some tens of megabytes


def judged(docs: DataFrame, percent: int, width: int, tables: int, rows: int, carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """The written signatures, with a struct `more` of the carried columns (text among them), and (row, doc_id, n_shingles, component_id, kept) of each row."""
    prepare(docs.sparkSession)
    fetch = F.xxhash64("text").alias("fetch")
    schema, more = StructType.fromDDL(SIGNED_DDL), F.struct(*(carry or ("text",))).alias("more")
    if carry:
        schema = schema.add(docs.select(more).schema[0])
    signed = docs.select("doc_id", fetch, more).mapInArrow(_sign(width, tables, rows, bool(carry)), schema)
    signed = written(signed, "signed", compression=TEXTS if carry else None)
    classes = signed.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.min("row").alias("row"), F.min("fetch").alias("fetch"), F.first("left").alias("left"), F.first("right").alias("right"))
    classes = written(classes.withColumn("id", F.monotonically_increasing_id()), "classes")  # the numbers are fixed as they are written

    left = classes.select("id", "right", F.posexplode("left").alias("i", "x"))
    keys = left.select("id", "i", "x", F.posexplode("right").alias("j", "y")).select(F.xxhash64("i", "x", "j", "y").alias("key"), "id")
    buckets = keys.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("key", "low")
    members = keys.join(dealt_out(buckets), "key").groupBy("low", "id").agg(F.count("*").alias("tables"))
    groups = written(members, "groups")  # the bucket's smallest is among its members

    def sets(members: DataFrame) -> DataFrame:
        """Sets of the members' texts. Copies of a text are one before the shuffle."""
        wanted = written(classes.select("id", "fetch", "digest").join(dealt_out(members.select("id").distinct()), "id"), "wanted")
        texts = IdFilter(wanted, "fetch").keep(docs.select(fetch, "text"), "fetch")
        texts = texts.groupBy("fetch").agg(F.collect_set("text").alias("texts")).join(dealt_out(wanted), "fetch")
        return texts.select("id", F.explode("texts").alias("text"), "digest").mapInArrow(_sets(width), "id long, shingles binary")

    labels = components(confirmed(groups, sets, percent))
    linked = labels.join(dealt_out(classes.select("id", "doc_id", "row")), F.col("node") == F.col("id")).select("node", "label", "doc_id", "row")
    heads = linked.groupBy("label").agg(F.min("doc_id").alias("head"), F.min("row").alias("first"))
    linked = linked.join(dealt_out(heads), "label").select("node", "head", "first")
    by_class = classes.select("digest", "id", "doc_id", "row").join(dealt_out(linked), F.col("id") == F.col("node"), "left")
    alone = F.col("node").isNull()
    by_class = by_class.select(F.col("digest").alias("_digest"), F.when(alone, F.col("doc_id")).otherwise(F.col("head")).alias("head"), F.when(alone, F.col("row")).otherwise(F.col("first")).alias("first"))
    out = signed.select("doc_id", "row", "n_shingles", "digest").join(dealt_out(by_class), (F.col("digest") == F.col("_digest")) & (F.col("n_shingles") > 0), "left")
    empty = F.col("n_shingles") == 0
    kept = empty | F.when(F.col("head").isNull(), F.col("row") == F.col("first")).otherwise(F.col("doc_id").eqNullSafe(F.col("head")))
    component = F.when(empty, F.col("doc_id")).otherwise(F.col("head"))
    return signed, out.select("row", "doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = 5, tables: int = 10, rows: int = 2) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row."""
    return judged(docs, percent, width, tables, rows)[1].drop("row")


def without_near_duplicates(docs: DataFrame, percent: int = 80, width: int = 5, tables: int = 10, rows: int = 2) -> DataFrame:
    """The kept rows, with all their columns. Rows that go are taken out by their number: up to MOST_BROADCAST of them are broadcast, more are joined by a shuffle."""
    signed, verdicts = judged(docs, percent, width, tables, rows, tuple(docs.columns))
    gone = written(verdicts.where("not kept").select("row"), "gone")
    gone = F.broadcast(gone) if gone.count() <= MOST_BROADCAST else dealt_out(gone)
    return signed.select("row", "more").join(gone, "row", "left_anti").select("more.*")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85, tables=8)
