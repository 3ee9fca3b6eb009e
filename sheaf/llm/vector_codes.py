"""Vector code compression by heap Lloyd (operator 13).

Vectors are cut into equal consecutive parts, and each part is replaced by the number of its nearest entry in the codebook of its
place, in integers throughout. Lloyd's rounds move each entry to the floor of its parts' mean. Not every part is compared again:

- The kept vectors lie in blocks, a row of a written table each. A block holds, for each place and entry, a heap of the parts assigned to the
  entry, keyed by slack: how much farther the second nearest entry was than the own one, plus the drift that the entry had
  seen by then. A heap is a run of keys in ascending order, which is a binary heap.
- After a round an entry's cumulative drift grows by its own movement and the greatest movement of any other entry of its place. A heap
  is popped as long as its least key is not above that drift: only these parts' bounds are violated, and they
  are compared exactly with all entries and pushed onto the heap of their nearest one. All other parts keep their entry for sure.
- A block carries the sums and counts of its parts by entry, mended by the parts that moved. The driver gets sums by place and entry only.

Slacks are floats, so each is lowered and each drift raised by more than rounding can take; ties have no slack and are popped each round.

Defined results: rows whose vector is null, or holds null or non-finite components, are dropped; so are vectors whose length isn't a positive
multiple of `parts`, or isn't that of the kept vector with the smallest id (null ids come last; of equal ids the smaller vector). With fewer kept rows than
entries the codebook has as many entries as rows. Rows with equal ids and rows without an id are each coded for themselves; equal vectors
get equal codes. Components of any finite size are exact: where squares would leave 53 bits, a block is computed in Python's integers and
without bounds; errors beyond 64 bits are given as the largest long. An empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm.common import prepare, table, to_batch, written

BLOCK = 1024  # vectors of a block, about 250 bytes each; members of its heaps are numbered in 16 bits
MOST_LONG = (1 << 63) - 1
NEVER = -np.inf  # the key of a part that is compared in each round


@dataclass
class Heaps:
    """The heaps of one place: members and keys of all of them one after another, and where each begins."""

    member: np.ndarray
    key: np.ndarray
    start: np.ndarray

    @staticmethod
    def of(codes: np.ndarray, key: np.ndarray, entries: int) -> Heaps:
        short = key.astype(np.float32)
        short = np.where(short > key, np.nextafter(short, np.float32(-np.inf)), short)  # four bytes, never above the exact key
        order = np.lexsort((short, codes))
        return Heaps(order.astype(np.uint16), short[order], np.searchsorted(codes[order], np.arange(entries + 1)).astype(np.int32))

    def pop(self, drift: np.ndarray) -> np.ndarray:
        """The members whose keys are not above their heap's drift: from each heap's root as far as they go."""
        popped = []
        for e in np.flatnonzero(np.diff(self.start)).tolist():
            a, b = self.start[e], self.start[e + 1]
            if self.key[a] <= drift[e]:
                popped.append(self.member[a : a + np.searchsorted(self.key[a:b], drift[e], "right")])
        return np.concatenate(popped).astype(np.int64) if popped else np.zeros(0, np.int64)


def is_small(parts: np.ndarray, book: np.ndarray) -> bool:
    """Whether squared distances stay exact in 53 bits."""
    most = max(int(np.abs(parts).max(initial=0)), int(np.abs(book).max(initial=0)))
    return 4 * most * most * max(1, parts.shape[-1]) < 1 << 53


def squares(parts: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of parts to entries."""
    if is_small(parts, book):
        x, c = parts.astype(np.float64), book.astype(np.float64)
        return (x * x).sum(1)[:, None] - 2 * np.einsum("ij,kj->ik", x, c) + (c * c).sum(1)
    return ((parts.astype(object)[:, None, :] - book.astype(object)[None]) ** 2).sum(2)


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part, the lowest at a tie, and the slack to the second nearest."""
    d = squares(parts, book)
    best = d.argmin(axis=1)
    if d.dtype == object:
        return best, np.full(len(d), NEVER)
    rows = np.arange(len(d))
    own = np.sqrt(d[rows, best])
    d[rows, best] = np.inf
    other = np.sqrt(d.min(axis=1)) if d.shape[1] > 1 else np.full(len(d), np.inf)
    return best, other - own - (own + np.where(np.isinf(other), 0, other)) * 1e-12 - 1e-9


def drifts(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """For each place and entry, how much less slack its parts may have: its own movement and the greatest one of the others."""
    if old.dtype == object or new.dtype == object:
        return np.full(old.shape[:2], np.inf)
    moved = np.sqrt(((old.astype(np.float64) - new.astype(np.float64)) ** 2).sum(axis=2)) * (1 + 1e-12)
    top = np.sort(moved, axis=1)
    others = np.where((moved == top[:, -1:]) & (np.arange(moved.shape[1]) == moved.argmax(axis=1)[:, None]), top[:, -2:-1] if moved.shape[1] > 1 else 0.0, top[:, -1:])
    return moved + others + 1e-9


@dataclass
class Block:
    """Some vectors' parts, their codes, heaps by place, and sums by place and entry."""

    ids: list
    labels: list
    parts: np.ndarray  # places x vectors x width, integers
    codes: np.ndarray  # places x vectors
    heaps: list[Heaps]
    counts: np.ndarray  # places x entries
    sums: np.ndarray  # places x entries x width
    looked: int = 0  # parts that were compared

    @staticmethod
    def fresh(ids: list, labels: list, parts: np.ndarray, books: np.ndarray) -> Block:
        places, n, width = parts.shape
        entries = books.shape[1]
        self = Block(ids, labels, parts, np.zeros((places, n), np.uint8), [], np.zeros((places, entries), np.int64), np.zeros((places, entries, width), parts.dtype))
        for k in range(places):
            best, slack = nearest(parts[k], books[k])
            self.codes[k] = best
            self.heaps.append(Heaps.of(best, slack, entries))
            self._add(k, best, parts[k], 1)
        self.looked = places * n
        return self

    def _add(self, k: int, codes: np.ndarray, parts: np.ndarray, sign: int) -> None:
        np.add.at(self.counts[k], codes, sign)
        np.add.at(self.sums[k], codes, sign * parts)

    def again(self, books: np.ndarray, drift: np.ndarray) -> None:
        """Assigns the parts whose bounds the cumulative drift has violated."""
        self.looked = 0
        for k, heaps in enumerate(self.heaps):
            who = heaps.pop(drift[k])
            if not len(who):
                continue
            self.looked += len(who)
            best, slack = nearest(self.parts[k][who], books[k])
            was = self.codes[k][who]
            moved = best != was
            self._add(k, was[moved], self.parts[k][who[moved]], -1)
            self._add(k, best[moved], self.parts[k][who[moved]], 1)
            key = np.empty(self.codes.shape[1])
            key[heaps.member] = heaps.key
            self.codes[k][who] = best
            key[who] = np.where(slack == NEVER, NEVER, slack + drift[k][best])
            self.heaps[k] = Heaps.of(self.codes[k], key, books.shape[1])

    def errors(self, books: np.ndarray) -> list[int]:
        """Squared distances to the own entries, summed over the places."""
        total = 0
        for k in range(len(self.parts)):
            own = books[k][self.codes[k]]
            wide = np.int64 if is_small(self.parts[k], books[k]) else object
            total = total + ((self.parts[k].astype(wide) - own.astype(wide)) ** 2).sum(axis=1)
        return [min(int(x), MOST_LONG) for x in total]

    def packed(self) -> bytes:
        for dtype in (np.int16, np.int32, np.int64):
            if self.parts.dtype != object and np.abs(self.parts).max(initial=0) <= np.iinfo(dtype).max:
                self.parts = self.parts.astype(dtype)
                break
        return zlib.compress(pickle.dumps(self, protocol=5), 1)

    @staticmethod
    def unpacked(raw: bytes) -> Block:
        """What this operator's own tasks have written to its own table."""
        self = pickle.loads(zlib.decompress(raw))
        if self.parts.dtype != object:
            self.parts = self.parts.astype(np.int64)
        return self


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(256 * x); Python's integers where 64 bits are too few."""
    x = np.floor(vectors.astype(np.float64) * 256)
    if np.abs(x).max(initial=0) < 1 << 40:
        return x.astype(np.int64)
    whole = [int(a) * 256 if abs(a) > 1 << 60 else int(f) for a, f in zip(vectors.astype(np.float64).ravel().tolist(), x.ravel().tolist(), strict=True)]
    return np.array(whole, object).reshape(vectors.shape)


def cut(vectors: np.ndarray, parts: int) -> np.ndarray:
    """Places x vectors x width."""
    x = integers(vectors)
    return x.reshape(len(x), parts, -1).transpose(1, 0, 2).copy()


def kept(rows: DataFrame, vector: str, parts: int) -> DataFrame:
    """(vec_id, label, vector) of the rows with a vector of finite components; a projection."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    n = F.size("vector")
    whole = rows.select("vec_id", "label", F.col(vector).alias("vector")).where(F.col("vector").isNotNull())
    return whole.where((n > 0) & (n % parts == 0)).where(F.coalesce(finite, F.lit(False)))


STATE_DDL = "block binary, sums binary, looked long"
STATE = pa.schema([("block", pa.binary()), ("sums", pa.binary()), ("looked", pa.int64())])


def _state(block: Block) -> pa.RecordBatch:
    return to_batch({"block": [block.packed()], "sums": [zlib.compress(pickle.dumps((block.counts, block.sums), protocol=5), 1)], "looked": [block.looked]}, STATE)


def _first(books: np.ndarray):
    """Blocks of neighbouring rows, assigned by comparing every part."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = [], [], []

        def made() -> pa.RecordBatch:
            out = _state(Block.fresh(list(ids), list(labels), cut(np.concatenate(vectors), parts), books))
            ids.clear(), labels.clear(), vectors.clear()
            return out

        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                if len(ids) + part.num_rows > BLOCK:
                    yield made()
                ids += part.column(0).to_pylist()
                labels += part.column(1).to_pylist()
                vectors.append(part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1))
        if ids:
            yield made()

    return run


def _next(books: np.ndarray, drift: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column(0):
                block = Block.unpacked(raw.as_py())
                block.again(books, drift)
                yield _state(block)

    return run


CODED = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("code", pa.string()), ("error", pa.int64())])
CODED_DDL = "vec_id long, label string, code string, error long"


def _coded(books: np.ndarray, drift: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column(0):
                block = Block.unpacked(raw.as_py())
                block.again(books, drift)
                hexes = ["".join(f"{c:02x}" for c in row) for row in block.codes.T.tolist()]
                yield to_batch({"vec_id": block.ids, "label": block.labels, "code": hexes, "error": block.errors(books)}, CODED)

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts and sums of a task's blocks, as one row."""
    total = None
    for b in batches:
        for raw in b.column(0):
            counts, sums = pickle.loads(zlib.decompress(raw.as_py()))
            total = [counts, sums.astype(object)] if total is None else [total[0] + counts, total[1] + sums]
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(pickle.dumps(tuple(total), protocol=5), 1)], pa.binary())], names=["sums"])


def added(state: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts and sums over all blocks: added up in fewer and fewer tasks, some kilobytes from each, until a few rows reach the driver."""
    rows = state.select("sums")
    n = rows.rdd.getNumPartitions()
    while n > 64:
        n = -(-n // 32)
        rows = rows.mapInArrow(_summed, "sums binary").repartition(n)
    got = [pickle.loads(zlib.decompress(r["sums"])) for r in rows.mapInArrow(_summed, "sums binary").collect()]
    return sum(c for c, _ in got), sum(s for _, s in got)


def moved(books: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Each entry at the floor of its parts' mean; unused entries stay."""
    out = books.astype(object)
    for k, e in np.argwhere(counts > 0):
        out[k, e] = [int(x) // int(counts[k, e]) for x in sums[k, e]]
    return small(out)


def small(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int64) if all(abs(v) < 1 << 40 for v in x.ravel().tolist()) else x


@dataclass
class Codes:
    rows: DataFrame  # (vec_id, label, code, error)
    books: np.ndarray  # places x entries x width
    compared: list[int]  # parts that each assignment compared, the last one not counted


def compress(vectors: DataFrame, vector: str = "embedding", parts: int = 16, entries: int = 64, rounds: int = 2) -> Codes | None:
    """Codes of all kept rows of (vec_id, label, vector) after so many rounds; None if no row is kept."""
    spark = prepare(vectors.sparkSession)
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part: 256 entries at most")
    rows = kept(vectors, vector, parts)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), F.col("vector")).limit(1).collect()
    if not first:
        return None
    rows = rows.where(F.size("vector") == len(first[0]["vector"]))
    begin = rows.orderBy(F.col("vec_id").asc_nulls_last(), F.col("vector")).limit(entries).collect()  # `entries` rows
    books = small(cut(np.array([r["vector"] for r in begin], np.float64), parts).astype(object))
    width = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), "vector")
    drift = np.zeros(books.shape[:2])
    state = written(width.mapInArrow(_first(books), STATE_DDL), "codes")
    compared = [state.agg(F.sum("looked")).first()[0]]
    for k in range(rounds):
        new = moved(books, *added(state))
        drift, books = drift + drifts(books, new), new
        if k + 1 < rounds:
            state = written(state.mapInArrow(_next(books, drift), STATE_DDL), "codes")
            compared.append(state.agg(F.sum("looked")).first()[0])
    return Codes(written(state.mapInArrow(_coded(books, drift), CODED_DDL), "coded"), books, compared)


def books_text(books: np.ndarray) -> str:
    return ",".join(str(int(x)) for x in books.ravel().tolist())


FEW_LABELS = 100_000  # labels whose sums are broadcast; more are joined by a shuffle


def with_label_errors(rows: DataFrame) -> DataFrame:
    """Each row with the error of all rows of its label, rows without a label together."""
    total: Column = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST_LONG).cast("decimal(38,0)")).cast("long")
    sums = rows.groupBy("label").agg(total.alias("label_error")).withColumnRenamed("label", "_label")
    sums = written(sums, "label-errors")
    if sums.limit(FEW_LABELS + 1).count() <= FEW_LABELS:
        sums = F.broadcast(sums)
    return rows.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = compress(table(spark, sf_dir, "embeddings"))
    if got is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    digest = hashlib.sha256(books_text(got.books).encode()).hexdigest()
    return with_label_errors(got.rows).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _oracle(entries: int = 64, rounds: int = 2) -> str:
    dims = range(4)
    each = lambda f, sep=", ": sep.join(f(j) for j in dims)
    out = f"""
with v as materialized (select row_number() over (order by vec_id nulls last, embedding) as r, vec_id, label, embedding::double[] as e from embeddings
  where embedding is not null and len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as materialized (select r, vec_id, label, k, {each(lambda j: f"floor(256 * e[4 * k + {j + 1}])::bigint as x{j}")} from v, range(16) t(k)),
b0 as materialized (select k, r - 1 as c, {each(lambda j: f"x{j}")} from p where r <= {entries})"""
    for n in range(rounds + 1):
        distance = each(lambda j: f"(p.x{j} - b.x{j}) * (p.x{j} - b.x{j})", " + ")
        out += f""",
a{n} as materialized (select r, p.k, min(({distance}, c)) as best, any_value(vec_id) as vec_id, any_value(label) as label, {each(lambda j: f"any_value(p.x{j}) as x{j}")} from p join b{n} b on p.k = b.k group by r, p.k)"""
        if n < rounds:
            mean = lambda j: f"((sum(x{j}) - ((sum(x{j}) % count(*)) + count(*)) % count(*)) // count(*))::bigint as x{j}"
            out += f""",
m{n} as (select k, best[2] as c, {each(mean)} from a{n} group by k, best[2]),
b{n + 1} as materialized (select b.k, b.c, {each(lambda j: f"coalesce(m.x{j}, b.x{j}) as x{j}")} from b{n} b left join m{n} m on b.k = m.k and b.c = m.c)"""
    return out + f""",
f as (select r, any_value(vec_id) as vec_id, any_value(label) as label, string_agg(printf('%02x', best[2]), '' order by k) as code, sum(best[1])::bigint as error from a{rounds} group by r),
h as (select sha256(string_agg({each(lambda j: f"x{j}", " || ',' || ")}, ',' order by k, c)) as digest from b{rounds})
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, digest as codebooks_sha256 from f, h"""


ORACLES = {"op13_vector_codes": _oracle()}
