"""Quality classifier with supervised subword embeddings (operator 11).

A document is the average of learned vectors: one for each of its words, for each pair of neighbouring words and for each 3- to 5-gram of
bytes within a word and its borders, all hashed into one table. A softmax over two outputs reads the average. Vectors and
outputs are learned together by numpy stochastic gradient descent. A pair of equal words is hashed as a ditto mark, whatever
the word, so that stuttering is one feature and not one for each word; each text has an end mark, whose share tells short texts.

Training takes a bounded sample of labelled rows: `Training.most_rows`, those with the smallest hashes of id and text. Their features are
sparse counts in a written table, dealt into `Training.shards` parts. In each round a task runs the descent over each part from the same
model, one document after another, and the parts' models are averaged, slice by slice (iterative parameter mixing). The result depends on the data
and the parameters only, not on the number of partitions; a lost executor costs one part of one round; the driver gets one model of
BUCKETS x DIM floats a round. Scoring needs only one number for each bucket (its vector through the output difference), which is broadcast.

Defined results: a null or empty text has only the end mark and is scored by it; without any labelled row, or with one class only, all
scores are 1, 0 or, without a row, one half (to within 1e-26); null labels and labels of null ids are left out; of several
labels of one id the more frequent counts, 1 at a tie; a label other than 0 counts as 1; a null id is hashed as an empty string; repeated rows are scored each
for itself and learned once; an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm.common import prepare, table, to_batch, written

BITS = 16
BUCKETS = 1 << BITS
DIM = 8
NGRAMS = (3, 4, 5)
PART = 1 << 20  # bytes of a text that are hashed at once
END, DITTO, PAIR, MIX, STEP = (np.uint32(k) for k in (0x9AE16A3B, 0xC3A5C85D, 0xB492B66F, 0x9E3779B1, 0x01000193))
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[9, 10, 11, 12, 13, 32]] = True


@dataclass(frozen=True)
class Training:
    most_rows: int = 8192  # labelled rows that are learned from
    shards: int = 8
    rounds: int = 5  # between which the shards' models are averaged
    steps: int = 40_960  # documents that all shards go over in all rounds; each shard is gone over once a round at least
    rate: float = 5.0  # falls linearly to a tenth, round by round
    seed: int = 11


def buckets(h: np.ndarray) -> np.ndarray:
    """The top bits of mixed hashes."""
    h = (h ^ (h >> np.uint32(15))) * MIX
    return h >> np.uint32(32 - BITS)


def pieces(texts: list[str | None]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """The texts in lists of about PART bytes, with each one's number; longer texts are cut at separators, or in a word of more than PART bytes."""
    held, owner, size = [], [], 0
    for k, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        at = 0
        while at == 0 or at < len(raw):
            end = len(raw)
            if end - at > PART:
                end = max(raw.rfind(c, at + 1, at + PART) for c in (b" ", b"\n", b"\t", b"\r"))
                end = at + PART if end < 0 else end
            if held and size + end - at > PART:
                yield held, np.array(owner)
                held, owner, size = [], [], 0
            held.append(raw[at:end])
            owner.append(k)
            size += end - at + 1
            at = max(end, 1)
    if held:
        yield held, np.array(owner)


def features(held: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray | None, np.ndarray]]:
    """Buckets, which of them count, and where each text's begin; of the words, each one's text instead."""
    b = np.frombuffer(b" " + b" ".join(held) + b" ", np.uint8)
    starts = np.cumsum([0, *(len(x) + 1 for x in held)])[:-1]
    blank = SEPARATORS[b]
    x = np.where(blank, np.uint8(32), b).astype(np.uint32) + np.uint32(1)
    h, good = x[:-1] * STEP + x[1:], None
    for n in NGRAMS:
        m = len(x) - n + 1
        if m <= starts[-1]:  # a last text too short for any
            x, blank = np.append(x, np.full(n, 33, np.uint32)), np.append(blank, np.ones(n, bool))
            h, good = np.append(h, np.zeros(n, np.uint32)), None if good is None else np.append(good, np.zeros(n, bool))
            m = len(x) - n + 1
        h = h[:m] * STEP + x[n - 1 : n - 1 + m]
        inner = ~blank[n - 2 : n - 2 + m]
        good = inner if good is None else good[:m] & inner
        yield buckets(h + np.uint32(n)), good, starts
    words, begin = word_hashes(x, blank)
    if len(words):
        text = np.searchsorted(starts, begin, "right") - 1
        yield buckets(words), None, text
        same = text[1:] == text[:-1]
        a, c = words[:-1][same], words[1:][same]
        yield buckets(np.where(a == c, DITTO, a * STEP ^ c * PAIR)), None, text[1:][same]


def word_hashes(x: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, the sum of its bytes mixed with their places in it, and where it begins."""
    begin = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
    if not len(begin):
        return np.zeros(0, np.uint32), begin
    ends = np.append(begin[1:], len(x))
    place = np.arange(len(x), dtype=np.uint32)
    place[begin[0] :] -= np.repeat(begin, ends - begin).astype(np.uint32)
    h = (x + place * STEP) * MIX
    h = (h ^ (h >> np.uint32(16))) * PAIR
    h[blank] = 0
    return np.add.reduceat(h, begin, dtype=np.uint32), begin


END_BUCKET = int(buckets(np.array([END]))[0])


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text, ascending, and their shares of all its features."""
    total = np.zeros(BUCKETS, np.int64)
    total[END_BUCKET] += 1
    for held, _ in pieces([text]):
        for h, good, _ in features(held):
            ids, n = np.unique(h if good is None else h[good], return_counts=True)
            total[ids] += n
    ids = np.flatnonzero(total)
    return ids.astype(np.int32), (total[ids] / total.sum()).astype(np.float32)


@dataclass
class Model:
    vectors: np.ndarray  # BUCKETS x DIM
    outputs: np.ndarray  # DIM x 2
    bias: np.ndarray  # 2

    @staticmethod
    def fresh(seed: int) -> Model:
        rng = np.random.default_rng(seed)
        return Model((rng.random((BUCKETS, DIM), np.float32) - 0.5) / DIM, (rng.random((DIM, 2), np.float32) - 0.5) / DIM, np.zeros(2, np.float32))

    def numbers(self) -> np.ndarray:
        return np.concatenate([self.vectors.ravel(), self.outputs.ravel(), self.bias])

    @staticmethod
    def of(numbers: np.ndarray) -> Model:
        vectors, outputs, bias = np.split(numbers.copy(), [BUCKETS * DIM, BUCKETS * DIM + 2 * DIM])
        return Model(vectors.reshape(BUCKETS, DIM), outputs.reshape(DIM, 2), bias)

    def learn(self, ids: np.ndarray, shares: np.ndarray, label: int, rate: float) -> None:
        """One step of the descent on the cross entropy of one document."""
        own = self.vectors[ids]
        mean = np.einsum("i,ij->j", shares, own)  # not BLAS, whose threads would be one pool for each task
        z = mean @ self.outputs + self.bias
        p = np.exp(z - z.max())
        p /= p.sum()
        p[label] -= 1
        back = self.outputs @ p
        self.outputs -= np.float32(rate) * np.outer(mean, p)
        self.bias -= np.float32(rate * 0.1) * p
        self.vectors[ids] = own - shares[:, None] * (np.float32(rate) * back)

    def weights(self) -> tuple[np.ndarray, float]:
        """What each bucket adds to the difference of the outputs, and the rest of it."""
        return np.einsum("ij,j->i", self.vectors, self.outputs[:, 1] - self.outputs[:, 0]).astype(np.float64), float(self.bias[1] - self.bias[0])


def scores(weights: np.ndarray, rest: float, texts: list[str | None]) -> np.ndarray:
    """The softmax output of label 1 for each text. Weights are float64, so sums don't depend on how texts are held together."""
    total, n = np.full(len(texts), weights[END_BUCKET]), np.ones(len(texts), np.int64)
    for held, owner in pieces(texts):
        for h, good, where in features(held):
            w = weights[h]
            if good is None:
                np.add.at(total, owner, np.bincount(where, w, len(owner)))
                np.add.at(n, owner, np.bincount(where, minlength=len(owner)))
            else:
                w[~good] = 0
                np.add.at(total, owner, np.add.reduceat(w, where))
                np.add.at(n, owner, np.add.reduceat(good.astype(np.int64), where))
    return 1 / (1 + np.exp(-np.clip(total / n + rest, -60, 60)))


def packed(ids: np.ndarray, shares: np.ndarray) -> tuple[bytes, bytes]:
    return zlib.compress(np.diff(ids, prepend=np.int32(0)).tobytes(), 1), zlib.compress(shares.tobytes(), 1)


def unpacked(ids: bytes, shares: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(np.frombuffer(zlib.decompress(ids), np.int32)), np.frombuffer(zlib.decompress(shares), np.float32)


COUNTED = pa.schema([("shard", pa.int32()), ("key", pa.int64()), ("doc_id", pa.int64()), ("label", pa.int32()), ("ids", pa.binary()), ("shares", pa.binary())])
COUNTED_DDL = "shard int, key long, doc_id long, label int, ids binary, shares binary"
SHARD = pa.schema([("shard", pa.int32()), ("labels", pa.list_(pa.int32())), ("ids", pa.list_(pa.binary())), ("shares", pa.list_(pa.binary()))])
SHARD_DDL = "shard int, labels array<int>, ids array<binary>, shares array<binary>"
SLICE = pa.schema([("slice", pa.int32()), ("shard", pa.int32()), ("n", pa.int64()), ("numbers", pa.binary())])
SLICE_DDL = "slice int, shard int, n long, numbers binary"
SLICES = 8


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cols = {c: b.column(b.schema.get_field_index(c)) for c in ("shard", "key", "doc_id", "label")}
        got = [packed(*counted(t)) for t in b.column(b.schema.get_field_index("text")).to_pylist()]
        yield to_batch(cols | {"ids": [x for x, _ in got], "shares": [y for _, y in got]}, COUNTED)


def _sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each shard: most_rows / shards compressed documents, some kilobytes each. A row can't be split, however its table is read."""
    shard, held = None, ([], [], [])
    for b in batches:
        for k, *row in zip(*(b.column(i).to_pylist() for i in (0, 3, 4, 5)), strict=True):
            if k != shard:
                if shard is not None:
                    yield to_batch(dict(zip(SHARD.names, ([shard], *([x] for x in held)), strict=True)), SHARD)
                shard, held = k, ([], [], [])
            for x, v in zip(held, row, strict=True):
                x.append(v)
    if shard is not None:
        yield to_batch(dict(zip(SHARD.names, ([shard], *([x] for x in held)), strict=True)), SHARD)


def outside(folds: int) -> Column:
    """Whether a row is held out of training."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds == 0


def sample(docs: DataFrame, labels: DataFrame, training: Training, folds: int) -> DataFrame:
    """(doc_id, key, label) of the rows that are learned from, at most most_rows: distinct texts of labelled ids, by the hash of id and text."""
    label = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.avg((F.col("quality") != 0).cast("int")) >= 0.5).cast("int").alias("label"))
    rows = docs.where(F.col("doc_id").isNotNull() & ~outside(folds)).select("doc_id", F.xxhash64("doc_id", "text").alias("key")).distinct()
    return written(rows.join(label, "doc_id").orderBy("key", "doc_id").limit(training.most_rows), "sample")


def train(docs: DataFrame, labels: DataFrame, training: Training, folds: int) -> tuple[np.ndarray, float]:
    """Weights of the buckets and the rest."""
    spark = docs.sparkSession
    chosen = sample(docs, labels, training, folds)
    classes = {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()}  # two rows
    if len(classes) < 2:
        return np.zeros(BUCKETS), 60.0 * (2 * next(iter(classes), 0.5) - 1)
    texts = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    rows = texts.join(F.broadcast(chosen), ["doc_id", "key"]).dropDuplicates(["doc_id", "key"])  # most_rows rows are broadcast
    rows = rows.select(F.pmod("key", F.lit(training.shards)).cast("int").alias("shard"), "key", "doc_id", "label", "text")
    counts = written(rows.mapInArrow(_counted, COUNTED_DDL), "counts").repartitionByRange(training.shards, "shard").sortWithinPartitions("shard", "key", "doc_id")
    shards = written(counts.mapInArrow(_sharded, SHARD_DDL), "shards")
    passes = max(1, round(training.steps / training.rounds / sum(classes.values())))
    model = Model.fresh(training.seed)
    for k in range(training.rounds):
        rate = training.rate * (1 - 0.9 * k / max(1, training.rounds - 1))
        shared = spark.sparkContext.broadcast(model.numbers())
        model = averaged(shards.mapInArrow(_learned(shared, rate, passes), SLICE_DDL), training.shards)
        shared.destroy()  # the round is over: its job has ended
    return model.weights()


def _learned(shared, rate: float, passes: int):
    """The model after some passes over each shard, in slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                rows = list(zip(*(b.column(i)[k].as_py() for i in (1, 2, 3)), strict=True))
                own = Model.of(shared.value)
                for _ in range(passes):
                    for label, ids, shares in rows:
                        own.learn(*unpacked(ids, shares), label, rate)
                cut = np.array_split(own.numbers(), SLICES)
                yield to_batch({"slice": range(SLICES), "shard": [b.column(0)[k].as_py()] * SLICES, "n": [len(rows)] * SLICES, "numbers": [x.tobytes() for x in cut]}, SLICE)

    return run


def _mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mean of each slice over the shards, weighted by their rows; neighbouring rows have one slice."""
    at, n, total = None, 0, np.zeros(0)
    out = lambda: to_batch({"slice": [at], "shard": [0], "n": [n], "numbers": [(total / n).astype(np.float32).tobytes()]}, SLICE)
    for b in batches:
        for k, m, raw in zip(*(b.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
            x = np.frombuffer(raw, np.float32).astype(np.float64) * m
            if k != at:
                if at is not None:
                    yield out()
                at, n, total = k, 0, np.zeros(len(x))
            n, total = n + m, total + x
    if at is not None:
        yield out()


def averaged(models: DataFrame, shards: int) -> Model:
    """The mean of the shards' models; the driver gets one model."""
    means = models.repartition(shards, "slice").sortWithinPartitions("slice", "shard").mapInArrow(_mean, SLICE_DDL)
    return Model.of(np.concatenate([np.frombuffer(r["numbers"], np.float32) for r in sorted(means.collect(), key=lambda r: r["slice"])]))


OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def quality_scores(docs: DataFrame, labels: DataFrame, training: Training = Training(), folds: int = 5, limit: float = 0.3) -> DataFrame:
    """Learns from labelled rows outside fold 0 and scores all rows; predicted is 1 from `limit` on. Scoring is a projection."""
    prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, training, folds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = scores(*shared.value, b.column(2).to_pylist())
            yield to_batch({"doc_id": b.column(0), "held_out": b.column(1), "score": got, "predicted": (got >= limit).astype(np.int32)}, OUT)

    return docs.select("doc_id", outside(folds).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
