"""Language identification with error-correcting output codes (operator 10).

Each language gets a codeword; each bit has a binary classifier over hashed byte n-grams of words, naive Bayes between the languages
with bit one and those with bit zero, every language weighing the same. A text's bits are decoded by the loss of each codeword,
weighted by how well a bit separates the languages; the nearest codeword wins, and a small lead is flagged as ambiguous.

Training uses all labelled rows outside the held-out fifth: n-gram counts are summed in each task to one vector a language, cut into
slices, and the slices are summed over tasks by language, so a hot language is spread over tasks too. Every language that has
a training row can be predicted. The bits are trained from sums over the languages on either side, which are made where the languages' counts
lie. The driver gets the languages' names and totals and one matrix of n-grams by bits (33 MB at most), no counts of any language; up to
128 languages have codewords as long as their number, more have MANY_BITS bits.

Defined results: a null text or one without letters (Unicode category L; numerals are none) is `und` with score 0; if nothing is labelled, all are `und`; with one
language, all texts with letters get it; a null id is hashed as an empty string; repeated rows are predicted each for itself;
an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm.common import partitions, prepare, table, to_batch, written

LETTER = regex.compile(r"\p{L}")
BITS = 14
SIZE = 1 << BITS
NOT_LETTERS = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]+")


def has_letter(text: str | None) -> bool:
    return bool(text) and LETTER.search(text) is not None


def ngram_counts(text: str) -> np.ndarray:
    """Counts of hashed 2-, 3- and 4-grams of the lower-case letters, words parted by one space."""
    raw = b" " + NOT_LETTERS.sub(b" ", text.lower().encode("utf-8", "surrogatepass")) + b" "
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    h2 = b[:-1] * np.uint32(257) + b[1:]
    h3 = h2[:-1] * np.uint32(263) + b[2:]
    h4 = h3[:-1] * np.uint32(269) + b[3:] if len(b) > 3 else h3[:0]
    out = np.zeros(SIZE, np.int64)
    for salt, h in ((1, h2), (2, h3), (3, h4)):
        out += np.bincount((h + np.uint32(salt)) * np.uint32(2654435761) >> np.uint32(32 - BITS), minlength=SIZE)
    return out


MANY, MANY_BITS = 128, 255
LANGS = 4096  # codewords that are handled at once


def codewords(n: int) -> np.ndarray:
    """n rows of -1 and 1: rows of a Hadamard matrix without its first column, so that any two differ in about half the bits.

    Of more than MANY rows only MANY_BITS columns are taken: those that number the rows, which keep them apart, and others at random.
    """
    bits = max(n - 1, 7).bit_length()
    columns = np.arange(1, 1 << bits)
    if n > MANY:
        numbering = 1 << np.arange(bits)
        others = np.setdiff1d(columns, numbering)
        columns = np.concatenate([numbering, np.random.default_rng(7).permutation(others)[: MANY_BITS - bits]])
    rows = (np.bitwise_count(np.arange(at, min(at + LANGS, n))[:, None] & columns) & 1 for at in range(0, n, LANGS))
    return np.concatenate([1 - 2 * x.astype(np.int8) for x in rows])


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # n-grams x bits
    bit_weight: np.ndarray
    lead: float = 0.2

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, score and ambiguity of each row of counts."""
        total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
        margin = np.clip((counts @ self.weights) / np.sqrt(total), -30, 30)  # grows with the evidence, slower than the text
        # a codeword's loss is sum of w * log(1 + exp(-c * m)); half of the two signs' sum is the same for all, half of their difference is w * m
        loss = np.concatenate([self.code[at : at + LANGS].astype(np.float64) @ (margin * self.bit_weight).T for at in range(0, len(self.langs), LANGS)]).T / -2
        p = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        p /= p.sum(axis=1, keepdims=True)
        best = loss.argmin(axis=1)
        top = np.partition(p, -2, axis=1)[:, -2:] if p.shape[1] > 1 else np.pad(p, ((0, 0), (1, 0)))
        return best, p[np.arange(len(p)), best], top[:, 1] - top[:, 0] < self.lead


TRAIN = pa.schema([("lang", pa.string()), ("slice", pa.int32()), ("counts", pa.binary()), ("total", pa.int64())])
TRAIN_DDL = "lang string, slice int, counts binary, total long"
SLICES = 16
HELD = 256  # languages that a task sums before it sends their sums on


def _sum_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of each language's counts in this task's texts."""
    sums: dict[str, np.ndarray] = {}

    def out() -> pa.RecordBatch:
        rows = [(k, i, zlib.compress(x.tobytes(), 1), int(x.sum())) for k, v in sums.items() for i, x in enumerate(np.split(v, SLICES))]
        sums.clear()
        return to_batch(dict(zip(TRAIN.names, zip(*rows, strict=True), strict=True)), TRAIN)

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if has_letter(text):
                if lang not in sums:
                    if len(sums) == HELD:
                        yield out()
                    sums[lang] = np.zeros(SIZE, np.int64)
                sums[lang] += ngram_counts(text)
    if sums:
        yield out()


def _sum_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of neighbouring rows with one language and slice; one vector is held at a time."""
    key, total = None, np.zeros(SIZE // SLICES, np.int64)
    out = lambda: to_batch({"lang": [key[0]], "slice": [key[1]], "counts": [zlib.compress(total.tobytes(), 1)], "total": [int(total.sum())]}, TRAIN)
    for b in batches:
        for lang, part, raw in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
            if key != (lang, part):
                if key is not None:
                    yield out()
                key, total = (lang, part), np.zeros(SIZE // SLICES, np.int64)
            total += np.frombuffer(zlib.decompress(raw), np.int64)
    if key is not None:
        yield out()


BIT_SUMS = pa.schema([("slice", pa.int32()), ("sums", pa.binary())])
BIT_SUMS_DDL = "slice int, sums binary"


def _share(raw: bytes, total: int) -> np.ndarray:
    """What the n-grams of a slice are of all that the language has, none of them never."""
    return (np.frombuffer(zlib.decompress(raw), np.int64) + 0.5) / (total + 0.5 * SIZE)


def _bit_sums(known):
    """Sums of the shares of the languages with bit one and of all, for each n-gram of each slice, in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, code = known.value
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for lang, part, raw in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                number, total = totals[lang]
                share = _share(raw, total)
                if part not in held:
                    held[part] = np.zeros((SIZE // SLICES, code.shape[1] + 1))
                held[part][:, :-1] += share[:, None] * (code[number] > 0)
                held[part][:, -1] += share
        for part, sums in held.items():
            yield to_batch({"slice": [part], "sums": [sums.tobytes()]}, BIT_SUMS)

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of neighbouring rows of one slice."""
    at, total = None, np.zeros(0)
    for b in batches:
        for part, raw in zip(*(b.column(k).to_pylist() for k in range(2)), strict=True):
            x = np.frombuffer(raw)
            if part != at:
                if at is not None:
                    yield to_batch({"slice": [at], "sums": [total.tobytes()]}, BIT_SUMS)
                at, total = part, np.zeros(len(x))
            total = total + x
    if at is not None:
        yield to_batch({"slice": [at], "sums": [total.tobytes()]}, BIT_SUMS)


def _spread(known, weights):
    """For each bit, the sum over this task's languages of how far their own margins are on either side; the slices of a language are neighbours."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, _ = known.value
        w = weights.value
        width = SIZE // SLICES
        lang, margin, total = None, np.zeros(w.shape[1]), np.zeros(w.shape[1])
        for b in batches:
            for name, part, raw in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                if name != lang:
                    total += np.abs(margin)
                    lang, margin = name, np.zeros(w.shape[1])
                margin += _share(raw, totals[name][1]) @ w[part * width : (part + 1) * width]
        yield to_batch({"slice": [0], "sums": [(total + np.abs(margin)).tobytes()]}, BIT_SUMS)

    return run


def train(rows: DataFrame) -> Model | None:
    """A model from all rows of (lang, text)."""
    spark = rows.sparkSession
    n = partitions(spark)
    parts = rows.select("lang", "text").mapInArrow(_sum_texts, TRAIN_DDL)
    sums = written(parts.repartition(n, "lang", "slice").sortWithinPartitions("lang", "slice").mapInArrow(_sum_slices, TRAIN_DDL), "language-counts")
    totals = dict(sorted((r["lang"], r["total"]) for r in sums.groupBy("lang").agg(F.sum("total").alias("total")).collect()))  # names and totals
    langs = list(totals)
    if not langs:
        return None
    if len(langs) == 1:
        return Model(langs, np.ones((1, 1), np.int8), np.zeros((SIZE, 1)), np.ones(1))
    code = codewords(len(langs))
    ones = (code > 0).sum(axis=0)
    code, ones = code[:, (ones > 0) & (ones < len(langs))], ones[(ones > 0) & (ones < len(langs))]
    known = spark.sparkContext.broadcast(({lang: (k, totals[lang]) for k, lang in enumerate(langs)}, code))
    by_slice = sums.mapInArrow(_bit_sums(known), BIT_SUMS_DDL).repartition(n, "slice").sortWithinPartitions("slice").mapInArrow(_added, BIT_SUMS_DDL)
    share = np.concatenate([np.frombuffer(r["sums"]).reshape(-1, len(ones) + 1) for r in sorted(by_slice.collect(), key=lambda r: r["slice"])])  # SLICES rows
    weights = np.log(share[:, :-1] / ones) - np.log((share[:, -1:] - share[:, :-1]) / (len(langs) - ones))
    sent = spark.sparkContext.broadcast(weights)
    apart = sums.repartition(n, "lang").sortWithinPartitions("lang").mapInArrow(_spread(known, sent), BIT_SUMS_DDL).collect()  # a row of bits for each task
    spread = sum(np.frombuffer(r["sums"]) for r in apart)
    return Model(langs, code, weights, spread / spread.sum() * len(spread))


OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])


def predict(docs: DataFrame, model: Model | None, held_out: Column) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: n-grams x code bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts = b.column(2).to_pylist()
            n = len(texts)
            there = [k for k, t in enumerate(texts) if m is not None and has_letter(t)]
            lang, score, unsure = ["und"] * n, [0.0] * n, [True] * n
            step = 64 if m is None else max(1, min(64, (1 << 22) // m.code.size))  # texts decoded at once
            for at in range(0, len(there), step):
                part = there[at : at + step]
                for k, i, s, u in zip(part, *m.predict(np.stack([ngram_counts(texts[k]) for k in part]).astype(np.float64)), strict=True):
                    lang[k], score[k], unsure[k] = m.langs[i], float(s), bool(u)
            yield to_batch({"doc_id": b.column(0), "held_out": b.column(1), "lang_pred": lang, "score": score, "ambiguous": unsure}, OUT)

    return docs.select("doc_id", held_out.alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")


def language_id(docs: DataFrame, folds: int = 5) -> DataFrame:
    """Trains on labelled documents outside fold 0 and predicts all."""
    prepare(docs.sparkSession)
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds == 0
    model = train(docs.where(F.col("lang").isNotNull() & ~held_out).select("lang", "text"))
    return predict(docs, model, held_out)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))
