"""Homomorphic multiset fingerprints of documents (operator 3).

A document is the multiset of its paragraphs: its lines, blank ones too, each kind of blank for itself. A paragraph is hashed to a
wide vector of two parts: LANES lanes modulo 2**64, which decide equality, and CELLS cells modulo 2**16, into which the paragraph's
word triples are counted, each in one cell with a sign. A document's state is the sum of the vectors, so paragraphs are put in and
taken out one by one, in any order, and the state of two texts together is the sum of theirs. The fingerprint is that state,
written in hex: lanes, a dot, cells. `parse` gives the state back, for `add`, `remove`, `together` and `likeness`.

The likeness of two fingerprints is 1 if they are equal, else the cosine of their cells, not under 0 and not over MOST. It
estimates the cosine of the texts' counts of word triples (three words in a row within a line; a line with fewer words is one), with an
error of about 1 / sqrt(CELLS) = 0.06; texts without words are like none but equal ones. A cell that a text fills beyond 32,767 wraps.

Defined results: a null text counts as empty; equal texts, and texts with the same lines in another order, have equal
fingerprints; the document after the last one is the first; a single document follows itself; an empty table gives no rows;
null ids come last. Rows of one id, or of none, follow by their texts' hashes, then by their texts, so rows that differ have one order. Further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheaf.llm.common import partitions, prepare, table, to_batch, written
from sheaf.llm.rolling import BASE, SPACE, U, mix, prefix, substrings

LANES, CELLS = 8, 256
MASK = U(0xFFFF)  # cells are kept modulo 2**16
MOST = 0.999  # likeness of texts that differ
PART = 1 << 16  # lines, and at least so many bytes, that are hashed at once
_ODD = (np.arange(1, LANES + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15)) | U(1)


class Hashes(NamedTuple):
    """What a text's paragraphs are hashed to: 128-bit hashes of the lines, as pairs, and hashes of the word triples in them."""

    lines: np.ndarray
    triples: np.ndarray


def paragraph_hashes(text: str) -> Hashes:
    raw = text.encode("utf-8", "surrogatepass")
    digests = b"".join(hashlib.blake2b(x, digest_size=16).digest() for x in raw.split(b"\n"))
    return Hashes(np.frombuffer(digests, "<u8").reshape(-1, 2), np.concatenate([triples(x) for x in parts_of(raw)] or [np.zeros(0, np.uint64)]))


def parts_of(raw: bytes) -> Iterator[bytes]:
    """Whole lines of the text, some kilobytes at a time; a line is never cut."""
    at = 0
    while at < len(raw):
        end = raw.find(b"\n", at + PART)
        end = len(raw) if end < 0 else end + 1
        yield raw[at:end]
        at = end


def triples(raw: bytes) -> np.ndarray:
    """Hashes of the word triples within lines; the words of a line with fewer are one."""
    if not raw:
        return np.zeros(0, np.uint64)
    b = np.frombuffer(raw, np.uint8)
    edge = np.diff(np.concatenate(([True], SPACE[b], [True])).astype(np.int8))
    begin = np.flatnonzero(edge == -1)
    w = substrings(prefix(b), begin, np.flatnonzero(edge == 1))
    line = np.cumsum(b == 10)[begin]
    out = []
    for n in (1, 2, 3):
        if len(w) < n:
            break
        h = np.full(len(w) - n + 1, U(n))
        for k in range(n):
            h = h * U(BASE) + w[k : len(w) - n + 1 + k]
        inside = line[: len(h)] == line[n - 1 :]
        if n < 3:  # the line begins and ends with them
            inside = inside & np.concatenate(([True], line[1 : len(h)] != line[: len(h) - 1])) & np.concatenate((line[n:] != line[: len(line) - n], [True]))
        out.append(mix(h[inside]))
    return np.concatenate(out) if out else w


def state_of(hashes: Hashes) -> np.ndarray:
    """The sum of the paragraphs' vectors: lanes, then cells."""
    out = np.zeros(LANES + CELLS, np.uint64)
    for at in range(0, len(hashes.lines), PART):
        pair = hashes.lines[at : at + PART]
        x = pair[:, :1] * _ODD + pair[:, 1:]
        x ^= x >> U(31)
        x *= U(0xD6E8FEB86659FD93)
        x ^= x >> U(29)
        out[:LANES] += x.sum(axis=0, dtype=np.uint64)
    cell, sign = (hashes.triples >> U(56)).astype(np.int64), 1.0 - 2.0 * (hashes.triples & U(1)).astype(np.float64)
    out[LANES:] = np.bincount(cell, sign, CELLS).astype(np.int64).view(np.uint64) & MASK
    return out


def add(state: np.ndarray, hashes: Hashes) -> np.ndarray:
    return together(state, state_of(hashes))


def remove(state: np.ndarray, hashes: Hashes) -> np.ndarray:
    other = state_of(hashes)
    return np.concatenate([state[:LANES] - other[:LANES], (state[LANES:] - other[LANES:]) & MASK])


def together(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The state of the paragraphs of both."""
    return np.concatenate([a[:LANES] + b[:LANES], (a[LANES:] + b[LANES:]) & MASK])


def fingerprint(state: np.ndarray) -> str:
    return f"{state[:LANES].astype('>u8').tobytes().hex()}.{state[LANES:].astype('>u2').tobytes().hex()}"


def parse(fingerprint: str) -> np.ndarray:
    """The state that a fingerprint holds."""
    lanes, cells = map(bytes.fromhex, fingerprint.split("."))
    return np.concatenate([np.frombuffer(lanes, ">u8").astype(np.uint64), np.frombuffer(cells, ">u2").astype(np.uint64)])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if (a == b).all():
        return 1.0
    x, y = (s[LANES:].astype(np.uint16).view(np.int16).astype(np.float64) for s in (a, b))
    size = float(np.sqrt((x @ x) * (y @ y)))
    return min(max(float(x @ y) / size, 0.0), MOST) if size else 0.0


def edited(text: str, following: str) -> str:
    n = len(text) // 2
    return text[: len(text) - n] + following[:n]


OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
OUT_DDL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
STEP = pa.schema([*OUT, ("task", pa.int64()), ("kind", pa.string()), ("text", pa.string())])
STEP_DDL = OUT_DDL + ", task long, kind string, text string"


class Document:
    def __init__(self, doc_id: int | None, text: str | None):
        self.doc_id, self.text = doc_id, text or ""
        self.state = state_of(paragraph_hashes(self.text))

    def beside(self, other: Document) -> tuple:
        """The row of this document before that one. The edited text's state is made from this one's by taking out and putting in what differs."""
        new = edited(self.text, other.text)
        kept = self.text[: len(self.text) - len(self.text) // 2].rfind("\n") + 1  # whole paragraphs before it stay
        state = add(remove(self.state, paragraph_hashes(self.text[kept:])), paragraph_hashes(new[kept:]))
        return (self.doc_id, len(self.text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), fingerprint(self.state), fingerprint(state), likeness(self.state, state), likeness(self.state, other.state))


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one sorted partition. Its first and last text go on, to be joined across partitions."""
    task, last = TaskContext.get().partitionId(), None
    for b in batches:
        done, heads = [], []
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            doc = Document(doc_id, text)
            if last is None:
                heads.append((doc_id, *[None] * 6, task, "head", doc.text))
            else:
                done.append((*last.beside(doc), task, "done", None))
            last = doc
        rows = done + heads
        if rows:
            yield to_batch(dict(zip(STEP.names, zip(*rows, strict=True), strict=True)), STEP)
    if last is not None:
        yield to_batch(dict(zip(STEP.names, ([x] for x in (last.doc_id, *[None] * 6, task, "tail", last.text)), strict=True)), STEP)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [Document(i, t).beside(Document(None, u)) for i, t, u in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True)]
        yield to_batch(dict(zip(OUT.names, zip(*rows, strict=True), strict=True)) if rows else {c: [] for c in OUT.names}, OUT)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text, whose second half comes from the next document in descending id order."""
    spark = prepare(docs.sparkSession)
    # a total order up to equal rows: what follows a row doesn't depend on how the table was read, and one id can lie in several ranges
    order = F.col("doc_id").desc_nulls_last(), F.col("_hash"), F.col("text")
    ranges = docs.select("doc_id", "text", F.xxhash64("text").alias("_hash")).repartitionByRange(partitions(spark), *order[:2]).sortWithinPartitions(*order)
    rows = written(ranges.mapInArrow(_in_order, STEP_DDL), "fingerprints", compression="zstd")  # hex halves
    # A row for each partition that has documents; the next such partition's number, from the last one the first.
    heads = rows.where("kind = 'head'").select(F.col("task").alias("head_task"), F.col("text").alias("head"))
    tasks = rows.where("kind = 'head'").select("task")
    following = F.coalesce(F.lead("task").over(Window.orderBy("task")), F.min("task").over(Window.partitionBy()))
    tasks = tasks.select("task", following.alias("head_task"))
    seams = rows.where("kind = 'tail'").select("doc_id", "text", "task").join(tasks, "task").join(heads, "head_task").select("doc_id", "text", "head")
    return rows.where("kind = 'done'").select(*OUT.names).unionByName(seams.mapInArrow(_across, OUT_DDL))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
