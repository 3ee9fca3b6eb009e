"""Removal of repeated byte strings by column-wise suffix construction (operator 8).

A byte goes if a `length`-byte string that covers it also starts earlier: in a document with a smaller id, or before in the
same one. Four steps:

1. Anchors. Every string of that length (a window) holds k-byte strings; the one with the least hash, the leftmost of equal
   ones, is its anchor. Equal windows have equal anchors at the same place. Neighbouring windows with one anchor are a segment.
2. Segments meet by anchor. Of equal segments all but the earliest are repeats as a whole. Anchors with one kind of segment
   are done; of the others one segment of each kind goes on.
3. Those segments' bytes are gathered by anchor and aligned at it. The collection is built column by column: each round
   inserts one symbol of every segment and refines the order of all of them; the ranks after each round, which say what
   prefixes are shared, go to a sequential file that is read back in reverse while the left contexts are built the same way.
   A window is a left context and a right context, so windows are equal if both ranks are.
4. The repeats found in 2 and 3 are brought to the documents.

Hot anchors take another way. A passage that many documents hold, each after another text, gives an anchor as many kinds of segments as
there are documents. An anchor with HOT kinds or more in one map task's batch is reported, and no segment of it is compared by anchor: its
windows are hashed one by one (128 bits), the earliest of equal ones goes on from each batch, and they meet by hash. So the passage's own windows
are combined before they travel, and those with other text spread over all partitions. What meets by anchor is thus less than HOT kinds a batch.

Blocks of packed numbers travel instead of rows, each with the number of its partition; map tasks combine equal segments
before, so a hot passage reaches step 2 once for each task.

A document is an id and a text: `key`, a hash of both, tells texts apart that share an id or have none, and orders them. So ranges
are found and applied by (id, key), never by the id alone. Anchors, segments and keys are compared by 64-bit hashes, the keys only
among rows of one id; windows of what is left are compared byte by byte.

Defined results: a null text counts as empty; texts shorter than `length` stay whole; a null id sorts before all others; of rows
with one id, or without one, but different texts the one with the smaller key is earlier; rows with equal ids and equal texts are one
document, which is treated alike in each of them; an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm.common import partitions, prepare, table, to_batch, written
from sheaf.llm.rolling import U, grams, mix, prefix, sliding_min, substrings

ANCHOR = 24  # bytes of an anchor
CHUNK = 1 << 20  # windows of a long text that are looked at together
FLUSH = 400_000  # segments a map task combines at once
HOT = 16  # kinds of segments in one such batch from which an anchor is hot
LOW = U(0xFFFFFF)

SEGMENT = np.dtype([("anchor", "<u8"), ("seg", "<u8"), ("doc", "<i8"), ("key", "<u8"), ("start", "<u4"), ("n", "u1"), ("off", "u1")])
RANGE = np.dtype([("doc", "<i8"), ("key", "<u8"), ("start", "<u4"), ("n", "u1")])
WINDOW = np.dtype([("hash", "<u8"), ("other", "<u8"), ("doc", "<i8"), ("key", "<u8"), ("start", "<u4")])
ANCHOR_NUMBER = np.dtype([("anchor", "<u8")])
WANTED = np.dtype([("doc", "<i8"), ("key", "<u8"), ("anchor", "<u8"), ("start", "<u4"), ("n", "u1"), ("off", "u1")])

BLOCK = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("doc_id", pa.int64()), ("block", pa.binary()), ("more", pa.string()), ("key", pa.int64())])
BLOCK_DDL = "part int, kind int, doc_id long, block binary, more string, key long"
KEY_MASK = (1 << 64) - 1  # keys travel as signed integers
#: Kinds of blocks; those that a document needs come before it.
SEGMENTS, HOT_ANCHORS, REPEATS, WANT, DEFERRED, DOC, CONTEXTS, WINDOWS = range(8)


def packed(a: np.ndarray) -> bytes:
    """Field after field, which compresses better than row after row."""
    return b"".join(np.ascontiguousarray(a[f]).tobytes() for f in a.dtype.names)


def unpacked(raw: bytes, dtype: np.dtype) -> np.ndarray:
    n = len(raw) // dtype.itemsize
    out, at = np.empty(n, dtype), 0
    for f in dtype.names:
        size = n * dtype[f].itemsize
        out[f] = np.frombuffer(raw, dtype[f], n, at)
        at += size
    return out


def joined(blocks: list[bytes], dtype: np.dtype) -> np.ndarray:
    return np.concatenate([unpacked(b, dtype) for b in blocks]) if blocks else np.empty(0, dtype)


def part_of(numbers: np.ndarray, parts: int) -> np.ndarray:
    return (mix(numbers) % U(parts)).astype(np.int32)


NO_ID = -(2**63)  # stands for a null id


def identity(doc_id: int | None, raw: bytes) -> tuple[int, int]:
    """The id, or what stands for none, and the key of the document."""
    doc = NO_ID if doc_id is None else doc_id
    return doc, int.from_bytes(hashlib.blake2b(raw, digest_size=8, key=doc.to_bytes(8, "little", signed=True)).digest(), "little")


def of_document(a: np.ndarray, doc: int, key: int) -> np.ndarray:
    """The rows of one document, from rows sorted by key."""
    lo, hi = np.searchsorted(a["key"], U(key), "left"), np.searchsorted(a["key"], U(key), "right")
    mine = a[lo:hi]
    return mine[mine["doc"] == doc]


def blocks(a: np.ndarray, field: str, kind: int, parts: int) -> pa.RecordBatch:
    """A row for each partition that gets something of a."""
    part = part_of(a[field], parts)
    order = np.argsort(part, kind="stable")
    a, part = a[order], part[order]
    cuts = np.flatnonzero(np.diff(part)) + 1
    pieces = [packed(x) for x in np.split(a, cuts)] if len(a) else []
    firsts = part[np.concatenate(([0], cuts))].tolist() if len(a) else []
    return to_batch({"part": firsts, "kind": [kind] * len(firsts), "doc_id": [None] * len(firsts), "block": pieces, "more": [None] * len(firsts), "key": [None] * len(firsts)}, BLOCK)


def segments(doc: int, raw: bytes, length: int, key: int = 0) -> Iterator[np.ndarray]:
    """The segments of a text, by chunks; a cut between chunks ends a segment early, which step 3 makes good."""
    b, width = np.frombuffer(raw, np.uint8), length - ANCHOR + 1
    for begin in range(0, len(b) - length + 1, CHUNK):
        c = b[begin : begin + CHUNK + length - 1]
        h = grams(c, ANCHOR)
        at = (sliding_min((h & ~LOW) | np.arange(len(h), dtype=np.uint64), width) & LOW).astype(np.int64)
        cut = np.flatnonzero(np.diff(at)) + 1
        s, e = np.concatenate(([0], cut)), np.concatenate((cut, [len(at)]))
        out = np.empty(len(s), SEGMENT)
        out["anchor"], out["seg"] = h[at[s]], substrings(prefix(c), s, e + length - 1)
        out["doc"], out["key"], out["start"], out["n"], out["off"] = doc, key, begin + s, e - s, at[s] - s
        yield out


def split_repeats(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The earliest of each kind of segment, sorted by anchor; the others as ranges of repeats."""
    a = a[np.lexsort((a["start"], a["key"], a["doc"], a["n"], a["off"], a["seg"], a["anchor"]))]
    if len(a):  # a row that is there twice is one document
        a = a[np.concatenate(([True], a[1:] != a[:-1]))]
    same = np.zeros(len(a), bool)
    if len(a):
        same[1:] = np.logical_and.reduce([a[f][1:] == a[f][:-1] for f in ("anchor", "seg", "off", "n")])
    return a[~same], a[same][["doc", "key", "start", "n"]].astype(RANGE)


WANTED_FIELDS = ["doc", "key", "anchor", "start", "n", "off"]


def kinds_of_anchors(a: np.ndarray) -> np.ndarray:
    """For each segment, sorted by anchor, how many there are of its anchor."""
    new = np.concatenate(([True], a["anchor"][1:] != a["anchor"][:-1])) if len(a) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    return np.bincount(group)[group] if len(a) else np.zeros(0, np.int64)


def windows(segments: np.ndarray, raw: bytes, length: int) -> np.ndarray:
    """All windows of one document's segments, with two hashes: of their bytes, and of these in reverse."""
    b = np.frombuffer(raw, np.uint8)
    start = np.concatenate([np.arange(int(w["start"]), int(w["start"]) + int(w["n"])) for w in segments])
    out = np.empty(len(start), WINDOW)
    lo, hi = int(start.min()), int(start.max()) + length
    part = b[lo:hi]
    out["hash"] = substrings(prefix(part), start - lo, start - lo + length)
    out["other"] = substrings(prefix(part[::-1]), hi - start - length, hi - start)
    out["doc"], out["key"], out["start"] = segments["doc"][0], segments["key"][0], start
    return out


def split_windows(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The earliest of equal windows; the others as ranges of repeats."""
    a = a[np.lexsort((a["start"], a["key"], a["doc"], a["other"], a["hash"]))]
    same = np.zeros(len(a), bool)
    same[1:] = (a["hash"][1:] == a["hash"][:-1]) & (a["other"][1:] == a["other"][:-1])
    later = a[same]
    ranges = np.empty(len(later), RANGE)
    ranges["doc"], ranges["key"], ranges["start"], ranges["n"] = later["doc"], later["key"], later["start"], 1
    return a[~same], compact(ranges)


def _find(length: int, parts: int, hot: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        count = 0

        def flush() -> Iterator[pa.RecordBatch]:
            first, repeats = split_repeats(np.concatenate(held))
            many = kinds_of_anchors(first) >= hot
            yield blocks(first[~many], "anchor", SEGMENTS, parts)
            yield blocks(first[many][WANTED_FIELDS].astype(WANTED), "key", DEFERRED, parts)
            yield blocks(np.unique(first["anchor"][many]).astype(ANCHOR_NUMBER), "anchor", HOT_ANCHORS, parts)
            yield blocks(repeats, "key", REPEATS, parts)

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                doc, key = identity(doc, raw)
                for s in segments(doc, raw, length, key):
                    held.append(s)
                    count += len(s)
                if count >= FLUSH:
                    yield from flush()
                    held, count = [], 0
        if held:
            yield from flush()

    return run


def _meet(parts: int):
    """Step 2 on one partition's blocks. Blocks of repeats and of hot anchors' segments pass through on their way to the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {SEGMENTS: [], HOT_ANCHORS: []}
        for b in batches:
            kinds = b.column(1).to_pylist()
            for k, block in zip(kinds, b.column(3).to_pylist(), strict=True):
                if k in held:
                    held[k].append(block)
            yield b.filter(pa.array([k not in held for k in kinds], pa.bool_()))
        a = joined(held[SEGMENTS], SEGMENT)
        if len(a):
            many = np.isin(a["anchor"], joined(held[HOT_ANCHORS], ANCHOR_NUMBER)["anchor"])
            yield blocks(a[many][WANTED_FIELDS].astype(WANTED), "key", DEFERRED, parts)
            first, repeats = split_repeats(a[~many])
            several = kinds_of_anchors(first) > 1
            yield blocks(repeats, "key", REPEATS, parts)
            yield blocks(first[several][WANTED_FIELDS].astype(WANTED), "key", WANT, parts)

    return run


def _contexts(length: int, parts: int):
    """Wanted segments of a partition's documents, as blocks: fields, then the segments' bytes, compressed. Of deferred ones the windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {WANT: [], DEFERRED: []}
        wanted, deferred, done = None, None, set()
        unzip, found, size = zstandard.ZstdDecompressor(), [], 0
        hashed: list[np.ndarray] = []
        n_hashed = 0

        def window_blocks() -> Iterator[pa.RecordBatch]:
            first, repeats = split_windows(np.concatenate(hashed))
            yield blocks(first, "hash", WINDOWS, parts)
            yield blocks(repeats, "key", REPEATS, parts)

        for b in batches:
            for kind, doc, block, key in zip(*(b.column(c).to_pylist() for c in (1, 2, 3, 5)), strict=True):
                if kind in held:
                    held[kind].append(block)
                elif kind == DOC:
                    if wanted is None:
                        wanted, deferred = (x[np.argsort(x["key"], kind="stable")] for x in (joined(held[k], WANTED) for k in (WANT, DEFERRED)))
                        held = {WANT: [], DEFERRED: []}
                    doc, key = NO_ID if doc is None else doc, key & KEY_MASK
                    mine, hot = of_document(wanted, doc, key), of_document(deferred, doc, key)
                    if (len(mine) or len(hot)) and (doc, key) not in done:  # equal rows are one document
                        done.add((doc, key))
                        raw = unzip.decompress(block)
                        if len(hot):
                            hashed.append(windows(hot, raw, length))
                            n_hashed += len(hashed[-1])
                            if n_hashed >= FLUSH:
                                yield from window_blocks()
                                hashed, n_hashed = [], 0
                        for w in mine:
                            begin = int(w["start"])
                            found.append((w, raw[begin : begin + int(w["n"]) + length - 1]))
                            size += len(found[-1][1])
                        if size > 1 << 23:
                            yield _context_blocks(found, parts)
                            found, size = [], 0
        if found:
            yield _context_blocks(found, parts)
        if hashed:
            yield from window_blocks()

    return run


def _context_blocks(found: list, parts: int) -> pa.RecordBatch:
    a = np.array([w for w, _ in found], WANTED)
    part = part_of(a["anchor"], parts)
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    rows: dict[str, list] = {c: [] for c in BLOCK.names}
    zip_ = zstandard.ZstdCompressor(level=1)
    for members in np.split(order, cuts):
        body = b"".join(found[k][1] for k in members)
        mine = a[members]
        for c, v in zip(BLOCK.names, (int(part[members[0]]), CONTEXTS, len(members), zip_.compress(packed(mine) + body), None, None), strict=True):
            rows[c].append(v)
    return to_batch(rows, BLOCK)


def refine(ranks: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Ranks of contexts that are longer by one symbol each: equal if both were equal."""
    _, out = np.unique(ranks.astype(np.int64) * 257 + symbols, return_inverse=True)
    return out.astype(np.int32)


def alone(ranks: np.ndarray) -> np.ndarray:
    return np.bincount(ranks)[ranks] == 1


def scratch_folder() -> str | None:
    """Spark's own scratch disk of this task's executor: what is there is read by the same task only and made again if the task is."""
    return os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None


def repeats_of(a: np.ndarray, text: np.ndarray, begin: np.ndarray, length: int) -> np.ndarray:
    """Ranges of windows that are repeats, from segments (WANTED) whose bytes start in text at begin.

    Ranks of right contexts are kept for every length in a file, written column after column and read in reverse.
    """
    if not len(a):
        return np.empty(0, RANGE)
    end = begin + a["n"] + length - 1
    anchor = begin + a["off"]
    _, ranks = np.unique(a["anchor"], return_inverse=True)
    ranks = ranks.astype(np.int32)
    most = int(a["off"].max())  # windows start up to so many bytes before their anchor
    out: list[np.ndarray] = []
    with tempfile.TemporaryFile(dir=scratch_folder()) as file:
        right, live = ranks, np.arange(len(a))
        for column in range(length + 1):  # after the round: contexts of `column` symbols from the anchor on
            if column:
                at = anchor + column - 1
                symbols = np.where(at < end, text[np.minimum(at, len(text) - 1)], 256)
                if column > ANCHOR:  # up to there equal by their anchor
                    new = refine(right[live], symbols[live])
                    right = right.copy()
                    right[live] = new
            if column >= length - most:
                file.write(right.tobytes())
        left, order = ranks, np.lexsort((a["start"], a["key"], a["doc"]))
        earliest = np.empty(len(a), np.int64)
        earliest[order] = np.arange(len(a))
        for back in range(most + 1):  # windows that start `back` bytes before their anchor
            if back:
                at = anchor - back
                left = refine(left, np.where(at >= begin, text[np.maximum(at, 0)], 256))
            file.seek((most - back) * right.nbytes)
            right = np.frombuffer(file.read(right.nbytes), np.int32)
            first = a["off"].astype(np.int64) - back  # the window's place among the segment's
            has = np.flatnonzero((first >= 0) & (first < a["n"]) & ~alone(left) & ~alone(right))
            if len(has) > 1:
                key = left[has].astype(np.int64) << 32 | right[has]
                o = np.lexsort((earliest[has], key))
                later = has[o[1:][key[o[1:]] == key[o[:-1]]]]
                r = np.empty(len(later), RANGE)
                r["doc"], r["key"], r["start"], r["n"] = a["doc"][later], a["key"][later], a["start"][later] + first[later], 1
                out.append(r)
    if not out:
        return np.empty(0, RANGE)
    return np.concatenate(out)


def compact(r: np.ndarray) -> np.ndarray:
    """Neighbouring ranges of one document joined, up to 255 windows each."""
    if not len(r):
        return r
    r = r[np.lexsort((r["start"], r["key"], r["doc"]))]
    step = np.concatenate(([True], (r["doc"][1:] != r["doc"][:-1]) | (r["key"][1:] != r["key"][:-1]) | (r["start"][1:] != r["start"][:-1] + 1)))
    place = np.arange(len(r)) - np.maximum.accumulate(np.where(step, np.arange(len(r)), 0))
    head = np.flatnonzero(step | (place % 255 == 0))
    out = r[head].copy()
    out["n"] = np.diff(np.append(head, len(r)))
    return out


def _build(length: int, parts: int):
    """Step 3 on one partition's contexts, some megabytes of whole anchors at a time, and hot anchors' windows. Blocks of repeats pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields, bodies, hashed, unzip = [], [], [], zstandard.ZstdDecompressor()
        for b in batches:
            kinds = b.column(1).to_pylist()
            for kind, n, block in zip(kinds, b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if kind == WINDOWS:
                    hashed.append(block)
                elif kind == CONTEXTS:
                    raw = unzip.decompress(block)
                    fields.append(unpacked(raw[: n * WANTED.itemsize], WANTED))
                    bodies.append(np.frombuffer(raw, np.uint8, offset=n * WANTED.itemsize))
            yield b.filter(pa.array([k == REPEATS for k in kinds], pa.bool_()))
        if hashed:
            yield blocks(split_windows(joined(hashed, WINDOW))[1], "key", REPEATS, parts)
        if not fields:
            return
        a, text = np.concatenate(fields), np.concatenate(bodies)
        size = a["n"].astype(np.int64) + length - 1
        begin = np.cumsum(size) - size
        order = np.argsort(a["anchor"], kind="stable")
        a, begin = a[order], begin[order]
        new = np.flatnonzero(np.concatenate(([True], a["anchor"][1:] != a["anchor"][:-1])))
        lo = 0
        while lo < len(a):  # whole anchors, about 50,000 segments
            k = np.searchsorted(new, lo + 50_000)
            hi = int(new[k]) if k < len(new) else len(a)
            yield blocks(compact(repeats_of(a[lo:hi], text, begin[lo:hi], length)), "key", REPEATS, parts)
            lo = hi

    return run


def spans_of(ranges: np.ndarray, n_bytes: int, length: int) -> list[tuple[int, int]]:
    """Maximal runs of removed bytes from ranges of windows."""
    if not len(ranges):
        return []
    ranges = ranges[np.argsort(ranges["start"], kind="stable")]
    begin, end = ranges["start"].astype(np.int64), np.minimum(ranges["start"].astype(np.int64) + ranges["n"] + length - 1, n_bytes)
    reach = np.maximum.accumulate(end)
    cut = np.flatnonzero(begin[1:] > reach[:-1]) + 1
    return list(zip(begin[np.concatenate(([0], cut))].tolist(), reach[np.concatenate((cut - 1, [len(end) - 1]))].tolist(), strict=True))


def kept_bytes(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]])


FOUND = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary()), ("more", pa.string())])
FOUND_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, more string"


def _cut(length: int, with_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ranges, unzip = [], None, zstandard.ZstdDecompressor()
        for b in batches:
            rows: dict[str, list] = {c: [] for c in FOUND.names}
            for kind, doc, block, more, key in zip(*(b.column(c).to_pylist() for c in range(1, 6)), strict=True):
                if kind == REPEATS:
                    held.append(block)
                    continue
                if ranges is None:
                    ranges = joined(held, RANGE)
                    ranges = ranges[np.argsort(ranges["key"], kind="stable")]
                raw = unzip.decompress(block)
                spans = spans_of(of_document(ranges, NO_ID if doc is None else doc, key & KEY_MASK), len(raw), length)
                kept = kept_bytes(raw, spans)
                for c, v in zip(FOUND.names, (doc, len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept if with_bytes else None, more), strict=True):
                    rows[c].append(v)
            yield to_batch(rows, FOUND)

    return run


def _documents(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=1)
        for b in batches:
            ids = b.column(0).to_pylist()
            raw = [(t or "").encode("utf-8", "surrogatepass") for t in b.column(1).to_pylist()]
            keys = np.array([identity(i, x)[1] for i, x in zip(ids, raw, strict=True)], np.uint64)
            yield to_batch({"part": part_of(keys, parts), "kind": [DOC] * len(ids), "doc_id": ids, "block": [zip_.compress(x) for x in raw], "more": b.column(2), "key": keys.view(np.int64)}, BLOCK)

    return run


PARTITION_BYTES = 64 << 20  # text whose segments one worker holds


def partitions_for(docs: DataFrame) -> int:
    """Partitions of the segments: a worker holds a whole partition's, about as many bytes as their texts have, so their number follows from the texts' bytes."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(partitions(docs.sparkSession), -(-size // PARTITION_BYTES))


def repeated_bytes(docs: DataFrame, length: int = 100, with_bytes: bool = False, carry: tuple[str, ...] = (), hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, if asked for the kept bytes, and the columns named in carry.

    Those travel with their row, so null and repeated ids need no join afterwards.
    """
    spark = prepare(docs.sparkSession)
    parts = partitions_for(docs)
    rest = docs.select(*carry).schema
    docs = docs.select("doc_id", "text", (F.to_json(F.struct(*carry)) if carry else F.lit(None).cast("string")).alias("more"))
    at = lambda rows: rows.repartitionById(parts, F.col("part"))
    blocks_first = lambda rows: at(rows).sortWithinPartitions("kind")  # noqa: E731  blocks stand before documents
    packed_docs = docs.mapInArrow(_documents(parts), BLOCK_DDL)
    met = written(at(docs.select("doc_id", "text").mapInArrow(_find(length, parts, hot), BLOCK_DDL)).mapInArrow(_meet(parts), BLOCK_DDL), "segments")
    contexts = blocks_first(met.where(F.col("kind").isin(WANT, DEFERRED)).unionByName(packed_docs)).mapInArrow(_contexts(length, parts), BLOCK_DDL)
    built = at(contexts).mapInArrow(_build(length, parts), BLOCK_DDL)
    repeats = met.where(F.col("kind") == REPEATS).unionByName(built)
    found = blocks_first(repeats.unionByName(packed_docs)).mapInArrow(_cut(length, with_bytes), FOUND_DDL)
    return found.withColumn("more", F.from_json("more", rest)).select(*FOUND.names[:-1], "more.*") if carry else found.drop("more")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(table(spark, sf_dir, "documents")).drop("kept")
