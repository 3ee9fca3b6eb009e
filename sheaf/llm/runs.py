"""Periodic run detection (operator 12).

A run is a stretch of words with smallest period q and at least max(min_length, exponent * q) words that no neighbour extends. Two places a
period apart agree over all of a run but its first q words, so a run without its first q words overlaps itself without its last q in k words at least, where
k is the least max(min_length, exponent * q) - q of any q (5 here): each word of a run is in k words in a row that the document has a second time. Words
outside such repeated k-grams are masked; what survives are stretches of words, and a run lies within one.

Main and Lorentz's search goes over the surviving segments only: a segment is halved again and again, and of each block all runs across its middle
are found from how far the words match forwards and backwards between the middle and the place one period before or after
it. A run of four periods has at least one of its periods on one side of the middle, and its period is at most a quarter of the block. The blocks of one
depth, of all segments of some documents, are searched together. Matches are measured by prefix hashes modulo two primes and
bisection, so a segment of n words costs n * log(n)**2 at most, whatever its words; the result is exact but for collisions of 62 bits.

Defined results: words are `[^\\x20\\x09-\\x0D]+`; a null or empty text has no words and no runs, and collapses to an empty text; a run is named once, by its smallest
period; repeated rows are searched each for itself; an empty table gives no rows; further columns are not looked at. Texts are read
in parts, so a worker holds a text, its distinct words, and some 60 bytes for each word.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm.common import prepare, table, to_batch

PART = 1 << 20
GROUP_WORDS = 1 << 18  # words of documents that are searched together; a longer document is searched alone
MIX = np.uint64(0x9E3779B97F4A7C15)
PRIMES = ((2147483647, 1234567891), (2147483629, 987654321))  # modulus and base
BLANKS = b" \t\n\x0b\x0c\r"


def parts(raw: bytes) -> Iterator[bytes]:
    """The text in parts of about PART bytes that don't cut words."""
    at = 0
    while at < len(raw):
        end = min(at + PART, len(raw))
        while end < len(raw) and raw[end] not in BLANKS:
            end += 1
        yield raw[at:end]
        at = end


def numbered(text: str | None) -> tuple[np.ndarray, list[bytes]]:
    """The text's words as numbers, and the distinct words."""
    index: dict[bytes, int] = {}
    got = [np.zeros(0, np.int32)]
    for part in parts((text or "").encode("utf-8", "surrogatepass")):
        words = part.split()
        got.append(np.fromiter((index.setdefault(w, len(index)) for w in words), np.int32, len(words)))
    return np.concatenate(got), list(index)


def overlap(min_length: int, exponent: int) -> int:
    """Words that a run shares with itself one period on, at least."""
    return min(max(min_length, exponent * q) - q for q in range(1, min_length + 1))


def surviving(words: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the stretches of words inside k-grams that their document has twice or more. A collision of hashes makes a stretch longer, never shorter."""
    m = len(words) - k + 1
    if m < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = doc[:m].astype(np.uint64)
    for j in range(k):
        h = (h ^ (h >> np.uint64(29))) * MIX + words[j : j + m].astype(np.uint64) + np.uint64(1)
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    twice = np.zeros(m, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice & (doc[:m] == doc[k - 1 :]))
    cover = np.bincount(at, minlength=len(words) + 1) - np.bincount(at + k, minlength=len(words) + 1)
    left = np.cumsum(cover[:-1]) > 0
    border = np.ones(len(words) + 1, bool)
    border[1:-1] = doc[1:] != doc[:-1]
    begin = left & (border[:-1] | np.concatenate([[True], ~left[:-1]]))
    end = left & (border[1:] | np.concatenate([~left[1:], [True]]))
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


class Matches:
    """How far two places of a row of numbers agree."""

    def __init__(self, x: np.ndarray):
        self.sums, self.powers = [], []
        for prime, base in PRIMES:
            power = np.ones(1, np.int64)
            while len(power) <= len(x):
                power = np.concatenate([power, power * (int(power[-1]) * base % prime) % prime])
            power = power[: len(x) + 1]
            self.powers.append(power)
            self.sums.append(np.concatenate([[0], np.cumsum((x + 1) * power[:-1] % prime) % prime]))

    def equal(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether n numbers from i and from j on agree, i < j."""
        out = np.ones(len(i), bool)
        for (prime, _), s, p in zip(PRIMES, self.sums, self.powers, strict=True):
            out &= (s[i + n] - s[i]) % prime * p[j - i] % prime == (s[j + n] - s[j]) % prime
        return out

    def forwards(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        return self._bisect(lambda n: self.equal(i, j, n), most)

    def backwards(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many numbers before i and before j agree."""
        return self._bisect(lambda n: self.equal(i - n, j - n, n), most)

    @staticmethod
    def _bisect(holds: Callable[[np.ndarray], np.ndarray], most: np.ndarray) -> np.ndarray:
        low, high = np.zeros(len(most), np.int64), most.astype(np.int64)
        while (open_ := low < high).any():
            mid = (low + high + 1) // 2
            good = holds(mid)
            low, high = np.where(open_ & good, mid, low), np.where(open_ & ~good, mid - 1, high)
        return low


TURNS = 6  # periods of a block that are looked at one by one before all others


def _near(x: np.ndarray, c: np.ndarray, p: np.ndarray, least: int) -> np.ndarray:
    """Whether the places c agree with those p before them, and enough of their neighbours for a run of `least` words or more.

    The matching stretch has the whole run but a period, so `least` - 1 words at period 1 and more beyond: two more match
    to the right or three to the left. Where a neighbour is beyond the row, any answer will do, as the stretch then goes the other way.
    """
    same = lambda k: x[np.clip(c + k, 0, len(x) - 1)] == x[np.clip(c - p + k, 0, len(x) - 1)]
    if least < 6:
        return same(0)
    return same(0) & ((same(1) & same(2)) | (same(-1) & same(-2) & same(-3)))


def runs_of(x: np.ndarray, begin: np.ndarray, end: np.ndarray, min_length: int, exponent: int) -> np.ndarray:
    """Rows (begin, end, period) of the runs inside segments, each row once and by its smallest period."""
    found = [np.zeros((0, 3), np.int64)]
    matches = Matches(x.astype(np.int64))
    left, right, first, last = begin, end, begin, end  # blocks, and the segments that they are of
    while len(left):
        middle = (left + right) // 2
        periods = (right - left) // exponent
        block = np.repeat(np.arange(len(left)), periods)
        p = np.arange(len(block)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
        c = middle[block]
        for before in (True, False):
            there = _near(x, c, p if before else -p, least=min_length)
            q, m, of = p[there], c[there], block[there]
            for last_turn in (False,) * TURNS + (True,):
                now = np.ones(len(q), bool)
                if not last_turn:  # the block's shortest period only: if it is a run's, its multiples within that run give the run again
                    now[1:] = of[1:] != of[:-1]
                i, j = (m[now] - q[now], m[now]) if before else (m[now], m[now] + q[now])
                b = matches.backwards(i, j, i - first[of[now]])
                f = matches.forwards(i, j, last[of[now]] - j)
                got = np.stack([i - b, j + f, q[now]], axis=1)
                is_run = got[:, 1] - got[:, 0] >= np.maximum(min_length, exponent * q[now])
                found.append(got[is_run])
                if last_turn or now.all():
                    break
                base, size = np.ones(len(left), np.int64), np.zeros(len(left), np.int64)
                base[of[now]], size[of[now]] = q[now], np.where(is_run, got[:, 1] - got[:, 0], 0)
                rest = ~now & ~((q % base[of] == 0) & (q < size[of]))
                q, m, of = q[rest], m[rest], of[rest]
        left, right, first, last = (np.concatenate([a, z]) for a, z in ((left, middle), (middle, right), (first, first), (last, last)))
        more = right - left >= min_length
        left, right, first, last = left[more], right[more], first[more], last[more]
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    return rows[new]


def grouped_runs(docs: list[np.ndarray], min_length: int, exponent: int) -> list[np.ndarray]:
    """Rows (start, length, period) of each document's runs, by start, then period."""
    sizes = np.array([len(d) for d in docs])
    words, doc, base = np.concatenate(docs), np.repeat(np.arange(len(docs)), sizes), np.cumsum(sizes) - sizes
    begin, end = surviving(words, doc, overlap(min_length, exponent))
    rows = runs_of(words, begin, end, min_length, exponent)
    at = doc[rows[:, 0]] if len(rows) else np.zeros(0, np.int64)
    rows = np.stack([rows[:, 0] - base[at], rows[:, 1] - rows[:, 0], rows[:, 2]], axis=1) if len(rows) else rows
    order = np.lexsort((rows[:, 2], rows[:, 0], at))
    rows, at = rows[order], at[order]
    cut = np.searchsorted(at, np.arange(len(docs) + 1))
    return [rows[cut[k] : cut[k + 1]] for k in range(len(docs))]


def collapsed(words: np.ndarray, names: list[bytes], runs: np.ndarray) -> bytes:
    """The words that are in no run, or in the first period of all their runs, joined by spaces."""
    if len(runs):
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
        words = words[np.cumsum(edge[:-1]) == 0]
    return b" ".join(b" ".join([names[k] for k in words[at : at + PART].tolist()]) for at in range(0, len(words), PART))


OUT = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))), ("collapsed", pa.string())])
OUT_DDL = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _search(min_length: int, exponent: int, rewrite: Callable[[int | None, int], np.ndarray | None] | None):
    def solved(held: list[tuple]) -> pa.RecordBatch:
        got = grouped_runs([w for _, w, _ in held], min_length, exponent)
        lists = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs.tolist()] for runs in got]
        texts = [collapsed(w, names, runs) for (_, w, names), runs in zip(held, got, strict=True)]
        return to_batch({"doc_id": [i for i, _, _ in held], "runs": lists, "collapsed": texts}, OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for k in range(b.num_rows):
                doc_id, (words, names) = b.column(0)[k].as_py(), numbered(b.column(1)[k].as_py())
                places = rewrite(doc_id, len(words)) if rewrite else None
                if held and size + len(words) > GROUP_WORDS:
                    yield solved(held)
                    held, size = [], 0
                held.append((doc_id, words if places is None else words[places], names))
                size += len(words)
        if held:
            yield solved(held)

    return run


def periodic_runs(docs: DataFrame, min_length: int = 6, exponent: int = 4, rewrite: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """(doc_id, runs, collapsed): each text's runs by start, then period, and the text without their repetitions. A projection: no shuffle.

    `rewrite(doc_id, n)` may name the places of the n words that stand for the document's words before the search.
    """
    if exponent < 3:
        raise ValueError("an exponent of 3 at least: the search takes periods up to a block's length through it from both sides of the middle")
    prepare(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_search(min_length, exponent, rewrite), OUT_DDL)


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Of a tenth of the documents, by the digest of the id, all words from one on repeat with some period."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = periodic_runs(table(spark, sf_dir, "documents"), rewrite=planted)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    rows = got.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("").alias("lines"), "collapsed")
    return rows.select(
        "doc_id",
        "n_runs",
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: crc32 of a text's bytes, as SQL: each byte goes through eight steps of the polynomial.
def _crc32(text: str) -> str:
    steps = "list_reduce(list_concat([xor(c, b)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda x, _: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)"
    letters = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::bigint)"
    return f"xor(list_reduce(list_concat([4294967295::bigint], {letters}), lambda c, b: {steps}), 4294967295)"


def _oracle(min_length: int = 6, exponent: int = 4) -> str:
    k = overlap(min_length, exponent)
    gram = ", ".join(f"lead(w, {j}) over p" for j in range(k))
    return rf"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as o, {_crc32("coalesce(cast(doc_id as varchar), '')")} as h from documents),
e as (select doc_id, o, len(o) as n, h % 10 = 0 and len(o) > 0 as planted, case when len(o) > 0 then (h // 10) % len(o) else 0 end as a, 3 + (h // 10) % 8 as times from d),
w as (select doc_id, i, o[1 + case when planted and i >= a then a + (i - a) % (1 + (n - a) // times) else i end] as w from (select *, unnest(range(n)) as i from e)),
g as (select * from (select doc_id, i, hash({gram}) as g, count(*) over (partition by doc_id) as n from w window p as (partition by doc_id order by i)) where i + {k} <= n),
pairs as (select a.doc_id, a.i, b.i - a.i as q from g a join g b on a.doc_id = b.doc_id and a.g = b.g and a.i < b.i),
isles as (select doc_id, q, min(i) as s, count(*) + {k - 1} + q as len from (select *, i - row_number() over (partition by doc_id, q order by i) as isle from pairs) group by doc_id, q, isle),
runs as (select doc_id, s, len, min(q) as q from isles where len >= greatest({min_length}, {exponent} * q) group by doc_id, s, len),
per as (select doc_id, count(*) as n_runs, arg_max((s, len, q), (len, -s, -q)) as b, string_agg(s || ',' || len || ',' || q || chr(10), '' order by s, q) as lines from runs group by doc_id),
gone as (select distinct w.doc_id, w.i from w join runs r on w.doc_id = r.doc_id and w.i >= r.s + r.q and w.i < r.s + r.len),
kept as (select doc_id, string_agg(w, ' ' order by i) as t from w anti join gone using (doc_id, i) group by doc_id)
select doc_id, coalesce(n_runs, 0) as n_runs, b[1] as start, b[2] as length, b[3] as period, 1000 * b[2] // b[3] as exponent_milli, sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(t, '')) as collapsed_sha256
from d left join per using (doc_id) left join kept using (doc_id)"""


ORACLES = {"op12_periodic_runs": _oracle()}
