"""SentencePiece encoding and decoding by a streaming Viterbi search (operator 7).

The text is searched left to right over the lattice of pieces. Each boundary keeps one backpointer; only boundaries within
the longest piece of the front can still be extended. Whenever all their backpointer paths meet in one boundary, the ids
before it are final and leave the window. Before a space mark that follows another character this is always so, as no
piece goes over it; the ids of such stretches are kept for reuse.

Two kinds of models are searched. Unigram: the path with the best sum of scores. BPE: a path is valid if each two
neighbouring pieces, merged anew by the model's order of merges, come out as those two; each boundary has one such path,
which ends in the ids that merging the whole text gives. Stretches that begin with two space marks or more, whose merges have equal rank, are
merged directly.

Defined results: a null text counts as empty and has no ids; characters outside the model become byte pieces (unknown if it
has none); repeated rows are encoded each for itself; an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sheaf.llm.common import prepare, table, to_batch
from sheaf.llm.tokens import tokenizer_path

MARK = "▁"
STRETCH = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
KEPT_STRETCHES, KEPT_PAIRS, KEPT_LENGTH = 800_000, 1_000_000, 40
UNIGRAM, BPE = 1, 2


class PieceModel:
    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        self.kind = proto.trainer_spec.model_type
        spec = proto.normalizer_spec
        if self.kind not in (UNIGRAM, BPE) or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or any(p.type == USER for p in proto.pieces):
            raise ValueError(f"{path}: only unigram and BPE models with the identity normalizer and without user-defined pieces")
        self.prefix = MARK if spec.add_dummy_prefix else ""
        self.pieces = [p.piece for p in proto.pieces]
        self.types = [p.type for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.unknown = next(i for i, t in enumerate(self.types) if t == UNKNOWN)
        self.longest = max(map(len, self.ids))
        self.unknown_score = min(self.scores.values(), default=0.0) - 10
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError(f"{path}: a piece goes over a space mark")
        widths: dict[str, set[int]] = defaultdict(set)
        for p in self.ids:
            if len(p) > 2:
                widths[p[-3:]].add(len(p))
        self.widths = {c: tuple(sorted(w, reverse=True)) for c, w in widths.items()}  # lengths over 2 of the pieces that end in three characters
        self.cuts = self._cuts()
        self.ranks = {p: k for k, p in enumerate(sorted(self.ids, key=lambda p: (-self.scores[p], self.ids[p])))}
        self.splits: dict[str, tuple[str, str] | None] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _cuts(self) -> re.Pattern:
        """Stretches of a text: cut before space marks, and before those other characters that follow a letter in no piece."""
        inside = {b for p in self.ids for a, b in zip(p, p[1:], strict=False) if a.isalpha()}
        free = "".join(re.escape(chr(c)) for c in range(128) if not chr(c).isalnum() and chr(c) not in inside)
        return re.compile(f"(?:{MARK}+|[^{MARK}])[^{MARK}{free}]*(?:(?<![^\\W\\d_])[{free}]+[^{MARK}{free}]*)*") if free else STRETCH

    def merged(self, s: str) -> list[str]:
        """Pieces of a string by merging neighbours: best score first, of equal ones the leftmost."""
        parts: list[str] = list(s)
        after, before = [*range(1, len(s)), -1], [*range(-1, len(s) - 1)]
        heap: list[tuple[float, int, str]] = []

        def offer(k: int) -> None:
            if k >= 0 and after[k] >= 0 and (joined := parts[k] + parts[after[k]]) in self.ids:
                heappush(heap, (-self.scores[joined], k, joined))

        for k in range(len(s)):
            offer(k)
        while heap:
            _, k, joined = heappop(heap)
            if not parts[k] or after[k] < 0 or parts[k] + parts[after[k]] != joined:
                continue  # a part of it has gone into another merge
            gone = after[k]
            parts[k], parts[gone], after[k] = joined, "", after[gone]
            if after[k] >= 0:
                before[after[k]] = k
            offer(before[k])
            offer(k)
        return [p for p in parts if p]

    def halves(self, piece: str) -> tuple[str, str] | None:
        """What the last merge of a piece joins; None for a single character, and for a piece that merging doesn't make."""
        known = self.splits.get(piece, 0)
        if known == 0:
            known = None
            if len(piece) > 1 and self.merged(piece) == [piece]:
                # The last merge is of the two parts that remain if the piece itself is no merge.
                own = self.ids.pop(piece)
                parts = self.merged(piece)
                self.ids[piece] = own
                known = (parts[0], parts[1]) if len(parts) == 2 else None
            self.splits[piece] = known
        return known

    def fits(self, a: str, b: str) -> bool:
        """Whether b may follow a in a BPE path: no merge over their seam would come before those that made them.

        The pieces are unmade step by step, the later merge first; a merge over the seam that ranks before the one unmade
        last would have been done in its place.
        """
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > KEPT_PAIRS:
                self.pairs.clear()
            known = len(b) == 1 or self.halves(b) is not None
            limit, x, y = np.inf, a, b
            while known and x:
                over = self.ranks.get(x + y)
                if over is not None and over < limit:
                    known = False
                    break
                rx, ry = (self.ranks[x] if len(x) > 1 else -1), (self.ranks[y] if len(y) > 1 else -1)
                if rx < 0 and ry < 0:
                    break
                if rx > ry:
                    limit, x = rx, self.halves(x)[1]
                else:
                    limit, y = ry + 1, self.halves(y)[0]
            self.pairs[a, b] = known
        return known

    def window(self, s: str) -> Iterator[str]:
        """Final pieces of a stretch, from a window that keeps only what isn't settled."""
        ids, longest, bpe = self.ids, self.longest, self.kind == BPE
        base, back, best = 0, [""], [0.0]  # of each boundary from base on: the piece that ends there, the path's score
        for i in range(1, len(s) + 1):
            choice, score = s[i - 1], -np.inf
            for begin in range(max(base, i - longest), i):
                piece = s[begin:i]
                if bpe:
                    if piece in ids and self.fits(back[begin - base], piece):
                        choice = piece
                        break
                else:
                    x = self.scores.get(piece, self.unknown_score if i - begin == 1 else -np.inf) + best[begin - base]
                    if x > score:
                        choice, score = piece, x
            back.append(choice)
            best.append(score)
            if len(back) > 8 * longest:
                fronts = {i - k for k in range(min(longest, i - base))}
                while len(fronts) > 1:  # the latest front steps back until all paths are in one boundary
                    last = max(fronts)
                    fronts.discard(last)
                    fronts.add(last - len(back[last - base]) if last > base else base)
                common = fronts.pop()
                if common > base:
                    yield from self._path(back, common - base)
                    back[:], best[:] = back[common - base :], best[common - base :]
                    base = common
        yield from self._path(back, len(s) - base)

    @staticmethod
    def _path(back: list[str], at: int) -> list[str]:
        out = []
        while at > 0:
            out.append(back[at])
            at -= len(back[at])
        return out[::-1]

    def short(self, s: str) -> list[str]:
        """The same as window() for a BPE stretch that fits in it: nothing is final before the end."""
        ids, known, widths, back, out = self.ids, self.pairs.get, self.widths.get, [""], []
        for i in range(1, len(s) + 1):
            piece = ""
            for n in widths(s[i - 3 : i], ()) if i > 2 else ():
                if n <= i and (longer := s[i - n : i]) in ids:
                    fit = known((back[-n], longer))
                    if self.fits(back[-n], longer) if fit is None else fit:
                        piece = longer
                        break
            if not piece:
                piece = s[i - 1]
                if i > 1 and (two := s[i - 2 : i]) in ids:
                    fit = known((back[-2], two))
                    if self.fits(back[-2], two) if fit is None else fit:
                        piece = two
            back.append(piece)
        at = len(s)
        while at:
            piece = back[at]
            out.append(piece)
            at -= len(piece)
        out.reverse()
        return out

    def stretch_ids(self, s: str) -> bytes:
        out: list[int] = []
        if self.kind == BPE and s.startswith(MARK * 2):
            pieces: Iterator[str] | list[str] = self.merged(s)
        else:
            pieces = self.short(s) if self.kind == BPE and len(s) <= 8 * self.longest else self.window(s)
        for p in pieces:
            i = self.ids.get(p)
            if i is not None:
                out.append(i)
            elif self.bytes:
                out += [self.bytes[b] for b in p.encode("utf-8", "surrogatepass")]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return np.asarray(out, "<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, "<u4")
        if len(self.kept) > KEPT_STRETCHES:
            self.older, self.kept = self.kept, {}  # what is met again comes over from the older ones
        parts = self.cuts.findall(self.prefix + text.replace(" ", MARK))
        out = list(map(self.kept.get, parts))
        if None in out:
            for k, ids in enumerate(out):
                if ids is None:
                    out[k] = self.fresh(parts[k])
        return np.frombuffer(b"".join(out), "<u4")

    def fresh(self, s: str) -> bytes:
        ids = self.kept.get(s) or self.older.get(s) or self.stretch_ids(s)
        if len(s) <= KEPT_LENGTH:
            self.kept[s] = ids
        return ids

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; runs of byte pieces as UTF-8, with U+FFFD for what is none."""
        out: list[str] = []
        raw = bytearray()
        for i in ids.tolist():
            if self.types[i] == BYTE:
                raw.append(int(self.pieces[i][3:5], 16))
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(self.pieces[i] if self.types[i] == NORMAL else " ⁇ " if self.types[i] == UNKNOWN else "")
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        text = "".join(out).replace(MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


OUT = pa.schema([("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64()), ("round_trip", pa.bool_())])


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for b in batches:
            rows: dict[str, list] = {c: [] for c in OUT.names}
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = model.encode(text or "")
                for c, v in zip(OUT.names, (doc_id, len(ids), zlib.crc32(ids.tobytes()), model.decode(ids) == (text or "")), strict=True):
                    rows[c].append(v)
            yield to_batch(rows, OUT)

    return run


def encode_pieces(docs: DataFrame, path: str) -> DataFrame:
    """Number and digest of each document's ids, and whether decoding gives the text back. A projection without a shuffle."""
    prepare(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_encode(path), "doc_id long, n_pieces long, ids_crc32 long, round_trip boolean")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
