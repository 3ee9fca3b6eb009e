"""The quality classifier, periodic runs and vector codes against plain versions, and their edge cases."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from sheaf.llm import quality_classifier as qc
from sheaf.llm import runs, vector_codes
from sheaf.llm.queries import QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# runs


def plain_runs(w, least=6, exponent=4):
    out = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            begin = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - begin >= max(least, exponent * q):
                out.setdefault((begin, i + q), q)
            i += 1
    return sorted((a, b - a, q) for (a, b), q in out.items())


def plain_row(doc_id, text):
    w = WORDS.findall(text or "")
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    got = plain_runs(w)
    gone = {i for s, size, q in got for i in range(s + q, s + size)}
    best = max(got, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    sha = lambda x: hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest()
    return (doc_id, len(got), *best, best[0] if best[0] is None else 1000 * best[1] // best[2], sha("".join(f"{s},{size},{q}\n" for s, size, q in got)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_runs_of_random_words():
    rng = random.Random(1)
    for _ in range(150):
        docs = []
        for _ in range(12):
            n, letters = rng.choice([0, 1, 5, 6, 7, 20, 60, 200]), rng.choice([1, 2, 3, 8])
            w = [rng.randrange(letters) for _ in range(n)]
            for _ in range(rng.randrange(3)):
                if n > 10:
                    s, q = rng.randrange(n), rng.randrange(1, 8)
                    for k in range(s + q, min(n, s + rng.randrange(1, 60))):
                        w[k] = w[k - q]
            docs.append(np.array(w, np.int32))
        for least, exponent in ((6, 4), (3, 3), (9, 5)):
            for d, got in zip(docs, runs.grouped_runs(docs, least, exponent), strict=True):
                assert [tuple(r) for r in got.tolist()] == plain_runs(d.tolist(), least, exponent)


def test_long_runs_stay_near_linear():
    import time

    n = 400_000
    thue = [0]
    while len(thue) < n:
        thue += [1 - x for x in thue]
    began = time.perf_counter()
    for w, want in ((np.zeros(n), [[0, n, 1]]), (np.arange(n) % 1000, [[0, n, 1000]]), (np.array(thue), []), (np.arange(n), [])):
        assert runs.grouped_runs([w.astype(np.int32)], 6, 4)[0].tolist() == want
    assert time.perf_counter() - began < 60


def test_op12_against_brute_force(spark, sf, tmp_path):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").where("length(text) < 3000").collect()]
    # ids whose documents are rewritten, with null and empty texts, repeated rows, a text of many parts and letters of many bytes
    ids = [k for k in range(100_000, 101_000) if zlib.crc32(str(k).encode()) % 10 == 0][:8]
    rows += [(ids[0], None), (ids[1], ""), (ids[2], "a b c d e"), (ids[3], "x " * 50), (ids[4], "é 日本 é 日本 🙂 " * 9), (ids[4], "é 日本 é 日本 🙂 " * 9), (None, "one two one two one two one two one two three"), (7, None), (8, " \t\n\x0b\x0c\r"), (9, "\x00 \x00 \x00 \x00 \x00 \x00 \x85 \x85")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(7).alias(c) for c in ("runs", "collapsed", "n_runs", "best", "start", "length", "lines")])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op12_periodic_runs"](spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in out.collect()), key=key) == sorted((plain_row(*r) for r in rows), key=key)
    assert runs.periodic_runs(docs.limit(0)).collect() == []


def test_runs_of_a_text_of_many_parts(spark):
    text = " ".join(["start"] + [f"w{k % 3000}" for k in range(300_000)] + ["end"])
    got = runs.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert len(text) > runs.PART
    assert [tuple(r) for r in got.runs] == [(1, 300_000, 3000)] and got.collapsed == " ".join(["start"] + [f"w{k}" for k in range(3000)] + ["end"])


# vector codes


def plain_codes(rows, parts=16, entries=64, rounds=2):
    good = [(i, label, v) for i, label, v in rows if v is not None and v and all(x is not None and math.isfinite(x) for x in v) and len(v) % parts == 0]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    good = [r for r in good if len(r[2]) == len(good[0][2])]
    width = len(good[0][2]) // parts
    x = [[[(lambda a, b: a * 256 // b)(*v.as_integer_ratio()) for v in r[2][k * width : (k + 1) * width]] for k in range(parts)] for r in good]
    books = [[x[e][k] for e in range(min(entries, len(x)))] for k in range(parts)]
    d = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b, strict=True))
    assign = lambda: [[min(range(len(books[k])), key=lambda e: (d(row[k], books[k][e]), e)) for k in range(parts)] for row in x]
    for _ in range(rounds):
        codes = assign()
        for k in range(parts):
            for e in range(len(books[k])):
                own = [row[k] for row, c in zip(x, codes, strict=True) if c[k] == e]
                if own:
                    books[k][e] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    codes = assign()
    errors = [min(sum(d(row[k], books[k][c[k]]) for k in range(parts)), vector_codes.MOST_LONG) for row, c in zip(x, codes, strict=True)]
    total = {}
    for (_, label, _), e in zip(good, errors, strict=True):
        total[label] = total.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return [(r[0], "".join(f"{v:02x}" for v in c), e, min(total[r[1]], vector_codes.MOST_LONG), digest) for r, c, e in zip(good, codes, errors, strict=True)]


VECTORS = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(DoubleType())), StructField("label", IntegerType())])


def vectors(kind, n=700):
    rng = random.Random(kind)
    rows = []
    for k in range(n):
        if kind == "clusters":
            c = rng.randrange(12)
            v = [math.sin(c * 7 + j) + rng.gauss(0, 0.02) for j in range(32)]
        elif kind == "ties":  # few distinct vectors, hence equal entries and equal distances
            v = [rng.choice([-0.5, 0.0, 0.5]) for _ in range(16)] if k % 3 else [0.25] * 16
        elif kind == "huge":
            v = [rng.choice([1.0, -3.4e38, 1e30, 2.5e9, 5e5]) * rng.random() for _ in range(16)]
        else:
            v = [rng.uniform(-1, 1) for _ in range(64)]
        rows.append((k, v, rng.choice([None, 0, 0, 0, 1, 2])))
    return rows


@pytest.mark.parametrize("kind", ["clusters", "ties", "huge", "even"])
def test_op13_against_brute_force(spark, tmp_path, kind):
    rows = vectors(kind)
    size = len(rows[0][1])
    rows += [(1, None, 0), (-5, [], 0), (-4, [None] + [1.0] * (size - 1), 0), (-3, [math.nan] * size, 0), (-2, [math.inf] + [0.0] * (size - 1), 1), (-1, [0.5] * (size - 3), 1), (90_000, [0.5] * (2 * size), 1)]
    rows += [(None, rows[5][1], 1), (None, rows[6][1], None), rows[7], (9, rows[10][1], 2)]
    random.Random(2).shuffle(rows)
    frame = spark.createDataFrame(rows, VECTORS).withColumn("code", F.lit(1)).withColumn("error", F.lit(1)).withColumn("_label", F.lit(1)).repartition(5)
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    out = QUERIES["op13_vector_codes"](spark, str(tmp_path))
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in out.collect()), key=key) == sorted(plain_codes([(i, label, v) for i, v, label in rows]), key=key)


def test_heaps_spare_most_comparisons(spark):
    """Later rounds look at the parts whose bounds drift has violated, and no round's result differs from comparing all."""
    rows = vectors("clusters", 2000)
    got = vector_codes.compress(spark.createDataFrame(rows, VECTORS), entries=12, rounds=6)
    assert got.compared[0] == 16 * len(rows) and got.compared[-1] < got.compared[0] / 4
    want = plain_codes([(i, label, v) for i, v, label in rows], entries=12, rounds=6)
    assert sorted((r.vec_id, r.code, r.error) for r in got.rows.collect()) == sorted(w[:3] for w in want)


def test_no_vectors_and_few_vectors(spark, tmp_path):
    few = [(3, [0.5] * 16, None), (1, [-0.25] * 16, 4)]
    spark.createDataFrame(few, VECTORS).write.parquet(f"{tmp_path}/a/embeddings.parquet")
    assert sorted(tuple(r) for r in QUERIES["op13_vector_codes"](spark, f"{tmp_path}/a").collect()) == sorted(plain_codes([(i, label, v) for i, v, label in few]))
    spark.createDataFrame([(3, None, 1)], VECTORS).write.parquet(f"{tmp_path}/b/embeddings.parquet")
    out = QUERIES["op13_vector_codes"](spark, f"{tmp_path}/b")
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and out.collect() == []


def test_more_labels_than_are_broadcast(spark, monkeypatch):
    rows = spark.createDataFrame([(k, str(k % 5) if k % 7 else None, "00", k) for k in range(50)], vector_codes.CODED_DDL)
    want = sorted((r.vec_id, r.label_error) for r in vector_codes.with_label_errors(rows).collect())
    monkeypatch.setattr(vector_codes, "FEW_LABELS", 2)
    assert sorted((r.vec_id, r.label_error) for r in vector_codes.with_label_errors(rows).collect()) == want


# quality classifier


def plain_buckets(text):
    """The buckets of all features of a text of one part, one by one."""
    m = 1 << 32
    mix = lambda h: (((h ^ (h >> 15)) * int(qc.MIX)) % m) >> (32 - qc.BITS)
    raw = [33] + [33 if c in (9, 10, 11, 12, 13, 32) else c + 1 for c in (text or "").encode()] + [33]
    out = [qc.END_BUCKET]
    for n in qc.NGRAMS:
        for i in range(len(raw) - n + 1):
            if 33 not in raw[i + 1 : i + n - 1]:
                h = raw[i]
                for c in raw[i + 1 : i + n]:
                    h = (h * int(qc.STEP) + c) % m
                out.append(mix((h + n) % m))
    last = None
    word = []
    for c in raw:
        if c != 33:
            word.append(c)
        elif word:
            total = 0
            for place, x in enumerate(word):
                v = (x + place * int(qc.STEP)) % m * int(qc.MIX) % m
                total += (v ^ (v >> 16)) * int(qc.PAIR) % m
            total %= m
            out.append(mix(total))
            if last is not None:
                out.append(mix(int(qc.DITTO) if last == total else (last * int(qc.STEP) % m) ^ (total * int(qc.PAIR) % m)))
            last, word = total, []
    return out


TEXTS = [None, "", " ", "a", "a a", "ab cd\tab  ab ab", "é ß\n日本 🙂 x", "one two three four five six", " lead and trail ", "x" * 300]


def test_features_are_what_they_are_said_to_be():
    rng = np.random.default_rng(3)
    weights = rng.normal(size=qc.BUCKETS)
    want = [1 / (1 + math.exp(-(weights[plain_buckets(t)].mean() + 0.25))) for t in TEXTS]
    assert np.allclose(qc.scores(weights, 0.25, TEXTS), want)
    assert np.allclose([qc.scores(weights, 0.25, [t])[0] for t in TEXTS], want, rtol=1e-15)
    for t in TEXTS:
        ids, shares = qc.unpacked(*qc.packed(*qc.counted(t)))
        found = np.bincount(plain_buckets(t), minlength=qc.BUCKETS)
        assert ids.tolist() == np.flatnonzero(found).tolist() and np.allclose(shares, found[ids] / found.sum())


def test_long_texts_are_read_whole(monkeypatch):
    weights = np.random.default_rng(3).normal(size=qc.BUCKETS)
    text = " ".join(f"w{k * k % 1013}" for k in range(20_000))
    whole = qc.scores(weights, 0.0, [text, "short", text])
    monkeypatch.setattr(qc, "PART", 10_000)
    assert np.allclose(qc.scores(weights, 0.0, [text, "short", text]), whole, rtol=1e-3) and whole[0] == whole[2]
    assert [b"".join(h) for h, _ in qc.pieces(["x" * 25_000])] == [b"x" * 10_000, b"x" * 10_000, b"x" * 5_000]


def test_the_descent_follows_the_gradient():
    """A step lowers the cross entropy as its gradient, taken numerically, says."""
    rng = np.random.default_rng(5)
    ids, shares = np.array([3, 9, 77]), np.array([0.5, 0.25, 0.25], np.float32)
    model = qc.Model.fresh(1)
    model.outputs = rng.normal(size=(qc.DIM, 2)).astype(np.float32)

    def loss(m):
        z = shares @ m.vectors[ids] @ m.outputs + m.bias
        return float(np.log(np.exp(z).sum()) - z[1])

    step = qc.Model(model.vectors.copy(), model.outputs.copy(), model.bias.copy())
    step.learn(ids, shares, 1, 1e-2)
    for name, at in (("vectors", (9, 2)), ("outputs", (4, 0))):
        moved = qc.Model(model.vectors.astype(np.float64), model.outputs.astype(np.float64), model.bias.astype(np.float64))
        getattr(moved, name)[at] += 1e-4
        slope = (loss(moved) - loss(model)) / 1e-4
        assert getattr(step, name)[at] - getattr(model, name)[at] == pytest.approx(-1e-2 * slope, rel=0.05, abs=1e-6)


FAST = qc.Training(steps=4000, rounds=3, shards=4)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = QUERIES["op11_quality_classifier"](spark, sf)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in rows.items())
    held = [(rows[r.doc_id], r.quality) for r in labels.collect() if rows[r.doc_id].held_out]
    assert sum(r.predicted == q for r, q in held) / len(held) > 0.95
    assert min(r.score for r, q in held if q) > max(r.score for r, q in held if not q)


def test_scores_ignore_held_out_labels_and_other_columns_and_partitions(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    want = {r.doc_id: r.score for r in qc.quality_scores(docs, labels, FAST).collect()}
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    more = docs.withColumn("lang", F.lit("zz")).withColumn("label", F.lit(0)).withColumn("key", F.lit("k")).withColumn("shard", F.lit(3)).repartition(7)
    assert {r.doc_id: r.score for r in qc.quality_scores(more, turned.repartition(3), FAST).collect()} == want


def test_classifier_edges(spark):
    rows = [(0, None), (1, ""), (2, "good words here"), (2, "good words here"), (None, "no id"), (5, "a " * 400_000), (6, "ß日本🙂 \x00"), (7, "|| $$ ##")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("quality", F.lit("clash"))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = qc.quality_scores(docs, none, FAST).collect()
    assert len(got) == len(rows) and {r.score for r in got} == {0.5}
    one = spark.createDataFrame([(2, 1, 0), (None, 0, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    assert all(r.score > 0.999 and r.predicted == 1 for r in qc.quality_scores(docs, one, FAST).collect())
    both = spark.createDataFrame([(k % 9, int(k % 9 != 7), 0) for k in range(30)] + [(2, 0, 0)], "doc_id long, quality int, toxic int")
    got = qc.quality_scores(docs, both, FAST).collect()
    assert len(got) == len(rows) and len({r.score for r in got if r.doc_id == 2}) == 1
    assert qc.quality_scores(docs.limit(0), both, FAST).collect() == []


def test_the_sample_is_bounded(spark):
    docs = spark.createDataFrame([(k % 40, f"text {k}") for k in range(400)] * 2, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    got = qc.sample(docs, labels, qc.Training(most_rows=50), 5)
    assert got.count() == got.distinct().count() == 50
    assert sorted(map(tuple, qc.sample(docs.repartition(9), labels, qc.Training(most_rows=50), 5).collect())) == sorted(map(tuple, got.collect()))
