"""Hot keys, ties and long inputs that earlier versions of the operators handled badly."""

import base64
import hashlib
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheaf.llm import fingerprints, language_id, quality_rules, secrets, suffix_dedup

rng = random.Random(4)


def value(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 + (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([tag]) + size + body


def elliptic(octets):
    return value(0x30, value(2, b"\1") + value(4, rng.randbytes(octets)))


def rsa(octets):
    return value(0x30, value(2, b"\0") + b"".join(value(2, b"\1" + rng.randbytes(octets)) for _ in range(8)))


def container():
    field = lambda b: len(b).to_bytes(4, "big") + b
    return b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + field(rng.randbytes(51)) + field(rng.randbytes(136))


def wrapped(raw, width):
    s = base64.b64encode(raw).decode()
    return "\n".join(s[k : k + width] for k in range(0, len(s), width))


MB = 5_000_000
ONE_LINE = elliptic(41)  # 48 bytes, 64 letters
KEYS = {
    "one line": ([wrapped(ONE_LINE, 64)], "der"),
    "two widths in turn": ([wrapped(ONE_LINE, 64), wrapped(elliptic(29), 48)], "der"),
    "several lines": ([wrapped(rsa(30), 64)], "der"),
    "ssh": ([wrapped(container(), 76)], "ssh"),
}


@pytest.mark.parametrize("name", KEYS)
def test_confirmed_keys_one_after_another_take_linear_time(name):
    keys, kind = KEYS[name]
    assert len(ONE_LINE) == 48 and all(secrets.confirmed_spans(k) == [(0, len(k), kind)] for k in keys)
    one, want, at = "\n".join(keys), [], 0
    text = "\n".join([one] * (MB // (len(one) + 1)))
    for k in range(MB // (len(one) + 1) * len(keys)):
        want.append((at, at + len(keys[k % len(keys)]), kind))
        at += len(keys[k % len(keys)]) + 1
    began = time.perf_counter()
    got = secrets.confirmed_spans(text)
    assert time.perf_counter() - began < 20
    # a shorter last line ends a key, so keys of lines that grow are told apart; none is lost
    assert got == want


def test_private_octets_of_elliptic_keys_have_a_size():
    for octets, there in ((19, False), (20, True), (32, True), (66, True), (67, False)):
        s = base64.b64encode(elliptic(octets)).decode()
        assert bool(secrets.confirmed_spans(s + "x" * 0)) == (there and len(s) >= 40), octets


TIED = [(5, "five\nlines"), (5, "other text of five"), (5, None), (5, "five\nlines"), (None, "no id"), (None, "another"), (7, "seven"), (3, ""), (3, "three three three"), (None, None)]


def test_fingerprints_of_tied_ids_have_one_result(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = set()
    try:
        for seed in range(4):
            rows = list(TIED)
            random.Random(seed).shuffle(rows)
            spark.conf.set("spark.sql.shuffle.partitions", str((1, 2, 8, 13)[seed]))
            out = fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(1 + seed)).collect()
            seen.add(tuple(sorted((tuple(r) for r in out), key=str)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(seen) == 1
    # the order that the docstring states, with Spark's own hash
    hashes = {r.text: r.h for r in spark.createDataFrame(TIED, "doc_id long, text string").select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(TIED, key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1]], r[1] or ""))
    want = sorted(hashlib.sha256(fingerprints.edited(t or "", order[(k + 1) % len(order)][1] or "").encode()).hexdigest() for k, (_, t) in enumerate(order))
    assert sorted(r[2] for r in next(iter(seen))) == want


def test_one_hot_id_is_spread_over_ranges(spark):
    docs = spark.createDataFrame([(1 if k % 3 else k, f"text {k}") for k in range(3000)], "doc_id long, text string")
    order = F.col("doc_id").desc_nulls_last(), F.xxhash64("text")
    sizes = [r["count"] for r in docs.repartitionByRange(8, *order).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1000 and len(fingerprints.fingerprints(docs).collect()) == 3000


def test_every_rule_of_a_condemned_host_reaches_documents_near_its_limit(spark):
    words = lambda k, n: " ".join(f"plain{k}x{j}" for j in range(n))
    twice = lambda k: " ".join([words(k, 5)] * 2 + [words(-k - 1, 60)])  # 10 of 70 words repeat: under the limit of 20 %, above 10 %
    often = lambda k: " ".join([words(k, 6)] * 6)
    near = {"few": (lambda k: words(k, 15), lambda k: words(k, 4)), "rep": (twice, often), "sym": (lambda k: words(k, 40) + " ########", lambda k: words(k, 12) + " ####################"), "wor": (lambda k: "longwordlongword" * 1 + " " + " ".join(f"longwordlongword{k}{j}" for j in range(30)), lambda k: " ".join(f"{'overlongword' * 3}{k}{j}" for j in range(30)))}
    rows, i = [], 0
    for name, (edge, bad) in near.items():
        for k in range(205):
            text = edge(k) if k < 5 else words(k, 40) if k < 10 else bad(k)
            rows.append((i, text, f"bad-{name}", k < 10, k < 5))
            rows.append((i + 1, edge(k) if k < 5 else words(k, 40), f"fine-{name}", True, False))
            i += 2
    out = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, source string")).collect()}
    for i, text, host, own, edge in rows:
        assert out[i].kept == (own and not edge), (host, text[:60])
        assert not (own and out[i].base_failed)
    import duckdb

    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", [r[:3] for r in rows])
    assert {r[0]: r[-1] for r in con.execute(quality_rules.ORACLES["op1_quality_rules"]).fetchall()} == {i: r.kept for i, r in out.items()}


def test_bits_are_trained_as_from_all_counts_at_once(spark):
    """The distributed sums give the weights that the definition gives, and the product of codewords and margins their losses."""
    rows = [(f"l{k % 9}", " ".join(random.Random(k).choice([f"w{k % 9}a", f"x{k % 9}", "the", f"q{k % 3}"]) for _ in range(60))) for k in range(90)]
    model = language_id.train(spark.createDataFrame(rows, "lang string, text string").repartition(5))
    langs = sorted({lang for lang, _ in rows})
    counts = np.array([sum(language_id.ngram_counts(t) for lang, t in rows if lang == name) for name in langs])
    share = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
    one = model.code > 0
    weights = np.log(share.T @ one / one.sum(axis=0)) - np.log(share.T @ ~one / (~one).sum(axis=0))
    spread = np.abs(share @ weights).mean(axis=0)
    assert model.langs == langs and np.allclose(model.weights, weights) and np.allclose(model.bit_weight, spread / spread.mean())
    texts = np.stack([language_id.ngram_counts(t) for _, t in rows]).astype(float)
    margin = np.clip(texts @ weights / np.sqrt(texts.sum(axis=1, keepdims=True)), -30, 30)
    loss = np.logaddexp(0, -margin[:, None, :] * model.code[None]) @ model.bit_weight
    best, score, _ = model.predict(texts)
    assert (best == loss.argmin(axis=1)).all()
    assert np.allclose(score, 1 / np.exp(loss.min(axis=1, keepdims=True) - loss).sum(axis=1))


def test_thousands_of_labels(spark):
    labels = 3000
    rows = [(k, f"{hashlib.md5(str(k).encode()).hexdigest().translate(str.maketrans('0123456789', 'ghijklmnop'))} " * 6, f"lang{k % labels}") for k in range(2 * labels)]
    out = language_id.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)).collect()
    known = [r for r in out if not r.held_out]
    assert sum(r.lang_pred == f"lang{r.doc_id % labels}" for r in known) > 0.95 * len(known)


def test_segments_are_dealt_by_bytes(spark, monkeypatch):
    """More text, more partitions, and the same result with one as with many."""
    rows = [(k, " ".join(random.Random(k % 7).choice(["alpha", "beta", "gamma", "delta", "epsilon"]) for _ in range(120))) for k in range(60)] + [(99, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(tuple(r) for r in suffix_dedup.repeated_bytes(docs).collect())
    assert suffix_dedup.partitions_for(docs) == 8 and suffix_dedup.partitions_for(docs.limit(0)) == 8
    monkeypatch.setattr(suffix_dedup, "PARTITION_BYTES", 1000)
    assert suffix_dedup.partitions_for(docs) == -(-sum(len(t or "") for _, t in rows) // 1000) > 30
    assert sorted(tuple(r) for r in suffix_dedup.repeated_bytes(docs).collect()) == want and sum(r[2] for r in want) > 0


def test_the_pipeline_deletes_what_later_stages_do_not_read(spark, sf):
    import corpus_pipeline
    from sheaf.llm import common

    other = common.written(spark.range(3), "other")
    before = common.mark(spark)
    out = corpus_pipeline.run(spark, sf)
    packing = common.mark(spark) - before  # the last stage's input, and what that stage wrote for its own result
    assert out.count() > 0 and other.count() == 3 and 1 <= packing <= 6
    assert common.release(spark, since=before) == packing and other.count() == 3
