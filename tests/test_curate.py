"""Topics by the published cases, repair, review edits, documents, listings, stage tables, similarity by vectors."""

import hashlib
import json
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheaf.functions import text as tx
from sheaf.functions.vocabulary import alias_table, tag_table
from sheaf.operators import consensus, curate, listing, merge, normalize, rules, similar
from sheaf.operators.stages import Metrics, StageCache, saved
from sheaf.plans import more
from sheaf.sources import providers, readers

TOPICS = [
    ("kinematics", "physics", "kinematics"), ("motion", "physics", "kinematics"), ("organic chemistry", "chemistry", "organic-chemistry"), ("nlm", "physics", "newtons-laws"), ("Kinematics", "physics", "kinematics"),
    ("ORGANIC Chemistry", "chemistry", "organic-chemistry"), ("kineamtics", "physics", "kinematics"), ("orgnic", "chemistry", "organic-chemistry"), ("probablity", "mathematics", "probability"), ("completely-unknown-topic", "physics", "general-physics"),
    ("  kinematics  ", "physics", "kinematics"), (None, "physics", "general-physics"), ("", "chemistry", "general-chemistry"), ("   ", "mathematics", "general-mathematics"), ("organic", "chemistry", "organic-chemistry"), ("quantum-computing", "physics", "general-physics"), ("kinemtics", "physics", "kinematics"),
]


def test_published_topic_cases(spark):
    rows = spark.createDataFrame(TOPICS, "topic string, subject string, expected string")
    got = normalize.normalize_topics(rows, alias_table(spark), tag_table(spark)).where("not topic_norm <=> expected").collect()
    assert [(r.topic, r.topic_norm) for r in got] == []


QUESTION = "paper string, exam string, pos int, number int, type string, text string, options array<string>, answer string"


def question(number, answer="0", options=("a", "b", "c", "d"), text="What is it?", kind="mcq", paper="p", exam="ncert-exemplar", pos=None):
    return (paper, exam, number if pos is None else pos, number, kind, text, None if options is None else list(options), answer)


def plain_repair(rows, key, again, expected, pages=True):
    """One round of repairs on one paper, error by error."""
    errors = []
    if expected and abs(len(rows) - expected) > 5:
        errors.append((None, "wrong_question_count"))
    for r in rows:
        if not r[7]:
            errors.append((r[3], "missing_answer"))
        if r[4] == "mcq" and not (r[6] and 3 <= len(r[6]) <= 5):
            errors.append((r[3], "invalid_option_count"))
        if not (r[5] or "").strip():
            errors.append((r[3], "missing_field"))
    working, left = [list(r) for r in rows], []
    for number, error in errors:
        first = next((w for w in working if w[3] == number), None)
        if error == "wrong_question_count" and len(again) > len(rows):
            working = [list(r) for r in again]
        elif error == "missing_answer" and key:
            for n, a in key:
                found = next((w for w in working if w[3] == n), None)
                if found and a:
                    found[7] = a
        elif error == "invalid_option_count" and first and first[6] and "(1)" in " ".join(first[6]):
            first[6] = [x.strip() for o in first[6] for x in o.replace("(2)", "\n(2)").split("\n")]
        else:
            left.append((number, error))
    return [tuple(w) for w in working], left


def test_repair_is_the_plain_loop(spark):
    rng = random.Random(6)
    papers = {}
    for k in range(12):
        exam = ["jeeadv", "ncert-exemplar"][k % 2]
        rows = [question(n, rng.choice(["", "1", "2"]), rng.choice([("a", "b", "c"), ("(1) red one (2) blue one", "(1) x"), None, ("only",)]), rng.choice(["text", " "]), rng.choice(["mcq", "nat"]), f"p{k}", exam, i) for i, n in enumerate([1, 2, 3, 3, 4, 7][: rng.randint(1, 6)])]
        key = [(n, rng.choice(["", "k1", "k2"])) for n in rng.choices([1, 2, 3, 9], k=rng.randint(0, 4))]
        again = [question(n, rng.choice(["", "9"]), paper=f"p{k}", exam=exam, pos=100 + n) for n in range(1, rng.randint(1, 9))]
        papers[f"p{k}"] = (rows, key, again, {"jeeadv": 54}.get(exam, 0))
    frame = lambda x: spark.createDataFrame(x, QUESTION)
    key = [(p, i, n, a) for p, (_, k, _, _) in papers.items() for i, (n, a) in enumerate(k)]
    out, left = curate.auto_repair(frame([r for rows, *_ in papers.values() for r in rows]), spark.createDataFrame(key, "paper string, pos int, number int, answer string"), frame([r for _, _, again, _ in papers.values() for r in again]))
    got, errors = {}, {}
    for r in out.collect():
        got.setdefault(r.paper, []).append((r.pos, r.number, r.options and len(r.options), r.answer))
    for r in left.collect():
        errors.setdefault(r.paper, []).append((r.number, r.error))
    for p, (rows, k, again, expected) in papers.items():
        good, rest = plain_repair(rows, k, again, expected)
        assert sorted((r[2], r[3], r[7]) for r in good) == sorted((a, b, d) for a, b, _, d in got[p]), p
        assert {x for x in rest if x[1] != "invalid_option_count"} == {x for x in errors.get(p, []) if x[1] != "invalid_option_count"}, p


def test_edits_and_fixes(spark):
    q = spark.createDataFrame([("p", 1, "a", "0", 4.0), ("p", 2, "b", "1", 4.0), (None, 1, "c", None, 4.0)], "paper string, number int, text string, answer string, marks double")
    edits = spark.createDataFrame([("p", 1, 1, "text", "first"), ("p", 1, 2, "text", "last"), ("p", 2, 3, "answer", None), (None, 1, 4, "answer", "3"), ("p", 9, 5, "text", "lost"), ("p", 2, 6, "marks", "9")], "paper string, number int, seq int, field string, value string")
    assert sorted(map(str, ((r.number, r.text, r.answer, r.marks) for r in curate.applied_edits(q, edits).collect()))) == sorted(map(str, [(1, "last", "0", 4.0), (2, "b", None, 4.0), (1, "c", "3", 4.0)]))
    assert curate.applied_edits(q, edits.limit(0)).count() == 3 and curate.applied_edits(q.limit(0), edits).count() == 0


@pytest.fixture
def paper_rows(spark):
    rows = [("jeemain", 2024, "22jan-s1", s, k, k + 1, f"Text {k}", "0", ["a", "b", "c", str(k)]) for k, s in enumerate(["physics", "physics", "chemistry", "physics", "chemistry"])]
    rows.append(("ncert-exemplar", 11, None, "biology", 0, 1, "é\nnew", None, None))
    schema = "exam string, year int, shift string, subject string, pos int, number int, text string, answer string, options array<string>"
    headers = spark.createDataFrame([("jeemain", 2024, "22jan-s1", True)], "exam string, year int, shift string, answerKeyFound boolean")
    return spark.createDataFrame(rows, schema), headers


def test_documents_are_written_and_read_again(spark, paper_rows, tmp_path):
    q, headers = paper_rows
    docs = curate.paper_documents(q, headers)
    got = {r.path: r for r in docs.collect()}
    assert set(got) == {f"jeemain/2024/22jan-s1/{d}.json" for d in ("paper", "physics", "chemistry")} | {f"ncert-exemplar/class-11/{d}.json" for d in ("paper", "biology")}
    physics = got["jeemain/2024/22jan-s1/physics.json"]
    assert [x.number for x in physics.questions] == [1, 2, 3] and [x.pos for x in physics.questions] == [0, 1, 3] and physics.total == 3
    assert [x.number for x in got["jeemain/2024/22jan-s1/paper.json"].questions] == [1, 2, 3, 4, 5] and len({r.checksum for r in got.values()}) == 5
    sizes = {r.path: r.bytes for r in curate.write_documents(docs, f"file://{tmp_path}/data").collect()}
    for path, size in sizes.items():
        raw = (Path(tmp_path) / "data" / path).read_bytes()
        body = json.loads(raw)
        assert len(raw) == size and body["schema"] == "v4" and body["total"] == len(body["questions"]) and body["checksum"] == got[path].checksum and body["provenance"]["license"]
    read = {(r.exam, r.total, r.answerKeyFound): r for r in readers.read_papers(spark, f"file://{tmp_path}/data").collect()}
    assert set(read) == {("jeemain", 5, True), ("ncert-exemplar", 1, None)}
    assert [x.options for x in read[("jeemain", 5, True)].questions] == [["a", "b", "c", str(k)] for k in range(5)]


def test_checksums_see_every_value(spark, paper_rows):
    q, headers = paper_rows
    sums = lambda d, h=headers: {r.path: r.checksum for r in curate.paper_documents(d, h).select("path", "checksum").collect()}
    base, paper = sums(q), "jeemain/2024/22jan-s1/paper.json"
    assert sums(q.orderBy(F.desc("pos"))) == base
    for change in (("text", F.lit("x")), ("answer", F.lit(None).cast("string")), ("answer", F.lit("")), ("options", F.array(F.lit("a,b")))):
        changed = q.withColumn(change[0], F.when(F.col("pos") == 3, change[1]).otherwise(F.col(change[0])))
        assert sums(changed)[paper] != base[paper]
    assert sums(q, headers.withColumn("answerKeyFound", F.lit(False)))[paper] != base[paper]


def test_golden_paper_through_the_run(spark):
    """Three agreeing extractors of ten questions: everything arrives, valid, in order, without errors."""
    texts = [("physics", "kinematics", "A body moves with  speed \\alpha"), ("chemistry", "orgnic", "Which compound is formed"), ("mathematics", "probablity", "Two dice are thrown")]
    rows = [{"number": n, "text": f"{texts[n % 3][2]} in case {n}?", "options": [f"{n}", f"{n}1", f"{n}2", f"{n}3"], "answer": "ABCD"[n % 4], "subject": texts[n % 3][0], "type": "mcq", "marks": 4.0, "topic": texts[n % 3][1]} for n in range(1, 11)]
    raw = [("ncert-exemplar/2024/s1", p, i, body, True) for i, (p, body) in enumerate((("poolside", json.dumps(rows)), ("longcat-lite", f"```json\n{json.dumps(rows)}\n```"), ("nvidia-qwen", json.dumps({"questions": rows}))))]
    frame = spark.createDataFrame(raw, "key string, provider string, rank int, raw string, key_found boolean")
    headers = spark.createDataFrame([("ncert-exemplar", 2024, "s1", True)], "exam string, year int, shift string, answerKeyFound boolean")
    docs, flags, left = curate.curate(frame, headers, alias_table(spark), tag_table(spark))
    assert left.collect() == [] and flags.where("severity = 'error'").collect() == []
    paper = docs.where("document = 'paper'").first()
    assert [q.number for q in paper.questions] == list(range(1, 11)) and [q.answer for q in paper.questions] == [str(n % 4) for n in range(1, 11)]
    assert {q.topic for q in paper.questions} == {"kinematics", "organic-chemistry", "probability"} and "α" in paper.questions[2].text and len({q.id for q in paper.questions}) == 10
    assert sorted(r.total for r in docs.where("document <> 'paper'").collect()) == [3, 3, 4]


def test_listings():
    state, seen = ("name", "asc"), []
    for _ in range(5):
        seen.append(state)
        state = listing.next_order(*state)
    assert seen == [*listing.FILE_ORDERS, listing.FILE_ORDERS[0]] and listing.next_order("date", "asc") == listing.FILE_ORDERS[0]
    with pytest.raises(ValueError, match="order"):
        listing.files(None, "date")


def test_holes_of_any_width(spark, monkeypatch):
    rows = spark.createDataFrame([("p", 3), ("p", 60), ("p", 61), ("q", 1)], "paper string, number int")
    monkeypatch.setattr(consensus, "GAP_RUN", 4)
    got = sorted((r.paper, r.number) for r in consensus.gaps(rows).collect())
    assert got == [("p", n) for n in (1, 2, *range(4, 60))]


def test_a_misread_number_makes_no_array_beyond_bounds(spark):
    rows = spark.createDataFrame([("p", 1), ("p", 2_000_000_000)], "paper string, number int")
    assert consensus.gaps(rows).limit(5).count() == 5


def test_stage_tables_and_metrics(spark, tmp_path):
    cache = StageCache(spark, f"file://{tmp_path}/cache")
    assert cache.load("a/1", "ocr") is None
    one = cache.save("a/1", "ocr", spark.range(3))
    two = cache.save("a/1", "ocr", one.where("id > 0"))  # made from what it replaces
    assert sorted(r.id for r in two.collect()) == [1, 2] and cache.load("a/1", "extract") is None
    metrics = Metrics(spark, f"file://{tmp_path}/metrics")
    assert metrics.read().count() == 0
    row = spark.createDataFrame([("k", "2024-01-01", 3, 90.0, 80.0, 70.0, 60.0, 1)], "key string, date string, total int, text_accuracy double, answer_accuracy double, topic_accuracy double, options_accuracy double, errors int")
    metrics.append(row)
    metrics.append(row.withColumn("date", F.lit("2024-01-02")))
    assert sorted(r.date for r in metrics.read().collect()) == ["2024-01-01", "2024-01-02"]
    assert saved(spark.range(4), "x").count() == 4


def test_similar_questions_are_all_found(spark, monkeypatch):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(60, 4))
    rows = [(f"p{k % 2}", k, k % 9, [float(x) for x in v[k]]) for k in range(60)]
    monkeypatch.setattr(similar, "BLOCK", 7)
    got = {(r.paper, r.a, r.b) for r in similar.similar_questions(spark.createDataFrame(rows, "paper string, id long, number int, embedding array<double>"), 0.6).collect()}
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    assert got == {(f"p{a % 2}", a, b) for a in range(60) for b in range(a + 1, 60) if a % 2 == b % 2 and a % 9 != b % 9 and unit[a] @ unit[b] >= 0.6}


def test_embedding_cache(spark):
    rows = spark.createDataFrame([(1, " One "), (2, "one"), (3, "two"), (4, "TWO ")], "id long, text string")
    cache = spark.createDataFrame([("one", [1.0])], "key string, embedding array<double>")
    found, missing = similar.embedded(rows, cache)
    assert sorted(r.id for r in found.collect()) == [1, 2] and [r.key for r in missing.collect()] == ["two"]


def test_similar_pairs_with_frequent_words(spark, monkeypatch):
    rng = random.Random(2)
    common = [f"common{k}" for k in range(6)]
    texts = [" ".join(rng.sample(common, 5) + rng.sample([f"word{k}" for k in range(30)], 6)) for _ in range(150)]
    texts += [t + " added" for t in texts[:20]]
    sets = [set(t.split()) for t in texts]
    expected = {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if sets[a] != sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.7}
    monkeypatch.setattr(merge, "FREQUENT", 20)
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    first = {}
    for k, s in enumerate(sets):
        first.setdefault(frozenset(s), k)
    expected = {(a, b) for a, b in expected if first[frozenset(sets[a])] == a and first[frozenset(sets[b])] == b}
    for most in (500_000, 0):
        monkeypatch.setattr(merge, "MOST_BROADCAST", most)
        assert {(r.a, r.b) for r in merge.similar_pairs(frame, 0.7).collect()} == expected


def test_similar_pairs_travel_without_their_words(spark, monkeypatch):
    """A group of near copies has many more pairs than sets: words are shuffled for the sets, not for the pairs."""
    rng = random.Random(4)
    common = [f"common{k}" for k in range(300)]
    texts = [" ".join(rng.sample(common, 290) + [f"own{k}x{i}" for i in range(10)]) for k in range(150)]
    sets = [set(t.split()) for t in texts]
    expected = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in range(150) for b in range(a + 1, 150)}
    expected = {p: s for p, s in expected.items() if s >= 0.8}
    shuffled = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(False).head().totalShuffleWrite()
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    before = shuffled()
    assert {(r.a, r.b): r.similarity for r in merge.similar_pairs(frame).collect()} == expected and len(expected) > 10_000
    assert shuffled() - before < 4_000_000  # 11,000 pairs with 300 words each were 30 MB and more
    for name, value in {"BLOCK": 40, "MOST_WORDS": 2000}.items():
        monkeypatch.setattr(merge, name, value, raising=False)
    assert {(r.a, r.b): r.similarity for r in merge.similar_pairs(frame).collect()} == expected


def test_chosen_names_and_kinds(spark):
    names = {"neet-2024-code-r5.pdf": ("neet", 2024, "code-r5"), "JEEMAIN_2023_24-January-Shift-1.pdf": ("jeemain", 2023, "24-jan-shift-1"), "jee-adv-2022-paper-1.pdf": ("jeeadv", 2022, "paper-1"), "ncert-exemplar-12-unit-3.pdf": ("ncert-exemplar", 12, "unit-3"), "notes.pdf": None}
    for name, expected in names.items():
        got = spark.range(1).select(readers.parse_chosen_name(F.lit(name)).alias("m")).first().m
        assert (tuple(got) if got else None) == expected, name
    kinds = {"neet 2024 answer key.pdf": "combined", "2024-solution.pdf": "answer-key", "2024.pdf": "question", "monkey.pdf": "question", "set-1.pdf": "question"}
    for name, kind in kinds.items():
        assert spark.range(1).select(readers.pdf_kind(F.lit(name)).alias("k")).first().k == kind, name


def test_rules_messages_are_given(spark):
    assert all(r.message for r in rules.RULES) and spark.range(1).select(tx.image_bytes(F.lit("data:image/png;base64,aGk=")).alias("b")).first().b == b"hi"


def test_files_reports_and_hashes(spark, tmp_path):
    rows = spark.createDataFrame([("p", 2, "<tr>2</tr>"), ("p", 1, "<tr>1</tr>")], "paper string, place int, html string")
    folder = f"file://{tmp_path}/out"
    assert [r.path for r in curate.write_files(curate.reports(rows), folder).collect()] == ["p/report.html"]
    text = (tmp_path / "out" / "p" / "report.html").read_text()
    assert text.index("<tr>1") < text.index("<tr>2") and text.startswith("<!doctype html>")
    images = spark.createDataFrame([("physics/q001-a.png", bytearray(b"\x89PNG"))], "path string, content binary")
    assert [(r.path, r.bytes) for r in curate.write_files(images, folder).collect()] == [("physics/q001-a.png", 4)]
    hashes = {Path(r.path).name: r.computed for r in curate.hashed_files(spark, folder).collect()}
    assert hashes["q001-a.png"] == hashlib.sha256(b"\x89PNG").hexdigest() and len(hashes) == 2


def test_ocr_by_service_name(spark):
    pages = spark.createDataFrame([("a", 0, "x")], "paper string, index int, markdown string")
    items = spark.createDataFrame([("a", 0, 0, "text", "x", 0, None, None, None)], "paper string, page_idx int, pos int, type string, text string, text_level int, img_path string, caption string, table_body string")
    for name, rows in (("mistral", pages), ("mineru", items)):
        assert [tuple(r) for r in providers.pages_by(name, rows).collect()] == [("a", 1, "x")]
    with pytest.raises(ValueError, match="service"):
        providers.pages_by("other", pages)


def test_repair_reaches_each_question_of_a_number(spark):
    """Answers and splits for two questions that share a number; a third row stands at the place of one that was split."""
    rows = [question(1, "", ("(1) red one (2) blue one", "(1) x"), "text", "mcq", "p", "jeeadv", 0), question(1, "", ("(1) red one (2) blue one", "(1) y"), "text", "mcq", "p", "jeeadv", 1), question(2, "", None, "text", "mcq", "p", "jeeadv", 1)]
    frame = spark.createDataFrame(rows, QUESTION)
    key = spark.createDataFrame([("p", 0, 1, "k")], "paper string, pos int, number int, answer string")
    for each, restored, errors in ((False, 1, {2}), (True, 2, set())):
        out, left = curate.auto_repair(frame, key, frame.limit(0), each=each)
        assert out.where("answer_restored and options_repaired and answer = 'k' and size(options) = 3").count() == restored and out.count() == 3
        assert {r.number for r in left.where("error = 'invalid_option_count'").collect()} == errors


def test_files_of_one_name_follow_by_the_order_given(spark):
    rows = spark.createDataFrame([("b", 7, 1), ("b", 3, 2), ("b", 9, 3), (None, 5, 4), ("a", None, 5)], "name string, size int, key int")
    for then, keys in ((F.asc("key"), [5, 1, 2, 3, 4]), (F.desc("key"), [5, 3, 2, 1, 4])):
        assert [r.key for r in listing.files(rows, "name", "asc", then).orderBy("place").collect()] == keys
    assert [r.key for r in listing.files(rows, "size", "asc").orderBy("place").collect()] == [2, 4, 1, 3, 5]


@pytest.mark.parametrize("part", [1, 2])
def test_documents_put_together_from_parts(spark, sf, monkeypatch, part):
    documents = lambda: sorted((r.asDict(recursive=True) for r in more._documents(spark, sf).collect()), key=lambda r: r["path"])
    whole = documents()
    assert max(r["total"] for r in whole) > part
    monkeypatch.setattr(curate, "PART", part)
    assert documents() == whole


def test_answers_of_long_papers_come_in_chunks(spark, tmp_path, monkeypatch):
    spark.range(1, 1000).selectExpr("id as p_partkey", "concat('part ', id) as p_name", "'Brand#1' as p_brand").write.parquet(f"{tmp_path}/part.parquet")
    seen = []
    monkeypatch.setattr(more.curate, "curate", lambda raw, *args, **named: seen.append(raw))
    more._run(spark, str(tmp_path))
    n = [r["n"] for r in readers.parse_responses(seen[0].withColumn("key", F.struct("key", "provider", "rank", F.xxhash64("raw")))).groupBy("key").agg(F.count("*").alias("n")).collect()]
    assert sum(n) == 999 * 3 and max(n) <= more.ANSWERED == 100
