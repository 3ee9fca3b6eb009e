"""Behaviour of the curation operators on small frames."""

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from sheaf.functions import text as tx
from sheaf.functions.vocabulary import SUBJECT_TAGS, alias_rows, alias_table, tag_table
from sheaf.operators import browse, chunks, compare, consensus, diagrams, merge, normalize, rules, state
from sheaf.sources import providers, readers

CANDIDATE = "paper string, provider string, rank int, number int, text string, options string, answer string, subject string"


def candidates(spark, *rows):
    """(provider, rank, number, text, answer)"""
    return spark.createDataFrame([("p", p, r, n, t, '["A","B","C","D"]', a, "physics") for p, r, n, t, a in rows], CANDIDATE)


def voted(spark, *rows):
    return {r.number: r for r in consensus.consensus(candidates(spark, *rows)).collect()}


def scalar(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


# Votes


def test_no_candidates(spark):
    assert voted(spark) == {}


def test_one_provider_passes_through(spark):
    out = voted(spark, ("gemini", 0, 1, "T", "2"))
    assert out[1].text == "T" and out[1].answer == "2" and out[1].confidence == "medium"


def test_three_agree(spark):
    out = voted(spark, *(("poolside", 0, 1, "T", "1"), ("zai", 1, 1, "T", "1"), ("gemini", 2, 1, "T", "1")))
    assert out[1].confidence == "high" and out[1].agreement == 1


def test_majority_of_answers(spark):
    out = voted(spark, ("gemini", 0, 1, "T", "0"), ("zai", 1, 1, "T", "1"), ("poolside", 2, 1, "T", "1"))
    assert out[1].answer == "1" and out[1].best_provider == "poolside"


def test_tie_takes_the_first(spark):
    out = voted(spark, ("gemini", 0, 1, "B", "1"), ("zai", 1, 1, "A", "0"))
    assert out[1].text == "B" and out[1].answer == "1"


def test_low_agreement_is_a_conflict(spark):
    v = consensus.consensus(candidates(spark, *[(p, k, 1, f"T{k}", str(k)) for k, p in enumerate(("poolside", "zai", "gemini"))]))
    assert [(r.number, r.reason) for r in consensus.conflicts(v).collect()] == [(1, "low_agreement")]


def test_two_of_four_is_no_conflict(spark):
    v = consensus.consensus(candidates(spark, ("poolside", 0, 1, "T", "1"), ("zai", 1, 1, "T", "1"), ("gemini", 2, 1, "U", "2"), ("vanchin", 3, 1, "V", "3")))
    assert consensus.conflicts(v).count() == 0


def test_gaps_are_reported(spark):
    v = consensus.consensus(candidates(spark, ("zai", 0, 1, "T", "1"), ("zai", 0, 4, "U", "1")))
    assert sorted(r.number for r in consensus.conflicts(v).collect()) == [2, 3]


def test_number_from_one_provider_only(spark):
    out = voted(spark, ("zai", 0, 1, "T", "1"), ("gemini", 1, 2, "U", ""))
    assert out[2].text == "U" and out[2].answer == "" and out[2].n_providers == 1


def test_numbers_below_one_go_and_the_first_of_a_provider_counts(spark):
    rows = candidates(spark, ("zai", 0, 0, "T", "1"), ("zai", 0, 1, "b", "1"), ("zai", 0, 1, "a", "2")).withColumn("pos", F.when(F.col("text") == "b", 0).otherwise(1))
    out = consensus.consensus(rows).collect()
    assert [(r.number, r.text, r.n_providers) for r in out] == [(1, "b", 1)]


def test_any_key_flag(spark):
    flags = spark.createDataFrame([("p", False), ("p", True), ("q", False)], "paper string, answer_key_found boolean")
    assert {r.paper: r.answer_key_found for r in consensus.answer_key_found(flags).collect()} == {"p": True, "q": False}


def test_votes_match_a_plain_count(spark):
    rng = random.Random(2)
    rows = [(p, k, n, rng.choice("ab"), rng.choice(["", "0", "1"])) for n in range(1, 60) for k, p in enumerate(("poolside", "zai", "gemini", "vanchin"))]
    out = voted(spark, *rows)
    for n in range(1, 60):
        texts = [r[3] for r in rows if r[2] == n]
        answers = [r[4] for r in rows if r[2] == n and r[4]]
        first = lambda v: max(v, key=lambda x: (v.count(x), -v.index(x))) if v else ""
        assert (out[n].text, out[n].answer) == (first(texts), first(answers))


# Merging


def rows_of(spark, *rows):
    """(number, chunk, answer, options, topic, full)"""
    return spark.createDataFrame([("p", n, c, k, a, o, t, f) for k, (n, c, a, o, t, f) in enumerate(rows)], "paper string, number int, chunk_index int, pos int, answer string, options string, topic string, full int")


@pytest.mark.parametrize(
    ("rows", "winner"),
    [
        ([(1, 0, "", "[]", "", 8), (1, 1, "2", "[]", "", 11)], 1),
        ([(1, 0, "1", "[]", "", 9), (1, 1, "2", "[]", "", 9)], 0),
        ([(1, 0, "", "[]", "", 9), (1, 1, "2", "[]", "", 9)], 1),
        ([(1, 0, "1", "[]", "", 9), (1, 1, "2", "[longer]", "", 9)], 1),
        ([(1, 0, "1", "[]", "", 9), (1, 1, "2", "[]", "waves", 9)], 1),
        ([(1, 0, "1", "[]", "", 11), (1, 1, "2", "[]", "waves", 9)], 0),
    ],
)
def test_better_row(spark, rows, winner):
    assert merge.merge_chunks(rows_of(spark, *rows)).first().chunk_index == winner


def test_fold_is_the_plain_loop(spark):
    rng = random.Random(4)
    rows = [(n, c, rng.choice(["", "1"]), "x" * rng.randint(0, 12), rng.choice(["", "t"]), rng.randint(5, 9)) for n in range(1, 80) for c in range(4)]

    def better(a, b):
        if abs(a[5] - b[5]) > 1:
            return a[5] > b[5]
        if bool(a[2]) != bool(b[2]):
            return bool(a[2])
        if abs(len(a[3]) - len(b[3])) > 5:
            return len(a[3]) > len(b[3])
        if bool(a[4]) != bool(b[4]):
            return bool(a[4])
        return a[1] <= b[1]

    expected = {}
    for r in rows:
        kept = expected.get(r[0])
        expected[r[0]] = r if kept is None or better(r, kept) else kept
    for parts in (1, 5):
        got = {r.number: r.chunk_index for r in merge.merge_chunks(rows_of(spark, *rows).repartition(parts)).collect()}
        assert got == {n: r[1] for n, r in expected.items()}


def test_completeness(spark):
    lit = lambda *v: [F.lit(x) for x in v]
    assert scalar(spark, merge.completeness(*lit("t", "s", "mcq", "1", 4, "waves", "a", 4.0))) == 14
    assert scalar(spark, merge.completeness(*lit("t", "", "mcq", "", 2, "", "", 0.0))) == 4


def test_backfill_takes_the_last_key_answer(spark):
    rows = rows_of(spark, (1, 0, "", "[]", "", 9), (1, 1, "2", "[]", "", 8), (1, 2, "3", "[]", "", 8), (2, 0, "1", "[]", "", 9)).withColumn("answer_key_found", F.col("chunk_index") > 0)
    out = {r.number: r.answer for r in merge.backfill(rows.where("chunk_index = 0"), merge.answer_key(rows)).collect()}
    assert out == {1: "3", 2: "1"}


def test_first_passage_of_each_id(spark):
    rows = spark.createDataFrame([("p", "a", "late", 1, 0), ("p", "a", "early", 0, 0), ("p", "b", "only", 1, 1)], "paper string, id string, text string, chunk_index int, pos int")
    assert {r.id: r.text for r in merge.first_passages(rows).collect()} == {"a": "early", "b": "only"}


@pytest.mark.parametrize(("a", "b", "low", "high"), [("the cat sat on mats", "the cat sat on mats", 1, 1), ("what force acts here now", "what force acts here then", 0.3, 0.99), ("alpha beta gamma", "delta epsilon zeta", 0, 0.4), ("", "words here", 0, 0)])
def test_similarity(spark, a, b, low, high):
    assert low <= scalar(spark, tx.jaccard(tx.word_set(F.lit(a)), tx.word_set(F.lit(b)))) <= high


def test_similar_pairs_are_all_found(spark):
    rng = random.Random(8)
    vocabulary = [f"word{k}" for k in range(40)]
    rows = []
    for k in range(150):
        words = rng.sample(vocabulary, rng.randint(3, 12)) if k % 3 else list(dict.fromkeys(rows[-1][1].split() + ["extra"] * (k % 2))) if rows else ["word1", "word2"]
        rows.append((k, " ".join(words)))
    sets = {}
    for k, t in rows:
        sets.setdefault(frozenset(t.split()), k)
    expected = {(min(i, j), max(i, j)) for (a, i), (b, j) in itertools.combinations(sets.items(), 2) if len(a & b) / len(a | b) >= 0.8}
    got = {(r.a, r.b) for r in merge.similar_pairs(spark.createDataFrame(rows, "id long, text string")).collect()}
    assert got == expected and expected


# Chunks


def chunk_sets(spark, n, size, overlap):
    pages = spark.createDataFrame([("p", k, n) for k in range(1, n + 1)], "paper string, page int, n_pages int")
    out = {}
    for r in chunks.page_chunks(pages, size, overlap).collect():
        out.setdefault(r.chunk_index, set()).add(r.page)
    return [sorted(out[k]) for k in sorted(out)]


def plain_chunks(n, size, overlap):
    if n <= size:
        return [list(range(1, n + 1))]
    out = []
    for at in itertools.count(0, size - overlap):
        out.append(list(range(at + 1, min(at + size, n) + 1)))
        if at + size >= n:
            return out


@pytest.mark.parametrize(("n", "size", "overlap"), [(3, 10, 3), (30, 10, 3), (25, 10, 3), (50, 15, 5), (15, 15, 5), (16, 15, 5), (100, 7, 6)])
def test_chunks(spark, n, size, overlap):
    assert chunk_sets(spark, n, size, overlap) == plain_chunks(n, size, overlap)


def test_overlap_must_be_smaller(spark):
    with pytest.raises(ValueError, match="overlap"):
        chunk_sets(spark, 30, 5, 5)


def test_key_pages_and_patterns(spark):
    grid = " ".join(f"{k}(2)" for k in range(1, 25))
    assert scalar(spark, tx.answer_key_score(F.lit("Answer Key"))) == 5
    assert scalar(spark, tx.answer_key_score(F.lit("Question No " + grid))) == 7
    assert scalar(spark, tx.answer_key_score(F.lit("nothing 1(2)"))) == 0
    for good in ("[Ans: 2]", "Key: 1-A", "| q | | ans |", "12 b\n", "3(4)", r"\answer{x}"):
        assert scalar(spark, tx.has_answer_key(F.lit(good))), good
    assert not scalar(spark, tx.has_answer_key(F.lit("no sign of it")))


# Topics, answers, texts, ids


@pytest.mark.parametrize(
    ("topic", "subject", "expected"),
    [("kinematics", "physics", "kinematics"), ("Kinematics ", "physics", "kinematics"), ("kineamtics", "physics", "kinematics"), ("orgnic chemistry", "chemistry", "organic-chemistry"), ("", "physics", "general-physics"), (None, "biology", "general-biology"), ("zzzz qqqq", "mathematics", "general-mathematics"), ("d-block", "chemistry", "d-block"), ("laws of thermodynamics", "physics", "thermodynamics")],
)
def test_topics(spark, topic, subject, expected):
    rows = spark.createDataFrame([(topic, subject)], "topic string, subject string")
    assert normalize.normalize_topics(rows, alias_table(spark), tag_table(spark)).first().topic_norm == expected


def test_published_aliases_give_their_topics(spark):
    rows = alias_rows()
    assert len(rows) == 244 and [n for *_, n in rows] == list(range(244))
    assert hashlib.sha256("\n".join(f"{a}={t}" for a, t, _ in rows).encode()).hexdigest() == "826444a1df2cbdefec4ee4e253d67ddc479b2bbc728c44922be3469194cfc063"  # as read from the published table
    subject = {t: s for s, tags in SUBJECT_TAGS.items() for t in tags}
    asked = spark.createDataFrame([(a, subject[t], t) for a, t, _ in rows] + [("Projectile gravity", "physics", "gravitation")], "topic string, subject string, expected string")
    wrong = normalize.normalize_topics(asked, alias_table(spark), tag_table(spark)).where("not topic_norm <=> expected")
    assert [tuple(r) for r in wrong.collect()] == []
    laws = spark.createDataFrame([("laws of thermodynamics", "physics")], "topic string, subject string")
    assert normalize.normalize_topics(laws, alias_table(spark), tag_table(spark), compat=True).first().topic_norm == "newtons-laws"


def test_blank_answers_take_the_first_of_several(spark):
    rows = [("7", "", ["b", "c"]), ("12.", None, ["4"]), ("101", "a", ["b"]), ("x", "", []), ("3", "", None)]
    q = spark.createDataFrame([(*r, ["A", "B", "C", "D"], "msq", None) for r in rows], "number string, answer string, answers array<string>, options array<string>, type string, section string")
    got = [(r.number, r.answer, r.answers, r.section) for r in normalize.normalize_answers(q).collect()]
    assert got == [(7, "1", None, "a"), (12, "3", None, "a"), (101, "0", ["b"], "b"), (None, "", [], None), (3, "", None, "a")]


def test_tags_have_no_duplicates_and_are_checked(spark):
    assert [len(v) for v in SUBJECT_TAGS.values()] == [32, 33, 29, 18]
    q = spark.createDataFrame([(1, "p", "x", "physics", ["Waves", "cooking"]), (2, "p", "y", "biology", ["waves"])], "pos int, paper string, id string, subject string, tags array<string>")
    assert sorted(r.message for r in rules.tag_flags(q, tag_table(spark)).collect()) == ["no tag of this subject: cooking", "no tag of this subject: waves"]


def test_latex(spark):
    lit = lambda s, **k: scalar(spark, tx.normalize_latex(F.lit(s), **k))
    assert lit(r"\frac{a}{b} \subseteq \text{abc} \sqrt{x}^{2}") == "a/b ⊆ abc √(x)^(2)"
    assert lit(r"\subseteq \text{abc}", compat=True) == r"⊂eq \textabc"
    once = lit(r"\alpha + {b} ﬁ")
    assert lit(once) == once == "α + b fi"


def test_options_are_repaired(spark):
    fix = lambda o: scalar(spark, tx.repair_options(F.array(*[F.lit(x) for x in o])))
    assert fix(["(1) alpha (2) beta", "plain"]) == ["(1) alpha", "(2) beta", "plain"]
    many = ["(1) aa (2) bb (3) cc (4) dd (5) ee (6) ff (1) gg"]
    assert fix(many) == many


def test_ids(spark):
    make = lambda *a: scalar(spark, tx.question_id(*[F.lit(x) for x in a]))
    assert make("jeemain", 2024, "22jan-shift1", "physics", 7) == "jeemain-2024-22jan-s1-ph-007"
    assert make("neet", 2024, "7", "biology", 1234) == "neet-2024-s7-bi-1234"
    assert make("jeeadv", 2023, "paper2", "art", 1) == "jeeadv-2023-p2-xx-001"

    def js(s):
        h = 0
        for c in s:
            h = (h * 31 + ord(c) + 2**31) % 2**32 - 2**31
        n, out = abs(h), ""
        while n:
            n, d = divmod(n, 36)
            out = "0123456789abcdefghijklmnopqrstuvwxyz"[d] + out
        return out[:8]

    for s in ("a-very-long-name-indeed", "zzzzzzzzzzzzzzzzzzzzzzzz"):
        assert scalar(spark, tx.short_shift(F.lit(s))) == js(s)


def test_tombstones(spark):
    q = spark.createDataFrame([("e", 2024, "1", "physics", 1), ("e", 2024, "1", "physics", 2)], "exam string, year int, shift string, subject string, pos int")
    dead = spark.createDataFrame([("e-2024-s1-ph-001",), ("e-2024-s1-ph-001-r1",)], "id string")
    assert sorted(r.id for r in normalize.assign_ids(q, dead).collect()) == ["e-2024-s1-ph-001-r2", "e-2024-s1-ph-002"]


def test_checksums_follow_content_not_order(spark):
    q = spark.createDataFrame([("e", 1, "s", k, f"t{k}") for k in range(20)], "exam string, year int, shift string, pos int, text string")
    sum_of = lambda d: normalize.content_checksum(d).first().content_checksum
    assert sum_of(q) == sum_of(q.repartition(5)) != sum_of(q.withColumn("text", F.concat("text", F.lit("!"))))


# Rules


GOOD = {"pos": 1, "paper": "p", "id": "a-1", "number": 1, "subject": "physics", "type": "mcq", "text": "What is it?", "options": ["a", "b", "c", "d"], "answer": "0", "answers": None, "marks": 4.0, "negative_marks": -1.0, "has_diagram": False, "diagram_file": None, "difficulty": None, "source": "official-pdf", "confidence": None, "revision": 1, "solution": None, "solution_format": None, "number_label": None, "precision_type": None, "tags": []}
SCHEMA = "pos int, paper string, id string, number int, subject string, type string, text string, options array<string>, answer string, answers array<string>, marks double, negative_marks double, has_diagram boolean, diagram_file string, difficulty string, source string, confidence string, revision int, solution string, solution_format string, number_label string, precision_type string, tags array<string>"


@pytest.mark.parametrize(
    ("change", "expected"),
    [
        ({}, []),
        ({"id": ""}, ["01"]),
        ({"number": 0}, ["03"]),
        ({"text": " "}, ["06"]),
        ({"text": "see [IMAGE] of it"}, ["07a"]),
        ({"options": ["a", "b"]}, ["08a", "26mcq1"]),
        ({"options": ["a", "a", "b"]}, ["08b"]),
        ({"answer": "9"}, ["26mcq4"]),
        ({"negative_marks": 0.0}, ["26mcq5"]),
        ({"type": "nat", "options": None, "negative_marks": 0.0, "answer": "1.5"}, []),
        ({"type": "nat", "options": None, "negative_marks": 0.0, "answer": "x"}, ["10c", "26nat2"]),
        ({"type": "msq", "answer": "", "answers": ["2", "0"]}, ["26msq4"]),
        ({"type": "assertion-reason", "options": None, "answer": "7"}, ["11b", "26ar2"]),
        ({"text": "a <b>bold</b> word"}, ["24a"]),
        ({"text": "bad \x01 text"}, ["25"]),
        ({"source": "imported-kaggle"}, ["19b"]),
        ({"revision": 0}, ["20"]),
        ({"has_diagram": True}, ["13a"]),
    ],
)
def test_rules(spark, change, expected):
    df = spark.createDataFrame([tuple({**GOOD, **change}.values())], SCHEMA)
    assert sorted(r.rule for r in rules.row_flags(df).collect()) == expected


def test_the_rules_are_one_projection(spark):
    df = spark.createDataFrame([tuple(GOOD.values())], SCHEMA)
    plan = rules.row_flags(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_extraction_errors(spark):
    rows = spark.createDataFrame([("p", k, "mcq", "t" if k else " ", ["a"] * (4 if k != 1 else 2), "" if k == 2 else "1") for k in range(3)], "paper string, number int, type string, text string, options array<string>, answer string")
    out = sorted((r.number if r.number is not None else -1, r.error) for r in rules.extraction_errors(rows, 90).collect())
    assert out == [(-1, "wrong_question_count"), (0, "missing_field"), (1, "invalid_option_count"), (2, "missing_answer")]


# Comparison, state, sources


def test_diff_and_report(spark):
    a = spark.createDataFrame([("p", 0, "T", "1"), ("p", 1, "<U>", "2")], "paper string, place int, text string, answer string")
    b = spark.createDataFrame([("p", 0, "T ", "1"), ("p", 1, "V", "2"), ("p", 2, "W", "3")], a.schema)
    d = compare.positional_diff(a, b, ("text", "answer"))
    assert sorted((r.place, r.status, r.fields) for r in d.collect()) == [(0, "match", ""), (1, "diff", "text"), (2, "missing-a", "")]
    s = compare.diff_summary(d).first()
    assert (s.matched, s.differing, s.missing_a, s.auto_acceptable) == (1, 1, 1, False)
    assert compare.html_rows(d).count() == 2


def test_query_parameters():
    q = browse.QuestionQuery.parse("?limit=9999&offset=3&topic=a,b&order=desc&sort=number")
    assert (q.limit, q.offset, q.topics, q.descending) == (500, 3, ("a", "b"), True)
    assert browse.QuestionQuery.parse("limit=0").limit == 100


def test_filters_reach_the_scan(spark, sf):
    lines = spark.read.parquet(f"{sf}/part.parquet").withColumnRenamed("p_type", "type")
    plan = browse.filter_questions(lines, browse.QuestionQuery(type="ECONOMY")).select("p_partkey")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(p_type,ECONOMY)" in plan and "p_name" not in plan


def test_resume(spark):
    rows = [("a", "ocr", "completed"), ("a", "extract", "failed"), ("b", "ocr", "pending"), *[("c", s, "completed") for s in ("ocr", "extract", "diagrams", "validate", "export")]]
    out = {r.key: (r.resume_stage, r.previous_stage) for r in state.resume_points(spark.createDataFrame(rows, "key string, stage string, status string")).collect()}
    assert out == {"a": ("extract", "ocr"), "b": ("ocr", None), "c": (None, None)}


def test_rate_window_is_open_on_the_left(spark):
    rows = spark.sql("select 'p' as provider, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s) as ts, s as seq from values (0), (30), (60), (61) as t(s)")
    assert [r.in_window for r in state.rate_window(rows, 2).orderBy("seq").collect()] == [1, 2, 2, 3]


@pytest.mark.parametrize(
    ("name", "expected"),
    [("jee-main-2024-22-jan-shift-1.pdf", ("jeemain", 2024, "22jan-s1")), ("NEET_2023_Code_E3.pdf", ("neet", 2023, "e3")), ("JEE Advanced 2022 Paper 2.pdf", ("jeeadv", 2022, "p2")), ("ncert-exemplar-11-physics.pdf", ("ncert-exemplar", 11, "")), ("neet 2024 re-exam.pdf", ("neet", 2024, "reexam")), ("paper 2021 5 april shift 2.pdf", ("jeemain", 2021, "05apr-s2")), ("notes.pdf", None)],
)
def test_file_names(spark, name, expected):
    m = scalar(spark, readers.parse_filename(F.lit(name)))
    assert (None if m is None else (m.exam, m.year, m.shift)) == expected


def test_responses(spark):
    rows = spark.createDataFrame([("a", '```json\n[{"number":1,"answer":"2"}]\n```', True), ("b", '{"questions":[{"number":3,"answer":"1"}]}', False), ("c", "sorry", True)], "key string, raw string, key_found boolean")
    assert sorted((r.key, r.number, r.answer) for r in readers.parse_responses(rows).collect()) == [("a", 1, "2"), ("b", 3, "")]


def test_papers_are_read_and_written(spark, tmp_path):
    import json

    base = tmp_path / "data/jeemain/2024/22jan-s1"
    base.mkdir(parents=True)
    paper = {"exam": "jeemain", "year": 2024, "shift": "22jan-s1", "total": 2, "questions": [{"id": f"q{k}", "number": k, "subject": s, "text": "T"} for k, s in ((5, "physics"), (9, "biology"))], "passages": [{"id": "p1", "text": "x"}]}
    (base / "paper.json").write_text(json.dumps(paper, indent=1))
    (tmp_path / "data/paper.json").write_text("{broken")
    papers = readers.read_papers(spark, str(tmp_path / "data"))
    q = readers.questions_of(papers)
    assert sorted((r.paper, r.pos, r.id) for r in q.collect()) == [("jeemain/2024/22jan-s1", 0, "q5"), ("jeemain/2024/22jan-s1", 1, "q9")]
    assert readers.passages_of(papers).count() == 1 and readers.rebuild_index(papers).first().key == "jeemain/2024/22jan-s1"
    readers.write_papers(q, str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out"))
    assert sorted((r.subject, r.number) for r in back.collect()) == [("biology", 1), ("physics", 1)]


def test_archives(spark, tmp_path):
    import io
    import json
    import zipfile

    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("x_content_list_v2.json", json.dumps([[{"type": "text", "text": "Hi", "text_level": 1, "page_idx": 0}], [{"type": "equation", "text": "x", "page_idx": 0}]]))
        z.writestr("full.md", "# Hi ![a](images/i.png)")
    files = spark.createDataFrame([("a.zip", raw.getvalue()), ("b.zip", b"no zip")], "path string, content binary")
    members = readers.unzipped(files).cache()
    assert members.where("error is not null").count() == 1
    assert chunks.pages_from_content(readers.content_items(members)).first().markdown == "# Hi\n\n$$x$$"
    images = spark.createDataFrame([("a.zip", "i.png", b"\x01\x02")], "paper string, name string, content binary")
    text = members.where("name = 'full.md'").select(F.col("path").alias("paper"), F.decode("content", "UTF-8").alias("markdown"))
    assert readers.embedded_images(text, images).first().markdown == "# Hi ![a](data:image/png;base64,AQI=)"


def test_providers(spark):
    class Flaky:
        name = "flaky"

        def call(self, prompt):
            if prompt == "bad":
                raise RuntimeError("no")
            return prompt.upper()

    prompts = spark.createDataFrame([("1", "ok"), ("2", "bad")], "key string, prompt string")
    out = {r.key: (r.raw, r.ok, r.error) for r in providers.answers(prompts, Flaky(), attempts=2).collect()}
    assert out == {"1": ("OK", True, None), "2": (None, False, "no")}
    recording = prompts.where("key = '1'").select(F.lit("zai").alias("provider"), F.sha2("prompt", 256).alias("prompt_sha"), F.lit("[]").alias("raw"))
    got = {r.key: r.ok for r in providers.Recorded(recording).answers(prompts.withColumn("provider", F.lit("zai"))).collect()}
    assert got == {"1": True, "2": False}


def test_annotations(spark):
    rows = spark.createDataFrame([("p", '{"questions":[{"text":"T","has_diagram":true}],"answer_key_found":true}', "{}"), ("q", "bad", '{"images":[{"type":"answer_key"}]}'), ("r", None, None)], "paper string, annotation string, boxes string")
    assert [(r.paper, r.number, r.has_diagram) for r in readers.annotation_rows(rows).collect()] == [("p", 1, True)]
    assert {r.paper: r.answer_key_found for r in providers.enhanced_flags(rows).collect()} == {"p": True, "q": True, "r": False}


def test_diagram_options(spark):
    q = spark.createDataFrame([("p", 1, True, [], 0)], "paper string, number int, has_diagram boolean, options array<string>, pos int")
    notes = spark.createDataFrame([("p", "i2", "figure", "A) one; B) two; C) three; D) four", 1), ("p", "i1", "logo", "x", 1)], "paper string, image_id string, type string, description string, relates_to int")
    assert diagrams.filled_options(diagrams.annotated(q, notes)).first().options == ["one", "two", "three", "four"]


def test_the_package_stands_without_the_corpus_operators():
    from pathlib import Path

    root = Path(__file__).resolve().parents[1] / "sheaf"
    for f in root.rglob("*.py"):
        if "llm" not in f.parts:
            assert "sheaf.llm" not in f.read_text()


def test_gates_of_answer_key_patterns_lose_nothing(spark):
    """What a pattern needs is in every text that it matches: with and without the gates the same texts have a key."""
    from sheaf.functions.vocabulary import ANSWER_KEY_NEEDS, ANSWER_KEY_PATTERNS

    rng = random.Random(11)
    bits = ["answer", "ANS", "Ans.", "key", "KEY", "correct", "question", "Q", "q.", "no", "table", "to", "s", "solution", ":", " ", "|", "\n", "1", "12", "a", "B", "-", "–", "(", ")", ".", "[", "]", "\\", "{", "}", "K", "ſ", "٣"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 14))) for _ in range(6000)]
    whole = ["|q||ans|", "Q no | x | ANS", "q.|a|ans", r"\Answer{", r"\correct ", r"x \KEY.", "\n 12 b\n", "1. A 2. B", "3-d", "4 ( 2 )", "ans 7 )", "[ans.] : 4", "(answer) - 3", "answer table", "key to questions", "solution  key", "question no", "correct answer"]
    texts += [a + w + b for w in whole for a in ("", "x", "K ") for b in ("", "y", " 5")]
    rows = spark.createDataFrame([(t,) for t in [*texts, None, ""]], "t string")
    for patterns in (ANSWER_KEY_PATTERNS, *[[p] for p in ANSWER_KEY_PATTERNS]):
        plain = F.lit(False)
        for p in patterns:
            plain = plain | F.coalesce(F.col("t").rlike(p), F.lit(False))
        n, wrong = rows.select(F.count_if(plain), F.count_if(plain != tx.has_answer_key("t", patterns))).first()
        assert wrong == 0 and n > 0, patterns
    assert len(ANSWER_KEY_NEEDS) == len(ANSWER_KEY_PATTERNS)


def test_trimming_takes_all_spaces_and_no_others(spark):
    spaces = "\t\n\x0b\x0c\r \u00a0\u1680\u2003\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
    rows = [(f"{c}{d}a{c}b{d}{c}", f"a{c}b") for c in spaces for d in spaces] + [(f"{c}a{c}", f"{c}a{c}") for c in "\u0085\u200b\u180e\x00"] + [("a \x85", "a \x85"), (spaces, ""), ("", ""), (None, None)]
    got = spark.createDataFrame(rows, "t string, want string").where(~tx.wide_trim("t").eqNullSafe(F.col("want"))).collect()
    assert got == []
