"""Places, sessions, alias neighbourhoods, vector joins, keyed stream state: against plain versions, and by their plans."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from sheaf.operators import listing, places


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# places


def test_places_equal_a_window_over_all(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, "a", "b", "c"]), rng.choice([None, 1, 2, 3]), rng.randrange(5), k) for k in range(3000)]
    df = spark.createDataFrame(rows, "g string, x int, y int, id long").repartition(7)
    got = {r.id: r.place for r in places.numbered(df, F.desc("x"), F.asc("id")).collect()}
    want = sorted(rows, key=lambda r: (-(r[1] if r[1] is not None else -1), r[3]))
    assert got == {r[3]: k + 1 for k, r in enumerate(want)}
    within = {r.id: r.place for r in places.numbered(df, F.asc("y"), F.asc("id"), within=("g", "x")).collect()}
    seen = {}
    for g, x, _, i in sorted(rows, key=lambda r: (r[2], r[3])):
        seen[g, x] = seen.get((g, x), 0) + 1
        assert within[i] == seen[g, x]


def test_places_of_ties_repeats_and_no_rows(spark):
    rows = [(1, "same")] * 500 + [(1, f"t{k}") for k in range(500)]
    df = spark.createDataFrame(rows, "x int, t string")
    runs = [sorted((r.place, r.t) for r in places.numbered(df.repartition(n), F.asc("x")).collect()) for n in (1, 9)]
    assert runs[0] == runs[1] and [p for p, _ in runs[0]] == list(range(1, 1001))
    assert places.numbered(df.limit(0), F.asc("x")).collect() == []
    odd = spark.createDataFrame([(1, {"a": 1}), (2, None)], "`a b` int, m map<string, int>")
    assert [(r["a b"], r.place) for r in places.numbered(odd, F.desc("`a b`")).orderBy("place").collect()] == [(2, 1), (1, 2)]


def test_a_value_that_most_rows_have_is_spread(spark):
    rows = spark.range(20_000).withColumn("x", F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(7))
    held = places.numbered(rows, F.asc("x"))
    sizes = [r["count"] for r in held.groupBy(F.spark_partition_id()).count().collect()]
    assert held.agg(F.countDistinct("place"), F.max("place")).first() == (20_000, 20_000) and max(sizes) < 12_000


def test_listings_have_no_task_for_all_rows(spark):
    rows = spark.range(5000).selectExpr("concat('f', id) as name", "id % 17 as size", "id % 3 as exam", "id as year", "'s' as shift", "id as pos")
    for df in (listing.files(rows), listing.checkpoints(rows), listing.counts(rows, "size", "pos"), listing.cascade(rows)):
        assert not re.search(r"SinglePartition(?!, ENSURE_REQUIREMENTS, \[plan_id=\d+\]\s*\n.*Aggregate)", plan_of(df)), plan_of(df)
    assert [r.place for r in listing.files(rows).orderBy("place").limit(3).collect()] == [1, 2, 3]


# review sessions


def plain_replay(rows):
    """A loop over each reviewer's events; what it says of each."""
    out, sessions = [], {}
    for who, seq, kind, total in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2] is not None, r[2] or "", r[3] is not None, r[3] or 0)):
        s = sessions.get(who)  # [questions, cursor, active]
        action = refused = question = None
        if kind == "start":
            if total is None:
                refused = "paper not found"
            else:
                s = sessions[who] = [total, 0, True]
        elif kind == "cancel":
            s = sessions[who] = None
        elif kind == "current":
            refused = None if s and s[2] else "no active review session"
        else:
            action = kind if kind and kind.strip() else "accept"
            if not s or not s[2]:
                refused = "no active review session"
            elif s[1] >= s[0]:
                s[2] = False
            else:
                question = s[1]
                s[1] += 1
                s[2] = s[1] < s[0]
        state = "none" if not s else "active" if s[2] else "done"
        progress = None if not s or not s[0] else math.floor(100 * s[1] / s[0] + 0.5)
        out.append((who, seq, kind, total, action, refused, question, s[1] if s else None, s[0] if s else None, state, progress))
    return out


def review_log(n, reviewers):
    rng = random.Random(n)
    kinds = ["start", "accept", "edit", "skip", "flag", "", None, "current", "cancel"]
    return [(rng.choice(reviewers), k, rng.choices(kinds, [1, 8, 4, 3, 2, 1, 1, 3, 0.3])[0], rng.choice([None, 0, 1, 4, 30, 3000])) for k in range(n)]


KEY = lambda r: tuple(str(x) for x in r)


@pytest.mark.parametrize("reviewers", [["a", "b", None, "c"], ["one"]])
def test_review_sessions_equal_a_loop(spark, reviewers):
    from sheaf.operators import review

    rows = review_log(2500, reviewers)
    got = review.replayed(spark.createDataFrame(rows, "reviewer string, seq long, kind string, total long").repartition(6))
    want = plain_replay(rows)
    assert got.columns == ["reviewer", "seq", "kind", "total", "action", "refused", "question", "position", "of", "state", "progress"]
    assert sorted((tuple(r) for r in got.collect()), key=KEY) == sorted(want, key=KEY)
    last = {r.reviewer: r for r in review.sessions(got).collect()}
    for who in reviewers:
        own = [w for w in want if w[0] == who]
        assert (last[who].state, last[who].position, last[who].of) == (own[-1][9], own[-1][7], own[-1][8])
        assert last[who].n_edit == sum(w[4] == "edit" and w[6] is not None for w in own) and last[who].n_refused == sum(w[5] is not None for w in own)


def test_a_session_runs_over_many_ranges(spark):
    """One reviewer, one start at the beginning: every range but the first gets its state from those before it."""
    from sheaf.operators import review

    rows = [("one", 0, "start", 5000)] + [("one", k, "accept", None) for k in range(1, 4001)]
    log = spark.createDataFrame(rows, "reviewer string, seq long, kind string, total long")
    assert places.ranged(log, F.col("reviewer"), F.col("seq")).select("_range").distinct().count() > 1
    got = review.replayed(log)
    assert {r.seq: r.question for r in got.collect()} == {0: None, **{k: k - 1 for k in range(1, 4001)}}
    edits = spark.createDataFrame([("one", 7, "text", "new"), ("one", 4000, "text", "x"), ("other", 8, "text", "y"), ("one", 9999, "text", "z")], "reviewer string, seq long, field string, value string")
    assert review.recorded_edits(got, edits).collect() == [] and review.replayed(spark.createDataFrame([], "reviewer string, seq long, kind string, total long")).collect() == []


def test_recorded_edits_go_into_the_questions(spark):
    from sheaf.operators import curate, review

    log = [("p", 1, "start", 2), ("p", 2, "edit", None), ("p", 3, "skip", None), ("p", 4, "edit", None)]
    edits = [("p", 2, "text", "mended"), ("p", 4, "text", "too late"), ("p", 3, "text", "not an edit")]
    took = review.recorded_edits(review.replayed(spark.createDataFrame(log, "reviewer string, seq long, kind string, total long")), spark.createDataFrame(edits, "reviewer string, seq long, field string, value string"))
    questions = spark.createDataFrame([("p", 0, "first"), ("p", 1, "second")], "paper string, number long, text string")
    assert sorted(tuple(r) for r in curate.applied_edits(questions, took).collect()) == [("p", 0, "mended"), ("p", 1, "second")]


# keyed state in streams


EVENTS = "path string, at timestamp, nth long, what string"


def stamped(seconds):
    import datetime

    return datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=seconds)


def test_upserts_go_on_after_a_restart_and_ignore_older_rows(spark):
    from sheaf.streaming import keyed

    batches = [[("a", 1), ("b", 5), ("a", 3)], [("a", 2), ("b", 5), (None, 1)], [("c", 1), ("b", 6)], []]
    rows = [spark.createDataFrame([(p, stamped(n), n, f"{p}{n}{k}") for p, n in batch], EVENTS) for k, batch in enumerate(batches)]
    fed = keyed.Fed(spark, "test-upsert", rows[0].schema)
    table = {}
    for k, part in enumerate(rows):
        fed.feed(part, k)
        fed.run(lambda s: keyed.upserts(s, ["path"], ["nth"]), "update")
        for p, n in batches[k]:
            if p not in table or n > table[p][0]:
                table[p] = (n, f"{p}{n}{k}")
        assert {r.path: (r.nth, r.what) for r in keyed.table_of(fed.log(), ["path"]).collect()} == table
    # a batch gives out its own changes only, however large the table is
    assert {r.batch: r["count"] for r in fed.log().groupBy("batch").count().collect()} == {0: 2, 1: 1, 2: 2}


def test_a_batch_that_is_run_again_is_written_once(spark):
    from sheaf.streaming import keyed

    rows = spark.createDataFrame([("a", stamped(1), 1, "x")], EVENTS)
    fed = keyed.Fed(spark, "test-again", rows.schema)
    fed.feed(rows, 0)
    tries = []

    def fails_once(batch, number):
        tries.append(number)
        if len(tries) == 1:
            raise RuntimeError("stopped here")

    with pytest.raises(Exception, match="stopped here"):
        fed.run(lambda s: keyed.upserts(s, ["path"], ["nth"]), "update", fails_once)
    fed.run(lambda s: keyed.upserts(s, ["path"], ["nth"]), "update", fails_once)
    assert tries == [0, 0] and [(r.path, r.nth, r.batch) for r in fed.log().collect()] == [("a", 1, 0)]


def test_keyed_streams_need_no_python_for_a_key(spark, tmp_path):
    from sheaf.streaming import keyed

    rows = spark.readStream.schema(EVENTS).parquet(f"file://{tmp_path}")
    for stream in (keyed.upserts(rows, ["path"], ["nth"]), keyed.debounced(rows, ["path"], "at", ["nth"], 60_000)):
        assert "Pandas" not in stream._jdf.queryExecution().toString() and stream.dtypes == rows.dtypes


def test_gaps_are_told_to_the_microsecond(spark):
    from sheaf.streaming import keyed

    rows = [("a", stamped(0.0009), 1, ""), ("a", stamped(60.0003), 2, ""), ("b", stamped(0.0004), 3, ""), ("b", stamped(60.0004), 4, ""), ("end", stamped(9000), 5, "")]
    fed = keyed.Fed(spark, "test-fine", spark.createDataFrame(rows, EVENTS).schema)
    fed.feed(spark.createDataFrame(rows, EVENTS), 0)
    fed.run(lambda s: keyed.debounced(s, ["path"], "at", ["nth"], 60_000), "append")
    assert sorted((r.path, r.nth) for r in fed.log().collect()) == [("a", 2), ("b", 3), ("b", 4)]


def plain_debounce(rows, gap):
    out = []
    for p in {r[0] for r in rows}:
        own = sorted(r for r in rows if r[0] == p)
        out += [a for a, b in zip(own, [*own[1:], None], strict=True) if b is None or b[1] - a[1] >= gap]
    return sorted(out)


def test_debounced_changes_over_batches(spark):
    from sheaf.streaming import keyed

    rng = random.Random(9)
    rows = sorted({(rng.choice("abcd"), rng.randrange(2000), k) for k in range(160)}, key=lambda r: r[1])
    frames = [spark.createDataFrame([(p, stamped(t), k, str(k)) for p, t, k in rows if lo <= t < lo + 500], EVENTS).repartition(3) for lo in range(0, 2000, 500)]
    frames.append(spark.createDataFrame([("end", stamped(10_000), 0, "")], EVENTS))
    fed = keyed.Fed(spark, "test-debounce", frames[0].schema)
    for k, part in enumerate(frames):
        fed.feed(part, k)
        fed.run(lambda s: keyed.debounced(s, ["path"], "at", ["nth"], 60_000), "append")
    got = sorted((r.path, int((r.at - stamped(0)).total_seconds()), r.nth) for r in fed.log().collect() if r.path != "end")
    assert got == plain_debounce(rows, 60)


def test_stretches_join_in_any_order():
    from sheaf.streaming import keyed

    rng = random.Random(2)
    for _ in range(200):
        points = sorted({rng.randrange(300) for _ in range(rng.randrange(1, 40))})
        frames = [[] for _ in range(3)]
        for t in points:
            rng.choice(frames).append((t, t, (t,), (t,)))
        held = []
        for f in frames:
            held = keyed.joined(held, f, 10)
        want = [t for t, u in zip(points, [*points[1:], None], strict=True) if u is None or u - t >= 10]
        assert [s[3][0] for s in held] == want


def test_history_keeps_the_newest(spark):
    from sheaf.streaming import keyed
    from sheaf.streaming.events import folder

    rows = spark.createDataFrame([("a", stamped(k), k, str(k)) for k in range(90)], EVENTS)
    kept = keyed.History(folder(spark, "test-history"), rows.schema, ["at", "nth"], most=25)
    assert kept.read(spark) is None
    for k, lo in enumerate((0, 60, 30)):
        kept.add(rows.where(F.col("nth").between(lo, lo + 29)), k)
    kept.add(rows.where(F.col("nth").between(30, 59)), 2)  # the last batch once more
    assert sorted(r.nth for r in kept.read(spark).collect()) == list(range(65, 90))


# vectors that are alike


def clustered(seed, n, dim, clusters, spread):
    import numpy as np

    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    return (centres[rng.integers(clusters, size=n)] + spread * rng.normal(size=(n, dim))).tolist()


def plain_pairs(rows, threshold):
    import numpy as np

    classes = {}
    for i, v in rows:
        classes[tuple(v)] = min(i, classes.get(tuple(v), i))
    ids, x = list(classes.values()), np.array(list(classes))
    s = x @ x.T / np.sqrt(np.outer((x * x).sum(1), (x * x).sum(1)))
    return {(min(ids[a], ids[b]), max(ids[a], ids[b])) for a, b in np.argwhere(np.triu(s >= threshold, 1)).tolist()}


@pytest.mark.parametrize("case", [(1, 1500, 8, 20, 0.1, 0.95), (2, 900, 3, 1, 1.0, 0.97), (3, 700, 24, 5, 2.0, 0.5)])
def test_similar_vectors_equal_brute_force(spark, monkeypatch, case):
    from sheaf.operators import similar

    monkeypatch.setattr(similar, "BLOCK", 40)
    seed, n, dim, clusters, spread, threshold = case
    rows = list(enumerate(clustered(seed, n, dim, clusters, spread)))
    rows += [(n + k, rows[3][1]) for k in range(50)] + [(-1, rows[9][1])]
    frame = spark.createDataFrame(rows, "id long, embedding array<double>").repartition(5)
    members, pairs = similar.similar_vectors(frame, threshold)
    got = [(r.a, r.b) for r in pairs.collect()]
    want = plain_pairs(rows, threshold)
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 100
    named = {r.id: r.class_id for r in members.collect()}
    assert len(named) == len(rows) and named[3] == named[n + 7] == 3 and named[9] == named[-1] == -1


def test_bounds_spare_far_cells():
    import numpy as np

    from sheaf.operators import similar

    x = np.array(clustered(4, 3000, 16, 30, 0.05))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    reach = math.sqrt(2 - 2 * 0.95)
    home, near = similar.cells_of(x, x[:50], reach)
    assert near.mean() < 0.25
    close = x @ x.T >= 0.95
    for a, b in np.argwhere(close)[::97].tolist():
        assert near[a, home[b]] and near[b, home[a]]


def test_more_pivots_only_where_they_spare_copies():
    import numpy as np

    from sheaf.operators import similar

    for clusters, spread, threshold, want in ((500, 0.01, 0.99, 499), (1, 1.0, 0.3, 15)):
        x = np.array(clustered(8, 1000, 32, clusters, spread))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        assert len(similar.chosen_pivots(x, 16, 500, math.sqrt(2 - 2 * threshold))) == want


def test_vectors_that_are_none(spark):
    from sheaf.operators import similar

    rows = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, []), (5, [math.nan, 1.0]), (6, [math.inf, 1.0]), (7, [2.0, 0.0]), (None, [1.0, 0.0]), (8, [1.0, 0.0, 0.0]), (9, [None, 1.0]), (7, [0.0, 3.0]), (10, [-0.0, 1.0]), (11, [0.0, 1.0])]
    frame = spark.createDataFrame(rows, "id long, embedding array<double>").withColumn("g", F.lit("clash")).withColumn("home", F.lit(3))
    members, pairs = similar.similar_vectors(frame, 0.9)
    assert sorted((r.id, r.class_id) for r in members.collect()) == [(1, 1), (7, 7), (7, 7), (8, 8), (10, 10), (11, 10)]
    assert sorted((r.a, r.b) for r in pairs.collect()) == [(1, 7), (7, 10)]
    assert [d.collect() for d in similar.similar_vectors(frame.limit(0), 0.9)] == [[], []]
    with pytest.raises(ValueError):
        similar.similar_vectors(frame, 0)


def test_one_group_of_copies_and_one_hot_cell_are_many_tasks(spark, monkeypatch):
    """A third of the rows are copies, and most others lie in one cell: copies are one class, the cell is dealt into chunks."""
    from sheaf.operators import similar

    monkeypatch.setattr(similar, "BLOCK", 50)
    near = clustered(6, 1000, 6, 1, 0.01)
    rows = [(k, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for k in range(500)] + [(500 + k, v) for k, v in enumerate(near)]
    members, pairs = similar.similar_vectors(spark.createDataFrame(rows, "id long, embedding array<double>"), 0.99999)
    assert members.where("class_id = 0").count() == 500
    assert {(r.a, r.b) for r in pairs.collect()} == plain_pairs(rows, 0.99999)


# aliases


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_near_strings_equal_brute_force(spark, most):
    from sheaf.operators import normalize

    rng = random.Random(most)
    word = lambda: "".join(rng.choice("abñ") for _ in range(rng.randrange(0, 8)))
    xs, ys = {word() for _ in range(60)} | {"a" * 300}, {word() for _ in range(60)}
    frame = lambda values, c: spark.createDataFrame([(v,) for v in [*values, *values, None]], f"{c} string")
    got = normalize.near_strings(frame(xs, "x"), frame(ys, "y"), "x", "y", most).collect()
    want = {(x, y, distance(x, y)) for x in xs for y in ys if distance(x, y) <= most}
    assert len(got) == len(want) and {(r.x, r.y, r.d) for r in got} == want
    assert normalize.near_strings(frame(xs, "x"), frame([], "y").limit(0), "x", "y", most).collect() == []


def test_a_long_alias_table_is_looked_up_by_keys(spark):
    from sheaf.functions.vocabulary import tag_table
    from sheaf.operators import normalize

    n = normalize.MOST_BROADCAST + 1
    million = spark.range(1_000_000).selectExpr("concat('alias of ', id) as alias", "concat('name-', id) as canonical", "cast(id as int) as ord")
    rows = spark.createDataFrame([("alias of 12x", "physics"), ("alias of 77", "physics"), ("Name 99", "physics"), ("zzzz", "physics"), (None, "physics")], "topic string, subject string")
    plan = plan_of(normalize.normalize_topics(rows, million, tag_table(spark)))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    few = million.where(F.col("ord") < 200)
    got = {r.topic: r.topic_norm for r in normalize.normalize_topics(rows, few, tag_table(spark)).collect()}
    assert got == {"alias of 12x": "name-1", "alias of 77": "name-77", "Name 99": "name-99", "zzzz": "general-physics", None: "general-physics"}
    assert n > 200


# diagrams of a paper's questions


def test_diagrams_by_annotation_reference_and_rank(spark):
    from sheaf.operators import diagrams

    rows = [
        ("p", 1, 1, "physics", "plain", ["a"], True),
        ("p", 2, 2, "physics", "Figure 7 is\n![x](i2.png)\nThe caption line", [], None),
        ("p", 3, 3, None, "![](gone.png) ![two](i3.png)", ["a"], True),
        ("p", 4, 4, "physics", "no picture", ["a"], False),
        ("p", 0, 0, "physics", "a Diagram", ["a"], True),
        ("q", 1, 1000, "biology", "shown in", [], None),
    ]
    q = spark.createDataFrame(rows, "paper string, pos int, number int, subject string, text string, options array<string>, has_diagram boolean")
    images = spark.createDataFrame([("p", "i1.png", 2), ("p", "i2.png", 1), ("p", "i3.png", 3), ("q", "b.png", 1)], "paper string, image_id string, page int")
    options = "A) red one; B) green one; C) blue one; D) grey one"
    notes = [("p", 2, "i1.png", "diagram", "drawn", 1), ("p", 1, "i3.png", "figure", "", 1), ("p", 3, "lost.png", "figure", "x", 1), ("p", 4, "i2.png", "table", None, 1), ("q", 1, "b.png", "figure", options, 1000)]
    notes = spark.createDataFrame(notes, "paper string, place int, image_id string, type string, description string, relates_to int")
    got = {(r.paper, r.pos): r for r in diagrams.attached(q, images, notes).collect()}
    shown = lambda key: [tuple(d) for d in got[key].diagrams or []]
    assert shown(("p", 1)) == [("diagrams/physics/q001-i3.png", "fig. 1", None), ("diagrams/physics/q001-i1.png", "drawn", "drawn")]
    assert shown(("p", 2)) == [("diagrams/physics/q002-i2.png", "Figure 7 is\n![x](i2.png)", "The caption line")] and got["p", 2].has_diagram
    assert shown(("p", 3)) == [("diagrams/unknown/q003-i3.png", "two", None)]
    assert shown(("p", 4)) == shown(("p", 0)) == [] and not got["p", 4].has_diagram and got["p", 0].diagram_file is None
    assert shown(("q", 1)) == [("diagrams/biology/q1000-b.png", options, options)] and got["q", 1].options == ["red one", "green one", "blue one", "grey one"]
    assert got["p", 2].options == [] and got["p", 1].diagram_file == "diagrams/physics/q001-i3.png"
    old = {(r.paper, r.pos): r.diagram_file for r in diagrams.attached(q, images).collect()}
    assert old == {("p", 1): "diagrams/physics/q001-fig1.png", ("p", 2): "diagrams/physics/q002-fig1.png", ("p", 3): "diagrams/unknown/q003-fig1.png", ("p", 4): None, ("p", 0): None, ("q", 1): "diagrams/biology/q1000-fig1.png"}


# stages that survive a crash


def test_a_result_takes_the_old_ones_place_as_one_step(spark, tmp_path, monkeypatch):
    from sheaf.operators import stages

    cache = stages.StageCache(spark, f"file://{tmp_path}/cache")
    cache.save("a/1", "ocr", spark.range(3))
    cache.save("a/1", "extract", spark.range(5))
    # written, but not put in place
    change = stages.Manifests.change
    monkeypatch.setattr(stages.Manifests, "change", lambda self, f: (_ for _ in ()).throw(RuntimeError("crashed")))
    with pytest.raises(RuntimeError):
        cache.save("a/1", "ocr", spark.range(9))
    monkeypatch.setattr(stages.Manifests, "change", change)
    again = stages.StageCache(spark, f"file://{tmp_path}/cache")
    assert again.load("a/1", "ocr").count() == 3 and again.load("a_1", "ocr") is None
    # a manifest that was cut short counts for nothing, and the next writer takes the number after it
    folder = tmp_path / "cache" / "a%2F1" / "manifests"
    (folder / "manifest-0000000003").write_text('{"ocr": ')
    assert again.load("a/1", "ocr").count() == 3
    again.save("a/1", "ocr", again.load("a/1", "ocr").where("id > 0"))
    assert again.load("a/1", "ocr").count() == 2 and again.load("a/1", "extract").count() == 5
    assert again.clean("a/1") == 2 and again.load("a/1", "ocr").count() == 2 and again.load("a/1", "extract").count() == 5


def test_two_writers_keep_both_changes(spark, tmp_path):
    from sheaf.operators import stages

    one, two = (stages.Manifests(spark, f"file://{tmp_path}/m") for _ in range(2))

    def late(old):
        if "two" not in old:
            two.change(lambda o: o | {"two": 2})  # comes between reading and writing
        return old | {"one": 1}

    assert one.change(late) == {"one": 1, "two": 2} == two.newest()


def test_a_run_goes_on_after_each_stage(spark, tmp_path):
    from sheaf.operators import stages

    def run(keep):
        a = keep("a", lambda: spark.range(10))
        b = keep("b", lambda: a.where("id % 2 = 0"))
        return keep("c", lambda: b.selectExpr("id * 10 as id"))

    class Stop(Exception):
        pass

    for stop in ("a", "b", "c"):
        first = stages.StageCache(spark, f"file://{tmp_path}/{stop}")
        inner = first.stage("k", "v1")

        def until(name, make, inner=inner, stop=stop):
            rows = inner(name, make)
            if name == stop:
                raise Stop
            return rows

        with pytest.raises(Stop):
            run(until)
        second = stages.StageCache(spark, f"file://{tmp_path}/{stop}")
        assert sorted(r.id for r in run(second.stage("k", "v1")).collect()) == [0, 20, 40, 60, 80]
        assert first.ran + second.ran == ["a", "b", "c"]
        third = stages.StageCache(spark, f"file://{tmp_path}/{stop}")
        run(third.stage("k", "v1"))
        assert third.ran == []
        run(third.stage("k", "v2"))  # other inputs: all anew
        assert third.ran == ["a", "b", "c"]


# catalogues as digest trees


def test_catalogues_differ_where_files_do(spark, tmp_path):
    from sheaf.operators import digests

    rng = random.Random(3)
    names = lambda: (rng.choice(["a", "b", None]), rng.choice(["1", "2"]), rng.choice(["s", None]))
    old = {(*names(), f"f{k}"): f"d{k}" for k in range(200)}
    new = dict(old)
    for k, key in enumerate(list(old)):
        if key[:2] == ("a", "1"):
            if k % 3 == 0:
                del new[key]
            elif k % 3 == 1:
                new[key] = "other" if k % 2 else None
    new["b", "9", "s", "fresh"] = "d"
    schema = "exam string, year string, shift string, file string, digest string"
    frames = [spark.createDataFrame([(*k, v) for k, v in d.items()], schema).repartition(n) for d, n in ((old, 3), (new, 5))]
    a, b = (digests.Catalogue.write(f, f"file://{tmp_path}/{k}") for k, f in enumerate(frames))
    got = {(r.exam, r.year, r.shift, r.file): r.change for r in digests.differences(a, b).collect()}
    want = {k: "removed" if k not in new else "added" if k not in old else "changed" for k in old.keys() | new.keys() if k not in new or k not in old or old[k] != new[k]}
    assert got == want and {"added", "removed", "changed"} == set(want.values())
    levels = digests.changed_branches(a, b)
    assert [r.change for r in levels[0].collect()] == ["changed"] and {r.exam["name"] for r in levels[1].collect()} == {"a", "b"}
    # a branch that agrees isn't read: its files can be gone
    plan = plan_of(digests.differences(a, b))
    assert "dynamicpruning" in plan.lower() or "PartitionFilters" in plan
    c = digests.Catalogue.write(frames[0].repartition(7, "digest"), f"file://{tmp_path}/c")
    assert digests.differences(a, c).collect() == [] and len(digests.changed_branches(a, c)) == 1
    twice = digests.Catalogue.write(frames[0].unionByName(frames[0].limit(1)), f"file://{tmp_path}/t")
    assert [r.change for r in digests.differences(a, twice).collect()] == ["changed"]


# archives by ranges


def test_archives_member_by_member(spark, tmp_path):
    import zipfile

    from sheaf.sources import archives

    rng = random.Random(4)
    folder = tmp_path / "zips"
    folder.mkdir()
    inside = {"a.txt": b"plain", "dir/b.bin": rng.randbytes(70_000), "é.txt": "ß".encode(), "empty": b"", "long": b"x" * 3_000_000}
    with zipfile.ZipFile(folder / "good.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.mkdir("dir")
        for name, content in inside.items():
            z.writestr(zipfile.ZipInfo(name), content, zipfile.ZIP_STORED if name == "a.txt" else zipfile.ZIP_DEFLATED)
        z.comment = b"a comment with PK\x05\x06 in it"
    good = (folder / "good.zip").read_bytes()
    with zipfile.ZipFile(folder / "empty.zip", "w"):
        pass
    (folder / "before.zip").write_bytes(b"some bytes before" + good)
    (folder / "cut.zip").write_bytes(good[: len(good) // 2])
    (folder / "none.zip").write_bytes(b"")
    (folder / "text.zip").write_bytes(b"no archive at all " * 9)
    at = good.index(b"plain")
    (folder / "spoiled.zip").write_bytes(good[:at] + b"PLAIN" + good[at + 5 :])
    with zipfile.ZipFile(folder / "packed.zip", "w", zipfile.ZIP_LZMA) as z:
        z.writestr("c", b"other method")
    paths = spark.createDataFrame([(f"file://{p}",) for p in sorted(folder.iterdir())] + [(f"file://{folder}/missing.zip",)], "path string")
    listed = archives.members(paths)
    got = {}
    for r in archives.contents(listed).collect():
        got.setdefault(r.path.rsplit("/", 1)[1], {})[r.name] = (None if r.content is None else bytes(r.content), r.error)
    want = {name: (content, None) for name, content in inside.items()}
    assert got["good.zip"] == want and got["before.zip"] == want and "empty.zip" not in got
    assert got["spoiled.zip"].pop("a.txt") == (None, "other content than the directory says") and got["spoiled.zip"] == {k: v for k, v in want.items() if k != "a.txt"}
    assert got["packed.zip"] == {"c": (None, "packed by method 14")}
    for name in ("cut.zip", "none.zip", "text.zip", "missing.zip"):
        assert list(got[name]) == [None] and got[name][None][0] is None and got[name][None][1], name
    assert archives.contents(listed.limit(0)).collect() == []


def test_wide_archives(spark, tmp_path):
    """Sizes and places of 64 bits, as writers of streams give them."""
    import zipfile

    from sheaf.sources import archives

    path = tmp_path / "wide.zip"
    limit = zipfile.ZIP64_LIMIT, zipfile.ZIP_FILECOUNT_LIMIT
    zipfile.ZIP64_LIMIT, zipfile.ZIP_FILECOUNT_LIMIT = 100, 2
    try:
        with zipfile.ZipFile(path, "w") as z:
            for k in range(5):
                z.writestr(f"m{k}", bytes([k]) * 300)
    finally:
        zipfile.ZIP64_LIMIT, zipfile.ZIP_FILECOUNT_LIMIT = limit
    rows = archives.contents(archives.members(spark.createDataFrame([(f"file://{path}",)], "path string"))).collect()
    assert sorted((r.name, bytes(r.content), r.error) for r in rows) == [(f"m{k}", bytes([k]) * 300, None) for k in range(5)]


def test_a_large_archive_is_read_by_many_tasks(spark, tmp_path):
    import zipfile

    from sheaf.sources import archives

    with zipfile.ZipFile(tmp_path / "large.zip", "w") as z:
        for k in range(2000):
            z.writestr(f"m{k:05d}", f"content {k}")
    listed = archives.members(spark.createDataFrame([(f"file://{tmp_path}/large.zip",)], "path string"))
    out = archives.contents(listed)
    tasks = out.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) > 4 and max(r["count"] for r in tasks) < 1000 and sum(r["count"] for r in tasks) == 2000


# recorded services


def test_services_are_selected_in_the_source(spark, tmp_path):
    from sheaf.sources import recorded

    root = f"file://{tmp_path}/rec"
    rows = spark.createDataFrame([(f"s{k % 3}" if k % 7 else None, str(k), k % 2 == 0, "a" * k, None) for k in range(60)], "service string, request string, ok boolean, answer string, error string")
    recorded.record(rows, root, 1)
    recorded.record(rows.limit(0), root, 2)
    every, one = recorded.read(spark, root), recorded.read(spark, root, ["s1"], True)
    assert every.count() == 60 and every.where("service = ''").count() == 9 and every.count() == 60
    assert sorted(int(r.request) for r in one.where("length(answer) > 10").collect()) == [k for k in range(60) if k % 7 and k % 3 == 1 and k % 2 == 0 and k > 10]
    assert one.rdd.getNumPartitions() < every.rdd.getNumPartitions()
    assert {p.service for p in recorded.RecordedReader(root, {"s1"}, None).partitions()} == {"s1"}
    assert recorded.read(spark, root, ["none"]).collect() == recorded.read(spark, root, []).collect() == []
    assert recorded.read(spark, root, ok=False).count() == 30


def test_half_a_turn_is_not_read(spark, tmp_path):
    from sheaf.sources import recorded

    root = f"file://{tmp_path}/rec"
    assert recorded.turns(root) == [] and recorded.RecordedStream(root).latestOffset() == {"turns": 0}
    rows = spark.createDataFrame([("s", "1", True, "a", None)], "service string, request string, ok boolean, answer string, error string")
    for turn in (1, 2, 3):
        recorded.record(rows, root, turn)
    (tmp_path / "rec" / "turn=0000000002" / "_SUCCESS").unlink()
    assert recorded.turns(root) == [1, 3] and recorded.RecordedStream(root).latestOffset() == {"turns": 1}
    recorded.record(rows, root, 2)
    stream = recorded.RecordedStream(root)
    assert stream.latestOffset() == {"turns": 3} and {p.turn for p in stream.partitions({"turns": 1}, {"turns": 3})} == {2, 3}
