"""Merging the results of overlapping chunks, answer backfill, duplicate questions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.text import word_list
from sheaf.operators.stages import saved

FREQUENT = 50_000  # a word is frequent if more than one set in so many has it
MOST_BROADCAST = 500_000  # the most frequent words, which are ranked: some ten megabytes
MOST_WORDS = 1 << 20  # words that are encoded at once
BLOCK = 512  # sets of a group that are compared in one task


def completeness(text: Column, subject: Column, kind: Column, answer: Column, n_options: Column, topic: Column, section: Column, marks: Column) -> Column:
    """0 to 14: how full a candidate is."""
    there = lambda c: F.coalesce(c, F.lit("")) != ""
    parts = [(there(text), 2), (there(subject), 2), (there(kind), 2), (there(answer), 3), (F.coalesce(n_options, F.lit(0)) >= 3, 2), (there(topic), 1), (there(section), 1), (F.coalesce(marks, F.lit(0.0)) > 0, 1)]
    return sum((F.when(c, k).otherwise(0) for c, k in parts), F.lit(0)).cast("int")


def prefers_new(a: Column, b: Column) -> Column:
    """Whether candidate a takes the place of b. Not transitive: the gaps of 1 and 5 make the order of arrival matter."""
    has = lambda c, f: F.coalesce(c[f], F.lit("")) != ""
    length = lambda c: F.coalesce(F.length(c["options"]), F.lit(0))
    return (
        F.when(a["full"] > b["full"] + 1, True)
        .when(b["full"] > a["full"] + 1, False)
        .when(has(a, "answer") & ~has(b, "answer"), True)
        .when(~has(a, "answer") & has(b, "answer"), False)
        .when(length(a) > length(b) + 5, True)
        .when(length(b) > length(a) + 5, False)
        .when(has(a, "topic") & ~has(b, "topic"), True)
        .when(~has(a, "topic") & has(b, "topic"), False)
        .otherwise(a["chunk_index"] <= b["chunk_index"])
    )


def merge_chunks(rows: DataFrame) -> DataFrame:
    """One row for each (paper, number), folded in order of chunk and place. rows: candidates with `full` (completeness), chunk_index, pos. A number's candidates are as many as the chunks that hold its page."""
    order = F.struct("chunk_index", "pos", *[c for c in rows.columns if c not in ("paper", "number", "chunk_index", "pos")])
    grouped = rows.groupBy("paper", "number").agg(F.array_sort(F.collect_list(order)).alias("c"))
    best = F.reduce(F.slice("c", 2, F.size("c")), F.get("c", F.lit(0)), lambda kept, new: F.when(prefers_new(new, kept), new).otherwise(kept))
    return grouped.withColumn("best", best).select("paper", "number", "best.*")


def best_rows(rows: DataFrame) -> DataFrame:
    """The same with a total order: fullest, answered, longest options, topic, earliest. A partial aggregate goes before the shuffle."""
    has = lambda f: (F.coalesce(F.col(f), F.lit("")) != "").cast("int")
    rank = F.struct("full", has("answer").alias("a"), F.coalesce(F.length("options"), F.lit(0)).alias("o"), has("topic").alias("t"), (-F.col("chunk_index")).alias("c"), (-F.col("pos")).alias("p"))
    names = [c for c in rows.columns if c not in ("paper", "number")]
    return rows.groupBy("paper", "number").agg(F.max_by(F.struct(*names), rank).alias("best")).select("paper", "number", "best.*")


def first_passages(passages: DataFrame) -> DataFrame:
    return passages.groupBy("paper", "id").agg(F.min_by("text", F.struct("chunk_index", "pos")).alias("text"))


def answer_key(rows: DataFrame) -> DataFrame:
    """(paper, number, key_answer): the last answer among chunks in which a key was found."""
    good = rows.where("answer_key_found and coalesce(answer, '') <> ''")
    return good.groupBy("paper", "number").agg(F.max_by("answer", F.struct("chunk_index", "pos")).alias("key_answer"))


def backfill(merged: DataFrame, key: DataFrame) -> DataFrame:
    """Blank answers from the key; both sides are grouped by the join's key already."""
    return merged.join(key, ["paper", "number"], "left").withColumn("answer", F.when(F.coalesce("answer", F.lit("")) == "", F.coalesce("key_answer", F.col("answer"))).otherwise(F.col("answer"))).drop("key_answer")


ENCODED_DDL = "k bigint, l bigint, n int, rare array<bigint>, common array<int>, sketch array<bigint>"


def _cut(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[tuple]:
    """Rows whose lists aren't empty, with the lists' values and lengths: as many rows as have so many values, at least one."""
    for whole in batches:
        lists = whole.column(column)
        ends, first = np.asarray(lists.offsets).astype(np.int64), 0
        while first < len(whole):
            last = min(max(int(np.searchsorted(ends, ends[first] + most, "right")) - 1, first + 1), len(whole))
            n = np.diff(ends[first : last + 1])
            if n.any():
                yield whole.slice(first, last - first).filter(pa.array(n > 0)), lists.values.slice(ends[first], ends[last] - ends[first]).to_numpy().astype(np.int64), n[n > 0]
            first = last


def _counted(cut, most: int):
    """Lists of hashes to (hash, number of lists that hold it), summed over some lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words, _ in cut(batches, 0, most):
            w, df = np.unique(words, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(df.astype(np.int64))], ["w", "df"])

    return run


def _encoded(cut, frequent, most: int):
    """(id, hashes of a set's words) to two hashes of the set, its size, its rare words by hash, its frequent words by rank, and a sketch.

    The sketch is the parity of the words in each of 64 cells, or twice as many, and so on: for n words, n / 2 cells at least.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = frequent.value
        offsets = lambda c: pa.array(np.concatenate(([0], np.cumsum(c))).astype(np.int32))
        for rows, words, n in cut(batches, 1, most):
            row, start = np.repeat(np.arange(len(n)), n), np.concatenate(([0], np.cumsum(n)[:-1]))
            common, value = np.zeros(len(words), bool), words
            if len(known):
                at = np.minimum(np.searchsorted(known, words), len(known) - 1)
                common = known[at] == words
                value = np.where(common, rank[at], words)
            order = np.lexsort((value, common, row))
            value, common = value[order], common[order]
            n_common = np.add.reduceat(common.astype(np.int64), start)
            bits = words.view(np.uint64)
            mixed = (bits ^ (bits >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            sums = [np.add.reduceat(x, start).view(np.int64) for x in (bits, mixed ^ (mixed >> np.uint64(32)))]
            lanes = 1 << np.ceil(np.log2(np.maximum(n / 128, 1))).astype(np.int64)
            sketch = np.zeros(lanes.sum(), np.uint64)
            lane = (words >> 6) & (lanes - 1)[row]
            np.bitwise_xor.at(sketch, (np.cumsum(lanes) - lanes)[row] + lane, np.uint64(1) << (bits & np.uint64(63)))
            lists = [(n - n_common, value[~common]), (n_common, value[common].astype(np.int32)), (lanes, sketch.view(np.int64))]
            columns = [rows.column(0), *map(pa.array, (*sums, n.astype(np.int32))), *[pa.ListArray.from_arrays(offsets(c), pa.array(v)) for c, v in lists]]
            yield pa.RecordBatch.from_arrays(columns, ["id", "k", "l", "n", "rare", "common", "sketch"])

    return run


def _compared(threshold: float, most: int):
    """Rows (g, i, j, guest, id, rare, common), the others before the guests of each (g, i, j), to the pairs that are alike of one of each, a < b."""

    def words(cuts: list[pa.RecordBatch]) -> tuple:
        owners, values, first = [], [], 0
        for cut in cuts:
            for lists in (cut.column(5), cut.column(6)):
                owners.append(first + np.repeat(np.arange(len(cut)), lists.value_lengths().to_numpy()))
                values.append(lists.flatten().to_numpy().astype(np.int64))
            first += len(cut)
        owner = np.concatenate(owners)
        return np.concatenate([c.column(4).to_numpy(zero_copy_only=False) for c in cuts]), owner, np.concatenate(values), np.bincount(owner, minlength=first)

    def met(held: list[pa.RecordBatch], guests: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        a, x, u, n = words(held)
        b, y, v, m = words([guests])
        order = np.argsort(u, kind="stable")
        x, u = x[order], u[order]
        order = np.argsort(y, kind="stable")
        y, v = y[order], v[order]
        low = np.searchsorted(u, v)
        have = np.searchsorted(u, v, "right") - low  # sets that hold the guest's word
        begin, total = np.concatenate(([0], np.cumsum(m))), np.concatenate(([0], np.cumsum(have)))
        first = 0
        while first < len(b):
            last = max(int(np.searchsorted(total[begin], total[begin[first]] + most, "right")) - 1, first + 1)
            part = slice(begin[first], begin[last])
            each = have[part]
            at = np.repeat(low[part] - (total[part] - total[part.start]), each) + np.arange(each.sum())
            both = np.bincount(np.repeat(y[part] - first, each) * len(a) + x[at], minlength=(last - first) * len(a)).reshape(-1, len(a))
            like = both / (m[first:last, None] + n[None] - both)
            k, h = np.nonzero((like >= threshold) & (a[None] < b[first:last, None]))
            if len(k):
                yield pa.RecordBatch.from_arrays([pa.array(a[h], guests.column(4).type), pa.array(b[first + k], guests.column(4).type), pa.array(like[k, h])], ["a", "b", "similarity"])
            first = last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            places, at = list(zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True)), 0
            while at < len(places):
                end = at + 1
                while end < len(places) and places[end] == places[at]:
                    end += 1
                *place, guest = places[at]
                cut, at = batch.slice(at, end - at), end
                if place != key:
                    key, held = place, []
                if not guest:
                    held.append(cut)
                elif held:
                    yield from met(held, cut)

    return run


def _word_sets(rows: DataFrame) -> DataFrame:
    """(id, n, rare, common, sketch) of each distinct word set that isn't empty, by its smallest id."""
    spark = rows.sparkSession
    hashed = rows.where("text is not null").select("id", F.array_distinct(F.transform(word_list("text"), lambda w: F.xxhash64(w))).alias("h"))
    counts = hashed.select("h").mapInArrow(_counted(_cut, MOST_WORDS), "w bigint, df bigint").groupBy("w").agg(F.sum("df").alias("df")).where(F.col("df") > max(rows.count() / FREQUENT, 2.0))
    known = counts.orderBy(F.desc("df"), "w").limit(MOST_BROADCAST).toArrow().column("w").to_numpy().astype(np.int64)
    order = np.argsort(known)
    frequent = spark.sparkContext.broadcast((known[order], (len(known) - 1 - order).astype(np.int64)))
    sets = hashed.mapInArrow(_encoded(_cut, frequent, MOST_WORDS), f"id {rows.schema['id'].dataType.simpleString()}, {ENCODED_DDL}")
    one = sets.groupBy("k", "l", "n").agg(F.min("id").alias("id"), *[F.first(c).alias(c) for c in ("rare", "common", "sketch")])
    return saved(one.select("id", "n", "rare", "common", "sketch"), "word-sets")


def _apart(x: Column, y: Column) -> Column:
    """In how many cells two sketches differ, the longer folded to the shorter's length; 0 if it is more than twice as long."""
    least = F.least(F.size(x), F.size(y))
    lane = lambda s, k: F.get(s, k).bitwiseXOR(F.coalesce(F.get(s, k + least), F.lit(0).cast("bigint")))
    apart = F.aggregate(F.sequence(F.lit(0), least - 1), F.lit(0), lambda sum_, k: sum_ + F.bit_count(lane(x, k).bitwiseXOR(lane(y, k))))
    return F.when(F.greatest(F.size(x), F.size(y)) > 2 * least, 0).otherwise(apart)


def similar_pairs(rows: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(a, b, similarity) of texts whose word sets have a Jaccard similarity of at least the threshold; rows: (id, text).

    Words are known by their 64-bit hashes. Equal sets are one class, that of their smallest id. Exact by prefixes: in any one order of all words,
    two such sets share one of the first words of each, so only those are joined. The order puts words that many sets have last: of those that
    more than one set in FREQUENT has, the MOST_BROADCAST most frequent are broadcast with their ranks; any order finds the same pairs. What a pair's sizes or the places of the shared word rule out is
    dropped inside the join, and of what is left what the sets' sketches rule out: cells whose parities differ are at most the words that only
    one of the two has.

    A pair travels as two ids and never with its words. For the comparison in full, pairs go to groups, that of a pair being the smallest candidate of its first set, and
    each set goes to a group once, not once for each pair; a group is dealt out in blocks of BLOCK sets by BLOCK sets.
    """
    sets = _word_sets(rows)
    slack = 1e-6  # products of fractions may lie above the whole number that they stand for
    first = F.slice(F.concat("rare", F.col("common").cast("array<bigint>")), 1, (F.col("n") - F.ceil(F.col("n") * threshold - slack) + 1).cast("int"))
    # a word, its set's size and its place in one number, and the word before it
    prefix = sets.select("id", "n", first.alias("p")).select("id", F.inline(F.transform("p", lambda w, i: F.struct(w.alias("w"), (F.shiftleft(F.col("n").cast("bigint"), 32) + i).alias("at"), F.get("p", i - 1).alias("before")))))
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    size, place = (lambda c: F.shiftright(c, 32)), (lambda c: c.bitwiseAND(F.lit(0xFFFFFFFF)))
    near = lambda n, m: (m >= n * threshold - slack) & (n >= m * threshold - slack)
    n, m = size(x("at")), size(y("at"))
    shared = F.least(n - place(x("at")), m - place(y("at"))) >= (n + m) * (threshold / (1 + threshold)) - slack
    # if the word before is the same too, the pair was met there
    met = F.coalesce(x("before") == y("before"), F.lit(False))
    hits = prefix.alias("x").join(prefix.alias("y"), (x("w") == y("w")) & (x("id") < y("id")) & near(n, m) & shared & ~met)
    pairs = hits.select(x("id").alias("a"), y("id").alias("b")).distinct()
    cells = sets.select("id", "n", "sketch")
    pairs = pairs.join(cells.alias("x"), F.col("a") == x("id")).join(cells.alias("y"), F.col("b") == y("id"))
    pairs = saved(pairs.where(_apart(x("sketch"), y("sketch")) <= (x("n") + y("n")) * ((1 - threshold) / (1 + threshold)) + slack).select("a", "b"), "similar-candidates")
    home = pairs.groupBy(F.col("b").alias("a")).agg(F.min("a").alias("g"))
    named = saved(pairs.join(home, "a", "left").select(F.coalesce("g", "a").alias("g"), "a", "b"), "similar-groups")
    side = lambda c: named.select("g", F.col(c).alias("id")).distinct()
    blocks = lambda c, k: side(c).groupBy("g").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(k))
    dims = saved(blocks("a", "ka").join(blocks("b", "kb"), "g"), "similar-blocks")
    own, each = (lambda k: F.pmod(F.xxhash64("id"), k).cast("int")), (lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1)))
    dealt = side("a").join(dims, "g").select("g", own("ka").alias("i"), each("kb").alias("j"), F.lit(False).alias("guest"), "id")
    dealt = dealt.unionByName(side("b").join(dims, "g").select("g", each("ka").alias("i"), own("kb").alias("j"), F.lit(True).alias("guest"), "id"))
    key, kind = ["g", "i", "j"], rows.schema["id"].dataType.simpleString()
    members = dealt.join(sets.select("id", "rare", "common"), "id").select(*key, "guest", "id", "rare", "common")
    dealt = members.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key).sortWithinPartitions(*key, "guest")
    return dealt.mapInArrow(_compared(threshold, MOST_WORDS), f"a {kind}, b {kind}, similarity double")
