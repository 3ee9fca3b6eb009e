"""Similarity by embeddings: a cache of vectors by text, and an exact join of vectors that are alike."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.functions.text import wide_trim
from sheaf.operators.stages import saved

def cache_key(column: str = "text"):
    """Texts that differ in case or outer spaces only share a vector."""
    return F.lower(wide_trim(column))


def embedded(rows: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows (id, text) with their vectors from the cache (key, embedding), and the texts that it lacks, each key once: (key, text)."""
    keyed = rows.withColumn("key", cache_key())
    missing = keyed.join(cache.select("key"), "key", "left_anti").groupBy("key").agg(F.min("text").alias("text"))
    return keyed.join(cache, "key"), missing


def cached(rows: DataFrame, cache: DataFrame, embed) -> tuple[DataFrame, DataFrame]:
    """rows (id, text) with their vectors, and the cache with those that it lacked appended: `embed` makes (key, embedding) of (key, text).

    Each key that is missing is embedded once, whatever the rows that share it; a key that the embedder gives nothing for stays out of both.
    """
    _, missing = embedded(rows, cache)
    made = saved(embed(missing).select("key", "embedding").where("embedding is not null").dropDuplicates(["key"]), "embedded")
    whole = cache.select("key", "embedding").unionByName(made)
    return embedded(rows, whole)[0], whole


BLOCK = 512  # vectors at home in a chunk, at least
HELD = 1 << 22  # numbers that a task holds as the vectors of one chunk, at most
TILE = 2048  # vectors of each side that are multiplied at once
MOST_PIVOTS = 1024
SLACK = 1e-9  # more than rounding can take from a bound

HOMED = pa.schema([("g", pa.string()), ("id", pa.int64()), ("size", pa.int32()), ("home", pa.int32()), ("cells", pa.list_(pa.int32())), ("embedding", pa.list_(pa.float64()))])
HOMED_DDL = "g string, id long, size int, home int, cells array<int>, embedding array<double>"
PAIRS = pa.schema([("g", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("similarity", pa.float64())])
PAIRS_DDL = "g string, a long, b long, similarity double"


def cells_of(x: np.ndarray, pivots: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each unit vector, and which pivots' cells can hold a vector within reach.

    A vector of another cell lies beyond the plane halfway between the two pivots; the way to that plane is at least
    (d(x, other) ** 2 - d(x, own) ** 2) / (2 * d(own, other)), and no vector beyond it is nearer.
    """
    square = np.maximum(2 - 2 * x @ pivots.T, 0)
    home = square.argmin(axis=1)
    between = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))[home]
    away = square - square[np.arange(len(x)), home][:, None]
    near = away <= 2 * between * (reach + SLACK) + SLACK
    near[np.arange(len(x)), home] = True
    return home, near


def _homed(shared, reach: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(2).to_pylist()
            sizes = [len(v) for v in raw]
            home, cells = np.zeros(len(raw), np.int32), [[0]] * len(raw)
            for size in set(sizes):
                at = [k for k, n in enumerate(sizes) if n == size]
                x = np.array([raw[k] for k in at], np.float64)
                own, near = cells_of(x / np.linalg.norm(x, axis=1, keepdims=True), shared.value[size], reach)
                for k, h, row in zip(at, own.tolist(), near, strict=True):
                    # a pair is found in one cell of its two: that from which the other is less than half way round
                    home[k], cells[k] = h, [c for c in np.flatnonzero(row).tolist() if (h - c) % len(row) <= len(row) // 2]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((b.column(0), b.column(1), sizes, home, cells, b.column(2)), HOMED, strict=True)], schema=HOMED)

    return run


def _compared(threshold: float):
    """Rows (g, size, cell, chunk, guest, id, home, embedding) by chunk, those at home first: each guest with all that are at home."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, number = None, [], []
        for b in batches:
            g, size, cell, chunk, guest = (b.column(k).to_pylist() for k in range(5))
            places = list(zip(g, size, cell, chunk, guest, strict=True))
            ids, homes = b.column(5).to_numpy(), b.column(6).to_numpy()
            at = 0
            while at < len(places):
                end = at + 1
                while end < len(places) and places[end] == places[at]:
                    end += 1
                *place, is_guest = places[at]
                x = b.column(7).slice(at, end - at).flatten().to_numpy().reshape(-1, place[1])
                who, home, at = ids[at:end], homes[at:end], end
                if place != key:
                    key, held, number = place, [], []
                if not is_guest:
                    held.append(x.copy())
                    number.append(who.copy())
                    continue
                if not held:
                    continue
                if len(held) > 1:
                    held, number = [np.concatenate(held)], [np.concatenate(number)]
                for k in range(0, len(who), TILE):
                    for m in range(0, len(number[0]), TILE):
                        yield from met(place, x[k : k + TILE], who[k : k + TILE], home[k : k + TILE], held[0][m : m + TILE], number[0][m : m + TILE])

    def met(place, x, who, home, held, number) -> Iterator[pa.RecordBatch]:
        lengths, norms = np.sqrt((x * x).sum(axis=1)), np.sqrt((held * held).sum(axis=1))
        like = (x / lengths[:, None]) @ (held / norms[:, None]).T >= threshold - SLACK
        like &= (home[:, None] != place[2]) | (who[:, None] < number[None])
        i, j = np.nonzero(like)
        for k in range(0, len(i), TILE * 16):
            p, q = i[k : k + TILE * 16], j[k : k + TILE * 16]
            exact = (x[p] * held[q]).sum(axis=1) / (lengths[p] * norms[q])
            p, q, exact = p[exact >= threshold], q[exact >= threshold], exact[exact >= threshold]
            if len(p):
                two = np.sort(np.stack([who[p], number[q]]), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array([place[0]] * len(p), pa.string()), pa.array(two[0]), pa.array(two[1]), pa.array(exact)], schema=PAIRS)

    return run


def _unit(x: list) -> np.ndarray:
    x = np.array(x, np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def chosen_pivots(x: np.ndarray, few: int, most: int, reach: float) -> np.ndarray:
    """Of unit vectors in a fixed order, the pivots: an odd number of at most `most`, if they spare so much that a vector is copied to fewer cells than `few` pivots make; else at most `few`."""
    few, most = (min(len(x), n) - 1 | 1 for n in (few, most))
    return x[:most] if few >= most or cells_of(x, x[:most], reach)[1].sum(axis=1).mean() <= few else x[:few]


def similar_vectors(rows: DataFrame, threshold: float, group: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Members (group, id, class_id) and pairs (group, a, b, similarity) of rows (id, embedding): all classes whose cosine is at least the threshold.

    Rows with one vector (and group) are a class, named by its smallest id; pairs are between classes, a < b, so copies aren't expanded. Only
    vectors of one length, and of one group if `group` names a column, meet. Null, empty and zero vectors, those with components that aren't finite,
    and null ids are in no class; rows with equal ids are in the classes of their vectors. The threshold must be above 0.

    Exact: unit vectors meet if they are within sqrt(2 - 2 * threshold) of each other. Each is at home with its nearest pivot and is a guest in the cells that can hold
    such a neighbour. A cell's members are dealt into chunks, and each chunk is a key of its own, so a cell that holds most
    vectors is many tasks. Where vectors form clusters there is a pivot for every BLOCK vectors, and a vector is copied to a few cells. Where
    no bound prunes, chunks are about two for each core, so a vector's copies don't grow with the table until a chunk would exceed HELD
    numbers; beyond that they grow as the table over HELD. The driver holds MOST_PIVOTS vectors of each length at most, and as many to try them.
    """
    if not 0 < threshold <= 1:
        raise ValueError("a threshold above 0, and 1 at most")
    spark = rows.sparkSession
    g = F.lit("") if group is None else F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = rows.select(g.alias("g"), F.col("id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("embedding")).where("id is not null and size(embedding) > 0").where(F.coalesce(finite, F.lit(False)))
    good = good.where(F.exists("embedding", lambda x: x != 0)).withColumn("embedding", F.transform("embedding", lambda x: F.when(x == 0, 0.0).otherwise(x)))
    named = saved(good.groupBy("g", "embedding").agg(F.min("id").alias("id")), "classes")
    members = good.join(named.withColumnRenamed("id", "class_id"), ["g", "embedding"]).select(_group(group), "id", "class_id")
    size = F.size("embedding")
    lengths = {r["n"]: r["count"] for r in named.groupBy(size.alias("n")).count().collect()}  # a row for each length
    reach = float(np.sqrt(2 - 2 * threshold))
    pivots, rows_of = {}, {}
    for n, count in lengths.items():
        few = max(1, min(2 * spark.sparkContext.defaultParallelism, -(-count // BLOCK)), -(-count * n // HELD))
        rows_of[n] = max(1, min(-(-2 * count // few), HELD // n))  # twice a cell of mean size
        chosen = named.where(size == n).orderBy(F.xxhash64("embedding"), "embedding").select("embedding").limit(max(1, min(2 * MOST_PIVOTS, count // BLOCK * 2))).collect()
        pivots[n] = chosen_pivots(_unit([r["embedding"] for r in chosen]), min(few, MOST_PIVOTS), min(MOST_PIVOTS, max(1, count // BLOCK)), reach)
    homed = saved(named.select("g", "id", "embedding").mapInArrow(_homed(spark.sparkContext.broadcast(pivots), reach), HOMED_DDL), "homed")
    held = F.element_at(F.create_map(*[F.lit(x) for n in (rows_of or {0: 1}).items() for x in n]), F.col("size"))
    chunks = homed.groupBy("g", "size", F.col("home").alias("cell")).agg(F.ceil(F.count("*") / held).cast("int").alias("chunks"))
    at_home = homed.withColumn("cell", F.col("home")).join(chunks, ["g", "size", "cell"])
    at_home = at_home.select("g", "size", "cell", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int").alias("chunk"), F.lit(False).alias("guest"), "id", "home", "embedding")
    guests = homed.withColumn("cell", F.explode("cells")).join(chunks, ["g", "size", "cell"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    every = at_home.unionByName(guests.select("g", "size", "cell", "chunk", F.lit(True).alias("guest"), "id", "home", "embedding"))
    key = ["g", "size", "cell", "chunk"]
    pairs = every.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *key).sortWithinPartitions(*key, "guest").mapInArrow(_compared(threshold), PAIRS_DDL)
    return members, pairs.select(_group(group), "a", "b", "similarity")


def _group(group: str | None):
    return F.when(F.col("g") != "", F.substring("g", 2, 1 << 30)).alias(group or "group")


def similar_questions(rows: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(paper, a, b, similarity) of a paper's questions (paper, number, id, embedding) with different numbers whose vectors' cosine is at least the threshold.

    Classes are joined, then written out as pairs of questions, as a paper's report lists them.
    """
    own = rows.withColumn("_paper", F.to_json(F.struct("paper")))
    members, pairs = similar_vectors(own.select("_paper", "id", "embedding"), threshold, "_paper")
    told = rows.select(F.to_json(F.struct("paper")).alias("_paper"), "paper", "id", "number").dropDuplicates(["_paper", "id"])
    each = members.join(told, ["_paper", "id"]).select("paper", "_paper", "class_id", "id", "number")
    same = members.select("_paper", F.col("class_id").alias("a"), F.col("class_id").alias("b"), F.lit(1.0).alias("similarity")).groupBy("_paper", "a", "b", "similarity").count().where("count > 1").drop("count")
    left = each.select("paper", "_paper", F.col("class_id").alias("a"), F.col("id").alias("x"), F.col("number").alias("number_x"))
    right = each.select("_paper", F.col("class_id").alias("b"), F.col("id").alias("y"), F.col("number").alias("number_y"))
    found = pairs.unionByName(same).join(left, ["_paper", "a"]).join(right, ["_paper", "b"]).where("number_x <> number_y and (a <> b or x < y)")
    return found.select("paper", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "similarity")
