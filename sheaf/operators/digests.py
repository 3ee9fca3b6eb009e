"""Catalogues as digest trees: root, exam, year, shift, files.

A node's digest is made of sums over the digests of its files, four lanes modulo 2**60 each, so a node is an aggregate that is combined before the
shuffle, however many files lie below it, and the tree is one rollup. Two catalogues are compared from the root down: a branch whose
digests agree is left, and of the files only those of changed shifts are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.operators.stages import saved

LEVELS = ("exam", "year", "shift")
LANES = 4
TOP = 1 << 60


def _lane(k: int) -> Column:
    """15 hex digits of the file's own digest, as a number below 2**60."""
    return F.conv(F.substring("_sum", 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)")


def tree(files: DataFrame) -> DataFrame:
    """files (exam, year, shift, file, digest) to nodes (level, exam, year, shift, files, digest): level 0 is the root, 3 a shift.

    Equal files count as often as they occur. Null names are names like others; a null digest is one too.
    """
    told = F.concat_ws("\x02", *[F.coalesce(F.col(c).cast("string"), F.lit("\x01")) for c in (*LEVELS, "file", "digest")])
    rows = files.select(*[F.coalesce(F.col(c).cast("string"), F.lit("\x01")).alias(c) for c in LEVELS], F.sha2(told, 256).alias("_sum"))
    sums = [(F.sum(_lane(k)) % TOP).alias(f"_{k}") for k in range(LANES)]
    nodes = rows.rollup(*LEVELS).agg(F.count("*").alias("files"), *sums)
    digest = F.sha2(F.concat_ws(",", F.col("files").cast("string"), *[F.coalesce(F.col(f"_{k}").cast("string"), F.lit("")) for k in range(LANES)]), 256)
    level = F.size(F.array_compact(F.array(*LEVELS)))
    name = lambda c: F.when(F.col(c) != "\x01", F.col(c))
    return nodes.select(level.alias("level"), *LEVELS, "files", digest.alias("digest")).select("level", *[F.struct(F.col(c).isNotNull().alias("here"), name(c).alias("name")).alias(c) for c in LEVELS], "files", "digest")


class Catalogue:
    """A version of a catalogue in a folder: its nodes by level, and its files by exam and year."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @staticmethod
    def write(files: DataFrame, root: str) -> Catalogue:
        files = files.select(*[F.col(c).cast("string").alias(c) for c in LEVELS], F.col("file").cast("string").alias("file"), F.col("digest").cast("string").alias("digest"))
        own = Catalogue(files.sparkSession, root)
        branch = [F.coalesce(c, F.lit("\x01")) for c in ("exam", "year")]
        files.withColumns({"_exam": F.sha1(branch[0]), "_year": F.sha1(branch[1])}).write.partitionBy("_exam", "_year").parquet(f"{own.root}/files")
        tree(files).write.partitionBy("level").parquet(f"{own.root}/nodes")
        return own

    def nodes(self, level: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/nodes").where(F.col("level") == level).drop("level")

    def files(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/files")


FEW = 100_000  # branches that are sent to all readers


def changed_branches(old: Catalogue, new: Catalogue) -> list[DataFrame]:
    """For each level the nodes (exam, year, shift, change) that differ: changed, added or removed. A level is read below changed nodes of the one above only."""
    out: list[DataFrame] = []
    above = None
    for level in range(len(LEVELS) + 1):
        keys = list(LEVELS[:level])
        a, b = old.nodes(level), new.nodes(level)
        if above is not None:
            a, b = (d.join(_hint(above), list(LEVELS[: level - 1]), "left_semi") if level > 1 else d for d in (a, b))
        a, b = (d.select(*keys, F.col("digest").alias(name)) for d, name in ((a, "old"), (b, "new")))
        both = a.join(b, keys, "full") if keys else a.crossJoin(b)  # a root each
        kind = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("changed")
        above = saved(both.where(~F.col("old").eqNullSafe(F.col("new"))).select(*keys, kind.alias("change")), "branches")
        out.append(above)
        if above.isEmpty():
            break
    return out


def _hint(branches: DataFrame) -> DataFrame:
    return F.broadcast(branches) if branches.limit(FEW + 1).count() <= FEW else branches


def differences(old: Catalogue, new: Catalogue) -> DataFrame:
    """(exam, year, shift, file, change) of files that were changed, added or removed. Files of branches that agree aren't read."""
    levels = changed_branches(old, new)
    if len(levels) <= len(LEVELS):
        return old.files().select(*LEVELS, "file", F.lit("").alias("change")).limit(0)
    branches = levels[-1].select(*[F.col(c)["name"].alias(f"_{c}") for c in LEVELS])
    folders = branches.select(F.sha1(F.coalesce("_exam", F.lit("\x01"))).alias("e"), F.sha1(F.coalesce("_year", F.lit("\x01"))).alias("y")).distinct()

    def read(catalogue: Catalogue, name: str) -> DataFrame:
        rows = catalogue.files()
        rows = rows.join(_hint(folders), (rows["_exam"] == folders["e"]) & (rows["_year"] == folders["y"]), "left_semi")  # leaves other folders unread
        same = [F.col(c).eqNullSafe(F.col(f"_{c}x")) for c in LEVELS]
        wanted = branches.select(*[F.col(f"_{c}").alias(f"_{c}x") for c in LEVELS])
        rows = rows.drop("_exam", "_year").join(_hint(wanted), same[0] & same[1] & same[2], "left_semi")
        key = F.struct(F.lit(name).alias("version"), F.col("digest").alias("digest"))
        return rows.select(*LEVELS, "file", key.alias("_v"))

    every = read(old, "old").unionByName(read(new, "new")).groupBy(*LEVELS, "file", "_v").agg(F.count("*").alias("_n"))
    versions = lambda v: F.array_sort(F.collect_set(F.when(F.col("_v.version") == v, F.struct(F.col("_v.digest").alias("d"), F.col("_n").alias("n")))))
    files = every.groupBy(*LEVELS, "file").agg(versions("old").alias("o"), versions("new").alias("n"))
    kind = F.when(F.size("o") == 0, "added").when(F.size("n") == 0, "removed").otherwise("changed")
    return files.where("o <> n").select(*LEVELS, "file", kind.alias("change"))


def index(files: DataFrame, questions: DataFrame) -> DataFrame:
    """The catalogue's index: (key, exam, year, shift, total, subjects, checksum) of each paper (questions: exam, year, shift, subject), with its branch's digest; key is exam/year/shift, or exam/year without a shift."""
    nodes = tree(files).where("level = 3").select(*[F.col(c)["name"].alias(c) for c in LEVELS], F.col("digest").alias("checksum"))
    sums = questions.groupBy(*LEVELS).agg(F.count("*").alias("total"), F.array_sort(F.collect_set("subject")).alias("subjects"))
    sums = sums.select(*[F.col(c).cast("string").alias(f"_{c}") for c in LEVELS], "total", "subjects")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in LEVELS]
    return nodes.join(sums, same[0] & same[1] & same[2], "left").select(F.concat_ws("/", *LEVELS).alias("key"), *LEVELS, F.coalesce("total", F.lit(0)).alias("total"), "subjects", "checksum")
