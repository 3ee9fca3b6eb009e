"""The corpus pipeline: five stages over the documents, each on all that its predecessor kept.

Quality rules reject documents; of near duplicates (five-word shingles, likeness of 0.8 or more) one of each group stays;
repeated 100-byte strings are cut out of the texts; secrets are replaced by a mark; the last stage packs token sequences.

Every decision is taken for a row and applied to that row: no stage joins by doc_id, so rows that share an id or have none are
neither lost nor spared for another's sake. Each stage states what it does with them; an empty table gives no rows in all of them, a
null text counts as empty (and stays null until it is cut or packed), and columns other than those of documents are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm.common import mark, prepare, release, table, to_batch, written
from sheaf.llm.near_duplicates import without_near_duplicates
from sheaf.llm.packing import pack
from sheaf.llm.quality_rules import without_rejected
from sheaf.llm.secrets import redact
from sheaf.llm.suffix_dedup import repeated_bytes
from sheaf.llm.tokens import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go: each row by its own text and host. Null and empty texts have too few words. A null source is a host."""
    return without_rejected(docs.select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the smallest id, with all rows of the group that carry it; of groups without any id one row. Texts without words stay."""
    return without_near_duplicates(docs.select(*COLUMNS), percent=80, tables=10)


def _decoded(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = dict(zip(b.schema.names, b.columns, strict=True))
            rows["text"] = [x.decode("utf-8", "ignore") for x in rows["text"].to_pylist()]
            yield to_batch(rows, schema)

    return run


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated strings go, all rows stay with their other columns; n_chars is counted anew. Bytes of a character that was cut in part go with it. A text that is cut to nothing stays as an empty one, and so does a null text. Rows with equal ids and texts are one document."""
    cut = repeated_bytes(docs, with_bytes=True, carry=("lang", "source")).select("doc_id", F.col("kept").alias("text"), "lang", "source")
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string())])
    return cut.mapInArrow(_decoded(schema), "doc_id long, text string, lang string, source string").withColumn("n_chars", F.char_length("text").cast("long"))


def _redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        k = b.schema.get_field_index("text")
        texts = [None if t is None else redact(t) for t in b.column(k).to_pylist()]
        yield b.set_column(k, "text", pa.array(texts, pa.string()))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a mark; all rows stay, null texts as null, and n_chars is counted anew."""
    prepare(spark)
    clean = docs.select(*COLUMNS).mapInArrow(_redacted, docs.select(*COLUMNS).schema)
    return clean.withColumn("n_chars", F.char_length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each row; an empty or null text is one piece, the end id."""
    return pack(docs, tokenizer_path())


STAGES = [("quality_rules", quality), ("minhash_near_dedup", near_dedup), ("suffix_array_dedup", suffix_dedup), ("secret_scans", secrets), ("best_fit_packing", packing)]

#: Near duplicates, byte strings and tokens are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again, and what was written before it is deleted then."""
    docs, before = table(spark, sf_dir, "documents"), mark(spark)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        release(spark, since=before, keep=1)
    return STAGES[-1][1](spark, docs, sf_dir)
