"""Repair of extracted questions, review edits, papers as nested documents, and the run from raw answers to documents."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheaf.functions.text import has_answer_key, repair_options
from sheaf.operators import chunks, consensus, diagrams, listing, merge, normalize, rules
from sheaf.operators.stages import keep_all, saved
from sheaf.sources import providers, readers


def auto_repair(questions: DataFrame, key_answers: DataFrame, again: DataFrame, each: bool = False) -> tuple[DataFrame, DataFrame]:
    """Questions after one round of repairs, and the errors that are left.

    key_answers: (paper, pos, number, answer) read again from each paper's last pages; again: questions of a second extraction, with the same
    columns. A paper with too few or too many questions takes the second extraction if it has more. If an answer is missing, all
    answers read again go in, each to the first question of its number. A wrong number of options is repaired by splitting.
    With `each` both reach every question of the number, and a split helps all numbers that stand at the split question's place.
    What could not be tried or didn't help stays an error; a missing answer counts as tried if anything was read again.
    """
    errors = saved(rules.extraction_errors(questions), "errors")
    marks = errors.groupBy("paper").agg(F.bool_or(F.col("error") == "wrong_question_count").alias("miscounted"), F.bool_or(F.col("error") == "missing_answer").alias("unanswered"))
    longer = again.groupBy("paper").agg(F.count("*").alias("n_again")).join(questions.groupBy("paper").agg(F.count("*").alias("n")), "paper").where("n_again > n").join(marks.where("miscounted"), "paper", "left_semi").select("paper")
    working = questions.join(longer, "paper", "left_anti").unionByName(again.join(longer, "paper", "left_semi"))
    nth = F.lit(1) if each else F.row_number().over(Window.partitionBy("paper", "number").orderBy("pos"))
    good = key_answers.where(F.coalesce("answer", F.lit("")) != "").groupBy("paper", "number").agg(F.max_by("answer", "pos").alias("key_answer"))
    split = errors.where("error = 'invalid_option_count'").select("paper", "number", F.lit(True).alias("split")).distinct()
    working = working.withColumn("nth", nth).join(good, ["paper", "number"], "left").join(split, ["paper", "number"], "left").join(marks.select("paper", "unanswered"), "paper", "left")
    fixed = repair_options("options")
    better = (F.col("nth") == 1) & F.col("split") & (F.size("options") > 0) & (F.size(fixed) > F.size("options"))
    restored = (F.col("nth") == 1) & F.col("unanswered") & F.col("key_answer").isNotNull()
    working = working.withColumns({"options_repaired": F.coalesce(better, F.lit(False)), "answer_restored": F.coalesce(restored, F.lit(False))})
    working = working.withColumns({"options": F.when(F.col("options_repaired"), fixed).otherwise(F.col("options")), "answer": F.when(F.col("answer_restored"), F.col("key_answer")).otherwise(F.col("answer"))})
    tried = key_answers.select("paper").distinct().withColumn("done", F.lit("missing_answer")).unionByName(longer.withColumn("done", F.lit("wrong_question_count")))
    left = errors.join(tried, (errors["paper"] == tried["paper"]) & (F.col("error") == F.col("done")), "left_anti")
    helped = working.where("options_repaired")
    if each:
        helped = working.join(helped.select("paper", "pos").distinct(), ["paper", "pos"], "left_semi")
    helped = helped.select("paper", "number", F.lit("invalid_option_count").alias("error")).distinct()
    return working.select(*questions.columns, "options_repaired", "answer_restored"), left.join(helped, ["paper", "number", "error"], "left_anti")


def applied_edits(questions: DataFrame, edits: DataFrame) -> DataFrame:
    """Review edits put into the rows: edits (paper, number, seq, field, value); the last value of each field counts.

    Only text columns can be edited; a field that the questions don't have is left out, an edit of a number that isn't there too.
    """
    fields = [f for f, kind in questions.dtypes if kind == "string" and f not in ("paper", "number")]
    last = edits.where(F.col("field").isin(fields)).groupBy("paper", "number").pivot("field", fields).agg(F.max_by(F.struct("value"), "seq"))
    named = last.select(F.col("paper").alias("_p"), F.col("number").alias("_n"), *[F.col(f"`{f}`").alias(f"_{f}") for f in fields])
    joined = questions.join(named, F.col("paper").eqNullSafe(F.col("_p")) & F.col("number").eqNullSafe(F.col("_n")), "left")
    return joined.withColumns({f: F.when(F.col(f"_{f}").isNotNull(), F.col(f"_{f}.value")).otherwise(F.col(f)) for f in fields}).select(*questions.columns)


def constant_fixes(questions: DataFrame, fixes: dict[str, object]) -> DataFrame:
    """The same value put into a column of all rows, as a reviewer's fix for a chunk; unknown columns are left out."""
    return questions.withColumns({c: F.lit(v).cast(questions.schema[c].dataType) for c, v in fixes.items() if c in questions.columns})


def first_seen(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of each key the row of the first chunk that has it."""
    names = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*names), F.struct(*order)).alias("r")).select(*keys, "r.*")


#: Fixed values of a published paper's header.
SCHEMA_VERSION, LICENSE, PIPELINE_VERSION = "v4", "GPLv3 OR Commercial", "1.0.0"
NULL_MARK, FIELD_MARK = "\x01", "\x02"


def row_checksum(columns: list[str]) -> Column:
    """SHA-256 of a row's values as text, in this order; null and empty differ."""
    return F.sha2(F.concat_ws(FIELD_MARK, *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in columns]), 256)


PART = 100  # places of a document whose questions are put together at once; a task holds at most 128 unfinished parts


def paper_documents(questions: DataFrame, headers: DataFrame, passages: DataFrame | None = None, generated_at: str = "1970-01-01T00:00:00.000Z") -> DataFrame:
    """One nested document for each paper and one for each of its subjects: header, provenance, questions, passages, checksum.

    questions: (exam, year, shift, subject, pos, ...); headers: (exam, year, shift, answer_key_found, ...); passages: (exam, year, shift, id, ...). A
    document's checksum is that of its questions' checksums in order, after its header's. In subject documents numbers start from 1.
    `path` is where it belongs. A paper's questions come together in one row: they are as many as an exam has. A longer document is put together
    from parts of PART places, so that its task holds its bytes and not an object for each value.
    """
    key = ["exam", "year", "shift"]
    fields = [c for c in questions.columns if c not in (*key, "number")]
    plain = [c for c in sorted(fields) if not questions.schema[c].dataType.simpleString().startswith(("array", "struct", "map"))]
    nested = [c for c in sorted(fields) if c not in plain]
    rows = questions.withColumns({f"_{c}": F.to_json(F.struct(c)) for c in nested})
    by_subject = F.row_number().over(Window.partitionBy(*key, "subject").orderBy("pos")).cast(questions.schema["number"].dataType)
    rows = rows.withColumn("_subject_number", by_subject)
    # A question goes into its paper's document and into its subject's.
    rows = rows.withColumn("part", F.explode(F.array(F.struct(F.lit("paper").alias("document"), F.col("number").alias("number")), F.struct(F.col("subject").alias("document"), F.col("_subject_number").alias("number")))))
    rows = rows.withColumn("document", F.col("part.document")).withColumn("number", F.col("part.number"))
    rows = rows.withColumn("_sum", row_checksum(["number", *plain, *[f"_{c}" for c in nested]]))
    parts = rows.withColumn("_part", F.floor(F.col("pos") / PART)).groupBy(*key, "document", "_part").agg(F.array_sort(F.collect_list(F.struct("pos", "number", "_sum", *[c for c in fields if c != "pos"]))).alias("_rows"), F.collect_set("subject").alias("subjects"))
    part = F.struct("_part", F.transform("_rows", lambda q: q.dropFields("_sum")).alias("questions"), F.array_join(F.transform("_rows", lambda q: q["_sum"]), "").alias("sums"), "subjects")
    # A number of partitions that is asked for stays: adaptive execution would put many documents into one task.
    parts = parts.select(*key, "document", part.alias("part"), F.size("_rows").alias("n")).repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key, "document")
    grouped = parts.groupBy(*key, "document").agg(F.array_sort(F.collect_list("part")).alias("parts"), F.sum("n").cast("int").alias("total"))
    of_parts = lambda c: F.transform("parts", lambda p: p[c])
    if passages is not None:
        inner = [c for c in passages.columns if c not in key]
        held = passages.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(*inner))).alias("passages"))
        grouped = grouped.join(held, key, "left")
    head = [c for c in headers.columns if c not in key]
    out = grouped.join(headers, key, "left")
    folder = F.when(F.col("exam") == "ncert-exemplar", F.concat(F.lit("class-"), F.col("year").cast("string"))).otherwise(F.concat_ws("/", F.coalesce(F.col("year").cast("string"), F.lit("unknown")), F.nullif("shift", F.lit(""))))
    path = F.concat(F.concat_ws("/", "exam", folder, "document"), F.lit(".json"))
    checksum = F.sha2(F.concat_ws(FIELD_MARK, row_checksum([*key, "document", "total", *sorted(head)]), F.array_join(of_parts("sums"), "")), 256)
    provenance = F.struct(F.lit("").alias("author"), F.lit("").alias("repo"), F.lit(LICENSE).alias("license"), F.lit(PIPELINE_VERSION).alias("pipelineVersion"), F.lit(generated_at).alias("generatedAt"))
    subjects = F.array_sort(F.array_distinct(F.flatten(of_parts("subjects")))).alias("subjects")
    return out.select(path.alias("path"), F.lit(SCHEMA_VERSION).alias("schema"), *key, "document", subjects, "total", *head, F.lit(generated_at).alias("scrapedAt"), provenance.alias("provenance"), F.flatten(of_parts("questions")).alias("questions"), *(["passages"] if passages is not None else []), checksum.alias("checksum"))


def write_documents(documents: DataFrame, folder: str) -> DataFrame:
    """Each document as a JSON file of its own at folder/path; returns (path, bytes)."""
    body = F.to_json(F.struct(*[c for c in documents.columns if c not in ("path", "document")]))
    return write_files(documents.select("path", body.cast("binary").alias("content")), folder)


def write_files(files: DataFrame, folder: str) -> DataFrame:
    """(path, content): a file for each row at folder/path; returns (path, bytes). A task that runs again writes the same files."""
    schema = pa.schema([("path", pa.string()), ("bytes", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        for b in batches:
            sizes = []
            for path, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                store.create_dir(f"{base}/{path.rpartition('/')[0]}", recursive=True)
                with store.open_output_stream(f"{base}/{path}") as f:
                    f.write(raw)
                sizes.append(len(raw))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64())], schema=schema)

    return files.select("path", F.col("content").cast("binary")).mapInArrow(write, "path string, bytes long")


def reports(html_rows: DataFrame) -> DataFrame:
    """(path, content) of one HTML page for each paper from compare.html_rows (paper, place, html)."""
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "html"))), lambda r: r["html"]), "\n")
    page = F.concat(F.lit("<!doctype html>\n<meta charset='utf-8'>\n<table>\n"), body, F.lit("\n</table>\n"))
    return html_rows.groupBy("paper").agg(page.alias("page")).select(F.concat("paper", F.lit("/report.html")).alias("path"), F.col("page").cast("binary").alias("content"))


def hashed_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, computed) of every file below a folder: the SHA-256 of what is in it, for state.integrity."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", F.sha2("content", 256).alias("computed"))


CANDIDATE_TEXTS = ("text", "answer", "topic", "subject", "type")


def distributed_extraction(pages: DataFrame, recording: DataFrame, names: list[str]) -> DataFrame:
    """Questions of papers whose chunks are dealt out to several extractors: (paper, page, n_pages, markdown) by recorded answers.

    Each chunk goes to one extractor; what they say about the pages that chunks share is folded by number, without a vote, and blank
    answers are filled from chunks in which an answer key was found.
    """
    texts = chunks.chunk_markdown(chunks.page_chunks(pages)).select("paper", "chunk_index", "markdown")
    dealt = chunks.round_robin(texts, names)
    prompts = dealt.select(F.struct("paper", "chunk_index", has_answer_key("markdown").alias("key_found")).alias("key"), "provider", F.col("markdown").alias("prompt"))
    got = providers.Recorded(recording).answers(prompts).where("ok")
    rows = readers.parse_responses(got.withColumn("key_found", F.col("key.key_found")))
    rows = rows.select("key.paper", "key.chunk_index", "pos", "number", *CANDIDATE_TEXTS, F.to_json("options").alias("options"), F.lit(None).cast("string").alias("section"), "marks", F.col("key_found").alias("answer_key_found"))
    n = F.size(F.from_json("options", "array<string>"))
    full = merge.completeness(F.col("text"), F.col("subject"), F.col("type"), F.col("answer"), F.when(F.col("options").isNotNull(), n), F.col("topic"), F.col("section"), F.col("marks"))
    rows = saved(rows.withColumn("full", full), "candidates")
    return merge.backfill(merge.merge_chunks(rows), merge.answer_key(rows))


DETAILS = ("answers", "tags", "solution", "solution_format", "difficulty", "number_label", "passage_id", "has_diagram", "section")


def curate(
    raw: DataFrame,
    headers: DataFrame,
    aliases: DataFrame,
    tags: DataFrame,
    key_answers: DataFrame | None = None,
    again: DataFrame | None = None,
    images: DataFrame | None = None,
    annotations: DataFrame | None = None,
    keep: Callable[[str, Callable[[], DataFrame]], DataFrame] = keep_all,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From extractors' raw answers to papers: documents, flags of the validation rules, errors that are left.

    raw: (key, provider, rank, raw, key_found), key being a paper as exam/year/shift; headers: (exam, year, shift, answer_key_found, ...); images: (paper, image_id, page);
    annotations: as in diagrams.attached. Answers are parsed, voted on by number, repaired, normalised, given topics, sections and ids, their
    diagrams and passages, validated, and nested. What isn't voted on comes from the first provider that has the question, a passage from the first that has it.

    `keep` takes each stage's name and how to make its rows. With StageCache.stage a run that was stopped goes on at the stage that it had not finished.
    """
    named = raw.withColumn("key", F.struct("key", "provider", "rank"))
    parsed = readers.parse_responses(named)
    votes = parsed.select(F.col("key.key").alias("paper"), F.col("key.provider").alias("provider"), F.col("key.rank").alias("rank"), "number", "text", F.to_json("options").alias("options"), "answer", "subject")
    voted = consensus.consensus(votes).select("paper", "number", "text", F.from_json("options", "array<string>").alias("options"), "answer", "subject", F.when(F.col("confidence") == "high", F.lit(None)).otherwise(F.col("confidence")).alias("confidence"))
    more = first_seen(parsed.select(F.col("key.key").alias("paper"), F.col("key.rank").alias("rank"), "pos", "number", "type", "topic", "marks", *DETAILS), ["paper", "number"], ["rank", "pos"]).drop("rank", "pos")
    part = lambda k: F.nullif(F.get(F.split("paper", "/"), F.lit(k)), F.lit(""))
    rows = voted.join(more, ["paper", "number"], "left").withColumns({"exam": part(0), "year": part(1).try_cast("int"), "shift": part(2), "pos": F.col("number"), "type": F.coalesce("type", F.lit("mcq"))})
    empty = lambda d: d.limit(0)
    asked = ["paper", "exam", "year", "shift", "pos", "number", "subject", "topic", "type", "text", "options", "answer", "marks", "confidence", *DETAILS]
    rows_asked = rows.select(*asked)
    rows = keep("voted", lambda: rows_asked)  # used by each repair
    again = empty(rows) if again is None else again.select(*again.columns, *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in asked if c not in again.columns])
    repaired, left_errors = auto_repair(rows, key_answers if key_answers is not None else empty(rows.select("paper", "pos", "number", "answer")), again)
    left = keep("left", lambda: left_errors)
    normal = keep("normalised", lambda: normalize.normalize_answers(normalize.normalize_texts(repaired.drop("options_repaired", "answer_restored"))))

    def made_ready() -> DataFrame:
        topics = normalize.normalize_topics(normal, aliases, tags).withColumn("topic", F.col("topic_norm")).drop("topic_norm")
        shown = diagrams.attached(topics, images if images is not None else empty(topics.select("paper", F.lit("").alias("image_id"), F.col("pos").alias("page"))), annotations)
        return normalize.assign_ids(shown).drop("subject_number").withColumns(fixed)

    fixed = {"negative_marks": F.when(F.col("type") == "nat", 0.0).otherwise(-1.0), "revision": F.lit(1), "source": F.lit("official-pdf"), "precision_type": F.lit(None).cast("string"), "tags": F.coalesce("tags", F.array().cast("array<string>"))}
    ready = keep("ready", made_ready)  # validated and nested
    merged = lambda: consensus.merged_passages(readers.parse_passages(named).where("id is not null").select(F.col("key.key").alias("paper"), "id", F.struct("key.rank", "pos").alias("rank"), "text", "text_hi", "questions"))
    held = keep("passages", merged)
    flags = [rules.row_flags(ready), rules.duplicate_flags(ready), rules.passage_flags(ready, held), rules.tag_flags(ready, tags)]
    placed = held.withColumns({"exam": part(0), "year": part(1).try_cast("int"), "shift": part(2)}).drop("paper")
    documents = keep("documents", lambda: paper_documents(ready.drop("paper"), headers, placed))
    return documents, keep("flags", lambda: reduce(DataFrame.unionByName, flags)), left


def dataset_scan(papers: DataFrame, metadata: DataFrame, flags: DataFrame) -> DataFrame:
    """A row for each paper with its verification status and the number of its errors: what a check of all datasets prints."""
    errors = flags.where("severity = 'error'").groupBy("paper").agg(F.count("*").alias("errors"))
    return with_status(papers, metadata).join(errors, "paper", "left").na.fill(0, ["errors"])


def with_status(papers: DataFrame, metadata: DataFrame) -> DataFrame:
    """papers (exam, year, shift, ...) with the status that metadata (exam, shift_key, status) has under year-shift, else unverified."""
    named = papers.withColumn("shift_key", F.concat_ws("-", F.col("year").cast("string"), F.coalesce("shift", F.lit("unknown"))))
    return named.join(metadata.select("exam", "shift_key", "status"), ["exam", "shift_key"], "left").withColumn("status", F.coalesce("status", F.lit("unverified"))).drop("shift_key")


def file_of_shift(asked: DataFrame, files: DataFrame) -> DataFrame:
    """asked (exam, year, shift) with the first scraped file (pos, exam, year, file_shift, path) whose shift is or contains the one asked for."""
    both = asked.join(files, ["exam", "year"]).where(F.col("file_shift").contains(F.col("shift")))
    best = both.groupBy("exam", "year", "shift").agg(F.min_by(F.struct("file_shift", "path"), "pos").alias("f")).select("exam", "year", "shift", "f.file_shift", "f.path")
    return asked.join(best, ["exam", "year", "shift"], "left")


def available(providers: DataFrame, keys: DataFrame) -> DataFrame:
    """Providers (provider, rank) for which a key is set: keys (provider, key), a blank one counts as none."""
    return providers.join(keys.where(F.coalesce(F.trim("key"), F.lit("")) != "").select("provider").distinct(), "provider", "left_semi")


def page_sums(pages: DataFrame) -> DataFrame:
    """Pages and characters of each paper's texts."""
    return pages.groupBy("paper").agg(F.count("*").alias("n_pages"), F.sum(F.char_length(F.coalesce("markdown", F.lit("")))).alias("n_chars"))


def answer_pages(pages: DataFrame) -> DataFrame:
    """The prompt text for reading a paper's answers again: its last pages in order."""
    last = listing.last_pages(pages)
    return last.groupBy("paper").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "markdown"))), lambda p: p["markdown"]), "\n\n").alias("markdown"))
