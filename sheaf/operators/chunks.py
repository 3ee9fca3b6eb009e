"""Pages into overlapping chunks, answer-key pages, pages from content lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.text import answer_key_score


def chunk_range(i: Column, n: Column, size: int, overlap: int) -> tuple[Column, Column]:
    """First and last chunk of the page with index i of n: a formula, no join."""
    step = size - overlap
    if step < 1:
        raise ValueError("the overlap must be less than the chunk size")
    count = F.when(n <= size, F.lit(1)).otherwise(F.ceil((n - size) / F.lit(step)) + 1)
    first = F.greatest(F.lit(0), F.ceil((i - size + 1) / F.lit(step)))
    return first.cast("long"), F.least(count - 1, F.floor(i / F.lit(step))).cast("long")


def page_chunks(pages: DataFrame, size: int = 15, overlap: int = 5) -> DataFrame:
    """From (paper, page, n_pages, ...) with pages from 1 on: each page once for each of its chunks."""
    first, last = chunk_range(F.col("page") - 1, F.col("n_pages"), size, overlap)
    return pages.withColumn("chunk_index", F.explode(F.sequence(first, last)))


def chunk_markdown(chunked: DataFrame) -> DataFrame:
    """A chunk's text: its pages in order, each under a header. As long as a chunk, which is bounded."""
    part = F.concat(F.lit("--- Page "), F.col("page").cast("string"), F.lit(" ---\n\n"), F.col("markdown"))
    return chunked.groupBy("paper", "chunk_index").agg(
        F.count("*").alias("n_pages"), F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", part.alias("part")))), lambda s: s["part"]), "\n\n").alias("markdown")
    )


def round_robin(chunks: DataFrame, providers: list[str], retry: int = 0) -> DataFrame:
    names = F.array(*[F.lit(p) for p in providers])
    return chunks.withColumn("provider", F.get(names, F.pmod(F.col("chunk_index") + retry, F.lit(len(providers))).cast("int")))


def answer_key_pages(pages: DataFrame, last: int = 10, least: int = 5) -> DataFrame:
    """Pages among a paper's last ten that score as an answer key. The filter on the page number needs no window."""
    scored = pages.where(F.col("n_pages") - F.col("page") < last).withColumn("score", answer_key_score("markdown"))
    return scored.where(F.col("score") >= least)


def with_key_pages(chunked: DataFrame, keys: DataFrame) -> DataFrame:
    """Each chunk with the paper's answer-key pages added, each page once."""
    chunks = chunked.select("paper", "chunk_index").distinct()
    added = chunks.join(keys.select("paper", "page", "markdown"), "paper")
    return chunked.select("paper", "chunk_index", "page", "markdown").unionByName(added.select("paper", "chunk_index", "page", "markdown")).dropDuplicates(["paper", "chunk_index", "page"])


def merged_key(pages: DataFrame) -> DataFrame:
    """One text of a paper's key pages, joined by blank lines, as page 0 after a heading."""
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "markdown"))), lambda s: s["markdown"]), "\n\n")
    return pages.groupBy("paper").agg(F.lit(0).alias("page"), F.concat(F.lit("--- ANSWER KEY ---\n\n"), body).alias("markdown"))


def pages_from_content(items: DataFrame) -> DataFrame:
    """From content-list items (paper, page_idx, pos, type, text, text_level, img_path, caption, table_body): a page's markdown in item order; other types are dropped."""
    line = (
        F.when((F.col("type") == "text") & (F.coalesce("text_level", F.lit(0)) > 0), F.concat(F.repeat(F.lit("#"), F.col("text_level")), F.lit(" "), F.col("text")))
        .when(F.col("type") == "text", F.col("text"))
        .when(F.col("type") == "table", F.concat_ws("\n", "caption", "table_body"))
        .when(F.col("type") == "equation", F.concat(F.lit("$$"), F.col("text"), F.lit("$$")))
        .when(F.col("type") == "image", F.concat_ws("\n", F.concat(F.lit("!["), F.coalesce("caption", F.lit("")), F.lit("]("), F.col("img_path"), F.lit(")"))))
    )
    kept = items.withColumn("line", line).where("line is not null and line <> ''")
    return kept.groupBy("paper", "page_idx").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda s: s["line"]), "\n\n").alias("markdown"))


def last_image_of_page(images: DataFrame) -> DataFrame:
    return images.groupBy("paper", "page").agg(F.max_by("image_id", "pos").alias("image_id"))


def requested_pages(requests: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages by number; a missing one gives a placeholder."""
    joined = requests.join(pages.select("paper", "page", "markdown"), ["paper", "page"], "left")
    return joined.withColumn("markdown", F.coalesce("markdown", F.concat(F.lit("[page "), F.col("page").cast("string"), F.lit(" not found]"))))


