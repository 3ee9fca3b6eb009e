"""OCR and extraction services behind one interface. There is no network here: answers come from a recording."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.operators.chunks import pages_from_content


class Provider(Protocol):
    """Answers one prompt. An exception is a failed attempt, which becomes a row."""

    name: str

    def call(self, prompt: str) -> str: ...


class Recorded:
    """Answers by a prompt's SHA-256 from recorded rows (provider, prompt_sha, raw): a join, as recordings may be large."""

    def __init__(self, recording: DataFrame):
        self.recording = recording

    def answers(self, prompts: DataFrame) -> DataFrame:
        """(key, provider, prompt): with raw and ok."""
        keyed = prompts.withColumn("prompt_sha", F.sha2("prompt", 256))
        joined = keyed.join(self.recording, ["provider", "prompt_sha"], "left")
        return joined.select("key", "provider", "raw", F.col("raw").isNotNull().alias("ok"))


def answers(prompts: DataFrame, provider: Provider, attempts: int = 3, tasks: int = 4) -> DataFrame:
    """(key, prompt) to (key, provider, raw, ok, error, attempt) by a live provider; `tasks` bounds how many calls run at once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for key, prompt in zip(frame["key"], frame["prompt"], strict=True):
                for n in range(1, attempts + 1):
                    try:
                        rows.append((key, provider.name, provider.call(prompt), True, None, n))
                        break
                    except Exception as e:  # noqa: BLE001  a failed call is data
                        if n == attempts:
                            rows.append((key, provider.name, None, False, str(e), n))
            yield pd.DataFrame(rows, columns=["key", "provider", "raw", "ok", "error", "attempt"])

    return prompts.select(F.col("key").cast("string").alias("key"), "prompt").repartition(tasks).mapInPandas(run, "key string, provider string, raw string, ok boolean, error string, attempt int")


def pages_by(provider: str, recording: DataFrame) -> DataFrame:
    """Pages (paper, page, markdown) from a named OCR service's recording: rows of pages, or items of content lists."""
    if provider == "mistral":
        return ocr_pages(recording)
    if provider == "mineru":
        return pages_from_content(recording).select("paper", (F.col("page_idx") + 1).alias("page"), "markdown")
    raise ValueError(f"no such OCR service: {provider}")


def ocr_pages(recording: DataFrame) -> DataFrame:
    """Recorded OCR rows (paper, index, markdown) to pages, numbered from 1."""
    return recording.select("paper", (F.col("index") + 1).alias("page"), "markdown")


def enhanced_flags(recording: DataFrame) -> DataFrame:
    """Whether annotations found an answer key: stated, or in an image; bad JSON counts as none."""
    stated = F.try_variant_get(F.try_parse_json("annotation"), "$.answer_key_found", "boolean")
    images = F.from_json("boxes", "struct<images:array<struct<type:string,contains_answer_key:boolean>>>")["images"]
    seen = F.exists(F.coalesce(images, F.array().cast("array<struct<type:string,contains_answer_key:boolean>>")), lambda i: F.coalesce(i["contains_answer_key"], F.lit(False)) | (F.coalesce(i["type"], F.lit("")) == "answer_key"))
    return recording.select("paper", (F.coalesce(stated, F.lit(False)) | seen).alias("answer_key_found"))
