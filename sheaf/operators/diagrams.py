"""Diagrams: references in texts, annotations of images, ranks of legacy images, and what a paper's questions get of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaf.functions.text import described_options, image_caption, image_refs, mentions_diagram


def detect(questions: DataFrame) -> DataFrame:
    return questions.withColumn("has_diagram", F.coalesce("has_diagram", F.lit(False)) | mentions_diagram("text"))


def references(rows: DataFrame) -> DataFrame:
    """(id, text): each image reference with its place, label and caption."""
    refs = rows.select("id", "text", F.posexplode(image_refs("text")).alias("place", "ref"))
    return refs.select("id", "place", "ref.label", "ref.filename", image_caption("text", F.col("ref.filename")).alias("caption"))


def referenced_images(rows: DataFrame, images: DataFrame) -> DataFrame:
    return references(rows).join(images.select(F.col("image_id").alias("filename"), "content"), "filename")


def annotated(questions: DataFrame, annotations: DataFrame) -> DataFrame:
    """Diagrams of annotations (paper, image_id, type, description, relates_to) with their questions, in order of image id."""
    rows = annotations.where(F.col("type").isin("diagram", "figure")).groupBy("paper", F.col("relates_to").alias("number")).agg(F.array_sort(F.collect_list(F.struct("image_id", "description"))).alias("diagrams"))
    return questions.join(rows, ["paper", "number"], "left")


def filled_options(questions: DataFrame) -> DataFrame:
    """Options of questions with a diagram and none of their own, from the diagrams' descriptions."""
    found = F.filter(F.transform("diagrams", lambda d: described_options(d["description"])), lambda o: o.isNotNull())
    return questions.withColumn("options", F.when(F.col("has_diagram") & (F.size("options") == 0), F.coalesce(F.get(found, F.lit(0)), F.col("options"))).otherwise(F.col("options")))


def legacy(questions: DataFrame, images: DataFrame) -> DataFrame:
    """The k-th question with a diagram gets the k-th image of its paper."""
    rank = lambda d, order: d.withColumn("k", F.row_number().over(Window.partitionBy("paper").orderBy(order)))
    return rank(questions.where("has_diagram"), "pos").join(rank(images, "page").select("paper", "k", "image_id"), ["paper", "k"], "left").drop("k")


def file_name(subject: str, number: str, image: str):
    return F.concat(F.lit("diagrams/"), F.col(subject), F.lit("/q"), F.format_string("%03d", F.col(number).cast("long")), F.lit("-"), F.col(image))


DIAGRAM = "struct<file: string, label: string, caption: string>"


def caption_label(text: str, image: str) -> Column:
    """What the text calls an image: from "Figure 3" or the like up to its reference, or null."""
    pattern = F.concat(F.lit(r"(?i)(Figure|Fig\.?|Diagram|Diag\.?)\s*(\d+)[^!]*!\[[^\]]*\]\(\Q"), F.col(image), F.lit(r"\E\)"))
    return F.nullif(F.call_function("regexp_extract", F.col(text), pattern, F.lit(0)), F.lit(""))


def attached(questions: DataFrame, images: DataFrame, annotations: DataFrame | None = None) -> DataFrame:
    """questions (paper, pos, number, subject, text, options, has_diagram) with `diagrams`, an array of (file, label, caption), and `diagram_file`, the first one's.

    A text that speaks of a figure promises a diagram. With annotations (paper, place, image_id, type, description, relates_to) such a question gets
    the images that are annotated as its diagrams and figures, or, if none are, those that its text refers to; images that the paper
    (images: paper, image_id, page) doesn't have are left out, and a question with a diagram and an empty array of options takes options from the
    descriptions. Without annotations the k-th such question of a paper gets its k-th image by page. Questions without a number get none.
    """
    rows = detect(questions)
    asking = rows.where("has_diagram and number <> 0").select("paper", "pos", "number", F.coalesce("subject", F.lit("unknown")).alias("_subject"), "text")
    own = images.select("paper", "image_id").distinct()
    name = lambda image: F.concat(F.lit("diagrams/"), "_subject", F.lit("/q"), F.lpad(F.col("number").cast("string"), F.greatest(F.lit(3), F.char_length(F.col("number").cast("string"))), F.lit("0")), F.lit("-"), image)
    if annotations is None:
        ranked = legacy(asking.withColumn("has_diagram", F.lit(True)), images.select("paper", "page", "image_id")).where("image_id is not null")
        found = ranked.select("paper", "pos", F.lit(0).alias("place"), name(F.lit("fig1.png")).alias("file"), F.lit("fig. 1").alias("label"), F.lit(None).cast("string").alias("caption"))
        described = None
    else:
        notes = annotations.where(F.col("type").isin("diagram", "figure") & (F.col("relates_to") != 0)).select("paper", F.col("relates_to").alias("number"), "place", "image_id", F.nullif("description", F.lit("")).alias("description"))
        noted = asking.join(notes, ["paper", "number"]).join(own, ["paper", "image_id"]).select("paper", "pos", "place", name(F.col("image_id")).alias("file"), F.col("description").alias("label"), F.col("description").alias("caption"))
        spoken = asking.join(notes.select("paper", "number").distinct(), ["paper", "number"], "left_anti")
        refs = spoken.select("*", F.posexplode(image_refs("text")).alias("place", "ref")).withColumn("image_id", F.col("ref.filename")).join(own, ["paper", "image_id"])
        refs = refs.select("paper", "pos", "place", name(F.col("image_id")).alias("file"), F.coalesce(caption_label("text", "image_id"), "ref.label").alias("label"), image_caption("text", F.col("image_id")).alias("caption"))
        found = noted.unionByName(refs)
        words = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "image_id", "description"))), lambda n: n["description"]), " ")
        described = notes.groupBy("paper", "number").agg(words.alias("_described"))
    each = found.groupBy("paper", "pos").agg(F.array_sort(F.collect_list(F.struct("place", "file", "label", "caption"))).alias("_found"))
    numbered = F.transform("_found", lambda d, k: F.struct(d["file"].alias("file"), (F.coalesce(d["label"], F.concat(F.lit("fig. "), (k + 1).cast("string"))) if annotations is not None else d["label"]).alias("label"), d["caption"].alias("caption")))
    out = rows.join(each, ["paper", "pos"], "left").withColumn("diagrams", numbered.cast(f"array<{DIAGRAM}>")).drop("_found")
    if described is not None:
        out = out.join(described, ["paper", "number"], "left")
        options = F.when(F.col("has_diagram") & (F.size("options") == 0) & (F.col("_described") != ""), described_options("_described"))
        out = out.withColumn("options", F.coalesce(options, "options")).drop("_described")
    return out.select(*questions.columns, "diagrams", F.get("diagrams", F.lit(0))["file"].alias("diagram_file"))
