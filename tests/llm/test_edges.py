"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns: each operator gives a row for each row."""

import pytest

from sheaf.llm import fingerprints, language_id, near_duplicates, packing, pieces, quality_rules, secrets, suffix_dedup, token_counts, warc
from sheaf.llm.common import shared_folder
from sheaf.llm.tokens import tokenizer_path

LONG = " ".join(f"word{k % 977} of{k % 13}" for k in range(60_000))
BASE = "The quick brown fox jumps over the lazy dog while seven wizards quietly juggle boxes of fine black quartz and more words follow here to make it long enough."
ROWS = [(0, None, "en", "a"), (1, "", None, "a"), (2, BASE, "en", None), (2, BASE, "en", None), (3, BASE, "en", "a"), (4, " \n\t ", "de", "b"), (5, LONG, "en", "b"), (None, "no id here", None, None), (6, "ß日本🙂 \x00 é", "fr", "b"), (7, "12345 !!", "en", "c")]
EXTRA = ("part", "kind", "block", "id", "low", "key", "digest", "host", "task", "rank", "_key", "_digest", "n", "label", "node", "length", "kept")

OPERATORS = {
    "quality": quality_rules.quality_rules,
    "packing": lambda d: packing.pack(d, tokenizer_path()),
    "fingerprints": fingerprints.fingerprints,
    "tokens": lambda d: token_counts.token_counts(d, tokenizer_path()),
    "pieces_count": lambda d: token_counts.token_counts(d, tokenizer_path("piece_bpe_32k.model")),
    "secrets": secrets.secret_spans,
    "pieces": lambda d: pieces.encode_pieces(d, tokenizer_path("piece_bpe_32k.model")),
    "suffix": suffix_dedup.repeated_bytes,
    "near": near_duplicates.near_duplicates,
    "language": language_id.language_id,
}


@pytest.fixture(scope="module")
def docs(spark):
    from pyspark.sql import functions as F

    plain = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return plain.select("*", *[F.lit(7).alias(c) for c in EXTRA])


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_a_result(docs, name):
    out = [r.asDict() for r in OPERATORS[name](docs).collect()]
    ids = sorted({-1 if r["doc_id"] is None else r["doc_id"] for r in out})
    assert ids == [-1, *range(8)]
    if name != "packing":
        assert len(out) == len(ROWS)
    by = {r["doc_id"]: r for r in out}
    if name == "near":
        assert by[3]["component_id"] == 2 and not by[3]["kept"] and by[0]["component_id"] == 0 and by[1]["component_id"] == 1 and by[4]["n_shingles"] == 0
    if name == "language":
        assert by[0]["lang_pred"] == by[7]["lang_pred"] == "und" and by[7]["score"] == 0
    if name == "suffix":
        assert by[2]["n_removed"] == 0 and by[3]["n_removed"] == len(BASE) and by[0]["n_bytes"] == 0 and by[5]["n_removed"] > 0
    if name == "fingerprints":
        assert by[2]["fingerprint"] == by[3]["fingerprint"] and by[0]["fingerprint"] == by[1]["fingerprint"]
    if name == "pieces":
        assert all(r["round_trip"] for r in out)
    if name == "quality":
        assert by[0]["base_failed"] and by[0]["n_words"] == 0 and by[2]["kept"]


@pytest.mark.parametrize("name", OPERATORS)
def test_an_empty_table_gives_no_rows(docs, name):
    assert OPERATORS[name](docs.limit(0)).collect() == []


def test_warc_edges(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u\nx", "<p>é</p>"), (5, "v", "<p>é</p>"), (5, "v", "<p>é</p>"), (None, "w", "<p>é</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "7 as _key", "7 as file", "7 as offset")
    folder = shared_folder(spark, "warc")
    out = warc.read_warc(warc.write_warc(pages, folder), folder).collect()
    kinds = sorted((-1 if r.page_id is None else r.page_id, r.record_type, r.refers_to or 0, r.payload_bytes) for r in out)
    assert kinds == [(-1, "revisit", 5, 9), (1, "revisit", 2, 0), (2, "response", 0, 0), (3, "revisit", 5, 9), (5, "response", 0, 9), (5, "response", 0, 9)]
    folder = shared_folder(spark, "warc")
    assert warc.read_warc(warc.write_warc(pages.limit(0), folder), folder).collect() == []


def test_carried_columns_stay_with_their_row(docs):
    rows = docs.selectExpr("doc_id", "text", "lang", "source", "7 as more", "8 as part")
    out = suffix_dedup.repeated_bytes(rows, carry=("lang", "source", "more", "part")).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted([(r.doc_id, r.lang, r.source, r.more, r.part) for r in out], key=key) == sorted([(i, lang, source, 7, 8) for i, _, lang, source in ROWS], key=key)


def test_pipeline_stages_keep_null_and_repeated_ids(spark):
    import corpus_pipeline as p

    plain = [(i, f"Document {i} tells of {' '.join(f'w{i}x{k * k % 97 + k}' for k in range(40))} and ends here.") for i in range(6)]
    rows = [(None if i == 5 else i, t, None if i == 1 else "en", None if i == 2 else "a", len(t)) for i, t in plain]
    rows += [rows[3], (4, plain[4][1] + " With another end of its own.", "de", "b", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    key = lambda r: tuple(str(x) for x in r)
    for _, stage in p.STAGES[:4]:
        out = stage(spark, docs, "")
        assert out.columns == list(p.COLUMNS)
        assert sorted([(r.doc_id, r.lang, r.source) for r in out.collect()], key=key) == sorted([(i, lang, source) for i, _, lang, source, _ in rows], key=key)
        docs = out
    assert p.packing(spark, docs, "").count() == len(rows)
