"""Queries that must work on all documents and their whole texts."""

import hashlib

from pyspark.sql import functions as F

from sheaf.operators import consensus, merge
from sheaf.plans import catalog
from sheaf.sources.views import questions, view


def test_candidates_hold_every_document_and_its_whole_text(spark, sf):
    c, pages = view(spark, sf, "v_candidates"), view(spark, sf, "v_pages").select("doc_id", "markdown")
    assert c.count() == 3 * pages.count()
    assert pages.join(c.groupBy("doc_id").agg(F.count_distinct("provider").alias("n")), "doc_id", "left").where("not n <=> 3").count() == 0
    assert c.join(pages, "doc_id").where("not startswith(text, markdown) or length(text) > length(markdown) + 3").count() == 0
    assert c.agg(F.max(F.length("text"))).first()[0] > 1000


def test_candidates_still_have_gaps_and_one_sided_numbers(spark, sf):
    assert catalog.QUERIES["consensus_gaps"](spark, sf).count() > 0
    seen = {r.status for r in catalog.QUERIES["positional_diff"](spark, sf).select("status").distinct().collect()}
    assert seen == {"match", "diff", "missing-a", "missing-b"}


def test_chunk_rows_carry_the_whole_text(spark, sf):
    rows = catalog._chunk_rows(spark, sf).select(F.col("pos").alias("doc_id"), "text").distinct()
    pages = view(spark, sf, "v_pages").select("doc_id", F.col("markdown").alias("text"))
    assert rows.exceptAll(pages).count() == 0 and pages.exceptAll(rows).count() == 0


def test_checksums_of_papers_are_returned(spark, sf):
    q = questions(spark, sf)
    rows = q.select("exam", "year", "shift", F.to_json(F.struct(*sorted(q.columns))).alias("j")).collect()
    papers = {}
    for r in rows:
        papers.setdefault((r.exam, r.year, r.shift), []).append(hashlib.sha256(r.j.encode()).hexdigest())
    expected = {k: (len(v), hashlib.sha256("".join(sorted(v)).encode()).hexdigest()) for k, v in papers.items()}
    got = catalog.QUERIES["paper_content_checksums"](spark, sf).collect()
    assert {(r.exam, r.year, r.shift): (r.total, r.content_checksum) for r in got} == expected


def test_folds_reach_the_last_candidate(spark):
    rows = spark.range(100003, numPartitions=4).selectExpr("'p' as paper", "1 as number", "cast(id as int) as chunk_index", "0 as pos", "case when id = 100002 then 14 else 5 end as full", "'1' as answer", "'[]' as options", "'t' as topic")
    assert merge.merge_chunks(rows).first().chunk_index == 100002
    c = spark.range(1003, numPartitions=4).selectExpr("'p' as paper", "case when id = 1002 then 'poolside' else concat('other', id) end as provider", "cast(id as int) as rank", "1 as number", "'T' as text", "'[]' as options", "'1' as answer", "'physics' as subject")
    assert consensus.consensus(c).first().best_provider == "poolside"
