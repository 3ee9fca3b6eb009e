"""The query catalogue: each operator applied to the test tables, with SQL for another engine where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.functions import text as tx
from sheaf.functions.vocabulary import ANSWER_KEY_PATTERNS, CONSENSUS_KEY_PATTERNS, LATEX, OCR_LITERALS, PAGE_ANSWERS, PAGE_SIGNS, SUBJECT_TAGS, alias_rows, alias_table, tag_table
from sheaf.operators import browse, chunks, compare, consensus, diagrams, merge, normalize, rules, state
from sheaf.sources import readers
from sheaf.sources.views import for_tables, questions, view
from sheaf.streaming import events as ev

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
Query = Callable[[SparkSession, str], DataFrame]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = for_tables(sql)
        return f

    return add


def candidates_query(sql: str) -> Callable[[Callable[[DataFrame], DataFrame]], Callable[[DataFrame], DataFrame]]:
    """A query over the candidates of all documents, with their whole texts."""

    def add(f: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf: f(view(spark, sf, "v_candidates"))
        ORACLES[f.__name__] = for_tables(sql)
        return f

    return add


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# Votes of extractors


def _vote(column: str, where: str = "true") -> str:
    return f"(select paper, number, {column} from (select paper, number, {column}, row_number() over (partition by paper, number order by count(*) desc, min(rank)) as rn from c where {column} is not null and {where} group by paper, number, {column}) as x where rn = 1)"


CONSENSUS = f"""c as (select * from {{v_candidates}} as v),
best as (select paper, number, provider as best_provider, options as best_options, answer as best_answer from (select *, row_number() over (partition by paper, number order by rank) as rn from c) as x where rn = 1),
voted as (select best.*, t.text, coalesce(o.options, best_options) as options, coalesce(a.answer, '') as answer, s.subject from best left join {_vote("text")} as t using (paper, number) left join {_vote("options")} as o using (paper, number)
  left join {_vote("answer", "answer <> ''")} as a using (paper, number) left join {_vote("subject")} as s using (paper, number)),
counted as (select v.paper, v.number, v.text, v.options, v.answer, v.subject, best_provider, cast(count(*) as int) as n_providers, cast(sum(case when trim(c.text) = trim(v.text) then 1 else 0 end) as int) as text_agreement,
  cast(sum(case when c.answer <> '' then 1 else 0 end) as int) as n_answers, cast(sum(case when c.answer <> '' and c.answer = v.answer then 1 else 0 end) as int) as answer_agreement
  from voted as v join c on v.paper = c.paper and v.number = c.number group by all),
rated as (select *, case when n_answers > 0 then (text_agreement / n_providers + answer_agreement / n_answers) / 2 else text_agreement / n_providers end as a from counted),
voting as (select paper, number, text, options, answer, subject, best_provider, case when a >= 0.8 and n_providers >= 2 then 'high' when a >= 0.5 then 'medium' else 'low' end as confidence, round(a, 6) as agreement, n_providers, text_agreement, n_answers, answer_agreement from rated),
holes as (select paper, unnest(range(coalesce(before, 0) + 1, number)) as number from (select paper, number, lag(number) over (partition by paper order by number) as before from voting) as x)"""


@candidates_query(f"with {CONSENSUS} select * from voting")
def consensus_vote(c):
    return consensus.consensus(c)


@candidates_query(f"with {CONSENSUS} select paper, cast(number as bigint) as number, 'low_agreement' as reason from voting where (text_agreement < 2 and n_providers > 2) or (answer_agreement < 2 and n_answers > 2) union all select paper, number, 'missing_from_all' from holes")
def consensus_conflicts(c):
    out = consensus.conflicts(consensus.consensus(c))
    return out.withColumn("number", F.col("number").cast("long"))


@candidates_query(f"with {CONSENSUS} select paper, number from holes")
def consensus_gaps(c):
    return consensus.gaps(consensus.consensus(c))


@candidates_query(f"with {CONSENSUS} select confidence, count(*) as n, sum(case when answer = '' then 1 else 0 end)::bigint as blank from voting group by confidence")
def consensus_confidence(c):
    return consensus.consensus(c).groupBy("confidence").agg(F.count("*").alias("n"), F.count_if(F.col("answer") == "").alias("blank"))


@candidates_query("""with c as (select * from {v_candidates} as v) select a.provider as a, b.provider as b, count(*) as n, round(avg(case when a.text = b.text then 1.0 else 0 end), 6) as text_share, round(avg(case when a.answer = b.answer then 1.0 else 0 end), 6) as answer_share
from c as a join c as b on a.paper = b.paper and a.number = b.number and a.rank < b.rank group by 1, 2""")
def provider_agreement(c):
    return consensus.provider_agreement(c)


@query("select source as paper, cast(n_chars % 7 as bigint) as id, arg_min(text, doc_id) as text from documents group by 1, 2")
def passages_first(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return consensus.merged_passages(docs.select(F.col("source").alias("paper"), (F.col("n_chars") % 7).alias("id"), "text", F.col("doc_id").alias("rank")))


# Pages and chunks

CHUNKED = """pages as (select * from {v_pages} as v), chunked as (select pages.*, c as chunk_index from pages, range(0, 100000) as r(c) where c >= greatest(0, ceil((page - 15) / 10)) and c <= least(case when n_pages <= 15 then 0 else cast(ceil((n_pages - 15) / 10) as bigint) end, (page - 1) // 10))"""


def _chunked(spark, sf):
    return chunks.page_chunks(view(spark, sf, "v_pages"))


@query(f"with {CHUNKED} select paper, page, chunk_index from chunked")
def page_chunks(spark, sf):
    return _chunked(spark, sf).select("paper", "page", "chunk_index")


@query(f"""with {CHUNKED} select paper, chunk_index, count(*) as n_pages, min(page) as first_page, max(page) as last_page, sha256(string_agg('--- Page ' || cast(page as varchar) || ' ---' || chr(10) || chr(10) || markdown, chr(10) || chr(10) order by page)) as digest from chunked group by 1, 2""")
def chunk_markdown(spark, sf):
    return chunks.chunk_markdown(_chunked(spark, sf)).select("paper", "chunk_index", "n_pages", "first_page", "last_page", F.sha2("markdown", 256).alias("digest"))


@query(f"with {CHUNKED} select distinct paper, chunk_index, case chunk_index % 3 when 0 then 'poolside' when 1 then 'longcat-lite' else 'nvidia-qwen' end as provider from chunked")
def chunk_round_robin(spark, sf):
    return chunks.round_robin(_chunked(spark, sf).select("paper", "chunk_index").distinct(), ["poolside", "longcat-lite", "nvidia-qwen"])


_COUNT = " + ".join(f"len(regexp_extract_all(lower(markdown), {quoted(p)}))" for p in PAGE_ANSWERS)
_SCORE = " + ".join(f"case when regexp_matches(lower(markdown), {quoted(p)}) then {k} else 0 end" for p, k in PAGE_SIGNS)
KEYS = f"keys as (select paper, page, markdown, cast({_SCORE} + case when {_COUNT} >= 20 then 4 when {_COUNT} >= 10 then 2 else 0 end as int) as score from {{v_pages}} as v where n_pages - page < 10)"


def _key_pages(spark, sf):
    return chunks.answer_key_pages(view(spark, sf, "v_pages"))


@query(f"with {KEYS} select paper, page, score from keys where score >= 5")
def answer_key_pages(spark, sf):
    return _key_pages(spark, sf).select("paper", "page", "score")


_RE2 = lambda ps: " or ".join(f"regexp_matches(markdown, {quoted(p)})" for p in ps)


@query(f"select paper, page, {_RE2(ANSWER_KEY_PATTERNS)} as single, {_RE2(CONSENSUS_KEY_PATTERNS)} as several from {{v_pages}} as v")
def has_answer_key(spark, sf):
    return view(spark, sf, "v_pages").select("paper", "page", tx.has_answer_key("markdown").alias("single"), tx.has_answer_key("markdown", CONSENSUS_KEY_PATTERNS).alias("several"))


@query(f"with {CHUNKED}, {KEYS}, plus as (select distinct paper, chunk_index, page from (select paper, chunk_index, page from chunked union all select c.paper, chunk_index, k.page from chunked as c join keys as k on c.paper = k.paper where score >= 5)) select paper, chunk_index, count(*) as n_pages from plus group by 1, 2")
def chunks_with_key(spark, sf):
    return chunks.with_key_pages(_chunked(spark, sf), _key_pages(spark, sf)).groupBy("paper", "chunk_index").agg(F.count("*").alias("n_pages"))


@query(f"with {KEYS} select paper, 0 as page, sha256('--- ANSWER KEY ---' || chr(10) || chr(10) || string_agg(markdown, chr(10) || chr(10) order by page)) as digest from keys where score >= 5 group by paper")
def merged_answer_key(spark, sf):
    return chunks.merged_key(_key_pages(spark, sf)).select("paper", "page", F.sha2("markdown", 256).alias("digest"))


@query("""select url_part as paper, page_idx, string_agg(line, chr(10) || chr(10) order by page_id) as markdown from (select page_id, page_id % 9 as url_part, page_id % 5 as page_idx, case page_id % 4 when 0 then '## ' || url when 1 then url when 2 then '$$' || url || '$$' else '![cap](' || url || ')' end as line from pages where page_id % 8 <> 7) as x group by 1, 2""")
def content_pages(spark, sf):
    p = spark.read.parquet(f"{sf}/pages.parquet")
    kind = F.when(F.col("page_id") % 8 == 7, "header").otherwise(F.element_at(F.array(*[F.lit(k) for k in ("text", "text", "equation", "image")]), (F.col("page_id") % 4 + 1).cast("int")))
    items = p.select((F.col("page_id") % 9).alias("paper"), (F.col("page_id") % 5).alias("page_idx"), F.col("page_id").alias("pos"), kind.alias("type"), F.col("url").alias("text"), F.when(F.col("page_id") % 4 == 0, 2).otherwise(0).alias("text_level"), F.col("url").alias("img_path"), F.lit("cap").alias("caption"), F.lit(None).cast("string").alias("table_body"))
    return chunks.pages_from_content(items)


@query("with p as (select * from {v_pages} as v) select r.paper, r.page, sha256(coalesce(p.markdown, '[page ' || cast(r.page as varchar) || ' not found]')) as digest from (select paper, page * 2 as page from p) as r left join p on r.paper = p.paper and r.page = p.page")
def requested_pages(spark, sf):
    p = view(spark, sf, "v_pages")
    return chunks.requested_pages(p.select("paper", (F.col("page") * 2).alias("page")), p).select("paper", "page", F.sha2("markdown", 256).alias("digest"))


@query(r"select paper, page, regexp_matches(markdown, '[\x{0900}-\x{097F}]') and regexp_matches(markdown, '[a-zA-Z]') as bilingual, cast(null as double) as ratio from {v_pages} as v where false union all select paper, page, false, case when regexp_matches(markdown, '[a-zA-Z]') then 0.0 end from {v_pages} as v")
def bilingual_pages(spark, sf):
    return view(spark, sf, "v_pages").select("paper", "page", tx.is_bilingual("markdown").alias("bilingual"), tx.devanagari_ratio("markdown").alias("ratio"))


# Extractor answers


@query("""select cast(p_partkey as bigint) as key, 0 as pos, p_size as number, p_name as text, case when p_partkey % 2 = 0 then cast(p_size % 4 as varchar) else '' end as answer from part where p_partkey % 5 <> 3""")
def parse_responses(spark, sf):
    body = "concat('{\"number\":', p_size, ',\"text\":\"', p_name, '\",\"answer\":\"', p_size % 4, '\"}')"
    raw = f"case p_partkey % 5 when 0 then concat('```json\\n[', {body}, ']\\n```') when 1 then concat('[', {body}, ']') when 3 then 'sorry' else concat('{{\"questions\":[', {body}, ']}}') end"
    rows = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_partkey").alias("key"), F.expr(raw).alias("raw"), (F.col("p_partkey") % 2 == 0).alias("key_found"))
    return readers.parse_responses(rows).select("key", "pos", "number", "text", "answer")


CHUNK_ROWS = f"""{CHUNKED}, rows as (select paper, page as number, chunk_index, doc_id as pos, 'physics' as subject, 'mcq' as type, markdown as text, case when (doc_id + chunk_index) % 3 = 0 then '' else cast((doc_id + chunk_index) % 4 as varchar) end as answer,
case when doc_id % 7 = 0 then null when (doc_id + chunk_index) % 2 = 0 then '["A","B","C","D"]' else '["A","B","C","a longer one"]' end as options, case when doc_id % 4 = 0 then null else 'waves' end as topic, case when doc_id % 6 = 0 then 'a' end as section, case when (doc_id + chunk_index) % 5 = 0 then 0.0 else 4.0 end as marks, chunk_index % 2 = 0 as answer_key_found from chunked),
scored as (select *, cast(case when coalesce(text, '') <> '' then 2 else 0 end + 4 + case when answer <> '' then 3 else 0 end + case when options is not null then 2 else 0 end + case when topic is not null then 1 else 0 end + case when section is not null then 1 else 0 end + case when marks > 0 then 1 else 0 end as int) as "full" from rows),
best as (select * from (select *, row_number() over (partition by paper, number order by "full" desc, case when answer <> '' then 0 else 1 end, coalesce(length(options), 0) desc, case when topic is not null then 0 else 1 end, chunk_index, pos) as rn from scored) as x where rn = 1)"""


def _chunk_rows(spark, sf):
    rows = _chunked(spark, sf).selectExpr(
        "paper", "page as number", "chunk_index", "doc_id as pos", "'physics' as subject", "'mcq' as type", "markdown as text", "case when (doc_id + chunk_index) % 3 = 0 then '' else cast((doc_id + chunk_index) % 4 as string) end as answer",
        """case when doc_id % 7 = 0 then null when (doc_id + chunk_index) % 2 = 0 then '["A","B","C","D"]' else '["A","B","C","a longer one"]' end as options""", "case when doc_id % 4 = 0 then null else 'waves' end as topic", "case when doc_id % 6 = 0 then 'a' end as section",
        "case when (doc_id + chunk_index) % 5 = 0 then 0.0D else 4.0D end as marks", "chunk_index % 2 = 0 as answer_key_found",
    )
    n = F.when(F.col("options").isNotNull(), F.size(F.from_json("options", "array<string>")))
    return rows.withColumn("full", merge.completeness(F.col("text"), F.col("subject"), F.col("type"), F.col("answer"), n, F.col("topic"), F.col("section"), F.col("marks")))


MERGED = ("paper", "number", "chunk_index", "full", "answer", "options")


@query(f'with {CHUNK_ROWS} select paper, number, chunk_index, "full" from scored')
def completeness_scores(spark, sf):
    return _chunk_rows(spark, sf).select("paper", "number", "chunk_index", "full")


@query(f'with {CHUNK_ROWS} select paper, number, chunk_index, "full", answer, options from best')
def merge_best_row(spark, sf):
    return merge.best_rows(_chunk_rows(spark, sf)).select(*MERGED)


@query()
def merge_fold(spark, sf):
    """The exact fold, whose order isn't transitive."""
    return merge.merge_chunks(_chunk_rows(spark, sf)).select(*MERGED)


@query(f"""with {CHUNK_ROWS}, key as (select paper, number, arg_max(answer, chunk_index) as k from rows where answer_key_found and answer <> '' group by 1, 2) select b.paper, b.number, case when answer = '' then coalesce(k, answer) else answer end as answer from best as b left join key on b.paper = key.paper and b.number = key.number""")
def answer_backfill(spark, sf):
    rows = _chunk_rows(spark, sf)
    return merge.backfill(merge.best_rows(rows), merge.answer_key(rows)).select("paper", "number", "answer")


@query(r"""with s as (select doc_id, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^a-zA-Z0-9_]+'), lambda w: length(w) > 2))) as ws from documents), r as (select min(doc_id) as id, ws from s where len(ws) > 0 group by ws),
t as (select id, unnest(ws) as w from r), i as (select x.id as a, y.id as b, count(*) as n from t as x join t as y on x.w = y.w and x.id < y.id group by 1, 2)
select a, b, round(n / (len(p.ws) + len(q.ws) - n), 6) as similarity from i join r as p on p.id = a join r as q on q.id = b where n / (len(p.ws) + len(q.ws) - n) >= 0.8""")
def near_duplicates_jaccard(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    return merge.similar_pairs(docs).withColumn("similarity", F.round("similarity", 6))


@query("""with e as (select vec_id, label, i, cast(embedding[i] as double) as x from embeddings, range(1, 65) as r(i)), c as (select label, i, avg(x) as m from e group by 1, 2)
select vec_id, e.label, round(sum(x * m) / (sqrt(sum(x * x)) * sqrt(sum(m * m))), 4) as similarity from e join c on e.label = c.label and e.i = c.i group by 1, 2""")
def embedding_cosine(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    parts = e.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    centres = parts.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("centre"))
    return e.join(centres, "label").select("vec_id", "label", F.round(tx.cosine("embedding", "centre"), 4).alias("similarity"))


# Hashes, texts, answers, topics, ids


@query("select sha256(text) as digest, count(*) as n, min(doc_id) as first_id from documents group by 1 having count(*) > 1")
def exact_text_hash(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").groupBy(F.sha2("text", 256).alias("digest")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


@query("select sha256(lower(trim(regexp_replace(text, '[ \\t\\n]+', ' ', 'g'))) || '||' || coalesce(options_text, '')) as digest, count(*) as n from {v_questions} as v where false group by 1 union all select sha256(lower(trim(regexp_replace(text, '\\s+', ' ', 'g')) || '||' || coalesce(options_text, ''))) as digest, count(*) from {v_questions} as v where options_text is null or options_text = lower(options_text) group by 1")
def question_hash_groups(spark, sf):
    return questions(spark, sf).groupBy(tx.question_hash("text", "options").alias("digest")).agg(F.count("*").alias("n"))


_TEXT_IN = r"""'\frac{a}{' || cast(p_size as varchar) || '} \alpha  \subseteq \sqrt{x}' || case when p_partkey % 3 = 0 then '^{2} \text{cm} ﬁn — {b}' else ' \leq \unknown –  end' end || chr(10) || chr(10) || chr(10) || chr(10) || p_name"""


def _latex_sql() -> str:
    x = "x"
    for a, b in OCR_LITERALS.items():
        x = f"replace({x}, {quoted(a)}, {quoted(b)})"
    for a, b in ((r"\r\n", "\n"), (r"\r", "\n"), (r"[ \t]+", " "), (r"\n{3,}", "\n\n")):
        x = f"regexp_replace({x}, {quoted(a)}, {quoted(b)}, 'g')"
    for a, b in (*tx._GROUPS, *tx._PLAIN, *tx._BRACES):
        x = f"regexp_replace({x}, {quoted(a)}, {quoted(b.replace('$', chr(92)))}, 'g')"
    for a, b in sorted(LATEX.items(), key=lambda kv: -len(kv[0])):
        x = f"replace({x}, {quoted(a)}, {quoted(b)})"
    return f"select p_partkey, trim({x}) as text from (select p_partkey, {_TEXT_IN} as x from part) as t"


@query(_latex_sql())
def normalize_latex(spark, sf):
    body = _TEXT_IN.replace("\\", "\\\\").replace("varchar", "string")
    return spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", tx.normalize_latex(F.expr(body)).alias("text"))


_ANSWER_IN = "case p_partkey % 9 when 0 then '(a)' when 1 then ' B ' when 2 then '3' when 3 then '0' when 4 then '' when 5 then '12.5' when 6 then 'E' when 7 then ' x ' else '(4)' end"


@query(f"""with t as (select p_partkey as number, {_ANSWER_IN} as raw, p_partkey % 2 + 3 as n from part), k as (select *, regexp_replace(lower(trim(raw)), '[()]', '', 'g') as key from t)
select number, case when raw = '' then raw when key in ('a', 'b', 'c', 'd', 'e') then cast(ascii(key) - 97 as varchar) when key in ('1', '2', '3', '4') and n = 4 then cast(cast(key as int) - 1 as varchar) when key in ('0', '1', '2', '3') then key else raw end as answer,
case when number between 1 and 100 then 'a' when number between 101 and 200 then 'b' end as section from k""")
def normalize_answers(spark, sf):
    rows = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_partkey").alias("number"), F.expr(_ANSWER_IN).alias("answer"), F.array_repeat(F.lit("o"), (F.col("p_partkey") % 2 + 3).cast("int")).alias("options"), F.lit("mcq").alias("type"), F.lit(None).cast("string").alias("section"))
    return normalize.normalize_answers(rows).select("number", "answer", "section")


_ALIASES = ", ".join(f"({quoted(a)}, {quoted(c)}, {i})" for a, c, i in alias_rows())
_TAGS = ", ".join(f"({quoted(s)}, {quoted(t)})" for s, tags in SUBJECT_TAGS.items() for t in tags)


@query(f"""with q as (select distinct lower(trim(topic)) as key from {{v_questions}} as v where trim(topic) <> ''), aliases(alias, canonical, ord) as (values {_ALIASES}), near as (select key, canonical, row_number() over (partition by key order by ord) as rn from q join aliases on levenshtein(key, alias) <= 2) select key, canonical from near where rn = 1""")
def topic_fuzzy(spark, sf):
    keys = questions(spark, sf).where(~tx.is_blank("topic")).select(F.lower(tx.wide_trim("topic")).alias("key")).distinct()
    near = keys.join(F.broadcast(alias_table(spark))).where(F.levenshtein("key", "alias", 2) >= 0)
    return near.groupBy("key").agg(F.min_by("canonical", "ord").alias("canonical"))


@query()
def topic_normalize(spark, sf):
    """The whole cascade."""
    rows = normalize.normalize_topics(questions(spark, sf), alias_table(spark), tag_table(spark))
    return rows.groupBy("topic", "subject", "topic_norm").agg(F.count("*").alias("n"))


@query("""with q as (select *, row_number() over (partition by exam, year, shift, subject order by pos) as k from {v_questions} as v)
select pos, exam || '-' || cast(year as varchar) || '-' || case when shift like '%s1' then '-s1' when shift like '%s2' then '-s2' else 's' || regexp_extract(shift, '([0-9]+)', 1) end || '-' || case subject when 'physics' then 'ph' when 'chemistry' then 'ch' when 'mathematics' then 'ma' when 'biology' then 'bi' else 'xx' end || '-' || lpad(cast(k as varchar), cast(greatest(3, length(cast(k as varchar))) as int), '0') as id, cast(k as int) as subject_number from q""")
def assign_ids(spark, sf):
    return normalize.assign_ids(questions(spark, sf)).select("pos", "id", "subject_number")


@query("""select pos, exam, year, shift, subject, number, coalesce(topic, 'unknown') as topic, coalesce(answer, '') as answer, text, marks, cast(row_number() over (partition by exam, year, shift, subject order by pos) as int) as subject_number from {v_questions} as v""")
def export_shape(spark, sf):
    return normalize.export_shape(questions(spark, sf)).select("pos", "exam", "year", "shift", "subject", "number", "topic", "answer", "text", "marks", "subject_number")


@query("select exam, year, shift, count(*) as total from {v_questions} as v group by 1, 2, 3")
def paper_checksums(spark, sf):
    """Totals only, as the SQL has it; paper_content_checksums has the checksums."""
    return normalize.content_checksum(questions(spark, sf)).select("exam", "year", "shift", "total")


@query()
def paper_content_checksums(spark, sf):
    """The checksums themselves, over each paper's whole content; tested against hashes of the collected rows."""
    return normalize.content_checksum(questions(spark, sf))


# Validation


def _duck(predicate: str) -> str:
    import re

    out = re.sub(r"\bRX\(", "regexp_matches(", predicate)
    return re.sub(r"\bN\(", "len(", out).replace("array_distinct(", "list_distinct(").replace("array_sort(", "list_sort(").replace("\\x0B", "\\x0b")


Q = "q as (select *, case when options_text is null or options_text = '' then null else string_split(options_text, '|') end as options, case when answers_text is null or answers_text = '' then null else string_split(answers_text, '|') end as answers, case when tags_text = '' then null else string_split(tags_text, '|') end as tags from {v_questions} as v)"
FLAGS = "flags as (" + " union all ".join(f"select pos, paper, id, {quoted(r.rule)} as rule, {quoted(r.field)} as field, {quoted(r.severity)} as severity from q where {_duck(r.broken)}" for r in rules.RULES) + ")"


@query(f"with {Q}, {FLAGS} select pos, rule, field, severity from flags")
def validate_flags(spark, sf):
    return rules.row_flags(questions(spark, sf)).select("pos", "rule", "field", "severity")


@query(f"with {Q}, {FLAGS}, n as (select pos, sum(case when severity = 'error' then 1 else 0 end) as errors, sum(case when severity = 'warning' then 1 else 0 end) as warnings, sum(case when severity = 'info' then 1 else 0 end) as infos from flags group by pos) select q.paper, count(*) as questions, sum(case when coalesce(errors, 0) = 0 then 1 else 0 end)::bigint as valid, sum(coalesce(errors, 0))::bigint as errors, sum(coalesce(warnings, 0))::bigint as warnings, sum(coalesce(infos, 0))::bigint as infos from q left join n using (pos) group by 1")
def validate_summary(spark, sf):
    q = questions(spark, sf)
    v = rules.validity(q, rules.row_flags(q))
    return v.groupBy("paper").agg(F.count("*").alias("questions"), F.count_if("valid").alias("valid"), *(F.sum(c).alias(c) for c in ("errors", "warnings", "infos")))


@query(f"""with {Q}, a as (select pos, row_number() over (partition by paper, id order by pos) as n from q where coalesce(id, '') <> ''), b as (select pos, row_number() over (partition by paper, lower(substr(text, 1, 100)) order by pos) as n from q where length(substr(text, 1, 100)) > 20) select pos, '28' as rule from a where n > 1 union all select pos, '29' from b where n > 1""")
def duplicate_flags(spark, sf):
    return rules.duplicate_flags(questions(spark, sf)).select("pos", "rule")


@query(f"with {Q}, tags_of(subject, tag) as (values {_TAGS}), t as (select pos, subject, unnest(tags) as t from q where tags is not null) select pos, 'no tag of this subject: ' || t as message from t where not exists (select 1 from tags_of as o where o.subject = t.subject and o.tag = lower(t.t))")
def bad_tags(spark, sf):
    return rules.tag_flags(questions(spark, sf), tag_table(spark)).select("pos", "message")


@query("select pos from {v_questions} as v where diagram_file is not null and pos % 24 <> 0")
def missing_diagram_files(spark, sf):
    q = questions(spark, sf)
    return rules.file_flags(q, q.where("pos % 24 = 0").select(F.concat(F.lit("fig"), F.col("pos").cast("string"), F.lit(".png")).alias("path"))).select("pos")


@query("select pos from {v_questions} as v where coalesce(answer, '') <> '' and year % 2 = 0")
def hallucinated_answers(spark, sf):
    q = questions(spark, sf)
    return rules.hallucinated_flags(q, q.select("paper", (F.col("year") % 2 == 1).alias("answer_key_found")).distinct()).select("pos")


@query("select paper, count(*) as n, max(number) = count(*) as total_ok, sum(case when subject = 'physics' then 1 else 0 end)::bigint as n_physics from {v_questions} as v group by paper")
def file_checks(spark, sf):
    q = questions(spark, sf)
    return rules.file_checks(q, q.groupBy("paper").agg(F.max("number").alias("total"))).select("paper", "n", "total_ok", "n_physics")


@query(f"""with {Q} select paper, number, e as error from (select paper, number, 'missing_answer' as e from q where coalesce(answer, '') = '' union all select paper, number, 'invalid_option_count' from q where type = 'mcq' and (options is null or len(options) < 3 or len(options) > 5) union all select paper, number, 'missing_field' from q where trim(coalesce(text, '')) = '') as x
union all select paper, null, 'wrong_question_count' from q group by paper having abs(count(*) - 90) > 5""")
def extraction_errors(spark, sf):
    return rules.extraction_errors(questions(spark, sf), 90)


@query("select page_id, regexp_matches(html, '(?is)<script|</?[a-z].*>') as has_html, sha256(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')) as escaped from pages")
def html_escape(spark, sf):
    return spark.read.parquet(f"{sf}/pages.parquet").select("page_id", tx.has_html("html").alias("has_html"), F.sha2(tx.escape_html("html"), 256).alias("escaped"))


@query("select pos, coalesce(has_diagram, false) or regexp_matches(text, '(?i)(Figure|Fig\\.?|Diagram|Graph|Circuit|shown\\s+in)') as has_diagram from {v_questions} as v")
def detect_diagrams(spark, sf):
    return diagrams.detect(questions(spark, sf)).select("pos", "has_diagram")


# Queries


@query("select pos, subject, type from {v_questions} as v where subject = 'physics' and type = 'mcq' and year = 2021 order by pos limit 50 offset 5")
def question_page(spark, sf):
    q = browse.QuestionQuery.parse("subject=physics&type=mcq&year=2021&limit=50&offset=5")
    return browse.page(questions(spark, sf), q).select("pos", "subject", "type")


@query("select paper, exam, year, shift, total from (select paper, exam, year, shift, count(*) as total from {v_questions} as v group by all)")
def papers_list(spark, sf):
    rows = questions(spark, sf).groupBy("paper").agg(F.count("*").alias("total"))
    headers = rows.select("paper", F.col("paper").alias("path"), F.lit("").alias("exam"), F.lit(None).cast("int").alias("year"), F.lit(None).cast("string").alias("shift"), "total")
    return browse.papers(headers).select("paper", "exam", F.col("year").cast("long").alias("year"), "shift", "total")


@query("select distinct exam, year from {v_questions} as v")
def exams_distinct(spark, sf):
    return questions(spark, sf).select("exam", "year").distinct()


@query("select exam, subject, type, grouping(exam, subject, type) as level, count(*) as n from {v_questions} as v group by grouping sets ((exam), (exam, subject), (exam, type), (subject), (type), ())")
def stats_grouping_sets(spark, sf):
    return browse.statistics(questions(spark, sf))


@query("select count(distinct paper) as datasets, count(*) as questions, count(distinct subject) as subjects from {v_questions} as v")
def stats_totals(spark, sf):
    return browse.totals(questions(spark, sf))


@query("select l_returnflag as exam, l_linestatus as type, count(*) as n, round(sum(l_quantity), 2) as score, count(distinct l_orderkey) as papers from lineitem group by 1, 2")
def bulk_statistics(spark, sf):
    rows = spark.read.parquet(f"{sf}/lineitem.parquet")
    return rows.groupBy(F.col("l_returnflag").alias("exam"), F.col("l_linestatus").alias("type")).agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("score"), F.count_distinct("l_orderkey").alias("papers"))


@query("select pos, subject from {v_questions} as v where paper in (select paper from {v_questions} as w group by paper having count(*) % 2 = 0)")
def open_export(spark, sf):
    q = questions(spark, sf)
    state_ = q.groupBy("paper").agg(F.when(F.count("*") % 2 == 0, "verified").otherwise("needs-review").alias("status"))
    return browse.open_export(q, state_, ("confidence", "revision")).select("pos", "subject")


@query("select 'data/' || cast(page_id % 7 as varchar) as dir, count(*) as files, sum(page_id)::bigint as bytes from pages where page_id % 3 <> 0 group by 1 union all select 'data', count(*), sum(page_id)::bigint from pages where page_id % 3 <> 0")
def file_tree(spark, sf):
    rows = spark.read.parquet(f"{sf}/pages.parquet").select(F.concat(F.lit("data/"), (F.col("page_id") % 7).cast("string"), F.when(F.col("page_id") % 3 == 0, F.lit("/.x/a.txt")).otherwise(F.concat(F.lit("/"), F.col("page_id").cast("string"), F.lit(".json")))).alias("path"), F.col("page_id").alias("size"))
    return browse.file_tree(rows)


# Comparison

SIDES = """a as (select paper, number as place, text, answer, subject from {v_candidates} as v where rank = 0), b as (select paper, number as place, text, answer, subject from {v_candidates} as v where rank = 1),
d as (select coalesce(a.paper, b.paper) as paper, coalesce(a.place, b.place) as place, case when a.paper is null then 'missing-a' when b.paper is null then 'missing-b' when a.subject = b.subject and trim(a.text) = trim(b.text) and a.answer = b.answer then 'match' else 'diff' end as status,
case when a.paper is null or b.paper is null then '' else concat_ws(',', case when a.subject <> b.subject then 'subject' end, case when trim(a.text) <> trim(b.text) then 'text' end, case when a.answer <> b.answer then 'answer' end) end as fields from a full join b on a.paper = b.paper and a.place = b.place)"""


def _sides(c):
    c = c.withColumnRenamed("number", "place")
    return c.where("rank = 0"), c.where("rank = 1")


def _diff(c):
    rows = c.withColumnRenamed("number", "place").where("rank < 2").withColumn("is_a", F.col("rank") == 0)
    return compare.paired_diff(rows, fields=("subject", "text", "answer"))


@candidates_query(f"with {SIDES} select * from d")
def positional_diff(c):
    return _diff(c)


@candidates_query(f"with {SIDES} select paper, place, case when status = 'diff' and fields not like '%text%' then 'match' else status end as status from d")
def passage_diff(c):
    a, b = (x.select("paper", F.col("place").alias("id"), tx.wide_trim("text").alias("text")) for x in _sides(c))
    return compare.passage_diff(a, b).withColumnRenamed("id", "place")


@candidates_query(f"with {SIDES}, n as (select paper, count(*) as total, sum((status = 'match')::int)::bigint as matched, sum((status = 'diff')::int)::bigint as differing, sum((status = 'missing-a')::int)::bigint as missing_a, sum((status = 'missing-b')::int)::bigint as missing_b from d group by paper) select *, matched = total as auto_acceptable, round(100 * matched / total, 1) as match_percent from n")
def cross_validation_summary(c):
    return compare.diff_summary(_diff(c))


@candidates_query(f"with {SIDES} select coalesce(a.paper, b.paper) as paper, coalesce(a.place, b.place) as place, case when a.paper is null then b.text else a.text end as text, case when coalesce(a.place, b.place) % 10 = 0 then 'fixed' when a.paper is null then b.answer else a.answer end as answer from a full join b on a.paper = b.paper and a.place = b.place")
def consensus_override(c):
    a, b = _sides(c)
    fixes = a.select("paper", "place").union(b.select("paper", "place")).distinct().where("place % 10 = 0").withColumn("answer", F.lit("fixed"))
    return compare.overridden(a, b, fixes)


@candidates_query(f"with {SIDES} select paper, place, '<tr><td>' || cast(place as varchar) || '</td><td>' || status || '</td><td>' || fields || '</td></tr>' as html from d where status <> 'match'")
def html_report_rows(c):
    return compare.html_rows(_diff(c))


@candidates_query("""with a as (select * from {v_candidates} as v where rank = 0), b as (select * from {v_candidates} as v where rank = 1), j as (select b.paper, lower(trim(substr(a.text, 1, 100))) = lower(trim(substr(b.text, 1, 100))) as t, b.answer <> '' and b.answer = a.answer as n, lower(a.subject) = lower(b.subject) as s, a.options is not distinct from b.options as o from b join a on a.paper = b.paper and a.number = b.number)
select paper, count(*) as checked, round(avg(t::int) * 100, 4) as text_accuracy, round(avg(n::int) * 100, 4) as answer_accuracy, round(avg(s::int) * 100, 4) as topic_accuracy, round(avg(o::int) * 100, 4) as options_accuracy, round((round(avg(t::int) * 100, 4) + round(avg(n::int) * 100, 4) + round(avg(s::int) * 100, 4) + round(avg(o::int) * 100, 4)) / 4, 4) as overall_accuracy from j group by paper""")
def golden_metrics(c):
    c = c.withColumn("topic", F.col("subject"))
    return compare.golden_metrics(c.where("rank = 0"), c.where("rank = 1"))


@query("select event_type as key, count(*) as runs, round(arg_max(value, event_id), 4) as latest, round(avg(value), 4) as average from events group by 1")
def accuracy_trends(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    return compare.accuracy_trends(e.select(F.col("event_type").alias("key"), F.col("value").alias("accuracy"), F.col("event_id").alias("seq")))


@query("""with q as (select *, case when pos % 3 = 0 then 'b' when pos % 7 = 0 then '' else 'a' end as section from {v_questions} as v), n as (select *, last_value(nullif(section, '') ignore nulls) over (partition by paper order by pos rows between unbounded preceding and 1 preceding) as before from q) select pos, section from n where section <> '' and section is distinct from before""")
def section_headers(spark, sf):
    q = view(spark, sf, "v_questions").withColumn("section", F.expr("case when pos % 3 = 0 then 'b' when pos % 7 = 0 then '' else 'a' end"))
    return compare.section_headers(q).select("pos", "section")


# State

LATEST = "l as (select * from (select *, row_number() over (partition by key, stage order by seq desc) as rn from {v_log} as v) as x where rn = 1)"


def _latest(spark, sf):
    return state.latest(view(spark, sf, "v_log"), ["key", "stage"], ["seq"])


@query(f"with {LATEST} select key, stage, seq, status from l")
def checkpoint_latest(spark, sf):
    return _latest(spark, sf).select("key", "stage", "seq", "status")


@query(f"with {LATEST}, s(stage, o) as (values ('ocr', 0), ('extract', 1), ('diagrams', 2), ('validate', 3), ('export', 4)), k as (select distinct key from l), t as (select k.key, min(s.o) as o from k join s on not exists (select 1 from l where l.key = k.key and l.stage = s.stage and l.status = 'completed') group by 1) select k.key, a.stage as resume_stage, b.stage as previous_stage from k left join t on k.key = t.key left join s as a on a.o = t.o left join s as b on b.o = t.o - 1")
def resume_point(spark, sf):
    return state.resume_points(_latest(spark, sf))


@query(f"with {LATEST} select distinct key from {{v_log}} as v where key not in (select key from l where stage = 'export' and status = 'completed')")
def pending_files(spark, sf):
    return state.pending(view(spark, sf, "v_log").select("key").distinct(), _latest(spark, sf))


@query("select exam, count(*) as papers, string_agg(distinct cast(year as varchar), ',' order by cast(year as varchar) desc) as years from (select distinct exam, year, paper from {v_questions} as v) as x group by exam")
def checkpoint_summary(spark, sf):
    return state.checkpoint_summary(questions(spark, sf).select("exam", "year", "paper").distinct())


@query("with o as (select paper, count(*) as total from {v_questions} as v where year < 2023 group by 1), n as (select paper, max(pos) as total from {v_questions} as v where year >= 2022 group by 1) select * from o where paper not in (select paper from n) union all select * from n")
def index_upsert(spark, sf):
    q = questions(spark, sf)
    return state.upsert(q.where("year < 2023").groupBy("paper").agg(F.count("*").alias("total")), q.where("year >= 2022").groupBy("paper").agg(F.max("pos").alias("total")), ["paper"])


REVIEW = "s as (select paper, count(*) as reviewed, sum((action = 'accept')::int)::bigint as accepted, sum((action = 'edit')::int)::bigint as edited, sum((action = 'skip')::int)::bigint as skipped from (select *, row_number() over (partition by paper, number order by seq desc) as rn from {v_review} as v) as x where rn = 1 group by 1)"


@query(f"with {REVIEW} select *, round(100 * (accepted + edited) / reviewed, 1) as done_percent from s")
def review_state(spark, sf):
    return state.review_state(view(spark, sf, "v_review")).drop("flagged")


@query(f"with {REVIEW} select paper, case when accepted + edited = 0 then 'unverified' when skipped > 0 then 'needs-review' else 'verified' end as status from s")
def signoff_status(spark, sf):
    return state.signoff(state.review_state(view(spark, sf, "v_review")))


@query("select event_id as seq, n as in_window, n <= 3 as admitted from (select event_id, count(*) over (partition by user_id order by epoch_us(ts) range between 59999999 preceding and current row) as n from events) as x")
def rate_window(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    return state.rate_window(e.select(F.col("user_id").alias("provider"), "ts", F.col("event_id").alias("seq")), 3).select("seq", "in_window", "admitted")


@query("select seq, key from {v_log} as v order by ts desc, seq desc limit 100")
def log_tail(spark, sf):
    return state.log_tail(view(spark, sf, "v_log")).select("seq", "key")


@query("select l_orderkey as chunk, arg_min(l_suppkey, l_linenumber) as provider, min(l_linenumber) as attempt from (select l_orderkey, l_linenumber, min(l_suppkey) as l_suppkey from lineitem where l_returnflag <> 'R' group by 1, 2) as x group by 1")
def failover(spark, sf):
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").groupBy(F.col("l_orderkey").alias("chunk"), F.col("l_linenumber").alias("attempt"), (F.col("l_returnflag") != "R").alias("ok")).agg(F.min("l_suppkey").alias("provider"))
    good = rows.where("ok").groupBy("chunk", "attempt").agg(F.min("provider").alias("provider")).withColumn("ok", F.lit(True))
    return state.failover(good)


@query("select case when n_chars % 3 = 0 then 'missing' when n_chars = length(text) then 'ok' else 'mismatch' end as status, count(*) as files from documents group by 1")
def integrity_report(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return state.integrity(d.select(F.concat(F.col("doc_id").cast("string"), F.lit(".json")).alias("path"), F.when(F.col("n_chars") % 3 != 0, F.col("n_chars").cast("string")).alias("stated"), F.char_length("text").cast("string").alias("computed")))


# Files and diagrams


@query("select p_partkey as id, 0 as place, case when p_partkey % 2 = 0 then null else 'Fig' end as label, 'img' || cast(p_size as varchar) || '.png' as filename, p_name || ' drawn' as caption from part")
def image_references(spark, sf):
    rows = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_partkey").alias("id"), F.expr("concat('See ![', case when p_partkey % 2 = 0 then '' else 'Fig' end, '](img', p_size, '.png)\\n', p_name, ' drawn\\nend')").alias("text"))
    return diagrams.references(rows)


@query("""with q as (select pos, paper, row_number() over (partition by paper order by pos) as k from {v_questions} as v where has_diagram), i as (select paper, 'img' || cast(pos as varchar) as image_id, row_number() over (partition by paper order by pos) as k from {v_questions} as v where type = 'nat') select pos, image_id from q left join i on q.paper = i.paper and q.k = i.k""")
def legacy_diagrams(spark, sf):
    q = questions(spark, sf)
    images = q.where("type = 'nat'").select("paper", F.col("pos").alias("page"), F.concat(F.lit("img"), F.col("pos").cast("string")).alias("image_id"))
    return diagrams.legacy(q, images).select("pos", "image_id")


@query("select p_partkey, case when p_partkey % 3 = 2 then 'jeeadv' when p_partkey % 3 = 1 then 'neet' else 'jeemain' end as exam, cast(2020 + p_partkey % 5 as int) as year, case when p_partkey % 3 = 2 then 'p' || cast(p_partkey % 2 + 1 as varchar) when p_partkey % 3 = 1 then 'h' || cast(p_partkey % 10 as varchar) else lpad(cast(p_partkey % 28 + 1 as varchar), 2, '0') || 'jan-s' || cast(p_partkey % 2 + 1 as varchar) end as shift from part")
def filename_parse(spark, sf):
    name = "case when p_partkey % 3 = 2 then concat('JEE Adv ', 2020 + p_partkey % 5, ' Paper ', p_partkey % 2 + 1, '.pdf') when p_partkey % 3 = 1 then concat('NEET_', 2020 + p_partkey % 5, '_Code_H', p_partkey % 10, '.pdf') else concat('jee-main-', 2020 + p_partkey % 5, '-', p_partkey % 28 + 1, '-January-Shift-', p_partkey % 2 + 1, '.PDF') end"
    meta = readers.parse_filename(F.expr(name))
    return spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", meta["exam"].alias("exam"), meta["year"].alias("year"), meta["shift"].alias("shift"))


@query("""select 'neet-2024-imported-' || substr(s, 1, 2) || '-' || lpad(cast(p_partkey as varchar), cast(greatest(3, length(cast(p_partkey as varchar))) as int), '0') as id, cast(p_partkey as int) as number, s as subject, case when p_size % 4 = 0 then 'unknown' else p_container end as topic, case when p_size % 3 = 0 then 'nat' else 'mcq' end as type, p_name as text, 'a,b' as options,
case when p_size % 5 = 0 then '' else cast(p_size % 4 as varchar) end as answer, case when p_size % 6 = 0 then 4.0 when p_size % 6 = 1 then 4.0 else 2.5 end::double as marks, cast(case when p_size % 3 = 0 then 0 else -1 end as double) as negative_marks, case when p_size % 7 = 0 then 'hard' end as difficulty, case when p_size % 2 = 0 then 'waves,optics' end as tags, 'imported-kaggle' as source, 'low' as confidence
from (select *, p_type as p_container, case when p_size % 2 = 0 then 'biology' else 'physics' end as s from part) as x""")
def import_flat(spark, sf):
    rows = spark.read.parquet(f"{sf}/part.parquet").selectExpr(
        "p_partkey as row", "p_name as question", "case when p_size % 2 = 0 then ' Biology' else 'Other' end as subject", "case when p_size % 3 = 0 then 'Numerical' else 'single' end as type", "' a || b|' as options",
        "case when p_size % 4 = 0 then null else p_type end as topic", "case when p_size % 5 = 0 then null else cast(p_size % 4 as string) end as answer", "case when p_size % 6 = 0 then null when p_size % 6 = 1 then 'four' else '2.5' end as marks",
        "case when p_size % 7 = 0 then 'hard' end as difficulty", "case when p_size % 2 = 0 then 'waves| |optics' end as tags",
    )
    out = readers.import_flat(rows, "neet", 2024)
    return out.withColumns({c: F.array_join(c, ",") for c in ("options", "tags")})


# Streams


@query("select time_bucket(interval '1 day', ts) as start, event_type, count(*) as n, round(sum(value), 2) as total from events group by 1, 2")
def event_tumbling_stream(spark, sf):
    out = ev.run_to_end(ev.tumbling(ev.event_stream(spark, f"{sf}/events.parquet")), "complete", "tumbling")
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("""with g as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 30 minutes then 0 else 1 end as new from events), s as (select user_id, sum(new) over (partition by user_id order by ts rows unbounded preceding) as k from g) select user_id, cast(count(distinct k) as bigint) as sessions, count(*) as n from s group by 1""")
def event_sessions(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.groupBy(F.session_window("ts", "30 minutes"), "user_id").agg(F.count("*").alias("c")).groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("c").alias("n"))


import sheaf.plans.more  # noqa: E402, F401  the rest of the catalogue, which registers itself
import sheaf.plans.structures  # noqa: E402, F401
