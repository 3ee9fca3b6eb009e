"""Views that give the test tables the shape of papers. One SQL text for each, which Spark and other engines read alike."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
KEY_LINE = " Answer Key 1(2) 2(4) 3(1) 4(3) 5(2) 6(1) 7(4) 8(3) 9(2) 10(1) 11(3)"

VIEWS = {
    "v_pages": f"""select paper, page, n_pages, doc_id, lang, case when n_pages - page < 2 and cast(substr(paper, 4) as int) % 2 = 0 then text || '{KEY_LINE}' else text end as markdown
from (select d.source as paper, k.page, k.n_pages, d.doc_id, d.lang, d.text from {{documents}} as d join (select doc_id, source, cast(row_number() over (partition by source order by doc_id) as bigint) as page, count(*) over (partition by source) as n_pages from {{documents}}) as k
on d.doc_id = k.doc_id and d.source is not distinct from k.source) as p""",
    "v_providers": "select 0 as p, 'poolside' as provider union all select 1, 'longcat-lite' union all select 2, 'nvidia-qwen'",
    "v_candidates": """select paper, provider, p as rank, page + 2 * cast(floor(page / 3) as bigint) - case when p = 1 and page % 3 = 0 then 1 else 0 end as number, doc_id, markdown || case when doc_id % 10 = 0 then ' v' || cast(p as string) when (doc_id * 7 + p) % 5 = 0 then ' *' else '' end as text,
case when (doc_id + p) % 11 = 0 then '' when doc_id % 10 = 0 then cast((doc_id + p) % 4 as string) else cast((doc_id + case when (doc_id + p) % 4 = 0 then p else 0 end) % 4 as string) end as answer,
case doc_id % 4 when 0 then 'physics' when 1 then 'chemistry' when 2 then 'mathematics' else 'biology' end as subject,
case when doc_id % 9 = 0 then null else '["A' || cast(doc_id % 7 as string) || '","B","C' || case when p = 2 and doc_id % 6 = 0 then '?' else '' end || '","D"]' end as options
from {v_pages} as pages, {v_providers} as providers""",
    "v_questions": """select pos, paper, exam, year, shift, number, subject, type, topic,
case when pos % 50 = 7 then null when pos % 50 = 9 then 'Bad ID' when pos % 50 = 11 then 'jeemain-2020-dup' else exam || '-' || cast(year as string) || '-' || shift || '-' || cast(number as string) end as id,
case when pos % 37 = 5 then '  ' when pos % 29 = 4 then name || ' see [Image] here' when pos % 31 = 6 then name || ' <b>bold</b>' when pos % 43 = 8 then name || '�' when pos % 23 = 2 then 'The same long question text again' else name || ' of ' || kind end as text,
case when (type = 'nat' or type = 'assertion-reason') and pos % 13 <> 0 then null when pos % 19 = 0 then 'x|x|y' when n_opt = 2 then 'one|two' when n_opt = 3 then 'one|two|three' when n_opt = 4 then 'one|two|three|four' when n_opt = 5 then 'one|two|three|four|<i>five</i>' else '1|2|3|4|5|6' end as options_text,
case when type = 'msq' and pos % 3 <> 0 then '' when type = 'nat' and pos % 7 = 0 then 'abc' when pos % 41 = 1 then '' else cast(pos % 6 as string) end as answer,
case when type = 'msq' then case when pos % 5 = 0 then '2|0' when pos % 5 = 1 then null else '0|2' end when pos % 47 = 0 then '1' end as answers_text,
case when pos % 53 = 10 then 0.0 else 4.0 end as marks, case when type = 'nat' and pos % 4 <> 1 then 0.0 when pos % 10 = 3 then 0.0 else -1.0 end as negative_marks,
pos % 6 = 0 as has_diagram, case when pos % 12 = 0 or pos % 97 = 1 then 'fig' || cast(pos as string) || '.png' end as diagram_file,
case when pos % 8 = 0 then 'hard' when pos % 8 = 1 then 'extreme' when pos % 8 = 2 then null else 'easy' end as difficulty,
case when pos % 11 = 0 then 'imported-kaggle' when pos % 59 = 0 then 'scan' else 'official-pdf' end as source, case when pos % 22 = 0 or pos % 9 = 1 then 'low' end as confidence,
case when pos % 61 = 0 then 0 else 1 end as revision, case when pos % 14 = 0 then 'because' end as solution, case when pos % 28 = 0 then 'plain' when pos % 67 = 0 then 'rtf' end as solution_format,
case when pos % 18 = 0 then '12x3' when pos % 18 = 1 then '12a' end as number_label, case when pos % 26 = 0 then 'p' || cast(pos % 4 as string) end as passage_id,
case when pos % 15 = 0 then 'kinematics|Waves' when pos % 15 = 1 then 'cooking' when pos % 15 = 2 then 'sets|probability' else '' end as tags_text, case when type = 'nat' and pos % 16 = 2 then 'fuzzy' end as precision_type
from (select pos, exam, year, shift, exam || '/' || cast(year as string) || '/' || shift as paper, name, kind, n_opt, cast(row_number() over (partition by exam, year, shift order by pos) as bigint) as number,
case when pos % 73 = 3 then 'geology' when size4 = 0 then 'physics' when size4 = 1 then 'chemistry' when size4 = 2 then 'mathematics' else 'biology' end as subject,
case when pos % 79 = 4 then 'essay' when pos % 4 = 0 then 'mcq' when pos % 4 = 1 then 'msq' when pos % 4 = 2 then 'nat' else 'assertion-reason' end as type,
case when pos % 10 = 0 then 'Kinematics' when pos % 10 = 1 then 'kineamtics' when pos % 10 = 2 then 'orgnic chemistry' when pos % 10 = 3 then 'laws of thermodynamics' when pos % 10 = 4 then '' when pos % 10 = 5 then 'd-block' when pos % 10 = 6 then 'number theory' when pos % 10 = 7 then 'zzzz qqqq' when pos % 10 = 8 then 'probability' else 'genetics' end as topic
from (select p_partkey as pos, case p_partkey % 3 when 0 then 'jeemain' when 1 then 'neet' else 'jeeadv' end as exam, 2020 + p_partkey % 5 as year, 's' || substr(p_brand, 7) as shift, p_name as name, lower(p_type) as kind, p_size % 5 + 2 as n_opt, p_size % 4 as size4 from {part}) as a) as b""",
    "v_log": """select event_id as seq, ts, 'paper-' || cast(user_id as string) as key, case event_type when 'signup' then 'ocr' when 'view' then 'extract' when 'click' then 'diagrams' when 'purchase' then 'validate' else 'export' end as stage,
case when value < 3 then 'failed' when value < 6 then 'pending' else 'completed' end as status, value from {events}""",
    "v_review": "select conv_id as paper, turn as number, conv_id * 1000 + turn as seq, case role when 'user' then 'accept' when 'assistant' then 'edit' else 'skip' end as action from {conversations}",
}

def expanded(sql: str) -> str:
    """Views put in as subqueries; {table} stays."""
    while names := set(re.findall(r"\{(v_\w+)\}", sql)):
        for n in names:
            sql = sql.replace("{" + n + "}", f"({VIEWS[n]})")
    return sql


def for_tables(sql: str) -> str:
    """SQL over tables of these names."""
    return re.sub(r"\{(" + "|".join(TABLES) + r")\}", r"\1", expanded(sql))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view over the Parquet tables of a folder."""
    sql = expanded("select * from {" + name + "}")
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(re.findall(r"\{(\w+)\}", sql))}
    return spark.sql(sql, **frames)


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_questions with arrays instead of joined texts."""
    from pyspark.sql import functions as F

    rows = view(spark, sf_dir, "v_questions")
    return rows.withColumns({c: F.when(F.coalesce(f"{c}_text", F.lit("")) != "", F.split(f"{c}_text", r"\|")) for c in ("options", "answers", "tags")}).drop("options_text", "answers_text", "tags_text")
