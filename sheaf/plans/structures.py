"""Queries of the operators that need a structure of their own: keyed stream state, review sessions, vector joins, digest trees, archives."""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import functions as F

from sheaf.operators import curate, digests, review, similar
from sheaf.plans.catalog import query
from sheaf.sources import readers, recorded
from sheaf.sources.views import questions
from sheaf.streaming import events as ev
from sheaf.streaming import keyed


def read(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Keyed state in streams


def _events(spark, sf):
    return read(spark, sf, "events").select("user_id", "event_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))


def _closing(spark, rows):
    """An event of nobody, long after all others, which lets out what waits."""
    last = rows.agg(F.max("ts")).first()[0]
    return None if last is None else spark.createDataFrame([(-1, -1, "end", None, last)], rows.schema).withColumn("ts", F.col("ts") + F.expr("interval 400 days"))


@query("select user_id, arg_max(event_id, event_id) as event_id, arg_max(event_type, event_id) as event_type, arg_max(value, event_id) as value from events group by 1")
def event_upsert_stream(spark, sf):
    """A table of the latest event of each user, kept in the state of a stream that is stopped and goes on after each of four slices."""
    rows = _events(spark, sf)
    fed = keyed.Fed(spark, "upsert", rows.schema)
    for k, part in enumerate(keyed.slices_by(rows, "ts", 4)):
        fed.feed(part, k)
        fed.run(lambda s: keyed.upserts(s, ["user_id"], ["event_id"]), "update")
    return keyed.table_of(fed.log(), ["user_id"]).select("user_id", "event_id", "event_type", "value")


GAP = "6 hours"


@query(f"select user_id, event_id, event_type, value from (select *, lead(ts) over (partition by user_id order by ts, event_id) as following from events) as e where following is null or following - ts >= interval {GAP}")
def event_debounce_stream(spark, sf):
    """Of each user's events the last one before each quiet gap, given out when the watermark has passed the gap, over three slices."""
    rows = _events(spark, sf)
    fed = keyed.Fed(spark, "debounce", rows.schema)
    closing = _closing(spark, rows)
    for k, part in enumerate([*keyed.slices_by(rows, "ts", 3), *([] if closing is None else [closing])]):
        fed.feed(part, k)
        fed.run(lambda s: keyed.debounced(s, ["user_id"], "ts", ["event_id"], 6 * 3600 * 1000), "append")
    return fed.log().where("user_id >= 0").select("user_id", "event_id", "event_type", "value")


@query("select user_id, event_id, event_type, value from events order by ts desc, event_id desc limit 500")
def event_history(spark, sf):
    """The newest 500 events that a stream pushed, kept by batch."""
    rows = _events(spark, sf)
    fed = keyed.Fed(spark, "pushed", rows.schema)
    kept = keyed.History(ev.folder(spark, "history"), rows.schema, ["ts", "event_id"])
    for k, part in enumerate(keyed.slices_by(rows, "ts", 3)):
        fed.feed(part, k)
        fed.run(lambda s: s, "append", kept.add)
    return kept.read(spark).select("user_id", "event_id", "event_type", "value")


@query("""with e as (select user_id, ts from events), g as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 30 minutes then 0 else 1 end as new from e), s as (select user_id, ts, sum(new) over (partition by user_id order by ts) as k from g)
select user_id, min(ts) as start, count(*) as n from s group by user_id, k""")
def event_sessions_stream(spark, sf):
    """Sessions of a stream over three slices, each given out once, when the watermark has closed it."""
    rows = _events(spark, sf)
    fed = keyed.Fed(spark, "sessions", rows.schema)
    closing = _closing(spark, rows)
    for k, part in enumerate([*keyed.slices_by(rows, "ts", 3), *([] if closing is None else [closing])]):
        fed.feed(part, k)
        fed.run(ev.sessions, "append")
    return fed.log().where("user_id >= 0").select("user_id", F.col("session_window.start").cast("timestamp_ntz").alias("start"), "n")


# Review sessions

_REVIEW = """select user_id as reviewer, event_id as seq, case event_type when 'signup' then 'start' when 'view' then 'accept' when 'click' then case when event_id % 3 = 0 then 'skip' else 'edit' end when 'purchase' then case when event_id % 5 = 0 then 'cancel' else 'flag' end else case when event_id % 4 = 0 then 'start' when event_id % 4 = 1 then '' else 'current' end end as kind,
case when event_id % 11 = 0 then null else event_id % 7 end as total from {events}"""
REPLAY = f"""with e as ({_REVIEW.replace("{events}", "events")}), m as (select *, kind = 'start' and total is not null as opens, kind not in ('start', 'cancel', 'current') as acts from e),
s as (select *, sum(case when opens or kind = 'cancel' then 1 else 0 end) over w as session, coalesce(sum(case when opens or kind = 'cancel' then 1 else 0 end) over (partition by reviewer order by seq rows between unbounded preceding and 1 preceding), 0) as session_before from m window w as (partition by reviewer order by seq)),
o as (select reviewer, session, max(case when opens then total end) as opened from s where opens or kind = 'cancel' group by 1, 2),
b as (select s.*, b.opened as of_before, n.opened as of_after, count(*) filter (acts) over (partition by s.reviewer, s.session order by seq) as acted_after, coalesce(count(*) filter (acts) over (partition by s.reviewer, s.session order by seq rows between unbounded preceding and 1 preceding), 0) as acted_same
  from s left join o as b on b.reviewer = s.reviewer and b.session = s.session_before left join o as n on n.reviewer = s.reviewer and n.session = s.session),
c as (select *, session = session_before and of_before is not null and acted_same < greatest(of_before, 1) as active_same, case when session = session_before then acted_same end as acted from b)
select reviewer, seq, kind, total, case when acts then case when kind = '' then 'accept' else kind end end as action, case when kind = 'start' and not opens then '{review.NOT_FOUND}' when (acts or kind = 'current') and not active_same then '{review.NO_SESSION}' end as refused,
  case when acts and active_same and of_before > 0 then acted end as question, case when of_after is not null then least(acted_after, of_after) end as position, of_after as of, case when of_after is null then 'none' when acted_after < greatest(of_after, 1) then 'active' else 'done' end as state,
  case when of_after > 0 then cast(floor(100 * least(acted_after, of_after) / of_after + 0.5) as bigint) end as progress from c"""


def _replay(spark, sf):
    return review.replayed(spark.sql(_REVIEW.replace("{events}", "{e}"), e=read(spark, sf, "events")))


@query(REPLAY)
def review_replay(spark, sf):
    """What each event of the review log did: cursor, state, refusals."""
    return _replay(spark, sf)


@query(f"""select reviewer, arg_max(state, seq) as state, arg_max(position, seq) filter (true) as position, arg_max(struct_pack(x := of), seq).x as of, arg_max(struct_pack(x := progress), seq).x as progress,
{", ".join(f"count(*) filter (action = '{k}' and question is not null) as n_{k}" for k in ("accept", "edit", "skip", "flag"))}, count(refused) as n_refused from ({REPLAY}) as r group by 1""".replace("arg_max(position, seq) filter (true)", "arg_max(struct_pack(x := position), seq).x"))
def review_sessions(spark, sf):
    return review.sessions(_replay(spark, sf))


# Vectors that are alike


@query("""with v as (select min(vec_id) as id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings where embedding is not null group by embedding), p as (select a.id as a, b.id as b, list_cosine_similarity(a.e, b.e) as s from v as a join v as b on a.id < b.id)
select a, b, round(s, 6) as similarity from p where s >= 0.33""")
def similar_vectors(spark, sf):
    """All pairs of different vectors that are alike, over the whole table."""
    rows = read(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return similar.similar_vectors(rows, 0.33)[1].select("a", "b", F.round("similarity", 6).alias("similarity"))


@query("""with t as (select doc_id, lower(trim(text)) as key from documents where text is not null), k as (select key, bool_or(doc_id % 3 = 0) as held, count(*) as n from t group by 1)
select key, case when held then 1.0 else cast(length(key) as double) end as first, n from k""")
def embedding_cache(spark, sf):
    """Texts of all documents with their vectors: those that the cache has, and those that it gets."""
    d = read(spark, sf, "documents").where("text is not null").select(F.col("doc_id").alias("id"), "text")
    cache = d.where("id % 3 = 0").select(similar.cache_key().alias("key"), F.array(F.lit(1.0)).alias("embedding")).distinct()
    found, whole = similar.cached(d, cache, lambda m: m.select("key", F.array(F.char_length("key").cast("double")).alias("embedding")))
    counts = found.groupBy("key").agg(F.count("*").alias("n"))
    return counts.join(whole, "key").select("key", F.col("embedding")[0].alias("first"), "n")


# Catalogues compared by their digest trees

_VERSIONS = """v as (select lang as exam, cast(2020 + doc_id % 5 as varchar) as year, source as shift, cast(doc_id as varchar) as file, doc_id, sha256(coalesce(text, '')) as a, sha256(coalesce(text, '') || '!') as b, doc_id % 5 = 2 and lang = 'en' as touched from documents),
c as (select *, case when not touched then 'same' when doc_id % 3 = 0 then 'changed' when doc_id % 7 = 0 then 'added' when doc_id % 11 = 0 then 'removed' else 'same' end as change from v)"""


def _versions(spark, sf):
    d = read(spark, sf, "documents").select(F.col("lang").alias("exam"), (F.col("doc_id") % 5 + 2020).cast("string").alias("year"), F.col("source").alias("shift"), F.col("doc_id").cast("string").alias("file"), "doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    touched = F.expr("coalesce(doc_id % 5 = 2 and exam = 'en', false)")
    changed = touched & F.expr("doc_id % 3 = 0")
    added, removed = touched & F.expr("doc_id % 3 <> 0 and doc_id % 7 = 0"), touched & F.expr("doc_id % 3 <> 0 and doc_id % 7 <> 0 and doc_id % 11 = 0")
    old = d.where(~added).select("exam", "year", "shift", "file", F.sha2(text, 256).alias("digest"))
    new = d.where(~removed).select("exam", "year", "shift", "file", F.sha2(F.concat(text, F.when(changed, "!").otherwise("")), 256).alias("digest"))
    return [digests.Catalogue.write(v, ev.folder(spark, "catalogue")) for v in (old, new)]


@query(f"with {_VERSIONS} select exam, year, shift, file, change from c where change <> 'same'")
def catalogue_differences(spark, sf):
    """Files of two versions of a catalogue that differ, found from the root down."""
    return digests.differences(*_versions(spark, sf))


@query(f"with {_VERSIONS}, t as (select * from c where change <> 'same') select 0 as level, 1 as branches where exists (select 1 from t) union all select 1, count(distinct exam) from t union all select 2, count(distinct exam || '/' || year) from t union all select 3, count(distinct exam || '/' || year || '/' || coalesce(shift, '?')) from t")
def catalogue_branches(spark, sf):
    """How many branches differ on each level: below those that agree nothing is read."""
    levels = digests.changed_branches(*_versions(spark, sf))
    counts = [d.agg(F.lit(k).alias("level"), F.count("*").alias("branches")) for k, d in enumerate(levels)]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@query("select exam || '/' || cast(year as varchar) || '/' || shift as key, count(*) as total, array_to_string(list_sort(list_distinct(list(subject))), ',') as subjects, count(*) as files from {v_questions} as v group by exam, year, shift")
def catalogue_index(spark, sf):
    """The catalogue's index, made anew from the questions; a paper's checksum is its branch's digest, and two orders of the rows give the same one."""
    q = questions(spark, sf).select("exam", F.col("year").cast("string").alias("year"), "shift", "subject", F.col("pos").cast("string").alias("file"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    one, two = digests.index(q, q), digests.index(q.repartition(5, "digest"), q)
    agreed = one.join(two.select(F.col("key").alias("k"), F.col("checksum").alias("c")), (F.col("key") == F.col("k")) & (F.col("checksum") == F.col("c")))
    sizes = digests.tree(q).where("level = 3").select(F.concat_ws("/", "exam.name", "year.name", "shift.name").alias("key"), "files")
    return agreed.join(sizes, "key").select("key", "total", F.array_join("subjects", ",").alias("subjects"), "files")


# Archives read by ranges

IN_ARCHIVE = 40  # pages that are zipped together


def _zipped(spark, sf):
    """Archives of the pages' html, IN_ARCHIVE to one, written to a shared folder; every seventh is cut off in its middle. (path)"""
    root = ev.folder(spark, "archives")
    pages = read(spark, sf, "pages").select(F.floor(F.col("page_id") / IN_ARCHIVE).alias("archive"), "page_id", F.coalesce("html", F.lit("")).alias("html"))

    def pack(held, number):
        raw = io.BytesIO()
        with zipfile.ZipFile(raw, "w") as z:
            for k, (page, html) in enumerate(held):
                z.writestr(f"pages/{page}.html", html, zipfile.ZIP_DEFLATED if k % 2 else zipfile.ZIP_STORED)
        return raw.getvalue()[: raw.tell() // 2 if number % 7 == 3 else None]

    def run(batches):
        at, held = None, []
        for b in batches:
            for archive, page, html in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                if archive != at and held:
                    yield pa.RecordBatch.from_arrays([pa.array([f"{at}.zip"]), pa.array([pack(held, at)], pa.binary())], names=["path", "content"])
                    held = []
                at = archive
                held.append((page, html))
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([f"{at}.zip"]), pa.array([pack(held, at)], pa.binary())], names=["path", "content"])

    made = pages.repartition("archive").sortWithinPartitions("archive", "page_id").mapInArrow(run, "path string, content binary")
    curate.write_files(made, root).select(F.sum("bytes")).collect()
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")


@query(f"""with p as (select page_id // {IN_ARCHIVE} as archive, page_id, coalesce(html, '') as html from pages)
select archive || '.zip' as archive, 'pages/' || page_id || '.html' as name, sha256(html) as digest, true as good from p where archive % 7 <> 3 union all select distinct archive || '.zip', null, null, false from p where archive % 7 = 3""")
def archive_members(spark, sf):
    """Members of zip archives, each read by its own range; an archive that was cut off is a row without a name."""
    out = readers.unzipped(_zipped(spark, sf))
    return out.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "name", F.sha2("content", 256).alias("digest"), F.col("error").isNull().alias("good"))


# Recorded services

_RECORDED = """r as (select page_id, case page_id % 3 when 0 then 'ocr' when 1 then 'annotate' else 'extract' end as service, page_id % 10 <> 4 as ok, case when page_id % 10 <> 4 then html end as answer, case when page_id % 10 = 4 then 'HTTP 500' end as error, cast(1 + page_id % 4 as bigint) as turn from pages)"""


def _recordings(spark, sf):
    """What three services answered on each page, in four turns; one turn at a time."""
    rows = spark.sql(f"with {_RECORDED.replace('from pages', 'from {p}')} select service, cast(page_id as string) as request, ok, answer, error, turn from r", p=read(spark, sf, "pages"))
    root = ev.folder(spark, "recordings")
    for turn in range(1, 5):
        recorded.record(rows.where(F.col("turn") == turn), root, turn)
        yield root


@query(f"with {_RECORDED} select service, cast(page_id as varchar) as request, sha256(coalesce(answer, '')) as answer, turn from r where service in ('ocr', 'extract') and ok")
def recorded_answers(spark, sf):
    """Good answers of two services; the source opens no file of the third."""
    *_, root = _recordings(spark, sf)
    rows = recorded.read(spark, root, ["ocr", "extract"], ok=True)
    return rows.select("service", "request", F.sha2(F.coalesce("answer", F.lit("")), 256).alias("answer"), "turn")


@query(f"with {_RECORDED} select service, turn, count(*) as n, count(*) filter (not ok) as failed, sum(strlen(coalesce(answer, ''))) as bytes from r group by 1, 2")
def recorded_stream(spark, sf):
    """The same as a stream that is stopped after each turn and goes on with the next one."""
    out, state = ev.folder(spark, "recorded-out"), ev.folder(spark, "recorded-state")
    for root in _recordings(spark, sf):
        rows = recorded.register(spark).readStream.format("recorded").load(root)
        ended = rows.writeStream.option("checkpointLocation", state).trigger(once=True).foreachBatch(lambda b, k: b.write.mode("overwrite").parquet(f"{out}/batch={k}")).start()
        ended.awaitTermination()
    seen = spark.read.parquet(out)
    return seen.groupBy("service", "turn").agg(F.count("*").alias("n"), F.count_if(~F.col("ok")).alias("failed"), F.sum(F.octet_length(F.coalesce("answer", F.lit("")))).alias("bytes"))
