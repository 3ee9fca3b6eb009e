"""SQL for the corpus queries that it can express."""

from __future__ import annotations

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: Bits of the hexadecimal digest, five at a time, as base32.
_BITS = "list_aggregate(list_transform(range(1, 41), lambda k: substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * cast(strpos('0123456789abcdef', substr(h, cast(k as int), 1)) as int) - 3, 4)), 'string_agg', '')"
_FIVE = " + ".join(f"{16 >> i} * cast(substr(bits, cast(5 * k + {i + 1} as int), 1) as int)" for i in range(5))
WARC = f"""with p as (select page_id, coalesce(html, '') as body from pages),
hashed as (select page_id, body, sha1(body) as h, max(page_id) over (partition by body) as last from p),
bits as (select *, {_BITS} as bits from hashed)
select page_id, cast(strlen(body) as bigint) as payload_bytes, list_aggregate(list_transform(range(32), lambda k: substr('{BASE32}', cast(1 + {_FIVE} as int), 1)), 'string_agg', '') as payload_digest,
  case when page_id = last then 'response' else 'revisit' end as record_type, case when page_id <> last then last end as refers_to from bits"""

NEAR = r"""with recursive words as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
sets as (select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s from words),
sizes as (select doc_id, cast(len(s) as bigint) as n from sets), items as (select doc_id, unnest(s) as g from sets),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from items as a join items as b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
links as (select a, b from common join sizes as x on x.doc_id = a join sizes as y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)), both_ways as (select a, b from links union select b, a from links),
reach as (select a, b from both_ways union select r.a, l.b from reach as r join both_ways as l on r.b = l.a)
select doc_id, n as n_shingles, least(doc_id, coalesce(m, doc_id)) as component_id, coalesce(m, doc_id) >= doc_id as kept from sizes left join (select a, min(b) as m from reach group by a) as r on r.a = doc_id"""

REPEATS = """with h as (select doc_id, hex(encode(coalesce(text, ''))) as x, cast(strlen(coalesce(text, '')) as bigint) as n from documents),
windows as (select doc_id, i, substr(x, cast(2 * i + 1 as int), 200) as w from (select doc_id, x, unnest(range(0, n - 99)) as i from h where n >= 100) as q),
later as (select doc_id, i from (select doc_id, i, row_number() over (partition by w order by doc_id, i) as rn from windows) as q where rn > 1),
marked as (select doc_id, i, case when i - lag(i) over (partition by doc_id order by i) <= 100 then 0 else 1 end as fresh from later),
runs as (select doc_id, min(i) as a, max(i) + 100 as b from (select doc_id, i, sum(fresh) over (partition by doc_id order by i rows unbounded preceding) as run from marked) as q group by doc_id, run),
around as (select r.doc_id, a, coalesce(lag(b) over (partition by r.doc_id order by a), 0) as from_, b, x from runs as r join h on h.doc_id = r.doc_id),
kept as (select doc_id, string_agg(substr(x, cast(2 * from_ + 1 as int), cast(2 * (a - from_) as int)), '' order by a) || substr(any_value(x), cast(2 * max(b) + 1 as int)) as k, cast(sum(b - a) as bigint) as removed, count(*) as spans from around group by doc_id)
select h.doc_id, n as n_bytes, coalesce(removed, 0) as n_removed, coalesce(spans, 0) as n_spans, sha256(unhex(coalesce(k, x))) as kept_sha256 from h left join kept on kept.doc_id = h.doc_id"""

ORACLES = {"op4_warc": WARC, "op8_suffix_dedup": REPEATS, "op9_near_duplicates": NEAR}
