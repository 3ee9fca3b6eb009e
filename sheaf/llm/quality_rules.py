"""Quality rules with host verdicts (operator 1).

Each document is measured once; its rule failures are summed by host, each host's failure rate of each rule is shrunk
with a beta prior fitted to all hosts, and the verdict goes back to the documents by a join. The prior's weight comes from the
spread between hosts that binomial noise doesn't explain (moments of the beta-binomial, hosts weighted by their size), so
many small hosts with the same rate give a heavy prior and not a light one. A host is condemned by a rule if its rate is above
the limit even when `caution` posterior deviations are taken off. The documents of a condemned host are held to that rule's stricter
limit (`STRICT`): what would pass elsewhere, as it is only near the limit, goes, and what is far from it stays.

Defined results: a null or empty text has no words and fails the base rules; a null host is a host of its own; repeated
rows are measured and judged each for itself, also if they share an id or have none; an empty table gives no rows; further
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sheaf.llm.common import TEXTS, prepare, table, to_batch, written

SYMBOLS = "#*$%&|<>"
MIX = np.uint64(0x9E3779B97F4A7C15)
MEASURES = pa.schema([("doc_id", pa.int64()), ("host", pa.string())] + [(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")])
MEASURES_DDL = "doc_id long, host string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


@dataclass(frozen=True)
class Rules:
    """Limits of the rules: few_words and repeats are base rules, which no document may break; the others count for the host."""

    min_words: int = 10
    repeat_percent: int = 20
    symbol_percent: int = 30  # symbols to words
    dup_line_percent: int = 30
    min_mean_word: float = 2.0
    max_mean_word: float = 20.0
    host_rate: float = 0.5  # shrunk failure rate above which a host is condemned by a rule
    caution: float = 2.0  # posterior deviations that are taken off the rate before


#: What a document of a host that is condemned by a rule has to keep of that rule.
STRICT = Rules(min_words=20, repeat_percent=10, symbol_percent=15, dup_line_percent=15, min_mean_word=3.0, max_mean_word=15.0)
RULE_NAMES = ("few_words", "repeats", "symbols", "dup_lines", "word_length")


def repeat_words(words: list[bytes], n: int = 5) -> int:
    """Words inside windows of n words that the text holds twice or more."""
    if len(words) <= n:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.uint64, len(words))
    h = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        h = (h ^ (h >> np.uint64(29))) * MIX + ids[k : len(ids) - n + 1 + k] + np.uint64(1)
    _, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    if not twice.any():
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    edge[at] += 1
    np.add.at(edge, at + n, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measure(text: str | None) -> tuple[int, int, int, int, int, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n_chars = len(text or "")
    blanks = sum(raw.count(c) for c in (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c"))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return len(words), n_chars - blanks, sum(raw.count(c.encode()) for c in SYMBOLS), len(lines), len(lines) - len(set(lines)), repeat_words(words)


def _measured(carried: bool):
    """Rows (doc_id, host, more) measured by the text in `more`, which goes on if it is carried."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [measure(t) for t in b.column(2).field("text").to_pylist()]
            cols = list(zip(*got, strict=True)) or [()] * 6
            out = to_batch({"doc_id": b.column(0), "host": b.column(1)} | dict(zip(MEASURES.names[2:], cols, strict=True)), MEASURES)
            yield pa.RecordBatch.from_arrays([*out.columns, b.column(2)], names=[*out.schema.names, "more"]) if carried else out

    return run


def failures(rules: Rules) -> dict[str, Column]:
    """0 or 1 for each rule, from a document's measures."""
    n = F.col("n_words")
    bad = {
        "few_words": n < rules.min_words,
        "repeats": 100 * F.col("n_repeat_words") > rules.repeat_percent * n,
        "symbols": 100 * F.col("n_symbols") > rules.symbol_percent * n,
        "dup_lines": 100 * F.col("n_dup_lines") > rules.dup_line_percent * F.col("n_lines"),
        "word_length": (F.col("word_chars") < rules.min_mean_word * n) | (F.col("word_chars") > rules.max_mean_word * n),
    }
    return {k: v.cast("int") for k, v in bad.items()}


MIN_WEIGHT, MAX_WEIGHT = 1.0, 1000.0  # documents that the prior may weigh


def host_verdicts(measures: DataFrame, rules: Rules) -> DataFrame:
    """A row for each host: documents, failures, shrunk rate and verdict for each rule. The driver gets one row of moments."""
    hosts = measures.groupBy("host").agg(F.count("*").alias("n_docs"), *(F.sum(c).alias(f"bad_{k}") for k, c in failures(rules).items()))
    hosts = written(hosts, "hosts")
    n = F.col("n_docs")
    moments = hosts.agg(F.count("*").alias("hosts"), F.sum(n).alias("docs"), F.sum(n.cast("double") * n).alias("squares"), *(c for k in RULE_NAMES for c in (F.sum(f"bad_{k}").alias(f"x_{k}"), F.sum(F.col(f"bad_{k}") / n * F.col(f"bad_{k}")).alias(f"xx_{k}")))).first()
    for k in RULE_NAMES:
        mean, weight = beta_prior(moments["hosts"], moments["docs"] or 0, moments["squares"] or 0.0, moments[f"x_{k}"] or 0, moments[f"xx_{k}"] or 0.0)
        rate = (F.col(f"bad_{k}") + F.lit(mean * weight)) / (n + F.lit(weight))
        hosts = hosts.withColumn(f"rate_{k}", rate)
        hosts = hosts.withColumn(f"condemned_{k}", F.col(f"rate_{k}") - rules.caution * F.sqrt(F.col(f"rate_{k}") * (1 - F.col(f"rate_{k}")) / (n + weight + 1)) > rules.host_rate)
    return hosts


def beta_prior(hosts: int, docs: int, squares: float, failed: int, shares: float) -> tuple[float, float]:
    """Mean and weight (in documents) of the beta prior, from the sums over hosts of 1, n, n**2, x and x**2 / n.

    Between hosts of equal rates the weighted squares of their rates' deviations sum to m * (1 - m) * (hosts - 1); what is above
    that is the spread of the rates themselves. No such spread, or no second host: the greatest weight.
    """
    if not docs:
        return 0.0, MAX_WEIGHT
    m = failed / docs
    noise, spare = m * (1 - m), docs - squares / docs
    if noise <= 0 or spare <= 0:
        return m, MAX_WEIGHT
    spread = (shares - failed * m - noise * (hosts - 1)) / spare
    return m, min(max(noise / spread - 1, MIN_WEIGHT), MAX_WEIGHT) if spread > 0 else MAX_WEIGHT


def judged(docs: DataFrame, rules: Rules, strict: Rules, host: Column | str, carry: tuple[str, ...]) -> DataFrame:
    """Measures, base verdict and final verdict of each row, with a struct `more` of the carried columns, text among them."""
    prepare(docs.sparkSession)
    host = F.col(host) if isinstance(host, str) else host
    schema, more = StructType.fromDDL(MEASURES_DDL), F.struct(*(carry or ("text",))).alias("more")
    if carry:
        schema = schema.add(docs.select(more).schema[0])
    rows = docs.select("doc_id", host.cast("string").alias("host"), more).mapInArrow(_measured(bool(carry)), schema)
    rows = written(rows, "measures", compression=TEXTS if carry else None)
    condemned = [f"condemned_{k}" for k in RULE_NAMES]
    verdicts = host_verdicts(rows.drop("more"), rules).where(" or ".join(condemned)).select(F.col("host").alias("_host"), *condemned)
    joined = rows.join(verdicts, F.col("host").eqNullSafe(F.col("_host")), "left")
    bad = failures(rules)
    base = (bad["few_words"] == 1) | (bad["repeats"] == 1)
    lost = F.lit(False)
    for k, c in failures(strict).items():
        lost = lost | ((c == 1) & F.coalesce(F.col(f"condemned_{k}"), F.lit(False)))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), (~base & ~lost).alias("kept"), *(["more"] if carry else []))


def quality_rules(docs: DataFrame, rules: Rules = Rules(), strict: Rules = STRICT, host: Column | str = "source") -> DataFrame:
    """Measures, base verdict and final verdict of each document. kept is false after a base failure, or if the document breaks the stricter limit of a rule by which its host is condemned."""
    return judged(docs, rules, strict, host, ())


def without_rejected(docs: DataFrame, rules: Rules = Rules(), strict: Rules = STRICT, host: Column | str = "source") -> DataFrame:
    """The rows that are kept, with all their columns: each row's own verdict decides, whatever id it has."""
    return judged(docs, rules, strict, host, tuple(docs.columns)).where("kept").select("more.*")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    r = Rules()

    def broken(r: Rules) -> dict[str, str]:
        return {
            "few_words": f"n_words < {r.min_words}",
            "repeats": f"100 * n_repeat_words > {r.repeat_percent} * n_words",
            "symbols": f"100 * n_symbols > {r.symbol_percent} * n_words",
            "dup_lines": f"100 * n_dup_lines > {r.dup_line_percent} * n_lines",
            "word_length": f"word_chars < {r.min_mean_word} * n_words or word_chars > {r.max_mean_word} * n_words",
        }

    bad, near = broken(r), broken(STRICT)
    m = lambda k: f"(sum(bad_{k}) / sum(n_docs))"
    noise = lambda k: f"({m(k)} * (1 - {m(k)}))"
    spare = "(sum(n_docs) - sum(cast(n_docs as double) * n_docs) / sum(n_docs))"
    spread = lambda k: f"((sum(bad_{k} / n_docs * bad_{k}) - sum(bad_{k}) * {m(k)} - {noise(k)} * (count(*) - 1)) / {spare})"
    prior = ", ".join(f"{m(k)} as m_{k}, case when {noise(k)} > 0 and {spare} > 0 and {spread(k)} > 0 then least(greatest({noise(k)} / {spread(k)} - 1, {MIN_WEIGHT}), {MAX_WEIGHT}) else {MAX_WEIGHT} end as w_{k}" for k in bad)
    shrunk = lambda k: f"((bad_{k} + m_{k} * w_{k}) / (n_docs + w_{k}))"
    return rf"""
with base as (select doc_id, source as host, coalesce(text, '') as text from documents),
words as (select doc_id, host, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from base),
grams as (select doc_id, i, w[i:i + 4] as g from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from words where len(w) >= 5)),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as c from grams) where c > 1),
covered as (select doc_id, count(distinct i + k) as n_repeat_words from twice, range(5) r(k) group by doc_id),
m as (select doc_id, host, cast(len(w) as bigint) as n_words, cast(list_sum(list_transform(w, lambda x: length(x))) as bigint) as wc, cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
  len(lines) as n_lines, cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines from words),
f as (select m.doc_id, host, n_words, coalesce(wc, 0) as word_chars, n_symbols, n_lines, n_dup_lines, cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words from m left join covered using (doc_id)),
flags as (select *, {", ".join(f"cast(({c}) as int) as f_{k}" for k, c in bad.items())} from f),
hosts as (select host, count(*) as n_docs, {", ".join(f"sum(f_{k}) as bad_{k}" for k in bad)} from flags group by host),
prior as (select {prior} from hosts),
verdicts as (select host, {", ".join(f"{shrunk(k)} - {r.caution} * sqrt({shrunk(k)} * (1 - {shrunk(k)}) / (n_docs + w_{k} + 1)) > {r.host_rate} as c_{k}" for k in bad)} from hosts, prior)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (f_few_words = 1 or f_repeats = 1) as base_failed,
  not (f_few_words = 1 or f_repeats = 1) and not ({" or ".join(f"(({near[k]}) and c_{k})" for k in bad)}) as kept
from flags left join verdicts on flags.host is not distinct from verdicts.host"""


ORACLES = {"op1_quality_rules": _oracle()}
