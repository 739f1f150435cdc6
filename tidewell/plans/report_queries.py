"""Queries over reports and decisions, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import classify, reports
from tidewell.plans.identity_queries import JOBS, _jobs
from tidewell.plans.tables import read

STATUS = "case event_type when 'error' then 500 else 200 end"


def host_liveness(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select("user_id", F.to_date("ts").alias("day"), F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"))
    return reports.host_liveness(e, ["user_id", "day"], "status")


HOST = f"""select user_id, cast(ts as date) as day, max(case when {STATUS} = 200 then 1 else 0 end) as has_2xx, max(case when {STATUS} = 500 then 1 else 0 end) as has_4xx_5xx,
  max(case when {STATUS} = 200 then 1 else 0 end) = 0 and max(case when {STATUS} = 500 then 1 else 0 end) = 1 as dead from events group by all"""


def topn_per_group(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return reports.top_n(o, ["o_orderpriority"], [F.desc("o_totalprice"), F.col("o_orderkey")], 10)


TOPN = "select o_orderkey, o_orderpriority, o_totalprice, cast(row_number() over (partition by o_orderpriority order by o_totalprice desc, o_orderkey) as integer) as place from orders qualify place <= 10"


def recent_dates(spark: SparkSession, d: str) -> DataFrame:
    return reports.recent_values(read(spark, d, "events").select(F.to_date("ts").alias("day")), "day", 7)


RECENT = "select distinct cast(ts as date) as day from events order by day desc limit 7"
BANDS = [("S+", 10), ("S", 100), ("A", 400), ("B", 900)]


def rank_bands(spark: SparkSession, d: str) -> DataFrame:
    """Orders as domains with several ranks, the best counts; customers ask for their band."""
    ranks = read(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.expr("o_orderkey % 1200").alias("rank"))
    best = reports.best_rank(ranks, "c_custkey", "rank", 1100)
    c = read(spark, d, "customer").select("c_custkey").join(best, "c_custkey", "left")
    return c.select("c_custkey", "rank", reports.band(F.col("rank"), BANDS).alias("band"))


RANKS = """select c_custkey, min(rank) as rank, case when min(rank) <= 10 then 'S+' when min(rank) <= 100 then 'S' when min(rank) <= 400 then 'A' when min(rank) <= 900 then 'B' else 'D' end as band
from customer left join (select o_custkey, o_orderkey % 1200 as rank from orders where o_orderkey % 1200 <= 1100) on c_custkey = o_custkey group by c_custkey"""


def scan_report(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select(
        F.to_date("ts").alias("run_date"), F.col("event_type").alias("source_pipeline"), F.lit(1).cast("long").alias("boards_scanned"), F.expr("cast(event_id % 3 as bigint)").alias("new_jobs_added"),
        (F.col("value") > 489).alias("failed"),
    )
    return reports.scan_report(e, ["run_date", "source_pipeline"], ["boards_scanned", "new_jobs_added"], "failed")


SCAN = """select cast(ts as date) as run_date, event_type as source_pipeline, cast(count(*) as bigint) as boards_scanned, cast(sum(event_id % 3) as bigint) as new_jobs_added,
  case when max(value > 489) then 'failed' else 'ok' end as status from events group by all"""


def _deltas(spark: SparkSession, d: str) -> DataFrame:
    metric = F.expr("case event_id % 3 when 0 then 'platform__' || event_type when 1 then 'country__c' || user_id % 9 else 'pages' end")
    return read(spark, d, "events").select((F.col("user_id") % 4).alias("campaign"), metric.alias("metric"), F.expr("cast(event_id % 7 as bigint)").alias("delta"), F.col("ts").alias("updated_at"))


DELTAS = """deltas as (select user_id % 4 as campaign, case event_id % 3 when 0 then 'platform__' || event_type when 1 then 'country__c' || user_id % 9 else 'pages' end as metric,
  cast(event_id % 7 as bigint) as delta, ts as updated_at from events)"""


def stat_tallies(spark: SparkSession, d: str) -> DataFrame:
    return reports.tally(_deltas(spark, d))


TALLY = f"""with {DELTAS} select case when starts_with(metric, 'platform__') then 'platform' when starts_with(metric, 'country__') then 'country' else 'other' end as kind,
  regexp_replace(metric, '^(platform|country)__', '') as key, cast(sum(delta) as bigint) as n, min(updated_at) as first, max(updated_at) as last from deltas group by 1, 2"""


def skipped_values(spark: SparkSession, d: str) -> DataFrame:
    # Orders without urgency have no value here; the two first priorities are allowed.
    orders = spark.read.parquet(f"{d}/orders.parquet")
    value = F.when(F.col("o_orderpriority").startswith("5"), " ").otherwise(F.concat("o_orderpriority", F.lit("/"), F.pmod("o_custkey", F.lit(29))))
    return reports.skipped_values(orders, value, [f"1-URGENT/{k}" for k in range(29)] + [f"2-HIGH/{k}" for k in range(29)])


SKIPPED = """with v as (select case when starts_with(o_orderpriority, '5') then '' else o_orderpriority || '/' || (o_custkey % 29) end as value from orders),
s as (select value, count(*) as n from v where value not like '1-URGENT/%' and value not like '2-HIGH/%' group by value),
t as (select coalesce(sum(n) filter (where value = ''), 0) / greatest(sum(n), 1)::double as empty_share from s)
select value, n, empty_share from s, t where value <> '' order by n desc, value limit 40"""


def campaign_summary(spark: SparkSession, d: str) -> DataFrame:
    return reports.campaign_summary(_deltas(spark, d))


CAMPAIGN = f"""with {DELTAS}, s as (select campaign, (epoch_us(max(updated_at)) - epoch_us(min(updated_at))) / 1e6::double as seconds from deltas group by campaign)
select d.campaign, metric, cast(sum(delta) as bigint) as n, any_value(seconds) as seconds from deltas d join s on d.campaign = s.campaign group by d.campaign, metric"""


def signal_mix(spark: SparkSession, d: str) -> DataFrame:
    has = lambda c, n: F.when(c, n)
    signals = F.array_compact(F.array(has(F.col("l_discount") > 0.05, "schema"), has(F.col("l_tax") > 0.04, "links"), has(F.col("l_quantity") > 25, "martech")))
    rows = read(spark, d, "lineitem").select(signals.alias("signals"), "l_returnflag")
    return reports.signal_mix(rows, "signals", F.col("l_returnflag") != "N")


SIGNALS = """with k as (from lineitem where l_returnflag <> 'N'), x as (
  select 'schema' as signal, count(*) filter (where l_discount > 0.05) as n from k union all select 'links', count(*) filter (where l_tax > 0.04) from k union all select 'martech', count(*) filter (where l_quantity > 25) from k)
select signal, n, n / greatest((select count(*) from k), 1) as share from x where n > 0"""


def blank_rate_ema(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select(F.to_date("ts").alias("run"), "event_type", "value")
    rates = reports.blank_rates(e, "run", "event_type", F.col("value") < 120)
    return reports.moving_average(rates, "run", "event_type").select("event_type", "run", F.round("rate", 6).alias("rate"), "ema", "spike")


EMA = """
with recursive r as (select cast(ts as date) as run, event_type, sum(case when value < 120 then 1 else 0 end)::double / count(*) as rate, row_number() over (partition by event_type order by cast(ts as date)) as k
  from events group by 1, 2 having count(*) >= 10),
e as (select event_type, run, k, rate, cast(null as double) as before, floor(rate * 10000 + 0.5) / 10000 as ema from r where k = 1
  union all select r.event_type, r.run, r.k, r.rate, e.ema, floor((0.3::double * r.rate + (1 - 0.3::double) * e.ema) * 10000 + 0.5) / 10000 from e join r on r.event_type = e.event_type and r.k = e.k + 1)
select event_type, run, round(rate, 6) as rate, ema, coalesce(rate - before > 0.15, false) as spike from e"""


def error_digest(spark: SparkSession, d: str) -> DataFrame:
    msg = F.concat(F.lit("["), F.col("event_type"), F.lit("] "), F.when(F.col("user_id") % 3 == 0, "ERROR").otherwise("WARNING"), F.lit(" status "), (F.lit(400) + F.col("user_id") % 5).cast("string"), F.lit(" #"), F.col("event_id"))
    return reports.error_digest(read(spark, d, "events").select(msg.alias("message"), "ts"), "message", "ts")


DIGEST = """
with l as (select event_type as source, case when user_id % 3 = 0 then 'ERROR' else 'WARNING' end as level, cast(400 + user_id % 5 as varchar) as code, ts,
  '[' || event_type || '] ' || case when user_id % 3 = 0 then 'ERROR' else 'WARNING' end || ' status ' || (400 + user_id % 5) || ' #' || event_id as message from events),
c as (select source, level, code, count(*) as k from l group by all),
b as (select source, level, code, row_number() over (partition by source, level order by k desc, code) as p from c)
select l.source, l.level, count(*) as n, arg_min(message, (ts, message)) as example, any_value(b.code) as code from l join b on l.source = b.source and l.level = b.level and p = 1 group by l.source, l.level"""


def repeated_siblings(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_returnflag").alias("tag"), F.when(F.col("l_linenumber") < 3, "").otherwise(F.col("l_linestatus")).alias("cls"), F.col("l_partkey").alias("url"))
    return reports.repeated_siblings(li, 2, 2)


SIBLINGS = """select l_orderkey as page, l_returnflag as tag, case when l_linenumber < 3 then '' else l_linestatus end as cls, count(distinct l_partkey) as urls from lineitem group by all having urls >= 2"""


def bin_pack(spark: SparkSession, d: str) -> DataFrame:
    units = read(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n")).collect()  # 25 nations
    packed = reports.pack_bins([(str(r["c_nationkey"]), r["n"]) for r in units], 4)
    return spark.createDataFrame(packed, "unit string, weight long, bin int")


def _lattice(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").selectExpr(
        "event_id", "event_id % 17 <> 0 as form_ok", "case event_id % 3 when 0 then 'match' when 1 then 'no_match' else 'unsure' end as result",
        "case event_id % 5 when 0 then 'blank' when 1 then 'bare_remote' else 'global_plus_place' end as reason", "case event_id % 2 when 0 then '1' else '2' end as priority",
        "case event_id % 7 when 0 then 'match_global' when 1 then 'match_africa' when 2 then 'uncertain' when 3 then 'no_match' end as label",
        "case event_id % 4 when 0 then 'p1' when 1 then 'p2' end as provider", "event_id % 11 < 6 as has_question", "event_id % 13 = 0 as excluded",
        "case when event_id % 19 = 0 then '4a' end as rank4", "case when event_id % 19 = 0 then 'narrow' end as rank4_reason", "case when event_id % 23 = 0 then '' else 'u' || event_id end as url",
    )


LATTICE_ROWS = """rows_ as (select event_id, event_id % 17 <> 0 as form_ok, case event_id % 3 when 0 then 'match' when 1 then 'no_match' else 'unsure' end as result,
  case event_id % 5 when 0 then 'blank' when 1 then 'bare_remote' else 'global_plus_place' end as reason, case event_id % 2 when 0 then '1' else '2' end as priority,
  case event_id % 7 when 0 then 'match_global' when 1 then 'match_africa' when 2 then 'uncertain' when 3 then 'no_match' end as label,
  case event_id % 4 when 0 then 'p1' when 1 then 'p2' end as provider, event_id % 11 < 6 as has_question, event_id % 13 = 0 as excluded,
  case when event_id % 19 = 0 then '4a' end as rank4, case when event_id % 23 = 0 then '' else 'u' || event_id end as url from events)"""


def rank_lattice(spark: SparkSession, d: str) -> DataFrame:
    out = classify.rank_lattice(_lattice(spark, d))
    return out.select("event_id", "branch", "location_priority", "clearance", "confidence", "exclude")


LATTICE = f"""
with {LATTICE_ROWS}, b as (select *, case when not form_ok then 'deferred' when result = 'match' then 'match'
  when result = 'unsure' and not excluded and reason = 'blank' and coalesce(label, '') in ('match_global', 'match_africa') then '3a'
  when result = 'unsure' and not excluded and has_question and reason <> 'blank' and coalesce(label, '') in ('match_global', 'match_africa') then '3b'
  when result = 'unsure' and not excluded and has_question and reason = 'bare_remote' and coalesce(label, '') = 'uncertain' and provider is not null then '3b'
  when rank4 is not null then 'rank4' else 'drop' end as branch from rows_)
select event_id, branch, case when branch = 'match' then priority when branch in ('3a', '3b') then branch when branch = 'rank4' then rank4 end as location_priority,
  case when branch = 'match' then 'regex' when branch in ('3a', '3b') then coalesce(provider, 'ai') when branch = 'rank4' then 'rank4' end as clearance,
  case when branch = 'match' then 'match' when branch in ('3a', '3b') then 'uncertain' when branch = 'rank4' then 'narrow' end as confidence,
  branch = 'drop' and result = 'unsure' and not excluded and provider is not null and url <> '' as exclude from b"""


def revalidate_plan(spark: SparkSession, d: str) -> DataFrame:
    jobs = _jobs(spark, d)
    c = F.expr("case id % 6 when 0 then 'ai_unreviewed' when 1 then 'rank4' else clearance end")
    scope = F.expr("case id % 4 when 0 then 'no_match' else 'match' end")
    due = classify.stale_first(jobs, "classifier_version", 18, "id", 3000)
    verdict = classify.revalidate(F.col("id") % 9 == 0, c, F.col("id") % 5 < 3, F.col("id") % 2 == 0, scope, F.col("application_status"))
    return due.select("id", "due", verdict.alias("verdict"), classify.plan_of(verdict).alias("plan"))


REVALIDATE = f"""
with {JOBS}, s as (select *, row_number() over (order by classifier_version, id) <= 3000 as due,
  case id % 6 when 0 then 'ai_unreviewed' when 1 then 'rank4' else clearance end as c from jobs where classifier_version < 18),
v as (select *, case when id % 9 = 0 and coalesce(c, '') <> 'ai_unreviewed' then 'undecided' when c = 'ai_unreviewed' then 'veto' when c = 'rank4' and not id % 5 < 3 then 'undecided'
  when c = 'rank4' then case when id % 2 = 0 then 'keep' else 'veto' end when id % 4 = 0 then 'veto' else 'keep' end as v0 from s),
w as (select *, case when v0 = 'veto' and application_status <> 'not_applied' then 'protected' else v0 end as verdict from v)
select id, due, verdict, case when verdict = 'veto' then 'veto' when verdict in ('keep', 'protected') then 'stamp' else 'retry' end as plan from w"""


def detection_cascade(spark: SparkSession, d: str) -> DataFrame:
    hits = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("domain"), F.col("l_linenumber").alias("tier"), F.col("l_returnflag").alias("ats"), F.col("l_suppkey").alias("slug"), F.col("l_partkey").alias("url")).where("url % 3 <> 0")
    return classify.first_tier(hits, "domain", "tier", ["ats", "slug"], "url")


CASCADE = """with h as (select l_orderkey as domain, l_linenumber as tier, l_returnflag as ats, l_suppkey as slug, l_partkey as url from lineitem where l_partkey % 3 <> 0)
select domain, tier, ats, slug, min(url) as url from h where tier = (select min(tier) from h x where x.domain = h.domain) group by all"""


def fetch_failures(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").selectExpr("cast(case event_id % 6 when 0 then 200 when 1 then 404 when 2 then 429 when 3 then 503 when 4 then 403 else 418 end as int) as status", "case when event_id % 10 = 0 then 'Connection reset by peer' when event_id % 15 = 1 then 'TimeoutError' end as error")
    kind = classify.fetch_failure(F.col("status"), F.col("error"))
    return e.groupBy(kind.alias("kind")).agg(F.count("*").alias("n")).withColumn("transient", F.coalesce(F.col("kind").isin(*classify.TRANSIENT), F.lit(False)))


FAILURES = """with e as (select case when event_id % 10 = 0 then 'connection' when event_id % 15 = 1 then 'timeout'
  else case event_id % 6 when 0 then null when 1 then 'not_found' when 2 then 'rate_limited' when 3 then 'server_error' when 4 then 'blocked' else 'client_error' end end as kind from events)
select kind, count(*) as n, coalesce(kind in ('timeout', 'connection', 'server_error', 'rate_limited'), false) as transient from e group by kind"""


def registry_states(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "supplier").selectExpr("s_nationkey", "case s_suppkey % 5 when 0 then null when 1 then false else true end as alive", "s_suppkey % 3 as jobs")
    return s.groupBy("s_nationkey", classify.registry_state(F.col("alive"), F.col("jobs")).alias("state")).agg(F.count("*").alias("n"))


STATES = """select s_nationkey, case when s_suppkey % 5 = 0 then 'unverified' when s_suppkey % 5 = 1 then 'dead' when s_suppkey % 3 > 0 then 'active' else 'empty' end as state, count(*) as n from supplier group by all"""


def longest_text(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "documents").select("source", "doc_id", F.length("text").alias("size"))
    return classify.longest_text(c, "source", "doc_id", "size", "doc_id")


LONGEST = "select source, arg_max(doc_id, (length(text), -doc_id)) as doc_id, cast(max(length(text)) as integer) as size from documents group by source"

QUERIES = {
    "host_liveness": (host_liveness, HOST),
    "topn_per_group": (topn_per_group, TOPN),
    "recent_dates": (recent_dates, RECENT),
    "rank_bands": (rank_bands, RANKS),
    "scan_report": (scan_report, SCAN),
    "stat_tallies": (stat_tallies, TALLY),
    "skipped_values": (skipped_values, SKIPPED),
    "campaign_summary": (campaign_summary, CAMPAIGN),
    "signal_mix": (signal_mix, SIGNALS),
    "blank_rate_ema": (blank_rate_ema, EMA),
    "error_digest": (error_digest, DIGEST),
    "repeated_siblings": (repeated_siblings, SIBLINGS),
    "bin_pack": (bin_pack, None),
    "rank_lattice": (rank_lattice, LATTICE),
    "revalidate_plan": (revalidate_plan, REVALIDATE),
    "detection_cascade": (detection_cascade, CASCADE),
    "fetch_failures": (fetch_failures, FAILURES),
    "registry_states": (registry_states, STATES),
    "longest_text": (longest_text, LONGEST),
}
