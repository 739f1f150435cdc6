"""Queries over scopes, paths and hosts: literal examples with the results the rules state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import filters, scope, urls
from tidewell.plans.tables import read

#: (location, result, reason or priority)
SCOPES = (
    ("Worldwide - US", "unsure", "global_plus_place"), ("Worldwide (US)", "unsure", "global_plus_place"), ("Global, Berlin", "unsure", "global_plus_place"),
    ("Worldwide; US", "unsure", "global_plus_place"), ("Worldwide, except US", "match", "1"), ("Worldwide (excluding US)", "match", "1"), ("Worldwide ex-US", "match", "1"),
    ("Anywhere except the UK", "match", "1"), ("Worldwide, outside the US", "match", "1"), ("Global (US only)", "no_match", "narrowed"), ("Anywhere in the US", "no_match", "narrowed"),
    ("Worldwide, US-based only", "no_match", "narrowed"), ("Global within Germany", "no_match", "narrowed"), ("Global, hybrid London", "no_match", "narrowed"),
    ("Worldwide, except Africa", "no_match", "exclusion names Africa"), ("Worldwide (excluding Nigeria)", "no_match", "exclusion names Africa"),
    ("Worldwide except EMEA", "no_match", "exclusion names Africa"), ("Global Business Services, Manila", "no_match", "place"), ("Worldwide except sanctioned countries", "unsure", "global_plus_place"),
    ("Remote", "unsure", "bare_remote"), ("", "unsure", "blank"), ("Worldwide", "match", "1"), ("EMEA", "match", "2"), ("Nairobi, Kenya; Lagos, Nigeria", "match", "2"), ("Paris, France", "no_match", "place"),
)


def broad_scopes(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.createDataFrame([(x,) for x, _, _ in SCOPES], "location string")
    s = scope.broad_scope_column("location")
    return rows.withColumn("s", s).select("location", F.get("s", F.lit(0)).alias("result"), F.get("s", F.lit(1)).alias("reason"))


SCOPE_SQL = "select location, result, reason from (values " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in SCOPES) + ") v(location, result, reason)"

#: (path, career, posting)
PATHS = (
    ("/careers", True, False), ("/blog/why-hiring-matters/", False, False), ("/jobs/events-marketing-manager-job-description", True, True), ("/careers/12345", True, True),
    ("/sap-successfactors-talent-modules-implementation-for-global-organizations", False, False), ("/about", False, False), ("/jobs/senior-sales-manager", True, True), ("/2024/05/hiring/", False, False),
)


def career_paths(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.createDataFrame([(p,) for p, _, _ in PATHS], "path string")
    return rows.select("path", filters.is_career_path(F.col("path")).alias("career"), filters.is_posting_path(F.col("path")).alias("posting"))


PATHS_SQL = "select path, career, posting from (values " + ", ".join(f"('{p}', {a}, {b})" for p, a, b in PATHS) + ") v(path, career, posting)"


def page_hosts(spark: SparkSession, d: str) -> DataFrame:
    """Hosts of pages: their first label, and whether it is a site's own machine's."""
    first = F.substring_index(urls.host(F.col("url")), ".", 1)
    return read(spark, d, "pages").select("page_id", first.alias("label"), filters.is_infra_host(first).alias("infra"), filters.is_parked(F.col("url"), F.col("html"), ["example.net"]).alias("parked"))


_INFRA = ", ".join(f"'{w}'" for w in filters.INFRA)
HOSTS_SQL = rf"""
with h as (select page_id, html, lower(regexp_extract(url, '^https?://([^/?#]*)', 1)) as host from pages), l as (select *, string_split(host, '.')[1] as label from h)
select page_id, label, len(list_intersect(regexp_split_to_array(label, '[-_]'), [{_INFRA}])) > 0 as infra,
  host = 'example.net' or ends_with(host, '.example.net') or regexp_matches(lower(regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)),
    '\b(page not found|404|not found|domain (is )?for sale|this domain|account suspended|site suspended|parked|coming soon)\b') as parked from l"""


def label_repair(spark: SparkSession, d: str) -> DataFrame:
    """Working-set labels against stored ranks: how many are right, to update, or without a row."""
    stored = read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") > 5000, "Global").when(F.col("c_acctbal") > 0, "EMEA").otherwise("Uncertain").alias("rank"))
    rows = read(spark, d, "orders").select((F.col("o_custkey") + F.when(F.col("o_orderkey") % 50 == 0, 10_000_000).otherwise(0)).alias("id"), F.when(F.col("o_orderkey") % 3 == 0, "Global").otherwise("EMEA").alias("label"))
    state = F.when(F.col("rank").isNull(), "skipped").when(F.col("rank") == F.col("label"), "already_correct").otherwise("updated")
    return rows.join(stored, "id", "left").groupBy(state.alias("state")).agg(F.count("*").alias("n"))


REPAIR_SQL = """
with s as (select c_custkey as id, case when c_acctbal > 5000 then 'Global' when c_acctbal > 0 then 'EMEA' else 'Uncertain' end as rank from customer),
r as (select o_custkey + case when o_orderkey % 50 = 0 then 10000000 else 0 end as id, case when o_orderkey % 3 = 0 then 'Global' else 'EMEA' end as label from orders)
select case when rank is null then 'skipped' when rank = label then 'already_correct' else 'updated' end as state, count(*) as n from r left join s using (id) group by 1"""


def write_accounting(spark: SparkSession, d: str) -> DataFrame:
    """Per platform: rows fetched, distinct written, new (first seen since the run began, less five seconds) and present."""
    e = read(spark, d, "events")
    start = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz") - F.expr("interval 5 seconds")
    rows = e.groupBy("event_type", "user_id").agg(F.count("*").alias("n"), F.min("ts").alias("first_seen"))
    new = F.col("first_seen") >= start
    return rows.groupBy("event_type").agg(F.sum("n").alias("fetched"), F.count("*").alias("written"), F.sum(new.cast("long")).alias("new"), F.sum((~new).cast("long")).alias("present"))


ACCOUNT_SQL = """
with r as (select event_type, user_id, count(*) as n, min(ts) as first_seen from events group by all)
select event_type, cast(sum(n) as bigint) as fetched, count(*) as written, count(*) filter (where first_seen >= timestamp '2024-01-20' - interval 5 second) as new,
  count(*) filter (where first_seen < timestamp '2024-01-20' - interval 5 second) as present from r group by event_type"""


def partitions_asked(spark: SparkSession, d: str) -> DataFrame:
    """Requested partitions that exist, in the order asked, and those missing."""
    have = read(spark, d, "events").select(F.to_date("ts").cast("string").alias("name")).distinct()
    asked = spark.createDataFrame([(k, f"2024-01-{20 + k:02d}") for k in range(15)], "place int, name string")
    return asked.join(have.withColumn("there", F.lit(True)), "name", "left").select("place", "name", F.coalesce("there", F.lit(False)).alias("there"))


ASKED_SQL = """
with a as (select cast(range as integer) as place, '2024-01-' || (20 + range) as name from range(15)), h as (select distinct strftime(ts, '%Y-%m-%d') as name from events)
select place, name, name in (from h) as there from a"""


def resolved_twins(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "supplier")
    boards = s.select(F.lit("oracle_cloud_hcm").alias("ats"), F.concat(F.lit("h"), F.col("s_nationkey"), F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("|CX_"), F.col("s_suppkey"))).otherwise("")).alias("slug"))
    return filters.drop_resolved_twins(boards)


TWIN_SQL = """
with b as (select 'oracle_cloud_hcm' as ats, 'h' || s_nationkey || case when s_suppkey % 2 = 0 then '|CX_' || s_suppkey else '' end as slug from supplier)
select * from b where contains(slug, '|') or slug not in (select string_split(slug, '|')[1] from b where contains(slug, '|'))"""


def detail_merge(spark: SparkSession, d: str) -> DataFrame:
    """Orders as listings, line items as detail pages with longer text."""
    from tidewell.operators import classify

    listing = read(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("description"), F.when(F.col("o_orderkey") % 2 == 0, "").otherwise("Oslo").alias("location"), F.lit(None).cast("string").alias("workplace_type"))
    detail = read(spark, d, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("k"), F.expr("repeat(l_returnflag, cast(l_quantity as int))").alias("description"), F.col("l_linestatus").alias("location"), F.col("l_returnflag").alias("workplace_type"))
    return classify.merge_detail(listing, detail, "k")


DETAIL_SQL = """
with l as (select l_orderkey as k, repeat(l_returnflag, cast(floor(l_quantity) as integer)) as description, l_linestatus as location, l_returnflag as workplace_type from lineitem where l_linenumber = 1)
select o_orderkey as k, case when length(coalesce(l.description, '')) > length(o_orderpriority) then l.description else o_orderpriority end as description,
  case when o_orderkey % 2 = 0 then coalesce(l.location, '') else 'Oslo' end as location, l.workplace_type from orders left join l on o_orderkey = k"""

QUERIES = {
    "broad_scopes": (broad_scopes, SCOPE_SQL),
    "career_paths": (career_paths, PATHS_SQL),
    "page_hosts": (page_hosts, HOSTS_SQL),
    "label_repair": (label_repair, REPAIR_SQL),
    "write_accounting": (write_accounting, ACCOUNT_SQL),
    "partitions_asked": (partitions_asked, ASKED_SQL),
    "resolved_twins": (resolved_twins, TWIN_SQL),
    "detail_merge": (detail_merge, DETAIL_SQL),
}
