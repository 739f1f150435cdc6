"""Queries over URL identity, duplicates and merges, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import hashing, urls
from tidewell.operators import identity, merge
from tidewell.plans.tables import read

NAMES = ", ".join(f"'{n}'" for n in urls.TRACKING_NAMES)
PREFIXES = " or ".join(f"starts_with(lower(string_split(p, '=')[1]), '{x}')" for x in urls.TRACKING_PREFIXES)
TRACKS = f"(lower(string_split(p, '=')[1]) in ({NAMES}) or {PREFIXES})"
URL_RE = r"^\s*([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*?))?\s*$"


def _parts(column: str) -> str:
    x = lambda k: f"regexp_extract({column}, '{URL_RE}', {k})"
    return f"lower({x(1)}) as s, lower({x(2)}) as h, {x(3)} as p0, {x(4)} as q0, {x(5)} as f"


def key_sql(table: str, id_: str, url: str) -> str:
    """(id, url, url_key) for URLs without percent escapes."""
    return f"""
select {id_}, {url}, s || '://' || h ||
  case when length(p1) > 1 then coalesce(nullif(rtrim(p1, '/'), ''), '/') else p1 end ||
  case when q1 <> '' then '?' || q1 else '' end || case when f <> '' then '#' || f else '' end as url_key
from (select {id_}, {url}, s, h, f, lower(regexp_replace(p0, '/{{2,}}', '/', 'g')) as p1,
  array_to_string(list_sort([lower(string_split(p, '=')[1]) || case when contains(p, '=') then p[instr(p, '='):] else '' end
    for p in string_split(q0, '&') if p <> '' and not {TRACKS}]), '&') as q1
  from (select {id_}, {url}, {_parts(url)} from {table}))"""


def url_key_pages(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", "url", urls.url_key(F.col("url")).alias("url_key"))


def canonical_url_pages(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", urls.canonical_url(F.col("url")).alias("canonical"))


CANONICAL = f"""
select page_id, s || '://' || h || p0 || case when q1 <> '' then '?' || q1 else '' end || case when f <> '' then '#' || f else '' end as canonical
from (select page_id, s, h, p0, f, array_to_string([p for p in string_split(q0, '&') if p <> '' and not {TRACKS}], '&') as q1
  from (select page_id, {_parts('url')} from pages))"""


def tracking_param_rows(spark: SparkSession, d: str) -> DataFrame:
    pieces = read(spark, d, "pages").select(F.explode(F.filter(F.split(urls.query(F.col("url")), "&"), lambda p: p != "")).alias("p"))
    name = F.lower(F.substring_index("p", "=", 1))
    return pieces.groupBy(name.alias("name"), urls.is_tracking(name).alias("tracking")).agg(F.count("*").alias("n"))


TRACKING = f"""
select name, tracking, count(*) as n from (
  select lower(string_split(p, '=')[1]) as name, {TRACKS} as tracking
  from (select unnest(string_split(regexp_extract(url, '{URL_RE}', 4), '&')) as p from pages) where p <> '')
group by name, tracking"""


def _twins(spark: SparkSession, d: str) -> DataFrame:
    """pages, and twins of every fifth: with a tracking parameter and a final slash, or an upper-case path."""
    pages = read(spark, d, "pages").select("page_id", "url")
    fifth = pages.where("page_id % 5 = 0")
    bare = F.regexp_extract("url", r"^([^?#]*)", 1)
    rest = F.substring("url", F.length(bare) + 1, F.lit(1 << 30))
    slash = fifth.select((F.col("page_id") + 1_000_000_000).alias("page_id"), F.concat(bare, F.lit("/"), rest).alias("url"))
    upper = fifth.where("page_id % 2 = 0").select((F.col("page_id") + 2_000_000_000).alias("page_id"), F.concat(F.upper(bare), rest).alias("url"))
    return pages.unionByName(slash).unionByName(upper)


TWINS = r"""twins as (
  select page_id, url from pages
  union all select page_id + 1000000000, regexp_extract(url, '^([^?#]*)', 1) || '/' || url[length(regexp_extract(url, '^([^?#]*)', 1)) + 1:] from pages where page_id % 5 = 0
  union all select page_id + 2000000000, upper(regexp_extract(url, '^([^?#]*)', 1)) || url[length(regexp_extract(url, '^([^?#]*)', 1)) + 1:] from pages where page_id % 10 = 0
)"""


def dup_groups(spark: SparkSession, d: str) -> DataFrame:
    rows = _twins(spark, d).withColumn("url_key", urls.url_key(F.col("url")))
    marked = identity.survivors(rows, "url_key", F.col("page_id") % 7 == 3, F.col("page_id") % 3 != 0, "page_id")
    return marked.select("page_id", "url_key", "survivor", "loser")


DUP_GROUPS = f"""
with {TWINS}, keyed as ({key_sql('twins', 'page_id', 'url')}),
g as (select url_key from keyed where url_key <> '' group by url_key having count(*) > 1),
m as (select page_id, url_key, page_id % 7 = 3 as tracked,
  row_number() over (partition by url_key order by (page_id % 7 = 3) desc, (page_id % 3 <> 0) desc, page_id) as place from keyed where url_key in (from g))
select page_id, url_key, place = 1 as survivor, place > 1 and not tracked as loser from m"""


def dup_sweep_guard(spark: SparkSession, d: str) -> DataFrame:
    rows = _twins(spark, d).withColumn("url_key", urls.url_key(F.col("url")))
    marked = identity.survivors(rows, "url_key", F.col("page_id") % 7 == 3, F.col("page_id") % 3 != 0, "page_id")
    return identity.guarded_sweep(rows, marked, "page_id", 0.5)


DUP_SWEEP = f"""
with {TWINS}, marked as ({DUP_GROUPS.replace('with ' + TWINS + ',', 'with')})
select page_id from marked where loser and (select count(*) from marked where loser) <= 0.5 * (select count(*) from twins)"""


def split_known_new(spark: SparkSession, d: str) -> DataFrame:
    batch = _twins(spark, d).withColumn("url_key", urls.url_key(F.col("url")))
    stored = read(spark, d, "pages").where("page_id % 2 = 0").select(urls.url_key(F.col("url")).alias("url_key"), F.col("url").alias("stored_url"))
    return identity.known_and_new(batch, stored, "url", "url_key", "page_id").select("page_id", "url", "state")


SPLIT = f"""
with {TWINS}, keyed as ({key_sql('twins', 'page_id', 'url')}),
stored as (select k.url_key, min(k.url) as stored_url from keyed k where k.page_id < 1000000000 and k.page_id % 2 = 0 group by k.url_key),
j as (select k.page_id, k.url, k.url_key, s.stored_url from keyed k left join stored s using (url_key))
select page_id, stored_url as url, 'known' as state from j where stored_url is not null
union all
select min(page_id), arg_min(url, page_id), 'new' from j where stored_url is null group by url_key"""


def case_twins(spark: SparkSession, d: str) -> DataFrame:
    """Customers as boards: segment as slug, in lower case for some; platform by nation."""
    c = read(spark, d, "customer")
    platform = F.when(F.col("c_nationkey") % 2 == 0, "greenhouse").otherwise("lever")
    slug = F.when(F.col("c_custkey") % 4 == 0, F.lower("c_mktsegment")).otherwise(F.concat(F.col("c_mktsegment"), F.when(F.col("c_custkey") % 3 == 0, "X").otherwise("")))
    registry = c.select(F.col("c_custkey").alias("id"), platform.alias("ats"), slug.alias("slug"))
    return identity.drop_case_twins(registry)


CASE_TWINS = """
with r as (select c_custkey as id, case when c_nationkey % 2 = 0 then 'greenhouse' else 'lever' end as ats,
  case when c_custkey % 4 = 0 then lower(c_mktsegment) else c_mktsegment || case when c_custkey % 3 = 0 then 'X' else '' end end as slug from customer)
select * from r a where not (ats = 'greenhouse' and slug <> lower(slug) and exists (select 1 from r b where b.ats = a.ats and b.slug = lower(a.slug)))"""


def registry_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Canonical slugs, one row per board, the earliest id winning."""
    c = read(spark, d, "customer")
    platform = F.when(F.col("c_nationkey") % 2 == 0, "greenhouse").otherwise("lever")
    rows = c.select(platform.alias("ats"), F.concat(F.col("c_mktsegment"), F.lit("-"), F.col("c_nationkey")).alias("raw"), F.col("c_custkey").alias("id"))
    rows = rows.withColumn("slug", identity.canonical_slug(F.col("ats"), F.col("raw"))).where(~F.col("slug").contains("${"))
    return identity.first_wins(rows.select("ats", "slug", "id"), ["ats", "slug"], "id")


REGISTRY = """
select ats, slug, min(id) as id from (
  select case when c_nationkey % 2 = 0 then 'greenhouse' else 'lever' end as ats,
    case when c_nationkey % 2 = 0 then lower(c_mktsegment || '-' || c_nationkey) else c_mktsegment || '-' || c_nationkey end as slug, c_custkey as id from customer)
group by ats, slug"""


def snapshot_merge(spark: SparkSession, d: str) -> DataFrame:
    """Even orders are stored; a batch re-dates every third and brings new ones."""
    o = read(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("last_seen"))
    target = o.where("o_orderkey % 2 = 0")
    source = o.where("o_orderkey % 3 = 0").select("o_orderkey", F.lit("Z").alias("o_orderstatus"), F.date_add("last_seen", 30).alias("last_seen"))
    return merge.snapshot_merge(target, source, ["o_orderkey"], ["last_seen"])


SNAPSHOT = """
with o as (select o_orderkey, o_orderstatus, o_totalprice, cast(o_orderdate as date) as last_seen from orders),
t as (from o where o_orderkey % 2 = 0), s as (select o_orderkey, 'Z' as o_orderstatus, last_seen + 30 as last_seen from o where o_orderkey % 3 = 0)
select coalesce(t.o_orderkey, s.o_orderkey) as o_orderkey, coalesce(t.o_orderstatus, s.o_orderstatus) as o_orderstatus, t.o_totalprice as o_totalprice,
  coalesce(s.last_seen, t.last_seen) as last_seen from t full join s on t.o_orderkey = s.o_orderkey"""


def touch_known(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("last_seen"))
    keys = read(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return merge.touch(o, keys, ["o_custkey"], "last_seen", F.lit("2030-01-01").cast("date"))


TOUCH = """
select o_orderkey, o_custkey, case when o_custkey in (select c_custkey from customer where c_acctbal < 0) then date '2030-01-01' else cast(o_orderdate as date) end as last_seen from orders"""


def delete_rows(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey")
    return merge.delete_keys(o, read(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey")), ["o_custkey"])


DELETE = "select o_orderkey, o_custkey from orders where o_custkey not in (select c_custkey from customer where c_mktsegment = 'BUILDING')"


def last_wins(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return identity.last_wins(rows, ["o_custkey"], "o_orderkey")


LAST_WINS = "select o_custkey, max(o_orderkey) as o_orderkey, arg_max(o_totalprice, o_orderkey) as o_totalprice from orders group by o_custkey"


def _jobs(spark: SparkSession, d: str) -> DataFrame:
    """Orders as stored postings."""
    o = read(spark, d, "orders")
    clearance = F.when(F.col("o_orderstatus") == "P", "vetoed").when(F.col("o_orderstatus") == "F", "regex")
    applied = F.when(F.col("o_custkey") % 5 == 0, "applied").otherwise("not_applied")
    synced = F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderdate"))
    return o.select(
        F.col("o_orderkey").alias("id"), clearance.alias("clearance"), applied.alias("application_status"), (F.col("o_orderkey") % 2 == 0).alias("is_active"),
        (F.col("o_custkey") % 20).cast("short").alias("classifier_version"), synced.alias("synced_at"), F.to_date("o_orderdate").alias("last_seen"), F.col("o_orderpriority").alias("source_pipeline"),
    )


JOBS = """jobs as (select o_orderkey as id, case o_orderstatus when 'P' then 'vetoed' when 'F' then 'regex' end as clearance,
  case when o_custkey % 5 = 0 then 'applied' else 'not_applied' end as application_status, o_orderkey % 2 = 0 as is_active,
  cast(o_custkey % 20 as smallint) as classifier_version, case when o_orderkey % 4 = 0 then o_orderdate end as synced_at,
  cast(o_orderdate as date) as last_seen, o_orderpriority as source_pipeline from orders)"""


def veto_and_purge(spark: SparkSession, d: str) -> DataFrame:
    jobs = _jobs(spark, d)
    vetoed = merge.veto(jobs, jobs.where("id % 11 = 0").select("id"), "id", 18)
    return merge.purge(vetoed).select("id", "clearance", "application_status", "is_active", "classifier_version")


VETO = f"""
with {JOBS}, v as (select id, case when id % 11 = 0 then 'vetoed' else clearance end as clearance, application_status,
  case when id % 11 = 0 then false else is_active end as is_active, case when id % 11 = 0 then cast(18 as smallint) else classifier_version end as classifier_version from jobs)
select * from v where not (coalesce(clearance, '') = 'vetoed' and application_status = 'not_applied')"""


def pending_push(spark: SparkSession, d: str) -> DataFrame:
    return merge.pending_push(_jobs(spark, d)).select("id", "clearance")


PENDING = f"with {JOBS} select id, clearance from jobs where synced_at is null and (clearance is null or clearance <> 'vetoed')"

DAYS = {"1-URGENT": 1, "2-HIGH": 3, "3-MEDIUM": 3, "4-NOT SPECIFIED": 30, "5-LOW": 1}


def stale_lifecycle(spark: SparkSession, d: str) -> DataFrame:
    """Users as postings, their last event as last_seen; the pipeline is their commonest letter of the id."""
    e = read(spark, d, "events").groupBy("user_id", "event_type").agg(F.to_date(F.max("ts")).alias("last_seen"))
    days = {"signup": 3, "error": 1, "click": 3, "view": 5, "purchase": 10}
    return merge.stale(e, F.lit("2024-01-31").cast("date"), days, "event_type").select("user_id", "event_type", "last_seen")


STALE = """
select * from (select user_id, event_type, cast(max(ts) as date) as last_seen from events group by all)
where last_seen < date '2024-01-31' - case event_type when 'signup' then 3 when 'error' then 1 when 'click' then 3 when 'view' then 5 else 10 end"""


def ttl_cache(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select("event_id", F.when(F.col("event_id") % 50 == 0, "2024").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("excluded_at"))
    return e.select("event_id", merge.expired(F.col("excluded_at"), F.lit("2024-01-31").cast("timestamp")).alias("expired"))


TTL = "select event_id, event_id % 50 = 0 or timestamp '2024-01-31' > date_trunc('second', ts) + interval 21 day as expired from events"


def cache_merge(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events").select(F.concat(F.lit("u"), F.col("user_id")).alias("url"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("excluded_at"), "event_id")
    existing = identity.first_wins(e.where("event_id % 2 = 0"), ["url"], "event_id").select("url", "excluded_at")
    return merge.cache_merge(existing, e.where("event_id % 2 = 1").select("url", "excluded_at"), F.lit("2024-01-23").cast("timestamp"))


CACHE = """
with e as (select 'u' || user_id as url, strftime(ts, '%Y-%m-%dT%H:%M:%S') as excluded_at, event_id from events),
x as (select url, arg_min(excluded_at, event_id) as excluded_at from e where event_id % 2 = 0 group by url),
m as (select coalesce(x.url, p.url) as url, coalesce(x.excluded_at, p.excluded_at) as excluded_at from x
  full join (select url, min(excluded_at) as excluded_at from e where event_id % 2 = 1 group by url) p on x.url = p.url)
select * from m where not (timestamp '2024-01-23' > cast(excluded_at as timestamp) + interval 21 day)"""


def md5_shard(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "customer").select("c_custkey", hashing.md5_shard(F.col("c_name"), 7).alias("shard"))


MD5_SHARD = "select c_custkey, cast(('0x' || md5(c_name))::uhugeint % 7 as integer) as shard from customer"


def bucket_shard(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select("o_orderkey", hashing.bucket_shard(F.col("o_orderkey"), 6).alias("shard"))


BUCKET = "select o_orderkey, cast((o_orderkey % 1000) % 6 as integer) as shard from orders"


def slug_titles(spark: SparkSession, d: str) -> DataFrame:
    words = F.concat_ws("-", F.split(F.lower("p_name"), " "))
    url = F.concat(F.lit("https://ex.com/jobs/"), words, F.lit("-"), F.col("p_partkey"), F.lit(".html"))
    return read(spark, d, "part").select("p_partkey", urls.slug_title(url).alias("title"), urls.is_sentence_slug(urls.path(url), 3).alias("sentence"))


def domain_clean(spark: SparkSession, d: str) -> DataFrame:
    dom = urls.clean_domain(F.col("url"))
    return read(spark, d, "pages").select("page_id", dom.alias("domain"), urls.reverse_domain(dom).alias("reversed"), urls.site_key(dom).alias("site"), urls.page_number(F.col("url")).alias("page"))


DOMAIN = r"""
with x as (select page_id, url, lower(string_split(regexp_replace(trim(url), '^(?i:https?://)', ''), '/')[1]) as domain from pages)
select page_id, domain, array_to_string(list_reverse(string_split(domain, '.')), '.') as reversed,
  array_to_string(string_split(domain, '.')[-2:], '.') as site,
  cast(nullif(regexp_extract(url, '[?&](?:page)=(\d{1,6})(?:&|#|$)', 1), '') as integer) as page from x"""

QUERIES = {
    "url_key_pages": (url_key_pages, key_sql("pages", "page_id", "url")),
    "canonical_url_pages": (canonical_url_pages, CANONICAL),
    "tracking_param_rows": (tracking_param_rows, TRACKING),
    "dup_groups": (dup_groups, DUP_GROUPS),
    "dup_sweep_guard": (dup_sweep_guard, DUP_SWEEP),
    "split_known_new": (split_known_new, SPLIT),
    "case_twins": (case_twins, CASE_TWINS),
    "registry_upsert": (registry_upsert, REGISTRY),
    "snapshot_merge": (snapshot_merge, SNAPSHOT),
    "touch_known": (touch_known, TOUCH),
    "delete_rows": (delete_rows, DELETE),
    "last_wins": (last_wins, LAST_WINS),
    "veto_and_purge": (veto_and_purge, VETO),
    "pending_push": (pending_push, PENDING),
    "stale_lifecycle": (stale_lifecycle, STALE),
    "ttl_cache": (ttl_cache, TTL),
    "cache_merge": (cache_merge, CACHE),
    "md5_shard": (md5_shard, MD5_SHARD),
    "bucket_shard": (bucket_shard, BUCKET),
    "slug_titles": (slug_titles, None),
    "domain_clean": (domain_clean, DOMAIN),
}
