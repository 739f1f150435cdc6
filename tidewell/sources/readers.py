"""Inputs: registries, bulk postings, company seeds, rank files and archives of them."""

from __future__ import annotations

import csv
import io
import json
import re
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import urls

#: Header names under which a company seed spells its columns.
NAME_HEADERS = ("name", "company_name", "company")
DOMAIN_HEADERS = ("domain", "website", "site", "url")
COUNTRY_HEADERS = ("country", "country_code", "country_iso")
SIZE_HEADERS = ("size", "employees", "employee_range", "company_size")
#: Fields of a bulk posting.
POSTING = ("title", "url", "company", "location", "country", "department", "employment_type", "salary", "description_snippet", "source_ats", "slug")


def column_of(df: DataFrame, names) -> Column:
    """The first column that a header alias names, as trimmed text; '' if there is none."""
    low = {c.lower().strip(): c for c in df.columns}
    found = next((low[n] for n in names if n in low), None)
    return F.coalesce(F.trim(F.col(f"`{found}`").cast("string")), F.lit("")) if found else F.lit("")


def bulk_csv(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows of several CSV files, tagged with their source; malformed rows are left out."""
    out = None
    for source, path in paths.items():
        df = spark.read.csv(path, header=True, multiLine=True, escape='"', mode="DROPMALFORMED").withColumn("source_ats", F.lit(source))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def postings(rows: DataFrame) -> DataFrame:
    """Bulk rows as postings; rows without URL or title are left out."""
    c = lambda *names: column_of(rows, names)
    or_ = lambda *cs: F.coalesce(*[F.nullif(x, F.lit("")) for x in cs], F.lit(""))
    remote = F.lower(c("is_remote")).isin("true", "1", "yes", "t", "y")
    from tidewell.functions.textscore import salary

    out = rows.select(
        c("title").alias("title"), or_(c("url"), c("apply_url")).alias("url"), c("company").alias("company"), F.when((c("location") == "") & remote, "Remote").otherwise(c("location")).alias("location"),
        or_(c("country_iso"), c("region")).alias("country"), or_(c("department"), c("team")).alias("department"), or_(c("employment_type"), c("commitment")).alias("employment_type"),
        salary(c("salary_min"), c("salary_max"), c("salary_currency"), c("salary_period")).alias("salary"), F.substring(c("description"), 1, 500).alias("description_snippet"),
        c("source_ats").alias("source_ats"), or_(c("ats_id"), c("requisition_id")).alias("slug"),
    )
    return out.where("url <> '' and title <> ''")


def company_seed(rows: DataFrame, countries: list[str] | None, aliases: dict[str, str] | None = None, skip: tuple[str, ...] = ()) -> DataFrame:
    """(name, domain, country, size) of usable companies in the countries; if no row names a country, the filter is dropped."""
    country = F.lower(column_of(rows, COUNTRY_HEADERS))
    if aliases:
        country = F.coalesce(F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])[country], country)
    out = rows.select(column_of(rows, NAME_HEADERS).alias("name"), urls.clean_domain(column_of(rows, DOMAIN_HEADERS)).alias("domain"), country.alias("country"), column_of(rows, SIZE_HEADERS).alias("size"))
    out = out.where((F.col("name") != "") & F.col("domain").contains(".") & ~F.col("domain").isin(*skip))
    if countries:
        any_ = F.broadcast(out.agg(F.max((F.col("country") != "").cast("int")).alias("__any")))  # one row
        out = out.join(any_, F.lit(True)).where((F.coalesce("__any", F.lit(0)) == 0) | F.col("country").isin(*[c.lower() for c in countries])).drop("__any")
    return out


def domain_ranks(spark: SparkSession, path: str, cutoff: int | None = None) -> DataFrame:
    """(domain, rank) of a rank-ordered TSV with # header lines; gzip by extension. Names are stored reversed."""
    raw = spark.read.csv(path, sep="\t", comment="#", schema="position long, value double, pr_position long, pr_value double, host_rev string, hosts long")
    out = raw.select(urls.reverse_domain(F.col("host_rev")).alias("domain"), F.col("position").alias("rank"))
    return out.where(F.col("rank") <= cutoff) if cutoff is not None else out


def domain_stats(spark: SparkSession, path: str, least: int, vendors: list[str]) -> DataFrame:
    """Domains of a TSV with enough entities that are no vendor's."""
    df = spark.read.csv(path, sep="\t", header=True).select(F.col("Domain").alias("domain"), F.col("`#Entities`").cast("long").alias("entities"))
    return df.where((F.col("entities") >= least) & F.col("domain").contains(".") & ~has_suffix(F.col("domain"), vendors))


def has_suffix(host: Column, suffixes: list[str]) -> Column:
    """Equal to a suffix or under it, never a part of a label."""
    return F.exists(F.array(*[F.lit(s) for s in suffixes]), lambda s: (host == s) | host.endswith(F.concat(F.lit("."), s)))


def host_index(spark: SparkSession, paths: list[str], tlds: list[str]) -> DataFrame:
    """Hosts of a Parquet index in the TLDs, with whether any fetch succeeded or failed; filter and columns reach the scan."""
    from tidewell.operators.reports import host_liveness

    df = spark.read.parquet(*paths).where(F.col("url_host_tld").isin(*tlds)).select("url_host_name", "fetch_status")
    return host_liveness(df, ["url_host_name"], "fetch_status")


def url_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct URLs of whichever of the columns there are."""
    have = [F.col(c) for c in columns if c in df.columns]
    return df.select(F.explode(F.array(*have)).alias("url")).where("url is not null and url <> ''").distinct()


def technology_top(df: DataFrame, months: int, n: int) -> DataFrame:
    """Pages of the n best ranks of each technology in the latest months, each once."""
    from pyspark.sql import Window

    dates = df.select("date").distinct().orderBy(F.desc("date")).limit(months)
    rows = df.join(F.broadcast(dates), "date", "left_semi").select("page", "rank", F.explode("technologies.technology").alias("technology"))
    place = F.row_number().over(Window.partitionBy("technology").orderBy("rank", "page"))
    return rows.withColumn("k", place).where(F.col("k") <= n).select("technology", "page").distinct()


def keyset_page(df: DataFrame, key: str, after: str | None, n: int) -> DataFrame:
    out = df.where(F.col(key) > after) if after is not None else df
    return out.select(key).distinct().orderBy(key).limit(n)


#: Keys of a registry's entries.
PLATFORM_KEYS = ("platform", "ats", "ats_system", "type")
SLUG_KEYS = ("token", "slug", "company_slug", "board_slug")
URL_KEYS = ("url", "source_url", "apply_url", "apply_host")
LABEL_KEYS = ("company", "display_name", "name")


def registry_entries(text: str | None) -> list[dict]:
    """Entries of a registry in any layout: a list, a wrapper object, or a map by platform; inactive ones are left out."""
    try:
        root = json.loads(text or "null")
    except ValueError:
        return []
    out, todo = [], [(root, "")]
    pick = lambda x, keys: next((str(x[k]) for k in keys if isinstance(x.get(k), str | int) and str(x[k])), "")
    while todo:
        x, platform = todo.pop(0)
        if isinstance(x, list):
            todo += [(i if not isinstance(i, str) else {"slug": i}, platform) for i in x]
        elif isinstance(x, dict):
            slug, url = pick(x, SLUG_KEYS), pick(x, URL_KEYS)
            if slug or url:
                if x.get("enabled") is not False and str(x.get("status", "active")).lower() in ("active", "ok", "live", ""):
                    out.append({"ats": (pick(x, PLATFORM_KEYS) or platform).lower(), "slug": slug, "url": url, "name": pick(x, LABEL_KEYS)})
            else:
                todo += [(v, k if isinstance(v, list) else platform or k) for k, v in x.items() if isinstance(v, list | dict)]
    return out


def registry_json(spark: SparkSession, path: str) -> DataFrame:
    """(ats, slug, url, name) of registry files, one recursive walk a file."""
    kind = "array<struct<ats:string,slug:string,url:string,name:string>>"
    files = spark.read.text(path, wholetext=True)

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(registry_entries)

    return files.select(F.explode(F.pandas_udf(run, kind)("value")).alias("e")).select("e.*")


def slug_map(spark: SparkSession, path: str) -> DataFrame:
    """(ats, slug) of a JSON map from platform to slugs."""
    files = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,array<string>>").alias("m"))
    return files.select(F.explode("m").alias("ats", "slugs")).select("ats", F.explode("slugs").alias("slug")).where("slug <> ''").distinct()


def slug_lines(spark: SparkSession, path: str) -> DataFrame:
    """One slug a line, # for remarks."""
    lines = spark.read.text(path).select(F.trim("value").alias("slug"))
    return lines.where("slug <> '' and not startswith(slug, '#')")


def robots_rules(text: Column, agent: str) -> Column:
    """Disallowed path prefixes of a robots file for everyone or the agent."""
    # Groups open with one or more agent lines; the flag is whether the current group applies.
    start = F.struct(F.lit(False).alias("on"), F.lit(False).alias("rules"), F.array().cast("array<string>").alias("out"))
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), r"\r?\n"), lambda x: F.trim(F.regexp_replace(x, "#.*$", "")))

    def step(a, x):
        key, value = F.lower(F.trim(F.substring_index(x, ":", 1))), F.trim(F.regexp_extract(x, r"^[^:]*:(.*)$", 1))
        mine = (value == "*") | F.lower(value).contains(agent.lower())
        return (
            F.when(key == "user-agent", F.struct(F.when(a["rules"], mine).otherwise(a["on"] | mine).alias("on"), F.lit(False).alias("rules"), a["out"].alias("out")))
            .when((key == "disallow") & a["on"] & (value != ""), F.struct(a["on"].alias("on"), F.lit(True).alias("rules"), F.concat(a["out"], F.array(value)).alias("out")))
            .when(key.isin("disallow", "allow"), F.struct(a["on"].alias("on"), F.lit(True).alias("rules"), a["out"].alias("out")))
            .otherwise(a)
        )

    return F.aggregate(lines, start, step, lambda a: a["out"])


def robots_allows(rules: Column, path: Column) -> Column:
    return ~F.exists(rules, lambda r: path.startswith(r))


def zipped(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the CSV and JSON files in zip archives as (member, row), row a map of text; one archive a task, streamed by member."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches):
        for pdf in batches:
            for content in pdf["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in z.namelist():
                        with z.open(name) as raw:
                            text = io.TextIOWrapper(raw, "utf-8", errors="replace", newline="")
                            if name.lower().endswith(".csv"):
                                rows = csv.DictReader(text)
                            elif name.lower().endswith((".json", ".jsonl", ".ndjson")):
                                head = text.read(1)
                                rest = head + text.read()
                                rows = json.loads(rest) if head == "[" else map(json.loads, filter(str.strip, rest.splitlines()))
                            else:
                                continue
                            part = []
                            for r in rows:
                                part.append({str(k): v if isinstance(v, str) else json.dumps(v) for k, v in r.items() if k is not None and v is not None})
                                if len(part) == 1000:
                                    yield pd.DataFrame({"member": name, "row": part})
                                    part = []
                            if part:
                                yield pd.DataFrame({"member": name, "row": part})

    return files.mapInPandas(run, "member string, row map<string,string>")


def deep_find(value, names, most: int = 4) -> list[str] | None:
    """Path to the first scalar under one of the names, scalars before children, to a depth; run on a sample of records."""
    wanted = {re.sub(r"[^a-z0-9]", "", n.lower()) for n in names}
    todo = [(value, [])]
    while todo:
        x, path = todo.pop(0)
        if isinstance(x, dict):
            for k, v in x.items():
                if re.sub(r"[^a-z0-9]", "", k.lower()) in wanted and not isinstance(v, dict | list) and v not in (None, ""):
                    return [*path, k]
            if len(path) < most:
                todo += [(v, [*path, k]) for k, v in x.items() if isinstance(v, dict)]
    return None
