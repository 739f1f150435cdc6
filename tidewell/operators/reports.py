"""Counts, rates and rankings: reports over crawls and postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host_liveness(fetches: DataFrame, keys: list[str], status: str) -> DataFrame:
    """Per host, whether any fetch succeeded or failed, and dead: failures and no success."""
    flag = lambda c: F.max(F.when(c, 1).otherwise(0))
    s = F.col(status)
    out = fetches.groupBy(*keys).agg(flag(s.between(200, 299)).alias("has_2xx"), flag(s >= 400).alias("has_4xx_5xx"))
    return out.withColumn("dead", (F.col("has_2xx") == 0) & (F.col("has_4xx_5xx") == 1))


def top_n(rows: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group, with their place.

    Spark prunes each partition to n rows a group before the shuffle.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("place", F.row_number().over(window)).where(F.col("place") <= n)


def recent_values(rows: DataFrame, column: str, n: int) -> DataFrame:
    return rows.select(column).distinct().orderBy(F.desc(column)).limit(n)


def band(rank: Column, bounds: list[tuple[str, int]], otherwise: str = "D") -> Column:
    """The first band whose bound the rank does not exceed; no rank is the last band."""
    out = None
    for name, most in bounds:
        hit = rank <= most
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(otherwise)


def best_rank(ranks: DataFrame, key: str, rank: str, cutoff: int | None = None) -> DataFrame:
    if cutoff is not None:
        ranks = ranks.where(F.col(rank) <= cutoff)
    return ranks.groupBy(key).agg(F.min(rank).alias(rank))


def scan_report(deltas: DataFrame, keys: list[str], counters: list[str], failed: str) -> DataFrame:
    """Shards' deltas added up; a failure sticks."""
    out = deltas.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counters], F.max(F.col(failed).cast("int")).alias("__f"))
    return out.withColumn("status", F.when(F.col("__f") == 1, "failed").otherwise("ok")).drop("__f")


def tally(deltas: DataFrame) -> DataFrame:
    """(kind, key, n, first, last): deltas of metrics by the prefix of their name (platform__, country__, other)."""
    m = F.col("metric")
    kind = F.when(m.startswith("platform__"), "platform").when(m.startswith("country__"), "country").otherwise("other")
    key = F.regexp_replace(m, "^(platform|country)__", "")
    return deltas.groupBy(kind.alias("kind"), key.alias("key")).agg(F.sum("delta").alias("n"), F.min("updated_at").alias("first"), F.max("updated_at").alias("last"))


def skipped_values(rows: DataFrame, value: Column, allowed: list[str], k: int = 40) -> DataFrame:
    """(value, n, empty_share): the k most frequent non-empty values outside allowed, ties by value, and the share of empty ones among all rows skipped."""
    skipped = rows.select(F.trim(F.coalesce(value, F.lit(""))).alias("value")).where(~F.col("value").isin(allowed))
    counts = skipped.groupBy("value").agg(F.count("*").alias("n"))
    total = counts.agg((F.coalesce(F.sum(F.when(F.col("value") == "", F.col("n"))), F.lit(0)) / F.greatest(F.sum("n"), F.lit(1))).alias("empty_share"))
    most = counts.where("value <> ''").orderBy(F.desc("n"), "value").limit(k)
    return most.join(F.broadcast(total), F.lit(True))


def campaign_summary(deltas: DataFrame) -> DataFrame:
    """(campaign, metric, n) and the seconds between a campaign's first and last update."""
    span = (F.unix_micros(F.max(F.col("updated_at").cast("timestamp"))) - F.unix_micros(F.min(F.col("updated_at").cast("timestamp")))) / 1e6
    sums = deltas.groupBy("campaign", "metric").agg(F.sum("delta").alias("n"))
    return sums.join(deltas.groupBy("campaign").agg(span.alias("seconds")), "campaign")


def signal_mix(rows: DataFrame, signals: str, accepted: Column) -> DataFrame:
    """Share of accepted rows that show each signal; shares need not add up to 1."""
    kept = rows.where(accepted)
    total = kept.agg(F.count("*").alias("total"))
    counts = kept.select(F.explode(signals).alias("signal")).groupBy("signal").agg(F.count("*").alias("n"))
    return counts.join(F.broadcast(total), F.lit(True)).select("signal", "n", (F.col("n") / F.greatest("total", F.lit(1))).alias("share"))


def blank_rates(rows: DataFrame, run: str, group: str, blank: Column, least: int = 10) -> DataFrame:
    """(run, group, n, rate) of groups with enough rows in a run."""
    out = rows.groupBy(run, group).agg(F.count("*").alias("n"), F.sum(blank.cast("int")).alias("blanks")).where(F.col("n") >= least)
    return out.select(run, group, "n", (F.col("blanks") / F.greatest("n", F.lit(1))).alias("rate"))


def moving_average(rates: DataFrame, run: str, group: str, alpha: float = 0.3, spike: float = 0.15) -> DataFrame:
    """Exponential average of each group's rates over its runs, rounded at each step; spike compares a rate with the average before.

    One row per run of a group: its sequence is bounded by the number of runs.
    """
    seq = F.array_sort(F.collect_list(F.struct(run, "rate")))
    ordered = rates.groupBy(group).agg(seq.alias("seq"))
    start = F.expr(f"cast(array() as array<struct<run:{dict(rates.dtypes)[run]}, rate:double, before:double, ema:double>>)")
    at4 = lambda v: F.floor(v * 10000 + 0.5) / 10000
    before = lambda a: F.element_at(a, -1)["ema"]
    folded = F.aggregate(
        "seq",
        start,
        lambda a, x: F.concat(
            a,
            F.array(
                F.struct(
                    x[run].alias("run"),
                    x["rate"].alias("rate"),
                    F.when(F.size(a) > 0, before(a)).alias("before"),
                    F.when(F.size(a) > 0, at4(alpha * x["rate"] + (1 - alpha) * before(a))).otherwise(at4(x["rate"])).alias("ema"),
                )
            ),
        ),
    )
    out = ordered.select(group, F.explode(folded).alias("x")).select(group, F.col("x.run").alias(run), "x.rate", "x.before", "x.ema")
    return out.withColumn("spike", F.coalesce(F.col("rate") - F.col("before") > spike, F.lit(False)))


def error_digest(logs: DataFrame, message: str, at: str) -> DataFrame:
    """(source, level): messages counted, the earliest as example, the commonest code (least of ties)."""
    source = F.coalesce(F.nullif(F.regexp_extract(message, r"^\[([^\]]+)\]", 1), F.lit("")), F.lit("other"))
    level = F.coalesce(F.nullif(F.regexp_extract(message, r"\b(ERROR|WARNING|INFO)\b", 1), F.lit("")), F.lit("INFO"))
    code = F.nullif(F.regexp_extract(message, r"\b([1-5]\d\d)\b", 1), F.lit(""))
    rows = logs.select(source.alias("source"), level.alias("level"), code.alias("code"), F.col(message).alias("message"), F.col(at).alias("at"))
    per_code = rows.groupBy("source", "level", "code").agg(F.count("*").alias("n"), F.min(F.struct("at", "message")).alias("first"))
    best = F.min_by("code", F.struct((-F.col("n")).alias("k"), "code"))
    return per_code.groupBy("source", "level").agg(F.sum("n").alias("n"), F.min("first")["message"].alias("example"), best.alias("code"))


def evidence_majority(items: DataFrame, group: str, evidence: Column) -> DataFrame:
    """Groups at least half of whose items show evidence."""
    out = items.groupBy(group).agg(F.count("*").alias("n"), F.sum(evidence.cast("int")).alias("hits"))
    return out.where(F.col("hits") * 2 >= F.col("n"))


def repeated_siblings(links: DataFrame, least: int = 3, least_unclassed: int = 5) -> DataFrame:
    """(page, tag, cls, urls) of sibling groups that repeat: enough distinct URLs, more if they have no class."""
    out = links.groupBy("page", "tag", "cls").agg(F.countDistinct("url").alias("urls"))
    return out.where(F.col("urls") >= F.when(F.col("cls") == "", least_unclassed).otherwise(least))


def pack_bins(units: list[tuple[str, int]], bins: int) -> list[tuple[str, int, int]]:
    """Largest first into the lightest bin: (unit, weight, bin). Units are a handful by their nature."""
    load = [0] * bins
    out = []
    for name, weight in sorted(units, key=lambda u: (-u[1], u[0])):
        b = min(range(bins), key=lambda k: (load[k], k))
        load[b] += weight
        out.append((name, weight, b))
    return out
