"""Rows told apart by a derived key: duplicates, known and new, survivors, twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Platforms whose board slug ignores case.
CASELESS_PLATFORMS = ("ashby", "workday", "smartrecruiters", "greenhouse", "dayforce", "oracle_cloud_hcm", "paycom")


def canonical_slug(platform: Column, slug: Column) -> Column:
    return F.when(F.lower(platform).isin(*CASELESS_PLATFORMS), F.lower(slug)).otherwise(slug)


def duplicate_groups(rows: DataFrame, key: str, *more: Column) -> DataFrame:
    """(key, n, *more aggregates) of the keys that several rows share; empty keys are no key.

    Emptiness is an aggregate as well: a filter on the key would move below and have a
    derived key computed twice for each row.
    """
    out = rows.groupBy(key).agg(F.count("*").alias("n"), F.max(F.col(key) != "").alias("__named"), *more)
    return out.where("n > 1 and __named").drop("__named")


def first_wins(rows: DataFrame, keys: list[str], position: str) -> DataFrame:
    """The earliest row of each key.

    An aggregate, not a window: a key that most rows share is combined before the shuffle.
    """
    rest = [c for c in rows.columns if c not in keys]
    out = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(position)).alias("__row"))
    return out.select(*keys, "__row.*").select(*rows.columns)


def last_wins(rows: DataFrame, keys: list[str], position: str) -> DataFrame:
    """The latest row of each key."""
    rest = [c for c in rows.columns if c not in keys]
    out = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(position)).alias("__row"))
    return out.select(*keys, "__row.*").select(*rows.columns)


def known_and_new(batch: DataFrame, stored: DataFrame, url: str, key: str, position: str) -> DataFrame:
    """batch rows to write, with state 'known' (url in its stored spelling) or 'new' (first of each key; rows without url all stay).

    stored has (key, stored_url), its first spelling of each key.
    """
    first = stored.groupBy(F.col(key).alias("__key")).agg(F.min("stored_url").alias("__stored"))
    joined = batch.join(first, F.col(key) == F.col("__key"), "left").drop("__key")
    known = joined.where(F.col("__stored").isNotNull()).withColumn(url, F.col("__stored")).drop("__stored").withColumn("state", F.lit("known"))
    new = joined.where(F.col("__stored").isNull()).drop("__stored")
    blank = new.where(F.coalesce(F.col(url), F.lit("")) == "")
    named = first_wins(new.where(F.coalesce(F.col(url), F.lit("")) != ""), [key], position).select(*new.columns)
    return known.unionByName(named.unionByName(blank).withColumn("state", F.lit("new")))


def drop_case_twins(registry: DataFrame, platform: str = "ats", slug: str = "slug") -> DataFrame:
    """The registry without mixed-case slugs whose lower-case twin is registered, on platforms that ignore case."""
    low = registry.where(F.col(slug) == F.lower(slug)).select(F.col(platform).alias("__p"), F.col(slug).alias("__s")).distinct()
    twin = F.lower(F.col(platform)).isin(*CASELESS_PLATFORMS) & (F.col(slug) != F.lower(slug))
    return registry.join(low, twin & (F.col(platform) == F.col("__p")) & (F.lower(slug) == F.col("__s")), "left_anti")


def survivors(rows: DataFrame, key: str, tracked: Column, active: Column, id_: str) -> DataFrame:
    """rows of duplicate groups with survivor and loser: tracked rows first, then active ones, then the least id; tracked rows never lose.

    The best row of a key is an aggregate that combines before the shuffle, joined back;
    no window has to hold a group that most rows are in.
    """
    place = F.struct((~tracked).alias("a"), (~active).alias("b"), F.col(id_).alias("c"))
    marked = rows.withColumn("__place", place).withColumn("__tracked", tracked)
    best = duplicate_groups(marked, key, F.min("__place").alias("__best")).drop("n")
    out = marked.join(best, key).withColumn("survivor", F.col("__place") == F.col("__best"))
    return out.withColumn("loser", ~F.col("survivor") & ~F.col("__tracked")).drop("__place", "__best", "__tracked")


def guarded_sweep(rows: DataFrame, marked: DataFrame, id_: str, fraction: float = 0.1) -> DataFrame:
    """Ids of losers, or none if they are more than a fraction of all rows."""
    total = rows.agg(F.count("*").alias("total"))
    losers = marked.where("loser").select(id_)
    count = losers.agg(F.count("*").alias("lost"))
    # Two one-row aggregates.
    safe = total.join(F.broadcast(count), F.lit(True)).where(F.col("lost") <= fraction * F.col("total")).select(F.lit(1).alias("one"))
    return losers.withColumn("one", F.lit(1)).join(F.broadcast(safe), "one", "left_semi").drop("one")
