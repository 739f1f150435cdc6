"""Snapshot merges: a new snapshot of a table from the stored one and a batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def snapshot_merge(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str], insert: bool = True) -> DataFrame:
    """Target rows with the update columns of matching source rows; unmatched source rows are inserted.

    A NULL in source does not overwrite; columns source lacks keep their stored value.
    source has one row per key.
    """
    have = set(source.columns)
    s = source.select(*[F.col(c).alias(f"__{c}") for c in source.columns], F.lit(True).alias("__hit"))
    on = [F.col(k) == F.col(f"__{k}") for k in keys]
    joined = target.withColumn("__there", F.lit(True)).join(s, on, "full" if insert else "left")
    out = []
    for c in target.columns:
        if c in keys and insert:
            out.append(F.coalesce(F.col(c), F.col(f"__{c}")).alias(c))
        elif c in update and c in have:
            out.append(F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c))
        elif c in have and insert:
            out.append(F.when(F.col("__there"), F.col(c)).otherwise(F.col(f"__{c}")).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def touch(target: DataFrame, keys_df: DataFrame, keys: Sequence[str], column: str, value: Column) -> DataFrame:
    """Sets a column on rows whose key is listed; can never insert."""
    hit = keys_df.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct().withColumn("__hit", F.lit(True))
    joined = target.join(hit, [F.col(k) == F.col(f"__{k}") for k in keys], "left")
    return joined.withColumn(column, F.when(F.col("__hit"), value).otherwise(F.col(column))).select(*target.columns)


def delete_keys(target: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(keys_df.select(*keys).distinct(), list(keys), "left_anti")


def veto(target: DataFrame, ids: DataFrame, id_: str, version: int) -> DataFrame:
    """Marks listed rows vetoed and inactive, stamped with a version."""
    hit = ids.select(F.col(id_).alias("__id")).distinct().withColumn("__hit", F.lit(True))
    joined = target.join(hit, F.col(id_) == F.col("__id"), "left")
    when = lambda v, c: F.when(F.col("__hit"), v).otherwise(F.col(c)).alias(c)
    changed = {"clearance": F.lit("vetoed"), "is_active": F.lit(False), "classifier_version": F.lit(version).cast("short")}
    return joined.select(*[when(changed[c], c) if c in changed else F.col(c) for c in target.columns])


def purge(target: DataFrame) -> DataFrame:
    """Without vetoed rows that nobody applied to."""
    return target.where(~((F.coalesce("clearance", F.lit("")) == "vetoed") & (F.coalesce("application_status", F.lit("not_applied")) == "not_applied")))


def pending_push(target: DataFrame) -> DataFrame:
    """Rows never pushed and not vetoed."""
    return target.where(F.col("synced_at").isNull() & (F.col("clearance").isNull() | (F.col("clearance") != "vetoed")))


def stale(target: DataFrame, today: Column, days: dict[str, int], pipeline: str = "source_pipeline") -> DataFrame:
    """Rows not seen for their pipeline's number of days; a missing last_seen counts as today."""
    limit = F.create_map(*[F.lit(x) for pair in days.items() for x in pair])
    return target.where(F.coalesce("last_seen", today) < F.date_sub(today, limit[F.col(pipeline)]))


def expired(at: Column, now: Column, days: int = 21) -> Column:
    """Older than the days; text that is no ISO timestamp is expired, so that it cannot hold work back."""
    shaped = F.when(at.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(F.regexp_replace(at, "T", " ")))
    return F.coalesce(now > shaped + F.make_dt_interval(F.lit(days)), F.lit(True))


def cache_merge(existing: DataFrame, partial: DataFrame, now: Column, days: int = 21) -> DataFrame:
    """(url, excluded_at): both maps, the existing time winning, the earliest of the partials', without expired entries."""
    both = existing.select("url", "excluded_at", F.lit(0).alias("__from")).unionByName(partial.select("url", "excluded_at", F.lit(1).alias("__from")))
    out = both.groupBy("url").agg(F.min_by("excluded_at", F.struct("__from", "excluded_at")).alias("excluded_at"))
    return out.where(~expired(F.col("excluded_at"), now, days))
