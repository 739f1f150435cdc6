"""Outputs: snapshots that replace each other, CSV exports, appended partials."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_snapshot(df: DataFrame, root: str, version: int) -> str:
    """Writes a new version beside the old ones; readers take the latest that is complete."""
    path = f"{root}/v={version:012d}"
    df.write.mode("errorifexists").parquet(path)
    return path


def latest_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest version with a _SUCCESS mark, through the path's own file system."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(root)
    fs = at.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return None
    names = sorted(str(s.getPath().toString()) for s in fs.listStatus(at) if s.isDirectory())
    done = [n for n in names if fs.exists(sc._jvm.org.apache.hadoop.fs.Path(f"{n}/_SUCCESS"))]
    return spark.read.parquet(done[-1]) if done else None


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)


def append_partial(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def job_row(df: DataFrame, today, version: int) -> DataFrame:
    """Postings as rows of the jobs table: cut to their widths, defaults filled in, stamped."""
    cut = lambda c, n, default="": F.left(F.coalesce(F.nullif(F.trim(F.col(c)), F.lit("")), F.lit(default)), F.lit(n)).alias(c)
    return df.select(
        cut("title", 300), cut("job_url", 500), cut("company_name", 200), cut("ats", 50, "unknown"), cut("location", 200), cut("salary", 200),
        cut("visa_sponsorship", 50, "unknown"), cut("clearance", 50), cut("location_priority", 50, "3"), cut("source_pipeline", 50), cut("role_category", 50),
        today.alias("date_added"), today.alias("last_seen"), F.lit(True).alias("is_active"), F.lit(version).cast("short").alias("classifier_version"),
    )
