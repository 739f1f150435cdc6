"""Shared plumbing: inputs, materialised tables, folds and worker state."""

from __future__ import annotations

import atexit
import ctypes
import sys
import tempfile
import types
import uuid

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions that run on executors travel by value, so executors need no copy of
# this package on their path.
cloudpickle.register_pickle_by_value(sys.modules["tidewell.llm"])

#: Bytes of rows that Spark hands to a Python worker at once.
ARROW_BATCH = "4m"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the input folder, by any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound the memory of a Python worker: batches of at most ARROW_BATCH."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one where it is unset and all runs in one process."""
    given = spark.conf.get("spark.checkpoint.dir", "")
    if given:
        return given.rstrip("/")
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return str(held.get()).rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = "file://" + tempfile.mkdtemp(prefix="tidewell-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def table(df: DataFrame, what: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it again.

    Cuts the lineage: a lost executor costs the tasks it ran, not the stages
    before. The files go when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidewell-{what}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    sc = spark.sparkContext

    def remove():
        try:
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the JVM has gone
            pass

    atexit.register(remove)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; NULL ids are in no fold (NULL)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(n)


def label_of(labels: DataFrame, name: str) -> DataFrame:
    """(doc_id, y): one row per id; repeated labels count by their majority, a tie as 1.

    Rows with a NULL id or label are left out.
    """
    return (
        labels.select(F.col("doc_id").alias("label_id"), F.col(name).cast("double").alias("y"))
        .where("label_id is not null and y is not null")
        .groupBy("label_id")
        .agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    )


def tidy() -> None:
    """At the end of a task, hand memory that a Python worker has freed back to the system; the worker lives on."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def worker_state(key: str, make):
    """A value that a Python worker process keeps between its tasks."""
    held = sys.modules.setdefault("_tidewell_worker", types.ModuleType("_tidewell_worker"))
    if not hasattr(held, key):
        setattr(held, key, make())
    return getattr(held, key)
