"""The stateful operators as Structured Streaming queries over files that arrive."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def files(spark: SparkSession, schema, path: str, at_once: int = 3) -> DataFrame:
    """Parquet files in order of arrival, a few in each batch; the checkpoint resumes after the last file done."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", at_once).parquet(path)


def drain(df: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Runs a query over what has arrived into a table in memory and returns it."""
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def drain_updates(df: DataFrame, folder: str, checkpoint: str) -> DataFrame:
    """Runs a query in update mode over what has arrived into Parquet files, none of it in the driver's memory, and returns all its rows."""

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch-{number}")

    df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(f"{folder}/batch-none")  # nothing may have arrived
    q = df.writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/batch-*")


def first_seen(stream: DataFrame, key: str, at: str, late: str = "30 days") -> DataFrame:
    """The first row of each key within the time that late rows may take."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def tallies(stream: DataFrame, keys: list[str], delta: str) -> DataFrame:
    """Running sums, for update or complete mode."""
    return stream.groupBy(*keys).agg(F.sum(delta).alias("n"))


def moving_average(stream: DataFrame, group: str, rate: str, run: str, alpha: float = 0.3, spike: float = 0.15) -> DataFrame:
    """(group, run, rate, ema, spike): a running average of each group's rates, spikes against the average before."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ema = state.get[0] if state.exists else None
        rows = []
        for pdf in batches:
            for r in pdf.sort_values(run).itertuples():
                value = float(getattr(r, rate))
                jump = ema is not None and value - ema > spike
                ema = int((value if ema is None else alpha * value + (1 - alpha) * ema) * 10000 + 0.5) / 10000
                rows.append((key[0], getattr(r, run), value, ema, jump))
        state.update((ema,))
        yield pd.DataFrame(rows, columns=[group, run, "rate", "ema", "spike"])

    kinds = dict(stream.dtypes)
    out = f"{group} {kinds[group]}, {run} {kinds[run]}, rate double, ema double, spike boolean"
    return stream.groupBy(group).applyInPandasWithState(step, out, "ema double", "append", GroupStateTimeout.NoTimeout)


def ttl_set(stream: DataFrame, key: str, at: str, days: int = 21) -> DataFrame:
    """(key, at, seen): the times at which a key's entries become active, for update mode; of a key's rows the one with most times seen counts.

    The first time is kept, so that it runs out, and then a later one may enter. Rows may
    arrive in any order and a key's rows in several frames, so the state holds all times
    of a key: an earlier one that comes late moves all entries after it.
    """

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        times = [np.frombuffer(bytes(state.get[0]), np.int64)] if state.exists else []
        times += [pdf[at].dropna().to_numpy("datetime64[us]").astype(np.int64) for pdf in batches]
        seen = np.unique(np.concatenate(times))
        state.update((seen.tobytes(),))
        active, place = [], 0
        while place < len(seen):
            active.append(int(seen[place]))
            place = int(np.searchsorted(seen, active[-1] + days * 86_400_000_000, "right"))
        yield pd.DataFrame({key: [k[0]], at: [[pd.Timestamp(t, unit="us") for t in active]], "seen": [len(seen)]})

    kinds = dict(stream.dtypes)
    out = f"{key} {kinds[key]}, {at} array<{kinds[at]}>, seen long"
    return stream.groupBy(key).applyInPandasWithState(step, out, "times binary", "update", GroupStateTimeout.NoTimeout)
