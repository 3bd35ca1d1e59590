"""Rates, newest records, capped series."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

HISTORY_SIZE = 200
CHART_POINTS = 30
#: Samples of a counter that one task compares.
TASK_ROWS = 1_000_000
#: Times looked at for each range when its bounds are chosen.
SAMPLED_TIMES = 100


def events_per_second(df: DataFrame) -> DataFrame:
    """Records per second of arrival: ``second, events``."""
    second = F.window("ingest_ts", "1 second")["start"]
    return df.groupBy(second.alias("second")).agg(F.count("*").alias("events"))


def rate_from_counter(
    samples: DataFrame, ts: str = "ts", value: str = "value", series: str | None = None, rows: int = TASK_ROWS
) -> DataFrame:
    """Increase of a running counter since the previous sample of its series, never negative: adds ``rate``.

    Samples are dealt out by ranges of time that hold about ``rows`` each, whatever their density;
    the bounds come from a sample of times and are constants from then on, so every step sees the
    same ranges and nothing is written down. The last value of a series in each range comes again
    as a row ahead of its next range, so samples are shuffled once, narrow, and compared within
    (series, range). A first sample counts from zero. Samples without time come first.
    """
    key = F.lit(0) if series is None else F.col(series)
    total = samples.count()
    ranges = max(1, -(-total // rows))
    bounds = _time_bounds(samples, ts, ranges, total)
    placed = samples.withColumns({"_series": key, "_range": _range_of(samples, ts, bounds), "_sample": F.lit(True)})
    if bounds:
        last = placed.groupBy("_series", "_range").agg(F.max_by(value, ts).alias("_last"))
        ordered = W.partitionBy("_series").orderBy("_range")
        carried = last.select("_series", F.lead("_range").over(ordered).alias("_range"), F.col("_last").alias(value)).where("_range IS NOT NULL")
        placed = placed.unionByName(carried.withColumn("_sample", F.lit(False)), allowMissingColumns=True).repartition(ranges, "_series", "_range")
    before = F.lag(value).over(W.partitionBy("_series", "_range").orderBy("_sample", ts))
    return (
        placed.withColumn("rate", F.greatest(F.col(value) - F.coalesce(before, F.lit(0)), F.lit(0)))
        .where("_sample").select(*samples.columns, "rate")
    )


def _number(samples: DataFrame, ts: str) -> Column:
    """A number in the order of ``ts``; no time is the lowest."""
    at = F.col(ts)
    if not isinstance(samples.schema[ts].dataType, T.NumericType):
        at = at.cast("timestamp")
    return F.coalesce(at.cast("double"), F.lit(float("-inf")))


def _time_bounds(samples: DataFrame, ts: str, ranges: int, total: int) -> list[float]:
    """Times that part the samples into about equal ranges; sampling them moves bounds, never a result."""
    if ranges == 1:
        return []
    sampled = samples.where(F.col(ts).isNotNull()).select(_number(samples, ts).alias("at"))
    if total > SAMPLED_TIMES * ranges:
        sampled = sampled.sample(SAMPLED_TIMES * ranges / total)
    return sorted(set(sampled.approxQuantile("at", [i / ranges for i in range(1, ranges)], 0.1 / ranges)))


def _range_of(samples: DataFrame, ts: str, bounds: list[float]) -> Column:
    if not bounds:
        return F.lit(0)
    edges = np.array(bounds)

    @F.pandas_udf(T.IntegerType())
    def place(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, at.to_numpy(), side="right").astype("int32"))

    return place(_number(samples, ts))


def last_n(df: DataFrame, n: int, *order: Column, by: str | None = None) -> DataFrame:
    """The first ``n`` rows in the given order, of all rows or per series.

    Both forms keep only ``n`` rows per task before anything is shuffled.
    """
    if by is None:
        return df.orderBy(*order).limit(n)
    rank = F.row_number().over(W.partitionBy(by).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def newest_first(history: DataFrame, n: int = HISTORY_SIZE) -> DataFrame:
    """Newest records; ties by hash so that the slice is the same every time."""
    return last_n(history, n, F.col("ingest_ts").desc(), F.col("raw_sha256").asc())


def chronological(df: DataFrame, ts: str) -> DataFrame:
    return df.orderBy(ts)
