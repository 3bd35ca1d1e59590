"""Time-windowed duplicate removal.

A record is kept when no record with the same hash was *kept* within the last W seconds; a
dropped duplicate does not extend the window, and exactly W is still a duplicate. Finding
the kept times of one hash is a chain: from each kept time, the first time more than W
later.

First the narrow (hash, time) pairs are counted per hash; only hashes that occur more than
once are written down. Records of all other hashes pass, as do those without payload or
time, which have no duplicates. The repeated hashes are broadcast where they were counted to
be few; otherwise Spark shuffles, with the same result. For the rest the kept times come in three tiers:

1. all times of the hash lie within W: the earliest is kept;
2. few records: the sorted times are folded inside one row;
3. hot hashes (more than ``hot_rows`` records): the chain is solved as a parallel scan.
   Each window of W holds at most one kept time, so a run of windows acts as a step
   function "end of the previous chain -> end of this chain". Neighbouring runs are
   composed level by level until one run per hash is left, then the true chain is handed
   back down. No task ever holds more than a few windows of one hash.

The kept pairs are then semi-joined to the records on (hash, time), which spreads even a
hash that owns a third of all rows. Of records equal in both, the one whose columns hash
lowest stays. A time that moves from job to job (``current_timestamp()``) is written down
first, since several jobs read it.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lognorm.session import cut_lineage

HOT_ROWS = 4_096
# Times one task may hold while composing runs (8 bytes each).
TASK_TIMES = 4_000_000
BROADCAST_ROWS = 500_000

_KEY, _TIME = "_dedup_key", "_dedup_time"


def dedup_window(
    df: DataFrame,
    seconds: float = 300,
    enabled: bool = True,
    hot_rows: int = HOT_ROWS,
    task_times: int = TASK_TIMES,
) -> DataFrame:
    """Records accepted by the window, by ``sha2(raw)`` and ``ingest_ts``.

    Of records equal in hash and time one is kept. The counting pass runs at once; the rest
    is lazy.
    """
    if not enabled:
        return df
    if _moves(df):
        df = cut_lineage(df)
    window = int(seconds * 1_000_000)
    keyed = df.withColumns({
        _KEY: F.unhex(F.col("raw_sha256") if "raw_sha256" in df.columns else F.sha2("raw", 256)),
        _TIME: F.unix_micros("ingest_ts"),
    })
    timed = keyed.select(_KEY, _TIME).where(F.col(_KEY).isNotNull() & F.col(_TIME).isNotNull())
    repeated = cut_lineage(_spans(timed).filter("n > 1"))
    found = repeated.agg(F.count("*").alias("hashes")).first()["hashes"]
    if not found:
        return df
    marked = keyed.join(_small(repeated.select(_KEY, F.lit(True).alias("_again")), found), _KEY, "left").select(*keyed.columns, "_again")
    pass_on = F.col("_again").isNull() | F.col(_TIME).isNull()
    single, rest = marked.where(pass_on).select(df.columns), marked.where(~pass_on).drop("_again")
    kept = kept_times(timed, window, hot_rows, task_times, repeated)
    return single.unionByName(_accepted(rest, kept).select(df.columns))


def _moves(df: DataFrame) -> bool:
    """Whether a second job could see other values: the plan holds a clock or a random function."""
    return re.search(r"\b(current_timestamp|localtimestamp|now|rand|randn|uuid)\(", df._jdf.queryExecution().analyzed().toString()) is not None


def _spans(times: DataFrame) -> DataFrame:
    return times.groupBy(_KEY).agg(F.count("*").alias("n"), F.min(_TIME).alias("lo"), F.max(_TIME).alias("hi"))


def _accepted(keyed: DataFrame, kept: DataFrame) -> DataFrame:
    """One record for each kept (hash, time); equal ones collapse map-side before they are shuffled."""
    columns = [c for c in keyed.columns if c not in (_KEY, _TIME)]
    row = F.struct(*columns)
    met = keyed.join(kept, [_KEY, _TIME], "left_semi")
    return met.groupBy(_KEY, _TIME).agg(F.min_by(row, F.xxhash64(*columns)).alias("_row")).select("_row.*")


def kept_times(
    times: DataFrame, window: int, hot_rows: int, task_times: int, spans: DataFrame | None = None
) -> DataFrame:
    """Kept (hash, time) pairs of a (hash, time) table; times and window in microseconds.

    ``spans`` restricts the work to its hashes and must be cheap to read again.
    """
    spans = cut_lineage(_spans(times)) if spans is None else spans
    short, is_hot = F.col("hi") - F.col("lo") <= window, F.col("n") > hot_rows
    kept = spans.filter(short).select(_KEY, F.col("lo").alias(_TIME))
    long = spans.filter(~short)
    found = long.agg(
        F.count_if(~is_hot).alias("folded"), F.count_if(is_hot).alias("hot"),
        F.max(F.when(is_hot, F.expr(f"(hi - lo) div {window} + 1"))).alias("windows"),
    ).first()
    if found["folded"]:
        few = _small(long.filter(~is_hot).select(_KEY), found["folded"])
        kept = kept.unionByName(_folded(times.join(few, _KEY, "left_semi"), window))
    if found["hot"]:
        hot = _small(long.filter(is_hot).select(_KEY, "lo"), found["hot"])
        kept = kept.unionByName(_scanned(times.join(hot, _KEY), window, found["windows"], task_times))
    return kept


def _small(hashes: DataFrame, count: int) -> DataFrame:
    """Broadcast when counted to be small (about 60 bytes a row); else left to Spark."""
    return F.broadcast(hashes) if count <= BROADCAST_ROWS else hashes


def _folded(times: DataFrame, window: int) -> DataFrame:
    def step(acc: Column, t: Column) -> Column:
        return F.when(
            acc["last"].isNull() | (t - acc["last"] > window),
            F.struct(t.alias("last"), F.concat(acc["kept"], F.array(t)).alias("kept")),
        ).otherwise(acc)

    start = F.lit(None).cast("long")
    chain = F.aggregate(
        F.array_sort(F.collect_set(_TIME)),
        F.struct(start.alias("last"), F.array().cast("array<bigint>").alias("kept")),
        step,
        lambda acc: acc["kept"],
    )
    return times.groupBy(_KEY).agg(chain.alias("kept")).select(_KEY, F.explode("kept").alias(_TIME))


# ------------------------------------------------------------------ hot hashes
#
# A run of windows is stored as rows (hash, run, entry, exit): the first entry above
# "previous kept time + W" tells where the chain leaves the run.


def _scanned(times: DataFrame, window: int, windows: int, task_times: int) -> DataFrame:
    points = cut_lineage(
        times.select(_KEY, F.expr(f"({_TIME} - lo) div {window}").alias("run"), _TIME)
        .distinct()
    )
    fullest = points.groupBy(_KEY, "run").count().agg(F.max("count")).first()[0]
    fan = min(max(task_times // fullest, 2), 64)
    levels = [points.select(_KEY, "run", F.col(_TIME).alias("entry"), F.col(_TIME).alias("exit"))]
    while windows > fan:
        levels.append(cut_lineage(_compose(levels[-1], window, fan)))
        windows = -(-windows // fan)
    # Above the last level each hash is one run, entered with nothing kept before it.
    entered = levels[-1].groupBy(_KEY).agg(F.lit(None).cast("long").alias("before")).withColumn("parent", F.lit(0).cast("long"))
    for level in reversed(levels):
        children = level.withColumn("parent", F.expr(f"run div {fan}"))
        entered = _descend(children.join(entered, [_KEY, "parent"]), window)
        entered = entered.withColumn("parent", F.col("run")).drop("run")
    first_after = F.col(_TIME) > F.coalesce(F.col("before") + window, F.col(_TIME) - 1)
    return (
        points.join(entered.withColumnRenamed("parent", "run"), [_KEY, "run"])
        .filter(first_after)
        .groupBy(_KEY, "run").agg(F.min(_TIME).alias(_TIME)).drop("run")
    )


def _compose(level: DataFrame, window: int, fan: int) -> DataFrame:
    """Runs of the next level: ``fan`` neighbouring runs become one."""

    def compose(group: pd.DataFrame) -> pd.DataFrame:
        entry = exit_ = np.empty(0, dtype=np.int64)
        for _, run in sorted(group.groupby("run"), reverse=True):
            run = run.sort_values("entry")
            own, leaves = run["entry"].to_numpy(), run["exit"].to_numpy()
            if len(entry):
                after = np.searchsorted(entry, leaves + window, side="right")
                ends = after == len(entry)
                leaves = np.where(ends, leaves, exit_[np.minimum(after, len(entry) - 1)])
                beyond = entry > own[-1]
                own = np.append(own, entry[beyond][:1])
                leaves = np.append(leaves, exit_[beyond][:1])
            last_of_exit = np.append(leaves[1:] != leaves[:-1], True)
            entry, exit_ = own[last_of_exit], leaves[last_of_exit]
        return pd.DataFrame({
            _KEY: [group[_KEY].iloc[0]] * len(entry), "run": group["parent"].iloc[0],
            "entry": entry, "exit": exit_,
        })

    return (
        level.withColumn("parent", F.expr(f"run div {fan}"))
        .groupBy(_KEY, "parent")
        .applyInPandas(compose, f"{_KEY} binary, run long, entry long, exit long")
    )


def _descend(children: DataFrame, window: int) -> DataFrame:
    """For each run of a level, the last kept time before it, given that of its parent."""

    def descend(group: pd.DataFrame) -> pd.DataFrame:
        before = group["before"].iloc[0]
        last = None if pd.isna(before) else int(before)
        rows = []
        for run, part in sorted(group.groupby("run")):
            part = part.sort_values("entry")
            rows.append((group[_KEY].iloc[0], run, last))
            at = 0 if last is None else int(np.searchsorted(part["entry"].to_numpy(), last + window, side="right"))
            if at < len(part):
                last = int(part["exit"].iloc[at])
        return pd.DataFrame(rows, columns=[_KEY, "run", "before"]).astype({"before": "Int64"})

    return children.groupBy(_KEY, "parent").applyInPandas(descend, f"{_KEY} binary, run long, before long")


def skipped_count(df: DataFrame, kept: DataFrame) -> DataFrame:
    """One row: how many records the window skipped."""
    counts = df.agg(F.count("*").alias("n")).unionAll(kept.agg((-F.count("*")).alias("n")))
    return counts.agg(F.sum("n").alias("skipped"))


def dedup_composite(df: DataFrame, time: str, id: str, message: str, n: int | None = None) -> DataFrame:
    """First record per (time, id, message), or of the first ``n`` characters of the message.

    The parts are compared each on its own, nulls equal to nulls; a long message counts through
    its SHA-256. First is the record whose columns hash lowest.
    """
    text = F.col(message).cast("string")
    keys = [F.col(time).alias("_t"), F.col(id).alias("_i"), F.sha2(text if n is None else F.left(text, F.lit(n)), 256).alias("_m")]
    row = F.struct(*df.columns)
    return df.groupBy(*keys).agg(F.min_by(row, F.xxhash64(*df.columns)).alias("_row")).select("_row.*")
