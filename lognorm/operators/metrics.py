"""Operator metrics as aggregates; all combine map-side, whatever the skew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lognorm.operators.outputs import REASONS
from lognorm.operators.validate import INVALID

METRICS = "metric string, label string, value long"

# Upper bounds of the latency buckets in seconds (fixed values).
LATENCY_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)


def matched_by_parser(df: DataFrame) -> DataFrame:
    """Records per matching parser, valid or not."""
    return df.filter(F.col("parser").isNotNull()).groupBy("parser").agg(F.count("*").alias("matched"))


def validation_failed_by_parser(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("parser").isNotNull()).groupBy("parser")
        .agg(F.count_if(F.col("status") == INVALID).alias("validation_failed"))
    )


def dlq_by_reason(df: DataFrame, dlq_mode: str = "manual") -> DataFrame:
    reason = F.create_map(*[F.lit(x) for pair in REASONS.items() for x in pair])[F.col("status")]
    return (
        df.select(reason.alias("reason"), F.lit(dlq_mode).alias("dlq_mode"))
        .filter(F.col("reason").isNotNull()).groupBy("reason", "dlq_mode").agg(F.count("*").alias("records"))
    )


def metrics_table(processed: DataFrame, ingested: DataFrame, dlq_mode: str = "manual") -> DataFrame:
    """All counters as (metric, label, value).

    ``ingested`` is the frame before dedup, ``processed`` the validated frame after it. One
    pass over each: the counters derive from the (parser, status) counts, a tiny table.
    """
    counts = processed.groupBy("parser", "status").agg(F.count("*").alias("n"))
    n, parser, status = F.col("n"), F.col("parser"), F.col("status")

    def sample(when: Column, metric: str, label: Column, value: Column = n) -> Column:
        return F.when(when, F.struct(
            F.lit(metric).alias("metric"), label.cast("string").alias("label"), value.alias("value")))

    always, no_label = F.lit(True), F.lit("")
    dlq_label = F.create_map(*[F.lit(x) for s, r in REASONS.items() for x in (s, f"{r},{dlq_mode}")])[status]
    samples = counts.select(F.explode(F.array_compact(F.array(
        sample(parser.isNotNull(), "matched_total", parser),
        sample(status == INVALID, "validation_failed_total", parser),
        sample(dlq_label.isNotNull(), "dlq_total", dlq_label),
        sample(always, "dedup_total", no_label, -n),  # skipped = taken in - processed
    ))).alias("s")).select("s.*")
    taken_in = ingested.agg(F.count("*").alias("n")).select(F.explode(F.array(
        sample(always, "ingest_total", no_label), sample(always, "dedup_total", no_label))).alias("s")).select("s.*")
    return samples.unionByName(taken_in).groupBy("metric", "label").agg(F.sum("value").alias("value"))


def totals(metrics: DataFrame) -> DataFrame:
    """One row: taken in, matched over all parsers, dead letters over all reasons."""
    def total(metric: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("metric") == metric, F.col("value"))), F.lit(0))

    return metrics.agg(
        total("ingest_total").alias("ingested"), total("matched_total").alias("parsed"),
        total("dlq_total").alias("dlq"),
    )


def latency_histogram(df: DataFrame, value: str, by: str,
                      buckets: tuple[float, ...] = LATENCY_BUCKETS) -> DataFrame:
    """Cumulative bucket counts plus sum and count per group: ``by, le, bucket_count, sum, count``."""
    seconds = F.col(value)
    per_group = df.groupBy(by).agg(
        F.array(*[F.struct(F.lit(str(b)).alias("le"), F.count_if(seconds <= b).alias("bucket_count")) for b in buckets],
                F.struct(F.lit("+Inf").alias("le"), F.count(seconds).alias("bucket_count"))).alias("buckets"),
        F.sum(seconds).alias("latency_sum"), F.count(seconds).alias("latency_count"),
    )
    return per_group.select(by, F.inline("buckets"), "latency_sum", "latency_count")


def draft_totals(attempts: DataFrame) -> DataFrame:
    """Drafting attempts by (model, status)."""
    counted = attempts.filter(F.col("status").isin("success", "error"))
    return counted.groupBy("model", "status").agg(F.count("*").alias("attempts"))


def parser_share(recent: DataFrame) -> DataFrame:
    """Records per parser in a history slice; unmatched is a slice of its own."""
    return recent.groupBy("parser").agg(F.count("*").alias("records"))
