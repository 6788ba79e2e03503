"""Stream health: records per second and lag by minute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Reporting period and how far back a report looks.
PERIOD = "60 seconds"
LOOKBACK = "INTERVAL 10 MINUTES"


def health_report(progress: DataFrame, now: Column | None = None) -> DataFrame:
    """Rate and lag per period from ``(timestamp, records_per_second, lag_ms)``.

    With ``now`` the report covers the ten minutes before it.
    """
    rows = progress
    if now is not None:
        stamp = F.col("timestamp")
        rows = rows.where((stamp >= now - F.expr(LOOKBACK)) & (stamp < now))
    return (
        rows.groupBy(F.window("timestamp", PERIOD))
        .agg(
            F.sum("records_per_second").alias("records_per_second_sum"),
            F.avg("records_per_second").alias("records_per_second_avg"),
            F.avg("lag_ms").alias("lag_ms_avg"),
            F.max("lag_ms").alias("lag_ms_max"),
        )
        .select(
            F.col("window.start").alias("period_start"),
            F.col("window.end").alias("period_end"),
            "records_per_second_sum",
            "records_per_second_avg",
            "lag_ms_avg",
            "lag_ms_max",
        )
    )


def query_report(progress: DataFrame) -> DataFrame:
    """What each query read and what came too late for it, by period of recorded progress."""
    window = F.window("timestamp", PERIOD)
    counts = progress.groupBy("query", window).agg(
        F.sum("records").alias("records"),
        F.sum("late_groups").alias("late_groups"),
        F.max("lag_ms").alias("lag_ms_max"),
        F.max("watermark").alias("watermark"),
    )
    bounds = F.col("window.start").alias("period_start"), F.col("window.end").alias("period_end")
    return counts.select("query", *bounds, "records", "late_groups", "lag_ms_max", "watermark")
