"""Refresh on file arrival (optional; the source pipeline uses a monthly cron).

A file-source stream over the landing folder of the daily series notices new
files; ``trigger(availableNow=True)`` processes whatever has landed and stops,
so a scheduler can start it at any time. Each non-empty micro-batch runs the
full refresh (the monthly averages need every day of a month, not only the
new rows), and the stream's checkpoint in the shared checkpoint folder
remembers which files were seen, so an unchanged landing area does no work.
This is not part of the parity inventory: the source has no streaming.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from starload.plans.refresh import refresh
from starload.session import checkpoint_root


def refresh_on_arrival(
    spark: SparkSession,
    daily_path: str,
    globs: Mapping[str, str],
    warehouse_root: str,
    checkpoint: str | None = None,
) -> list[dict]:
    """Run the refresh once if new daily files landed; returns the load reports."""
    checkpoint = checkpoint or f"{checkpoint_root(spark).rstrip('/')}/starload-stream/daily-arrival"
    reports: list[dict] = []

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        res = refresh(spark, daily_path, globs, warehouse_root)
        reports.append({"batch_id": batch_id, "version": res.version, **res.report})

    arrivals = spark.readStream.format("text").load(daily_path)
    q = (
        arrivals.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return reports
