"""The streaming job: source, applier, metrics listener."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rowtide.streaming.apply import ChangeApplier
from rowtide.streaming.metrics import BatchMetricsListener

# Fixed value: length of a micro-batch.
BATCH_SECONDS = 100


def start_stream(
    source: DataFrame,
    applier: ChangeApplier,
    checkpoint: str,
    every_seconds: int | None = BATCH_SECONDS,
    name: str = "change-stream",
    cluster: str = "",
) -> tuple[StreamingQuery, BatchMetricsListener]:
    """Start the query; ``every_seconds=None`` works off what is there and stops.

    ``checkpoint`` holds the source positions, so a restart goes on where the last batch ended.
    """
    listener = BatchMetricsListener(applier.spark, applier.metrics_path, name, cluster, every_seconds)
    applier.spark.streams.addListener(listener)
    writer = (
        source.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(applier)
    )
    if every_seconds is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{every_seconds} seconds")
    return writer.start(), listener


def run_available(
    source: DataFrame, applier: ChangeApplier, checkpoint: str, name: str = "change-stream", report_seconds: float | None = None
) -> None:
    """Apply everything the source holds now, then return; a failed batch raises.

    Reports arrive after the query has ended, so their end is waited for; ``report_seconds`` bounds the wait and raises.
    """
    query, listener = start_stream(source, applier, checkpoint, None, name)
    try:
        query.awaitTermination()
    finally:
        reported = listener.ended.wait(report_seconds)
        applier.spark.streams.removeListener(listener)
    if not reported:
        raise TimeoutError(f"the last reports of {name} did not arrive within {report_seconds} s")
