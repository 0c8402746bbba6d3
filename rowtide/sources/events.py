"""Change-event sources: anything that yields one text per record."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from rowtide.operators.events import decode


def event_stream(spark: SparkSession, fmt: str, value: str = "value", path: str | None = None, **options) -> DataFrame:
    """Streaming frame with a text ``value`` from any connector; bytes are decoded as UTF-8.

    Where to start (earliest, latest, a position) is the connector's own option.
    """
    reader = spark.readStream.format(fmt).options(**options)
    raw = reader.load(path) if path else reader.load()
    return decode(raw.select(value), value)


def shard_union(shards: Iterable[DataFrame]) -> DataFrame:
    """All shards as one frame, streaming or not; columns are matched by name."""
    return reduce(DataFrame.unionByName, shards)


def splits(raw: DataFrame) -> int:
    """The tasks that rows come in, told from the plan: nothing is run, exchanges included. 0 for a stream."""

    def of(node) -> int:
        known = node.outputPartitioning().numPartitions()
        if known:
            return known
        below = [node.children().apply(i) for i in range(node.children().size())]
        if not below:
            return node.execute().getNumPartitions()
        return sum(map(of, below)) if node.nodeName() == "Union" else max(map(of, below))

    return 0 if raw.isStreaming else of(raw._jdf.queryExecution().sparkPlan())


def spread(raw: DataFrame, tasks: int | None) -> DataFrame:
    """Round-robin over ``tasks``, for sources whose few or uneven splits would hold up the parsing; None: as they come.

    Rows that come in so many splits or more stay where they are: those of a large source, and those that have been dealt.
    """
    return raw if tasks is None or splits(raw) >= tasks else raw.repartition(tasks)
