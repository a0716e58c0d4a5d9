"""Streaming forms: windowed counts with late data, first-delivery dedup, per-key cursors, and re-rendering of changed chapters.

State is bounded by watermarks and timeouts; sinks are idempotent by batch. The checkpoint folder is the caller's, shared by the cluster.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def stream_of(spark: SparkSession, folder: str, schema, files_per_batch: int = 1) -> DataFrame:
    """New Parquet files of a folder as a stream; times without zone become instants, which watermarks need."""
    df = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    return df.select(*(F.col(f.name).cast("timestamp").alias(f.name) if f.dataType.typeName() == "timestamp_ntz" else F.col(f.name) for f in schema.fields))


def windowed_counts(events: DataFrame, time: str, key: str, value: str, late: str = "1 hour", size: str = "1 day") -> DataFrame:
    """Events and sums by window and key; events later than ``late`` are left out."""
    w = events.withWatermark(time, late).groupBy(F.window(time, size), key)
    return w.agg(F.count("*").alias("n_events"), F.sum(value).alias("total")).select(F.col("window.start").alias("since"), key, "n_events", "total")


def first_deliveries(events: DataFrame, keys: list[str], time: str, late: str = "1 hour") -> DataFrame:
    """The first delivery of each key within the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


CURSOR = "key string, order_id long, number int, accepted boolean"


def cursors(rows: DataFrame, key: str, order: str, number: str, step: int = 25, time: str | None = None, idle: str = "7 days") -> DataFrame:
    """Forward-only cursor of each key across batches: a number is accepted if it is above the last accepted one by at most ``step``.

    The rows of a key in a batch are ordered as a whole; they are what a key's chapter gets at once. time: a column with a watermark; the state of a key whose last
    row is ``idle`` before the watermark is dropped. Without it the state of every key is kept.
    """
    rest = int(pd.Timedelta(idle).total_seconds() * 1000)

    def advance(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else 0
        pdf = pd.concat(list(frames)).sort_values(order)
        accepted = []
        for n in pdf[number]:
            ok = n is not None and n == n and last < n <= last + step
            last = int(n) if ok else last
            accepted.append(ok)
        state.update((last,))
        if time:
            state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), int(pdf[time].max().timestamp() * 1000)) + rest)
        yield pd.DataFrame({"key": k[0], "order_id": pdf[order], "number": pdf[number], "accepted": accepted})

    how = GroupStateTimeout.EventTimeTimeout if time else GroupStateTimeout.NoTimeout
    return rows.groupBy(key).applyInPandasWithState(advance, CURSOR, "last int", "append", how)


def rerendered(changes: DataFrame, keys: list[str], render: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, int], None], checkpoint: str):
    """Writes, for each batch, the renderings of the keys that it touches; a batch that is tried again writes the same rows."""

    def each(batch: DataFrame, number: int) -> None:
        write(render(batch.select(*keys).distinct()), number)

    return changes.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def collected(stream: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """All rows that a stream has for the data there is, by way of an in-memory table: for tests and small results."""
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)
