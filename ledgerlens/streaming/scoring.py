"""Stateless scoring of a stream of applicant inputs.

The scoring projection is the same function as in batch; the stream reads
Parquet files as they land, writes to a Parquet sink (exactly-once with the
checkpoint folder) and, for a bounded run, stops once every available file
is processed (``availableNow``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def finish(query, timeout_s: int | None = None) -> None:
    """Wait until the query has processed all available input. A query that fails
    raises, and so does one that is still running after ``timeout_s``: the sink of
    a stopped query is never taken for its result."""
    ended = query.awaitTermination(timeout_s) if timeout_s is not None else query.awaitTermination()
    if timeout_s is not None and not ended:
        query.stop()
        raise TimeoutError(f"the stream was still running after {timeout_s} s; its sink is incomplete")
    if query.exception() is not None:
        raise query.exception()


def score_stream(spark: SparkSession, source: str, schema, transform: Callable[[DataFrame], DataFrame],
                 sink: str, checkpoint: str, files_per_trigger: int = 1, timeout_s: int | None = None) -> DataFrame:
    """Score everything that is there and return the whole sink; ``timeout_s`` raises
    instead of returning part of it."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
              .parquet(source))
    q = (transform(stream).writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    finish(q, timeout_s)
    return spark.read.parquet(sink)
