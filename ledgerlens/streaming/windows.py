"""W2 with managed state: a window's counts leave the state once the watermark has passed it.

Keyed state holds, per window and slot, a count per bin; an event-time timer at the window's end emits
them and clears the state, so only open windows are kept. Rows of a window are dealt to SLOTS keys
by a hash: a busy window is several tasks' work, and a reader adds the slots' rows up. Rows that come after
the watermark are dropped by Spark and counted.
"""

from __future__ import annotations

import contextlib
import os

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ledgerlens.operators.drift import bin_index
from ledgerlens.streaming.scoring import finish

SLOTS = 8
CLOSED = "window_start timestamp, slot int, bin int, n long"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class BinCounts(StatefulProcessor):
    """Counts per bin of one (window, slot) until the window ends."""

    def __init__(self, seconds: int):
        self.seconds = seconds

    def init(self, handle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "bin int", "n long")

    def handleInputRows(self, key, rows, timerValues):
        for frame in rows:
            for b, n in frame["bin"].value_counts().items():
                held = self.counts.getValue((int(b),)) if self.counts.containsKey((int(b),)) else None
                self.counts.updateValue((int(b),), (int(n) + (held[0] if held else 0),))
        start = pd.Timestamp(key[0])
        start = start.tz_localize("UTC") if start.tzinfo is None else start
        self.handle.registerTimer(int(start.timestamp() + self.seconds) * 1000)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        rows = [(b[0], n[0]) for b, n in self.counts.iterator()]
        self.counts.clear()
        yield pd.DataFrame({"window_start": [key[0]] * len(rows), "slot": [key[1]] * len(rows),
                            "bin": [b for b, _ in rows], "n": [n for _, n in rows]})

    def close(self) -> None:
        pass


@contextlib.contextmanager
def _with_rocksdb(spark: SparkSession):
    """Timers and maps need this state store; the session's own setting comes back."""
    old = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, old)


def closed_windows(spark: SparkSession, source_dir: str, glob: str, schema, edges: DataFrame, sink: str,
                   checkpoint: str, ts: str = "ts", value: str = "value", days: int = 7, watermark: str = "1 day",
                   files_per_trigger: int = 1, timeout_s: int | None = None) -> tuple[DataFrame, int]:
    """((window_start, bin, n) of every window that the watermark has passed, late rows of this run).

    A run goes on from ``checkpoint``: what is open stays in its state for the next run, what is closed is in
    ``sink`` once, as each epoch's folder is written over when it is repeated."""
    seconds = days * 86400
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", glob)
              .option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir))
    ev = stream.select(F.col(ts).cast("timestamp").alias("_ts"), F.col(value).cast("double").alias("_v"))
    ev = ev.withWatermark("_ts", watermark).where(F.col("_v").isNotNull())
    start = F.timestamp_seconds(F.floor(F.unix_seconds("_ts") / seconds) * seconds)
    rows = ev.crossJoin(F.broadcast(edges)).select(  # static one-row side
        "_ts", start.alias("window_start"), F.pmod(F.xxhash64("_ts", "_v"), F.lit(SLOTS)).cast("int").alias("slot"),
        bin_index(F.col("_v"), F.col("edges")).alias("bin")).where(F.col("bin").isNotNull())
    counts = rows.groupBy("window_start", "slot").transformWithStateInPandas(
        BinCounts(seconds), CLOSED, "Append", "EventTime")

    def write_epoch(batch: DataFrame, epoch: int):
        batch.write.mode("overwrite").parquet(os.path.join(sink, f"epoch={epoch}"))

    with _with_rocksdb(spark):
        q = (counts.writeStream.outputMode("append").foreachBatch(write_epoch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        finish(q, timeout_s)
    late = sum(int(op["numRowsDroppedByWatermark"]) for p in q.recentProgress for op in p["stateOperators"])
    done = spark.read.schema(f"{CLOSED}, epoch long").parquet(sink)
    return done.groupBy("window_start", "bin").agg(F.sum("n").alias("n")), late
