"""PSI per event-time window against stored reference bins, with late data
dropped after the watermark.

State = (window, bin) counts kept by Spark's streaming aggregation; each
micro-batch's updated counts are written idempotently (one folder per epoch,
overwritten on replay) by ``foreachBatch``; the latest count per (window, bin)
is the final state. PSI is then the batch ``psi_from_counts`` over those counts.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.operators.drift import bin_index
from ledgerlens.streaming.scoring import finish


def windowed_bin_counts(spark: SparkSession, source_dir: str, glob: str, schema, edges: DataFrame,
                        sink: str, checkpoint: str, ts: str = "ts", value: str = "value",
                        window: str = "7 days", watermark: str = "1 day",
                        files_per_trigger: int = 1, timeout_s: int | None = None) -> DataFrame:
    """Streaming (window_start, bin, n) counts of ``value`` against static ``edges``
    (a one-row DataFrame holding the reference bin edges array ``edges``)."""
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", glob)
              .option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir))
    ev = stream.select(F.col(ts).cast("timestamp").alias("_ts"), F.col(value).cast("double").alias("_v"))
    # watermark needs a timezone-aware timestamp (timestamp_ntz is rejected)
    ev = ev.withWatermark("_ts", watermark).where(F.col("_v").isNotNull())
    binned = ev.crossJoin(F.broadcast(edges)).select(  # static one-row side
        "_ts", bin_index(F.col("_v"), F.col("edges")).alias("bin")).where(F.col("bin").isNotNull())
    counts = binned.groupBy(F.window("_ts", window).alias("w"), "bin").agg(F.count(F.lit(1)).alias("n"))

    def write_epoch(batch: DataFrame, epoch: int):
        (batch.select(F.col("w.start").alias("window_start"), "bin", "n", F.lit(epoch).alias("epoch"))
         .write.mode("overwrite").parquet(os.path.join(sink, f"epoch={epoch}")))

    q = (counts.writeStream.outputMode("update").foreachBatch(write_epoch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finish(q, timeout_s)
    allc = spark.read.parquet(sink)
    w = Window.partitionBy("window_start", "bin").orderBy(F.desc("epoch"))
    return (allc.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
            .select("window_start", "bin", "n"))
