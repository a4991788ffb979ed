"""Streaming queries (W1, W2): results equal the batch queries when nothing is late."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import drift as D
from ledgerlens.plans import linear as LIN
from ledgerlens.plans import monitoring as MON
from ledgerlens.plans import scoring as SC
from ledgerlens.plans.registry import query, round_doubles
from ledgerlens.session import materialize
from ledgerlens.sources.io import run_path
from ledgerlens.sources.tables import KEY, read_table
from ledgerlens.streaming.drift import windowed_bin_counts
from ledgerlens.streaming.scoring import score_stream
from ledgerlens.streaming.windows import closed_windows


@query("stream_score", sql=SC.ORACLE_RULE_SCORE)
def q_stream_score(spark, sf_dir):
    """The dashboard inputs land as Parquet files; a file stream scores them
    (same projection as ``rule_score``) into a Parquet sink, exactly once."""
    base = run_path(spark, "stream_score")
    src = f"{base}/inputs"
    SC.dashboard_inputs(spark, sf_dir).repartition(4, KEY).write.mode("overwrite").parquet(src)
    schema = spark.read.parquet(src).schema
    out = score_stream(spark, src, schema, SC.rule_scored, f"{base}/sink", f"{base}/checkpoint")
    return round_doubles(out)


@query("stream_requests", sql=LIN.SPARSE_SQL)
def q_stream_requests(spark, sf_dir):
    """Sparse requests land as files and go through the fitted pipeline (default fill, scale, model),
    with the result of ``sparse_request_score`` in batch."""
    base = run_path(spark, "stream_requests")
    src = f"{base}/inputs"
    LIN.requests(spark, sf_dir).repartition(4, KEY).write.mode("overwrite").parquet(src)
    return score_stream(spark, src, spark.read.parquet(src).schema, LIN.request_scorer(spark, sf_dir),
                        f"{base}/sink", f"{base}/checkpoint")


WEEK = MON.WEEK


def _reference(spark, sf_dir):
    """(events by week, the first week's decile edges, its counts per bin)."""
    ev = MON.events_windows(spark, sf_dir)
    first = ev.agg(F.min("win").alias("_w0"))
    ref = ev.join(F.broadcast(first), F.col("win") == F.col("_w0")).select("feature", "value")  # one-row side
    edges = D.decile_edges(ref, ["feature"])
    ref_c = (ref.join(F.broadcast(edges), "feature")
             .select("feature", D.bin_index(F.col("value"), F.col("edges")).alias("bin"))
             .where(F.col("bin").isNotNull()).groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("e_n")))
    return ev, edges, ref_c


@query("stream_psi", sql=MON.ORACLE_PSI_FEATURE)
def q_stream_psi(spark, sf_dir):
    """Events.value binned against the first week's decile edges in a
    watermarked 7-day event-time aggregation; PSI per window from the counts."""
    ev, edges, ref_c = _reference(spark, sf_dir)
    base = run_path(spark, "stream_psi")
    schema = read_table(spark, sf_dir, "events", normalise=False).schema
    counts = windowed_bin_counts(spark, sf_dir, "events.parquet", schema, edges.select("edges"),
                                 f"{base}/counts", f"{base}/checkpoint")
    act_c = counts.select(F.lit("value").alias("feature"),
                          F.floor(F.unix_seconds("window_start") / WEEK).cast("bigint").alias("win"),
                          "bin", F.col("n").alias("a_n"))
    keys = ev.select("feature", "win").distinct()
    return round_doubles(D.psi_from_counts(edges, ref_c, act_c, keys, ["feature"], "win"))


@query("stream_psi_closed", sql=f"""SELECT * FROM ({MON.ORACLE_PSI_FEATURE}) p
WHERE (win + 1) * {WEEK} <= (SELECT epoch(max(ts)) - 86400 FROM events)""")
def q_stream_psi_closed(spark, sf_dir):
    """W2 with managed state: the PSI of the weeks that the watermark (one day) has passed."""
    ev, edges, ref_c = _reference(spark, sf_dir)
    base = run_path(spark, "stream_psi_closed")
    schema = read_table(spark, sf_dir, "events", normalise=False).schema
    counts, _ = closed_windows(spark, sf_dir, "events.parquet", schema, edges.select("edges"), f"{base}/counts",
                               f"{base}/checkpoint")
    act_c = materialize(counts.select(F.lit("value").alias("feature"),
                                      F.floor(F.unix_seconds("window_start") / WEEK).cast("bigint").alias("win"),
                                      "bin", F.col("n").alias("a_n")), "closed")
    keys = act_c.select("feature", "win").distinct()
    return round_doubles(D.psi_from_counts(edges, ref_c, act_c, keys, ["feature"], "win"))
