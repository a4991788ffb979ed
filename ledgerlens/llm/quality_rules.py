"""Quality rules whose cutoffs are chosen under a proven limit on false rejection.

Each rule is a ratio of a document (symbols to words, repeated lines to lines,
...) and rejects documents whose ratio is over its cutoff. All rules of a stratum go
along one path of cutoffs, a grid from harmless to strict, so a step of the path rejects the
documents with any ratio over its cutoff. A labelled holdout (quality 1: good) counts,
per stratum and step, how many good documents would go. A step is safe if the exact
binomial test rejects "over ``alpha`` of the good documents go" at level ``delta`` /
strata: Bonferroni over strata, and a fixed sequence along the path (the first step that fails
ends it), whose tests need no correction among themselves. So with confidence 1 - ``delta``, no
stratum loses more than ``alpha`` of its good documents to the rules. A stratum with too few labels to
prove anything rejects nothing: at least ln(delta / strata) / ln(1 - alpha) good documents are needed,
217 for four strata.

The test counts independent documents: rows of the holdout that repeat an id or have equal text are
one trial.

Nulls: a null text is empty (no words, so the base rule rejects it); a null
stratum is a stratum of its own; null labels are ignored. Repeated rows are
judged alike. Very long texts are counted whole, by the slice. Columns other than the id,
text and stratum are left alone.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import shared
from ledgerlens.llm.textbytes import COUNT_COLUMNS, counts_of, slices

#: ratio of each rule: (count, count that it is divided by)
RULES = {
    "symbols": ("n_symbols", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "upper": ("n_upper", "n_letters"),
    "marks": ("n_marks", "n_words"),
    "doubled": ("n_doubled", "n_words"),
    "top_word": ("top_word", "n_words"),
}
GRID = [0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.65, 0.6, 0.55, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2,
        0.15, 0.1, 0.05]
ALPHA, DELTA = 0.02, 0.05
#: Text bytes that a task counts at a time; a longer text is read whole.
SLICE = 1 << 20
#: Chosen cutoffs up to this many strata go to every task; more are joined.
MAP_STRATA = 4096


def with_counts(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
                prefix: str = "") -> DataFrame:
    """``keep`` columns (all by default) and the long counts of the whole texts."""
    keep = docs.columns if keep is None else keep
    names = [prefix + c for c in COUNT_COLUMNS]
    clash = set(names) & set(keep)
    if clash:
        raise ValueError(f"columns {sorted(clash)} clash with the counts")
    schema = docs.select(*keep).schema
    for c in names:
        schema = schema.add(c, "long")
    held = dict.fromkeys([*keep, text])

    def count(batches):
        for batch, texts in slices(batches, text, SLICE):
            found = counts_of(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in keep]
                + [pa.array(found[c]) for c in COUNT_COLUMNS], names=[*keep, *names])

    return docs.select(*held).mapInArrow(count, schema)


def base_failed(prefix: str = "") -> Column:
    words, again = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (words < 50) | (100 * again > 50 * words)


def rule_value(rule: str, prefix: str = "") -> Column:
    over, under = RULES[rule]
    return F.least(F.lit(1.0), F.col(prefix + over) / F.greatest(F.col(prefix + under), F.lit(1)))


def binomial_at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p): summed exactly, term by term, downwards
    from k, until the terms no longer matter."""
    if k >= n:
        return 1.0
    i = np.arange(k, -1, -1, dtype=float)
    head = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) \
        + k * math.log(p) + (n - k) * math.log1p(-p)
    steps = np.log(i[:-1]) - np.log(n - i[:-1] + 1) + math.log1p(-p) - math.log(p)
    return float(min(1.0, np.exp(head + np.concatenate(([0.0], np.cumsum(steps)))).sum()))


def worst_ratio(prefix: str = "") -> Column:
    """The ratio of the rule that a document comes closest to failing."""
    return F.greatest(*[rule_value(r, prefix) for r in RULES])


def choose_cutoffs(holdout: DataFrame, stratum: str, prefix: str = "", alpha: float = ALPHA,
                   delta: float = DELTA) -> DataFrame:
    """(stratum, cutoff, n_good, n_rejected): the strictest cutoff proven safe on ``holdout``, the good
    documents that the base rule keeps, one row each; strata without one are left out."""
    grid = F.array(*[F.lit(g) for g in GRID])
    # the number of grid cutoffs that a document is over; the grid falls, so it goes under the last ones
    over = F.size(F.filter(grid, lambda g: F.col("worst") > g))
    counted = (holdout.select(F.col(stratum).alias("stratum"), worst_ratio(prefix).alias("worst"))
               .groupBy("stratum", over.alias("over")).agg(F.count(F.lit(1)).alias("n")))
    counted = shared.written(counted, "rule-counts")
    strata = counted.select("stratum").distinct().count()
    if not strata:
        return counted.select("stratum", F.lit(0.0).alias("cutoff"), F.lit(0).cast("long").alias("n_good"),
                              F.lit(0).cast("long").alias("n_rejected")).limit(0)
    steps = F.explode(F.sequence(F.lit(0), F.lit(len(GRID) - 1))).alias("step")
    per = counted.groupBy("stratum").agg(F.sum("n").alias("total"),      # a row per count of the grid
                                         F.collect_list(F.struct("over", "n")).alias("by"))
    # step s rejects the documents over GRID[s]: those over at least len(GRID) - s cutoffs
    tests = per.select("stratum", "total", "by", steps).select(
        "stratum", "total", "step",
        F.aggregate(F.filter("by", lambda x: x["over"] >= len(GRID) - F.col("step")),
                    F.lit(0).cast("long"), lambda s, x: s + x["n"]).alias("rejected"))
    level = delta / strata

    def test(frames):
        for f in frames:
            p = [binomial_at_most(int(k), int(n), alpha) for k, n in zip(f.rejected, f.total)]
            yield f.assign(safe=[int(x <= level) for x in p])[["stratum", "total", "step", "rejected", "safe"]]

    safe = tests.mapInPandas(test, T.StructType([*tests.schema.fields]).add("safe", "integer"))
    run = W.partitionBy("stratum").orderBy("step")   # as long as the grid
    return (safe.withColumn("so_far", F.min("safe").over(run)).filter("so_far = 1")
            .groupBy("stratum").agg(F.max(F.struct("step", "total", "rejected")).alias("last"))
            .select("stratum", F.element_at(grid, F.col("last.step") + 1).alias("cutoff"),
                    F.col("last.total").alias("n_good"), F.col("last.rejected").alias("n_rejected")))


def verdict(counted: DataFrame, cutoffs: DataFrame, stratum: str, prefix: str = "",
            out: str = "kept") -> DataFrame:
    """``counted`` with ``out``: false if the base rule or a chosen cutoff rejects."""
    side = shared.written(cutoffs.select(F.col("stratum").alias(f"{prefix}_stratum"),
                                         F.col("cutoff").alias(f"{prefix}_cutoff")), "rule-cutoffs")
    if side.limit(MAP_STRATA + 1).count() <= MAP_STRATA:
        side = F.broadcast(side)
    joined = counted.join(side, F.col(stratum).eqNullSafe(F.col(f"{prefix}_stratum")), "left")
    over = F.coalesce(worst_ratio(prefix) > F.col(f"{prefix}_cutoff"), F.lit(False))
    return (joined.withColumn(out, ~base_failed(prefix) & ~over)
            .drop(f"{prefix}_stratum", f"{prefix}_cutoff"))


def counted_once(docs: DataFrame, stratum: str, prefix: str) -> DataFrame:
    """Id, stratum, hash of the text and counts of every document, written."""
    rows = docs.select("doc_id", stratum, "text", F.xxhash64("text").alias(f"{prefix}_digest"))
    return shared.written(with_counts(rows, keep=["doc_id", stratum, f"{prefix}_digest"], prefix=prefix),
                          "rule-features")


def cutoffs_for(counted: DataFrame, labels: DataFrame, stratum: str, prefix: str = "", **limits) -> DataFrame:
    """Cutoffs from the rows of ``counted_once`` that the base rule keeps and a label calls good. Copies are one
    trial: of the rows of an id one counts (the smallest hash), of the rows of a text one per stratum."""
    good = labels.filter("quality = 1").select(F.col("doc_id").alias("_labelled")).distinct()
    digest = f"{prefix}_digest"
    holdout = (counted.filter(~base_failed(prefix))
               .join(good, F.col("doc_id") == F.col("_labelled"), "left_semi")
               .groupBy("doc_id").agg(F.min_by(F.struct(*counted.columns), F.struct(digest, stratum)).alias("_row"))
               .select("_row.*").dropDuplicates([stratum, digest]))
    return choose_cutoffs(holdout, stratum, prefix, **limits)


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **limits) -> DataFrame:
    """One row per document: its id, counts, ``base_failed`` and ``kept``."""
    counted = counted_once(docs, stratum, "q_")
    cutoffs = cutoffs_for(counted, labels, stratum, "q_", **limits)
    out = verdict(counted, cutoffs, stratum, "q_").withColumn("base_failed", base_failed("q_"))
    return out.select("doc_id", *[F.col(f"q_{c}").alias(c) for c in COUNT_COLUMNS],
                      "base_failed", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **limits) -> DataFrame:
    """The documents that no rule rejects, with their columns. The texts are
    counted twice, once for the cutoffs and once to filter, but never shuffled."""
    q = shared.free_prefix(docs.columns, "_q_")
    cutoffs = cutoffs_for(counted_once(docs, stratum, q), labels, stratum, q, **limits)
    kept = verdict(with_counts(docs, prefix=q), cutoffs, stratum, q, f"{q}kept")
    return kept.filter(F.col(f"{q}kept")).select(*docs.columns)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept")
