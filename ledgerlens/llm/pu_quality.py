"""Quality classifier from positive and unlabelled documents.

Trusted positives (quality 1) and unlabelled web text train an additive model: each
feature of a document (ratios of its counts over the whole text) falls into one of
BINS bins, and the bins' weights and a bias add up to a margin. They minimise the
non-negative unbiased risk with the logistic loss,

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)),

stepping back on batches where the last term is negative. The class prior is
estimated first, from the same two samples: plain positive-against-unlabelled
fits, each on the other half, order them; where the ratio of unlabelled to positive
tail shares, with a confidence margin for both, is least, it bounds the prior (best
bin), and the lower end of the margin is taken.

The fit uses bounded samples: about POSITIVES and UNLABELLED documents, drawn by
a hash of their ids; scores are computed for all documents, in their own tasks.
Labels are only read from rows outside the held-out fold; label, language, source
and id never enter a score.

Nulls: a null text is empty and is scored; null labels are ignored; a null id is
scored and counts as not held out. Rows that repeat an id get the same score.
Without any positives all scores are 0.5.
Very long texts are counted whole. Rows that repeat an id and its text are one training document, an id's
other texts are others.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import shared
from ledgerlens.llm.quality_rules import SLICE, with_counts
from ledgerlens.llm.textbytes import COUNT_COLUMNS, counts_of, slices

FOLDS = 5
POSITIVES, UNLABELLED = 20_000, 20_000
BINS = 12
STEPS, RATE = 400, 0.1
#: Ridge penalty: at least the first, and the second per positive document.
L2, L2_EACH = 2e-3, 3.0
CUT = 0.3

#: feature: (count, count that it is divided by)
RATIOS = {
    "word_length": ("word_chars", "n_words"), "symbols": ("n_symbols", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"), "repeats": ("n_repeat_words", "n_words"),
    "line_length": ("n_words", "n_lines"), "upper": ("n_upper", "n_letters"),
    "letters": ("n_letters", "n_chars"), "digits": ("n_digits", "n_chars"),
    "marks": ("n_marks", "n_words"), "stops": ("n_stops", "n_words"),
    "top_word": ("top_word", "n_words"), "distinct": ("n_distinct", "n_words"),
    "doubled": ("n_doubled", "n_words"), "long_words": ("n_long_words", "n_words"),
}
FEATURES = ["size", *RATIOS]


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(shared.id_bucket(doc_id, FOLDS) == 0, F.lit(False))


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    ratio = [counts[a] / np.maximum(counts[b], 1) for a, b in RATIOS.values()]
    return np.column_stack([np.log1p(counts["n_words"]), *ratio])


@dataclass
class Model:
    edges: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray | None = None
    bias: float = 0.0
    prior: float = 0.5

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Column of each feature's bin among all features' bins."""
        return np.column_stack([k * BINS + np.searchsorted(e, x[:, k], "right")
                                for k, e in enumerate(self.edges)])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        margin = self.weights[self.bins(x)].sum(1) + self.bias
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def edges_of(x: np.ndarray) -> np.ndarray:
    """Up to BINS - 1 distinct inner quantiles; a value of its own bin where many are equal."""
    cuts = np.unique(np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1]))
    low = x.min()
    return np.unique(np.concatenate(([np.nextafter(low, np.inf)] if low in cuts else [], cuts[cuts > low])))[:BINS - 1]


def _sigmoid(m):
    return 1 / (1 + np.exp(-np.clip(m, -500, 500)))


def _descend(one_p: np.ndarray, one_u: np.ndarray, gradient, ridge: float) -> tuple[np.ndarray, float]:
    """Adam on the weights of one-hot rows; gradient(margins) gives dRisk/dMargin of each."""
    size = one_p.max(initial=0) + 1
    size = max(size, one_u.max(initial=0) + 1, len(FEATURES) * BINS)
    w = np.zeros(size + 1)                                   # the bias is last
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, STEPS + 1):
        gp, gu = gradient(w[one_p].sum(1) + w[-1], w[one_u].sum(1) + w[-1])
        g = np.zeros(size + 1)
        g += np.bincount(one_p.ravel(), np.repeat(gp, one_p.shape[1]), size + 1)
        g += np.bincount(one_u.ravel(), np.repeat(gu, one_u.shape[1]), size + 1)
        g[-1] = gp.sum() + gu.sum()
        g[:-1] += ridge * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w[:-1], float(w[-1])


def estimate_prior(score_p: np.ndarray, score_u: np.ndarray, delta: float = 0.1) -> float:
    """Best bin: where (share of unlabelled over c + margin) / (share of positives over c) is least."""
    p, u = np.sort(score_p), np.sort(score_u)
    cuts = np.unique(np.quantile(p, np.linspace(0, 0.99, 200)))
    tail = lambda x: 1 - np.searchsorted(x, cuts, "left") / len(x)
    margin = np.sqrt(np.log(4 / delta) / 2) * (1 / np.sqrt(len(u)) + 1 / np.sqrt(len(p)))
    qp, qu = tail(p), tail(u)
    ok = qp > margin
    best = np.argmin(np.where(ok, (qu + margin) / np.maximum(qp, 1e-12), np.inf))
    # the lower end of its margin: a prior that is too high leaves no room for negatives
    return float(np.clip((qu[best] - margin) / qp[best], 0.01, 0.99)) if ok.any() else 0.5


def fit(x_p: np.ndarray, x_u: np.ndarray) -> Model:
    """Non-negative unbiased risk on features of positives and unlabelled documents."""
    model = Model()
    if not len(x_p) or not len(x_u):
        return model
    model.edges = [edges_of(np.concatenate((x_p[:, k], x_u[:, k]))) for k in range(x_p.shape[1])]
    one_p, one_u = model.bins(x_p), model.bins(x_u)
    n_p, n_u = len(x_p), len(x_u)
    ridge = max(L2, L2_EACH / n_p)
    # every document's order for the prior comes from a fit on the other half
    score_p, score_u = np.zeros(n_p), np.zeros(n_u)
    for half in range(2):
        own_p, own_u = np.arange(n_p) % 2 == half, np.arange(n_u) % 2 == half
        rest_p, rest_u = one_p[~own_p], one_u[~own_u]
        plain = lambda mp, mu: ((_sigmoid(mp) - 1) / (2 * max(len(mp), 1)),
                                _sigmoid(mu) / (2 * max(len(mu), 1)))
        w, b = _descend(rest_p, rest_u, plain, ridge)
        score_p[own_p], score_u[own_u] = w[one_p[own_p]].sum(1) + b, w[one_u[own_u]].sum(1) + b
    model.prior = prior = estimate_prior(score_p, score_u)

    def nnpu(mp, mu):
        # loss of +1: log(1 + e^-m), of -1: log(1 + e^m)
        negative = np.logaddexp(0, mu).mean() - prior * np.logaddexp(0, mp).mean()
        if negative < 0:                      # step back: only undo the overfitted part
            return prior * _sigmoid(mp) / n_p, -_sigmoid(mu) / n_u
        return prior * (_sigmoid(mp) - 1 - _sigmoid(mp)) / n_p, _sigmoid(mu) / n_u

    model.weights, model.bias = _descend(one_p, one_u, nnpu, ridge)
    return model


def draw_sample(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES,
                unlabelled: int = UNLABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Features of about so many positives and unlabelled training documents, each id and text once."""
    own = shared.free_prefix(docs.columns, "_digest")
    part = lambda salt: F.pmod(F.xxhash64("doc_id", own, F.lit(salt)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias(own)).filter(F.col("doc_id").isNotNull() & ~held_out())
    # rows that repeat an id and its text are one document, an id's other texts are others
    pairs = shared.written(texts.select("doc_id", own).distinct(), "training-rows")
    good = labels.select("doc_id", "quality").filter(~held_out()).filter("quality = 1").select("doc_id").distinct()
    trusted = pairs.join(good, "doc_id", "left_semi")
    n_good, n_pairs = trusted.count(), pairs.count()
    trusted = trusted.filter(part("p") < positives / max(n_good, 1)).withColumn("_kind", F.lit(1))
    some = pairs.filter(part("u") < unlabelled / max(n_pairs, 1)).withColumn("_kind", F.lit(0))
    # about positives + unlabelled rows of 24 bytes, however large the tables are
    picked = trusted.union(some).groupBy("doc_id", own).agg(F.max("_kind").alias("_p"), (1 - F.min("_kind")).alias("_u"))
    chosen = texts.join(F.broadcast(picked), ["doc_id", own])
    kept = ["doc_id", own, "_p", "_u"]
    rows = with_counts(chosen, keep=kept).dropDuplicates(["doc_id", own]).toArrow()
    counts = {c: rows[c].to_numpy() for c in COUNT_COLUMNS}
    x = features(counts) if rows.num_rows else np.zeros((0, len(FEATURES)))
    return x[rows["_p"].to_numpy() == 1], x[rows["_u"].to_numpy() == 1]


def train(docs: DataFrame, labels: DataFrame, **bounds) -> Model:
    return fit(*draw_sample(docs, labels, **bounds))


def with_score(docs: DataFrame, model: Model, name: str = "score", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default) and the score of the whole text."""
    keep = docs.columns if keep is None else keep
    schema = docs.select(*keep).schema.add(name, "double")

    def score(batches):
        for batch, texts in slices(batches, "text", SLICE):
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in keep]
                + [pa.array(model.score(features(counts_of(texts))))], names=[*keep, name])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(score, schema)


def keep_quality(docs: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    """The documents that the classifier predicts to be of quality, with their columns."""
    name = shared.free_prefix(docs.columns, "_quality_score")
    return with_score(docs, train(docs, labels, **bounds), name).filter(F.col(name) >= CUT).select(*docs.columns)


def op10_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_score(docs, train(docs, shared.table(spark, sf_dir, "labels")), keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "score",
                        (F.col("score") >= CUT).cast("int").alias("predicted"))
