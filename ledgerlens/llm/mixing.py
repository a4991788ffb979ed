"""Mixing sources to target weights by iterative proportional fitting.

Token totals per cell (source, language, topic) are raked until their marginals
meet the targets. A cell's factor is the product of one factor per source,
language and topic; a document is kept with probability scale x factor, so that
the expected tokens of the sample have the target marginals. The scale is the one
that keeps the ``fraction`` of all tokens, where probabilities over 1 count as 1: a
value with hardly any tokens is then kept whole, and does not set the size of the
sample. Only targets of the caller's own are met exactly, unless a fraction goes with
them: the scale is the largest one that leaves every probability at 1 or less. Whether
a document is kept depends on its id alone (a hash), not on partitions or retries.

Every value of a dimension is raked as itself, however few tokens it has. Up to
DRIVER_CELLS cells are raked on the driver; more stay distributed: each step sums the
cells per value and writes the dimension's factors to the shared folder. Factors go
back to the documents by a join, of which sides up to MAP_VALUES rows go to every task.
Where the targets contradict each other (say, a source has one language only), raking
ends as soon as its rounds no longer change how far the marginals are off.

A topic is the class that most long words of the whole text hash to: a class of
vocabulary, not a subject. Nulls: a null
source or language is a value of its own; a null text has its end id only; a null id is
replaced by the text's hash. Rows that repeat an id stay or go together. Targets
for values that the data lack are left out, the others scaled up; a value that the
caller's targets for its dimension do not name has the target 0, and nothing of it is kept. Values with no
tokens at all keep the factor 1.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import shared
from ledgerlens.llm.textbytes import slices, words_of
from ledgerlens.llm.tokens import ids_of

TOPICS = 8
LONG_WORD = 6
#: Up to this many cells are raked on the driver.
DRIVER_CELLS = 1 << 17
#: Factors of up to this many values go to every task; more are joined.
MAP_VALUES = 1 << 16
#: Exponent of the query's and the pipeline's targets: share of tokens to this power.
TEMPER = 0.7
#: Share of all tokens that is kept, unless the caller says so or has own targets.
FRACTION = 0.5
MISSING = "\x00null"
#: Raking ends below this error, or when a round changes the error by less than STALLED.
TOLERANCE, STALLED, MAX_ROUNDS = 1e-10, 1e-13, 2000
SEED = 42


def with_topic(docs: DataFrame, keep: list[str] | None = None, topics: int = TOPICS,
               prefix: str = "", count: bool = True) -> DataFrame:
    """``keep`` columns (all by default), ``n_tokens`` (if ``count``: ids of the whole
    text with its end id, as they are packed) and ``topic``: of the words of at least LONG_WORD bytes, the most frequent class
    (the lowest among equals; 0 if there are none)."""
    keep = docs.columns if keep is None else keep
    names = [f"{prefix}n_tokens", f"{prefix}topic"][not count:]
    if set(names) & set(keep):
        raise ValueError(f"columns {names} are there already")
    schema = docs.select(*keep).schema
    if count:
        schema = schema.add(names[0], "long")
    schema = schema.add(names[-1], "integer")

    def topic_of(batches):
        for batch, texts in slices(batches, "text"):
            words, n = words_of(texts, lower=True), len(texts)
            codes, distinct = words.codes()
            classes = pd.util.hash_array(distinct.to_numpy(zero_copy_only=False).astype(object),
                                         categorize=False) % topics if len(distinct) else codes
            long = words.ends - words.starts >= LONG_WORD
            votes = np.bincount(words.doc[long] * topics + classes[codes[long]].astype(np.int64),
                                minlength=n * topics).reshape(n, topics)
            tokens = [pa.array([len(ids_of(t.as_py())) for t in batch.column("text")], pa.int64())] if count else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in keep]
                + [*tokens, pa.array(votes.argmax(1).astype(np.int32))], names=[*keep, *names])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(topic_of, schema)


def rake(tokens: np.ndarray, at: list[np.ndarray], targets: list[np.ndarray]) -> list[np.ndarray]:
    """Factors per dimension so that sums of ``tokens`` x factors per value have the
    targets' proportions. at: each cell's value in each dimension."""
    factors = [np.ones(len(t)) for t in targets]
    total = tokens.sum()
    if total <= 0:
        return factors
    goal = []
    for where, target in zip(at, targets):
        there = np.bincount(where, tokens, len(target)) > 0
        wanted = np.where(there, target, 0.0)
        goal.append(wanted * total / wanted.sum() if wanted.sum() > 0 else
                    np.bincount(where, tokens, len(target)))
    last = np.inf
    for _ in range(MAX_ROUNDS):
        worst = 0.0
        for k, where in enumerate(at):
            weight = tokens * np.prod([f[w] for f, w in zip(factors, at)], axis=0)
            now = np.bincount(where, weight, len(goal[k]))
            step = np.divide(goal[k], now, out=np.ones_like(now), where=now > 0)
            worst = max(worst, float(np.abs(now - goal[k]).max()) / total)
            factors[k] = factors[k] * step
        if worst < TOLERANCE or abs(worst - last) < STALLED:
            break
        last = worst
    return factors


def scale_for(tokens: np.ndarray, factor: np.ndarray, fraction: float | None) -> float:
    if not len(tokens) or factor.max() <= 0:
        return 1.0
    if fraction is None:
        return 1.0 / factor.max()
    want = min(fraction, 1.0) * tokens.sum()
    low, high = 0.0, 1.0 / factor[factor > 0].min()
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if (tokens * np.minimum(1, mid * factor)).sum() < want else (low, mid)
    return high


def _value(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(MISSING))


def _side(factors: DataFrame) -> DataFrame:
    return F.broadcast(factors) if factors.count() <= MAP_VALUES else factors


def _times(df: DataFrame, factors: dict[str, DataFrame], at: dict[str, str], out: str) -> DataFrame:
    """``df`` with ``out``, the product of the factors of its values; at: the column
    of each dimension. Values without a factor have 1."""
    own = shared.free_prefix([*df.columns, out], "_rake_")
    product, held = F.lit(1.0), []
    for k, (d, table) in enumerate(factors.items()):
        value, factor = f"{own}v{k}", f"{own}f{k}"
        side = table.select(F.col("value").alias(value), F.col("factor").alias(factor))
        df = df.join(_side(side), _value(at[d]) == F.col(value), "left")
        product = product * F.coalesce(F.col(factor), F.lit(1.0))
        held += [value, factor]
    return df.withColumn(out, product).drop(*held)


def _fit_here(cells: DataFrame, dims: list[str], targets: dict[str, dict], temper: float,
              fraction: float | None) -> tuple[dict[str, DataFrame], float]:
    """Factors (value, factor) per dimension and the scale, raked on the driver."""
    rows = sorted(tuple(r) for r in cells.select(*dims, "n").collect())
    weight = np.array([r[-1] for r in rows], float)
    values = [sorted({r[k] for r in rows}) for k in range(len(dims))]
    index = [{v: i for i, v in enumerate(own)} for own in values]
    at = [np.array([index[k][r[k]] for r in rows], int) for k in range(len(dims))]
    goals = []
    for k, d in enumerate(dims):
        share = np.bincount(at[k], weight, len(values[k]))
        goals.append(np.array([targets[d].get(v, 0.0) for v in values[k]], float) if d in targets else
                     share ** temper * (share > 0))
    raked = rake(weight, at, goals)
    factor = np.prod([f[w] for f, w in zip(raked, at)], axis=0)
    spark = cells.sparkSession
    factors = {d: shared.written(spark.createDataFrame(
        list(zip(own, f.tolist())), "value string, factor double"), "mix-factors")
        for d, own, f in zip(dims, values, raked)}
    return factors, scale_for(weight[weight > 0], factor[weight > 0], fraction)


def _fit_spread(cells: DataFrame, dims: list[str], targets: dict[str, dict], temper: float,
                fraction: float | None) -> tuple[dict[str, DataFrame], float]:
    """As ``_fit_here``, with cells and factors as distributed tables."""
    here = {d: d for d in dims}
    total = cells.agg(F.sum("n")).first()[0] or 0
    if not total:
        return {}, 1.0
    factors = {}
    for d in dims:
        wanted = (_lookup(list(targets[d]), np.array(list(targets[d].values()), float), F.col("value"), 0.0)
                  if d in targets else F.pow("share", F.lit(float(temper))))
        shares = shared.written(
            cells.groupBy(F.col(d).alias("value")).agg(F.sum("n").cast("double").alias("share"))
            .withColumn("wanted", F.when(F.col("share") > 0, wanted).otherwise(0.0)), "mix-shares")
        whole = shares.agg(F.sum("wanted")).first()[0]
        goal = F.col("wanted") * F.lit(float(total) / whole) if whole > 0 else F.col("share")
        factors[d] = shared.written(shares.select("value", goal.alias("goal"), F.lit(1.0).alias("factor"),
                                                  F.lit(0.0).alias("off")), "mix-factors")
    last = np.inf
    for _ in range(MAX_ROUNDS):
        worst = 0.0
        for d in dims:
            now = (_times(cells, factors, here, "f").groupBy(F.col(d).alias("value"))
                   .agg(F.sum(F.col("n") * F.col("f")).alias("now")))
            step = F.when(F.col("now") > 0, F.col("goal") / F.col("now")).otherwise(1.0)
            factors[d] = shared.written(
                now.join(factors[d], "value").select("value", "goal", (F.col("factor") * step).alias("factor"),
                                                     F.abs(F.col("now") - F.col("goal")).alias("off")),
                "mix-factors")
            worst = max(worst, factors[d].agg(F.max("off")).first()[0] / total)
        if worst < TOLERANCE or abs(worst - last) < STALLED:
            break
        last = worst
    raked = shared.written(_times(cells, factors, here, "f").filter("n > 0").select("n", "f"), "mix-raked")
    return factors, _scale_spread(raked, fraction)


def _scale_spread(raked: DataFrame, fraction: float | None) -> float:
    """``scale_for`` of (n, f): what is kept is concave in the scale and linear
    between the points where a cell reaches 1, so Newton's steps end there from below."""
    tokens, weight, most = raked.agg(F.sum("n"), F.sum(F.col("n") * F.col("f")), F.max("f")).first()
    if not tokens or most <= 0:
        return 1.0
    if fraction is None:
        return 1.0 / most
    want = min(fraction, 1.0) * tokens
    scale = want / weight
    for _ in range(MAX_ROUNDS):
        over = F.col("f") * F.lit(scale) >= 1
        full, rest = raked.agg(F.sum(F.when(over, F.col("n")).otherwise(0)),
                               F.sum(F.when(over, 0.0).otherwise(F.col("n") * F.col("f")))).first()
        if not rest or (want - full) / rest <= scale * (1 + 1e-12):
            break
        scale = (want - full) / rest
    return scale


def _lookup(keys: list, values: np.ndarray, at: Column, default: float) -> Column:
    pairs = [x for k, v in zip(keys, values.tolist()) for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.element_at(F.create_map(*pairs), at), F.lit(default)) if pairs else F.lit(default)


class Mix:
    """Factors fitted on ``counted``, which has the dimensions and tokens."""

    def __init__(self, counted: DataFrame, dims: list[str], tokens: str,
                 targets: dict[str, dict] | None = None, temper: float = TEMPER,
                 fraction: float | None = None):
        if fraction is None and not targets:
            fraction = FRACTION
        cells = shared.written(counted.groupBy(*[_value(d).alias(d) for d in dims])
                               .agg(F.coalesce(F.sum(tokens), F.lit(0)).alias("n")), "mix-cells")
        # as the cells spell values: a topic may be given as a number, null as None
        targets = {d: {MISSING if v is None else str(v): float(t) for v, t in own.items()}
                   for d, own in (targets or {}).items()}
        fit = _fit_here if cells.count() <= DRIVER_CELLS else _fit_spread
        self.factors, self.scale = fit(cells, dims, targets, temper, fraction)

    def weighted(self, df: DataFrame, names: dict[str, str] | None = None,
                 weight: str = "weight", probability: str = "probability") -> DataFrame:
        """``df`` with the raked weight of a token and the probability of a document;
        names: of dimensions under another column name."""
        out = _times(df, self.factors, {d: (names or {}).get(d, d) for d in self.factors}, weight)
        return out.withColumn(probability, F.least(F.lit(1.0), F.lit(float(self.scale)) * F.col(weight)))


def draw(doc_id: str = "doc_id", text: str | None = None, seed: int = SEED) -> Column:
    """A uniform number in [0, 1) that depends on the id."""
    key = F.col(doc_id) if text is None else F.coalesce(doc_id, F.xxhash64(text))
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))


DIMS = ["source", "lang", "topic"]


def mix_report(docs: DataFrame, **kw) -> DataFrame:
    """One row per document: dimensions, tokens, raked weight, probability, kept."""
    keyed = docs.select(F.coalesce("doc_id", F.xxhash64("text")).alias("_mix_key"), "doc_id",
                        "source", "lang", "text")
    counted = shared.written(with_topic(keyed, ["_mix_key", "doc_id", "source", "lang"]), "mix")
    mix = Mix(counted, DIMS, "n_tokens", **kw)
    return (mix.weighted(counted)
            .withColumn("kept", draw("_mix_key") < F.col("probability")).drop("_mix_key"))


def keep_mixed(docs: DataFrame, **kw) -> DataFrame:
    """The sampled documents, with their columns. Texts are read twice, once for the
    factors and once to sample, and shuffled only if a dimension has over MAP_VALUES values."""
    counted = shared.written(with_topic(docs, ["source", "lang"]), "mix")
    mix = Mix(counted, DIMS, "n_tokens", **kw)
    own = shared.free_prefix(docs.columns, "_mix_")
    again = mix.weighted(with_topic(docs, prefix=own, count=False), {"topic": f"{own}topic"},
                         f"{own}weight", f"{own}probability")
    sampled = draw("doc_id", "text") < F.col(f"{own}probability")
    return again.filter(sampled).select(*docs.columns)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(shared.table(spark, sf_dir, "documents"))
