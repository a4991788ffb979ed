"""Leaf-wise boosting against a plain recount of every split of every open leaf."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ledgerlens.operators import histtrees as H


def frame(spark, x, y, group, parts=3):
    rows = [(i, [float(v) for v in r], int(t), int(g)) for i, (r, t, g) in enumerate(zip(x, y, group))]
    df = spark.createDataFrame(rows, "id long, x array<double>, label int, grp int").repartition(parts, "id")
    return df.withColumn("features", array_to_vector("x"))


def data(n=500, seed=3, values=20):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, values, (n, 6)).astype(float)
    x[:, 4] = rng.normal(size=n)
    p = 1 / (1 + np.exp(-(x[:, 0] / 4 - 3 + (x[:, 1] > 12) * (x[:, 2] < 6) * 2 + x[:, 4])))
    return x, (rng.random(n) < p).astype(int)


def naive_tree(bins, g, h, p, columns):
    """Best-first growth by trying every split of every open leaf, one split at a time."""
    def score(a, b):
        return a * a / (b + p.l2) if b + p.l2 > 0 else 0.0

    def best(rows):
        top = None
        for f in columns:
            for b in range(int(bins[:, f].max())):
                left = bins[rows, f] <= b
                lo, hi = rows[left], rows[~left]
                if min(len(lo), len(hi)) < max(p.min_leaf, 1) or min(h[lo].sum(), h[hi].sum()) < p.min_hessian:
                    continue
                gain = 0.5 * (score(g[lo].sum(), h[lo].sum()) + score(g[hi].sum(), h[hi].sum())
                              - score(g[rows].sum(), h[rows].sum()))
                if gain > p.min_gain + 1e-12 and (top is None or gain > top[0] + 1e-9):
                    top = (gain, f, b, lo, hi)
        return top

    leaves, gains = [(np.arange(len(g)), 0)], []
    while len(leaves) < p.max_leaves:
        options = [(best(r) if not p.max_depth or d < p.max_depth else None, k) for k, (r, d) in enumerate(leaves)]
        options = [(o, k) for o, k in options if o]
        if not options:
            break
        o, k = max(options, key=lambda s: s[0][0])
        depth = leaves.pop(k)[1]
        leaves += [(o[3], depth + 1), (o[4], depth + 1)]
        gains.append(o[0])
    return sorted(len(r) for r, _ in leaves), sorted(gains)


@pytest.mark.parametrize("p", [
    H.Params(rounds=3, max_leaves=63, max_depth=7, min_leaf=4, rate=0.3, balance="balanced"),
    H.Params(rounds=2, max_leaves=9, max_depth=0, min_leaf=1, l2=1.0, min_hessian=2.0, rate=0.5, balance="positive"),
    H.Params(rounds=2, max_leaves=31, max_depth=4, min_leaf=20, columns=0.5, min_gain=0.4),
])
def test_trees_equal_best_first_growth(spark, p, spread):
    x, y = data()
    table = H.binned(frame(spark, x, y, np.zeros(500)), "features", "label", "id", F.col("grp"))
    model, = H.train(table, [H.Fit(p, frozenset({0}))])
    bins = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(table.edges)], axis=1)
    n = np.bincount(y, minlength=2)
    w = {"none": (1, 1), "balanced": 500 / (2 * n), "positive": (1, n[0] / n[1])}[p.balance]
    weight = np.where(y > 0, w[1], w[0])
    f = np.full(500, math.log(n[1] * w[1] / (n[0] * w[0])))
    for k, tree in enumerate(model.trees):
        prob = 1 / (1 + np.exp(-f))
        columns = np.arange(6)
        if p.columns < 1:
            columns = np.sort(np.random.default_rng([p.seed, k]).choice(6, 3, replace=False))
        g, h = weight * (prob - y), weight * prob * (1 - prob)
        sizes, gains = naive_tree(bins, g, h, p, columns)
        leaf = tree.feature < 0
        assert sorted(tree.rows[leaf].astype(int).tolist()) == sizes
        assert sorted(tree.gain[~leaf]) == pytest.approx(gains)
        assert leaf.sum() <= p.max_leaves and tree.rows[0] == 500
        # splits of equal gain may differ, so values are those of the tree's own leaves
        at = tree.walk(bins)
        values = np.array([-p.rate * g[at == i].sum() / (h[at == i].sum() + p.l2) for i in at])
        assert tree.value[at] == pytest.approx(values)
        f = f + values
    assert len(model.trees) == p.rounds


@pytest.fixture(params=["one block", "blocks", "blocks, sums shuffled"])
def spread(request, monkeypatch):
    """Small tables as one block, as several, and with sums too large for the driver."""
    if request.param != "one block":
        monkeypatch.setattr(H, "TASK_ROWS", 128)
    if "shuffled" in request.param:
        monkeypatch.setattr(H, "DRIVER_BYTES", 0)


def test_many_models_train_as_each_alone(spark, spread):
    x, y = data(400, 5)
    group = np.arange(400) % 4
    table = H.binned(frame(spark, x, y, group, 2), "features", "label", "id", F.col("grp"), bins=16)
    fits = [H.Fit(H.Params(rounds=4, max_leaves=8, max_depth=d, min_leaf=3, rows=0.7, columns=0.8, rate=0.2),
                  frozenset(range(4)) - {k}) for d in (2, 3) for k in range(4)]
    together = H.train(table, fits)
    for fit, model in zip(fits[::5], together[::5]):
        alone, = H.train(table, [fit], parallelism=1)
        for a, b in zip(alone.trees, model.trees):
            assert a.feature.tolist() == b.feature.tolist() and a.value == pytest.approx(b.value)
    scored = H.block_margins(table, together, [f"m{i}" for i in range(8)],
                             [{k} for _ in (2, 3) for k in range(4)]).collect()
    assert len(scored) == 2 * 400 and {(r.model, r.group) for r in scored} == {
        (f"m{i}", i % 4) for i in range(8)}
    assert np.mean([(r.margin > 0) == r.label for r in scored]) > 0.6


def test_patience_keeps_the_best_round(spark):
    x, y = data(400, 7)
    y[::5] = 1 - y[::5]
    group = (np.arange(400) >= 300).astype(int)
    table = H.binned(frame(spark, x, y, group), "features", "label", "id", F.col("grp"))
    p = H.Params(rounds=200, max_leaves=31, min_leaf=2, rate=0.3, patience=8)
    model, = H.train(table, [H.Fit(p, frozenset({0}), frozenset({1}))])
    assert len(model.losses) < 200
    assert len(model.trees) == int(np.argmin(model.losses)) + 1 == len(model.losses) - 8
    margins = {r.key: r.margin for r in H.block_margins(table, [model], ["m"], [{1}]).collect()}
    f = np.array([margins[i] for i in range(300, 400)])
    loss = np.logaddexp(0, np.where(y[300:] > 0, -f, f)).mean()
    assert loss == pytest.approx(min(model.losses))


def test_missing_values_and_one_class(spark):
    x, y = data(60, 9)
    x[::7, 0] = np.nan
    table = H.binned(frame(spark, x, np.ones(60), np.zeros(60)), "features", "label", "id", F.col("grp"))
    model, = H.train(table, [H.Fit(H.Params(rounds=2), frozenset({0}))])
    assert model.start == 10.0 and all(len(t.feature) >= 1 for t in model.trees)
    with pytest.raises(ValueError):
        H.train(table, [H.Fit(H.Params(), frozenset({5}))])


def test_a_task_alone_subtracts_tables(spark, monkeypatch):
    """Several blocks in one task: a child's table left after its sibling's gives the trees that counting gives."""
    x, y = data()
    monkeypatch.setattr(H, "BLOCK_ROWS", 100)
    fit = H.Fit(H.Params(rounds=4, max_leaves=20, max_depth=6, min_leaf=3, rows=0.8, columns=0.8), frozenset({0}))
    grown = {}
    for least in (1, 1000):
        monkeypatch.setattr(H, "SUBTRACT_ROWS", least)
        table = H.binned(frame(spark, x, y, np.zeros(500)), "features", "label", "id", F.col("grp"))
        assert table.blocks.count() > 1 and table.rdd().getNumPartitions() == 1
        grown[least], = H.train(table, [fit])
    for a, b in zip(grown[1].trees, grown[1000].trees):
        assert a.rows.tolist() == b.rows.tolist() and a.value == pytest.approx(b.value)


def test_a_round_adds_its_trees_to_the_margins_once(spark, monkeypatch):
    """Spread blocks: the kept margins hold every tree so far, and equal those made anew."""
    monkeypatch.setattr(H, "TASK_ROWS", 128)
    monkeypatch.setattr(H, "REFRESH", 3)
    x, y = data(300)
    table = H.binned(frame(spark, x, y, np.zeros(300)), "features", "label", "id", F.col("grp"))
    run = H._Run(H.Fit(H.Params(), frozenset({0})), table)
    source = H._Spread(table.rdd(), [run], 64, 1)
    for k in range(5):
        source.begin_round([run])
        assert source.held == [k]
        kept = source.rows.map(lambda b: b[-1]).collect()
        assert sum(m.shape[1] for m in kept) == 300
        assert np.concatenate(kept, axis=1)[0] == pytest.approx(run.start + sum(range(1, k + 1)))
        one = np.ones(1)
        run.trees.append(H.Tree(-one.astype(int), one, one, one, one * (k + 1), one, one, 0))


def test_a_stump_reweighs_the_rows_once(monkeypatch):
    """The kept weights are those of all stumps so far: a round looks at the rows once a stump."""
    rng = np.random.default_rng(1)
    bins = rng.integers(0, 8, (400, 5)).astype(np.uint8)
    label = ((bins[:, 0] > 3) ^ (rng.random(400) < 0.3)).astype(float)
    seen, misses = [], H._misses
    monkeypatch.setattr(H, "_misses", lambda s, *rest: seen.append(s) or misses(s, *rest))

    class Rows:
        """One partition, worked on in this process."""

        ctx = None

        def __init__(self, items=None):
            self.items = items

        def getNumPartitions(self):
            return 1

        def mapPartitions(self, f):
            return Rows(list(f(iter([([(0, 400)], bins, label, np.zeros(400, np.int16))]))))

        def collect(self):
            return self.items

    class Table:
        edges, counts = [np.arange(7.0)] * 5, {(0, 0): int((label == 0).sum()), (0, 1): int(label.sum())}

        def rdd(self):
            return Rows()

    found = H.train_stumps(Table(), frozenset({0}), 40, 0.1)
    assert len(found) == 40 and len(seen) <= 40
    w = np.full(400, 1 / 400)
    for s in found:
        said = np.where(bins[:, s.feature] <= s.threshold, s.left, s.right)
        err = w[said != label].sum() / w.sum()
        assert s.weight == pytest.approx(0.1 * math.log((1 - err) / err))
        w[said != label] *= math.exp(s.weight)


def test_a_walk_reads_the_rows_still_going(monkeypatch):
    """A row is looked at once for each split on its way, not once for each level of the tree."""
    n, read, cells = 64, [], H._cells
    monkeypatch.setattr(H, "_cells", lambda bins, rows, feature: read.extend(rows.tolist()) or cells(bins, rows, feature))
    bins = np.arange(n, dtype=np.uint8)[:, None].repeat(3, axis=1)
    # a chain: the k-th split sends bin k to a leaf
    inner = np.arange(0, 20, 2)
    t = H.Tree(np.full(21, -1, np.int32), np.zeros(21, np.int16), np.zeros(21, np.int32), np.zeros(21, np.int32),
               np.arange(21.0), np.zeros(21), np.zeros(21), 10)
    t.feature[inner], t.cut[inner], t.left[inner], t.right[inner] = inner % 3, inner // 2, inner + 1, inner + 2
    for table in (bins, np.asfortranarray(bins), bins[:, ::-1]):
        read.clear()
        assert t.walk(table).tolist() == [2 * k + 1 for k in range(10)] + [20] * (n - 10)
        assert sorted(read) == sorted(k for k in range(n) for _ in range(min(k + 1, 10)))
        assert t.walk(table, np.array([3, 40]), np.array([4, 20], np.int32)).tolist() == [7, 20]


def test_scoring_leaves_the_blocks_where_they_are(spark):
    """Margins of a block are those of its rows, whatever rows are asked for."""
    x, y = data(300)
    table = H.binned(frame(spark, x, y, np.arange(300) % 3), "features", "label", "id", F.col("grp"))
    model, = H.train(table, [H.Fit(H.Params(rounds=5, min_leaf=3), frozenset({0, 1}))])
    every = {r.key: r.margin for r in H.block_margins(table, [model], ["m"]).collect()}
    some = {r.key: r.margin for r in H.block_margins(table, [model], ["m"], [{2}]).collect()}
    assert len(every) == 300 and len(some) == 100 and all(every[k] == v for k, v in some.items())


@pytest.fixture(params=["sums on the driver", "sums shuffled"])
def waves(request, monkeypatch):
    """A job per wave, as for more bins than a task holds."""
    monkeypatch.setattr(H, "TASK_ROWS", 128)
    monkeypatch.setattr(H, "FIT_BYTES", 0)
    if "shuffled" in request.param:
        monkeypatch.setattr(H, "DRIVER_BYTES", 0)


def test_waves_of_jobs_train_the_same_models(spark, waves):
    test_many_models_train_as_each_alone(spark, None)
    test_trees_equal_best_first_growth(
        spark, H.Params(rounds=2, max_leaves=9, max_depth=0, l2=1.0, min_hessian=2.0, rate=0.5, balance="positive"), None)


def test_more_rows_are_grown_by_a_task_for_each_model(spark, monkeypatch):
    """Several models over more than TASK_ROWS rows need no job per wave, and are what the jobs give."""
    x, y = data(600, 11)
    x[:, 1:] += np.random.default_rng(2).normal(size=(600, 5))             # no ties between features
    monkeypatch.setattr(H, "BLOCK_ROWS", 100)
    monkeypatch.setattr(H, "TASK_ROWS", 128)
    group = np.arange(600) % 3
    table = H.binned(frame(spark, x, y, group), "features", "label", "id", F.col("grp"))
    p = H.Params(rounds=12, max_leaves=15, min_leaf=5, rows=0.8, columns=0.7, rate=0.3)
    fits = [H.Fit(p, frozenset({0, 1})), H.Fit(H.replace(p, patience=4, rate=0.5), frozenset({0}), frozenset({1}))]
    monkeypatch.setattr(H, "FIT_BYTES", 0)
    want = H.train(table, fits)
    monkeypatch.setattr(H, "FIT_BYTES", 600 * 6)
    monkeypatch.setattr(H, "_Spread", None)                                # breaks if a wave were a job
    for a, b in zip(H.train(table, fits), want):
        assert len(a.trees) == len(b.trees) and a.losses == pytest.approx(b.losses)
        for s, t in zip(a.trees, b.trees):
            assert s.feature.tolist() == t.feature.tolist() and s.value == pytest.approx(t.value)


def test_features_counted_together_give_their_own_tables():
    rng = np.random.default_rng(4)
    sizes = [64, 2, 3, 64, 40, 2, 17, 1, 64]
    bins = np.asfortranarray(np.stack([rng.integers(0, n, 30_000) for n in sizes], axis=1).astype(np.uint8))
    joint = H.Joint.of(bins, [np.zeros(n - 1) for n in sizes])
    assert len(joint.features) < len(sizes) and sorted(sum(joint.features, [])) == list(range(len(sizes)))
    rows = np.flatnonzero(rng.random(30_000) < 0.7)
    g, h = rng.normal(size=len(rows)), rng.random(len(rows))
    for slots in (1, 3, 200):                                              # the last ones are counted by feature
        slot = rng.integers(0, slots, len(rows))
        for columns in (np.arange(9), np.array([0, 2, 4, 8])):
            got = joint.tabulate(bins, slot, slots, columns, 64, g, h, rows=rows)
            want = H.tabulate(bins, slot, slots, columns, 64, g, h, rows=rows)
            assert got.shape == want.shape and got == pytest.approx(want, abs=1e-9)


def test_margins_are_those_of_the_trees(monkeypatch):
    """Rows that a round learned from go on from where they are; the others watched walk from the root."""
    x, y = data(300, 6)
    bins = np.stack([np.unique(c, return_inverse=True)[1] for c in x.T], axis=1).clip(0, 63).astype(np.uint8)

    class Table:
        edges, counts = [np.arange(63.0)] * 6, {(g, t): int(((np.arange(300) % 3 == g) & (y == t)).sum()) for g in range(3) for t in (0, 1)}

    # leaves that best-first order drops, and splits after the last wave
    run = H._Run(H.Fit(H.Params(rounds=6, max_leaves=7, max_depth=3, min_leaf=3, rows=0.6, rate=0.4), frozenset({0}), frozenset({1})), Table())
    here = H._Here([([(0, 300)], bins, y.astype(float), (np.arange(300) % 3).astype(np.int16))], [run], 64)
    H._grow([run], here, 6)
    f = run.start + sum(t.value[t.walk(bins)] for t in run.trees)
    seen = np.arange(300) % 3 < 2
    assert len(run.trees) == 6 and here.margins[0][seen] == pytest.approx(f[seen])
