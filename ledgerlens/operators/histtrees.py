"""Boosted trees from binned features (I7-I9, I11, I12): leaf-wise growth, many models at once.

The feature matrix is binned once and written as blocks of bytes; every fit reads those.
A tree grows best first: the open leaf whose best split gains most is split next,
until ``max_leaves`` are there. What a split needs are the sums of gradient, hessian and rows by
(model, leaf, feature, bin). One Spark job gives these for all leaves and all models
that wait for some: each task adds up its blocks, and one shuffle keyed by (model, leaf)
adds up the tasks' tables and finds the best split there. The driver sees one split per leaf.

A wave asks for more leaves than best-first order is sure to need: it replays the order with
what is known, takes unknown gains as none, and expands every leaf it meets. When a replay meets
only leaves that are known, it is the true best-first order, and leaves outside it are dropped.
So a tree takes about as many waves as it is deep, not as many as it has leaves.

Rows never leave their blocks. The models' margins are kept beside the blocks, in a
persisted RDD: a round adds its trees once, not every wave, and every REFRESH rounds the margins are made anew from
the blocks and all trees; a lost executor costs the recomputation of its blocks.
"""

from __future__ import annotations

import heapq
import math
import threading
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import materialize

BINS = 64
#: Rows of a block at most.
BLOCK_ROWS = 1 << 16
#: Rows of a task's share of the blocks, about.
SHARE_ROWS = 1 << 17
#: Rounds after which margins or weights are made anew beside the blocks.
REFRESH = 10
#: Rows (a byte a feature each) up to which a task grows its models alone.
TASK_ROWS = 1 << 18
#: Bytes of all bins up to which a task grows one model alone, if the rows are more.
FIT_BYTES = 256 << 20
#: Cells of the table of a group of features at most.
JOINT_CELLS = 1 << 12
#: Rows from which a node's table is kept there, so that one child's table gives the other's.
SUBTRACT_ROWS = 1 << 12
#: Sums of a wave up to this size are added up on the driver, larger ones by a shuffle.
DRIVER_BYTES = 64 << 20
BLOCK_SCHEMA = "block long, n int, bins binary, label binary, group binary, keys array<long>"


# --------------------------------------------------------------------------- binning

def bin_edges(df: DataFrame, features: str, bins: int = BINS) -> list[np.ndarray]:
    """Per feature the thresholds between its bins, halfway between neighbours of its distinct
    quantiles (a feature with few values has a bin for each). Bounded by features x bins."""
    shares = F.array(*[F.lit(i / (bins - 1)) for i in range(bins)])
    long = df.select(F.posexplode(vector_to_array(features)).alias("at", "x"))
    rows = (long.filter(~F.isnan("x")).groupBy("at")
            .agg(F.percentile_approx("x", shares, 20_000).alias("q"))).collect()
    width = df.select(F.max(F.size(vector_to_array(features)))).first()[0] or 0
    out = [np.zeros(0)] * width
    for r in rows:
        q = np.unique(np.asarray(r["q"], float))
        out[r["at"]] = (q[:-1] + q[1:]) / 2
    return out


@dataclass
class Binned:
    """Written blocks of rows, the thresholds of their bins, and rows by (group, label)."""

    blocks: DataFrame
    edges: list[np.ndarray]
    counts: dict[tuple[int, int], int]
    _base: object = None
    _whole: object = None
    _lock: threading.Lock = field(default_factory=threading.Lock)

    @property
    def width(self) -> int:
        return len(self.edges)

    def rdd(self):
        """([(block number, rows)], bins, label, group) by up to SHARE_ROWS rows, persisted once. The bins lie
        by feature. Up to TASK_ROWS rows make one partition, more are dealt out evenly."""
        if self._base is None:
            rows, cores = sum(self.counts.values()), self.blocks.sparkSession.sparkContext.defaultParallelism
            self._base = self._shares(1 if rows <= TASK_ROWS else cores * math.ceil(rows / (cores * SHARE_ROWS)), SHARE_ROWS)
        return self._base

    def whole(self):
        """The same with all rows in one partition and element, persisted once; for up to FIT_BYTES."""
        with self._lock:                                  # searches ask at the same time
            if self._whole is None:
                self._whole = self._shares(1, math.inf)
            return self._whole

    def _shares(self, few: int, most: float):
        width = self.width

        def unpack(r):
            return ([(r.block, r.n)], np.frombuffer(r.bins, np.uint8).reshape(r.n, width),
                    np.frombuffer(r.label, np.uint8).astype(float), np.frombuffer(r.group, np.int16))

        def shares(blocks):
            some, n = [], 0
            for b in map(unpack, blocks):
                if some and n + len(b[2]) > most:
                    yield _joined(some)
                    some, n = [], 0
                some.append(b)
                n += len(b[2])
            if some:
                yield _joined(some)

        blocks = self.blocks.select("block", "n", "bins", "label", "group")
        blocks = blocks.coalesce(1) if few == 1 else blocks.repartition(few)
        return blocks.rdd.mapPartitions(shares).persist(StorageLevel.MEMORY_AND_DISK)


def _joined(blocks: list) -> tuple:
    if len(blocks) == 1 and blocks[0][1].flags.f_contiguous:
        return blocks[0]
    numbers = [n for b in blocks for n in b[0]]
    return (numbers, np.asfortranarray(np.concatenate([b[1] for b in blocks])),
            np.concatenate([b[2] for b in blocks]), np.concatenate([b[3] for b in blocks]))


def binned(df: DataFrame, features: str, label: str, key: str, group, edges: list[np.ndarray] | None = None,
           bins: int = BINS) -> Binned:
    """``df`` as blocks of bin numbers. ``group`` (a small whole number, such as the fold) says which
    rows a model learns from. A missing value (NaN) goes right at every split."""
    if not 2 <= bins <= 256:
        raise ValueError("bins must fit a byte")
    edges = bin_edges(df, features, bins) if edges is None else edges
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(label).cast("int").alias("label"),
                     group.cast("int").alias("group"), vector_to_array(features).alias("x"))

    def pack(batches: Iterator[pa.RecordBatch]):
        seen = 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                b = batch.slice(at, BLOCK_ROWS)
                x = b.column(3).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(edges))
                out = np.empty(x.shape, np.uint8)
                for j, e in enumerate(edges):
                    out[:, j] = np.searchsorted(e, x[:, j], "left")
                number = (b.column(4)[0].as_py() << 32) + seen
                seen += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([b.num_rows], pa.int32()), pa.array([out.tobytes()], pa.binary()),
                     pa.array([b.column(1).to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()], pa.binary()),
                     pa.array([b.column(2).to_numpy(zero_copy_only=False).astype(np.int16).tobytes()], pa.binary()),
                     pa.array([b.column(0).to_pylist()], pa.list_(pa.int64()))],
                    names=["block", "n", "bins", "label", "group", "keys"])

    counts = {(r["group"], r["label"]): r["count"] for r in rows.groupBy("group", "label").count().collect()}
    few = max(1, math.ceil(sum(counts.values()) / min(BLOCK_ROWS, TASK_ROWS)))
    blocks = materialize(rows.coalesce(few).withColumn("part", F.spark_partition_id())
                         .mapInArrow(pack, BLOCK_SCHEMA), "binned")
    return Binned(blocks, edges, counts)


# --------------------------------------------------------------------------- parameters and trees

@dataclass(frozen=True)
class Params:
    rounds: int = 100
    rate: float = 0.05
    max_leaves: int = 63
    max_depth: int = 7
    min_leaf: int = 20             # rows
    min_hessian: float = 1e-3
    min_gain: float = 0.0
    l2: float = 0.0
    rows: float = 1.0              # share of rows drawn per round
    columns: float = 1.0           # share of features drawn per tree
    balance: str = "none"          # none | balanced | positive
    patience: int | None = None    # rounds without a better loss on the watched rows
    seed: int = 42


@dataclass(frozen=True)
class Fit:
    """A model to train: its parameters, the groups it learns from and those it watches."""

    params: Params
    train: frozenset
    watch: frozenset = frozenset()


@dataclass
class Tree:
    feature: np.ndarray            # -1 at leaves
    cut: np.ndarray                # bins up to it go left
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    rows: np.ndarray               # training rows that reach the node
    gain: np.ndarray
    depth: int

    def walk(self, bins: np.ndarray, rows: np.ndarray | None = None, at: np.ndarray | None = None) -> np.ndarray:
        """The node at which each row (of ``rows``) ends, on its way from the root or from node ``at``."""
        every = np.arange(len(bins)) if rows is None else rows
        at = np.zeros(len(every), np.int32) if at is None else at.copy()
        going = np.flatnonzero(self.feature[at] >= 0)
        while len(going):
            node = at[going]
            right = _cells(bins, every[going], self.feature[node]) > self.cut[node]
            at[going] = np.where(right, self.right[node], self.left[node])
            going = going[self.feature[at[going]] >= 0]
        return at


def _cells(bins: np.ndarray, rows: np.ndarray, feature: np.ndarray) -> np.ndarray:
    """``bins[rows, feature]`` by places in the flat table, which is read faster."""
    if bins.flags.f_contiguous:
        return bins.T.reshape(-1).take(feature.astype(np.int64) * len(bins) + rows)
    if bins.flags.c_contiguous:
        return bins.reshape(-1).take(rows * bins.shape[1] + feature)
    return bins[rows, feature]


@dataclass
class Split:
    gain: float
    feature: int
    cut: int
    left: tuple                    # gradient, hessian, rows
    right: tuple


@dataclass
class Node:
    depth: int
    total: tuple | None = None
    split: Split | None = None
    asked: bool = False
    children: tuple | None = None
    parent: int = -1


@dataclass
class Growing:
    """One tree on its way: nodes that best-first order may need, and the splits known."""

    params: Params
    columns: np.ndarray
    nodes: list[Node] = field(default_factory=lambda: [Node(0)])

    def waiting(self) -> list[int]:
        return [i for i, n in enumerate(self.nodes) if not n.asked and self.may_split(n)]

    def may_split(self, n: Node) -> bool:
        p = self.params
        if p.max_depth and n.depth >= p.max_depth:
            return False
        return n.total is None or (n.total[2] >= 2 * p.min_leaf and n.total[1] >= 2 * p.min_hessian)

    def replay(self) -> tuple[list[int], list[int]]:
        """Splits in best-first order as far as known, and those whose children are not known yet."""
        order, missing, heap = [], [], []

        def offer(i):
            if self.nodes[i].split is not None:
                heapq.heappush(heap, (-self.nodes[i].split.gain, i))

        offer(0)
        while heap and len(order) + 1 < self.params.max_leaves:
            i = heapq.heappop(heap)[1]
            order.append(i)
            if self.nodes[i].children is None:
                missing.append(i)
            else:
                for c in self.nodes[i].children:
                    offer(c)
        return order, missing

    def expand(self, some: list[int]) -> None:
        for i in some:
            n = self.nodes[i]
            n.children = (len(self.nodes), len(self.nodes) + 1)
            self.nodes += [Node(n.depth + 1, n.split.left, parent=i), Node(n.depth + 1, n.split.right, parent=i)]

    def kept(self, chosen: set[int]) -> list[int]:
        """The nodes of the tree of the chosen splits, in its order."""
        ids, at = [0], 0
        while at < len(ids):
            if ids[at] in chosen:
                ids += self.nodes[ids[at]].children
            at += 1
        return ids

    def ends(self, chosen: set[int]) -> np.ndarray:
        """For each node its number in the tree of the chosen splits, or that of the nearest node above it there."""
        place = {i: k for k, i in enumerate(self.kept(chosen))}
        for i, n in enumerate(self.nodes):
            place.setdefault(i, place.get(n.parent))
        return np.array([place[i] for i in range(len(self.nodes))], np.int32)

    def tree(self, chosen: set[int] | None = None) -> Tree:
        """The tree of the chosen splits, by default of all that are expanded; those keep node numbers."""
        p, nodes = self.params, self.nodes
        ids = list(range(len(nodes))) if chosen is None else self.kept(chosen)
        place = {i: k for k, i in enumerate(ids)}
        n = len(ids)
        t = Tree(np.full(n, -1, np.int32), np.zeros(n, np.int16), np.zeros(n, np.int32), np.zeros(n, np.int32),
                 np.zeros(n), np.zeros(n), np.zeros(n), 0)
        for k, i in enumerate(ids):
            node = nodes[i]
            if node.total is not None:
                g, h, t.rows[k] = node.total
                t.value[k] = -p.rate * g / (h + p.l2) if h + p.l2 > 0 else 0.0
            if node.children is not None and (chosen is None or i in chosen):
                t.feature[k], t.cut[k], t.gain[k] = node.split.feature, node.split.cut, node.split.gain
                t.left[k], t.right[k] = (place[c] for c in node.children)
            t.depth = max(t.depth, node.depth)
        return t


def best_split(table: np.ndarray, columns: np.ndarray, p: Params) -> tuple[tuple, Split | None]:
    """Totals and best split of (features, bins, gradient | hessian | rows) sums; the first feature
    and bin of equal ones. Gain is half the drop of sum g**2 / (h + l2)."""
    left = np.cumsum(np.ascontiguousarray(np.moveaxis(table, -1, 0)), axis=2)     # a sum at a time lies together
    total = left[:, 0, -1]
    right = total[:, None, None] - left
    whole = tuple(float(v) for v in total)

    def score(s):
        weight = np.asarray(s[1] + p.l2)
        return np.divide(s[0] * s[0], weight, out=np.zeros_like(weight), where=weight > 0)

    gain = 0.5 * (score(left) + score(right) - score(total))
    rows = max(p.min_leaf, 1)
    fits = ((left[2] >= rows) & (right[2] >= rows) & (left[1] >= p.min_hessian) & (right[1] >= p.min_hessian))
    gain[~fits] = -np.inf
    at = int(np.argmax(gain))
    f, b = divmod(at, gain.shape[1])
    if not gain[f, b] > p.min_gain + 1e-12:
        return whole, None
    return whole, Split(float(gain[f, b]), int(columns[f]), b, tuple(map(float, left[:, f, b])),
                        tuple(map(float, right[:, f, b])))


def tabulate(bins: np.ndarray, slot: np.ndarray, slots: int, columns: np.ndarray, width: int,
             *sums: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
    """(slots, features, width, len(sums) + 1): sums, and rows, by slot, feature and bin; slots and sums
    are those of ``rows`` if given. A feature at a time, so that its table stays in the cache."""
    out = np.empty((len(columns), len(sums) + 1, slots * width))
    base, at = slot.astype(np.int64) * width, np.empty(len(slot), np.int64)
    for i, c in enumerate(columns):
        x = bins[:, c]
        np.add(base, x if rows is None else x.take(rows), out=at)
        for j, s in enumerate(sums):
            out[i, j] = np.bincount(at, s, slots * width)
        out[i, -1] = np.bincount(at, minlength=slots * width)
    return out.reshape(len(columns), -1, slots, width).transpose(2, 0, 3, 1)


@dataclass
class Joint:
    """Features counted together: a code says the bins of a group of features, up to JOINT_CELLS of them. One
    count of a group's codes holds the tables of all its features."""

    features: list[list[int]]      # of each group
    sizes: list[list[int]]
    codes: np.ndarray              # (rows, groups), by group

    @classmethod
    def of(cls, bins: np.ndarray, edges: list[np.ndarray]) -> Joint:
        features, sizes = [], []
        for f in sorted(range(len(edges)), key=lambda f: -len(edges[f])):
            n = len(edges[f]) + 1
            k = next((k for k, some in enumerate(sizes) if math.prod(some) * n <= JOINT_CELLS), None)
            if k is None:
                k = len(sizes)
                features.append([])
                sizes.append([])
            features[k].append(f)
            sizes[k].append(n)
        codes = np.zeros((len(bins), len(sizes)), np.uint16, "F")
        for k, (some, wide) in enumerate(zip(features, sizes)):
            for f, n in zip(some, wide):
                codes[:, k] *= n
                codes[:, k] += bins[:, f]
        return cls(features, sizes, codes)

    def tabulate(self, bins: np.ndarray, slot: np.ndarray, slots: int, columns: np.ndarray, width: int,
                 g: np.ndarray, h: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """``tabulate`` with a count for each group; few rows are counted by feature."""
        if slots * JOINT_CELLS > 2 * len(rows):
            return tabulate(bins, slot, slots, columns, width, g, h, rows=rows)
        place, out = {int(c): i for i, c in enumerate(columns)}, np.zeros((len(columns), 3, slots, width))
        base, at = slot.astype(np.int64) * JOINT_CELLS, np.empty(len(slot), np.int64)
        both = g + 1j * h                                 # added up in one go
        alone = []
        for k, (some, sizes) in enumerate(zip(self.features, self.sizes)):
            asked = [(place[f], j) for j, f in enumerate(some) if f in place]
            if len(asked) < 2:
                alone += [i for i, _ in asked]
                continue
            np.add(base, self.codes[:, k].take(rows), out=at)
            pairs = np.zeros(slots * JOINT_CELLS, complex)
            np.add.at(pairs, at, both)
            pairs, counts = (t.reshape(slots, -1)[:, :math.prod(sizes)].reshape(slots, *sizes)
                             for t in (pairs, np.bincount(at, minlength=slots * JOINT_CELLS)))
            for i, axis in asked:
                others, n = tuple(a + 1 for a in range(len(sizes)) if a != axis), sizes[axis]
                found = pairs.sum(axis=others)
                out[i, 0, :, :n], out[i, 1, :, :n] = found.real, found.imag
                out[i, 2, :, :n] = counts.sum(axis=others)
        if alone:
            out[alone] = tabulate(bins, slot, slots, columns[alone], width, g, h, rows=rows).transpose(1, 3, 0, 2)
        return out.transpose(2, 0, 3, 1)


# --------------------------------------------------------------------------- training

@dataclass
class Boosted:
    """Initial margin, trees and thresholds of a fitted model."""

    start: float
    trees: list[Tree]
    edges: list[np.ndarray]
    losses: list[float] = field(default_factory=list)

    def gains(self) -> np.ndarray:
        """Each feature's share of all gain."""
        out = np.zeros(len(self.edges))
        for t in self.trees:
            np.add.at(out, t.feature[t.feature >= 0], t.gain[t.feature >= 0])
        return out / out.sum() if out.sum() else out

    def splits(self) -> np.ndarray:
        """How often each feature splits (I13's other measure)."""
        out = np.zeros(len(self.edges))
        for t in self.trees:
            np.add.at(out, t.feature[t.feature >= 0], 1.0)
        return out


class _Run:
    """A fit under way."""

    def __init__(self, fit: Fit, table: Binned):
        p = self.p = fit.params
        self.fit = fit
        n = [sum(c for (g, y), c in table.counts.items() if g in fit.train and y == label) for label in (0, 1)]
        total = sum(n)
        if not total:
            raise ValueError("no rows to learn from")
        self.weight = {"none": (1.0, 1.0),
                       "balanced": tuple(total / (2 * v) if v else 1.0 for v in n),
                       "positive": (1.0, n[0] / n[1] if n[1] else 1.0)}[p.balance]
        w = n[0] * self.weight[0], n[1] * self.weight[1]
        self.start = math.log(w[1] / w[0]) if min(w) > 0 else math.copysign(10.0, w[1] - w[0])
        self.trees: list[Tree] = []
        self.losses: list[float] = []
        self.growing: Growing | None = None
        self.ends = np.zeros(1, np.int32)                 # of the last tree
        self.done = p.rounds <= 0

    def begin(self, width: int) -> None:
        k = len(self.trees)
        chosen = np.arange(width)
        if self.p.columns < 1:
            rng = np.random.default_rng([self.p.seed, k])
            chosen = np.sort(rng.choice(width, max(1, math.ceil(self.p.columns * width)), replace=False))
        self.growing = Growing(self.p, chosen)

    def finish(self) -> None:
        chosen = set(self.growing.replay()[0])
        self.trees.append(self.growing.tree(chosen))
        self.ends = self.growing.ends(chosen)
        self.growing = None
        if len(self.trees) >= self.p.rounds:
            self.done = True

    def heard(self, loss: float) -> None:
        """The watched rows' loss of all trees so far; ends the run when patience is out."""
        self.losses.append(loss)
        best = int(np.argmin(self.losses))
        if self.p.patience and len(self.losses) - 1 - best >= self.p.patience:
            self.done = True

    def model(self, edges) -> Boosted:
        keep = len(self.trees)
        if self.p.patience and self.losses:
            keep = int(np.argmin(self.losses)) + 1
        return Boosted(self.start, self.trees[:keep], edges, self.losses)


@dataclass
class _Ask:
    """What a task needs to know of one model in one wave."""

    number: int
    place: int                     # column of the margins
    p: Params
    weight: tuple
    train: np.ndarray
    watch: np.ndarray | None       # groups whose loss is asked for
    partial: Tree | None
    slots: np.ndarray | None       # node -> slot of its table, or -1
    nodes: list[int]
    columns: np.ndarray | None
    round: int


def _loss(ask: _Ask, label, group, f) -> tuple:
    seen = np.isin(group, ask.watch)
    z = np.where(label[seen] > 0, -f[seen], f[seen])
    return (ask.number, -1), np.array([np.logaddexp(0, z).sum(), seen.sum()])


def _learned(ask: _Ask, blocks: list, label, group, f) -> tuple:
    """The rows that a round learns from, their gradients and hessians."""
    used = np.isin(group, ask.train)
    if ask.p.rows < 1:
        used &= np.concatenate([np.random.default_rng([ask.p.seed, ask.round, block]).random(n) for block, n in blocks]
                               ) < ask.p.rows
    used = np.flatnonzero(used)
    prob = 1 / (1 + np.exp(-f[used]))
    w = np.where(label[used] > 0, ask.weight[1], ask.weight[0])
    return used, w * (prob - label[used]), w * prob * (1 - prob)


def _tables(ask: _Ask, blocks: list, bins, label, group, f, width: int) -> Iterator[tuple]:
    if ask.watch is not None:
        yield _loss(ask, label, group, f)
    if ask.partial is None:
        return
    used, g, h = _learned(ask, blocks, label, group, f)
    slot = ask.slots[ask.partial.walk(bins, used)]
    asked = slot >= 0
    tables = tabulate(bins, slot[asked], len(ask.nodes), ask.columns, width, g[asked], h[asked], rows=used[asked])
    for node, table in zip(ask.nodes, tables):
        yield (ask.number, node), table


@dataclass
class _Tree:
    """A tree that a task grows alone: its rows, where they are, and tables of nodes that may be split."""

    used: np.ndarray
    g: np.ndarray
    h: np.ndarray
    at: np.ndarray
    tables: dict = field(default_factory=dict)


class _Here:
    """Blocks that one task holds: margins and the rows' nodes are kept up to date in its memory. Margins are
    those of the rows that a model learns from or watches."""

    lots = 1

    def __init__(self, blocks: list, runs: list[_Run], width: int, joint: Joint | None = None):
        self.blocks, self.bins, self.label, self.group = _joined(blocks)
        self.margins = np.repeat(np.array([[r.start] for r in runs]), len(self.label), axis=1)
        self.seen = [np.isin(self.group, sorted(r.fit.train | r.fit.watch)) for r in runs]
        self.runs, self.width, self.held, self.joint = runs, width, [0] * len(runs), joint
        self.trees: dict[int, _Tree] = {}

    def begin_round(self, runs: list[_Run]) -> None:
        for i, r in enumerate(runs):
            for t in r.trees[self.held[i]:]:
                rest, last = self.seen[i], self.trees.get(i)
                if last is not None and t is r.trees[-1]:     # these rows are nearly there
                    self.margins[i][last.used] += t.value[t.walk(self.bins, last.used, r.ends[last.at])]
                    rest = rest.copy()
                    rest[last.used] = False
                rest = np.flatnonzero(rest)
                self.margins[i][rest] += t.value[t.walk(self.bins, rest)]
            self.held[i] = len(r.trees)
        self.trees = {}

    def wave(self, asks: list[list[_Ask]]) -> list[tuple]:
        out = []
        for ask in asks[0]:
            if ask.watch is not None:
                out.append(_loss(ask, self.label, self.group, self.margins[ask.place]))
            if ask.partial is not None:
                out += [((ask.number, node), best_split(table, ask.columns, ask.p))
                        for node, table in self.counted(ask).items()]
        return out

    def counted(self, ask: _Ask) -> dict:
        """Tables of the nodes asked for. Of two children whose parent's table is kept, the one with fewer
        rows is counted; the other's table is what remains."""
        tree = self.trees.get(ask.place)
        if tree is None:
            used, g, h = _learned(ask, self.blocks, self.label, self.group, self.margins[ask.place])
            tree = self.trees[ask.place] = _Tree(used, g, h, np.zeros(len(used), np.int32))
        tree.at = ask.partial.walk(self.bins, tree.used, tree.at)
        nodes, count, rest = self.runs[ask.place].growing.nodes, [], {}
        for i in ask.nodes:
            parent = nodes[i].parent
            if parent not in tree.tables:
                count.append(i)
                continue
            few, many = sorted(nodes[parent].children, key=lambda c: (nodes[c].total[2], c))
            if few not in count:
                count.append(few)
            if i == many:
                rest[many] = parent, few
        slots = np.full(len(nodes), -1)
        slots[count] = np.arange(len(count))
        slot = slots[tree.at]
        asked = np.flatnonzero(slot >= 0)
        count_by = tabulate if self.joint is None else self.joint.tabulate
        tables = count_by(self.bins, slot[asked], len(count), ask.columns, self.width, tree.g[asked], tree.h[asked],
                          rows=tree.used[asked])
        found = dict(zip(count, tables))
        for many, (parent, few) in rest.items():
            found[many] = tree.tables[parent] - found[few]
        for i in ask.nodes:
            tree.tables.pop(nodes[i].parent, None)
            if found[i][0, :, -1].sum() >= SUBTRACT_ROWS:
                tree.tables[i] = found[i].copy()
        return {i: found[i] for i in ask.nodes}


class _Spread:
    """Blocks all over the cluster: a wave is a job. The margins are persisted with each round's trees."""

    def __init__(self, base, runs: list[_Run], width: int, parallelism: int):
        self.base, self.width, self.parts = base, width, base.getNumPartitions()
        # few blocks and many models: the models are dealt out as well
        self.lots = max(1, min(len(runs), parallelism // self.parts))
        self.rows, self.old, self.written, self.held = None, None, 0, [0] * len(runs)

    def begin_round(self, runs: list[_Run]) -> None:
        step = max(len(r.trees) for r in runs)
        self.old = self.rows
        if self.rows is None or step - self.written >= REFRESH:
            self.rows, self.written = self.anew(runs), step
        else:
            self.rows = self.advanced(runs)
        self.rows = self.rows.persist(StorageLevel.MEMORY_AND_DISK)
        self.held = [len(r.trees) for r in runs]

    def anew(self, runs: list[_Run]):
        """The blocks with the margins of all trees."""
        made = []
        for lot in range(self.lots):
            sent = self.base.ctx.broadcast([(r.start, list(r.trees)) for r in runs[lot::self.lots]])

            def add(b, sent=sent):
                return (*b, _advanced(b[1], np.repeat([[start] for start, _ in sent.value], len(b[2]), axis=1),
                                      [trees for _, trees in sent.value]))

            made.append(self.base.map(add))
        return self.base.ctx.union(made)

    def advanced(self, runs: list[_Run]):
        """The last round's margins and the trees since: one a model."""
        lots, parts = self.lots, self.parts
        trees = [[r.trees[held:] for r, held in zip(runs[lot::lots], self.held[lot::lots])] for lot in range(lots)]

        def add(index, blocks):
            for *b, margins in blocks:
                yield (*b, _advanced(b[1], margins.copy(), trees[index // parts]))

        return self.rows.mapPartitionsWithIndex(add)

    def wave(self, asks: list[list[_Ask]]) -> list[tuple]:
        width, parts = self.width, self.parts

        def work(index, blocks):
            return _sums(asks[index // parts], blocks, width).items()

        tables = self.rows.mapPartitionsWithIndex(work)
        found = self.added_up(tables, asks)
        if self.old is not None:                          # the new margins are there now
            self.old.unpersist()
            self.old = None
        return found

    def added_up(self, tables, asks: list[list[_Ask]]) -> list[tuple]:
        width, parts = self.width, self.parts
        leaves = sum(len(a.nodes) for lot in asks for a in lot)
        size = parts * 24 * width * sum(len(a.nodes) * len(a.columns) for lot in asks for a in lot if a.nodes)
        if size > DRIVER_BYTES:
            return tables.reduceByKey(np.add, min(parts, leaves + 1)).map(lambda item: _decided(item, asks)).collect()
        sums: dict = {}
        for key, part in tables.collect():
            sums[key] = sums[key] + part if key in sums else part
        return [_decided(item, asks) for item in sums.items()]


def _advanced(bins: np.ndarray, margins: np.ndarray, trees: list[list[Tree]]) -> np.ndarray:
    for f, some in zip(margins, trees):
        for t in some:
            f += t.value[t.walk(bins)]
    return margins


def _sums(mine: list[_Ask], blocks, width: int) -> dict:
    sums: dict = {}
    for numbers, bins, label, group, f in blocks:
        for ask in mine:
            for key, part in _tables(ask, numbers, bins, label, group, f[ask.place], width):
                sums[key] = sums[key] + part if key in sums else part
    return sums


def _decided(item: tuple, asks: list[list[_Ask]]) -> tuple:
    """((model, node), (totals, split)) of a leaf's table, ((model, -1), loss sums)."""
    (model, node), sums = item
    if node == -1:
        return (model, node), sums
    ask = next(a for lot in asks for a in lot if a.number == model)
    return (model, node), best_split(sums, ask.columns, ask.p)


def _grow(runs: list[_Run], source, features: int) -> None:
    """All rounds of all runs: waves of leaves until every tree's best-first order is known."""
    while any(not r.done or len(r.losses) < len(r.trees) and r.fit.watch for r in runs):
        source.begin_round(runs)
        for r in runs:
            if not r.done:
                r.begin(features)
        first = True
        while True:
            asks: list[list[_Ask]] = [[] for _ in range(source.lots)]
            for i, r in enumerate(runs):
                nodes = r.growing.waiting() if r.growing else []
                watch = first and r.fit.watch and len(r.losses) < len(r.trees)
                if not nodes and not watch:
                    continue
                partial = slots = None
                if nodes:
                    partial = r.growing.tree()
                    slots = np.full(len(r.growing.nodes), -1)
                    slots[nodes] = np.arange(len(nodes))
                asks[i % source.lots].append(_Ask(
                    i, i // source.lots, r.p, r.weight, np.array(sorted(r.fit.train)),
                    np.array(sorted(r.fit.watch)) if watch else None, partial, slots,
                    nodes, r.growing.columns if nodes else None, len(r.trees)))
            first = False
            if not any(asks):
                break
            for (i, node), found in source.wave(asks):
                r = runs[i]
                if node == -1:
                    r.heard(found[0] / found[1] if found[1] else math.inf)
                else:
                    n = r.growing.nodes[node]
                    n.asked = True
                    total, n.split = found
                    n.total = n.total or total
            for r in runs:
                if r.growing and r.done:
                    r.growing = None                      # its patience ended with the last tree
                if r.growing:
                    for node in r.growing.waiting():      # no row reached it
                        r.growing.nodes[node].asked = True
                while r.growing and not r.growing.waiting():
                    missing = r.growing.replay()[1]
                    r.growing.expand(missing)
                    if not missing:
                        r.finish()


def train(table: Binned, fits: list[Fit], parallelism: int | None = None) -> list[Boosted]:
    """All ``fits`` together; they share every scan of the blocks.

    Up to TASK_ROWS rows are grown where their blocks are, the models dealt out over tasks: the
    same waves without a job each. Up to FIT_BYTES of bins a task grows one model, with all rows at hand.
    More rows take a job per wave."""
    rows, width = sum(table.counts.values()), max((len(e) for e in table.edges), default=0) + 1
    features, edges = table.width, table.edges
    runs = [_Run(f, table) for f in fits]
    if TASK_ROWS < rows and rows * features <= FIT_BYTES:
        base = table.whole()
        # those with the most to do begin first
        order = sorted(range(len(fits)), key=lambda i: -fits[i].params.rounds * fits[i].params.max_leaves)

        def one(index, blocks):
            run, blocks = runs[order[index]], list(blocks)
            _grow([run], _Here(blocks, [run], width, Joint.of(blocks[0][1], edges)), features)
            yield order[index], run.trees, run.losses

        for i, trees, losses in base.ctx.union([base] * len(fits)).mapPartitionsWithIndex(one).collect():
            runs[i].trees, runs[i].losses = trees, losses
        return [r.model(edges) for r in runs]
    base = table.rdd()
    cores = parallelism or base.ctx.defaultParallelism
    if rows > TASK_ROWS or base.getNumPartitions() > 1:
        source = _Spread(base, runs, width, cores)
        _grow(runs, source, features)
        for kept in (source.rows, source.old):
            if kept is not None:
                kept.unpersist()
        return [r.model(edges) for r in runs]
    lots = max(1, min(len(fits), cores))

    def whole(index, blocks):
        mine = runs[index::lots]
        _grow(mine, _Here(list(blocks), mine, width), features)
        yield index, [(r.trees, r.losses) for r in mine]

    for index, grown in base.ctx.union([base] * lots).mapPartitionsWithIndex(whole).collect():
        for r, (r.trees, r.losses) in zip(runs[index::lots], grown):
            pass
    return [r.model(edges) for r in runs]


# --------------------------------------------------------------------------- AdaBoost

@dataclass(frozen=True)
class Stump:
    feature: int                   # -1: one leaf
    threshold: float
    left: float                    # predicted class, 0 or 1
    right: float
    weight: float


def _misses(stump: tuple, bins: np.ndarray, label: np.ndarray) -> np.ndarray:
    f, cut, left, right = stump[:4]
    said = np.where(bins[:, f] <= cut, left, right) if f >= 0 else left
    return said != label


def _training_rows(blocks, train: np.ndarray, start: float) -> Iterator[tuple]:
    """(bins, label, weight) of the rows to learn from."""
    for _, bins, label, group in blocks:
        use = np.flatnonzero(np.isin(group, train))
        yield np.asfortranarray(bins[use]), label[use], np.full(len(use), start)


def _reweighted(rows: tuple, stumps: list[tuple]) -> tuple:
    bins, label, w = rows
    w = w.copy()
    for s in stumps:
        w[_misses(s, bins, label)] *= math.exp(s[4])
    return bins, label, w


def _label_sums(parts: Iterator[tuple], width: int) -> np.ndarray:
    """(features, bins, weight of class 0 | of class 1 | rows)."""
    total = 0
    for bins, label, w in parts:
        t = tabulate(bins, label > 0, 2, np.arange(bins.shape[1]), width, w)
        total = total + np.stack([t[0, ..., 0], t[1, ..., 0], t[..., 1].sum(axis=0)], axis=-1)
    return total


def best_stump(table: np.ndarray) -> tuple[tuple, float]:
    """(feature, bin, class on the left, on the right) with the least Gini impurity, the first of equal
    ones, and its share of wrong weight; both follow from the one table."""
    left = np.cumsum(table, axis=1)
    whole = left[0, -1]
    right = whole - left

    def impurity(s):
        total = s[..., 0] + s[..., 1]
        with np.errstate(divide="ignore", invalid="ignore"):
            p = np.where(total > 0, s[..., 1] / total, 0.0)
        return total, 2 * p * (1 - p)

    (total, own), (tl, il), (tr, ir) = impurity(whole), impurity(left), impurity(right)
    gain = np.where((left[..., 2] > 0) & (right[..., 2] > 0), own - (tl * il + tr * ir) / total, 0.0)
    f, b = divmod(int(np.argmax(gain)), gain.shape[1])
    if not gain[f, b] > 0:
        says = float(whole[1] > whole[0])
        return (-1, 0, says, says), float(min(whole[0], whole[1]) / total)
    lo, hi = left[f, b], right[f, b]
    wrong = min(lo[0], lo[1]) + min(hi[0], hi[1])
    return (f, b, float(lo[1] > lo[0]), float(hi[1] > hi[0])), float(wrong / total)


def train_stumps(table: Binned, train: frozenset, rounds: int = 200, rate: float = 0.1) -> list[Stump]:
    """Discrete SAMME boosting. A round is one table of weight by (feature, bin, class); split,
    classes and error follow from it, and the rows' weights from the stumps so far."""
    base, width = table.rdd(), max((len(e) for e in table.edges), default=0) + 1
    groups = np.array(sorted(train))
    n = sum(c for (g, _), c in table.counts.items() if g in train)
    if not n:
        raise ValueError("no rows to learn from")

    def boost(sums) -> list[tuple]:
        stumps: list[tuple] = []
        for _ in range(rounds):
            stump, err = best_stump(sums(stumps))
            if err <= 0 or err >= 0.5:
                if err <= 0 or not stumps:
                    stumps.append((*stump, 1.0))
                break
            stumps.append((*stump, rate * math.log((1 - err) / err)))
        return stumps

    # a round reweighs by the stumps that the kept weights lack
    if sum(table.counts.values()) <= TASK_ROWS and base.getNumPartitions() == 1:
        def whole(blocks):
            rows, held = list(_training_rows(blocks, groups, 1.0 / n)), 0

            def sums(stumps):
                nonlocal rows, held
                rows, held = [_reweighted(r, stumps[held:]) for r in rows], len(stumps)
                return _label_sums(rows, width)

            yield boost(sums)

        found = base.mapPartitions(whole).collect()[0]
    else:
        first = base.mapPartitions(lambda blocks: _training_rows(blocks, groups, 1.0 / n)).persist(StorageLevel.MEMORY_AND_DISK)
        rows, held = first, 0

        def spread(stumps):
            nonlocal rows, held
            old = None
            if len(stumps) - held >= REFRESH:
                old, done = rows, list(stumps)
                rows, held = first.map(lambda r: _reweighted(r, done)).persist(StorageLevel.MEMORY_AND_DISK), len(stumps)
            late = stumps[held:]
            # a table per task, of features x bins, added up in a tree
            tables = rows.mapPartitions(lambda parts: [_label_sums((_reweighted(r, late) for r in parts), width)])
            total = tables.filter(lambda t: not np.isscalar(t)).treeReduce(np.add)
            if old is not None and old is not first:
                old.unpersist()
            return total

        try:
            found = boost(spread)
        finally:
            for kept in (rows, first):
                kept.unpersist()
    return [Stump(f, float(table.edges[f][b]) if f >= 0 else 0.0, lo, hi, w) for f, b, lo, hi, w in found]


# --------------------------------------------------------------------------- scoring

def block_margins(table: Binned, models: list[Boosted], names: list[str], groups: list[set] | None = None) -> DataFrame:
    """(model, group, key, label, margin) of the rows whose group is in the model's ``groups`` (all
    by default), read from the written blocks."""
    sent = table.blocks.sparkSession.sparkContext.broadcast((models, names, groups))
    width = table.width

    def run(batches: Iterator[pa.RecordBatch]):
        models, names, groups = sent.value
        for batch in batches:
            for r in batch.to_pylist():
                bins = np.frombuffer(r["bins"], np.uint8).reshape(r["n"], width)
                group = np.frombuffer(r["group"], np.int16)
                label, keys = np.frombuffer(r["label"], np.uint8), np.asarray(r["keys"], np.int64)
                for k, (m, name) in enumerate(zip(models, names)):
                    at = np.arange(r["n"]) if groups is None else np.flatnonzero(np.isin(group, sorted(groups[k])))
                    f = np.full(len(at), m.start)
                    for t in m.trees:
                        f += t.value[t.walk(bins, at)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(at), pa.string()), pa.array(group[at].astype(np.int32)), pa.array(keys[at]),
                         pa.array(label[at].astype(np.int32)), pa.array(f)],
                        names=["model", "group", "key", "label", "margin"])

    return table.blocks.mapInArrow(run, "model string, group int, key long, label int, margin double")


def thresholds(model: Boosted) -> list[Tree]:
    """The model's trees; ``cut`` as the feature value up to which rows go left."""
    out = []
    for t in model.trees:
        at = [model.edges[f][min(c, len(model.edges[f]) - 1)] if f >= 0 else math.nan for f, c in zip(t.feature, t.cut)]
        out.append(replace(t, cut=np.array(at, float)))
    return out
