"""Histogram trees, grown level by level: forests (ML7-ML9) and second-order boosting (ML10-ML12).

Features are binned once, by exact quantiles, into a byte matrix that is stored as blocks of rows.  A level of a tree needs only two
sums per (node, feature, bin): for a forest the weighted class-1 count and the weighted count, for boosting the gradients and
the Hessians.  Many trees of many forests (folds, settings) are grown at once:

* every task sums its rows' histograms for the trees of a batch (HIST_BYTES at most), the sums are added up by tree where the
  splits are picked too, and the driver gets the splits alone; rows are moved down by walking the tree again;
* a table of at most LOCAL_BYTES travels to the tasks whole (a counted broadcast), one of at most COPIED times as many through a
  shuffle; each task grows its own trees, with no shuffle between levels.  Cross-validation sends on sums of leaf shares, no trees.

Both ways give the same forest: weights and feature subsets are hashes of row, tree and node, and sums are whole numbers.  Boosting
adds floating-point gradients, so there the last digits depend on the order of the blocks.

Ties go to the first feature, then the lowest cut.  A row with a NULL feature is neither trained on nor scored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditspark.operators.quantiles import column_quantiles
from creditspark.session import scratch_path

BINS = 32
BLOCK_ROWS = 1 << 16
LOCAL_BYTES = 64 << 20
#: A table of so many times LOCAL_BYTES is still copied to every task, past the driver.
COPIED = 2.5
HIST_BYTES = 256 << 20
#: Rows that are walked or counted at a time, for the cache.
WALK_ROWS, COUNT_ROWS = 1 << 14, 1 << 16
#: Levels that are walked by comparing whole columns.
TOP = 4
#: Weights of class 1 are counted in the same sum as all weights, this much higher.
HIGH = 2.0 ** 26
#: Leaf shares are added up as whole numbers of this unit, so that the order does not matter; so many rows' sums travel together.
SHARE, VOTE_ROWS = 2.0 ** 40, 1 << 17
#: Held-out rows of one round that one task ranks.
RANKED_ROWS = 1 << 20
#: Boosting rounds that are ranked at a time, and rounds (or fewer) after which the blocks are written again with their margins.
KEEP, WRITE = 25, 8
#: Sums of all tasks that the driver adds up itself: a job of one stage in place of two.
SUMS_BYTES = 32 << 20


# --------------------------------------------------------------------------- rules and trees

@dataclass(frozen=True)
class Gini:
    """Decrease of Gini impurity, in rows: ``g`` counts class 1, ``h`` all."""
    least: float = 1.0
    gamma: float = 0.0

    def score(self, g, h):
        return np.divide(g * g + (h - g) * (h - g), h, out=np.zeros_like(h), where=h > 0)

    def value(self, g, h):
        return np.divide(g, h, out=np.zeros_like(h), where=h > 0)


@dataclass(frozen=True)
class Newton:
    """Decrease of the second-order loss with an L2 penalty; ``least`` bounds a child's Hessian sum, ``gamma`` the gain."""
    least: float = 2.0
    gamma: float = 5.0
    l2: float = 1.0

    def score(self, g, h):
        return g * g / (h + self.l2)

    def value(self, g, h):
        return -g / (h + self.l2)


class Tree:
    """A heap: node i has children 2i and 2i + 1; ``feature`` is -1 at a leaf.  Rows with bin <= ``cut`` go left."""

    def __init__(self, depth: int):
        n = 2 << depth
        self.depth = depth
        self.feature, self.cut = np.full(n, -1, np.int16), np.zeros(n, np.uint8)
        self.g, self.h, self.gain = np.zeros(n), np.zeros(n), np.zeros(n)
        self.value = np.zeros(n)

    def step(self, bins: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Rows one level down; rows at a leaf stay."""
        bins, out, tables = np.ascontiguousarray(bins), np.empty_like(node), _tables(self.feature, self.cut)
        for first in range(0, len(node), WALK_ROWS):
            rows = slice(first, first + WALK_ROWS)
            out[rows] = _step(*tables, bins, node[rows], first)
        return out

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        return walk(self.feature, self.cut, self.depth, bins)

    def lean(self) -> Tree:
        """What predictions need."""
        tree = Tree.__new__(Tree)
        tree.depth, tree.feature, tree.cut, tree.value = self.depth, self.feature, self.cut, self.value
        return tree

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return self.value.take(self.leaves(bins))

    def shares(self, bins: np.ndarray) -> np.ndarray:
        """Leaf shares in SHARE's units."""
        return np.rint(self.value * SHARE).astype(np.int64).take(self.leaves(bins))

    def finish(self, rule) -> Tree:
        """Take back splits below ``gamma`` whose children are leaves, from the deepest up; set the leaves' values."""
        for i in range(len(self.feature) // 2 - 1, 0, -1):
            if self.feature[i] >= 0 and self.gain[i] < rule.gamma and self.feature[2 * i] < 0 and self.feature[2 * i + 1] < 0:
                self.feature[i] = -1
        self.value = rule.value(self.g, self.h)
        return self

    def importance(self, k: int) -> np.ndarray:
        inner = self.feature >= 0
        return np.bincount(self.feature[inner], weights=self.gain[inner], minlength=k)

    def pack(self) -> bytes:
        used = np.flatnonzero((self.feature >= 0) | (self.h > 0) | (self.g != 0)).astype(np.int32)
        head = np.array([self.depth, len(used)], np.int32)
        return b"".join(x.tobytes() for x in (head, used, self.feature[used], self.cut[used], self.gain[used], self.value[used], self.g[used], self.h[used]))

    @classmethod
    def unpack(cls, data: bytes) -> Tree:
        depth, n = np.frombuffer(data, np.int32, 2).tolist()
        tree, at = cls(depth), 8
        used = np.frombuffer(data, np.int32, n, at)
        at += 4 * n
        for name in ("feature", "cut", "gain", "value", "g", "h"):
            x = getattr(tree, name)
            x[used] = np.frombuffer(data, x.dtype, n, at)
            at += x.itemsize * n
        return tree


def _tables(feature: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By node: feature and cut in one number, and the node of rows up to the cut (a leaf's own)."""
    inner, node = feature >= 0, np.arange(len(feature))
    return np.maximum(feature, 0).astype(np.int64) << 8 | np.where(inner, cut, 255), np.where(inner, 2 * node, node)


def _step(code: np.ndarray, low: np.ndarray, bins: np.ndarray, node: np.ndarray, first: int) -> np.ndarray:
    """One level down for the rows from ``first`` on that are at ``node``."""
    n = bins.shape[1]
    own = code.take(node)
    at = (own >> 8) * n
    at += np.arange(first, first + len(node))
    return low.take(node) + (np.ascontiguousarray(bins).reshape(-1).take(at) > (own & 255))


def _top(feature: np.ndarray, cut: np.ndarray, levels: int, bins: np.ndarray, node: int = 1):
    """The node that rows reach after ``levels``: one number if it is the same for all, else bytes."""
    if not levels or feature[node] < 0:
        return node
    right = (bins[feature[node]] > cut[node]).view(np.uint8)
    a, b = (_top(feature, cut, levels - 1, bins, child) for child in (2 * node, 2 * node + 1))
    if isinstance(a, int) and isinstance(b, int):
        return right * np.uint8(b - a) + np.uint8(a)
    a, b = (np.uint8(x) if isinstance(x, int) else x for x in (a, b))
    return a ^ ((a ^ b) & (np.uint8(0) - right))


def walk(feature: np.ndarray, cut: np.ndarray, depth: int, bins: np.ndarray) -> np.ndarray:
    """The node that each row reaches after ``depth`` levels."""
    bins, n = np.ascontiguousarray(bins), bins.shape[1]
    out, top, (code, low) = np.empty(n, np.int64), min(depth, TOP), _tables(feature, cut)
    for first in range(0, n, WALK_ROWS):
        rows = slice(first, min(first + WALK_ROWS, n))
        out[rows] = _top(feature, cut, top, bins[:, rows])
        for _ in range(top, depth):
            out[rows] = _step(code, low, bins, out[rows], first)
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers (SplitMix64's last steps)."""
    with np.errstate(over="ignore"):
        x = (np.asarray(x, np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


#: Distribution of a Poisson variable of mean 1: how often the bootstrap takes a row.
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 16)]))


#: The same for 64-bit hashes: of the first 53 bits, so many lie at or above each.
_LIMITS = np.array([int(x) << 11 for x in np.ceil(_POISSON * 2.0 ** 53) if x < 2.0 ** 53], np.uint64)
_FEW = 6


def bootstrap(keys: np.ndarray, seed: int) -> np.ndarray:
    own, out = mixed(np.uint64(seed)), np.zeros(len(keys), np.uint8)
    for first in range(0, len(keys), WALK_ROWS):
        w = out[first:first + WALK_ROWS]
        h = mixed(keys[first:first + WALK_ROWS] ^ own)
        for limit in _LIMITS[:_FEW]:
            w += h >= limit
        many = np.flatnonzero(w == _FEW)
        w[many] = np.searchsorted(_LIMITS, h[many], side="right")
    return out


def subset(seed: int, nodes: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which ``n`` of ``k`` features each node may split on."""
    if n >= k:
        return np.ones((len(nodes), k), bool)
    h = mixed(mixed(np.uint64(seed)) + np.asarray(nodes, np.uint64)[:, None] * np.uint64(1 << 16) + np.arange(k, dtype=np.uint64))
    return np.argsort(np.argsort(h, axis=1, kind="stable"), axis=1) < n


def sums(bins: np.ndarray, place: np.ndarray, weights: list[np.ndarray], m: int, n_bins: int) -> list[np.ndarray]:
    """(m, features, bins) sums of each of ``weights`` over the rows at places 0 to m - 1; rows at m count nowhere.  Where there are
    many rows for few places, two features are counted at once."""
    k, n = bins.shape
    out, cells = [np.zeros((m, k, n_bins)) for _ in weights], n_bins * n_bins
    for first in range(0, n, COUNT_ROWS):
        rows = slice(first, min(first + COUNT_ROWS, n))
        own, at, ws = bins[:, rows], place[rows], [w[rows] for w in weights]
        here = np.flatnonzero(at < m)
        if len(here) < .8 * len(at):
            own, at, ws = own.take(here, axis=1), at[here], [w[here] for w in ws]
        two = k // 2 * 2 if 2 * (m + 1) * cells <= len(at) else 0
        base = at * cells
        for f in range(0, two, 2):
            both = base + (own[f].astype(np.uint16) * np.uint16(n_bins) + own[f + 1])
            for x, w in zip(out, ws):
                h = np.bincount(both, weights=w, minlength=(m + 1) * cells)[:m * cells].reshape(m, n_bins, n_bins)
                x[:, f] += h.sum(axis=2)
                x[:, f + 1] += h.sum(axis=1)
        base = at * n_bins
        for f in range(two, k):
            one = base + own[f]
            for x, w in zip(out, ws):
                x[:, f] += np.bincount(one, weights=w, minlength=(m + 1) * n_bins)[:m * n_bins].reshape(m, n_bins)
    return out


def histograms(bins: np.ndarray, place: np.ndarray, g: np.ndarray, h: np.ndarray, m: int, n_bins: int) -> np.ndarray:
    """(m, features, bins, 2) sums of the rows at places 0 to m - 1."""
    return np.stack(sums(bins, place, [g, h], m, n_bins), axis=-1)


def parted(x: np.ndarray) -> np.ndarray:
    """Class-1 weights and all weights from sums of both."""
    g = np.floor(x / HIGH)
    return np.stack([g, x - g * HIGH], axis=-1)


def counted(bins: np.ndarray, place: np.ndarray, w: np.ndarray, y: np.ndarray, m: int, n_bins: int) -> np.ndarray:
    """``histograms`` of whole weights."""
    if w.sum() >= HIGH:
        return histograms(bins, place, w * y, w, m, n_bins)
    return parted(sums(bins, place, [w + w * y * HIGH], m, n_bins)[0])


def split(tree: Tree, nodes: np.ndarray, hist: np.ndarray, rule, allowed: np.ndarray) -> np.ndarray:
    """Set the best splits of ``nodes``; their children's sums follow.  Returns the children."""
    left = np.cumsum(hist, axis=2)
    total = left[:, :1, -1:, :]
    tree.g[nodes], tree.h[nodes] = total[:, 0, 0, 0], total[:, 0, 0, 1]
    left = left[:, :, :-1]
    right = total - left
    gain = rule.score(left[..., 0], left[..., 1]) + rule.score(right[..., 0], right[..., 1]) - rule.score(total[..., 0], total[..., 1])
    gain[~((left[..., 1] >= rule.least) & (right[..., 1] >= rule.least) & allowed[:, :, None])] = -np.inf
    flat = gain.reshape(len(nodes), -1)
    # rounded: equal splits of equal sums tie whatever the order of additions
    best = np.argmax(np.round(flat, 9), axis=1) if flat.shape[1] else np.zeros(len(nodes), int)
    found = flat[np.arange(len(nodes)), best] if flat.shape[1] else np.full(len(nodes), -np.inf)
    good = found > 1e-9
    i, own = np.flatnonzero(good), nodes[good]
    f, c = np.divmod(best[good], gain.shape[2])
    tree.feature[own], tree.cut[own], tree.gain[own] = f, c, found[good]
    for side, child in ((left, 2 * own), (right, 2 * own + 1)):
        tree.g[child], tree.h[child] = side[i, f, c, 0], side[i, f, c, 1]
    return np.sort(np.concatenate([2 * own, 2 * own + 1]))


def places(node: np.ndarray, active: np.ndarray, depth: int) -> np.ndarray:
    """The index in ``active`` of the rows' nodes; its length for other nodes."""
    at = np.full(2 << depth, len(active))
    at[active] = np.arange(len(active))
    return at.take(node)


# --------------------------------------------------------------------------- the byte matrix

@dataclass
class Block:
    bins: np.ndarray            # features x rows
    y: np.ndarray
    key: np.ndarray
    fold: np.ndarray
    margin: np.ndarray | None = None   # models x rows (boosting)

    @classmethod
    def of(cls, row: dict, k: int) -> Block:
        n = row["n"]
        margin = np.frombuffer(row["margin"], np.float64).reshape(-1, n) if row["margin"] else None
        return cls(np.frombuffer(row["bins"], np.uint8).reshape(k, n), np.frombuffer(row["y"], np.uint8).astype(np.float64),
                   np.frombuffer(row["key"], np.uint64), np.frombuffer(row["fold"], np.uint8), margin)

    def row(self) -> dict:
        return {"n": len(self.y), "bins": np.ascontiguousarray(self.bins).tobytes(), "y": self.y.astype(np.uint8).tobytes(), "key": self.key.tobytes(),
                "fold": self.fold.tobytes(), "margin": None if self.margin is None else self.margin.tobytes()}


def joined(blocks: list[Block]) -> Block:
    return Block(np.concatenate([b.bins for b in blocks], axis=1), *[np.concatenate([getattr(b, c) for b in blocks]) for c in ("y", "key", "fold")])


BLOCK = "n long, bins binary, y binary, key binary, fold binary, margin binary"
_ARROW = pa.schema([("n", pa.int64()), *[(c, pa.binary()) for c in ("bins", "y", "key", "fold", "margin")]])


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "uncompressed").parquet(path)  # read by every job: unpacking took longer than reading more
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH, BLOCKS = "spark.sql.execution.arrow.maxRecordsPerBatch", 4


@contextmanager
def few_blocks(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside send BLOCKS rows (blocks) at a time to Python: thousands would wait for one another in one buffer."""
    was = spark.conf.get(BATCH)
    spark.conf.set(BATCH, str(BLOCKS))
    try:
        yield
    finally:
        spark.conf.set(BATCH, was)


@dataclass
class Matrix:
    """Binned training rows: ``blocks`` on shared storage, and all of them in one broadcast where they are few."""
    blocks: DataFrame
    features: list[str]
    edges: list[np.ndarray]
    n_bins: int
    rows: int
    local: object | None = None

    @property
    def k(self) -> int:
        return len(self.features)

    def batches(self, kind: str, run: Callable[[Iterator[Block]], Iterator[dict]]) -> DataFrame:
        """``run`` over the blocks of each partition."""
        k = self.k

        def apply(batches):
            for row in run(Block.of(x, k) for b in batches for x in b.to_pylist()):
                yield pa.RecordBatch.from_pylist([row])

        return self.blocks.mapInArrow(apply, kind)

    @property
    def travels(self) -> bool:
        """Whether every task can have all rows."""
        return self.local is not None or 0 < self.rows * (self.k + 10) <= COPIED * LOCAL_BYTES

    def everywhere(self, kind: str, n: int, run: Callable[[int, Block], Iterator[dict]]) -> DataFrame:
        """``run`` in ``n`` tasks, each of which has its number and all rows, in one order."""
        spark, k, local = self.blocks.sparkSession, self.k, self.local
        columns = ["n", "bins", "y", "key", "fold"]

        def broadcast(batches):
            for b in batches:
                for i in b.column(0).to_pylist():
                    yield from (pa.RecordBatch.from_pylist([x]) for x in run(i, local.value))

        def copied(batches):
            held, number = [], None
            for b in batches:
                number = b.column(0)[0].as_py() if b.num_rows else number
                held += [Block.of({"n": n.as_py(), "margin": None, **{c: x.as_buffer() for c, x in zip(columns[1:], own)}}, k) for n, *own in zip(*b.columns[1:])]
            whole = joined(sorted(held, key=lambda b: (b.key.tobytes(), b.bins.tobytes())))
            held.clear()
            yield from (pa.RecordBatch.from_pylist([x]) for x in run(number, whole))

        if local is not None:
            return spark.range(0, n, 1, n).mapInArrow(broadcast, kind)
        # of the numbers that hash to a partition one is taken, so that each gets one copy
        copies = spark.range(64 * n).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("number")).agg(F.min("id").alias("copy"))
        return self.blocks.crossJoin(F.broadcast(copies)).repartition(n, "copy").select("number", *columns).mapInArrow(copied, kind)


def binned(df: DataFrame, features: list[str], label: str, key: str, fold=None, n_bins: int = BINS, edges: list | None = None) -> Matrix:
    """Bin ``features`` by quantiles (or by given inner ``edges``: a value up to the first is in bin 0)."""
    if not features:
        raise ValueError("no features")
    if n_bins > 256:
        raise ValueError("a bin is a byte: at most 256")
    spark = df.sparkSession
    df = df.dropna(subset=[*features, label])
    if edges is None:
        cuts = column_quantiles(df, features, [i / n_bins for i in range(1, n_bins)])
        edges = [np.unique([x for x in cuts[f] if x is not None]) for f in features]
    edges = [np.asarray(e, float) for e in edges]
    n_bins = max(2, *[len(e) + 1 for e in edges])
    rows = df.select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)], F.col(label).cast("int").alias("y"),
                     F.xxhash64(key, *features).alias("key"), (F.lit(0) if fold is None else fold).cast("int").alias("fold"))
    k = len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block():
            t = pa.Table.from_batches(held)
            bins = np.stack([np.searchsorted(e, t.column(i).to_numpy(), side="left") for i, e in enumerate(edges)]).astype(np.uint8)
            b = Block(bins, t.column(k).to_numpy(), t.column(k + 1).to_numpy().view(np.uint64), t.column(k + 2).to_numpy().astype(np.uint8))
            return pa.RecordBatch.from_pylist([b.row()], schema=_ARROW)

        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= BLOCK_ROWS:
                yield block()
                held.clear()
        if sum(x.num_rows for x in held):
            yield block()

    # as many files as cores, so that a pass is one round of tasks of like size
    blocks = _stored(rows.mapInArrow(run, BLOCK).repartition(spark.sparkContext.defaultParallelism), "binned")
    n = blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    m = Matrix(blocks, list(features), edges, n_bins, n)
    if n and n * (k + 10) <= LOCAL_BYTES:
        # one order, whatever the partitions
        whole = joined([Block.of(x, k) for x in blocks.toArrow().to_pylist()])
        order = np.argsort(whole.key, kind="stable")
        m.local = spark.sparkContext.broadcast(Block(np.ascontiguousarray(whole.bins[:, order]), whole.y[order], whole.key[order], whole.fold[order]))
    return m


# --------------------------------------------------------------------------- forests

@dataclass(frozen=True)
class Plan:
    """One tree: of which forest, its hash seed, features per node, and the fold that it must not see (-1: none)."""
    forest: int
    seed: int
    mtry: int
    fold: int = -1
    sample: bool = True


def _weights(b: Block, plan: Plan) -> np.ndarray:
    w = bootstrap(b.key, plan.seed) if plan.sample else np.ones(len(b.y), np.uint8)
    return w * (b.fold != plan.fold) if plan.fold >= 0 else w


def _impure(tree: Tree, nodes: np.ndarray) -> np.ndarray:
    return nodes[(tree.g[nodes] != 0) & (tree.g[nodes] != tree.h[nodes])]


def _grow_here(b: Block, plans: list[Plan], rule, depth: int, n_bins: int) -> list[Tree]:
    """Whole trees of one seed and fold from one block.  ``first`` has the first tree with the same path to a node: it alone keeps and
    counts that node's rows.  Of two children only the smaller is counted, the other is what remains of the parent."""
    k, trees, w = len(b.bins), [Tree(depth) for _ in plans], _weights(b, plans[0])
    rows = np.flatnonzero(w != 0)
    w, y = w[rows].astype(float), b.y[rows]
    one = w.sum() < HIGH  # both classes in one sum
    rows = (b.bins.take(rows, axis=1), *((w + w * y * HIGH,) if one else (w * y, w)), np.ones(len(rows), np.int64))
    held, first = [rows, *[None] * (len(plans) - 1)], np.zeros((len(plans), 2 << depth), int)

    def count(rows: tuple, place: np.ndarray, m: int) -> np.ndarray:
        got = sums(rows[0], place, list(rows[1:-1]), m, n_bins)
        return parted(got[0]) if one else np.stack(got, axis=-1)

    active, hists = [np.array([1])] * len(plans), [count(rows, rows[-1] - 1, 1)] * len(plans)
    for level in range(depth):
        kids = [_impure(tree, split(tree, own, hist, rule, subset(plan.seed, own, k, plan.mtry))) if len(own) else own for tree, plan, own, hist in zip(trees, plans, active, hists)]
        if level == depth - 1 or not any(map(len, kids)):
            break
        new_held, new_hists = [], []
        for v, tree in enumerate(trees):
            parents = np.unique(kids[v] // 2)
            of, owner = first[v, parents], np.full(len(parents), v)
            for r in range(v - 1, -1, -1):
                owner[(first[r, parents] == of) & (trees[r].feature[parents] == tree.feature[parents]) & (trees[r].cut[parents] == tree.cut[parents])] = r
            own, parts = parents[owner == v], []
            for r in np.unique(of[owner == v]):
                live = np.zeros(2 << depth, bool)
                live[own[of[owner == v] == r]] = True
                at = np.flatnonzero(live.take(held[r][-1]))
                parts.append(held[r] if r == v and len(at) >= .8 * len(held[r][-1]) else (held[r][0].take(at, axis=1), *[x[at] for x in held[r][1:]]))
            hist = np.zeros((len(kids[v]), k, n_bins, 2))
            if len(own):
                bins, *ws, node = parts[0] if len(parts) == 1 else [np.concatenate(x, axis=-1) for x in zip(*parts)]
                rows = (bins, *ws, tree.step(bins, node))
                less = 2 * own + (tree.h[2 * own] > tree.h[2 * own + 1])
                counts = count(rows, places(rows[-1], less, depth), len(less))
                to = np.flatnonzero(np.isin(kids[v] // 2, own))
                at, whole = np.searchsorted(own, kids[v][to] // 2), np.searchsorted(active[v], kids[v][to] // 2)
                hist[to] = np.where((kids[v][to] == less[at])[:, None, None, None], counts[at], hists[v][whole] - counts[at])
            for r in np.unique(owner[owner != v]):
                to = np.flatnonzero(np.isin(kids[v] // 2, parents[owner == r]))
                hist[to] = new_hists[r][np.searchsorted(kids[r], kids[v][to])]
            first[v, 2 * parents] = first[v, 2 * parents + 1] = owner
            new_held.append(rows if len(own) else None)
            new_hists.append(hist)
        held, hists, active = new_held, new_hists, kids
    return [tree.finish(rule) for tree in trees]


def _added(spark_df: DataFrame, shape: str) -> dict[int, np.ndarray]:
    """Sum the ``hist`` arrays (binary doubles) by ``tree``."""
    def add(t: pa.Table) -> pa.Table:
        total = None
        for x in t["hist"]:
            own = np.frombuffer(x.as_buffer())
            total = own.copy() if total is None else np.add(total, own, out=total)
        return pa.table({"tree": pa.array([t["tree"][0].as_py()], pa.int64()), "hist": pa.array([total.tobytes()], pa.binary())})

    got = spark_df.groupBy("tree").applyInArrow(add, shape).toArrow()
    return {t: np.frombuffer(h) for t, h in zip(got["tree"].to_pylist(), got["hist"].to_pylist())}


HIST = "tree long, hist binary"


SPLITS = "tree long, node binary, feature binary, cut binary, gain binary, sums binary"


def _small(x: np.ndarray) -> np.ndarray:
    """Whole numbers in as few bytes as the greatest needs."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def _grow_spread(m: Matrix, plans: list[Plan], rule, depth: int) -> list[Tree]:
    """The trees of a batch, one job per level (more where a level's histograms are many)."""
    spark, k, n_bins = m.blocks.sparkSession, m.k, m.n_bins
    trees = [Tree(depth) for _ in plans]
    active = {t: np.array([1]) for t in range(len(plans))} if m.rows else {}
    for level in range(depth):
        # trees of one seed side by side: their rows are drawn once
        todo, nxt = sorted(active, key=lambda t: (plans[t].seed, t)), {}
        while todo:
            take, total = [], 0
            while len(take) < len(todo) and (not take or total + len(active[todo[len(take)]]) * k * n_bins * 16 <= HIST_BYTES):
                total += len(active[todo[len(take)]]) * k * n_bins * 16
                take.append(todo[len(take)])
            todo = todo[len(take):]
            shared = spark.sparkContext.broadcast({t: (trees[t].feature, trees[t].cut, active[t], plans[t]) for t in take})

            def run(blocks: Iterator[Block], shared=shared, level=level) -> Iterator[dict]:
                def out():
                    for t in list(total):
                        yield {"tree": t, "hist": _small(parted(total.pop(t))).tobytes()}

                total, weight = {}, 0
                for b in blocks:
                    if weight + 16 * len(b.y) >= HIGH:
                        yield from out()
                        weight = 0
                    weight += 16 * len(b.y)
                    drawn, unit = None, 1 + HIGH * b.y
                    for t, (feature, cut, nodes, plan) in shared.value.items():
                        if drawn != (plan.seed, plan.sample):
                            drawn, w = (plan.seed, plan.sample), _weights(b, replace(plan, fold=-1))
                            rows = np.flatnonzero(w != 0)
                            bins, fold, w = b.bins.take(rows, axis=1), b.fold[rows], w.take(rows) * unit.take(rows)
                        place = places(walk(feature, cut, level, bins), nodes, depth)
                        if plan.fold >= 0:
                            place[fold == plan.fold] = len(nodes)
                        own = sums(bins, place, [w], len(nodes), n_bins)[0]
                        total[t] = np.add(total[t], own, out=total[t]) if t in total else own
                yield from out()

            def picked(table: pa.Table) -> pa.Table:
                t = table["tree"][0].as_py()
                _, _, nodes, plan = shared.value[t]
                shape, hist = (len(nodes), k, n_bins, 2), 0
                for x in table["hist"]:
                    data = x.as_buffer()
                    hist = hist + np.frombuffer(data, f"u{data.size // int(np.prod(shape))}").reshape(shape).astype(float)
                tree = Tree(depth)
                split(tree, nodes, hist, rule, subset(plan.seed, nodes, k, plan.mtry))
                own = nodes[tree.feature[nodes] >= 0].astype(np.int32)
                sent = np.concatenate([[tree.g[nodes[0]], tree.h[nodes[0]]], tree.g[2 * own], tree.h[2 * own]])
                return pa.table({"tree": pa.array([t], pa.int64()), **{c: pa.array([x.tobytes()], pa.binary()) for c, x in (
                    ("node", own), ("feature", tree.feature[own]), ("cut", tree.cut[own]), ("gain", tree.gain[own]), ("sums", sent))}})

            for r in m.batches(HIST, run).groupBy("tree").applyInArrow(picked, SPLITS).toArrow().to_pylist():
                t, tree = r["tree"], trees[r["tree"]]
                own, sent = np.frombuffer(r["node"], np.int32), np.frombuffer(r["sums"])
                tree.feature[own], tree.cut[own], tree.gain[own] = np.frombuffer(r["feature"], np.int16), np.frombuffer(r["cut"], np.uint8), np.frombuffer(r["gain"])
                if level == 0:
                    tree.g[1], tree.h[1] = sent[:2]
                for x, left in ((tree.g, sent[2:2 + len(own)]), (tree.h, sent[2 + len(own):])):
                    x[2 * own], x[2 * own + 1] = left, x[own] - left
                kids = _impure(tree, np.sort(np.concatenate([2 * own, 2 * own + 1])))
                if len(kids):
                    nxt[t] = kids
            shared.unpersist()
        active = nxt
        if not active:
            break
    return [t.finish(rule) for t in trees]


@dataclass
class Forest:
    trees: list[Tree]
    features: list[str]
    edges: list[np.ndarray] = field(default_factory=list)
    scale: float = 1.0
    logistic: bool = False

    def raw(self, bins: np.ndarray) -> np.ndarray:
        total = np.zeros(bins.shape[1])
        for t in self.trees:
            total += t.predict(bins)
        return total * self.scale if self.logistic else total / max(len(self.trees), 1)

    def lean(self) -> Forest:
        return replace(self, trees=[t.lean() for t in self.trees])

    def probability(self, bins: np.ndarray) -> np.ndarray:
        raw = self.raw(bins)
        return 1 / (1 + np.exp(-raw)) if self.logistic else raw

    def importance(self) -> np.ndarray:
        """Summed impurity decrease, each tree's over its sum."""
        k, total = len(self.features), np.zeros(len(self.features))
        for t in self.trees:
            own = t.importance(k)
            total += own / own.sum() if own.sum() and not self.logistic else own
        return total / total.sum() if total.sum() else total

    def score(self, df: DataFrame, key: str, out: str = "prob") -> DataFrame:
        """(key, probability of class 1) of the rows without NULL features."""
        rows = df.dropna(subset=self.features).select(key, *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(self.features)])
        model = df.sparkSession.sparkContext.broadcast(self.lean())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            f = model.value
            for b in batches:
                bins = np.stack([np.searchsorted(e, b.column(i + 1).to_numpy(), side="left") for i, e in enumerate(f.edges)]).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(f.probability(bins))], [key, out])

        return rows.mapInArrow(run, f"{df.schema[key].simpleString().replace(':', ' ', 1)}, {out} double")


def _dealt(m: Matrix, plans: list[Plan]) -> tuple[int, Callable[[int], list[list[int]]]]:
    """Number of tasks, and the trees of each: by fold, those of one seed (and so of the same rows) together."""
    found: dict[tuple, list[int]] = {}
    for i, p in sorted(enumerate(plans), key=lambda t: (t[1].fold, t[1].seed, t[0])):
        found.setdefault((p.fold, p.seed, p.sample), []).append(i)
    units, cores = list(found.values()), m.blocks.sparkSession.sparkContext.defaultParallelism
    n = max(1, min(len(units), cores if m.local is None else 4 * cores))
    return n, lambda i: units[i * len(units) // n:(i + 1) * len(units) // n]


def grow(m: Matrix, plans: list[Plan], rule=Gini(), depth: int = 10) -> dict[int, Forest]:
    """The forests of ``plans``."""
    if m.travels:
        n_bins, (n, of) = m.n_bins, _dealt(m, plans)

        def run(i: int, b: Block) -> Iterator[dict]:
            for own in of(i):
                for t, tree in zip(own, _grow_here(b, [plans[t] for t in own], rule, depth, n_bins)):
                    yield {"tree": t, "data": tree.pack()}

        got = m.everywhere("tree long, data binary", n, run).toArrow()
        own = {t: Tree.unpack(x) for t, x in zip(got["tree"].to_pylist(), got["data"].to_pylist())}
        trees = [own[i] for i in range(len(plans))]
    else:
        with few_blocks(m.blocks.sparkSession):
            trees = _grow_spread(m, plans, rule, depth)
    out: dict[int, Forest] = {}
    for plan, tree in zip(plans, trees):
        out.setdefault(plan.forest, Forest([], m.features, m.edges)).trees.append(tree)
    return out


def forest(m: Matrix, n_trees: int, mtry: int, seed: int = 100, depth: int = 10) -> Forest:
    return grow(m, [Plan(0, seed * 1_000_003 + t, mtry) for t in range(n_trees)], depth=depth)[0]


def forest_cv(m: Matrix, mtrys: list[int], n_trees: int, folds: int, seed: int = 100, depth: int = 10) -> list[tuple[int, float, float]]:
    """(mtry, accuracy, kappa), the means over the folds.  No more than one forest's trees are held at a time, and none where all
    rows travel to the tasks: these add up their trees' shares for the held-out rows."""
    plans = [Plan(s * folds + f, seed * 1_000_003 + t, mtry, f) for s, mtry in enumerate(mtrys) for f in range(folds) for t in range(n_trees)]
    cols = ("tn", "fn", "fp", "tp")
    kind = "forest long, " + ", ".join(f"{c} long" for c in cols)

    def confusion(i: int, votes: np.ndarray, y: np.ndarray) -> dict:
        counts = np.bincount(2 * (2 * votes >= n_trees * SHARE) + y.astype(int), minlength=4)
        return {"forest": i, **dict(zip(cols, counts.tolist()))}

    counts = {}
    if m.travels:
        n_bins, (n, of) = m.n_bins, _dealt(m, plans)

        def run(i: int, b: Block) -> Iterator[dict]:
            def out():
                for forest, x in votes.items():
                    for part, first in enumerate(range(0, len(x), VOTE_ROWS)):
                        yield {"forest": forest, "part": part, "votes": x[first:first + VOTE_ROWS].tobytes(), "y": y[first:first + VOTE_ROWS].tobytes()}

            fold, votes = None, {}
            for own in of(i):
                if fold != plans[own[0]].fold:
                    yield from out()
                    fold, votes = plans[own[0]].fold, {}
                    rows = np.flatnonzero(b.fold == fold)
                    bins, y = b.bins.take(rows, axis=1), b.y[rows].astype(np.uint8)
                for t, tree in zip(own, _grow_here(b, [plans[t] for t in own], Gini(), depth, n_bins)):
                    votes[plans[t].forest] = votes.get(plans[t].forest, 0) + tree.shares(bins)
            yield from out()

        def added(t: pa.Table) -> pa.Table:
            votes = sum(np.frombuffer(x.as_buffer(), np.int64) for x in t["votes"])
            return pa.Table.from_pylist([confusion(t["forest"][0].as_py(), votes, np.frombuffer(t["y"][0].as_buffer(), np.uint8))])

        found = m.everywhere("forest long, part long, votes binary, y binary", n, run).groupBy("forest", "part").applyInArrow(added, kind)
        counts = {r["forest"]: [r[c] for c in cols] for r in found.groupBy("forest").agg(*[F.sum(c).alias(c) for c in cols]).collect()}
    else:
        for i in range(len(mtrys) * folds):
            shared = m.blocks.sparkSession.sparkContext.broadcast(grow(m, [p for p in plans if p.forest == i], depth=depth)[i].lean())

            def held(blocks: Iterator[Block], i=i, shared=shared) -> Iterator[dict]:
                for b in blocks:
                    rows = np.flatnonzero(b.fold == i % folds)
                    bins = b.bins.take(rows, axis=1)
                    yield confusion(i, sum(t.shares(bins) for t in shared.value.trees), b.y[rows])

            r = m.batches(kind, held).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols]).first()
            counts[i] = [r[c] for c in cols]
            shared.unpersist()
    rows = []
    for s, mtry in enumerate(mtrys):
        own = [counts[s * folds + f] for f in range(folds) if s * folds + f in counts and sum(counts[s * folds + f])]
        rows.append((mtry, float(np.mean([(c[0] + c[3]) / sum(c) for c in own])), float(np.mean([kappa(*c) for c in own]))))
    return rows


def kappa(tn: int, fn: int, fp: int, tp: int) -> float:
    """Cohen's kappa of a 2 x 2 confusion matrix (same formula as ``evaluate.confusion``)."""
    n = float(tn + fn + fp + tp)
    if n == 0:
        return 0.0
    po = (tn + tp) / n
    pe = ((tn + fn) * (tn + fp) + (fp + tp) * (fn + tp)) / (n * n)
    return (po - pe) / (1.0 - pe) if pe != 1.0 else 0.0


# --------------------------------------------------------------------------- boosting

@dataclass(frozen=True)
class Boost:
    """Published settings' names: step (eta), depth, share of features per tree, and the rule's gamma and child weight."""
    rounds: int = 193
    step: float = 0.7
    depth: int = 3
    colsample: float = 0.933
    rule: Newton = Newton()
    seed: int = 100

    def features(self, t: int, k: int) -> np.ndarray:
        """One subset for all nodes of a tree."""
        return subset(self.seed * 7_919 + t, np.array([1]), k, max(1, int(self.colsample * k)))


def _gradients(b: Block, margin: np.ndarray, fold: int) -> tuple[np.ndarray, np.ndarray]:
    p = 1 / (1 + np.exp(-margin))
    seen = (b.fold != fold).astype(float)
    return (p - b.y) * seen, p * (1 - p) * seen


def _boost_here(b: Block, s: Boost, fold: int, n_bins: int) -> tuple[list[Tree], list[float], list[float]]:
    """All rounds on one block; for every round the log-loss and AUC of the rows of ``fold``."""
    margin, trees, losses, aucs = np.zeros(len(b.y)), [], [], []
    held = b.fold == fold
    train = np.flatnonzero(~held)
    seen = Block(b.bins.take(train, axis=1), b.y[train], b.key[train], b.fold[train])
    for t in range(s.rounds):
        g, h = _gradients(seen, margin[train], fold)
        tree, node, active = Tree(s.depth), np.ones(len(seen.y), np.int64), np.array([1])
        allowed = s.features(t, len(b.bins))
        for _ in range(s.depth):
            hist = histograms(seen.bins, places(node, active, s.depth), g, h, len(active), n_bins)
            active = split(tree, active, hist, s.rule, np.repeat(allowed, len(active), axis=0))
            if not len(active):
                break
            node = tree.step(seen.bins, node)
        trees.append(tree.finish(s.rule))
        margin += s.step * tree.predict(b.bins)
        if held.any():
            losses.append(log_loss(margin[held], b.y[held]))
            aucs.append(rank_auc(margin[held], b.y[held]))
    return trees, losses, aucs


def log_loss(margin: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, margin) - y * margin))


def rank_auc(score: np.ndarray, y: np.ndarray) -> float:
    """Area under the curve; ties count half."""
    value, at, n = np.unique(score, return_inverse=True, return_counts=True)
    rank = (np.cumsum(n) - (n - 1) / 2)[at]
    pos = float(y.sum())
    neg = len(y) - pos
    return float((rank[y > 0].sum() - pos * (pos + 1) / 2) / (pos * neg)) if pos and neg else float("nan")


def _boost_spread(m: Matrix, s: Boost, folds: list[int]) -> list[list[Tree]]:
    """All rounds of all models, one job per round and level."""
    n_models = len(folds)
    if not m.rows:
        return [[Tree(s.depth).finish(s.rule) for _ in range(s.rounds)] for _ in folds]

    def with_margins(blocks_of: Matrix, trees: list[list[Tree]]) -> Matrix:
        shared = m.blocks.sparkSession.sparkContext.broadcast([[x.lean() for x in own] for own in trees])

        def run(blocks: Iterator[Block]) -> Iterator[dict]:
            for b in blocks:
                yield replace(b, margin=np.stack(margins(b, shared.value)), key=b.key[:0]).row()

        return Matrix(_stored(blocks_of.batches(BLOCK, run), "margins"), m.features, m.edges, m.n_bins, m.rows)

    def margins(b: Block, trees: list[list[Tree]]) -> list[np.ndarray]:
        """Stored margins and what the trees add."""
        out = np.zeros((n_models, len(b.y))) if b.margin is None else b.margin
        return [x + s.step * sum((t.predict(b.bins) for t in own), np.zeros(len(b.y))) if own else x for x, own in zip(out, trees)]

    parts = m.blocks.rdd.getNumPartitions()
    done: list[list[Tree]] = [[] for _ in folds]
    fresh: list[list[Tree]] = [[] for _ in folds]
    data = with_margins(m, fresh)
    for t in range(s.rounds):
        if len(fresh[0]) == min(KEEP, WRITE):
            data, fresh = with_margins(data, fresh), [[] for _ in folds]
        trees, active = [Tree(s.depth) for _ in folds], {i: np.array([1]) for i in range(n_models)}
        allowed = s.features(t, m.k)
        for level in range(s.depth):
            shared = m.blocks.sparkSession.sparkContext.broadcast(([x.lean() for x in trees], active, [[x.lean() for x in own] for own in fresh]))

            def run(blocks: Iterator[Block], n_bins=m.n_bins, shared=shared, level=level) -> Iterator[dict]:
                (trees, active, fresh), total = shared.value, {}
                for b in blocks:
                    now = margins(b, fresh)
                    for i, nodes in active.items():
                        g, h = _gradients(b, now[i], folds[i])
                        place = places(walk(trees[i].feature, trees[i].cut, level, b.bins), nodes, s.depth)
                        if folds[i] >= 0:
                            place[b.fold == folds[i]] = len(nodes)
                        total[i] = total.get(i, 0) + histograms(b.bins, place, g, h, len(nodes), n_bins)
                for i, x in total.items():
                    yield {"tree": i, "hist": x.tobytes()}

            sent, shapes = data.batches(HIST, run), {i: (len(nodes), m.k, m.n_bins, 2) for i, nodes in active.items()}
            if parts * sum(16 * math.prod(x[:3]) for x in shapes.values()) <= SUMS_BYTES:
                found = {i: np.zeros(x) for i, x in shapes.items()}
                for r in sent.collect():
                    found[r["tree"]] += np.frombuffer(r["hist"]).reshape(shapes[r["tree"]])
            else:
                found = {i: x.reshape(shapes[i]) for i, x in _added(sent, HIST).items()}
            shared.unpersist()
            kids = {i: split(trees[i], nodes, found[i], s.rule, np.repeat(allowed, len(nodes), axis=0)) for i, nodes in active.items()}
            active = {i: x for i, x in kids.items() if len(x)}
            if not active:
                break
        for i, tree in enumerate(trees):
            tree.finish(s.rule)
            done[i].append(tree)
            fresh[i].append(tree)
    return done


def boost(m: Matrix, s: Boost = Boost(), folds: list[int] | None = None) -> list[Forest]:
    """One model per fold that is left out (-1: none)."""
    folds = [-1] if folds is None else folds
    if m.local is not None or m.travels and len(folds) > 1:  # a single model is quicker over many tasks
        trees = [x for x, _, _ in _boosted_locally(m, s, folds)]
    else:
        with few_blocks(m.blocks.sparkSession):
            trees = _boost_spread(m, s, folds)
    return [Forest(t, m.features, m.edges, s.step, True) for t in trees]


def _boosted_locally(m: Matrix, s: Boost, folds: list[int]) -> list[tuple]:
    n_bins = m.n_bins

    def run(i: int, b: Block) -> Iterator[dict]:
        trees, losses, aucs = _boost_here(b, s, folds[i], n_bins)
        yield {"model": i, "trees": [t.pack() for t in trees], "losses": losses, "aucs": aucs}

    got = m.everywhere("model long, trees array<binary>, losses array<double>, aucs array<double>", len(folds), run).collect()
    return [([Tree.unpack(bytes(x)) for x in r["trees"]], r["losses"], r["aucs"]) for r in sorted(got, key=lambda r: r["model"])]


def boost_cv(m: Matrix, s: Boost, folds: int) -> tuple[list[tuple], int]:
    """([(round, mean and sd of log-loss, mean and sd of AUC)], best round by mean AUC) over the folds."""
    if m.travels:
        got = _boosted_locally(m, s, list(range(folds)))
        losses, aucs = np.array([x[1] for x in got if x[1]]), np.array([x[2] for x in got if x[1]])
    else:
        with few_blocks(m.blocks.sparkSession):
            models = _boost_spread(m, s, list(range(folds)))
        losses, aucs = _spread_metrics(m, s, models)
    aucs = aucs[~np.isnan(aucs).all(axis=1)]  # a fold of one class has no AUC
    mean, sd = (aucs.mean(axis=0), aucs.std(axis=0)) if len(aucs) else (np.full(s.rounds, np.nan),) * 2
    rows = [(i + 1, float(losses[:, i].mean()), float(losses[:, i].std()), float(mean[i]), float(sd[i])) for i in range(losses.shape[1])]
    return rows, int(np.argmax(mean)) + 1 if len(aucs) else int(np.argmin(losses.mean(axis=0))) + 1


METRIC = "fold long, round long, part long, loss double, neg binary, pos binary"


def _spread_metrics(m: Matrix, s: Boost, models: list[list[Tree]]) -> tuple[np.ndarray, np.ndarray]:
    """Log-loss and AUC of every fold after every round.  A round's margins are cut into ranges that one task each can sort; pairs
    within a range are counted there, pairs of two ranges by the ranges' counts.  KEEP rounds are done at a time."""
    spark, n_folds = m.blocks.sparkSession, len(models)
    parts = -(-m.rows // n_folds // RANKED_ROWS) if m.rows else 1
    losses, aucs = np.full((n_folds, s.rounds), np.nan), np.full((n_folds, s.rounds), np.nan)
    for first in range(0, s.rounds, KEEP):
        last = min(first + KEEP, s.rounds)
        shared = spark.sparkContext.broadcast([[t.lean() for t in own[:last]] for own in models])

        def held(b: Block, shared=shared, first=first) -> Iterator[tuple]:
            for f, trees in enumerate(shared.value):
                rows = np.flatnonzero(b.fold == f)
                if not len(rows):
                    continue
                bins, margin = b.bins.take(rows, axis=1), np.zeros(len(rows))
                for t, tree in enumerate(trees):
                    margin = margin + s.step * tree.predict(bins)
                    if t >= first:
                        yield f, t, margin, b.y[rows] > 0

        edges = {}
        if parts > 1:  # any edges give the same result: some rows' quantiles give ranges of like size
            def some(blocks: Iterator[Block], held=held) -> Iterator[dict]:
                for b in blocks:
                    for f, t, margin, _ in held(b):
                        yield {"fold": f, "round": t, "edges": np.unique(np.quantile(margin, np.arange(1, parts) / parts)).tolist()}

            one = Matrix(m.blocks.limit(1), m.features, m.edges, m.n_bins, m.rows)
            edges = {(r["fold"], r["round"]): np.array(r["edges"]) for r in one.batches("fold long, round long, edges array<double>", some).collect()}

        def run(blocks: Iterator[Block], held=held, edges=edges) -> Iterator[dict]:
            for b in blocks:
                for f, t, margin, y in held(b):
                    part = np.searchsorted(edges.get((f, t), np.zeros(0)), margin, side="left")
                    loss = np.log1p(np.exp(-np.abs(margin))) + np.maximum(margin, 0.0) - y * margin
                    for p in np.unique(part):
                        at = part == p
                        yield {"fold": f, "round": t, "part": int(p), "loss": float(loss[at].sum()), "neg": margin[at & ~y].tobytes(), "pos": margin[at & y].tobytes()}

        def ranked(table: pa.Table) -> pa.Table:
            neg, pos = (np.sort(np.concatenate([np.frombuffer(x.as_buffer()) for x in table[c]])) for c in ("neg", "pos"))
            won = int(np.searchsorted(neg, pos, side="left").sum() + np.searchsorted(neg, pos, side="right").sum())
            return pa.table({**{c: table[c].slice(0, 1).cast(pa.int64()) for c in ("fold", "round", "part")}, "loss": pa.array([sum(table["loss"].to_pylist())], pa.float64()),
                             "n_neg": pa.array([len(neg)], pa.int64()), "n_pos": pa.array([len(pos)], pa.int64()), "twice": pa.array([won], pa.int64())})

        found = m.batches(METRIC, run).groupBy("fold", "round", "part").applyInArrow(ranked, "fold long, round long, part long, loss double, n_neg long, n_pos long, twice long")
        by: dict[tuple, list] = {}
        for r in sorted(found.collect(), key=lambda r: (r["fold"], r["round"], r["part"])):
            by.setdefault((r["fold"], r["round"]), []).append(r)
        for (f, t), own in by.items():
            neg = twice = 0
            for r in own:
                twice += r["twice"] + 2 * neg * r["n_pos"]
                neg += r["n_neg"]
            pos = sum(r["n_pos"] for r in own)
            losses[f, t] = sum(r["loss"] for r in own) / (neg + pos)
            if neg and pos:
                aucs[f, t] = twice / (2 * neg * pos)
        shared.unpersist()
    there = ~np.isnan(losses).all(axis=1)
    return losses[there], aucs[there]


def importance_table(spark: SparkSession, model: Forest) -> DataFrame:
    """ML9/ML12: normalised importances, ranked."""
    rows = sorted(((f, float(v)) for f, v in zip(model.features, model.importance())), key=lambda t: (-t[1], t[0]))
    return spark.createDataFrame([(i + 1, f, v) for i, (f, v) in enumerate(rows)], "rank int, feature string, importance double")
