"""Documents scored by masked pseudo-likelihood.

Every word is predicted from the words on both its sides by a window network without hidden layer, in numpy: words are the leaves
of a tree of three levels with ``width`` branches each, and at every level the branch is a softmax of the branch's prior and, for each
place around the word, one row of weights chosen by the neighbour, times a gain.  A document's score is the sum of the logarithms
over all its words.

1. Spark counts the distinct words; the counts stay a table.  The most frequent words (HEAD, or WIDTH times
   the root of the number of distinct words if that is more) are leaves of their own; the rarer ones share a quarter
   as many leaves by their hash, and within such a leaf a word has its share of the leaf's count, joined from the table.
   Leaves are dealt to the branches in turn by their frequency, so that frequent words are apart on every level.
2. The first level sees two neighbours on either side, each as its leaf; the second, of one branch, the next neighbours by the
   first two levels of their own place in the tree; the third, of one twig, by the first.
3. Training makes every word a target in both its passes.  The first counts (row, branch) pairs; a weight is the logarithm of how
   much more often than by chance the branch follows, drawn to 0 where that is rare.  The second sums gradient and curvature
   of the corpus' log-likelihood in the gains, which take a Newton step (the problem is concave).
4. Every word of every document is scored.

Both passes only add numbers up, so the model does not depend on how the corpus is cut into partitions.  Tasks send counts as
compressed blocks by slot, which are added up FAN at a time, so no task reads a block of every other.

The weights are broadcast; they grow with the number of leaves to the power 4/3, that is with the distinct words' to 2/3.

Null texts and texts without words have 0 words, score 0 and no mean.  Repeated rows get equal scores up to rounding.
An empty table returns no rows.  Columns besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditspark.llm.common import stored
from creditspark.llm.shingles import blocks, word_hashes
from creditspark.llm.token_alignment import _spread as spread
from creditspark.llm.token_alignment import _squeezed as squeezed

HEAD, WIDTH = 1 << 14, 16
#: Neighbours that each level sees.
PLACES = ((-2, -1, 1, 2), (-1, 1), (-1, 1))
#: Counts by which a weight is drawn to 0, and the gains before training.
SMOOTH, START = 2.0, 0.5
#: Words at a time: their logits stay in a core's cache.
STEP = 2048
#: Cells of a slot, and blocks that one task adds up.
SLOT, FAN = 1 << 17, 64


class Vocabulary:
    """Leaf of each word, and the leaves' places in the tree."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, rest: np.ndarray):
        """``words`` (sorted hashes) with their counts, and the summed counts of the leaves of rarer words."""
        n = np.concatenate([counts, rest]).astype(np.float64)
        order = np.argsort(-n, kind="stable")
        self.words, self.n_rest, self.size = words, len(rest), len(n)
        leaf = np.empty(len(n), np.int32)
        leaf[order] = np.arange(len(n))
        self.leaf, self.rest_leaf = leaf[:len(words)], leaf[len(words):]
        n = n[order]
        self.log_n = np.log(np.maximum(n, 1))
        self.kind = np.dtype(np.uint16 if len(n) < 1 << 16 else np.uint32)
        self.width = w = max(2, int(np.ceil(round(len(n) ** (1 / 3), 9))))
        r = np.arange(len(n) + 1)
        #: Of every leaf, and of the edge of a text (the last): its branch, twig, and leaf on the twig.
        self.branch, self.twig = np.append(r[:-1] % w, w).astype(np.int32), np.append(r[:-1] % (w * w), w * w).astype(np.int32)
        #: Per level: the node where the level's choice is made, and the choice.
        self.node = (np.zeros(len(n), np.int32), self.branch[:-1], self.twig[:-1])
        self.choice = (self.branch[:-1], (self.twig[:-1] // w).astype(np.int32), (r[:-1] // (w * w)).astype(np.int32))
        self.prior = []
        for level in range(3):
            sums = np.bincount(self.node[level].astype(np.int64) * w + self.choice[level], weights=np.maximum(n, 1e-9), minlength=w ** (level + 1)).astype(float).reshape(-1, w)
            total = sums.sum(axis=1, keepdims=True)
            p = np.divide(sums, total, out=np.zeros_like(sums), where=total > 0)
            self.prior.append(np.log(np.maximum(p, 1e-30)).astype(np.float32))

    def rows(self) -> tuple[int, int, int]:
        """Rows of weights for one place of each level: by leaf; by branch and neighbour's twig; by twig and neighbour's branch."""
        w = self.width
        return self.size + 1, w * (w * w + 1), w * w * (w + 1)

    def tables(self) -> list[tuple[int, int, int]]:
        """(level, place, rows) of every table of weights."""
        return [(level, p, self.rows()[level]) for level, places in enumerate(PLACES) for p in places]

    def row(self, level: int, target: np.ndarray, beside: np.ndarray) -> np.ndarray:
        """The row of weights that a neighbour chooses for the node of the target."""
        if level == 0:
            return beside
        w = self.width
        near, far = (self.branch, self.twig) if level == 1 else (self.twig, self.branch)
        return near.take(target) * ((w * w if level == 1 else w) + 1) + far.take(beside)

    def encode(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words' leaves, and whether they share them."""
        at = np.minimum(np.searchsorted(self.words, words), max(len(self.words) - 1, 0))
        rare = self.words[at] != words if len(self.words) else np.ones(len(words), bool)
        leaf = self.leaf[at] if len(self.words) else np.zeros(len(words), np.int32)
        if rare.any():
            leaf[rare] = self.rest_leaf[(words[rare] % np.uint64(self.n_rest)).astype(np.int64)]
        return leaf, rare


class Network:
    """Weights per table, and their gains."""

    def __init__(self, v: Vocabulary, counts: list[np.ndarray]):
        self.weights, self.gains = [], [np.full(len(p), START) for p in PLACES]
        for (level, _, rows), n in zip(v.tables(), counts):
            n = n.reshape(rows, v.width)
            node = np.zeros(rows, np.int64) if level == 0 else np.arange(rows) // (rows // len(v.prior[level]))
            chance = n.sum(axis=1, keepdims=True) * np.exp(v.prior[level].astype(np.float64))[node]
            self.weights.append(np.log((n + SMOOTH) / (chance + SMOOTH)).astype(np.float32))

    def whole(self, v: Vocabulary) -> list[np.ndarray]:
        """The weights times their gains, the prior added to the last table of each level: a level's sum is its logits."""
        out, at = [], 0
        for level, places in enumerate(PLACES):
            out += [self.weights[at + i] * np.float32(g) for i, g in enumerate(self.gains[level])]
            at += len(places)
            out[-1] += np.repeat(v.prior[level], len(out[-1]) // len(v.prior[level]), axis=0)
        return out

    def slopes(self, v: Vocabulary, row: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
        """Per level: log-likelihood, its gradient in the gains and minus its second derivatives, summed over the words."""
        target, first, out = row[place], 0, []
        at, one = np.arange(len(place)) * v.width, np.ones(v.width, np.float32)
        own = np.empty((len(place), v.width), np.float32)
        for level, places in enumerate(PLACES):
            seen = [self.weights[first + i].take(v.row(level, target, row[place + p]), axis=0) for i, p in enumerate(places)]
            first += len(places)
            p = v.prior[level].take(v.node[level].take(target), axis=0)
            for x, gain in zip(seen, self.gains[level]):
                p += np.multiply(x, np.float32(gain), out=own)
            chosen = at + v.choice[level].take(target)
            ll = p.ravel().take(chosen).sum(dtype=np.float64)
            total = np.exp(p, out=p) @ one
            ll -= np.log(total).sum(dtype=np.float64)
            p /= total[:, None]
            mean, square, gradient = np.empty((len(seen), len(place))), np.empty((len(seen), len(seen))), np.empty(len(seen))
            for i, x in enumerate(seen):
                np.multiply(p, x, out=own)
                mean[i] = own @ one
                gradient[i] = x.ravel().take(chosen).sum(dtype=np.float64) - mean[i].sum()
                for j in range(i + 1):
                    square[i, j] = square[j, i] = np.vdot(own, seen[j])
            out.append(np.concatenate([[ll], gradient, (square - mean @ mean.T).ravel()]))
        return out

    def improve(self, sums: list[np.ndarray]) -> None:
        """One Newton step of the gains."""
        for level, x in enumerate(sums):
            k = len(PLACES[level])
            curve = x[1 + k:].reshape(k, k)
            ridge = 1e-6 * max(float(np.trace(curve)), 1.0) * np.eye(k)
            self.gains[level] = np.clip(self.gains[level] + np.linalg.solve(curve + ridge, x[1:1 + k]), 0.0, 1.5)


def log_likelihoods(whole: list[np.ndarray], v: Vocabulary, row: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Logarithm of the probability of the leaf of each word at ``place``, by the network's whole tables."""
    target, tables = row[place], iter(whole)
    at, one, out = np.arange(len(place)) * v.width, np.ones(v.width, np.float32), np.zeros(len(place))
    for level, places in enumerate(PLACES):
        z = sum((next(tables).take(v.row(level, target, row[place + p]), axis=0) for p in places[1:]),
                next(tables).take(v.row(level, target, row[place + places[0]]), axis=0))
        out += z.ravel().take(at + v.choice[level].take(target))
        out -= np.log(np.exp(z, out=z) @ one)
    return out


def around(leaves: np.ndarray, at: np.ndarray, edge: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts' words in a row with gaps of ``edge`` between texts, and the words' places in it."""
    pad = max(PLACES[0])
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    place = np.arange(len(leaves)) + pad * (doc + 1)
    row = np.full(len(leaves) + pad * len(at), edge, np.int32)
    row[place] = leaves
    return row, place


def count_words(docs: DataFrame, most: int = 1 << 19) -> DataFrame:
    """(w, n): each distinct word's hash and how often it occurs; a task holds some ``most`` words' counts."""
    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        w, n = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(w, kind="stable")  # sorted runs are merged
        w, n = w[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]])) if len(w) else np.zeros(0, int)
        return w[first], np.add.reduceat(n, first) if len(first) else n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        out = lambda x: pa.RecordBatch.from_arrays([pa.array(x[0].view(np.int64)), pa.array(x[1], pa.int64())], ["w", "n"])
        for batch in batches:
            for b in blocks(batch, 0, 4 << 20):
                held.append(np.unique(word_hashes(b.column(0))[0], return_counts=True))
                if sum(len(w) for w, _ in held) > 2 * most:
                    held = [merged(held)]
                    if len(held[0][0]) > most:
                        yield out(held.pop())
        if held:
            yield out(merged(held))

    return docs.select("text").mapInArrow(run, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))


def vocabulary_of(counts: DataFrame) -> tuple[Vocabulary, int, int]:
    """The vocabulary, the least count of a word with its own leaf, and the number of all words."""
    by_n = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).toArrow()
    n, words = (by_n[c].to_numpy() for c in ("n", "words"))
    order = np.argsort(-n)
    n, words = n[order], words[order]
    size = max(HEAD, int(WIDTH * words.sum() ** .5))
    fits = int(np.searchsorted(np.cumsum(words), size, side="right"))
    least = int(n[fits - 1]) if fits else int(n[0]) + 1 if len(n) else 1
    head = counts.filter(F.col("n") >= least).toArrow()
    w = head["w"].to_numpy().view(np.uint64)
    order = np.argsort(w)
    n_rest = size // 4
    rest = np.zeros(n_rest if fits < len(n) else 0, np.int64)
    if len(rest):
        # the remainder of the hash as an unsigned number
        leaf = F.pmod(F.pmod("w", F.lit(n_rest)) + F.when(F.col("w") < 0, F.lit((1 << 64) % n_rest)).otherwise(F.lit(0)), F.lit(n_rest))
        sums = counts.filter(F.col("n") < least).groupBy(leaf.alias("leaf")).agg(F.sum("n").alias("n")).toArrow()
        rest[sums["leaf"].to_numpy()] = sums["n"].to_numpy()
    return Vocabulary(w[order], head["n"].to_numpy()[order], rest), least, int((n * words).sum())


def encoded(docs: DataFrame, v: Vocabulary) -> DataFrame:
    """(rid, doc_id, leaves, rare) for every row: its words' leaves, and the hashes of those that share one."""
    shared = docs.sparkSession.sparkContext.broadcast(v)
    key = docs.schema["doc_id"].simpleString().replace(":", " ", 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid, kind = TaskContext.get().partitionId() << 40, shared.value.kind
        for batch in batches:
            for b in blocks(batch, 1):
                words, at = word_hashes(b.column(1))
                leaf, rare = shared.value.encode(words)
                rares = np.concatenate([[0], np.cumsum(rare)])[at]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(rid, rid + b.num_rows)), b.column(0), _bytes(leaf.astype(kind), at),
                    pa.ListArray.from_arrays(pa.array(rares, pa.int32()), pa.array(words[rare].view(np.int64)))], ["rid", "doc_id", "leaves", "rare"])
                rid += b.num_rows

    return stored(docs.select("doc_id", "text").mapInArrow(run, f"rid long, {key}, leaves binary, rare array<long>"), "leaves")


def _bytes(numbers: np.ndarray, at: np.ndarray) -> pa.Array:
    """Runs of numbers as binary values."""
    ends = (at * numbers.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(numbers.tobytes())])


def pieces(column: pa.Array, kind: np.dtype, n: int = 1 << 20) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Rows of about ``n`` words together, with the words and where each row's begin."""
    _, ends, data = column.buffers()
    at = np.frombuffer(ends, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64) // kind.itemsize
    values = np.frombuffer(data or b"", kind, int(at[-1]) if data else 0)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + n, side="right")) - 1)
        yield slice(lo, hi), values[at[lo]:at[hi]], at[lo:hi + 1] - at[lo]
        lo = hi


COUNTS = "slot int, part int, n int, cell binary, count binary"


def _block(slot: int, part: int, dense: np.ndarray) -> pa.RecordBatch:
    cell = np.flatnonzero(dense)
    return pa.RecordBatch.from_pydict({
        "slot": pa.array([slot], pa.int32()), "part": pa.array([part], pa.int32()), "n": pa.array([len(cell)], pa.int32()),
        "cell": [squeezed(np.diff(cell, prepend=0).astype(np.int32))], "count": [squeezed(dense[cell].astype(np.int64))]})


def _dense(n: int, cell: bytes, count: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(spread(cell, np.int32, n)), spread(count, np.int64, n)


def _added(table: pa.Table) -> pa.Table:
    """The sum of one slot's blocks."""
    total = np.zeros(SLOT, np.int64)
    for r in table.to_pylist():
        cell, count = _dense(r["n"], r["cell"], r["count"])
        total[cell] += count
    return pa.Table.from_batches([_block(table["slot"][0].as_py(), table["part"][0].as_py(), total)])


def count_pairs(docs: DataFrame, v: Vocabulary) -> list[np.ndarray]:
    """How often each choice was made beside each row of weights, one array per table."""
    shared = docs.sparkSession.sparkContext.broadcast(v)
    cells = [rows * v.width for _, _, rows in v.tables()]
    first = np.cumsum([0, *[-(-c // SLOT) for c in cells]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, part = shared.value, TaskContext.get().partitionId() // FAN
        sums = [np.zeros(c, np.int64) for c in cells]
        for batch in batches:
            for _, leaf, at in pieces(batch.column(0), v.kind):
                row, place = around(leaf, at, v.size)
                target = row[place]
                for (level, p, _), total in zip(v.tables(), sums):
                    cell = v.row(level, target, row[place + p]) * np.int64(v.width)
                    cell += v.choice[level].take(target)
                    total += np.bincount(cell, minlength=len(total))
        for t, total in enumerate(sums):
            for s in range(first[t], first[t + 1]):
                if (own := total[(s - first[t]) * SLOT:(s - first[t] + 1) * SLOT]).any():
                    yield _block(s, part, own)

    found, parts = docs.select("leaves").mapInArrow(run, COUNTS), -(-docs.rdd.getNumPartitions() // FAN)
    while True:
        found = found.groupBy("slot", "part").applyInArrow(_added, COUNTS)
        if parts <= 1:
            break
        found = stored(found, "pair-counts").withColumn("part", F.expr(f"part div {FAN}").cast("int"))
        parts = -(-parts // FAN)
    out = [np.zeros((first[t + 1] - first[t]) * SLOT, np.int64) for t in range(len(cells))]
    for r in found.toLocalIterator():
        t = int(np.searchsorted(first, r["slot"], side="right")) - 1
        cell, count = _dense(r["n"], bytes(r["cell"]), bytes(r["count"]))
        out[t][(r["slot"] - first[t]) * SLOT + cell] = count
    return [x[:c] for x, c in zip(out, cells)]


def train(docs: DataFrame, v: Vocabulary) -> Network:
    """The network of the encoded documents."""
    net = Network(v, count_pairs(docs, v))
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((net, v))
    sizes = [1 + len(p) + len(p) ** 2 for p in PLACES]
    names = [f"s{i}" for i in range(sum(sizes))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, v = shared.value
        total = np.zeros(sum(sizes))
        for batch in batches:
            for _, leaf, at in pieces(batch.column(0), v.kind):
                row, place = around(leaf, at, v.size)
                for lo in range(0, len(place), STEP):
                    total += np.concatenate(net.slopes(v, row, place[lo:lo + STEP]))
        yield pa.RecordBatch.from_pydict({c: [x] for c, x in zip(names, total.tolist())})

    sums = docs.select("leaves").mapInArrow(run, ", ".join(f"{c} double" for c in names)).agg(*[F.sum(c) for c in names]).first()
    if sums[0] is not None:
        net.improve(np.split(np.array(sums, float), np.cumsum(sizes)[:-1]))
    shared.unpersist()
    return net


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, log_likelihood, mean_log_likelihood) for every row."""
    counts = stored(count_words(docs), "words")
    v, least, _ = vocabulary_of(counts)
    rows = encoded(docs, v)
    shared = docs.sparkSession.sparkContext.broadcast((train(rows, v).whole(v), v))
    key = docs.schema["doc_id"].simpleString().replace(":", " ", 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, v = shared.value
        shares = np.zeros(v.size)
        shares[v.rest_leaf] = v.log_n[v.rest_leaf]
        for batch in batches:
            for part, leaf, at in pieces(batch.column(2), v.kind):
                row, place = around(leaf, at, v.size)
                logp = -shares[leaf]
                for lo in range(0, len(place), STEP):
                    logp[lo:lo + STEP] += log_likelihoods(net, v, row, place[lo:lo + STEP])
                sums = np.concatenate([[0.0], np.cumsum(logp)])
                n = np.diff(at)
                yield pa.RecordBatch.from_arrays([batch.column(0)[part], batch.column(1)[part], pa.array(n, pa.int64()), pa.array(np.where(n > 0, sums[at[1:]] - sums[at[:-1]], 0.0))],
                                                 ["rid", "doc_id", "n_words", "leaves_ll"])

    out = rows.select("rid", "doc_id", "leaves").mapInArrow(run, f"rid long, {key}, n_words long, leaves_ll double")
    rare = rows.select("rid", F.explode("rare").alias("w")).join(counts.filter(F.col("n") < least).hint("shuffle_hash"), "w").groupBy("rid").agg(F.sum(F.log("n")).alias("rare_ll"))
    out = out.join(rare, "rid", "left").select("doc_id", "n_words", (F.col("leaves_ll") + F.coalesce("rare_ll", F.lit(0.0))).alias("log_likelihood"))
    return out.withColumn("mean_log_likelihood", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")))


def report(docs: DataFrame) -> DataFrame:
    return score(docs)
