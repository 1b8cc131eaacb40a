"""Near duplicates by an inverted join of minhash signature coordinates.

Two documents link when ``100 * |A and B| >= percent * |A or B|`` over their sets of distinct word shingles.

1. Signatures.  A set's signature holds, for each of COORDINATES hash functions, the least hash of its shingles; two
   sets agree in a coordinate with the probability of their similarity.  Equal sets (by a 128-bit digest) are
   one vertex; copies need no join.
2. Threshold.  A pair must agree in at least ``threshold(percent)`` coordinates, the most for which a pair at the
   very limit of similarity falls short with a probability below LOSS.  Pairs above the limit fall short less often.
3. Postings.  Every vertex is posted under each (coordinate, value) pair.  A pair that one vertex alone has can not
   collide, so a vertex with fewer recurring pairs than the threshold links with nothing.
4. Prefix.  Of its c recurring pairs, rarest first, a vertex is listed under the first c - threshold + 1: two
   vertices that agree in enough coordinates share one of these.
   Pairs of one list go on if their sizes, and the parities of their shingles by hash bits, let them be so similar.
5. Skip.  The long lists, which the prefix leaves out, are not merged: candidates from the short ones are held against
   each other's whole signature, in its lowest byte per coordinate, and those with fewer collisions than the threshold, or with more different parities than may be, go.
6. What is left is confirmed on whole sets, made again from the texts of the listed vertices alone.

A list of many vertices is not paired within itself.  First each list's centre, the vertex with its least hash, is
paired with the others; families of copies mostly share one centre over all their lists.  Turns with other
centres follow while they find links.  Then vertices of one list in different components are paired, until no list has
any untried: components are those of all links, and pairs inside one component are not listed.

Null texts, and texts without words, have an empty set and link with nothing.  Rows that repeat a doc_id are vertices
by their text; a null doc_id is passed over where a component's least is taken, unless all are null.  An empty table returns
no rows.  Columns besides ``doc_id`` and ``text`` are not read.  Sets are compared by 64-bit shingle hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditspark.llm.common import components, small, stored
from creditspark.llm.shingles import blocks, shingle_sets

COORDINATES = 96
LOSS = 1e-7
#: Parity bits of a set; and the same by the remainder of their place, in columns of 64.
PARITIES = 1024
BITS = ["b0", "b1", "b2", "b3"]
#: Pairs for each listed vertex from which another turn of centres comes before all pairs.  Most fall to the bounds of ``_may_link``.
MANY_PAIRS = 256


@cache
def threshold(percent: int, coordinates: int = COORDINATES, loss: float = LOSS) -> int:
    """Most collisions that a pair of ``percent`` similarity reaches but for a probability below ``loss``."""
    p, below = percent / 100, 0.0
    for t in range(coordinates + 1):
        below += comb(coordinates, t) * p ** t * (1 - p) ** (coordinates - t)
        if below >= loss:
            return t
    return coordinates


def hash_functions(coordinates: int = COORDINATES, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and summands; a hash is the upper half of ``a * x + b``."""
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 1 << 63, (2, coordinates), dtype=np.uint64)
    return a * np.uint64(2) + np.uint64(1), b


def signatures(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """One line of least hashes per set; an empty set has zeros."""
    out = np.zeros((len(sets), coordinates), np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if not full:
        return out
    every = np.concatenate([sets[i] for i in full]).view(np.uint64)
    first = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
    work = np.empty_like(every)
    with np.errstate(over="ignore"):
        for k, (a, b) in enumerate(zip(*hash_functions(coordinates))):
            np.multiply(every, a, out=work)
            np.add(work, b, out=work)
            out[full, k] = np.minimum.reduceat(work, first) >> np.uint64(32)
    return out


def parities(sets: list[np.ndarray], bits: int = PARITIES) -> np.ndarray:
    """One line of ``bits`` parities per set, as 64-bit numbers: how many shingles have each value of their upper bits.
    Two sets differ in as many bits, at most, as in shingles."""
    out = np.zeros((len(sets), bits // 64), np.int64)
    for lo in range(0, len(sets), 256):
        part = sets[lo:lo + 256]
        every = np.concatenate(part).view(np.uint64)
        cell = np.repeat(np.arange(len(part)), [len(s) for s in part]) * bits + (every >> np.uint64(40)).astype(np.int64) % bits
        odd = (np.bincount(cell, minlength=len(part) * bits) & 1).astype(np.uint8)
        out[lo:lo + 256] = np.packbits(odd).view(np.int64).reshape(len(part), -1)
    return out


def folded(odd: np.ndarray) -> np.ndarray:
    """Parities by fewer bits."""
    return np.bitwise_xor.reduce(odd.reshape(len(odd), -1, len(BITS)), axis=1)


def _digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _signed(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, th, digest, n, sig, low, BITS) of every row; ``low`` has the lowest byte of each coordinate and the parities."""
    key = docs.schema["doc_id"].simpleString().replace(":", " ", 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch, 2):
                sets = shingle_sets(b.column(2), shingle)
                sig, odd = signatures(sets).view(np.int32), parities(sets)
                at = np.arange(0, sig.size + 1, COORDINATES, dtype=np.int32)
                low = [x.tobytes() + y.tobytes() for x, y in zip(sig.astype(np.uint8), odd)]
                odd = folded(odd)
                yield pa.RecordBatch.from_arrays([
                    b.column(0), b.column(1), pa.array([_digest(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(sig.ravel())), pa.array(low, pa.binary()), *[pa.array(odd[:, i]) for i in range(len(BITS))]], ["doc_id", "th", "digest", "n", "sig", "low", *BITS])

    return docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(run, f"{key}, th long, digest binary, n long, sig array<int>, low binary, " + ", ".join(f"{c} long" for c in BITS))


def _lists(vertices: DataFrame, least: int) -> DataFrame:
    """(t, before, digest, n, BITS): vertices under the (coordinate, value) pairs of their prefixes, in lists of several."""
    posted = vertices.select("digest", F.posexplode("sig").alias("k", "v"))
    posted = posted.select("digest", F.shiftleft(F.col("k").cast("long"), 32).bitwiseOR(F.col("v").cast("long").bitwiseAND(0xFFFFFFFF)).alias("t"))
    several = posted.groupBy("t").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    own = posted.join(several, "t").groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("df", "t"))).alias("own"))
    own = own.filter(F.size("own") >= least)
    prefix = own.select("digest", F.posexplode(F.slice("own", 1, F.size("own") - least + 1)).alias("at", "p"), "own")
    prefix = stored(prefix.select("digest", F.col("p.t").alias("t"), F.get("own", F.col("at") - 1)["t"].alias("before")), "prefixes")
    shared = prefix.groupBy("t").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).filter("lo <> hi").select("t")
    return stored(prefix.join(shared, "t").join(vertices.select("digest", "n", *BITS), "digest"), "lists")


def _sets_of(docs: DataFrame, listed: DataFrame, shingle: int) -> DataFrame:
    """(digest, items) of the listed vertices, each made from the text of one of its rows."""
    one = small(stored(listed.select(F.col("one.doc_id").alias("one_id"), F.col("one.th").alias("one_th")).distinct(), "one-row"), 300_000)
    texts = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    texts = texts.join(one, texts["doc_id"].eqNullSafe(one["one_id"]) & (texts["th"] == one["one_th"]), "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch, 0):
                sets = shingle_sets(b.column(0), shingle)
                yield pa.RecordBatch.from_arrays([pa.array([_digest(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["digest", "items"])

    sets = stored(texts.mapInArrow(run, "digest binary, items binary"), "whole-sets")
    return sets.dropDuplicates(["digest"]) if sets.count() > listed.count() else sets  # a row may be there several times


def _confirmed(pairs: DataFrame, listed: DataFrame, sets: DataFrame, least: int, percent: int) -> DataFrame:
    """The pairs (a, b) that collide often enough and are as similar as that on their whole sets."""
    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in batch.columns[2:4])
            collided = (x[:, :COORDINATES] == y[:, :COORDINATES]).sum(axis=1) >= least
            differ = np.bitwise_count(x[:, COORDINATES:] ^ y[:, COORDINATES:]).sum(axis=1, dtype=np.int64)
            n = batch.column(4).to_numpy() + batch.column(5).to_numpy()
            yield batch.select([0, 1]).filter(pa.array(collided & ((100 + percent) * differ <= (100 - percent) * n)))

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.int64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    def with_both(pairs: DataFrame, of: DataFrame, *cols: str) -> DataFrame:
        side = lambda v: of.select(F.col("digest").alias(v), *[F.col(c).alias(f"{c}_{v}") for c in cols])
        return small(pairs).join(side("a"), "a").join(side("b"), "b").select("a", "b", *[f"{c}_{v}" for c in cols for v in "ab"])

    near = stored(with_both(stored(pairs, "pairs"), listed, "low", "n").mapInArrow(hits, "a binary, b binary"), "collided")
    met = small(stored(near.select(F.explode(F.array("a", "b")).alias("digest")).distinct(), "met"))
    return with_both(near, sets.join(met, "digest", "left_semi"), "items").mapInArrow(similar, "a binary, b binary")


def _open(rows: DataFrame, label: DataFrame) -> DataFrame:
    """The list rows with their component, of lists that hold several components."""
    rows = rows.drop("label").join(small(label.withColumnRenamed("node", "digest")), "digest", "left").withColumn("label", F.coalesce("label", "digest"))
    rows = stored(rows, "labelled")
    many = rows.groupBy("t").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("t")
    return stored(rows.join(many, "t", "left_semi"), "open-lists")


def _may_link(percent: int):
    """Different components, sizes near enough, and no more different parities than shingles may differ."""
    n, m = F.col("x.n"), F.col("y.n")
    bits = sum((F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in BITS), F.lit(0))
    return ((F.col("x.label") != F.col("y.label")) & (100 * F.least(n, m) >= percent * F.greatest(n, m))
            & ((100 + percent) * bits <= (100 - percent) * (n + m)))


def _pairs(x: DataFrame, y: DataFrame, where) -> DataFrame:
    x, y = x.alias("x"), y.alias("y")
    met = x.join(y, (F.col("x.t") == F.col("y.t")) & where)
    return met.select(F.least("x.digest", "y.digest").alias("a"), F.greatest("x.digest", "y.digest").alias("b")).distinct()


def _links(lists: DataFrame, listed: DataFrame, sets: DataFrame, least: int, percent: int) -> DataFrame:
    """(node, label) of all vertices with a link."""
    label = lists.sparkSession.createDataFrame([], "node binary, label binary")
    rows, links, found, turn, most, last = lists.withColumn("label", F.col("digest")), None, 0, 0, 0, False
    while not last:
        if found:
            rows = _open(rows, label)  # a list that holds one component stays so
        if turn:
            each = rows.groupBy("t", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("t").agg(F.sum("c").alias("s"), F.sum(F.col("c") * F.col("c")).alias("q"))
            size = each.agg(F.sum("s"), F.sum((F.col("s") * F.col("s") - F.col("q")) / 2)).first()
            if not size[0]:
                break
            last = size[1] <= MANY_PAIRS * size[0] or 10 * found < most or not found
        if last:
            # where both have the same pair before this one they have met in its list
            once = F.col("x.before").isNull() | F.col("y.before").isNull() | (F.col("x.before") != F.col("y.before"))
            tried = _pairs(rows, rows, (F.col("x.digest") < F.col("y.digest")) & once & _may_link(percent))
        else:
            cols = ["digest", "n", "label", *BITS]
            centre = rows.groupBy("t").agg(F.min(F.struct(F.xxhash64("digest", F.lit(turn)).alias("h"), *cols)).alias("c"))
            tried = _pairs(centre.select("t", *[f"c.{c}" for c in cols]), rows, _may_link(percent))
        new = stored(_confirmed(tried, listed, sets, least, percent), "found-links")
        found = new.count()
        most = max(most, found)
        turn += 1
        if found:
            links = new if links is None else links.unionByName(new)
            label = stored(components(links, "a", "b"), "labels")
    return label


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, th, n_shingles, component_id) per row: the least doc_id of the documents reachable by links."""
    least = threshold(percent)
    signed = stored(_signed(docs, shingle), "signatures")
    rows = signed.select("doc_id", "th", "digest", F.col("n").alias("n_shingles"))
    vertices = signed.filter("n > 0").groupBy("digest").agg(F.min(F.struct("doc_id", "th")).alias("one"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("low").alias("low"), *[F.first(c).alias(c) for c in BITS])
    vertices = stored(vertices, "vertices")
    lists = _lists(vertices, least)
    listed = stored(vertices.select("digest", "one", "low", "n").join(lists.select("digest").distinct(), "digest"), "listed")
    label = _links(lists, listed, _sets_of(docs, listed, shingle), least, percent)
    # a vertex without a link is its own component
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("least"))
    named = first.join(label.withColumnRenamed("node", "digest"), "digest", "left").withColumn("label", F.coalesce("label", "digest"))
    whole = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = named.join(whole, "label").select("digest", "component_id")
    full, none = rows.filter("n_shingles > 0"), rows.filter("n_shingles = 0")
    return (full.join(named, "digest").select("doc_id", "th", "n_shingles", "component_id")
            .unionByName(none.select("doc_id", "th", "n_shingles", F.col("doc_id").alias("component_id"))))


def report(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs, 5, 85)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


ORACLE = r"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as g
      from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by 1),
l as (select a, b from (select x.doc_id as a, y.doc_id as b, count(*) as c from s x join s y using (g) where x.doc_id <> y.doc_id group by 1, 2)
      join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * c >= 85 * (na.n + nb.n - c)),
r as (select doc_id as a, doc_id as b from d union select r.a, l.b from r join l on r.b = l.a)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, c.b as component_id, d.doc_id = c.b as kept
from d left join n using (doc_id) join (select a, min(b) as b from r group by 1) c on c.a = d.doc_id
"""
