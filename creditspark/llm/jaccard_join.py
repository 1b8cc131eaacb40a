"""Near duplicates by a grouped prefix join on word shingles.

Two documents link when ``100 * |A and B| >= percent * |A or B|`` over their sets of distinct shingles.

1. Sets.  Equal sets (by a 128-bit digest) are one vertex; copies need no join.
2. Order.  Shingles that recur within a task's blocks are counted (lossy counting), and the most
   frequent ``COMMON`` of them come last, the more frequent the later; all others come by hash.  Any
   common order gives the same links; this one keeps shared passages out of the prefixes.
3. Groups.  Of a set of n shingles in that order the first ``n - ceil(percent * n / 100) + 1`` are its
   prefix; linked sets share a shingle of their prefixes.  Vertices with identical prefix and size
   collapse into one group, and only groups are joined.
4. Group pairs that share a prefix shingle pass the length bound, the positional bound and the bitmap bound
   (of two sets' parities by hash bit, as many bits differ at most as elements do), then members are
   expanded, held against the most that their prefixes let them share, and verified on their whole sets.
5. First each bucket's groups are paired with CENTRES of them alone, which gives most components
   without the pairs of a large bucket; while buckets would still have many pairs and
   a turn finds a tenth of the best turn's links, this is done again with other centres.  Then all pairs of groups whose members
   lie in different components are joined, for every bucket that still holds several: components
   are those of all links, and pairs inside one component are not listed.

Null texts, and texts without words, have an empty set and link with nothing.  Rows that repeat a doc_id
are vertices by their text.  Columns besides ``doc_id`` and ``text`` are not read.  Sets are compared by
64-bit shingle hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditspark.llm.common import components, small, stored
from creditspark.llm.shingles import blocks, shingle_sets

#: Shingles that the order puts last.  They are broadcast: 2 MB.  Others differ in cost alone.
COMMON = 1 << 18
#: Groups of a bucket with which all others are paired first, and the pairs for each group of a bucket from which
#: that is worth another turn.
CENTRES, MANY_PAIRS = 3, 64
#: Bytes of text whose sets a task holds at once.
BLOCK = 2 << 20
#: Parity bits of a set, in columns of 64.
BITS = ["b0", "b1", "b2", "b3"]


def _digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, th, digest, n, -, -) per row, and (-, -, -, -, token, seen) per recurring shingle of a block."""
    key = docs.schema["doc_id"].simpleString().replace(":", " ", 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch, 2, BLOCK):
                sets = shingle_sets(b.column(2), k)
                digests = [_digest(s) for s in sets]
                each = list({d: s for d, s in zip(digests, sets)}.values())
                tokens, seen = np.unique(np.concatenate(each), return_counts=True)
                tokens, seen = tokens[seen > 1], seen[seen > 1]
                n, m = len(sets), len(tokens)
                gap = lambda size, kind: pa.nulls(size, kind)
                put = lambda a, kind, size: pa.concat_arrays([a, gap(size, kind)])
                pre = lambda a, kind, size: pa.concat_arrays([gap(size, kind), a])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": put(b.column(0), b.column(0).type, m), "th": put(b.column(1), pa.int64(), m),
                    "digest": put(pa.array(digests, pa.binary()), pa.binary(), m), "n": put(pa.array([len(s) for s in sets], pa.int64()), pa.int64(), m),
                    "token": pre(pa.array(tokens, pa.int64()), pa.int64(), n), "seen": pre(pa.array(seen, pa.int64()), pa.int64(), n)})

    return docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(
        run, f"{key}, th long, digest binary, n long, token long, seen long")


def _common(marked: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most COMMON of the most frequent shingles, sorted, and their rank (the more frequent, the higher)."""
    counts = stored(marked.filter("token is not null").groupBy("token").agg(F.sum("seen").alias("seen")), "shingle-counts")
    # by eighths of a doubling: a few hundred levels, whatever the counts
    level = F.floor(8 * F.log2("seen")).cast("int")
    least, total = None, 0
    for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("level")).collect():
        total += r["n"]
        if total > COMMON:
            break
        least = r["level"]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    top = counts.filter(level >= least).toPandas().sort_values(["seen", "token"])
    common = top["token"].to_numpy(np.int64)
    order = np.argsort(common)
    return common[order], order


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def ordered(s: np.ndarray, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """A sorted set in the join's order; ``common`` is sorted, ``rank`` says which of them come later."""
    at = np.minimum(np.searchsorted(common, s), max(len(common) - 1, 0))
    late = common[at] == s if len(common) else np.zeros(len(s), bool)
    return np.concatenate([s[~late], s[late][np.argsort(rank[at[late]])]])


def parities(s: np.ndarray) -> np.ndarray:
    """Whether each of 64 x BITS classes of hashes holds an odd number of the set's elements."""
    n = 64 * len(BITS)
    odd = np.bincount((s >> 7) & (n - 1), minlength=n) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _prefixes(docs: DataFrame, k: int, percent: int, shared) -> DataFrame:
    """(digest, gid, n, tokens, BITS) per row with words; ``gid`` stands for prefix and size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch, 0, BLOCK):
                sets = [s for s in shingle_sets(b.column(0), k) if len(s)]
                once = {_digest(s): s for s in sets}
                heads = [ordered(s, *shared.value)[:prefix_size(len(s), percent)] for s in once.values()]
                sizes = [len(s) for s in once.values()]
                bits = np.array([parities(s) for s in once.values()], np.int64).reshape(-1, len(BITS)).T
                yield pa.RecordBatch.from_pydict({
                    "digest": pa.array(list(once), pa.binary()),
                    "gid": pa.array([xxhash.xxh3_64_intdigest(h.tobytes(), seed=n) - (1 << 63) for h, n in zip(heads, sizes)], pa.int64()),
                    "n": pa.array(sizes, pa.int64()), "tokens": pa.array(heads, pa.list_(pa.int64())), **{c: pa.array(np.ascontiguousarray(v)) for c, v in zip(BITS, bits)}})

    return docs.select("text").mapInArrow(run, "digest binary, gid long, n long, tokens array<long>, " + ", ".join(f"{c} long" for c in BITS))


def _may_link(percent: int, a: str, b: str) -> Column:
    """Length, positional and bitmap bounds of two groups that share the shingle at ``a.pos`` and ``b.pos``.
    Bitmaps are those of single members."""
    differ = sum((F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in BITS), F.lit(0))
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    most = 1 + F.least(na - F.col(f"{a}.pos") - 1, nb - F.col(f"{b}.pos") - 1)
    return ((percent * F.greatest(na, nb) <= 100 * F.least(na, nb)) & (most * (100 + percent) >= percent * (na + nb))
            & ((F.col(f"{a}.many") > 1) | (F.col(f"{b}.many") > 1) | (differ * (100 + percent) <= (100 - percent) * (na + nb))))


def most_shared(x: np.ndarray, nx: int, y: np.ndarray, ny: int, common: np.ndarray, rank: np.ndarray) -> int:
    """At most so many elements are shared by two sets with these prefixes and sizes: all of either prefix up to
    where the shorter one ends is known, and of the rest any could be shared."""
    kx, ky = (_order_key(v, common, rank) for v in (x, y))
    end = min(kx[-1], ky[-1])
    seen = len(np.intersect1d(x, y, assume_unique=True))
    return seen + min(nx - int(np.searchsorted(kx, end, "right")), ny - int(np.searchsorted(ky, end, "right")))


def _order_key(s: np.ndarray, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Numbers that rise as ``ordered`` does (hashes that differ in the last bit alone may be equal)."""
    at = np.minimum(np.searchsorted(common, s), max(len(common) - 1, 0))
    late = common[at] == s if len(common) else np.zeros(len(s), bool)
    early = (s.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(1)
    return np.where(late, np.uint64(1 << 63) + rank[at].astype(np.uint64) if len(common) else early, early)


def _plausible(pairs: DataFrame, vertices: DataFrame, percent: int, shared) -> DataFrame:
    """The pairs (a, b) whose prefixes allow a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = zip(batch.column(2).to_pylist(), batch.column(4).to_pylist())
            heads = zip(batch.column(3), batch.column(5))
            keep = [most_shared(x.values.to_numpy(), nx, y.values.to_numpy(), ny, *shared.value) * (100 + percent) >= percent * (nx + ny)
                    for (nx, ny), (x, y) in zip(sizes, heads)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    of = lambda v: vertices.select(F.col("digest").alias(v), F.col("n").alias(f"n_{v}"), F.col("tokens").alias(f"head_{v}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "n_a", "head_a", "n_b", "head_b")
    return both.mapInArrow(run, "a binary, b binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of vertices that link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.int64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    of = lambda v: sets.select(F.col("digest").alias(v), F.col("items").alias(f"set_{v}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(run, "a binary, b binary")


class _Links:
    """Verified links so far, the pairs that were tried, and every vertex's component."""

    def __init__(self, docs: DataFrame, rows: DataFrame, vertices: DataFrame, k: int, percent: int, shared):
        self.docs, self.rows, self.vertices, self.k, self.percent, self.shared = docs, rows, vertices, k, percent, shared
        self.members = members = vertices.select("gid", "n", "digest", *BITS)
        self.links = self.tried = None
        self.labelled = members.withColumn("label", F.col("digest"))

    def add(self, pairs: DataFrame) -> tuple[int, int]:
        """Verify the pairs (a, b) that are new; how many were tried, and how many link."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if self.tried is not None:
            pairs = pairs.join(self.tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        tried = pairs.count()
        self.tried = pairs if self.tried is None else self.tried.unionByName(pairs)
        pairs = stored(_plausible(pairs, self.vertices, self.percent, self.shared), "plausible")
        met = stored(pairs.select(F.col("a").alias("digest")).unionByName(pairs.select(F.col("b").alias("digest"))).distinct(), "met")
        found = stored(_verified(pairs, _whole_sets(self.docs, self.rows, met, self.k), self.percent), "links")
        n = tried, found.count()
        self.links = found if self.links is None else self.links.unionByName(found)
        if n[1]:
            label = components(self.links, "a", "b")
            self.labelled = stored(self.members.join(label.withColumnRenamed("node", "digest"), "digest", "left")
                                   .select("gid", "n", "digest", *BITS, F.coalesce("label", "digest").alias("label")), "labelled")
        return n

    def sides(self) -> DataFrame:
        """(gid, label, many, one, BITS): how many members each component has in each group, and one of them."""
        return self.labelled.groupBy("gid", "label").agg(F.count(F.lit(1)).alias("many"), F.min("digest").alias("one"), *[F.min(c).alias(c) for c in BITS])


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, th, n_shingles, component_id) per row: the least doc_id of the documents reachable by links."""
    marked = stored(_sets(docs, shingle), "sets")
    rows = marked.filter("n is not null").select("doc_id", "th", "digest", F.col("n").alias("n_shingles"))
    shared = docs.sparkSession.sparkContext.broadcast(_common(marked))
    vertices = stored(_prefixes(docs, shingle, percent, shared).dropDuplicates(["digest"]), "vertices")
    members = vertices.select("gid", "n", "digest")
    postings = vertices.select("gid", "n", "tokens", F.posexplode_outer("tokens").alias("pos", "token"))
    postings = postings.select("gid", "n", "pos", "token", F.get("tokens", F.col("pos") - 1).alias("before"))
    several = postings.groupBy("token").agg(F.min("gid").alias("lo"), F.max("gid").alias("hi")).filter("lo <> hi").select("token")
    buckets = stored(postings.join(several, "token").distinct(), "buckets")

    found = _Links(docs, rows, vertices, shingle, percent, shared)
    one = members.groupBy("gid").agg(F.min("digest").alias("a"), F.count(F.lit(1)).alias("many")).filter("many > 1")
    inside = one.drop("many").join(members, "gid").filter("a <> digest").select("a", F.col("digest").alias("b"))
    turn = most = 0
    while True:
        mixed = _mixed(buckets, found.sides())
        c = mixed.groupBy("token", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("token").agg(F.sum("c").alias("s"), F.sum(F.col("c") * F.col("c")).alias("q"))
        size = c.agg(F.sum("s"), F.sum((F.col("s") * F.col("s") - F.col("q")) / 2)).first()
        if turn and (not size[0] or size[1] <= MANY_PAIRS * size[0]):
            break
        pairs = _centre_pairs(mixed, found.labelled, percent, turn)
        tried, linked = found.add(pairs if turn else pairs.unionByName(inside))
        turn += 1
        most = max(linked, most)
        if 10 * linked < most or not tried:
            mixed = _mixed(buckets, found.sides())
            break
    found.add(_same_group(found.labelled).unionByName(_all_pairs(mixed, found.labelled, percent)))

    # an equal set needs no link; the least doc_id of a vertex, then of a component
    least = rows.groupBy("digest").agg(F.min("doc_id").alias("least"))
    named = least.join(found.labelled.select("digest", "label"), "digest")
    whole = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = named.join(whole, "label").select("digest", "component_id")
    full, none = rows.filter("n_shingles > 0"), rows.filter("n_shingles = 0")
    return (full.join(named, "digest").select("doc_id", "th", "n_shingles", "component_id")
            .unionByName(none.select("doc_id", "th", "n_shingles", F.col("doc_id").alias("component_id"))))


def _mixed(buckets: DataFrame, sides: DataFrame) -> DataFrame:
    """(gid, token, n, pos, before, and the columns of ``sides``) of the buckets that hold several components."""
    rows = buckets.join(sides, "gid")
    many = rows.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("token")
    return stored(rows.join(many, "token", "left_semi"), "mixed")


def _centre_pairs(mixed: DataFrame, labelled: DataFrame, percent: int, turn: int) -> DataFrame:
    """Each bucket's centres (the least by a few hashes, others every turn) with the members of its other groups."""
    row = ["gid", "n", "pos", "label", "one", "many", *BITS]
    least = [F.min(F.struct(F.xxhash64("gid", "label", F.lit(CENTRES * turn + k)).alias("h"), *row)).alias(f"c{k}") for k in range(CENTRES)]
    some = F.array_distinct(F.array(*[F.struct(*[F.col(f"c{k}.{c}").alias(c) for c in row]) for k in range(CENTRES)]))
    centre = mixed.groupBy("token").agg(*least).select("token", F.inline_outer(some))
    x, y = centre.alias("x"), mixed.alias("y")
    near = (x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.label") != F.col("y.label")) & _may_link(percent, "x", "y"))
            .select(F.col("x.one").alias("a"), F.col("y.gid").alias("gid"), F.col("y.label").alias("label")).distinct())
    return near.join(labelled, ["gid", "label"]).select("a", F.col("digest").alias("b"))


def _all_pairs(mixed: DataFrame, labelled: DataFrame, percent: int) -> DataFrame:
    """Members of all pairs of groups of one bucket that lie in different components.

    Two groups whose prefixes go on alike would meet in bucket after bucket: where both have the same shingle
    before this one they have met there, with wider bounds.  Their first common shingle always counts.
    """
    x, y = mixed.alias("x"), mixed.alias("y")
    first = F.coalesce(F.col("x.before") != F.col("y.before"), F.lit(True))
    rest = (x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.label") < F.col("y.label")) & first & _may_link(percent, "x", "y"))
            .select(F.col("x.gid").alias("ga"), F.col("x.label").alias("la"), F.col("y.gid").alias("gb"), F.col("y.label").alias("lb")).distinct())
    side = lambda g, l, v: labelled.select(F.col("gid").alias(g), F.col("label").alias(l), F.col("digest").alias(v))
    return rest.join(side("ga", "la", "a"), ["ga", "la"]).join(side("gb", "lb", "b"), ["gb", "lb"]).select("a", "b")


def _same_group(labelled: DataFrame) -> DataFrame:
    """Pairs of vertices of one group that lie in different components."""
    mixed = labelled.groupBy("gid").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("gid")
    open_ = stored(labelled.join(mixed, "gid", "left_semi"), "open-groups")
    x, y = open_.alias("x"), open_.alias("y")
    return (x.join(y, (F.col("x.gid") == F.col("y.gid")) & (F.col("x.label") < F.col("y.label")))
            .select(F.col("x.digest").alias("a"), F.col("y.digest").alias("b")))


def _whole_sets(docs: DataFrame, rows: DataFrame, met: DataFrame, k: int) -> DataFrame:
    """(digest, items) of the given vertices, each made from the text of one of its rows."""
    one = rows.join(met, "digest", "left_semi").groupBy("digest").agg(F.min(F.struct("doc_id", "th")).alias("r"))
    one = small(stored(one.select(F.col("r.doc_id").alias("one_id"), F.col("r.th").alias("one_th")).distinct(), "one-row"), 300_000)
    texts = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    texts = texts.join(one, texts["doc_id"].eqNullSafe(one["one_id"]) & (texts["th"] == one["one_th"]), "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[bytes] = set()
        for batch in batches:
            for b in blocks(batch, 0, BLOCK):
                sets = {d: s for s in shingle_sets(b.column(0), k) if (d := _digest(s)) not in done}
                done.update(sets)
                yield pa.RecordBatch.from_pydict({"digest": pa.array(list(sets), pa.binary()), "items": pa.array([s.tobytes() for s in sets.values()], pa.binary())})

    sets = stored(texts.mapInArrow(run, "digest binary, items binary"), "whole-sets")
    # a row may be there several times
    return sets.dropDuplicates(["digest"]) if sets.count() > met.count() else sets


def report(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, 3, 90).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row of its least (doc_id, text
    hash).  Texts without words all stay; rows that share doc_id and text count as one.  Where a whole component has
    no doc_id, one row of each distinct text stays."""
    cols = docs.columns
    found = stored(near_duplicates(docs, shingle, percent), "components")
    one = (found.filter("n_shingles > 0").groupBy(F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("th")).alias("own"))
           .agg(F.min(F.struct("doc_id", "th")).alias("r")).select(F.col("r.doc_id").alias("one_id"), F.col("r.th").alias("one_th")))
    empty = found.filter("n_shingles = 0").select(F.col("doc_id").alias("one_id"), F.col("th").alias("one_th"))
    one = stored(one.unionByName(empty).distinct(), "kept")
    kept = docs.join(one, docs["doc_id"].eqNullSafe(one["one_id"]) & (F.xxhash64(docs["text"]) == one["one_th"]), "left_semi")
    twice = found.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("many")).filter("many > 1").select(F.col("doc_id").alias("t_id"), F.col("th").alias("t_th"))
    twice = stored(twice, "repeated")
    if twice.isEmpty():
        return kept
    same = docs["doc_id"].eqNullSafe(twice["t_id"]) & (F.xxhash64(docs["text"]) == twice["t_th"])
    return kept.join(twice, same, "left_anti").select(cols).unionByName(kept.join(twice, same, "left_semi").dropDuplicates(["doc_id", "text"]).select(cols))


ORACLE = r"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + 2], ' ') as g
      from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by 1),
l as (select a, b from (select x.doc_id as a, y.doc_id as b, count(*) as c from s x join s y using (g) where x.doc_id <> y.doc_id group by 1, 2)
      join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * c >= 90 * (na.n + nb.n - c)),
r as (select doc_id as a, doc_id as b from d union select r.a, l.b from r join l on r.b = l.a)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, c.b as component_id
from d left join n using (doc_id) join (select a, min(b) as b from r group by 1) c on c.a = d.doc_id
"""
