"""Prefix trie of conversations: which beginnings they share, and what sharing saves.

A conversation is a sequence of turns (role, text); each distinct sequence of its first d turns is a node of depth d.

1. Equal conversations become one path with a count, before anything else moves; turns travel as 128-bit digests.
2. Paths are dealt into prefix shards.  A prefix of one turn that more than SHARD paths begin with is no shard:
   its paths are told apart by two turns, then four, and so on.  Several small prefixes share a shard.
3. Each shard numbers its turns densely and packs its paths into a double array: a child by turn c of state s is state
   ``BASE[s] + c``, and its ``CHECK`` is s.  All paths are traversed through the arrays, level by level, which
   counts members at every node; leaves and saved tokens are summed from the deepest level up.
4. Nodes above their shard's prefix are shared: the shards' partial counts are merged, and what the shards
   found below is added to all shared nodes above.

A conversation's turns (some 40 bytes each) lie in one task, a group of copies does not: the numbers of its members
are sorted by range over all tasks, joined to pieces there, and only the pieces stream through one digest.

Turns are ordered by turn (null first), ties by digest; null role or text counts as empty; repeated rows are turns of
their own.  Rows without a conv_id belong to no conversation and are left out.  An empty table has no nodes.  Columns
besides ``conv_id``, ``turn``, ``role`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditspark.llm.common import small, stored

#: Paths of a shard, about; a prefix of more is cut.
SHARD = 4_000
#: Children from which a node's are laid behind all others instead of into gaps.
WIDE = 64
PIECE = 4_096
SEQ = "array<struct<d:binary,t:int>>"
NOTHING = hashlib.sha256(b"").hexdigest()
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: What a shard returns: whole nodes, and the partial counts of shared ones (with ``key``).
PARTIAL = f"{NODE}, key string, parent_key string, up array<string>, tokens long"


class DoubleArray:
    """BASE and CHECK, grown level by level."""

    def __init__(self) -> None:
        self.base, self.check = np.zeros(64, np.int64), np.full(64, -1, np.int64)
        self.check[0], self.end = 0, 1  # the root; nothing lies from ``end`` on

    def _reach(self, n: int) -> None:
        if n > len(self.check):
            more = max(n, 2 * len(self.check)) - len(self.check)
            self.base, self.check = np.concatenate([self.base, np.zeros(more, np.int64)]), np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _put(self, state: int, codes: np.ndarray, base: int) -> None:
        self._reach(base + int(codes[-1]) + 1)
        self.base[state] = base
        self.check[base + codes] = state
        self.end = max(self.end, base + int(codes[-1]) + 1)

    def add(self, states: np.ndarray, codes: np.ndarray) -> None:
        """Children of one level: (state, code) pairs, sorted and distinct."""
        owner, first, n = np.unique(states, return_index=True, return_counts=True)
        for i in np.flatnonzero(n > 1):
            own = codes[first[i]:first[i] + n[i]]
            self._put(int(owner[i]), own, self._gap(own))
        one = n == 1
        alone, own = owner[one], codes[first[one]]
        self._reach(self.end + len(alone))
        free = np.flatnonzero(self.check < 0)[:len(alone)]
        self.base[alone] = free - own
        self.check[free] = alone
        if len(free):
            self.end = max(self.end, int(free[-1]) + 1)

    def _gap(self, codes: np.ndarray) -> int:
        """A base for all codes: the first that fits into free cells, or behind all others."""
        last = self.end - int(codes[0])
        if len(codes) >= WIDE:
            return last
        self._reach(self.end + int(codes[-1] - codes[0]) + 1)
        base = np.flatnonzero(self.check[:self.end] < 0) - codes[0]
        for c in codes[1:]:
            base = base[self.check[base + c] < 0]
            if not len(base):
                return last
        return int(base[0])

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The children of the states by the codes; -1 where there is none."""
        t = self.base[states] + codes
        inside = (t > 0) & (t < len(self.check))
        return np.where(inside & (self.check[np.where(inside, t, 0)] == states), t, -1)


def pack(codes: np.ndarray, at: np.ndarray) -> tuple[DoubleArray, list[np.ndarray]]:
    """The double array of sequences (``codes[at[i]:at[i + 1]]``), and the states of each level, root first."""
    trie = DoubleArray()
    size, states, levels, d = np.diff(at), np.zeros(len(at) - 1, np.int64), [np.zeros(1, np.int64)], 0
    while len(live := np.flatnonzero(size > d)):
        code = codes[at[live] + d]
        pair = np.unique(np.stack([states[live], code], axis=1), axis=0)
        trie.add(pair[:, 0], pair[:, 1])
        levels.append(trie.step(pair[:, 0], pair[:, 1]))
        states[live] = trie.step(states[live], code)
        d += 1
    return trie, levels


def _shard_nodes(table: pa.Table) -> pa.Table:
    """Nodes of one shard's paths (p, path, n, least, ends, seq)."""
    seq = table["seq"].combine_chunks()
    flat, at = seq.flatten(), seq.offsets.to_numpy().astype(np.int64)
    at = at - at[0]
    turns = flat.field("d").dictionary_encode()
    codes, names = turns.indices.to_numpy().astype(np.int64), turns.dictionary
    token = flat.field("t").to_numpy()
    n, least, p = (table[c].to_numpy() for c in ("n", "least", "p"))
    ends = table["ends"].to_pylist()
    trie, levels = pack(codes, at)
    cells = len(trie.check)
    depth, members, children, leaves, saved, tokens, some = (np.zeros(cells, np.int64) for _ in range(7))
    first, prefix, end = np.full(cells, np.iinfo(np.int64).max), np.zeros(cells, np.int64), {}
    states, size, d = np.zeros(len(n), np.int64), np.diff(at), 0
    live = np.arange(len(n))
    while True:  # all paths go down a level together
        s = states[live]
        np.add.at(members, s, n[live])
        np.minimum.at(first, s, least[live])
        prefix[s], some[s], depth[s] = p[live], live, d
        if d:
            tokens[s] = token[at[live] + d - 1]
        for i in live[size[live] == d].tolist():
            end[int(states[i])] = ends[i]
        live = live[size[live] > d]
        if not len(live):
            break
        states[live] = trie.step(states[live], codes[at[live] + d])
        d += 1
    prefix[0] = d + 2  # the root is shared by all shards
    every = np.concatenate(levels)
    for level in levels[:0:-1]:
        whole = level[depth[level] >= prefix[level]]
        leaves[whole[children[whole] == 0]] = 1
        saved[whole] += (members[whole] - 1) * tokens[whole]
        above = trie.check[whole]
        for total, part in ((children, np.ones(len(whole), np.int64)), (leaves, leaves[whole]), (saved, saved[whole])):
            np.add.at(total, above, part)
    shared = depth[every] < prefix[every]
    keys: dict[int, tuple[str, str | None, list[str]]] = {}
    hexes = {}

    def key(state: int) -> tuple[str, str | None, list[str]]:
        """The key of a shared state, of the one above, and of all above from the root on."""
        down = []
        while state not in keys and state:
            down.append(state)
            state = int(trie.check[state])
        if state not in keys:
            keys[state] = (path_key(""), None, [])
        for s in reversed(down):
            i = int(some[s])
            if i not in hexes:
                hexes[i] = "".join(names[int(c)].as_py().hex() for c in codes[at[i]:min(at[i] + p[i], at[i + 1])])
            _, _, up = keys[state]
            keys[s] = (path_key(hexes[i][:32 * int(depth[s])]), keys[state][0], [*up, keys[state][0]])
            state = s
        return keys[state]

    whole, parts = every[~shared], every[shared].tolist()
    above = trie.check[whole]
    top = depth[above] < prefix[above]
    out = [key(s) for s in parts]
    order = np.concatenate([whole, np.array(parts, np.int64)])
    known = ~np.concatenate([top, np.ones(len(parts), bool)])
    return pa.table({
        "conv_id": first[order], "depth": depth[order], "parent_conv_id": pa.array(first[trie.check[order]], mask=~known),
        "n_convs": members[order], "n_children": children[order], "n_leaves": leaves[order], "saved_tokens": saved[order],
        "ends_sha256": pa.array([end.get(s) or NOTHING for s in whole.tolist()] + [end.get(s) for s in parts], pa.string()),
        "key": pa.array([None] * len(whole) + [k for k, _, _ in out], pa.string()),
        "parent_key": pa.array([key(s)[0] if t else None for s, t in zip(above.tolist(), top.tolist())] + [u for _, u, _ in out], pa.string()),
        "up": pa.array([None] * len(whole) + [u for _, _, u in out], pa.list_(pa.string())), "tokens": tokens[order]})


def path_key(digests: str) -> str:
    return hashlib.md5(digests.encode()).hexdigest()


def _path(seq: Column) -> Column:
    return F.md5(F.array_join(F.transform(seq, lambda x: F.lower(F.hex(x["d"]))), ""))


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq): each conversation's turns in order, as digest and number of words."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct("turn", F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("d"),
                    F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("int").alias("t"))
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long"), turn.alias("x"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("x"))
    return grouped.select("conv_id", F.transform("x", lambda x: F.struct(x["d"].alias("d"), x["t"].alias("t"))).alias("seq"))


def rebuilt(convs: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """(conv_id, seq): every conversation with its first h turns from the one that its family (of ``family`` ids) begins
    with; h is the CRC of the id modulo ``most``."""
    convs = stored(convs, "conversations")
    base = F.col("conv_id") - F.col("conv_id") % family
    heads = convs.filter(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), F.slice("seq", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    head = F.coalesce("head", F.array().cast(SEQ))
    joined = convs.withColumn("base", base).join(heads, "base", "left")
    return joined.select("conv_id", F.concat(F.slice(head, F.lit(1), h), F.slice("seq", h + 1, F.greatest(F.size("seq"), F.lit(1)))).alias("seq"))


def _ends(rows: DataFrame) -> DataFrame:
    """(path, ends): SHA-256 of the members' ids, ascending and comma-joined, of (path, conv_id) rows."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, ids = None, []

        def piece():
            return pa.RecordBatch.from_pydict({"path": [path], "first": pa.array([ids[0]], pa.int64()), "ids": [",".join(map(str, ids))]})

        for b in batches:
            for p, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if ids and (p != path or len(ids) == PIECE):
                    yield piece()
                    ids = []
                path = p
                ids.append(c)
        if ids:
            yield piece()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, sha = None, None
        for b in batches:
            done = []
            for p, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if p != path:
                    if sha:
                        done.append((path, sha.hexdigest()))
                    path, sha = p, hashlib.sha256(ids.encode())
                else:
                    sha.update(f",{ids}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], pa.string()) for k in (0, 1)], ["path", "ends"])
        if sha:
            yield pa.RecordBatch.from_pydict({"path": [path], "ends": [sha.hexdigest()]})

    sorted_ = rows.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    joined = sorted_.select("path", "conv_id").mapInArrow(pieces, "path string, first long, ids string")
    return joined.repartition("path").sortWithinPartitions("path", "first").mapInArrow(digests, "path string, ends string")


def paths(convs: DataFrame) -> DataFrame:
    """(path, n, least, ends, seq): the distinct sequences of (conv_id, seq) rows."""
    rows = stored(convs.select("conv_id", "seq", _path(F.col("seq")).alias("path")), "paths")
    found = stored(rows.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), F.first("seq").alias("seq")), "distinct-paths")
    several = rows.join(found.filter("n > 1").select("path"), "path", "left_semi").select("path", "conv_id")
    alone = F.sha2(F.col("least").cast("string"), 256)
    return found.join(_ends(several), "path", "left").withColumn("ends", F.when(F.col("n") == 1, alone).otherwise(F.col("ends")))


def sharded(found: DataFrame, shard: int = SHARD) -> DataFrame:
    """``found`` with ``p``, the turns of the prefix that a path is dealt by, and ``shard``."""
    found = stored(found, "dealt-paths")
    rest, p, out = found, 1, None
    n_shards = -(-found.count() // shard) or 1
    while True:
        keyed = rest.withColumn("prefix", _path(F.slice("seq", 1, p))).withColumn("p", F.lit(p).cast("long"))
        # at most one for every ``shard`` paths
        large = stored(keyed.groupBy("prefix").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > shard).select("prefix"), "large-prefixes")
        none = large.isEmpty()
        part = keyed if none else keyed.join(small(large), "prefix", "left_anti")
        part = part.select(*found.columns, "p", F.pmod(F.xxhash64("prefix"), F.lit(n_shards)).alias("shard"))
        out = part if out is None else out.unionByName(part)
        if none:
            return out
        rest, p = keyed.join(small(large), "prefix", "left_semi").select(*found.columns), 2 * p


def trie(convs: DataFrame, shard: int = SHARD) -> DataFrame:
    """The nodes of (conv_id, seq) rows."""
    dealt = sharded(paths(convs), shard).select("shard", "p", "n", "least", "ends", "seq")
    found = stored(dealt.groupBy("shard").applyInArrow(_shard_nodes, PARTIAL), "shard-nodes")
    whole, part = found.filter("key is null"), found.filter("key is not null")
    upper = part.groupBy("key").agg(
        F.first("depth").alias("depth"), F.first("parent_key").alias("parent_key"), F.first("up").alias("up"), F.first("tokens").alias("tokens"),
        F.min("conv_id").alias("conv_id"), F.max("ends_sha256").alias("ends_sha256"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    upper = stored(upper, "shared-nodes")
    below = upper.filter("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("more"))
    upper = upper.join(below, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    upper = (upper.withColumn("n_leaves", F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0))
             .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("tokens")))
    upper = stored(upper, "shared-counts")
    # every shared node counts for itself and all shared ones above
    sums = (upper.select(F.explode(F.concat("up", F.array("key"))).alias("key"), "n_leaves", "saved_tokens")
            .groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")))
    names = stored(upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("named")), "shared-names")
    cols = [c.split()[0] for c in NODE.split(", ")]
    upper = upper.drop("n_leaves", "saved_tokens").join(sums, "key").withColumns({"ends_sha256": F.coalesce("ends_sha256", F.lit(NOTHING)), "parent_conv_id": F.lit(None).cast("long")})
    both = upper.select(*cols, "parent_key").unionByName(whole.filter("parent_key is not null").select(*cols, "parent_key"))
    both = both.join(names, "parent_key", "left").withColumn("parent_conv_id", F.col("named")).select(cols)
    return both.unionByName(whole.filter("parent_key is null").select(cols))


def report(conversations: DataFrame) -> DataFrame:
    return trie(rebuilt(sequences(conversations)))


ORACLE = r"""
with t as (select conv_id, coalesce(role, '') as r, coalesce(text, '') as x, turn from conversations where conv_id is not null),
o as (select conv_id, list({'r': r, 'x': x} order by turn nulls first, md5(strlen(r) || ':' || r || x)) as s from t group by 1),
h as (select conv_id, s, conv_id - conv_id % 20 as base,
             xor(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(string_split(conv_id::varchar, ''),
                     lambda c: list_concat([ascii(c)::bigint], [-1, -1, -1, -1, -1, -1, -1, -1])))),
                 lambda a, e: case when e >= 0 then xor(a, e) else xor(a >> 1, 3988292384 * (a & 1)) end), 4294967295) % 4 as h from o),
b as (select h.conv_id, list_concat(list_slice(coalesce(f.s, []), 1, h.h), list_slice(h.s, h.h + 1, len(h.s))) as s
      from h left join o f on f.conv_id = h.base),
n as (select conv_id, d, s[1:d] as p, len(s) = d as ends from (select conv_id, s, unnest(range(0, len(s) + 1)) as d from b)),
g as (select p, d, min(conv_id) as m, count(*) as n,
             coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '') as e,
             case when d = 0 then 0 else len(regexp_extract_all(p[d].x, '[^\x20\x09-\x0D]+')) end as w from n group by 1, 2),
k as (select a.d, a.m, c.d as cd, c.m as cm, c.n, c.w, c.kids
      from (select x.*, (select count(*) from g y where y.d = x.d + 1 and y.p[1:x.d] = x.p) as kids from g x) c
      join n v on v.conv_id = c.m and v.d <= c.d join g a on a.d = v.d and a.p = v.p),
u as (select d, m, sum((n - 1) * w) as saved, sum((kids = 0)::int) as leaves, max(case when d = cd then kids end) as kids from k group by 1, 2)
select g.m as conv_id, g.d as depth, q.m as parent_conv_id, g.n as n_convs, u.kids::bigint as n_children, u.leaves::bigint as n_leaves,
       u.saved::bigint as saved_tokens, sha256(g.e) as ends_sha256
from g join u on u.d = g.d and u.m = g.m left join g q on q.d = g.d - 1 and q.p = g.p[1:g.d - 1]
"""
