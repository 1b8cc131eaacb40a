"""Repeated passages by content-defined chunking.

A gear rolling hash over a text's bytes (the last 16 count) cuts it at the least hash of every REACH neighbouring
places (all of them if equal, so that periodic stretches are cut as well): cuts depend on content alone, lie no
further apart than that, and an insertion moves only the ones it touches.  From every cut on, the stretch to the first
cut at least ``least`` characters on is a sequence; its digest is counted over the corpus (one row per distinct
digest and task before the shuffle) with its least doc_id, and the digests that occur twice or more join
back to the sequences.  Digests that hold a 4096th of the recurring sequences or more, of which there can be 4096,
are broadcast, and their sequences are spread by row instead of meeting in one task.  In each document, the sequences that recur form the passages
where they overlap or touch, so every part of a passage lies in a stretch of ``least`` characters that occurs
elsewhere as a whole.  A sequence's first occurrence in the document of least doc_id stays; what else of the
passages is there is to be removed.  A shared passage of ``least`` + 16 + 3 REACH single-byte characters always
holds a sequence.

Offsets are code points, the end is exclusive.  Null and empty texts have no chunks.  A row is told from
others by its doc_id and text: rows that repeat both are one document here, and get equal results.  Of sequences that
only documents without doc_id hold, each such document keeps one.  Other columns are not read.  A digest
has 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditspark.llm.common import stored
from creditspark.llm.shingles import blocks

REACH = 40
LEAST = 100
WINDOW = 16
HOT = 4096  # a digest with one in so many of the recurring sequences is listed


@cache
def _gear() -> np.ndarray:
    """A fixed random number per byte value."""
    return np.array([xxhash.xxh64_intdigest(bytes([b]), seed=9) & 0xFFFF for b in range(256)], np.uint16)


def _least(h: np.ndarray, n: int) -> np.ndarray:
    """The least of every ``n`` neighbours."""
    size = 1
    while size < n:
        step = min(size, n - size)
        h = np.minimum(h[:-step], h[step:])
        size += step
    return h


def cuts(data: bytes | np.ndarray, reach: int = REACH) -> np.ndarray:
    """Ends of all chunks of ``data``.  With 16-bit hashes a byte is shifted out after 16 steps, so the rolling
    sum is that of 16 shifted copies."""
    raw = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data
    if not len(raw):
        return np.zeros(0, np.int64)
    if len(raw) < WINDOW + reach:
        return np.array([len(raw)])
    g = _gear()[raw]
    h = g.copy()
    for j in range(1, WINDOW):
        h[j:] += g[:-j] << np.uint16(j)
    # only whole windows of whole hashes count, so a text's cuts are also those of any text around it
    h = h[WINDOW - 1:]
    low = _least(h, reach)
    # the highest of the leasts of all windows around a place
    edge = np.zeros(reach - 1, np.uint16)
    high = ~_least(~np.concatenate([edge, low, edge]), reach)
    ends = np.flatnonzero(h == high) + WINDOW
    # a cut never splits a code point: it moves on to the end of it
    first = np.flatnonzero((raw & 0xC0) != 0x80)
    ends = np.unique(np.append(first, len(raw))[np.searchsorted(first, ends)])
    return ends if len(ends) and ends[-1] == len(raw) else np.append(ends, len(raw))


def sequences(docs: DataFrame, reach: int = REACH, least: int = LEAST) -> DataFrame:
    """(doc_id, th, start, n_chars, digest) of the stretch from every cut to the first one ``least`` characters on."""
    key = docs.schema["doc_id"].simpleString().replace(":", " ", 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch, 2, 2 << 20):
                row, start, size, digest = [], [], [], []
                for r, text in enumerate(pc.fill_null(b.column(2).cast(pa.binary()), b"").to_pylist()):
                    if not text:
                        continue
                    raw = np.frombuffer(text, np.uint8)
                    at = np.concatenate([[0], cuts(raw, reach)])
                    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[at]
                    last = np.searchsorted(chars, chars + least)
                    first = np.flatnonzero(last < len(at))
                    last = last[first]
                    row.append(np.full(len(first), r))
                    start.append(chars[first])
                    size.append(chars[last] - chars[first])
                    digest += [xxhash.xxh3_64_intdigest(text[i:j]) for i, j in zip(at[first].tolist(), at[last].tolist())]
                if not digest:
                    continue
                take = pa.array(np.concatenate(row))
                col = lambda x: pa.array(np.concatenate(x), pa.int32())
                yield pa.RecordBatch.from_pydict({"doc_id": b.column(0).take(take), "th": b.column(1).take(take), "start": col(start), "n_chars": col(size),
                                                  "digest": pa.array(np.array(digest, np.uint64).view(np.int64))})

    return docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(run, f"{key}, th long, start int, n_chars int, digest long")


def repeats(docs: DataFrame, reach: int = REACH, least: int = LEAST) -> DataFrame:
    """(doc_id, th, passages, removable) per row with a passage: arrays of (start, end), in order.
    ``passages`` are all that occur elsewhere too, ``removable`` those parts of which this is not the first."""
    every = sequences(docs, reach, least)
    twice = stored(every.groupBy("digest").agg(F.count(F.lit(1)).alias("many"), F.min("doc_id").alias("first")).filter("many > 1"), "recurring")
    total = twice.agg(F.sum("many")).first()[0] or 0
    hot = F.col("many") * HOT >= total
    # a row of a hot digest needs no partner any more: its second key never matches, its first spreads it
    listed = F.broadcast(twice.filter(hot).select("digest", F.struct("first").alias("hot")))
    rest = twice.filter(~hot).select(F.col("digest").alias("key"), F.lit(False).alias("spread"), F.struct("first").alias("cold"))
    keyed = (every.join(listed, "digest", "left").withColumn("spread", F.col("hot").isNotNull())
             .withColumn("key", F.when(F.col("spread"), F.xxhash64("th", "start")).otherwise(F.col("digest"))))
    found = keyed.join(rest, ["key", "spread"], "left").withColumn("from", F.coalesce("hot", "cold")).filter("from is not null")
    own = found.select("doc_id", "th", F.struct("start", "n_chars", "digest", (~F.col("doc_id").eqNullSafe(F.col("from.first"))).alias("later")).alias("c"))
    key = docs.schema["doc_id"].simpleString().replace(":", " ", 1)
    span = "array<struct<start:int,end:int>>"
    return own.groupBy("doc_id", "th").agg(F.sort_array(F.collect_set("c")).alias("c")).mapInArrow(
        _runs(least), f"{key}, th long, passages {span}, removable {span}")


def merge(found: list[tuple[int, int, int, bool]], least: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Passages and removable parts of a document's repeated sequences (start, n_chars, digest, later), in order."""
    seen: set[int] = set()
    passages: list[tuple[int, int]] = []
    again: list[tuple[int, int]] = []
    kept: list[tuple[int, int]] = []
    for start, n, digest, later in found:
        for spans in (passages, again if later or digest in seen else kept):
            if spans and spans[-1][1] >= start:
                spans[-1] = (spans[-1][0], max(spans[-1][1], start + n))
            else:
                spans.append((start, start + n))
        seen.add(digest)
    passages = [p for p in passages if p[1] - p[0] >= least]
    # what a first occurrence covers stays
    removable, i = [], 0
    for start, end in again:
        while i < len(kept) and kept[i][1] <= start:
            i += 1
        k = i
        while start < end:
            stop = min(end, kept[k][0]) if k < len(kept) else end
            if stop - start >= least:
                removable.append((start, stop))
            start = max(start, kept[k][1]) if k < len(kept) else end
            k += 1
    return passages, removable


def _runs(least: int):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [merge([tuple(c.values()) for c in own], least) for own in b.column(2).to_pylist()]
            keep = pa.array([bool(p) for p, _ in out], pa.bool_())
            spans = [pa.array([[{"start": s, "end": e} for s, e in o[k]] for o in out], kind) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *spans], ["doc_id", "th", "passages", "removable"]).filter(keep)

    return run


def report(docs: DataFrame) -> DataFrame:
    """Per row: n_repeats, n_repeated_chars, passages and removable as ``start:end`` lists."""
    found = stored(repeats(docs), "repeats").select(F.col("doc_id").alias("own_id"), F.col("th").alias("own_th"), "passages", "removable")
    every = docs.select("doc_id", F.xxhash64("text").alias("th"))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    rows = every.join(found, every["doc_id"].eqNullSafe(found["own_id"]) & (every["th"] == found["own_th"]), "left").select(
        "doc_id", F.coalesce("passages", empty).alias("p"), F.coalesce("removable", empty).alias("r"))
    chars = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + (x["end"] - x["start"]))
    text = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"))), ",")
    return rows.select("doc_id", F.size("p").cast("long").alias("n_repeats"), chars(F.col("p")).alias("n_repeated_chars"),
                       chars(F.col("r")).alias("n_removable_chars"), text(F.col("p")).alias("passages"), text(F.col("r")).alias("removable"))
