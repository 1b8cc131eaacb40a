"""Sharding by vector bin packing (law ``bytes``).

Rows with equal texts form a group, which stays in one shard.  A group's vector is (bytes, tokens, rows).
Groups are dealt by digest over many cells of a bounded number of groups; each cell fills its own share of
every shard (a cell's total over the number of shards, in each dimension), largest group first, always
where the dot product of the group's vector with the shard's residual capacity is highest.  Every cell
ends nearly even, so the shards do.

Groups above ``1 / first`` of a shard, of which there are a bounded number, are placed before all others, over
whole shards; the cells share out what these leave.  Only a group of more bytes than a shard is cut: its
rows are dealt by a hash over as few chunks as may each fit into a shard.  Groups are counted before anything moves (one row
per group and task), texts themselves are never shuffled, and slots are numbered by buckets of bounded size.

A null text has size 1 and no tokens, and null texts form one group.  Rows that repeat a doc_id are
rows like others.  Columns besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditspark.llm.common import small, stored

CELL_GROUPS = 4_000
BUCKET_ROWS = 100_000
#: Bytes are the law; tokens and rows decide among shards of like room.
BYTES_WEIGHT = 512.0
DIMENSIONS = ["size", "tokens", "rows"]


def place(vectors: np.ndarray, room: np.ndarray, turn: int = 0) -> np.ndarray:
    """The shard of each vector: largest first, by the dot product with the residual capacity (``room``,
    a row per shard, which shrinks)."""
    n = len(room)
    scale = np.where(room.sum(axis=0) > 0, room.sum(axis=0), 1) / n
    scaled, left = vectors / scale, room / scale
    weight = np.array([BYTES_WEIGHT, 1, 1])
    out = np.empty(len(vectors), np.int32)
    for i in np.argsort(-(scaled @ weight), kind="stable"):
        fit = (left * weight) @ (scaled[i] + 1e-12)
        out[i] = s = (int(np.argmax(np.roll(fit, -turn))) + turn) % n
        left[s] -= scaled[i]
    room[:] = left * scale
    return out


def shard(docs: DataFrame, n_shards: int = 16, first: int = 64, seed: int = 42) -> DataFrame:
    """(doc_id, size, tokens, digest, text_crc32, shard, slot) per row; slots are gapless from 0 in each shard."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.md5(F.coalesce("text", F.lit("\0null"))).alias("digest"), F.crc32(text).alias("text_crc32"),
                       (F.octet_length(text) + 1).cast("long").alias("size"), F.regexp_count(text, F.lit(r"[^ \t-\r]+")).cast("long").alias("tokens"))
    rows = stored(rows, "sizes")
    vector = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    groups = stored(rows.groupBy("digest").agg(*vector), "groups")
    total = groups.agg(*[F.sum(c).alias(c) for c in DIMENSIONS], F.count(F.lit(1)).alias("n")).first()
    if not total["n"]:
        return rows.select("*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    part = F.greatest(F.col("size") / total["size"], F.col("rows") / total["rows"]) * n_shards
    # at most 2 x first x n_shards groups are this large
    chunks = F.when(F.col("rows") > 1, F.ceil(F.col("size") / total["size"] * n_shards)).otherwise(1).cast("long")
    large = groups.filter(part * first > 1).select("digest", chunks.alias("chunks"))
    rows = rows.join(F.broadcast(large), "digest", "left")
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.col("chunks"))).drop("chunks")
    chunks = rows.filter("chunk is not null").groupBy("digest", "chunk").agg(*vector).toPandas().sort_values(["digest", "chunk"])
    room = np.tile(np.array([total[c] for c in DIMENSIONS], float) / n_shards, (n_shards, 1))
    chunks["shard"] = place(chunks[DIMENSIONS].to_numpy(float), room)
    spark = docs.sparkSession
    early = spark.createDataFrame(chunks[["digest", "chunk", "shard"]], "digest string, chunk long, shard int")
    shares = np.maximum(room, 0) / np.maximum(room, 0).sum(axis=0).clip(1e-9)
    cells = math.ceil(total["n"] / CELL_GROUPS)

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("digest", kind="stable")
        vectors = group[DIMENSIONS].to_numpy(float)
        group["shard"] = place(vectors, shares * vectors.sum(axis=0), int(group["cell"].iloc[0]) * 7 % n_shards)
        return group[["digest", "shard"]]

    rest = groups.join(F.broadcast(large), "digest", "left_anti").withColumn("cell", F.pmod(F.xxhash64("digest", F.lit(seed)), F.lit(cells)))
    late = rest.groupBy("cell").applyInPandas(fill, "digest string, shard int")
    # no group of this join is large
    placed = rows.filter("chunk is null").join(late, "digest").unionByName(rows.filter("chunk is not null").join(F.broadcast(early), ["digest", "chunk"]))
    return number(stored(placed.drop("chunk"), "placed"), math.ceil(total["rows"] / n_shards / BUCKET_ROWS))


def number(rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` with ``slot``: shards are cut into hashed buckets, which are counted, then numbered alone."""
    keyed = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(max(1, buckets))))
    counts = keyed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    # one row per 100,000 documents
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "digest")
    numbered = keyed.withColumn("k", F.row_number().over(inside) - 1)
    return (numbered.join(small(first), ["shard", "bucket"])
            .withColumn("slot", F.col("first") + F.col("k")).drop("bucket", "first", "k"))


def report(docs: DataFrame) -> DataFrame:
    return shard(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
