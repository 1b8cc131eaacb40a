"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions alone.

A window is ``window`` consecutive words of a benchmark item (a shorter item is one window).  Each
window is a set of word shingles, of which a document must hold all:

1. one pass over the documents hashes every shingle of whole texts and keeps the places whose hash
   is a benchmark shingle, each with the words around it (and one row per document for its counts);
2. shingles are ordered by rarity, counted over all those places; for full containment the necessary
   prefix of a window is its rarest shingle, and a window with an absent shingle cannot occur;
3. places join the windows whose prefix they hold; the prefix's offset gives the window's place, which
   must lie within the document (position and length bounds);
4. what is left is verified word by word against the window.

Null texts have no words.  A row is told from others by its doc_id and text, so repeated rows get
equal results and a null doc_id is a value like others.  Items with a null item_id or without words are
left out; equal items are joined as one.  Other columns are not read.
The benchmark's shingles are broadcast if counted to be few, else joined by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from creditspark.llm.common import ascii_lower, small, stored

WINDOW, SHINGLE = 10, 5


def words_of(text: Column) -> Column:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z in lower case."""
    t = F.coalesce(text, F.lit(""))
    plain = F.length(t) == F.octet_length(t)
    low = F.when(plain, F.lower(t)).otherwise(ascii_lower(t))
    return F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _hash(words: str, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(F.col(words), at + k) for k in range(size)])


def windows_of(items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(wid, words) of the distinct windows, and (wid, item_ids) lists of equal items per window."""
    same = (items.filter("item_id is not null").select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words"))
            .filter(F.size("words") > 0).groupBy("words").agg(F.collect_set("item_id").alias("item_ids")))
    at = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    every = same.select("item_ids", F.explode_outer(F.transform(at, lambda i: F.slice("words", i, window))).alias("words"))
    every = stored(every.select(F.xxhash64("words").alias("wid"), "words", "item_ids"), "windows")
    return every.groupBy("wid").agg(F.first("words").alias("words")), every.select("wid", "item_ids").distinct()


def shingles_of(windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(wid, words, size, off, h): every shingle of every window."""
    size = F.least(F.size("words"), F.lit(shingle))
    rows = windows.select("wid", "words", size.alias("size"), F.explode_outer(F.sequence(F.lit(0), F.size("words") - size)).alias("off"))
    return rows.select("*", F.xxhash64(F.slice("words", F.col("off") + 1, F.col("size"))).alias("h"))


def places(docs: DataFrame, shingles: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, th, n_words, pos, h, base, around): a row with pos -1 for every document, and one for
    every place of a benchmark shingle with the words from ``base`` on that a window there can hold."""
    keys = shingles.select("h", "size").distinct()
    sizes = sorted(r["size"] for r in keys.select("size").distinct().collect())  # 1 to SHINGLE
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), words_of(F.col("text")).alias("words"))
    least = min(sizes, default=window)
    # outer, though never empty: else a filter on the generator's input is pushed below, and the words are made twice
    at = F.explode_outer(F.sequence(F.lit(-1), F.greatest(F.size("words") - least, F.lit(-1))))
    rows = rows.select("doc_id", "th", "words", F.size("words").cast("long").alias("n_words"), at.alias("pos"))
    # the hash of a slice of words and that of its words in turn are the same
    some = {s: _hash("words", F.col("pos"), s) for s in sizes}
    if len(sizes) == 1:
        rows = rows.select("*", F.lit(sizes[0]).alias("size"), some[sizes[0]].alias("h"))
    else:
        each = F.array(*[F.struct(F.lit(s).alias("size"), F.when(F.col("pos") + s <= F.col("n_words"), h).otherwise(F.lit(0)).alias("h"))
                         for s, h in some.items()] or [F.struct(F.lit(0).alias("size"), F.lit(0).cast("long").alias("h"))])
        rows = rows.select("doc_id", "th", "words", "n_words", "pos", F.explode_outer(F.when(F.col("pos") < 0, F.slice(each, 1, 1)).otherwise(each)).alias("s"))
        rows = rows.select("doc_id", "th", "words", "n_words", "pos", "s.size", "s.h")
    # a document's own row has a key of its own, which spreads these rows where the join shuffles
    rows = rows.withColumn("h", F.when(F.col("pos") < 0, F.col("th")).otherwise(F.col("h")))
    known = small(keys.withColumn("known", F.lit(True)), 2_000_000)
    hit = rows.join(known, ["h", "size"], "left").filter((F.col("pos") < 0) | (F.col("known") & (F.col("pos") + F.col("size") <= F.col("n_words"))))
    base = F.greatest(F.col("pos") - (F.lit(window) - F.col("size")), F.lit(0))
    around = F.when(F.col("pos") >= 0, F.slice("words", base + 1, 2 * window - F.col("size")))
    return hit.select("doc_id", "th", "n_words", "pos", "h", "size", base.alias("base"), around.alias("around"))


def occurrences(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (doc_id, th, n_words), verified windows (doc_id, th, start, length, wid) and (wid, item_ids)."""
    windows, owners = windows_of(items, window)
    shingles = stored(shingles_of(windows, shingle), "shingles")
    found = stored(places(docs, shingles, window), "places")
    counts = found.filter("pos >= 0").groupBy("h", "size").agg(F.count(F.lit(1)).alias("n"))
    rarest = (shingles.join(counts, ["h", "size"], "left")
              .groupBy("wid", "words").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "h", "size")).alias("p"))
              .filter("p.n > 0").select("wid", F.col("words").alias("w"), "p.off", "p.h", "p.size"))
    prefix = small(stored(rarest, "prefixes"), 1_000_000)
    start = F.col("pos") - F.col("off")
    length = F.size("w")
    at = (found.filter("pos >= 0").join(prefix, ["h", "size"])
          .filter((start >= 0) & (start + length <= F.col("n_words")))
          .filter(F.slice("around", start - F.col("base") + 1, length) == F.col("w")))
    seen = at.select("doc_id", "th", start.alias("start"), length.alias("length"), "wid")
    return found.filter("pos < 0").select("doc_id", "th", "n_words"), seen, owners


def judge(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, th, n_words, n_hit, item_ids, contaminated) per row of ``docs``."""
    every, seen, owners = occurrences(docs, items, window, shingle)
    seen = stored(seen.distinct(), "occurrences")
    before = Window.partitionBy("doc_id", "th").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    spans = seen.select("doc_id", "th", "start", "length").distinct().withColumn("done", F.max(end).over(before))
    new = F.greatest(end - F.greatest(F.col("start"), F.coalesce("done", F.lit(0))), F.lit(0))
    hits = spans.groupBy("doc_id", "th").agg(F.sum(new).cast("long").alias("n_hit"))
    whose = (seen.select("doc_id", "th", "wid").distinct().join(small(owners), "wid").select("doc_id", "th", "item_ids").distinct()
             .groupBy("doc_id", "th").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids")))
    both = hits.join(whose, hits["doc_id"].eqNullSafe(whose["doc_id"]) & (hits["th"] == whose["th"])).select(hits["*"], whose["item_ids"])
    out = every.join(both, every["doc_id"].eqNullSafe(both["doc_id"]) & (every["th"] == both["th"]), "left")
    return out.select(every["*"], F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                      F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), F.col("n_hit").isNotNull().alias("contaminated"))


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    return judge(docs, items).select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                                     F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no window occurs."""
    bad = judge(docs, items).filter("contaminated").select(F.col("doc_id").alias("bad_id"), "th").distinct()
    return docs.join(small(bad, 1_000_000), docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs["text"]) == bad["th"]), "left_anti")


ORACLE = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
win as (select distinct item_id, least(len(w), 10) as n, array_to_string(w[i:i + 9], ' ') as g
        from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)),
sizes as (select distinct n from win),
dw as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as g
       from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n)),
hit as (select doc_id, item_id, i, n from dw join win using (n, g)),
c as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from (select distinct doc_id, i, n from hit)) group by 1),
o as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
      from hit group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
from d left join c using (doc_id) left join o using (doc_id)
"""
