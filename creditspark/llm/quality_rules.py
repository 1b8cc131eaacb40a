"""Quality rules with host-level verdicts, in DataFrame functions alone.

Every document's rule measures are computed inside its row (array functions over its words; no
shuffle).  Rule failures are then counted by host (partial aggregation, so a host with a third of all
rows costs one row per task), each host's failure rate is shrunk towards the corpus by a beta prior
fitted to all hosts by moments, and a host whose shrunk rate exceeds ``host_limit`` for any rule loses
all its documents.  The verdicts of rejected hosts join back to the documents.

Null texts count as empty.  A null host has no host verdict.  Repeated rows count as often as they
occur.  Columns besides ``doc_id``, ``text`` and the host are not read.  Windows are compared within one
document by a 64-bit hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditspark.llm.common import let, small, stored

BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 8
#: rule -> failed?  Over the measures of ``measure``.
RULES = {
    "short": "n_words < 20",
    "repeated": "100 * n_repeat_words > 30 * n_words",
    "symbols": "n_symbols > n_words",
    "lines": "2 * n_dup_lines > n_lines",
    "letters": "n_words > 0 and (word_chars < 2 * n_words or word_chars > 20 * n_words)",
}
BASE = ("short", "repeated")


def words_of(text: Column) -> Column:
    """Runs of characters other than blanks."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[ \t-\r]+"))


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words that lie in a window of ``width`` words that the text holds twice or more.

    Windows are hashed; only a text with equal hashes sorts them, keeps the places of equal
    neighbours and adds up what each place covers up to the next one.
    """
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - width),
                          lambda i: F.xxhash64(F.slice(words, i + 1, width)))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda v, k: F.least(F.lit(width), F.coalesce(F.get(places, k + 1) - v, F.lit(width))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def places(order: Column) -> Column:
        twice = F.filter(order, lambda x, k: F.coalesce(F.get(order, k - 1)["h"] == x["h"], F.lit(False))
                         | F.coalesce(F.get(order, k + 1)["h"] == x["h"], F.lit(False)))
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    def count(h: Column) -> Column:
        order = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), let(order, places)).otherwise(F.lit(0))

    return F.when(F.size(words) > width, let(windows, count)).otherwise(F.lit(0))


def measure(docs: DataFrame, host: str) -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words) per row."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    by_words = let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).cast("long").alias("n_repeat_words")))
    by_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"),
                                             (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    rows = docs.select("doc_id", F.col(host).alias("host"), by_words.alias("w"), by_lines.alias("l"),
                       F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"))
    return rows.select("doc_id", "host", "w.*", "l.*", "n_symbols")


def host_verdicts(measures: DataFrame, host_limit: float = 0.5) -> DataFrame:
    """(host, n_docs, <rule>_rate..., rejected): shrunk failure rates of every non-null host."""
    fails = measures.filter("host is not null").groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), *[F.count_if(F.expr(rule)).alias(f"f_{name}") for name, rule in RULES.items()])
    fails = stored(fails, "host-rules")
    total = fails.agg(F.sum("n_docs").alias("n"), *[F.sum(f"f_{r}").alias(r) for r in RULES]).first()
    mean = {r: (total[r] / total["n"] if total["n"] else 0.0) for r in RULES}
    spread = fails.agg(*[(F.try_divide(F.sum(F.col("n_docs") * F.pow(F.col(f"f_{r}") / F.col("n_docs") - mean[r], 2)), F.sum("n_docs"))).alias(r)
                         for r in RULES]).first()
    out = [F.col("host"), F.col("n_docs")]
    for r in RULES:
        m, v = mean[r], spread[r] or 0.0
        strength = min(max(m * (1 - m) / v - 1, 1.0), 1e6) if v > 0 else 1e6
        out.append(((F.col(f"f_{r}") + m * strength) / (F.col("n_docs") + strength)).alias(f"{r}_rate"))
    return fails.select(out).withColumn("rejected", F.greatest(*[F.col(f"{r}_rate") for r in RULES]) > host_limit)


def judge(docs: DataFrame, host: str = "source", host_limit: float = 0.5) -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` for every row."""
    m = stored(measure(docs, host), "rules")
    bad = host_verdicts(m, host_limit).filter("rejected").select("host", F.lit(True).alias("host_rejected"))
    base = " or ".join(f"({RULES[r]})" for r in BASE)
    return (m.join(small(bad), "host", "left").withColumn("base_failed", F.expr(base))
            .withColumn("kept", ~F.col("base_failed") & F.col("host_rejected").isNull()))


def report(docs: DataFrame) -> DataFrame:
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE = r"""
with d as (
    select doc_id, source, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
    from documents),
win as (
    select doc_id, i, array_to_string(w[i:i + 7], ' ') as g
    from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from d where len(w) >= 8)),
rep as (select doc_id, count(distinct p) as n_repeat_words from (
    select doc_id, unnest(range(i, i + 8)) as p
    from (select doc_id, i, count(*) over (partition by doc_id, g) as c from win) where c > 1) group by 1),
m as (
    select doc_id, source, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols, len(l)::bigint as n_lines,
           (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words
    from d left join rep using (doc_id)),
f as (
    select *, n_words < 20 as r1, 100 * n_repeat_words > 30 * n_words as r2, n_symbols > n_words as r3,
           2 * n_dup_lines > n_lines as r4, n_words > 0 and (word_chars < 2 * n_words or word_chars > 20 * n_words) as r5
    from m),
h as (
    select source, r, count(*) as n, count(*) filter (x) as c
    from (select source, unnest([1, 2, 3, 4, 5]) as r, unnest([r1, r2, r3, r4, r5]) as x from f where source is not null) group by 1, 2),
a as (select r, sum(c) / sum(n) as mean from h group by 1),
v as (select r, mean, sum(n * power(c / n - mean, 2)) / sum(n) as var from h join a using (r) group by 1, 2),
s as (select r, mean, case when var > 0 then least(greatest(mean * (1 - mean) / var - 1, 1), 1e6) else 1e6 end as k from v),
bad as (select distinct source from h join s using (r) where (c + mean * k) / (n + k) > 0.5)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, r1 or r2 as base_failed,
       not (r1 or r2) and bad.source is null as kept
from f left join bad on f.source = bad.source
"""
