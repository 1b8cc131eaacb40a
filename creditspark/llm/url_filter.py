"""URL filter over a sorted digest array.

A list of rules (host suffix and path prefix, ``block`` or ``allow``) is hashed with 64-bit xxhash,
range-partitioned and sorted by digest with Spark, and written to the shared folder.  Spark ships those
files to every executor once (``addFile``); there a worker lays digests and strings out as one flat sorted
file which all workers of the executor memory-map, so a list costs page cache, not heap.

A URL's candidate keys are its host and each parent domain, each with the path cut to every length that
a rule's path has.  Keys of a whole batch are hashed and probed together by binary search; each
digest hit is confirmed against the rule's stored string, so a collision cannot decide.  The longest
rule wins (equal length: the longer host, then a block).  A URL that no rule fits gets ``default``.

A null URL, or one without ``://``, has an empty host and path, which no rule fits.  Null rules are left
out; of a rule listed twice with different verdicts, ``block`` holds.  Repeated rows get equal results;
columns besides the key and the URL are not read.  An empty list gives every URL ``default``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditspark.llm.common import ascii_lower
from creditspark.session import scratch_path

#: Rows of one index file; a list of any length is cut into as many files as it takes.
FILE_ROWS = 2_000_000


def host_and_path(url):
    """Columns (host, path): the host after the first ``://``, A-Z in lower case; the path up to ``?`` or ``#``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def build_index(rules: DataFrame) -> tuple[list[str], list[int], list[int]]:
    """Index files of ``rules`` (rule, verdict), known to all executors by these names, and the lengths of the rules' paths and hosts."""
    spark = rules.sparkSession

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [xxhash.xxh64_intdigest(r) for r in b.column(0).to_pylist()]
            # the order of signed and unsigned digests differs: sort as signed, search as signed
            yield pa.RecordBatch.from_pydict({"digest": pa.array(np.array(keys, np.uint64).view(np.int64)), "rule": b.column(0), "verdict": b.column(1)})

    clean = (rules.filter("rule is not null and verdict is not null and instr(rule, '/') > 0")
             .groupBy("rule").agg(F.max("verdict").alias("verdict")))
    path = scratch_path(spark, "url-index")
    clean.mapInArrow(digest, "digest long, rule string, verdict string").write.parquet(path + "-raw")
    rows = spark.read.schema("digest long, rule string, verdict string").parquet(path + "-raw")
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.length("rule") - F.instr("rule", "/") + 1).alias("lengths"),
                     F.collect_set(F.instr("rule", "/") - 1).alias("hosts")).first()
    files = -(-stats["n"] // FILE_ROWS) or 1
    rows.repartitionByRange(files, "digest").sortWithinPartitions("digest", "rule").write.parquet(path)
    found = spark.read.schema(rows.schema).parquet(path).inputFiles()
    for f in found:
        spark.sparkContext.addFile(f)
    return [os.path.basename(f) for f in found], sorted(stats["lengths"]), sorted(stats["hosts"])


class DigestArray:
    """One sorted index file, memory-mapped: digests are searched, strings read where a digest hits."""

    def __init__(self, name: str):
        source = SparkFiles.get(name)
        flat = f"{source}.arrow"
        if not os.path.exists(flat):
            table = pq.read_table(source).combine_chunks()
            own = f"{flat}.{uuid.uuid4().hex}"
            with pa.ipc.new_file(own, table.schema) as out:
                out.write_table(table)
            os.replace(own, flat)  # whichever worker is last: the files are equal
        table = pa.ipc.open_file(pa.memory_map(flat)).read_all().combine_chunks()
        # one record batch: these are views of the mapped file
        self.digests = table["digest"].chunk(0).to_numpy() if table.num_rows else np.zeros(0, np.int64)
        self.rules, self.verdicts = table["rule"], table["verdict"]

    def probe(self, keys: list[str], digests: np.ndarray) -> Iterator[tuple[int, str]]:
        """(key's place, verdict) of every key that is a rule."""
        at = np.searchsorted(self.digests, digests)
        hit = np.flatnonzero((at < len(self.digests)) & (np.take(self.digests, at, mode="clip") == digests))
        for k in hit.tolist():
            i = int(at[k])
            while i < len(self.digests) and self.digests[i] == digests[k]:  # colliding rules lie side by side
                if self.rules[i].as_py() == keys[k]:
                    yield k, self.verdicts[i].as_py()
                i += 1


@cache
def _array(name: str) -> DigestArray:
    return DigestArray(name)


def candidates(host: str, path: str, lengths: list[int], hosts: list[int]) -> list[str]:
    """The host and its parent domains of the given lengths, each with the path's beginnings of the given lengths."""
    out, n = [], len(host)
    for k in hosts:
        if 0 < k == n or 0 < k < n and host[n - k - 1] == ".":
            out += [host[n - k:] + path[:m] for m in lengths if m <= len(path)]
    return out


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """(key, host, path, rule, verdict) for every row; a narrow pass, whatever the list's size."""
    names, lengths, hosts = build_index(rules)
    host, path = host_and_path(F.col(url))
    kind = pages.schema[key].simpleString().replace(":", " ", 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = [_array(n) for n in names]
        for b in batches:
            owner, keys = [], []
            for r, (h, p) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                own = candidates(h, p, lengths, hosts)
                keys += own
                owner += [r] * len(own)
            digests = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys)).view(np.int64)
            best: dict[int, tuple] = {}
            for a in arrays:
                for k, verdict in a.probe(keys, digests):
                    rule = keys[k]
                    rank = (len(rule), rule.index("/"), verdict == "block", rule, verdict)
                    if rank > best.get(owner[k], (0,)):
                        best[owner[k]] = rank
            won = [best.get(r) for r in range(b.num_rows)]
            yield pa.RecordBatch.from_pydict({
                key: b.column(0), "host": b.column(1), "path": b.column(2),
                "rule": pa.array([w and w[3] for w in won], pa.string()),
                "verdict": pa.array([w[4] if w else default for w in won], pa.string())})

    return pages.select(key, host.alias("host"), path.alias("path")).mapInArrow(
        run, f"{kind}, host string, path string, rule string, verdict string")


#: fixed values: the rules of the query
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]


def report(pages: DataFrame) -> DataFrame:
    return judge(pages, pages.sparkSession.createDataFrame(RULES, "rule string, verdict string"))


ORACLE = r"""
with p as (select page_id, coalesce(case when url like '%://%' then substr(url, instr(url, '://') + 3) end, '') as rest from pages),
q as (select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from p),
rules(h, d, verdict) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                                ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fit as (select page_id, h || d as rule, verdict, row_number() over (partition by page_id order by length(h || d) desc) as k
        from q join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, d))
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from q left join (select * from fit where k = 1) using (page_id)
"""
