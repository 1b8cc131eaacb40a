import random
import zlib
from collections import Counter, defaultdict

import pytest

from creditspark.llm import packing, queries, sharding, url_filter

from .brute import url
from .conftest import frame, odd_rows

URLS = [None, "", "no scheme", "http://", "http://Example.COM", "http://example.com/", "https://www.EXAMPLE.com/en/x?y#z", "http://example.com/en/1",
        "http://a.b.net/es/1", "http://net/fr/", "http://netx/fr/", "http://xcom/", "a://b://c.com/d", "http://x.com?q=/en/", "ftp://x.com#/", "http://u:p@h.com:80/en/\nx", "http://.com/", "http://com./"]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(i % 15, u, "x", "y", "z") for i, u in enumerate(URLS)], "page_id long, url string, html string, rule string, host string")


def test_urls_by_the_rules(pages):
    got = Counter(tuple(r) for r in url_filter.report(pages).collect())
    assert got == Counter((i % 15, *url(u)) for i, u in enumerate(URLS))


def test_urls_empty_table_and_list(spark, pages):
    assert url_filter.report(pages.limit(0)).count() == 0
    none = url_filter.judge(pages, spark.createDataFrame([], "rule string, verdict string"), default="block")
    assert {(r["rule"], r["verdict"]) for r in none.collect()} == {(None, "block")}


def test_long_list_in_several_files(spark, monkeypatch):
    r = random.Random(2)
    listed = [(f"h{r.randrange(400)}.org", "/" + "ab"[:r.randrange(3)], r.choice(["allow", "block"])) for _ in range(600)]
    listed = list({(h, p): (h, p, v) for h, p, v in listed}.values())
    monkeypatch.setattr(url_filter, "FILE_ROWS", 50)
    rules = spark.createDataFrame([(h + p, v) for h, p, v in listed] + [(None, "block"), ("x/", None)], "rule string, verdict string")
    urls = [f"http://{r.choice(['', 'www.'])}h{r.randrange(500)}.org/{r.choice(['', 'a', 'ab', 'b'])}" for _ in range(500)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {row["page_id"]: tuple(row)[1:] for row in url_filter.judge(pages, rules).collect()}
    assert got == {i: url(u, listed) for i, u in enumerate(urls)}


def test_colliding_digests_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda s: 7)
    import pyarrow as pa
    a = url_filter.DigestArray.__new__(url_filter.DigestArray)
    import numpy as np
    a.digests, a.rules, a.verdicts = np.array([7, 7, 7]), pa.array(["a/", "b/", "c/"]), pa.array(["allow", "block", "allow"])
    assert list(a.probe(["b/", "z/"], np.array([7, 7]))) == [(0, "block")]


def test_pieces_hold_every_id_once(spark, odd):
    path = packing.word_tokenizer_path()
    tok = packing.WordIds(path).tok
    want = Counter()
    for d, t in odd_rows():
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        want[(d, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))] += 1
    rows = packing.pack(odd).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] and r["length"] > 0
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[(r["doc_id"], r["doc_tokens"])].append((r["start"], bytes(r["ids"])))
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= packing.SIZE
    got = Counter()
    for (d, n), own in pieces.items():
        if n * sum(1 for k in want if k[:2] == (d, n)) and len({x for x in want if x[:2] == (d, n)}) == 1 and want[next(x for x in want if x[:2] == (d, n))] == 1:
            whole = b"".join(ids for _, ids in sorted(own))
            got[(d, n, zlib.crc32(whole))] += 1
    assert len(got) > 50 and all(k in want for k in got)
    assert sum(r["length"] for r in rows) == sum(k[1] * c for k, c in want.items())
    room = sum(4096 - sum(n for _, n in s) for s in sequences.values())
    assert room <= 4096 * 4  # one open sequence for each task


def test_packing_of_nothing(empty):
    assert packing.report(empty).count() == 0


def test_first_fit_decreasing_against_a_plain_loop():
    r = random.Random(1)
    for _ in range(60):
        lengths = sorted((r.randint(1, 100) for _ in range(r.randrange(80))), reverse=True)
        fit, rooms = packing.FirstFit(100), []
        for n in lengths:
            b = next((i for i, room in enumerate(rooms) if room >= n), len(rooms))
            if b == len(rooms):
                rooms.append(100)
            rooms[b] -= n
            assert fit.put(n) == b
        assert fit.room() == rooms


def test_fill_cuts_to_close_room():
    r = random.Random(1)
    for _ in range(60):
        lengths = [r.randint(1, 100) for _ in range(r.randrange(1, 90))]
        bins = packing.fill(lengths, 100)
        seen = defaultdict(list)
        for b in bins:
            assert 0 < sum(n for *_, n in b) <= 100
            for i, at, n in b:
                seen[i].append((at, n))
        for i, n in enumerate(lengths):
            at = 0
            for a, k in sorted(seen[i]):
                assert a == at
                at += k
            assert at == n
        assert len(bins) == -(-sum(lengths) // 100)


def test_shards_are_even_and_slots_gapless(spark):
    r = random.Random(3)
    rows = [(i, "x" * r.randint(1, 300) + str(r.randrange(2000))) for i in range(3000)] + [(5000 + i, "copy " * 40) for i in range(1500)]
    rows += [(d, t) for d, t in odd_rows() if d != 52]  # that text alone is larger than a shard
    got = sharding.report(frame(spark, rows, ["digest", "size", "shard"])).collect()
    assert Counter((x["doc_id"], x["size"], x["text_crc32"]) for x in got) == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    sizes, slots = Counter(), defaultdict(set)
    for x in got:
        sizes[x["shard"]] += x["size"]
        slots[x["shard"]].add(x["slot"])
    assert all(s == set(range(len(s))) for s in slots.values()) and sum(map(len, slots.values())) == len(rows)
    assert set(sizes) == set(range(16)) and max(sizes.values()) <= 1.02 * min(sizes.values()), sizes


def test_equal_texts_share_a_shard(spark):
    rows = [(i, f"text number {i // 3} " * (1 + i % 2 * 0)) for i in range(900)]
    got = defaultdict(set)
    texts = dict(rows)
    for x in sharding.shard(frame(spark, rows)).collect():
        got[texts[x["doc_id"]]].add(x["shard"])
    assert all(len(s) == 1 for s in got.values())


def test_sharding_of_nothing(empty):
    assert sharding.report(empty).count() == 0


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 11))
