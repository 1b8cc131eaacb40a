import random

import pytest

from creditspark.llm import substring_dedup

from .conftest import frame


def spans(text):
    return [tuple(map(int, s.split(":"))) for s in text.split(",")] if text else []


def test_neighbouring_common_phrases_are_no_passage(spark):
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 8)))
    phrases = [" ".join(word() for _ in range(10)) for _ in range(40)]
    # each phrase occurs often, no two documents hold the same two in a row
    pairs = [(a, b) for a in range(40) for b in range(40) if a != b]
    r.shuffle(pairs)
    rows = [(i, f"{word()} {phrases[a]} {phrases[b]} {word()}") for i, (a, b) in enumerate(pairs[:400])]
    got = substring_dedup.report(frame(spark, rows)).collect()
    assert max(len(p) for p in phrases) < 100 and not any(x["n_repeats"] for x in got)


@pytest.mark.parametrize("variety", [1, 2, 5, 25, 400])
def test_shared_passages_are_found_whatever_their_variety(spark, variety):
    r = random.Random(variety)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(4, 7)))
    rows, where = [], {}
    for i in range(150):
        few = [word() for _ in range(variety)]
        passage = " ".join(r.choice(few) for _ in range(51))
        for side in range(2):
            before, after = (" ".join(word() for _ in range(30)) for _ in range(2))
            rows.append((2 * i + side, f"{before} {passage} {after}"))
            where[2 * i + side] = (len(before) + 1, len(before) + 1 + len(passage))
    got = {x["doc_id"]: x for x in substring_dedup.report(frame(spark, rows)).collect()}
    for d, (lo, hi) in where.items():
        found = spans(got[d]["passages"])
        assert found and all(lo - 4 <= s and e <= hi + 4 for s, e in found)  # contexts may share letters by chance
    assert all(got[d]["n_removable_chars"] > 0 for d in where if d % 2)


def test_overlapping_sequences():
    found = [(0, 110, 1, False), (20, 120, 2, True), (50, 130, 3, True), (300, 100, 4, True), (330, 110, 5, True)]
    assert substring_dedup.merge(found, 50) == ([(0, 180), (300, 440)], [(110, 180), (300, 440)])


def test_hot_and_rare_digests_give_the_same_passages(spark, monkeypatch):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 8)))
    hot, rare = (" ".join(word() for _ in range(60)) for _ in range(2))
    rows = [(i, f"{word()} {word()} {hot} {word()} {rare if i % 50 == 0 else word()} {word()}") for i in range(200)]
    rows += [(None, hot), (None, hot), (7, None), (8, "")]
    kept = []
    for least_share in (1, 4, 10**9):  # none listed, some, all
        monkeypatch.setattr(substring_dedup, "HOT", least_share)
        kept.append(sorted(map(str, substring_dedup.report(frame(spark, rows)).collect())))
    assert kept[0] == kept[1] == kept[2] and sum("n_repeats=0" not in x for x in kept[0]) == 202
    every = substring_dedup.sequences(frame(spark, rows)).groupBy("digest").count().filter("count > 1").collect()
    total = sum(x["count"] for x in every)
    assert not any(x["count"] >= total for x in every) and all(x["count"] * 10**9 >= total for x in every)


def test_recurring_sequences_against_plain_counts(spark):
    """Every sequence of the corpus counted as a string: passages are the unions of those that recur."""
    r = random.Random(6)
    words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(r.randint(2, 7))) for _ in range(60)]
    parts = [" ".join(r.choice(words) for _ in range(45)) for _ in range(12)]
    texts = [" ".join([r.choice(words), *(r.choice(parts) for _ in range(r.randint(0, 4))), *(r.choice(words) for _ in range(20))]) for _ in range(120)]
    own = []
    for t in texts:
        raw = t.encode()
        at = [0, *substring_dedup.cuts(raw).tolist()]
        chars = [len(raw[:a].decode()) for a in at]
        seqs = []
        for i, a in enumerate(chars):
            j = next((j for j in range(len(chars)) if chars[j] >= a + substring_dedup.LEAST), None)
            if j is not None:
                seqs.append((a, chars[j]))
        own.append(seqs)
    counts = {}
    for t, seqs in zip(texts, own):
        for a, b in seqs:
            counts[t[a:b]] = counts.get(t[a:b], 0) + 1
    got = {x["doc_id"]: spans(x["passages"]) for x in substring_dedup.report(frame(spark, list(enumerate(texts)))).collect()}
    for d, (t, seqs) in enumerate(zip(texts, own)):
        covered = [False] * (len(t) + 1)
        starts = set()
        for a, b in seqs:
            if counts[t[a:b]] > 1:
                starts.add(a)
                covered[a:b] = [True] * (b - a)
        want, i = [], 0
        while i < len(t):
            if covered[i]:
                j = i
                while covered[j]:
                    j += 1
                want.append((i, j))
                i = j
            i += 1
        assert got[d] == want
