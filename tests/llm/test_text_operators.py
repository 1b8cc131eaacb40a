import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from creditspark.llm import decontam, jaccard_join, pii, pseudo_likelihood, quality_classifier, quality_rules, substring_dedup
from creditspark.llm.shingles import shingle_sets

from . import brute
from .conftest import frame, odd_rows

ITEMS = [(1, " ".join(odd_rows()[22][1].split()[35:60])), (2, "one"), (3, None), (4, "... !!"), (None, "the end"), (10, "The END"),
         (11, " ".join(odd_rows()[40][1].split()[:7])), (12, " ".join(odd_rows()[40][1].split()[:7])), (1, "word word word word word word word word word word word")]


def items(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, words string")


def test_decontamination_against_brute_force(spark, odd):
    want = Counter((d, n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), hit > 0) for d, n, hit, ids in brute.decontaminate(odd_rows(), ITEMS))
    assert Counter(tuple(r) for r in decontam.report(odd, items(spark)).collect()) == want


def test_decontamination_joined_by_a_shuffle(spark, odd, monkeypatch):
    monkeypatch.setattr(decontam, "small", lambda df, most=0: df)
    want = Counter((d, n, hit) for d, n, hit, _ in brute.decontaminate(odd_rows(), ITEMS))
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"]) for r in decontam.report(odd, items(spark)).collect()) == want


def test_decontamination_of_nothing(spark, odd, empty):
    assert decontam.report(empty, items(spark)).count() == 0
    got = decontam.report(odd, items(spark).limit(0)).collect()
    assert len(got) == len(odd_rows()) and not any(r["contaminated"] for r in got)


def test_clean_documents_keep_all_columns(spark, odd):
    got = decontam.clean_documents(odd, items(spark))
    assert got.columns == odd.columns
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter(
        (d, t) for (d, t), x in zip(odd_rows(), brute.decontaminate(odd_rows(), ITEMS)) if not x[2])


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80), (1, 50)])
def test_components_against_all_pairs(odd, k, percent):
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(odd, k, percent).collect())
    assert got == brute.jaccard_components(odd_rows(), k, percent)


def test_components_of_large_families(spark, monkeypatch):
    """Families of near copies, some linked only through others; few common shingles known."""
    monkeypatch.setattr(jaccard_join, "COMMON", 16)
    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for f in range(6):
        w = [r.choice(vocabulary) for _ in range(r.choice([4, 40, 90]))]
        for _ in range(40):
            if r.random() < .8:
                w = list(w)
                w[r.randrange(len(w))] = r.choice(vocabulary)
            rows.append((len(rows), " ".join(w)))
    r.shuffle(rows)
    got = Counter((x["doc_id"], x["n_shingles"], x["component_id"]) for x in jaccard_join.near_duplicates(frame(spark, rows).repartition(4), 3, 80).collect())
    assert got == brute.jaccard_components(rows, 3, 80)


def test_prefix_and_bitmap_bounds_lose_no_pair():
    r = random.Random(5)
    for _ in range(400):
        base = [r.randrange(-2**62, 2**62) for _ in range(r.randint(1, 60))]
        a, b = ({x for x in base if r.random() > .08} | {r.randrange(2**62) for _ in range(r.randrange(4))} for _ in range(2))
        if not a or not b:
            continue
        both = len(a & b)
        if 100 * both < 80 * (len(a) + len(b) - both):
            continue
        common = np.array(sorted(r.sample(base, len(base) // 3)), np.int64)
        rank = np.array(r.sample(range(len(common)), len(common)))
        x, y = (jaccard_join.ordered(np.array(sorted(s), np.int64), common, rank)[:jaccard_join.prefix_size(len(s), 80)].tolist() for s in (a, b))
        assert set(x) & set(y)
        assert jaccard_join.most_shared(np.array(x), len(a), np.array(y), len(b), common, rank) >= both
        odd = sum(bin(int(p) & (2**64 - 1) ^ int(q) & (2**64 - 1)).count("1") for p, q in zip(*(jaccard_join.parities(np.array(sorted(s), np.int64)) for s in (a, b))))
        assert odd <= len(a ^ b)


def test_shingle_sets_are_those_of_words():
    texts = [t for _, t in odd_rows()]
    for k in (1, 3, 5):
        assert [len(s) for s in shingle_sets(pa.array(texts), k)] == [len(brute.shingle_set(t, k)) for t in texts]


def test_keep_one(spark, odd, empty):
    got = jaccard_join.keep_one(odd)
    assert got.columns == odd.columns
    kept = Counter((r["doc_id"], r["text"]) for r in got.collect())
    parts = brute.jaccard_components(odd_rows(), 5, 80)
    assert {d for d, n, c in parts if n and c is not None and d == c} <= {d for d, _ in kept}
    assert not {d for d, _ in kept if d is not None} & {d for d, n, c in parts if n and d is not None and d != c and (d, n, d) not in parts}
    assert kept[(51, "same row")] == 1 and kept[(3, " \t\n ")] == 1 and kept[(None, None)] == 1
    assert jaccard_join.keep_one(empty).count() == 0 and jaccard_join.report(empty).count() == 0


def test_pii_against_patterns(odd, empty):
    r = random.Random(1)
    for _ in range(20_000):
        alphabet = r.choice(["a1@.+ -", "12.345 ", "0123456789 -", "+1 ().-9a", "é1.2@b+ -(\n"])
        text = "".join(r.choice(alphabet) for _ in range(r.randrange(60)))
        assert [x for x in pii.find(text) if x[0] in pii.BASE] == brute.pii_base(text, pii.luhn), text
    want = Counter()
    for d, t in odd_rows():
        base = brute.pii_base(t, pii.luhn)
        n = Counter(k for k, *_ in base)
        want[(d, *[n[k] for k in pii.BASE], pii.digest(base), ",".join(f"{k}:{s}:{e}" for k, s, e in pii.find(t)))] += 1
    assert Counter(tuple(x) for x in pii.report(odd).collect()) == want
    assert pii.report(empty).count() == 0


@pytest.mark.parametrize("text,kind,found", [
    ("IBAN: GB82 WEST 1234 5698 7654 32 is", "account", "GB82 WEST 1234 5698 7654 32"), ("iban GB82 WEST 1234 5698 7654 33", "account", None),
    ("account no. 1234567 ok", "account", "1234567"), ("on account of 12", "account", None), ('token = "24be64439e3e"', "secret", "24be64439e3e"),
    ("the token ring", "secret", None), ("https://joe:pw1@host.org/x y", "url", "https://joe:pw1@host.org/x"), ("https://host.org/@x", "url", None)])
def test_added_kinds(text, kind, found):
    assert [text[s:e] for k, s, e in pii.find(text) if k == kind] == ([found] if found else [])


def test_redaction(odd):
    got = {(r["doc_id"], r["text"]): r for r in pii.redact_documents(odd).collect()}
    texts = [t for d, t in got if d == 200]
    assert texts == ["mail [EMAIL], [IP], [CARD] and [PHONE].\nmail [EMAIL]"]
    assert all(r["n_chars"] == len(t) for (_, t), r in got.items() if t is not None)
    assert (1, None) in got and pii.redact_documents(odd).columns == odd.columns


def test_rules_against_brute_force(odd, empty):
    want = Counter()
    for d, t in odd_rows():
        m = brute.rules(t)
        bad = m[0] < 20 or 100 * m[4] > 30 * m[0]
        want[(d, *m, bad)] += 1
    got = quality_rules.report(odd).collect()
    assert Counter(tuple(r)[:7] for r in got) == want
    assert not any(r["kept"] and r["base_failed"] for r in got)
    assert quality_rules.report(empty).count() == 0


def test_hosts_are_judged_by_shrunk_rates(spark):
    good = " ".join(f"w{i}" for i in range(40))
    rows = [(i, good if i % 10 else "short", "fine") for i in range(300)] + [(1000 + i, "short" if i % 10 else good, "bad") for i in range(300)]
    rows += [(2000, "short", "new"), (2001, good, "new"), (2002, good, None)]
    docs = spark.createDataFrame([(i, t + f" {i}", h) for i, t, h in rows], "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.report(docs).collect()}
    assert all(kept[i] == bool(i % 10) for i in range(300)) and not any(kept[1000 + i] for i in range(300))
    assert kept[2001] and kept[2002] and not kept[2000]


def test_chunks_are_cut_by_content():
    r = random.Random(6)
    text = "".join(r.choice("abcdefgh é ") for _ in range(4000)).encode()
    ends = substring_dedup.cuts(text)
    assert ends[-1] == len(text) and (np.diff(ends) > 0).all()
    shifted = {int(e) - 7 for e in substring_dedup.cuts(b"shift! " + text)}
    assert len(set(ends.tolist()) - shifted) <= 1
    for e in ends:
        text[:e].decode()


def test_repeated_passages(spark, odd, empty):
    got = {(r["doc_id"], r["n_repeats"]): r for r in substring_dedup.report(odd).collect()}
    texts = dict(odd_rows())
    passage = " ".join(odd_rows()[22][1].split()[30:100])
    for k in range(40, 46):
        r = next(r for (d, _), r in got.items() if d == k)
        spans = [tuple(map(int, s.split(":"))) for s in r["passages"].split(",")]
        covered = sum(max(0, min(e, texts[k].index(passage) + len(passage)) - max(s, texts[k].index(passage))) for s, e in spans)
        assert covered >= .6 * len(passage)
        assert bool(r["removable"]) == (k != 40)
    for d, n in got:
        assert n == 0 or d in range(20, 46) or d in (51, 53, 52, 202, 203)
    assert substring_dedup.report(empty).count() == 0
    assert sum(1 for d, _ in got if d is None) == 1 or (None, 0) in got


def test_runs_of_chunks():
    found = [(0, 60, 1, False), (60, 60, 2, True), (120, 60, 1, True), (300, 50, 3, True), (400, 120, 4, True), (520, 100, 9, False)]
    assert substring_dedup.merge(found, 100) == ([(0, 180), (400, 620)], [(60, 180), (400, 520)])


def test_label_model_finds_accuracies():
    r = np.random.default_rng(1)
    truth = r.choice(3, 20_000, p=[.8, .13, .07])
    votes = np.full((len(truth), 5), -1)
    right = [.95, .9, .85, .9, .7]
    for j, p in enumerate(right):
        cast = r.random(len(truth)) < .7
        wrong = (truth + r.integers(1, 3, len(truth))) % 3
        votes[cast, j] = np.where(r.random(len(truth)) < p, truth, wrong)[cast]
    p, n = np.unique(quality_classifier.pattern(votes), return_counts=True)
    post, share, table = quality_classifier.expectation_maximisation(quality_classifier.unpattern(p, 5), n.astype(float))
    assert np.abs(share - [.8, .13, .07]).max() < .03
    for j, q in enumerate(right):
        assert abs(table[j, 0, 1] / table[j, 0, 1:].sum() - q) < .05
    guess = dict(zip(p, post.argmax(axis=1)))
    assert np.mean([guess[x] == t for x, t in zip(quality_classifier.pattern(votes), truth)]) > .95


def test_classifier_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    fit, rest = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1").toPandas()
    kept = quality_classifier.report(docs, fit).toPandas().merge(rest, on="doc_id")
    assert kept[(kept.quality == 1) & (kept.toxic == 0)].kept.mean() > .97
    assert kept[kept.quality == 0].kept.mean() < .1


def test_classifier_edges(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (20, 1, 0), (203, 1, 1), (None, 0, 1)], "doc_id long, quality int, toxic int")
    got = quality_classifier.report(odd, labels).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, _ in odd_rows())
    assert not any(r["kept"] for r in got if r["doc_id"] == 202)
    assert quality_classifier.report(empty, labels).count() == 0 and quality_classifier.keep_good(empty, labels).count() == 0
    assert quality_classifier.report(odd, labels.limit(0)).count() == len(odd_rows())
    kept = quality_classifier.keep_good(odd, labels)
    assert kept.columns == odd.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in got if r["kept"])


def test_pseudo_likelihood_orders_texts(spark):
    r = random.Random(7)
    follow = {f"a{i}": [f"a{(3 * i + k) % 40}" for k in (1, 2)] for i in range(40)}

    def walk(n):
        w = ["a0"]
        while len(w) < n:
            w.append(r.choice(follow[w[-1]]))
        return w

    rows = [(i, " ".join(walk(120))) for i in range(400)]
    test = [walk(100) for _ in range(30)]
    mixed = [r.sample(w, len(w)) for w in test]
    rows += [(1000 + i, " ".join(w)) for i, w in enumerate(test)] + [(2000 + i, " ".join(w)) for i, w in enumerate(mixed)]
    got = {x["doc_id"]: x["mean_log_likelihood"] for x in pseudo_likelihood.report(frame(spark, rows).repartition(2)).collect()}
    assert np.mean([got[1000 + i] > got[2000 + i] for i in range(30)]) > .95


def test_pseudo_likelihood_edges(odd, empty):
    got = pseudo_likelihood.report(odd).collect()
    assert Counter((r["doc_id"], r["n_words"]) for r in got) == Counter((d, len(brute.words(t))) for d, t in odd_rows())
    assert all((r["mean_log_likelihood"] is None) == (r["n_words"] == 0) and r["log_likelihood"] <= 0 for r in got)
    assert pseudo_likelihood.report(empty).count() == 0
