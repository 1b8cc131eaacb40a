import random
from collections import Counter
from math import exp, log

import numpy as np
import pytest

from creditspark.llm import pseudo_likelihood

from .conftest import frame


def walks(r, n_words, n_docs, length):
    """Texts in which each word has two followers."""
    out = []
    for _ in range(n_docs):
        w = [r.randrange(n_words)]
        while len(w) < length:
            w.append((3 * w[-1] + r.choice((1, 2))) % n_words)
        out.append([f"a{i}" for i in w])
    return out


def means(df):
    return {x["doc_id"]: x["mean_log_likelihood"] for x in pseudo_likelihood.report(df).collect()}


def unigram(texts):
    n = Counter(w for t in texts for w in t)
    total = sum(n.values())
    return sum(k * log(k / total) for k in n.values()) / total


def test_context_counts_for_thousands_of_words(spark):
    r = random.Random(3)
    texts = walks(r, 2000, 3000, 100)
    mixed = [r.sample(w, len(w)) for w in texts[:100]]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)] + [(10_000 + i, " ".join(w)) for i, w in enumerate(mixed)]
    got = means(frame(spark, rows).repartition(2))
    assert np.mean([got[i] > got[10_000 + i] + .2 for i in range(100)]) > .95
    assert np.mean([got[i] for i in range(3000)]) > unigram(texts) + .5


def test_partitions_do_not_change_the_model(spark, monkeypatch):
    """1, 4 and 40 partitions, with sums of two blocks at a time: the same scores."""
    monkeypatch.setattr(pseudo_likelihood, "FAN", 2)
    texts = walks(random.Random(4), 300, 2000, 60)
    rows = frame(spark, [(i, " ".join(w)) for i, w in enumerate(texts)])
    got = [means(rows.repartition(n)) for n in (1, 4, 40)]
    for other in got[1:]:
        assert max(abs(got[0][i] - other[i]) for i in got[0]) < 1e-3
    assert np.mean(list(got[0].values())) > unigram(texts) + .5


def test_training_passes_against_plain_sums(spark):
    """The pair counts by hand, and the gains' slopes against differences of the log-likelihood."""
    r = random.Random(7)
    texts = walks(r, 60, 50, 30) + [["a1"], []]
    rows = frame(spark, [(i, " ".join(w)) for i, w in enumerate(texts)]).repartition(3)
    v, _, total = pseudo_likelihood.vocabulary_of(pseudo_likelihood.count_words(rows))
    docs = pseudo_likelihood.encoded(rows, v)
    counts = pseudo_likelihood.count_pairs(docs, v)
    want = [Counter() for _ in v.tables()]
    leaves = [np.frombuffer(x["leaves"], v.kind).tolist() for x in docs.select("leaves").collect()]
    w = v.width
    for own in leaves:
        for i, t in enumerate(own):
            path = (t % w, t // w % w, t // w // w)
            for (level, p, _), n in zip(v.tables(), want):
                u = own[i + p] if 0 <= i + p < len(own) else None
                row = (v.size if u is None else u, (t % w) * (w * w + 1) + (w * w if u is None else u % (w * w)), (t % (w * w)) * (w + 1) + (w if u is None else u % w))[level]
                n[row * w + path[level]] += 1
    for n, x in zip(want, counts):
        assert {int(i): int(x[i]) for i in np.flatnonzero(x)} == dict(n)
    net = pseudo_likelihood.Network(v, counts)
    at = np.cumsum([0, *map(len, leaves)])
    row, place = pseudo_likelihood.around(np.array([x for own in leaves for x in own], np.int32), at, v.size)
    before = pseudo_likelihood.log_likelihoods(net.whole(v), v, row, place).sum()
    slopes = net.slopes(v, row, place)
    assert before == pytest.approx(sum(x[0] for x in slopes), rel=1e-5)
    for level, x in enumerate(slopes):
        for i in range(len(pseudo_likelihood.PLACES[level])):
            both = []
            for e in (.01, -.01):
                net.gains[level][i] += e
                both.append(pseudo_likelihood.log_likelihoods(net.whole(v), v, row, place).sum())
                net.gains[level][i] -= e
            k = len(pseudo_likelihood.PLACES[level])
            assert (both[0] - both[1]) / .02 == pytest.approx(x[1 + i], rel=.02, abs=.5)
            assert (2 * before - both[0] - both[1]) / 1e-4 == pytest.approx(x[1 + k:].reshape(k, k)[i, i], rel=.1, abs=20)
    net.improve(slopes)
    assert pseudo_likelihood.log_likelihoods(net.whole(v), v, row, place).sum() > before


@pytest.mark.parametrize("head", [1 << 15, 500])
def test_every_word_has_its_own_probability(spark, monkeypatch, head):
    monkeypatch.setattr(pseudo_likelihood, "HEAD", head)
    monkeypatch.setattr(pseudo_likelihood, "WIDTH", 1)
    words = [f"w{i}" for i in range(6000)]
    rows = [(i, w) for i, w in enumerate(words) for _ in range(1 + i % 3 + 40 * (i < 400))]
    got = means(frame(spark, rows).repartition(3))
    # one-word texts all have the same context: their probabilities add up to 1
    assert sum(exp(x) for x in got.values()) == pytest.approx(1, abs=1e-3)
    if head == 500:
        v, least, total = pseudo_likelihood.vocabulary_of(pseudo_likelihood.count_words(frame(spark, rows)))
        assert (len(v.words), least, total) == (400, 41, len(rows))
        leaf = {}
        for i in range(400, 6000):
            at = int(v.encode(pseudo_likelihood.word_hashes(pseudo_likelihood.pa.array([words[i]]))[0])[0][0])
            leaf.setdefault(at, []).append(got[i] - log(1 + i % 3))
        assert all(max(x) - min(x) < 1e-4 for x in leaf.values())


def test_words_of_short_texts_are_trained(spark):
    r = random.Random(5)
    texts = [[f"a{k}", f"b{k}"] for k in (r.randrange(40) for _ in range(60_000))]
    got = means(frame(spark, [(i, " ".join(t)) for i, t in enumerate(texts)]).repartition(2))
    assert np.mean(list(got.values())) > unigram(texts) + .2
