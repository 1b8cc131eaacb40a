import random
from collections import Counter

import numpy as np
import pytest

from creditspark.llm import conversation_trie, minhash_dedup, token_alignment

from . import brute
from .conftest import frame, odd_rows

TALK = "conv_id long, turn long, role string, text string, d string, key string, seq string"


def talks():
    """Shared beginnings of many lengths, copies, ties, nulls, absent family heads, conversations without turns of their own."""
    r = random.Random(3)
    said = [("user", f"word {i} " * r.randint(0, 3)) for i in range(6)] + [(None, None), ("", ""), ("assistant", "é \t x")]
    rows = [(None, 1, "user", "nobody"), (7, None, "user", "first"), (7, None, "user", "also first"), (7, 3, "user", "third"), (7, 3, "user", "third"), (-13, 1, "user", "minus")]
    for c in range(20, 140):
        if c in (40, 60):
            continue
        opening = [said[0]] * 5 if c % 3 else []
        own = opening + [said[r.randrange(len(said))] for _ in range(r.randint(0 if opening else 1, 6))]
        rows += [(c, t * 2, role, text) for t, (role, text) in enumerate(own)]
    for c in range(1000, 1400):  # copies
        rows += [(c, t, "user", "the same") for t in range(4)]
    r.shuffle(rows)
    return rows


def talk_frame(spark, rows):
    return spark.createDataFrame([(*x, "x", "y", "z") for x in rows], TALK)


@pytest.mark.parametrize("shard", [1, 5, 1000])
def test_trie_against_brute_force(spark, shard):
    conv = talk_frame(spark, talks()).repartition(5)
    got = conversation_trie.trie(conversation_trie.rebuilt(conversation_trie.sequences(conv)), shard)
    assert Counter(map(tuple, got.collect())) == Counter(brute.trie(talks()))


def test_trie_of_small_pieces_and_of_nothing(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "PIECE", 3)
    got = conversation_trie.report(talk_frame(spark, talks()))
    assert Counter(map(tuple, got.collect())) == Counter(brute.trie(talks()))
    assert conversation_trie.report(talk_frame(spark, [])).count() == 0


def test_double_array_holds_exactly_its_sequences():
    r = random.Random(5)
    seqs = sorted({tuple(r.randrange(r.choice([3, 200])) for _ in range(r.randint(0, 6))) for _ in range(500)})
    codes = np.array([c for s in seqs for c in s], np.int64)
    trie, levels = conversation_trie.pack(codes, np.cumsum([0, *map(len, seqs)]))
    prefixes = {s[:d] for s in seqs for d in range(len(s) + 1)}
    assert sum(map(len, levels)) == len(prefixes) == (trie.check >= 0).sum()
    state = {(): 0}
    for p in sorted(prefixes, key=len):
        for c in range(200):
            t = int(trie.step(np.array([state[p]]), np.array([c]))[0])
            assert (t >= 0) == ((*p, c) in prefixes)
            if t >= 0:
                state[(*p, c)] = t
    assert len(set(state.values())) == len(prefixes)


def coders():
    import public_tokenizers
    return token_alignment._coders(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def alignment_rows():
    r = random.Random(6)
    letters = "abcdeth ,.\n\t  ▁é中🙂 　'1234567<|>\x00́"
    odd = ["", None, " ", "  ", " a", "a ", "a  b", "x\n\n y \t\nz", "▁", "a▁b", "<0x41> <s> </s> <unk>", "say <|endoftext|> now", "it's we'll 'tis", "​﻿", "é" * 40, "don't  stop\r\n"]
    rows = [(i, t) for i, t in enumerate(odd)] + [(100 + i, "".join(r.choice(letters) for _ in range(r.randint(1, 60)))) for i in range(150)]
    return rows + [(None, "no id here"), (5, "same row"), (5, "same row")] + [(i, t and t[:3000]) for i, t in odd_rows() if i != 53]


def plain_alignment(rows):
    a, b = coders()
    byte = token_alignment._byte_of()
    assert sorted(byte.values()) == list(range(256))
    whole_a = lambda t: a.tok.encode(f" {t}", add_special_tokens=False).ids
    b_bytes = lambda i: bytes([int(b.sp.id_to_piece(i)[3:5], 16)]) if b.sp.is_byte(i) else b.sp.id_to_piece(i).replace("▁", " ").encode()
    a_bytes = lambda i: b"<|endoftext|>" if i == 50256 else bytes(byte[c] for c in a.tok.id_to_token(i))
    return brute.token_alignment(rows, whole_a, b.sp.encode, a_bytes, b_bytes)


@pytest.mark.parametrize("part,block", [(1, 1), (1 << 30, 1 << 22)])
def test_alignment_against_brute_force(spark, monkeypatch, part, block):
    monkeypatch.setattr(token_alignment, "BLOCK", block)
    rows = alignment_rows()
    got = token_alignment.aligned(frame(spark, rows, ["part", "pair", "docs", "n", "block"]).repartition(3), part=part)
    cols = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert Counter(tuple(r[c] for c in cols) for r in got.collect()) == Counter(plain_alignment(rows))


def test_alignment_of_nothing(spark, empty):
    assert token_alignment.report(empty).count() == 0
    got = token_alignment.report(frame(spark, [(1, None), (2, "")])).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_pieces_are_encoded_like_whole_texts():
    """Neither tokenizer looks across a single space."""
    a, b = coders()
    assert b.parted
    for _, t in alignment_rows():
        if not t or "  " in t or t[0] == " " or t[-1] == " " or "▁" in t:
            continue
        for coder in (a, b):
            assert coder.encode([t])[0] == [i for own in coder.encode(t.split(" ")) for i in own], t


@pytest.mark.parametrize("k,percent", [(5, 85), (3, 90), (5, 80)])
def test_minhash_components_against_all_pairs(odd, k, percent):
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in minhash_dedup.near_duplicates(odd, k, percent).collect())
    assert got == brute.jaccard_components(odd_rows(), k, percent)


def test_minhash_families_and_shared_passages(spark, monkeypatch):
    """Chains of near copies, and documents of which most is one common passage; several turns of centres."""
    monkeypatch.setattr(minhash_dedup, "MANY_PAIRS", 1)
    r = random.Random(9)
    vocabulary = [f"v{i}" for i in range(500)]
    rows = []
    for f in range(5):
        w = [r.choice(vocabulary) for _ in range(90)]
        for i in range(40):
            w = list(w)
            w[r.randrange(90)] = r.choice(vocabulary)
            rows.append((f * 100 + i, " ".join(w)))
    passage = " ".join(r.choice(vocabulary) for _ in range(60))
    rows += [(1000 + i, passage + " " + " ".join(r.choice(vocabulary) for _ in range(25))) for i in range(60)]
    docs = frame(spark, rows).repartition(4)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in minhash_dedup.near_duplicates(docs, 5, 85).collect())
    want = brute.jaccard_components(rows, 5, 85)
    assert got == want and len({c for _, _, c in want}) < len(rows)


def test_minhash_of_nothing_and_kept(odd, empty):
    assert minhash_dedup.report(empty).count() == 0
    for x in minhash_dedup.report(odd).collect():
        assert x["kept"] == (x["doc_id"] == x["component_id"])


def test_threshold_loses_less_than_stated():
    t = minhash_dedup.threshold(85)
    r = np.random.default_rng(1)
    assert 0.5 * minhash_dedup.COORDINATES < t < 0.85 * minhash_dedup.COORDINATES
    assert (r.binomial(minhash_dedup.COORDINATES, .85, 1_000_000) >= t).all()
