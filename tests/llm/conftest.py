import random

import pytest

from creditspark.session import get_spark

CLASHING = ["th", "digest", "size", "n", "label", "host", "key", "spread", "pos", "h", "shard", "slot", "spans", "kept", "one_id", "rows", "words", "gid"]


@pytest.fixture(scope="session")
def spark():
    return get_spark(master="local[4]", shuffle_partitions=4)


def frame(spark, rows, extra=()):
    """Documents (doc_id, text), with lang, source and n_chars, and constant columns of the given names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{c}` string" for c in extra)
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), *["x"] * len(extra)) for i, t in rows], schema)


def odd_rows():
    """Nulls, empty and blank texts, ties, repeated rows, near copies, shared passages, very long texts."""
    r = random.Random(4)
    vocabulary = ["".join(r.choice("abcdeéou") for _ in range(r.randint(2, 7))) for _ in range(400)]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    base, passage = say(120).split(), say(70)
    rows = [(1, None), (None, "a b c d e f"), (None, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one"), (6, "One two"), (7, "the end")]
    for k in range(12):
        w = list(base)
        for _ in range(k % 4):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        rows.append((20 + k, " ".join(w)))
    rows += [(40 + k, f"{say(30)} {passage}\n{say(25)}") for k in range(6)]
    rows += [(50, say(40)), (50, say(40)), (51, "same row"), (51, "same row"), (52, ("x" * 30_000) + " " + say(6000)), (53, "word " * 5000)]
    rows += [(60 + k, say(r.randint(1, 60))) for k in range(40)]
    rows += [(200, "mail a.b@c.example.com, 10.0.0.1, 4111 1111 1111 1111 and +1 (555) 123-4567.\nmail a.b@c.example.com"),
             (201, "É 1.2.3.4.5.6.7.8 x@y@z.com password=7602ad27cf5550de1c"), (202, "#### $$$$ %%%% " * 20), (203, "YOU IDIOT. " * 12), (204, "tab\tline\x0bfeed\x0cend\x1cno\x85nbsp\u00a0x")]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, odd_rows(), CLASHING).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [], CLASHING)
