"""Quality classifier from weak labels.

1. Overlapping heuristic labellers vote ``good``, ``junk`` or ``toxic`` on every document, or abstain.  One of
   them knows words that labelled toxic documents hold and others don't, learned from at most
   ``LABELLED_ROWS`` labelled rows.
2. Documents are counted by their votes (a few hundred distinct patterns at most reach the driver, whatever the
   corpus); expectation-maximisation over these counts estimates each labeller's votes given the
   true class, and every pattern's posterior.
3. The posteriors of at most ``TRAINING_ROWS`` rows, taken by least hash, train a linear scorer over hashed words and
   bucketed measures (softmax, mini-batch AdaGrad in numpy); the scorer then judges every whole document,
   and rejects one whose probability of ``good`` is below ``least``.

Null texts count as empty; a text without words has measures of 0.  A null doc_id is a value like others;
repeated rows get equal results.  An empty table trains nothing and returns no rows.  Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditspark.llm.common import stored
from creditspark.llm.shingles import blocks

CLASSES = ["good", "junk", "toxic"]
LABELLED_ROWS = 20_000
TRAINING_ROWS = 8_000
BUCKETS = 1 << 18
LEXICON = 200
HEADS = (4, 5, 6)

# fixed values: insults
INSULTS = ["clown", "disgusting", "dumb", "idiot", "imbecile", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless"]
# fixed values: frequent function words of English, French, German and Spanish
FUNCTION_WORDS = ["a", "an", "and", "as", "at", "by", "for", "in", "is", "it", "of", "on", "that", "the", "this", "to", "was", "with",
                  "dans", "des", "du", "est", "et", "la", "le", "les", "par", "pour", "que", "qui", "sur", "un", "une",
                  "auf", "das", "dem", "den", "der", "die", "ein", "eine", "ist", "mit", "nicht", "sich", "und", "von", "zu",
                  "con", "de", "el", "en", "los", "las", "no", "por", "se", "y"]

MEASURES = ["words", "function", "distinct", "adjacent", "upper", "symbols", "pipes", "shouts", "digits", "lines", "length", "insults", "learned"]
#: Bounds between a measure's buckets, for the scorer.
STEPS = {"words": [5, 20, 100, 1000], "function": [.02, .08, .2, .4], "distinct": [.1, .3, .5, .7], "adjacent": [.02, .1, .3], "upper": [.15, .4, .7],
         "symbols": [.02, .1, .3, 1], "pipes": [.05, .3], "shouts": [.05, .3], "digits": [.1, .3], "lines": [.1, .3, .6], "length": [3, 4, 7, 9],
         "insults": [.5, 1.5], "learned": [.5, 1.5]}

_STRIP = str.maketrans(dict.fromkeys("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", " ") | {c: " " for c in "\t\n\r\x0b\x0c"})


def labeller_votes(m: np.ndarray) -> np.ndarray:
    """Votes of every labeller (columns) on every document (rows): a class's number, or -1."""
    c = dict(zip(MEASURES, m.T))
    some, many = c["words"] >= 5, c["words"] >= 20
    even = (c["symbols"] < .08) & (c["upper"] < .3) & (c["adjacent"] < .06) & (c["pipes"] + c["shouts"] < .08) & ((c["distinct"] > .25) | ~many)
    bad_words = c["insults"] + c["learned"]
    vote = lambda *cases: np.select([k for k, _ in cases], [v for _, v in cases], -1)
    return np.stack([
        vote((some & (c["symbols"] > .15), 1)),
        vote((some & (c["adjacent"] > .15), 1)),
        vote((some & (c["upper"] > .35), 1)),
        vote((some & (c["pipes"] + c["shouts"] > .15), 1)),
        vote((many & (c["function"] < .06), 1), (some & even & (c["function"] > .15), 0)),
        vote(((c["words"] >= 50) & (c["distinct"] < .2), 1)),
        vote((c["lines"] > .3, 1)),
        vote((c["insults"] >= 1, 2)),
        vote((c["learned"] >= 1, 2)),
        vote((bad_words >= 3, 2), (even & (bad_words == 0), 0)),
    ], axis=1)


def measures(texts: list[str | None], lexicon: frozenset[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """MEASURES of each text, and its distinct words' hash buckets."""
    insults, function = frozenset(INSULTS), frozenset(FUNCTION_WORDS)
    low = [(t or "").lower() for t in texts]
    split = pc.split_pattern(pa.array([t.translate(_STRIP) for t in low], pa.large_string()), " ")
    coded = split.flatten().dictionary_encode()
    vocabulary = coded.dictionary.to_pylist()
    word = coded.indices.to_numpy()
    real = np.array([bool(w) for w in vocabulary], bool)[word] if len(word) else np.zeros(0, bool)
    ends = np.concatenate([[0], np.cumsum(real)])[split.offsets.to_numpy() - split.offsets[0].as_py()]
    word = word[real]
    is_ = lambda known: np.array([w in known for w in vocabulary], bool)
    is_function, is_insult, is_learned = is_(function), is_(insults), is_(lexicon)
    heads = {w[:-1] for w in lexicon if w.endswith("*")}
    if heads:
        is_learned |= np.array([any(len(w) > k and w[:k] in heads for k in HEADS) for w in vocabulary], bool)
    chars = np.array([len(w) for w in vocabulary], np.int64)
    bucket = np.array([xxhash.xxh32_intdigest(w) % BUCKETS for w in vocabulary], np.int64)
    out, features = np.zeros((len(texts), len(MEASURES))), []
    for i, text in enumerate(texts):
        w, text = word[ends[i]:ends[i + 1]], text or ""
        raw = np.frombuffer(text.encode(), np.uint8)
        count = np.bincount(raw, minlength=256)
        upper, lower = count[65:91].sum(), count[97:123].sum()
        lines = [x for x in text.split("\n") if x.strip()]
        n = max(len(w), 1)
        own = np.unique(w)
        per = lambda s: count[[ord(x) for x in s]].sum() / n
        out[i] = [len(w), is_function[w].sum() / n, len(own) / n, (w[1:] == w[:-1]).sum() / n, upper / max(upper + lower, 1), per("#*$%&<>|"), per("|"), per("!"),
                  count[48:58].sum() / max(len(raw), 1), 1 - len(set(lines)) / max(len(lines), 1), chars[w].sum() / n, is_insult[own].sum(), is_learned[own].sum()]
        features.append(np.unique(bucket[own]))
    return out, features


def shape_features(m: np.ndarray) -> np.ndarray:
    """One bucket per measure, numbered after the words' buckets."""
    return np.stack([BUCKETS + 8 * k + np.searchsorted(STEPS[name], m[:, k], side="right") for k, name in enumerate(MEASURES)], axis=1)


SIZE = BUCKETS + 8 * len(MEASURES)


def pattern(votes: np.ndarray) -> np.ndarray:
    return (votes + 1) @ (4 ** np.arange(votes.shape[1]))


def unpattern(p: np.ndarray, n: int) -> np.ndarray:
    return (p[:, None] // 4 ** np.arange(n) % 4) - 1


def expectation_maximisation(votes: np.ndarray, counts: np.ndarray, rounds: int = 200, tol: float = 1e-8) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posterior of each pattern, class shares, tables [labeller, class, vote + 1]).

    A labeller's table starts with a vote being right in 4 of 5 cases, and holds that belief with the weight of
    2 in 100 documents, so that a class that no labeller confuses stays what its name says.
    """
    n, m = len(CLASSES), votes.shape[1]
    total = counts.sum()
    share = np.array([.8, .12, .08])
    belief = np.full((m, n, n + 1), 0.0)
    for j in range(m):
        cast = np.array([counts[votes[:, j] == v].sum() / total for v in range(-1, n)])
        for c in range(n):
            like = np.array([max(cast[0], .05)] + [(.8 if v == c else .1) * (cast[v + 1] > 0) for v in range(n)])
            like[1 + c] = max(like[1 + c], 1e-3)
            belief[j, c] = like / like.sum()
    table, post = belief.copy(), None
    for _ in range(rounds):
        log = np.log(share)[None] + sum(np.log(np.maximum(table[j][:, votes[:, j] + 1].T, 1e-6)) for j in range(m))
        new = np.exp(log - log.max(axis=1, keepdims=True))
        new /= new.sum(axis=1, keepdims=True)
        if post is not None and np.abs(new - post).max() < tol:
            break
        post, weight = new, new * counts[:, None]
        share = (weight.sum(axis=0) + .002 * total) / (total * (1 + .002 * n))
        for j in range(m):
            seen = np.stack([weight[votes[:, j] == v].sum(axis=0) for v in range(-1, n)], axis=1)
            table[j] = seen + .02 * total * belief[j] + 1e-9
            table[j] /= table[j].sum(axis=1, keepdims=True)
    return post, share, table


def values(row: np.ndarray) -> np.ndarray:
    """A row's feature values: its words share one unit of length, each measure's bucket is 1."""
    words = row < BUCKETS
    return np.where(words, 1 / np.sqrt(max(words.sum(), 1)), 1.0)


def fit(rows: list[np.ndarray], target: np.ndarray, epochs: int = 10, rate: float = .2, seed: int = 7) -> np.ndarray:
    """Weights [feature, class] of a softmax over the rows' features, fitted to soft targets."""
    rng = np.random.default_rng(seed)
    w, g2 = np.zeros((SIZE + 1, len(CLASSES))), np.full((SIZE + 1, 1), 1e-4)
    rows = [np.append(r, SIZE) for r in rows]  # the last weight is the constant
    size = [values(r) for r in rows]
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), 32):
            part = order[lo:lo + 32]
            at, v = np.concatenate([rows[i] for i in part]), np.concatenate([size[i] for i in part])
            doc = np.repeat(np.arange(len(part)), [len(rows[i]) for i in part])
            z = np.zeros((len(part), len(CLASSES)))
            np.add.at(z, doc, w[at] * v[:, None])
            p = np.exp(z - z.max(axis=1, keepdims=True))
            err = (p / p.sum(axis=1, keepdims=True) - target[part]) / len(part)
            ids, back = np.unique(at, return_inverse=True)
            grad = np.zeros((len(ids), len(CLASSES)))
            np.add.at(grad, back, err[doc] * v[:, None])
            grad += np.where(ids < BUCKETS, 1e-4, 1e-6)[:, None] * w[ids]
            g2[ids] += (grad ** 2).sum(axis=1, keepdims=True)
            w[ids] -= rate * grad / np.sqrt(g2[ids])
    return w


def _heads(words, k: int):
    return F.transform(F.filter(words, lambda w: F.length(w) > k), lambda w: F.concat(F.substring(w, 1, k), F.lit("*")))


def learned_lexicon(docs: DataFrame, labels: DataFrame, most: int = LABELLED_ROWS) -> list[str]:
    """Words, and beginnings of words (``lett*``), that labelled toxic documents hold at least 20 times as often as
    others do, taken while each is in 1 of 100 toxic documents that hold none before it: words of a family of
    copies add nothing."""
    known = labels.filter("doc_id is not null and toxic is not null").select("doc_id", "toxic").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    known = F.broadcast(stored(known, "labelled"))
    words = F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: F.length(w) > 2))
    heads = [_heads(words, k) for k in HEADS]
    words = F.array_distinct(F.concat(words, *heads))
    rows = docs.select("doc_id", "text").join(known, "doc_id").select("doc_id", (F.col("toxic") == 1).alias("bad"), F.explode_outer(words).alias("word"))
    rows = stored(rows.filter("word is not null"), "labelled-words")
    seen = rows.groupBy("word").agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("rest"))
    n = known.agg(F.count_if(F.col("toxic") == 1).alias("bad"), F.count_if(F.col("toxic") != 1).alias("rest")).first()
    odds = (F.col("bad") + .5) / (n["bad"] + 1) / ((F.col("rest") + .5) / (n["rest"] + 1))
    top = (seen.filter(F.col("bad") >= max(5, n["bad"] / 100)).withColumn("odds", odds).filter("odds >= 20")
           .orderBy(F.desc("odds"), F.desc("bad"), "word").limit(2 * LEXICON))
    held: dict[str, set] = {}
    for r in rows.filter("bad").join(F.broadcast(top.select("word")), "word").select("doc_id", "word").toPandas().itertuples():
        held.setdefault(r.word, set()).add(r.doc_id)
    found, covered = [], set()
    while held and len(found) < LEXICON:
        word = max(held, key=lambda w: (len(held[w] - covered), w))
        new = held.pop(word) - covered
        if len(new) < max(3, n["bad"] / 100):
            break
        covered |= new
        found.append(word)
    return found


class Model:
    """A fitted scorer: weights, the learned words, and what the label model found."""

    def __init__(self, weights: np.ndarray, lexicon: list[str], share: np.ndarray, table: np.ndarray):
        self.weights, self.lexicon, self.share, self.table = weights.astype(np.float32), lexicon, share, table


def _votes(docs: DataFrame, lexicon: list[str]) -> DataFrame:
    words = frozenset(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch, 1):
                m, _ = measures(b.column(1).to_pylist(), words)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pattern(labeller_votes(m)), pa.int64())], ["key", "pattern"])

    return docs.select(F.xxhash64("doc_id", "text").alias("key"), "text").mapInArrow(run, "key long, pattern long")


def train(docs: DataFrame, labels: DataFrame | None = None, most: int = TRAINING_ROWS) -> Model | None:
    """The label model over all rows of ``docs`` and the scorer; None for an empty table."""
    lexicon = learned_lexicon(docs, labels) if labels is not None else []
    votes = stored(_votes(docs, lexicon), "votes")
    counts = votes.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").toPandas()
    if not len(counts):
        return None
    m = labeller_votes(np.zeros((1, len(MEASURES)))).shape[1]
    post, share, table = expectation_maximisation(unpattern(counts["pattern"].to_numpy(), m), counts["n"].to_numpy(float))
    last = votes.select("key").orderBy("key").limit(most).agg(F.max("key")).first()[0]
    place, words = dict(zip(counts["pattern"].tolist(), post)), frozenset(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch, 1):
                m, rows = measures(b.column(1).to_pylist(), words)
                rows = [np.concatenate(x) for x in zip(rows, shape_features(m))]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.int32())), pa.array(pattern(labeller_votes(m)), pa.int64())], ["key", "features", "pattern"])

    key = F.xxhash64("doc_id", "text")
    # rows that repeat one key would pass the bound: one of each is enough
    sample = (docs.select(key.alias("key"), "text").filter(F.col("key") <= last)
              .mapInArrow(run, "key long, features array<int>, pattern long").dropDuplicates(["key"]).orderBy("key").limit(most).toPandas())
    target = np.stack([place[p] for p in sample["pattern"]])
    return Model(fit([np.asarray(f) for f in sample["features"]], target), lexicon, share, table)


def _scores(texts: list[str | None], weights: np.ndarray, words: frozenset[str]) -> np.ndarray:
    m, rows = measures(texts, words)
    z = np.stack([weights[r].sum(axis=0) / np.sqrt(max(len(r), 1)) for r in rows]) + weights[shape_features(m)].sum(axis=1) + weights[SIZE]
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def classify(docs: DataFrame, model: Model, least: float = .5) -> DataFrame:
    """(doc_id, p_good, p_junk, p_toxic, kept) for every row; a narrow pass."""
    spark = docs.sparkSession
    shared, words = spark.sparkContext.broadcast(model.weights), frozenset(model.lexicon)
    key = docs.schema["doc_id"].simpleString().replace(":", " ", 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch, 1):
                p = _scores(b.column(1).to_pylist(), shared.value, words)
                yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(x) for x in p.T.astype(float)], pa.array(p[:, 0] >= least)], ["doc_id", "p_good", "p_junk", "p_toxic", "kept"])

    return docs.select("doc_id", "text").mapInArrow(run, f"{key}, p_good double, p_junk double, p_toxic double, kept boolean")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels)
    if model is None:
        return docs.select("doc_id", *[F.lit(0.0).alias(f"p_{c}") for c in CLASSES], F.lit(False).alias("kept")).limit(0)
    return classify(docs, model)


def keep_good(docs: DataFrame, labels: DataFrame, least: float = .5) -> DataFrame:
    """The rows of ``docs`` that the scorer keeps, with all their columns."""
    model = train(docs, labels)
    if model is None:
        return docs
    shared, words = docs.sparkSession.sparkContext.broadcast(model.weights), frozenset(model.lexicon)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(batch, at):
                yield b.filter(pa.array(_scores(b.column(at).to_pylist(), shared.value, words)[:, 0] >= least))

    return docs.mapInArrow(run, docs.schema)
