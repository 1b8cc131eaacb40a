"""Alignment of two tokenizers over a corpus, in Arrow.

Tokenizer A splits a space and the text, tokenizer B the text, before which it puts a space itself; both cut the same bytes.

1. Texts are split at their spaces into pieces, which neither tokenizer looks across; each distinct piece of a block is encoded
   once, and taken for all its occurrences.  (Texts with a run of spaces, at either end or with the piece
   tokenizer's own space mark are encoded whole.)
2. Token lists are flattened; parent indices tell each token's document, and sums of byte lengths, begun anew
   in each document, where it ends.
3. A full hash join of A's and B's tokens on (document, end) holds every place where either ends: where both do, a
   group ends.  In order of places, each row is one pair of tokens whose bytes overlap: the next A token and
   the next B token to end there.
4. ``Table.group_by`` counts each document's id pairs, and for a part of about PART bytes in how many documents each occurs.
   Spark adds up the parts' counts by id pair.
5. A part's documents wait as one compressed block.  A pair that no other part has is counted already; for the others
   the sums come back to the part, whose blocks are read once more.

Only the highest count of each A id is broadcast, at most a row for each id of the vocabulary.  Memory holds one block of text
and one part's pairs.

Texts that are null or empty, or whose token bytes differ from a space and the text, have no tokens: zeros, and an empty
``groups_sha256``.  Repeated rows are documents of their own and count each.  An empty table returns no rows.
Columns besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditspark.llm.common import stored
from creditspark.llm.shingles import blocks

BLOCK, PART = 4 << 20, 32 << 20
MARK = "▁"
SPACE = 1 << 20
#: What may follow an id: another of the group, the other tokenizer's, the next group, nothing.
MARKS = (",", "|", ";", "")


class Coder:
    """One tokenizer: ids of texts, and each id's bytes."""

    def __init__(self, names: list[bytes]):
        self.bytes = pa.array(names, pa.large_binary())
        self.size = np.fromiter(map(len, names), np.int64, len(names))

    def lists(self, texts: list[str]) -> pa.LargeListArray:
        ids = self.encode(texts)
        at = np.cumsum([0, *map(len, ids)])
        flat = np.fromiter((i for own in ids for i in own), np.int32, int(at[-1]))
        return pa.LargeListArray.from_arrays(pa.array(at, pa.int64()), pa.array(flat))

    def joined(self, lists: pa.LargeListArray) -> pa.Array:
        """The bytes of each list's tokens."""
        ids = lists.flatten()
        at = np.concatenate([[0], np.cumsum(self.size[ids.to_numpy()])])[lists.offsets.to_numpy()]
        return pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(at.tobytes()), self.bytes.take(ids).buffers()[2]])


def _byte_of() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves, others in turn
    from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class ByteLevel(Coder):
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        byte = _byte_of()
        names = [b""] * self.tok.get_vocab_size(with_added_tokens=True)
        for piece, i in self.tok.get_vocab(with_added_tokens=True).items():
            names[i] = bytes(byte[c] for c in piece) if all(c in byte for c in piece) else piece.encode()
        super().__init__(names)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch([f" {t}" for t in texts], add_special_tokens=False)]


class Pieces(Coder):
    def __init__(self, path: str):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        #: No piece goes on after a space mark that follows another letter: spaces part the text.
        self.parted = not any(MARK in p.lstrip(MARK) for p in names)
        super().__init__([bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(names)])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.sp.encode(texts, num_threads=1)


@cache
def _coders(a: str, b: str) -> tuple[Coder, Coder]:
    return ByteLevel(a), Pieces(b)


def _split(texts: pa.Array, parted: bool) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Rows in the order that follows, how many pieces each has, and all pieces; rows without text are left out."""
    filled = pc.fill_null(pc.greater(pc.binary_length(texts), 0), False)
    odd = pc.match_substring(texts, "  ")
    for x in (pc.starts_with(texts, " "), pc.ends_with(texts, " "), pc.match_substring(texts, MARK)):
        odd = pc.or_(odd, x)
    odd = pc.fill_null(odd, False).to_numpy(zero_copy_only=False) | (not parted)
    filled = filled.to_numpy(zero_copy_only=False)
    plain, whole = np.flatnonzero(filled & ~odd), np.flatnonzero(filled & odd)
    split = pc.split_pattern(texts.take(pa.array(plain)), " ")
    n = np.concatenate([pc.list_value_length(split).to_numpy().astype(np.int64), np.ones(len(whole), np.int64)])
    return np.concatenate([plain, whole]), n, pa.concat_arrays([split.flatten(), texts.take(pa.array(whole))])


def _starts(n: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(n)])


def _tokens(lists: pa.LargeListArray, piece: pa.Array, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all tokens in turn, and where each document's begin."""
    own = lists.take(piece)
    ids = own.flatten().to_numpy()
    at = own.offsets.to_numpy()
    return ids, (at - at[0])[_starts(n)]


@cache
def _numbers(most: int) -> pa.Array:
    """Every number with each mark that may follow it."""
    return pa.array([f"{i}{mark}" for i in range(most) for mark in MARKS], pa.large_string())


def _digests(ids_a: np.ndarray, ids_b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray, groups: np.ndarray) -> list[str]:
    """The digest of each document's groups; these end with the given tokens, and documents have so many."""
    n = np.empty(len(ids_a) + len(ids_b), np.int64)
    ends = np.zeros(len(n), np.int64)
    # in each group A's tokens come first, then B's
    place_a = np.arange(len(ids_a)) + np.repeat(np.concatenate([[0], end_b[:-1] + 1]), np.diff(end_a, prepend=-1))
    place_b = np.arange(len(ids_b)) + np.repeat(end_a + 1, np.diff(end_b, prepend=-1))
    n[place_a], n[place_b] = ids_a, ids_b
    ends[place_a[end_a]], ends[place_b[end_b]] = MARKS.index("|"), MARKS.index(";")
    last = place_b[end_b[np.cumsum(groups) - 1]]
    ends[last] = MARKS.index("")
    _, at, data = _numbers(1 << 16 if n.max() < 1 << 16 else int(n.max()) + 1).take(pa.array(n * len(MARKS) + ends)).buffers()
    cut, view = np.frombuffer(at, np.int64)[np.concatenate([[0], last + 1])].tolist(), memoryview(data)
    return [hashlib.sha256(view[x:y]).hexdigest() for x, y in zip(cut, cut[1:])]


def align(texts: pa.Array, a: Coder, b: Coder) -> tuple[dict[str, np.ndarray], list[str], pa.Table]:
    """Of each text the numbers of tokens, groups and links and the digest of its groups; and (doc, pair, m): how often
    each document (its place in ``texts``) holds an id pair linked."""
    texts = texts.cast(pa.large_string())
    rows, n, flat = _split(texts, b.parted)
    coded = flat.dictionary_encode()
    words = coded.dictionary
    names = words.to_pylist()
    la, lb = a.lists(names), b.lists(names)
    own = pc.binary_join_element_wise(pa.scalar(b" ", pa.large_binary()), words.cast(pa.large_binary()), pa.scalar(b"", pa.large_binary()))
    same = pc.and_(pc.equal(a.joined(la), own), pc.equal(b.joined(lb), own)).to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(rows)), n)
    piece = coded.indices.to_numpy().astype(np.int64)
    good = np.bincount(doc[~same[piece]], minlength=len(rows)) == 0
    piece, rows, n = pa.array(piece[good[doc]]), rows[good], n[good]
    stats = {c: np.zeros(len(texts), np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
    digests = [""] * len(texts)
    if not len(rows):
        return stats, digests, pa.table({"doc": pa.array([], pa.int64()), "pair": pa.array([], pa.int64()), "m": pa.array([], pa.int64())})
    sides = []
    for coder, lists, name in ((a, la, "a"), (b, lb, "b")):
        ids, at = _tokens(lists, piece, n)
        parent = np.repeat(np.arange(len(rows)), np.diff(at))
        total = np.cumsum(coder.size[ids])
        end = total - np.concatenate([[0], total])[at[:-1]][parent]
        sides.append((ids, at, pa.table({"doc_end": (parent << 40) | end, name: np.arange(len(ids))})))
    (ids_a, at_a, ta), (ids_b, at_b, tb) = sides
    ends = ta.join(tb, "doc_end", join_type="full outer", use_threads=False).combine_chunks()
    order = pa.array(np.argsort(ends["doc_end"].to_numpy()))
    ends = ends.take(order).combine_chunks()
    place, xa, xb = ends["doc_end"].to_numpy() >> 40, ends["a"], ends["b"]
    common = pc.and_(pc.is_valid(xa), pc.is_valid(xb)).to_numpy()
    # a document's last place is an end of both: nothing is filled from another document
    xa, xb = (pc.fill_null_backward(x).to_numpy() for x in (xa, xb))
    links, groups = np.bincount(place, minlength=len(rows)), np.bincount(place[common], minlength=len(rows))
    for c, x in (("n_a", np.diff(at_a)), ("n_b", np.diff(at_b)), ("n_groups", groups), ("n_links", links)):
        stats[c][rows] = x
    for r, t in zip(rows.tolist(), _digests(ids_a, ids_b, xa[common], xb[common], groups)):
        digests[r] = t
    pair = ids_a[xa].astype(np.int64) * SPACE + ids_b[xb]
    held = pa.table({"doc": rows[place], "pair": pair}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    return stats, digests, held.rename_columns(["doc", "pair", "m"])


def _squeezed(x: np.ndarray) -> bytes:
    """Numbers as compressed bytes, those of like weight side by side."""
    x = np.ascontiguousarray(x)
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T), "zstd", asbytes=True) if len(x) else b""


def _spread(data: bytes, kind, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    return np.ascontiguousarray(np.frombuffer(pa.decompress(data, n * size, "zstd", asbytes=True), np.uint8).reshape(size, n).T).view(kind).ravel()


class _Part:
    """Documents of about PART bytes with their pairs."""

    def __init__(self) -> None:
        self.bytes, self.docs, self.held, self.n = 0, [], [], 0

    def add(self, block: pa.RecordBatch, a: Coder, b: Coder) -> None:
        stats, digests, held = align(block.column(1), a, b)
        self.docs.append(pa.table({"doc_id": block.column(0), **stats, "groups_sha256": pa.array(digests, pa.string())}))
        self.held.append(held.set_column(0, "doc", pc.add(held["doc"], self.n)))
        self.n += block.num_rows
        self.bytes += pc.sum(pc.binary_length(block.column(1))).as_py() or 0

    def rows(self, part: int) -> Iterator[pa.RecordBatch]:
        """A row per id pair with its documents in this part, and a row with all that is needed later."""
        held = pa.concat_tables(self.held)
        count = held.group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by("pair").combine_chunks()
        pair, docs = count["pair"].to_numpy(), count["count_all"].to_numpy()
        doc, code, m = held["doc"].to_numpy(), np.searchsorted(pair, held["pair"].to_numpy()), held["m"].to_numpy()
        order = np.argsort(doc * max(len(pair), 1) + code)
        doc, code, m = doc[order], code[order], m[order]
        step = np.diff(code, prepend=0)
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        step[first] = code[first]
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, (t := pa.concat_tables(self.docs)).schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(t)
        for lo in range(0, len(pair), 1 << 18):
            hi = min(lo + (1 << 18), len(pair))
            yield pa.RecordBatch.from_pydict({"part": np.full(hi - lo, part), "pair": pair[lo:hi], "docs": docs[lo:hi], "block": pa.nulls(hi - lo, pa.binary())})
        block = pa.array([{"docs": sink.getvalue().to_pybytes(), "n_pairs": len(pair), "pair": _squeezed(np.diff(pair, prepend=0)), "count": _squeezed(docs.astype(np.int32)),
                           "n_held": len(code), "size": _squeezed(np.bincount(doc, minlength=self.n).astype(np.int32)),
                           "step": _squeezed(step.astype(np.int32)), "m": _squeezed(m.astype(np.int32))}])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, (t := pa.table({"x": block})).schema) as out:
            out.write_table(t)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "pair": pa.nulls(1, pa.int64()), "docs": pa.nulls(1, pa.int64()), "block": pa.array([sink.getvalue().to_pybytes()], pa.binary())})


def _finished(blocks_: pa.Table, sums: pa.Table, highest: np.ndarray) -> pa.Table:
    """The rows of one part, from its block and the counts of pairs that other parts have too."""
    x = pa.ipc.open_stream(blocks_["block"][0].as_buffer()).read_all()["x"][0].as_py()
    docs = pa.ipc.open_stream(x["docs"]).read_all()
    pair = np.cumsum(_spread(x["pair"], np.int64, x["n_pairs"]))
    count = _spread(x["count"], np.int32, x["n_pairs"]).astype(np.int64)
    count[np.searchsorted(pair, sums["pair"].to_numpy())] = sums["n"].to_numpy()
    best = count == highest[pair // SPACE]
    size = _spread(x["size"], np.int32, docs.num_rows)
    step, m = (_spread(x[c], np.int32, x["n_held"]).astype(np.int64) for c in ("step", "m"))
    at = _starts(size)
    run = np.cumsum(step)
    code = run - np.repeat(np.concatenate([[0], run])[at[:-1]], size)
    total = lambda v: np.diff(np.concatenate([[0], np.cumsum(v)])[at])
    return docs.append_column("n_best", pa.array(total(m * best[code]))).append_column("count_sum", pa.array(total(m * count[code])))


def aligned(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, part: int = PART) -> DataFrame:
    """One row per document with the columns of ``report``."""
    import public_tokenizers
    a_path, b_path = a_path or public_tokenizers.path("byte_bpe_50k.json"), b_path or public_tokenizers.path("piece_bpe_32k.model")
    key = docs.schema["doc_id"].simpleString().replace(":", " ", 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _coders(a_path, b_path)
        number, own = TaskContext.get().partitionId() << 32, _Part()
        for batch in batches:
            for block in blocks(batch, 1, BLOCK):
                own.add(block, a, b)
                if own.bytes >= part:
                    yield from own.rows(number)
                    number, own = number + 1, _Part()
        if own.n:
            yield from own.rows(number)
        pa.default_memory_pool().release_unused()

    parts = stored(docs.select("doc_id", "text").mapInArrow(run, "part long, pair long, docs long, block binary"), "alignment-parts")
    counts = parts.filter("pair is not null").select("part", "pair", "docs")
    sums = stored(counts.groupBy("pair").agg(F.sum("docs").alias("n"), F.count(F.lit(1)).alias("parts")), "pair-counts")
    # at most one row for each id of A
    top = sums.groupBy(F.expr(f"pair div {SPACE}").alias("a")).agg(F.max("n").alias("n")).toArrow()
    highest = np.zeros(max([0, *top["a"].to_pylist()]) + 1, np.int64)
    highest[top["a"].to_numpy()] = top["n"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(highest)
    several = counts.select("part", "pair").join(sums.filter("parts > 1").select("pair", "n"), "pair").select(F.col("part").alias("of_part"), "pair", "n")
    cols = f"{key}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return parts.filter("block is not null").select("part", "block").groupBy("part").cogroup(several.groupBy("of_part")).applyInArrow(
        lambda x, y: _finished(x, y, shared.value), cols)


def report(docs: DataFrame) -> DataFrame:
    return aligned(docs).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
