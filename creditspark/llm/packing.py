"""Packing of tokenised documents into training sequences.

Every document's ids (its text by the tokenizer, then the end id) are cut into pieces of at most
``size`` ids: whole sequences from the front, and one rest.  Pieces are shuffled by a hash
(randomised groups) and each task packs its groups, of a bounded number of ids, one after another by
first-fit decreasing; a tournament tree over the bins' free room finds the first bin that fits in
log time.  What is left open at the end of a group is closed by cutting: the emptiest bins' pieces
are cut to fill the room of the fuller ones, so that little is padded.

Null text counts as empty (the end id alone).  Repeated rows are packed as often as they occur.
Columns besides ``doc_id`` and ``text`` are not read.  Memory: one batch of texts, or one group.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 4096
END_ID = 2
GROUP_IDS = 8_000_000
#: Words whose ids a task remembers; this bounds its memory alone.
CACHED_WORDS = 400_000

#: A lower-case Latin word and its punctuation: one pre-token each, whatever the rest of the text.
_PLAIN = re.compile(r"([a-z\u00df-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)")


def word_tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _byte_names() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the rest follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(shown))
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(rest)}


class WordIds:
    """Ids of whole texts for ``word_bpe_49k``, through a bounded cache of words.

    The pre-tokenizer never joins across blanks, tabs and line ends, so the ids of a text are those
    of its words in turn.
    Texts that are not in normal form C, or that hold a character or string whose treatment depends
    on its place, go to the tokenizer as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.model = self.tok.model
        self.names = _byte_names()
        self.known: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}

    def _encode(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _word(self, word: str) -> bytes:
        m = _PLAIN.fullmatch(word)
        if not m:
            return self._encode(word)
        core, marks = m.groups()
        if not core.isascii():
            core = "".join([self.names[b] for b in core.encode()])
        if marks not in self.marks:
            self.marks[marks] = self._encode(marks)
        return array(self.dtype.char, [t.id for t in self.model.tokenize(core)]).tobytes() + self.marks[marks]

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text.  Each distinct word of the batch is looked up once."""
        out: list[np.ndarray | None] = [None] * len(texts)
        rows, plain = [], []
        for i, t in enumerate(texts):
            t = t or ""
            # lower-casing may undo the normal form, which the tokenizer would make anew for a word
            if "<|" in t or "\u03a3" in t or not unicodedata.is_normalized("NFC", t) or not unicodedata.is_normalized("NFC", t.lower()):
                out[i] = np.frombuffer(self._encode(t), self.dtype)
            else:
                rows.append(i)
                plain.append(t.lower().replace("\n", " ").replace("\t", " ").replace("\r", " "))
        if not rows:
            return out
        split = pc.split_pattern(pa.array(plain, pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        bank = [self._known(w) for w in coded.dictionary.to_pylist()]
        size = np.fromiter(map(len, bank), np.int64, len(bank)) // self.dtype.itemsize
        flat = np.frombuffer(b"".join(bank), self.dtype)
        first = np.cumsum(size) - size
        word = coded.indices.to_numpy()
        n = size[word]
        ends = np.cumsum(n)
        ids = flat[np.repeat(first[word] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.concatenate([[0], ends])[split.offsets.to_numpy() - split.offsets[0].as_py()]
        for k, i in enumerate(rows):
            out[i] = ids[cuts[k]:cuts[k + 1]]
        return out

    def _known(self, word: str) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            ids = self._word(word) if word else b""
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            if len(word) <= 64:
                self.known[word] = ids
        return ids


@cache
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def _blocks(batch: pa.RecordBatch, n_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about ``n_bytes`` of text (column 1), or of one longer text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy())
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + n_bytes)))
        yield batch.slice(lo, hi - lo)
        lo = hi


class FirstFit:
    """Bins of equal size in a tournament tree; each inner node holds the larger room below it."""

    def __init__(self, size: int):
        self.size, self.leaves, self.n, self.tree = size, 1, 0, [size, size]

    def _grow(self) -> None:
        old = self.tree[self.leaves:self.leaves + self.n]
        self.leaves *= 2
        self.tree = [0] * self.leaves + old + [self.size] * (self.leaves - len(old))
        for i in range(self.leaves - 1, 0, -1):
            self.tree[i] = max(self.tree[2 * i], self.tree[2 * i + 1])

    def put(self, length: int) -> int:
        """The first bin with room for ``length``, which it takes."""
        while self.tree[1] < length:
            self._grow()
        t, i = self.tree, 1
        while i < self.leaves:
            i = 2 * i if t[2 * i] >= length else 2 * i + 1
        bin_ = i - self.leaves
        t[i] -= length
        while i > 1:
            i //= 2
            t[i] = max(t[2 * i], t[2 * i + 1])
        self.n = max(self.n, bin_ + 1)
        if self.n == self.leaves:
            self._grow()
        return bin_

    def room(self) -> list[int]:
        return self.tree[self.leaves:self.leaves + self.n]


def fill(lengths: list[int], size: int = SIZE) -> list[list[tuple[int, int, int]]]:
    """Sequences of (piece, from, length) for pieces of at most ``size``."""
    fit = FirstFit(size)
    bins: list[list[tuple[int, int, int]]] = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        b = fit.put(lengths[i])
        if b == len(bins):
            bins.append([])
        bins[b].append((i, 0, lengths[i]))
    room = fit.room()
    # the emptiest bins are dissolved into the open room of the rest
    order = sorted((b for b in range(len(bins)) if room[b]), key=lambda b: (room[b], b))
    lo = 0
    while lo < len(order) - 1:
        last = order[-1]
        if sum(room[b] for b in order[lo:-1]) < size - room[last]:
            break
        moving = bins[last]
        bins[last] = []
        order.pop()
        for i, at, n in moving:
            while n:
                b = order[lo]
                take = min(n, room[b])
                bins[b].append((i, at, take))
                at, n, room[b] = at + take, n - take, room[b] - take
                if not room[b]:
                    lo += 1
    return [b for b in bins if b]


def pack(docs: DataFrame, tokenizer_path: str | None = None, size: int = SIZE, end_id: int = END_ID,
         group_ids: int = GROUP_IDS, seed: int = 42) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (binary: unsigned
    32-bit little-endian).  Offsets of a sequence are gapless from 0."""
    path = tokenizer_path or word_tokenizer_path()
    key = docs.schema["doc_id"].simpleString().replace(":", " ", 1)

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _word_ids(path)
        for b in batches:
            for part in _blocks(b):
                rows, starts, totals, ids = [], [], [], []
                for r, own in enumerate(ids_of(part.column(1).to_pylist())):
                    full = np.append(own, ids_of.dtype.type(end_id))
                    for s in range(0, len(full), size):
                        rows.append(r)
                        starts.append(s)
                        totals.append(len(full))
                        ids.append(full[s:s + size].tobytes())
                take = pa.array(rows, pa.int32())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column(0).take(take), "spread": part.column(2).take(take),
                    "start": pa.array(starts, pa.int64()), "doc_tokens": pa.array(totals, pa.int64()), "packed": pa.array(ids, pa.binary())})

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = _word_ids(path).dtype
        task, done = TaskContext.get().partitionId() << 32, 0

        def flush(group: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal done
            t = pa.Table.from_batches(group)
            ids = [np.frombuffer(x, dtype) for x in t["packed"].to_pylist()]
            starts = t["start"].to_pylist()
            rows, start, length, seq, offset, out = [], [], [], [], [], []
            for members in fill([len(x) for x in ids], size):
                at = 0
                for i, frm, n in members:
                    rows.append(i)
                    start.append(starts[i] + frm)
                    length.append(n)
                    seq.append(task + done)
                    offset.append(at)
                    out.append(ids[i][frm:frm + n].astype("<u4").tobytes())
                    at += n
                done += 1
            for lo in range(0, len(rows), 2000):
                cut = slice(lo, lo + 2000)
                take = pa.array(rows[cut], pa.int64())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": t["doc_id"].take(take).combine_chunks(), "start": pa.array(start[cut], pa.int64()),
                    "length": pa.array(length[cut], pa.int64()), "doc_tokens": t["doc_tokens"].take(take).combine_chunks(),
                    "sequence_id": pa.array(seq[cut], pa.int64()), "offset": pa.array(offset[cut], pa.int64()), "ids": pa.array(out[cut], pa.binary())})

        group, held = [], 0
        for b in batches:
            group.append(b)
            held += sum(map(len, b.column("packed").to_pylist())) // dtype.itemsize
            if held >= group_ids:
                yield from flush(group)
                group, held = [], 0
        if held:
            yield from flush(group)

    # the text's digest keeps rows that share a doc_id (or have none) from meeting in one task
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text", F.lit(seed)).alias("spread"))
    pieces = rows.mapInArrow(tokenise, f"{key}, spread long, start long, doc_tokens long, packed binary")
    mixed = pieces.repartition("spread").sortWithinPartitions("spread", "doc_id", "start")
    return mixed.mapInArrow(place, f"{key}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def report(docs: DataFrame, **kw) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pack(docs, **kw).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
