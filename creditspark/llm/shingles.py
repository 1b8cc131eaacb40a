"""Hashed word shingles of whole texts, a batch at a time (numpy and Arrow inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: A-Z to lower case, blanks (tab to carriage return) to a space, every other byte as it is.
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else 0x20 if 0x09 <= c <= 0x0D else c for c in range(256))
_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD,
        0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3]


def blocks(batch: pa.RecordBatch, text: int, n_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about ``n_bytes`` of text, or of one longer text.  After the last one Arrow's spare memory goes back:
    workers stay for later tasks."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy())
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + n_bytes)))
        yield batch.slice(lo, hi - lo)
        lo = hi
    pa.default_memory_pool().release_unused()


def folded(texts: pa.Array) -> pa.Array:
    """The texts as bytes with A-Z in lower case and single-byte blanks; null becomes empty."""
    plain = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = plain.buffers()
    at = np.frombuffer(offsets, np.int64)[plain.offset:plain.offset + len(plain) + 1]
    raw = memoryview(data)[at[0]:at[-1]] if data is not None else b""
    return pa.Array.from_buffers(pa.large_binary(), len(plain), [None, pa.py_buffer((at - at[0]).tobytes()), pa.py_buffer(bytes(raw).translate(_FOLD))])


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in turn, and where each text's words begin (one more than texts).
    Each distinct word of the batch is hashed once."""
    split = pc.split_pattern(folded(texts).cast(pa.large_string(), safe=False), " ")
    coded = split.flatten().dictionary_encode()
    own = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()), np.uint64, len(coded.dictionary))
    filled = pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False) > 0
    word = coded.indices.to_numpy()
    real = filled[word] if len(word) else np.zeros(0, bool)
    ends = np.concatenate([[0], np.cumsum(real)])
    at = split.offsets.to_numpy()
    return own[word[real]], ends[at - at[0]]


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(_ODD[4])
    return h ^ (h >> np.uint64(29))


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Each text's distinct ``k``-word shingles as sorted 64-bit hashes; a shorter text is one shingle."""
    words, at = word_hashes(texts)
    with np.errstate(over="ignore"):
        every = np.full(max(len(words) - k + 1, 0), k, np.uint64)
        for j in range(k):
            every += words[j:len(words) - k + 1 + j] * np.uint64(_ODD[j % 8] + 2 * (j // 8))
        every = _finish(every).view(np.int64)
        out = []
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
            n = hi - lo
            if n >= k:
                s = np.sort(every[lo:hi - k + 1])
                out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
            elif n:
                h = np.uint64(n) + sum((words[lo + j] * np.uint64(_ODD[j % 8] + 2 * (j // 8)) for j in range(n)), np.uint64(0))
                out.append(_finish(np.array([h], np.uint64)).view(np.int64))
            else:
                out.append(np.zeros(0, np.int64))
    return out
