"""Words and word shingles of many texts as numpy arrays of 64-bit hashes, for use inside tasks.

Texts are handled in slices of about a megabyte, straight on the UTF-8 bytes, so memory stays bounded
whatever the batch; a longer text is a slice of its own. Hashes are the same in every task: words are
polynomial in per-byte random values, shingles chain word hashes through a 64-bit mixer. Two different
shingles share a hash with odds of 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 2**64))
_STEP = np.uint64(0xD1342543DE82EF95)


def byte_set(characters: bytes) -> np.ndarray:
    """Table by byte value of whether it is one of the characters."""
    found = np.zeros(256, dtype=bool)
    found[list(characters)] = True
    return found


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads each bit of 64-bit words over all others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_SPACE = byte_set(b" \t\n\v\f\r")


@dataclass
class Slice:
    """Some whole texts: word ``i`` has hash ``word[i]`` and bytes ``start[i]:end[i]`` of ``raw``.

    Text ``j`` of the slice has the words ``first[j]:first[j + 1]`` and starts at byte ``origin[j]``.
    """

    at: int  # place of the first text in the batch
    raw: np.ndarray
    origin: np.ndarray
    word: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n + 1 of them."""
    if len(_powers[0]) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        for i, base in enumerate((_BASE, _BACK)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def _tokenise(at: int, raw: np.ndarray, bounds: np.ndarray, lower: bool, gaps: np.ndarray) -> Slice:
    """``bounds``: byte offsets of the texts in ``raw``, with the end."""
    n = len(raw)
    space = gaps[raw]
    begins = ~space
    previous = np.ones(n, dtype=bool)
    if n:
        previous[1:] = space[:-1]
        inner = bounds[:-1]
        previous[inner[inner < n]] = True
    start = np.flatnonzero(begins & previous)
    after = np.ones(n, dtype=bool)
    if n:
        after[:-1] = space[1:]
        ends = bounds[1:] - 1
        after[ends[ends >= 0]] = True
    end = np.flatnonzero(begins & after) + 1
    power, back = _power(n)
    folded = _LOWER[raw] if lower else raw
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[folded] * power[:n], out=sums[1:])
    word = mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64) * _STEP)
    first = np.searchsorted(start, bounds)
    return Slice(at, raw, bounds[:-1], word, start, end, first)


def slices(texts: pa.Array, lower: bool = True, gaps: np.ndarray = _SPACE) -> Iterator[Slice]:
    """The texts of a string column (NULL as empty), slice by slice; ``gaps`` tells which bytes part words."""
    texts = texts.fill_null("")
    offset_type = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(offsets, offset_type)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE_BYTES, side="right")) - 1)
        yield _tokenise(lo, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], lower, gaps)
        lo = hi


def shingles(word: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words; of the whole sequence where there are fewer words, if any."""
    n = len(word)
    k = min(k, n)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.full(n - k + 1, np.uint64(k), np.uint64)
    for i in range(k):
        h = mix(h * _STEP + word[i : n - k + 1 + i])
    return h


def span_hash(word: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the word runs ``begin:end``, whatever their lengths."""
    power, back = _power(len(word))
    sums = np.zeros(len(word) + 1, np.uint64)
    np.cumsum(word * power[: len(word)], out=sums[1:])
    return mix((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64) * _STEP)


def shingle_sets(part: Slice, k: int) -> list[np.ndarray]:
    """For each text of the slice its distinct shingle hashes, ascending."""
    long = np.diff(part.first) >= k
    runs = shingles(part.word, k) if len(part.word) >= k else np.zeros(0, np.uint64)
    sets = []
    for j in range(len(part)):
        lo, hi = part.first[j], part.first[j + 1]
        sets.append(np.unique(runs[lo : hi - k + 1] if long[j] else shingles(part.word[lo:hi], k)))
    return sets


def code_points(part: Slice, offsets: np.ndarray, text: int) -> np.ndarray:
    """Byte offsets in the slice as code-point offsets in the given text."""
    begin = int(part.origin[text])
    stop = int(offsets.max()) if len(offsets) else begin
    lead = np.zeros(stop - begin + 1, np.int64)
    np.cumsum((part.raw[begin:stop] & 0xC0) != 0x80, out=lead[1:])
    return lead[offsets - begin]
