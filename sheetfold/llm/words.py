"""Words of many texts at once, as NumPy arrays of byte offsets and 64-bit digests.

Texts are UTF-8 bytes. A word is the longest run of bytes other than the ASCII white space
``\\x20 \\x09-\\x0D`` (the same words as the pattern ``[^\\x20\\x09-\\x0D]+`` over characters, as
no byte of a longer UTF-8 character is white space).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256)
_LOWER[ord("A"):ord("Z") + 1] += 32
_STEP = 0x9E3779B97F4A7C15 | 1
#: Bytes of text handled at once.
CHUNK_BYTES = 1 << 18


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of SplitMix64)."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def digests_of(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit digests of the byte ranges ``starts`` to ``ends`` (none empty, none overlapping).

    Blocks of eight bytes are mixed one by one, each with a key of its place, before they are
    added up: no pattern of bytes makes such sums equal, as it can those of a polynomial."""
    lengths = ends - starts
    before = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum())) - np.repeat(before, lengths)
    values = (_LOWER if lower else np.arange(256)).astype(np.uint64)
    shifted = values[buf[at + np.repeat(starts, lengths)]] << ((at & 7) << 3).astype(np.uint64)
    blocks = np.add.reduceat(shifted, np.flatnonzero((at & 7) == 0))
    counts = (lengths + 7) >> 3
    first = np.cumsum(counts) - counts
    place = np.arange(len(blocks)) - np.repeat(first, counts)
    keys = mix64(np.arange(1, int(counts.max(initial=1)) + 1, dtype=np.uint64) * np.uint64(_STEP))
    return mix64(np.add.reduceat(mix64(blocks ^ keys[place]), first) + lengths.astype(np.uint64) * np.uint64(_STEP))


class Words(NamedTuple):
    starts: np.ndarray  # byte offset of each word in the joined buffer
    ends: np.ndarray    # one past its last byte
    digests: np.ndarray
    first: np.ndarray   # first[d] .. first[d + 1]: the words of text d
    base: np.ndarray    # byte offset of each text in the joined buffer
    buffer: np.ndarray


def words_of(texts: list[bytes], digests: bool = True) -> Words:
    """All words of ``texts``. Their digests, if wanted, ignore the case of A-Z."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    base = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if texts else np.zeros(0, np.int64)
    space = _SPACE[buf]
    edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=np.int8(1)))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Words(none, none, none.astype(np.uint64), np.zeros(len(texts) + 1, np.int64), base, buf)
    found = digests_of(buf, starts, ends, lower=True) if digests else np.zeros(0, np.uint64)
    first = np.searchsorted(starts, np.append(base, len(buf)))
    return Words(starts, ends, found, first, base, buf)


def slices(batches, rows: int = 1024):
    """Record batches in slices of ``rows``, so that few texts are Python objects at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def chunks(texts: list[bytes | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """``texts`` in runs of about ``limit`` bytes with the index of each run's first; null as empty."""
    run: list[bytes] = []
    size = begin = 0
    for i, t in enumerate(texts):
        run.append(t or b"")
        size += len(run[-1])
        if size >= limit:
            yield begin, run
            run, size, begin = [], 0, i + 1
    if run:
        yield begin, run


_SHINGLE = np.array([0x8CB92BA72F3D8DD7, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                     0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9C6E6877736C46E3], np.uint64)


def shingle_sets(w: Words, k: int = 5) -> list[np.ndarray]:
    """For each text its set of ``k``-word shingles as sorted distinct 64-bit digests; with fewer
    words the whole sequence is one shingle, without words the set is empty."""
    n = len(w.digests)
    if n >= k:
        total = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            total += w.digests[j:n - k + 1 + j] * _SHINGLE[j]
        total = mix64(total)
    sets = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if b - a >= k:
            sets.append(np.unique(total[a:b - k + 1]))
        elif b > a:
            sets.append(mix64((w.digests[a:b] * _SHINGLE[:b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
