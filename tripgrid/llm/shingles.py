"""Word shingles of whole Arrow columns, hashed to 64 bits with numpy.

Words are runs of ``[^\\x20\\x09-\\x0D]`` after lower-casing A-Z; both rules
are per byte in UTF-8. A word's hash is a sum of table values by byte and
place, a shingle's hash a weighted sum of its words' mixed hashes; no Python
object is made per word. Columns are worked off in slabs of bounded size (one
text at least).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
SLAB_BYTES = 2 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PLACES = 64
_rng = np.random.Generator(np.random.PCG64(20130319))
_TABLE = _rng.integers(0, 1 << 64, size=_PLACES * 256, dtype=np.uint64)
_FACTOR = _rng.integers(0, 1 << 64, size=64, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts between ``offsets``, and each text's first word."""
    inside = ~_SPACE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    opens[begins] = inside[begins]  # a word never runs from one text into the next
    starts = np.flatnonzero(opens)
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), first
    at = np.flatnonzero(inside)
    heads = np.searchsorted(at, starts)
    lengths = np.diff(np.append(heads, len(at)))
    place = np.arange(len(at)) - np.repeat(heads, lengths)
    values = _TABLE[(place % _PLACES) * 256 + _LOWER[data[at]]]
    if lengths.max() > _PLACES:
        values *= (2 * (place // _PLACES) + 1).astype(np.uint64)
    hashes = np.add.reduceat(values, heads) + lengths.astype(np.uint64) * _FACTOR[63]
    return mix(hashes), first


def _slab_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[np.ndarray]:
    hashes, first = _word_hashes(data, offsets)
    n = len(hashes)
    shingles = np.zeros(max(0, n - words + 1), dtype=np.uint64)
    for k in range(words):
        shingles += hashes[k : k + len(shingles)] * _FACTOR[k]
    shingles = mix(shingles)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            found = np.sort(shingles[a : b - words + 1])
            keep = np.empty(len(found), dtype=bool)
            keep[0] = True
            np.not_equal(found[1:], found[:-1], out=keep[1:])
            yield found[keep]
        elif b > a:  # a short text is one shingle; its length keeps it apart from longer ones
            terms = np.append(hashes[a:b] * _FACTOR[: b - a], _FACTOR[40 + b - a])
            yield mix(terms.sum(dtype=np.uint64, keepdims=True))
        else:
            yield np.empty(0, dtype=np.uint64)


def shingle_sets(column: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a string column (null: none)."""
    if not 1 <= words <= 20:
        raise ValueError("words must be 1 to 20")
    column = column.fill_null("").cast(pa.large_binary())
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer else np.empty(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLAB_BYTES, side="right")) - 1)
        end = min(end, len(column))
        yield from _slab_sets(data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row], words)
        row = end
