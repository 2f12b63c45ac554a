"""Array operations over the bytes of many texts: word borders, hashes of any range, minimisers.

Range hashes come from prefix sums modulo 2**64: S[i] sums t[symbol] * base**j over j < i, with a random
64-bit value t per byte, so a range is (S[e] - S[s]) * base**-s, mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of texts handled at a time (a longer text is handled alone).
CHUNK_BYTES = 500_000
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
#: Word borders: space and the characters 9 to 13.
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True


def _table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, 256, np.uint64)


BYTE_VALUES = _table(11)
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[65:91] = LOWER_VALUES[97:123]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        n = max(n, CHUNK_BYTES + 1024)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """S of length len(values) + 1 for symbols given as 64-bit values."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(len(values) + 1)[0][:len(values)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * _powers(len(sums))[1][starts])


def chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets from 0, bytes) for runs of rows of about CHUNK_BYTES."""
    raw = texts.cast(pa.large_binary())
    if not len(raw):
        return
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2], np.uint8) if raw.buffers()[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(raw):
        top = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1)
        top = min(top, len(raw))
        yield row, offsets[row:top + 1] - offsets[row], data[offsets[row]:offsets[top]]
        row = top


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, counts per text) of all words, in order; no word crosses texts."""
    inside = ~SPACES[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    first = before.copy()
    first[offsets[:-1]] = False  # a text's first byte follows no word
    starts = np.nonzero(inside & ~first[:-1])[0]
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[offsets[1:]] = False  # and its last precedes none
    ends = np.nonzero(inside & ~after[1:])[0] + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False):
    """(hash per word, starts, ends, offsets of the words of each text)."""
    starts, ends, counts = words(data, offsets)
    sums = prefix_sums((LOWER_VALUES if lower else BYTE_VALUES)[data])
    return range_hash(sums, starts, ends), starts, ends, np.concatenate(([0], np.cumsum(counts)))


def long_word_hashes(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hash per word of one text, piece by piece: a hash does not depend on the word's place."""
    out, at = [], 0
    while at < len(data):
        end = at + CHUNK_BYTES
        while end < len(data) and not SPACES[data[end - 1]]:  # a piece ends after a space
            gap = np.nonzero(SPACES[data[end:end + CHUNK_BYTES]])[0]
            end = end + int(gap[0]) + 1 if len(gap) else end + CHUNK_BYTES
        piece = data[at:end]
        out.append(word_hashes(piece, np.array([0, len(piece)]), lower)[0])
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours (one per window start)."""
    n = len(keys)
    if n < width:
        return np.zeros(0, keys.dtype)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(keys.dtype).max, keys.dtype)
    padded[:n] = keys
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def anchors(gram_hashes: np.ndarray, offsets: np.ndarray, window: int, gram: int):
    """Minimiser runs: every window of ``window`` symbols is owned by the leftmost least of its grams
    (``gram`` symbols each; gram_hashes[i] starts at symbol i). Equal windows own equal grams at equal places.
    Returns (owner position, first window start, last window start) of runs of windows with one owner;
    ``offsets`` are the texts' symbol offsets, and no window crosses a text's end."""
    n = int(offsets[-1])
    starts = np.nonzero(_fits(offsets, window))[0]
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3
    bits = np.uint64(max(1, int(n).bit_length()))
    place = np.arange(len(gram_hashes), dtype=np.uint64)
    keys = (gram_hashes >> bits << bits) | place  # leftmost among equal hashes
    least = window_minima(keys, window - gram + 1)[starts]
    owner = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.nonzero(new)[0]
    last = np.append(at[1:], len(starts)) - 1
    return owner[at], starts[at], starts[last]


def _fits(offsets: np.ndarray, window: int) -> np.ndarray:
    """Whether a window that starts at each symbol ends inside its text."""
    n = int(offsets[-1])
    change = np.zeros(n + 1, np.int64)
    sizes = np.diff(offsets)
    long = sizes >= window
    np.add.at(change, offsets[:-1][long], 1)
    np.add.at(change, offsets[1:][long] - window + 1, -1)
    return np.cumsum(change)[:n] > 0
