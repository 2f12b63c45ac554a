"""Encode a batch of texts word by word: each distinct word of the batch is encoded once, and the ids of
all texts are gathered from the distinct words with array operations."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct words that one worker remembers between batches (about 250 bytes each).
CACHE_WORDS = 500_000


#: Rows whose ids are gathered at a time: bounds a task's arrays, whatever the size of an Arrow batch.
SLICE_ROWS = 2000


def slices(batches, rows: int = SLICE_ROWS):
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def ragged_take(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """Concatenate flat[starts[i] : starts[i] + lengths[i]] for each i of ``pick``."""
    n = lengths[pick]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total, dtype=np.int64) - np.repeat(ends - n, n) + np.repeat(starts[pick], n)
    return flat[at]


class WordCache:
    """word -> ids as little-endian uint32 bytes. When it is full it takes no more: the frequent words came early,
    others are encoded anew, and memory stays bounded."""

    def __init__(self, encode: Callable[[str], bytes], limit: int = CACHE_WORDS):
        self.encode, self.limit, self.known = encode, limit, {}

    def get(self, words: list[str]) -> list[bytes]:
        known, encode, room = self.known, self.encode, self.limit - len(self.known)
        out = list(map(known.get, words))
        for i, ids in enumerate(out):
            if ids is None:
                out[i] = ids = encode(words[i])
                if room > 0:
                    known[words[i]] = ids
                    room -= 1
        return out


def encode_texts(texts: pa.Array, cache: WordCache, first: WordCache | None = None,
                 unsafe: Callable[[str], bool] | None = None,
                 whole: Callable[[str], bytes] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of all texts, cut at single spaces. ``first`` encodes a text's first word where that
    differs from the others (no space before it). A text with an ``unsafe`` word is encoded by ``whole``."""
    lists = pc.split_pattern(texts, " ")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    offsets = offsets - offsets[0]
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    words = coded.dictionary.to_pylist()
    n_texts = len(offsets) - 1
    encoded = cache.get(words)
    if first is not None:
        starts = offsets[:-1]
        firsts, inverse = np.unique(index[starts], return_inverse=True)
        index = index.copy()
        index[starts] = len(words) + inverse
        encoded = encoded + first.get([words[i] for i in firsts])
    lengths = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
    flat = np.frombuffer(b"".join(encoded), dtype="<u4")
    begins = np.cumsum(lengths) - lengths
    per_word = np.concatenate(([0], np.cumsum(lengths[index])))
    out_offsets = per_word[offsets]
    ids = ragged_take(flat, begins, lengths, index)
    if unsafe is not None:
        bad = np.fromiter(map(unsafe, words), bool, len(words))
        if bad.any():
            if first is not None:
                bad = np.concatenate((bad, bad[firsts]))
            hits = np.concatenate(([0], np.cumsum(bad[index])))
            redo = np.nonzero(hits[offsets[1:]] > hits[offsets[:-1]])[0]
            ids, out_offsets = replaced(ids, out_offsets, redo, lambda t: whole(texts[t].as_py()))
    assert len(out_offsets) == n_texts + 1
    return ids, out_offsets


def replaced(ids: np.ndarray, offsets: np.ndarray, rows: np.ndarray,
             encode: Callable[[int], bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) with the ids of ``rows`` encoded anew."""
    if not len(rows):
        return ids, offsets
    parts, sizes, last = [], np.diff(offsets), 0
    for t in rows.tolist():
        own = np.frombuffer(encode(t), dtype="<u4")
        parts += [ids[last:offsets[t]], own]
        last, sizes[t] = offsets[t + 1], len(own)
    return np.concatenate([*parts, ids[last:]]), np.concatenate(([0], np.cumsum(sizes)))


def whole_texts(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The column as one large_string array, null as the empty text. Rows of a slice are copied first: casting
    keeps a slice's offset, and ``pc.ascii_lower`` reads the wrong bytes of such an array."""
    return pc.fill_null(pa.concat_arrays([batch.column(column)]).cast(pa.large_string()), "")
