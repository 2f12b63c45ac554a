"""Substring dedup by prefix-partitioned suffix trees (operator 3).

A word goes if a window of ``window`` words around it also starts in a document with a smaller doc_id.
``repeats`` finds the stretches of windows that may repeat; each is a bundle of suffixes around a shared run
of words. Suffixes are split by prefix: bundles with equal owner words form a group, groups fill a
subtree up to a set size, and a group above that size is split by the longest prefix, the whole window, with
partial aggregation. A subtree is grown level by level over its suffixes (1, 2, 4, ... words deep, only
branches with more than one suffix go on), so the nodes it reaches at ``window`` words are the deep
internal nodes: their leaves are the places of one repeated window, and neighbouring ones join to
maximal repeats.

Defined results: null texts have no words; rows without doc_id are compared with none and stay whole; rows
that share a doc_id are not smaller than each other, so they don't remove each other's words; texts below
``window`` words stay whole; an empty table gives no rows; extra columns are not read. Windows are judged on the
input, over whole texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from txnguard.llm import repeats as R
from txnguard.llm import rolling
from txnguard.llm.common import staged
from txnguard.llm.wordwise import whole_texts

WINDOW = 50
GRAM = 8
#: Words of the suffixes that one subtree takes (more only if one group has more, up to HOT_STRETCHES).
SUBTREE_WORDS = 2_000_000


def deep_nodes(symbols: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Node reached at ``depth`` symbols by the suffix at each start; -1 where it branched off alone before."""
    _, rank = np.unique(symbols, return_inverse=True)  # depth 1, for every position
    rank = rank.astype(np.int64)
    at, node, have = starts, rank[starts], 1
    level, size = rank, 1
    live = np.arange(len(starts))
    out = np.full(len(starts), -1, np.int64)
    while len(live):
        _, node, counts = np.unique(node, return_inverse=True, return_counts=True)
        some = counts[node] > 1
        live, at, node = live[some], at[some], node[some]
        if have >= depth or not len(live):
            break
        if size * 2 <= depth - have and size * 2 <= have * 2:
            nxt = np.zeros_like(level)  # names of twice as many symbols, for every position
            pairs = level[:-size] * (int(level.max()) + 1) + level[size:]
            _, nxt[:-size] = np.unique(pairs, return_inverse=True)
            level, size = nxt, size * 2
        step = min(size, depth - have)
        shift = have + step - size  # overlaps what is known when the rest is shorter
        node = node * (int(level.max()) + 1) + level[at + shift]
        have += step
    out[live] = node
    return out


def _pieces(joined: DataFrame, window: int) -> DataFrame:
    """Open stretches with their text, and the single windows of hot ones (h1, h2)."""

    def run(batches):
        for b in batches:
            row, todo = R.todo_arrays(b)
            hot, out = todo["hot"].astype(bool), []
            for top, offsets, data in rolling.chunks(whole_texts(b)):
                hashes, starts, ends, words = rolling.word_hashes(data, offsets)
                here = (row >= top) & (row < top + len(offsets) - 1)
                cold = np.nonzero(here & ~hot)[0]
                first = words[row[cold] - top] + todo["first"][cold]
                last = first + todo["n"][cold] + window - 2
                raw = data.tobytes()
                bodies = [raw[s:e] for s, e in zip(starts[first].tolist(), ends[last].tolist(), strict=True)]
                out.append((row[cold], todo["owner"][cold], None, todo["first"][cold], todo["n"][cold], bodies))
                warm = np.nonzero(here & hot)[0]
                if len(warm):
                    which, at, h1, h2 = R.hot_windows(hashes, words[row[warm] - top], todo["first"][warm],
                                                      todo["n"][warm].astype(np.int64), window)
                    out.append((row[warm][which], h1.view(np.int64), h2.view(np.int64), at,
                                np.ones(len(at), np.int16), None))
            for rows, h1, h2, first, n, bodies in out:
                rows = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1, pa.int64()), pa.nulls(len(rows), pa.int64()) if h2 is None else pa.array(h2),
                     b.column("doc_id").take(rows), b.column("tag").take(rows), pa.array(first.astype(np.int32)),
                     pa.array(n.astype(np.int16)),
                     pa.nulls(len(rows), pa.binary()) if bodies is None else pa.array(bodies, pa.binary())],
                    ["h1", "h2", "doc_id", "tag", "first", "n", "body"])

    id_type = joined.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"h1 long, h2 long, doc_id {id_type}, tag smallint, first int, n smallint, body binary")


def _subtrees(pieces: DataFrame, window: int) -> DataFrame:
    """Repeats among the bundles of each owner: doc_id, tag, first, n."""

    def solve(t: pa.Table):
        bodies = t.column("body").combine_chunks().cast(pa.large_binary())
        owners, n = R.column(t, "h1"), R.column(t, "n").astype(np.int64)
        ids, tags, first = R.column(t, "doc_id"), R.column(t, "tag"), R.column(t, "first").astype(np.int64)
        symbols, base, done = [], [], 0
        for _, offsets, data in rolling.chunks(bodies):
            hashes, _, _, words = rolling.word_hashes(data, offsets)
            symbols.append(hashes)
            base.append(words[:-1] + done)
            done += len(hashes)
        symbols, base = np.concatenate(symbols), np.concatenate(base)
        which = np.repeat(np.arange(len(n)), n)
        step = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        node = deep_nodes(symbols, base[which] + step, window)
        deep = np.nonzero(node >= 0)[0]
        which, at = which[deep], first[which[deep]] + step[deep]
        repeat = R.repeat_flags([node[deep], owners[which]], ids[which], tags[which], at, False)
        rows, at, count = R.runs_of(which[repeat], at[repeat])
        rows = pa.array(rows)
        return pa.RecordBatch.from_arrays(
            [t.column("doc_id").combine_chunks().take(rows), t.column("tag").combine_chunks().take(rows),
             pa.array(at.astype(np.int32)), pa.array(count.astype(np.int16))], ["doc_id", "tag", "first", "n"])

    def run(batches):
        held, words = [], 0
        for b in batches:  # sorted by owner
            n = int(R.column(b, "n").astype(np.int64).sum()) + window * b.num_rows
            held.append(b)
            words += n
            if words >= SUBTREE_WORDS:
                t = pa.Table.from_batches(held)
                owners = R.column(t, "h1")
                cut = int(np.searchsorted(owners, owners[-1]))  # the last owner may go on
                if cut:
                    yield solve(t.slice(0, cut))
                    t = t.slice(cut)
                held, words = t.to_batches(), (window + 10) * t.num_rows
        if held and sum(b.num_rows for b in held):
            yield solve(pa.Table.from_batches(held))

    id_type = pieces.schema["doc_id"].dataType.simpleString()
    rows = pieces.select("h1", "doc_id", "tag", "first", "n", "body")
    return (rows.repartition("h1").sortWithinPartitions("h1")
            .mapInArrow(run, f"doc_id {id_type}, tag smallint, first int, n smallint"))


def find_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, tag, first, n: runs of windows (by first word) that also start in a smaller doc_id."""
    rows = R.tagged(docs)
    classes = staged(R.classify(rows, R.word_symbols, window, min(GRAM, window), within=False), "word-stretches")
    pieces = staged(_pieces(R.open_by_document(rows, classes), window), "word-pieces")
    whole = classes.filter("not open").select("doc_id", "tag", "first", "n")
    cold = _subtrees(pieces.filter("body is not null"), window)
    hot = R.resolve_hot(pieces.filter("body is null").select("h1", "h2", "doc_id", "tag", "first"), within=False)
    return staged(whole.unionByName(cold).unionByName(hot), "word-repeats")


def kept_texts(docs: DataFrame, window: int = WINDOW, digest: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept (the other words joined by a space), or kept_sha256."""

    def run(batches):
        for b in batches:
            texts, spans = whole_texts(b).cast(pa.large_binary()), b.column("repeats")
            n_words, n_removed, kept = [], [], []
            for i in range(b.num_rows):
                words = texts[i].as_py().split()
                gone = 0
                own = spans[i].as_py()
                n_words.append(len(words))
                if own:
                    mask = R.covered(len(words), own, window)
                    gone = int(mask.sum())
                    words = [w for w, m in zip(words, mask.tolist(), strict=True) if not m]
                n_removed.append(gone)
                text = b" ".join(words)
                kept.append(hashlib.sha256(text).hexdigest() if digest else text.decode())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", out])

    out = "kept_sha256" if digest else "kept"
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = R.with_repeats(docs, find_repeats(docs, window))
    return rows.mapInArrow(run, f"doc_id {id_type}, n_words long, n_removed long, {out} string")
