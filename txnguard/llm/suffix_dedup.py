"""Suffix-array dedup by common-prefix-aware distributed merge sort (operator 10).

A byte goes if a string of ``window`` bytes around it also starts earlier: in a smaller doc_id, or earlier in
the same document. The suffixes that enter the sort are those at the minimisers of stretches that may repeat
(``repeats``): a sparse suffix array in which every repeated string is met. Map tasks sort their suffixes and
send front-coded runs (length shared with the suffix before, and the rest) to the range of the first
symbol, the owner gram. A range merges its runs by a loser tree that knows each contender's common prefix
with the last output and never compares those bytes again; the merge yields the suffix array with its
common-prefix lengths. Two windows are equal if the suffixes between them share what stands right of the
owner and the bytes left of it agree, which is decided for each distance to the owner at once.

Hot owners (more than ``HOT_STRETCHES`` open stretches) are compared window by window with partial
aggregation instead, so no range holds more than a bounded number of one owner's suffixes.

Defined results: null texts have no bytes; rows without doc_id are compared with none and stay whole; rows that
share doc_id and text have equal results and don't remove each other, nor do different texts under one doc_id;
texts below ``window`` bytes stay whole; an empty
table gives no rows; extra columns are not read. Strings are judged on the input, over whole texts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from txnguard.llm import repeats as R
from txnguard.llm import rolling
from txnguard.llm.common import staged
from txnguard.llm.wordwise import whole_texts

WINDOW = 100
GRAM = 24
#: Suffixes that one range merges on average.
RANGE_SUFFIXES = 20_000
#: Bytes of the owner's hash, the first symbol of every sort key.
HEAD = 8


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, given that the first ``known`` bytes agree."""
    end = min(len(a), len(b))
    x, y = a[known:end], b[known:end]
    if x == y:
        return end
    differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return end - (differ.bit_length() + 7) // 8


def front_coded(keys: list[bytes]) -> list[tuple[int, bytes]]:
    """(bytes shared with the key before, the rest) of sorted keys."""
    out, last = [], b""
    for k in keys:
        shared = common_prefix(last, k, 0)
        out.append((shared, k[shared:]))
        last = k
    return out


class LoserTree:
    """Merges front-coded sorted runs. Each contender keeps the length of its common prefix with the last
    output: the longer one wins without a comparison, equal ones are compared from there on."""

    def __init__(self, runs: list[list[tuple[int, bytes]]]):
        self.runs, k = runs, len(runs)
        self.size = 1 << max(0, k - 1).bit_length()
        self.keys: list[bytes | None] = [r[0][1] if r else None for r in runs] + [None] * (self.size - k)
        self.shared, self.next = [0] * self.size, [1] * self.size
        self.loser = [0] * self.size
        self.winner = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        return self._play(self._build(2 * node), self._build(2 * node + 1), node)

    def _play(self, a: int, b: int, node: int) -> int:
        """The winner of a and b; the loser stays at the node."""
        keys, shared = self.keys, self.shared
        if keys[a] is None or keys[b] is not None and shared[a] < shared[b]:
            a, b = b, a
        elif keys[b] is not None and shared[a] == shared[b]:
            at = common_prefix(keys[a], keys[b], shared[a])
            if keys[a][at:at + 1] > keys[b][at:at + 1]:
                a, b = b, a
            shared[b] = at
        self.loser[node] = b
        return a

    def __iter__(self):
        """(run, place in the run, common prefix with the output before) in sorted order."""
        while self.keys[self.winner] is not None:
            w = self.winner
            at = self.next[w]
            yield w, at - 1, self.shared[w]
            if at < len(self.runs[w]):
                self.shared[w], rest = self.runs[w][at]
                self.keys[w] = self.keys[w][:self.shared[w]] + rest
                self.next[w] = at + 1
            else:
                self.keys[w] = None
            node = (w + self.size) >> 1
            while node:
                w = self._play(w, self.loser[node], node)
                node >>= 1
            self.winner = w


def _pieces(joined: DataFrame, window: int, gram: int, n_ranges: int) -> DataFrame:
    """Front-coded runs of the open stretches' suffixes (one row each, in order), and the windows of hot ones."""

    def run(batches):
        task = TaskContext.get().partitionId() << 24
        for count, b in enumerate(batches):
            row, todo = R.todo_arrays(b)
            hot = todo["hot"].astype(bool)
            keys, index, lefts = [], [], []
            for top, offsets, data in rolling.chunks(whole_texts(b)):
                here = (row >= top) & (row < top + len(offsets) - 1)
                cold = np.nonzero(here & ~hot)[0]
                raw = data.tobytes()
                start = offsets[row[cold] - top] + todo["first"][cold]
                owner = start + todo["place"][cold]
                end = start + todo["n"][cold] + window - 1
                heads = todo["owner"][cold].astype(">i8").tobytes()
                for j, (s, o, e) in enumerate(zip(start.tolist(), owner.tolist(), end.tolist(), strict=True)):
                    keys.append(heads[HEAD * j:HEAD * j + HEAD] + raw[o + gram:e])
                    lefts.append(raw[s:o])
                index.append(cold)
                warm = np.nonzero(here & hot)[0]
                if len(warm):
                    which, at, h1, h2 = R.hot_windows(rolling.BYTE_VALUES[data], offsets[row[warm] - top],
                                                      todo["first"][warm], todo["n"][warm].astype(np.int64), window)
                    yield batch(b, row[warm][which], at, np.ones(len(at)), h1=pa.array(h1.view(np.int64)),
                                h2=pa.array(h2.view(np.int64)))
            index = np.concatenate(index) if index else np.zeros(0, np.int64)
            order = sorted(range(len(keys)), key=keys.__getitem__)
            coded = front_coded([keys[i] for i in order])
            pick = index[order]
            heads = todo["owner"][pick].view(np.uint64) >> np.uint64(32)
            ranges = (heads * np.uint64(n_ranges) >> np.uint64(32)).astype(np.int32)
            for i in np.nonzero(np.diff(ranges, prepend=-1))[0].tolist():  # a range's run starts with a whole key
                coded[i] = (0, keys[order[i]])
            yield batch(b, row[pick], todo["first"][pick], todo["n"][pick], range=pa.array(ranges),
                        run=pa.array(np.full(len(pick), task + count)), seq=pa.array(np.arange(len(pick), dtype=np.int32)),
                        place=pa.array(todo["place"][pick]),
                        shared=pa.array(np.array([c[0] for c in coded], np.int16)),
                        rest=pa.array([c[1] for c in coded], pa.binary()),
                        left=pa.array([lefts[i] for i in order], pa.binary()))

    id_type = joined.schema["doc_id"].dataType.simpleString()
    kinds = {"range": pa.int32(), "run": pa.int64(), "seq": pa.int32(), "place": pa.int16(), "shared": pa.int16(),
             "rest": pa.binary(), "left": pa.binary(), "h1": pa.int64(), "h2": pa.int64()}

    def batch(b, rows, first, n, **given):
        rows = pa.array(rows)
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id").take(rows), b.column("tag").take(rows), pa.array(np.asarray(first).astype(np.int32)),
             pa.array(np.asarray(n).astype(np.int16)), *[given.get(k, pa.nulls(len(rows), t)) for k, t in kinds.items()]],
            ["doc_id", "tag", "first", "n", *kinds])

    return joined.mapInArrow(run, f"doc_id {id_type}, tag smallint, first int, n smallint, range int, run long, seq int, "
                                  "place smallint, shared smallint, rest binary, left binary, h1 long, h2 long")


def _merge_ranges(pieces: DataFrame, window: int, gram: int) -> DataFrame:
    """Repeats among the suffixes of each range: doc_id, tag, first, n."""

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by([("run", "ascending"), ("seq", "ascending")])
        run = R.column(table, "run")
        begins = np.append(np.nonzero(np.diff(run, prepend=run[0] - 1))[0], len(run)).tolist()
        coded = list(zip(R.column(table, "shared").tolist(), table.column("rest").to_pylist(), strict=True))
        runs = [coded[s:e] for s, e in zip(begins[:-1], begins[1:], strict=True)]
        merged = [(begins[w] + i, lcp) for w, i, lcp in LoserTree(runs)]
        order = np.array([m[0] for m in merged])
        right = np.array([m[1] for m in merged]) - HEAD  # shared right of the owner gram, negative: other owner
        ids, tags, first, n, place = (R.column(table, c)[order] for c in ("doc_id", "tag", "first", "n", "place"))
        first, n, place = first.astype(np.int64), n.astype(np.int64), place.astype(np.int64)
        lefts = table.column("left").combine_chunks().cast(pa.large_binary()).take(pa.array(order))
        ends = np.frombuffer(lefts.buffers()[1], np.int64)[lefts.offset:lefts.offset + len(lefts) + 1][1:]
        data = np.frombuffer(lefts.buffers()[2], np.uint8) if len(order) and lefts.buffers()[2] is not None \
            else np.zeros(0, np.uint8)
        left_hash = np.zeros(len(order), np.uint64)
        rows, at = [], []
        for t in range(int(place.max()) + 1):  # windows that start t bytes before the owner
            own = np.nonzero((place - n < t) & (t <= place))[0]
            if len(own):
                same = np.cumsum(right < window - t - gram)[own]
                _, name, size = np.unique(same, return_inverse=True, return_counts=True)
                own, same = own[size[name] > 1], same[size[name] > 1]
                start = first[own] + place[own] - t
                repeat = R.repeat_flags([same, left_hash[own]], ids[own], tags[own], start, True)
                rows.append(own[repeat])
                at.append(start[repeat])
            more = place > t
            byte = np.zeros(len(order), np.uint64)
            byte[more] = rolling.BYTE_VALUES[data[ends[more] - 1 - t]]
            left_hash = rolling.mix(left_hash * np.uint64(0x9E3779B97F4A7C15) + byte)
        rows, at = np.concatenate(rows), np.concatenate(at)
        by = np.lexsort((at, rows))
        rows, at, count = R.runs_of(rows[by], at[by])
        took = pa.array(order[rows])
        return pa.table({"doc_id": table.column("doc_id").take(took), "tag": table.column("tag").take(took),
                         "first": at.astype(np.int32), "n": count.astype(np.int16)})

    id_type = pieces.schema["doc_id"].dataType.simpleString()
    return pieces.drop("h1", "h2").groupBy("range").applyInArrow(
        merge, f"doc_id {id_type}, tag smallint, first int, n smallint")


def find_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, tag, first, n: runs of strings (by first byte) that also start earlier."""
    gram = min(GRAM, window)
    rows = R.tagged(docs)
    classes = staged(R.classify(rows, R.byte_symbols, window, gram, within=True), "byte-stretches")
    n_ranges = max(1, -(-classes.filter("open").count() // RANGE_SUFFIXES))
    pieces = staged(_pieces(R.open_by_document(rows, classes), window, gram, n_ranges), "suffix-runs")
    whole = classes.filter("not open").select("doc_id", "tag", "first", "n")
    cold = _merge_ranges(pieces.filter("rest is not null"), window, gram)
    hot = R.resolve_hot(pieces.filter("rest is null").select("h1", "h2", "doc_id", "tag", "first"), within=True)
    return staged(whole.unionByName(cold).unionByName(hot), "byte-repeats")


def kept_bytes(docs: DataFrame, window: int = WINDOW, digest: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (binary), or kept_sha256."""

    def run(batches):
        for b in batches:
            texts, spans = whole_texts(b).cast(pa.large_binary()), b.column("repeats")
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            for i in range(b.num_rows):
                text, own = texts[i].as_py(), spans[i].as_py()
                gone = runs = 0
                n_bytes.append(len(text))
                if own:
                    mask = R.covered(len(text), own, window)
                    gone, runs = int(mask.sum()), int(np.count_nonzero(np.diff(mask.astype(np.int8), prepend=0) == 1))
                    text = np.frombuffer(text, np.uint8)[~mask].tobytes()
                n_removed.append(gone)
                n_spans.append(runs)
                kept.append(hashlib.sha256(text).hexdigest() if digest else text)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(n_spans, pa.int64()), pa.array(kept, pa.string() if digest else pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", out])

    out = "kept_sha256" if digest else "kept"
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = R.with_repeats(docs, find_repeats(docs, window))
    return rows.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, "
                                f"{out} {'string' if digest else 'binary'}")
