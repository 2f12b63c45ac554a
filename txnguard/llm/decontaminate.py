"""Benchmark decontamination with SimHash of item-sized windows (operator 1).

An item of m words is compared with windows of m consecutive words. A window's SimHash is looked up in a
multi-index: fingerprints are cut into ``BLOCKS`` blocks, and two that differ in at most ``RADIUS`` bits
differ in at most RADIUS // BLOCKS bits of some block, so listing every item under all block values that
near guarantees to meet all items within the radius. Candidates are verified by the exact similarity of
their shingle multisets (each shingle weighted by its count): summed minima over summed maxima.

A similarity above zero needs a shared shingle, so only windows around one are fingerprinted; nothing that
could pass is left out. Where no shingle repeats, the bit distance at a similarity of 0.8 has mean 9.7 and deviation 2.9,
which puts RADIUS over three deviations away. A repeated shingle weighs more in a fingerprint and no radius holds: windows
that repeat a shingle, and items that do, are verified with each other by the exact similarity alone, wherever
they share a shingle. Documents are read in one map over whole texts without a shuffle, long ones by pieces; bit sums
are kept for at most ``SPAN`` words at a time. Items go to the tasks in blocks of bounded size, one pass over the
documents each, whose matches are written before the next block is sent.

Words are lower-cased (A-Z) runs without white space. Items of fewer words than a shingle are one shingle.
A document shorter than the item is one window. Defined results: null and empty texts and items match
nothing; repeated rows and ties give one pair, with the greatest similarity and then the first window;
empty tables give no rows; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnguard.llm import rolling
from txnguard.llm.common import staged
from txnguard.llm.simhash import _masks
from txnguard.llm.wordwise import whole_texts

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 19
BLOCKS = 4
#: Words whose bit sums are kept at a time (64 of four bytes each).
SPAN = 65_536
#: Items, and bytes of their texts, that one pass over the documents takes.
BLOCK_ITEMS = 1000
BLOCK_BYTES = 2_000_000


def _grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words."""
    out = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for j in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[j:j + len(out)]
    return rolling.mix(out)


def _bits(grams: np.ndarray) -> np.ndarray:
    return np.unpackbits(grams.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _fingerprints(sums: np.ndarray, sizes) -> np.ndarray:
    return np.packbits(sums * 2 > np.reshape(sizes, (-1, 1)), axis=1, bitorder="little").view("<u8").ravel()


def similarity(a: Counter, b: Counter) -> float:
    common = sum(min(c, b[g]) for g, c in a.items() if g in b)
    return common / (sum(a.values()) + sum(b.values()) - common)


class Items:
    """One block of benchmark items with the multi-index over their fingerprints."""

    def __init__(self, rows: list[tuple[int, str]], n: int = SHINGLE_WORDS):
        self.ids, self.sizes, self.shingles, prints = [], [], [], []
        self.by_gram: dict[int, dict[int, dict[int, set[int]]]] = {}  # shingle length -> shingle hash -> item size -> items
        self.repeating: set[int] = set()  # items that hold a shingle more than once
        for item_id, text in rows:
            data = np.frombuffer((text or "").encode(), np.uint8)
            hashes = rolling.word_hashes(data, np.array([0, len(data)]), lower=True)[0]
            if not len(hashes):
                continue
            g = min(n, len(hashes))
            grams = _grams(hashes, g)
            self.ids.append(item_id)
            self.sizes.append(len(hashes))
            self.shingles.append(Counter(grams.tolist()))
            prints.append(_fingerprints(_bits(grams).sum(0, dtype=np.int64)[None, :], [len(grams)])[0])
            if len(self.shingles[-1]) < len(grams):
                self.repeating.add(len(self.ids) - 1)
            for h in self.shingles[-1]:
                self.by_gram.setdefault(g, {}).setdefault(h, {}).setdefault(len(hashes), set()).add(len(self.ids) - 1)
        prints = np.array(prints, np.uint64)
        self.sizes, self.prints = np.array(self.sizes, np.int64), prints
        self.seeds = {g: np.array(sorted(m), np.uint64) for g, m in self.by_gram.items()}
        bits = 64 // BLOCKS
        near = np.array(_masks(bits, RADIUS // BLOCKS), np.int64)
        self.index = []
        for block in range(BLOCKS):
            values = (prints >> np.uint64(bits * block)).astype(np.int64) & ((1 << bits) - 1)
            keys = (values[:, None] ^ near[None, :]).ravel()
            order = np.argsort(keys, kind="stable")
            bounds = np.searchsorted(keys[order], np.arange((1 << bits) + 1))
            self.index.append((bounds, np.repeat(np.arange(len(prints), dtype=np.int32), len(near))[order]))

    def within(self, fingerprint: int, size: int) -> np.ndarray:
        """Items of ``size`` words within RADIUS bits, by way of the blocks."""
        bits, met = 64 // BLOCKS, []
        for block, (bounds, items) in enumerate(self.index):
            value = fingerprint >> bits * block & (1 << bits) - 1
            met.append(items[bounds[value]:bounds[value + 1]])
        met = np.unique(np.concatenate(met))
        met = met[self.sizes[met] == size]
        return met[np.bitwise_count(self.prints[met] ^ np.uint64(fingerprint)) <= RADIUS]

    def matches(self, hashes: np.ndarray, grams: np.ndarray, g: int, hits: np.ndarray, threshold: float):
        """(item, similarity, first word) of one document, given where it holds item shingles."""
        n, best = len(hashes), {}
        wanted: dict[int, list[int]] = {}
        for p in hits.tolist():
            for size in self.by_gram[g][int(grams[p])]:
                wanted.setdefault(size, []).append(p)
        for size, places in wanted.items():
            own, places = min(size, n), np.array(places)
            spread = own - g + 1  # shingles of a window
            # runs of window starts around the hits, a bounded stretch of words at a time
            low, high = np.maximum(places - spread + 1, 0), np.minimum(places, n - own)
            for first, last in _stretches(low, high):
                starts = np.arange(first, last + 1)
                part = grams[first:last + spread]
                sums = np.zeros((len(part) + 1, 64), np.int32)
                np.cumsum(_bits(part), axis=0, dtype=np.int32, out=sums[1:])
                prints = _fingerprints(sums[starts - first + spread] - sums[starts - first], [spread])
                again = _repeats(part, spread)
                for start, fp in zip(starts.tolist(), prints.tolist(), strict=True):
                    found = set(self.within(fp, size).tolist())
                    if again[start - first] or self.repeating:
                        inside = places[np.searchsorted(places, start):np.searchsorted(places, start + spread)]
                        shared = set().union(*(self.by_gram[g][int(grams[p])].get(size, ()) for p in inside.tolist()))
                        found |= shared if again[start - first] else shared & self.repeating
                    if found:
                        own_shingles = Counter(grams[start:start + spread].tolist())
                        for item in found:
                            s = similarity(self.shingles[item], own_shingles)
                            if s >= threshold and s > best.get(item, (0.0, 0))[0]:
                                best[item] = (s, start)
        return [(self.ids[i], s, start) for i, (s, start) in sorted(best.items())]


def _stretches(low: np.ndarray, high: np.ndarray):
    """(first, last) window starts of the union of the runs low[i] to high[i] (both ascending), cut to SPAN."""
    new = np.nonzero(low[1:] > np.maximum.accumulate(high)[:-1] + 1)[0] + 1
    for a, b in zip(low[np.concatenate(([0], new))].tolist(), np.maximum.accumulate(high)[np.append(new - 1, len(high) - 1)].tolist(), strict=True):
        for first in range(a, b + 1, SPAN):
            yield first, min(first + SPAN - 1, b)


def _repeats(grams: np.ndarray, spread: int) -> np.ndarray:
    """Whether the window of ``spread`` shingles from each start holds one more than once."""
    change = np.zeros(len(grams) + 1, np.int64)
    order = np.argsort(grams, kind="stable")
    same = grams[order][1:] == grams[order][:-1]
    before, after = order[:-1][same], order[1:][same]  # neighbouring places of one shingle
    near = after - before < spread
    np.add.at(change, np.maximum(after[near] - spread + 1, 0), 1)
    np.add.at(change, before[near] + 1, -1)
    return np.cumsum(change)[:max(len(grams) - spread + 1, 0)] > 0


def _hits(grams: np.ndarray, seeds: np.ndarray, table: np.ndarray) -> np.ndarray:
    maybe = np.nonzero(table[(grams >> np.uint64(42)).astype(np.int64)])[0]
    found = seeds[np.minimum(np.searchsorted(seeds, grams[maybe]), len(seeds) - 1)] == grams[maybe]
    return maybe[found]


def _scan(docs: DataFrame, items: Items, threshold: float) -> DataFrame:
    """The written matches of one block of items, whose index leaves the executors after that."""
    shared = docs.sparkSession.sparkContext.broadcast(items)  # at most BLOCK_ITEMS items of BLOCK_BYTES together

    def run(batches):
        own = shared.value
        tables = {}
        for g, seeds in own.seeds.items():
            tables[g] = np.zeros(1 << 22, bool)
            tables[g][(seeds >> np.uint64(42)).astype(np.int64)] = True
        for b in batches:
            at, ids, sims, starts = [], [], [], []
            for row, offsets, data in rolling.chunks(whole_texts(b)):
                if len(offsets) == 2:
                    hashes = rolling.long_word_hashes(data, lower=True)
                    ends = np.array([0, len(hashes)])
                else:
                    hashes, _, _, ends = rolling.word_hashes(data, offsets, lower=True)
                for g, seeds in own.seeds.items():
                    grams = _grams(hashes, g)
                    hits = _hits(grams, seeds, tables[g])
                    texts = np.searchsorted(ends, hits, "right") - 1
                    inside = hits + g <= ends[texts + 1]
                    hits, texts = hits[inside], texts[inside]
                    for t in np.unique(texts).tolist():
                        first, last = int(ends[t]), int(ends[t + 1])
                        for i, s, start in own.matches(hashes[first:last], grams[first:last - g + 1], g,
                                                       hits[texts == t] - first, threshold):
                            at.append(row + t)
                            ids.append(i)
                            sims.append(s)
                            starts.append(start)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(at, pa.int64())), pa.array(ids, pa.int64()),
                 pa.array(sims, pa.float64()), pa.array(starts, pa.int64())],
                ["doc_id", "item_id", "similarity", "start_word"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    out = staged(docs.mapInArrow(run, f"doc_id {id_type}, item_id long, similarity double, start_word long"), "leaks")
    shared.destroy()
    return out


def _blocks(benchmark: DataFrame):
    """Item rows in id order, in lists bounded by number and bytes; the driver holds one block at a time."""
    rows = (benchmark.select(F.col("item_id").cast("long"), "text").filter("item_id is not null and text is not null")
            .distinct().orderBy("item_id", "text"))
    block, size = [], 0
    for r in rows.toLocalIterator():
        if block and (len(block) == BLOCK_ITEMS or size + len(r[1]) > BLOCK_BYTES):
            yield block
            block, size = [], 0
        block.append((r[0], r[1]))
        size += len(r[1])
    if block:
        yield block


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = SIMILARITY, n: int = SHINGLE_WORDS) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, similarity, start_word of its best window."""
    read = docs.select(docs["doc_id"], docs["text"])
    found = None
    for block in _blocks(benchmark):
        part = _scan(read, Items(block, n), threshold)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = _scan(read.limit(0), Items([], n), threshold)
    best = Window.partitionBy("doc_id", "item_id").orderBy(F.desc("similarity"), "start_word")
    return (found.withColumn("_r", F.row_number().over(best)).filter("_r = 1").drop("_r"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is found, unchanged. Rows are matched by doc_id; rows without
    one stay."""
    ids = leaks(docs, benchmark).select(F.col("doc_id").alias("_leak")).filter("_leak is not null").distinct()
    return docs.join(ids, docs["doc_id"] == ids["_leak"], "left_anti")
