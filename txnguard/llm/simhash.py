"""SimHash near-duplicates by meet-in-the-middle ball hashing (operator 2).

Two fingerprints that differ in at most ``radius`` bits have a common variant within half the radius of
both. Variants are dealt by their top bits: a fingerprint is sent once to each variant prefix it can reach
(37 prefixes of 8 bits at radius 4), and the rest of its variants are made inside the task, so the shuffle
carries fingerprints instead of 2,081 variants each. Prefixes lengthen as the corpus grows, which keeps
the variants of one prefix in memory; should bits be unevenly filled, a task cuts its prefix further.
All fingerprints of one variant are within the radius of each other, so a star from the least one keeps
every link's component without listing pairs; the links are deduplicated and verified by their bit distance.

Defined results: null or empty texts have fingerprint 0 and link like any other; equal texts share a
fingerprint and are handled as one; rows with a null doc_id have a fingerprint and a component but never
name one; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import staged
from txnguard.llm.components import connected_components
from txnguard.llm.wordwise import whole_texts

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
#: Variants that one prefix group makes on average, and at most at a time.
GROUP_VARIANTS = 2_000_000
MOST_VARIANTS = 8_000_000
#: Shingles whose bits are unpacked at a time.
STEP = 200_000


def fingerprint(text: bytes, n: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """64-bit SimHash of lower-cased word shingles: a bit is 1 if set in over half the shingle hashes."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= n:
        shingles = [joined]
    else:
        starts = np.concatenate(([0], ends[:-1] + 1))[:len(words) - n + 1].tolist()
        shingles = [joined[s:e] for s, e in zip(starts, ends[n - 1:].tolist(), strict=True)]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(shingles), STEP):
        part = shingles[at:at + STEP]
        hashes = np.fromiter((digest(s, seed) for s in part), "<u8", len(part))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = counts * 2 > len(shingles)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, n: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a long)."""

    def run(batches):
        for b in batches:
            raw = whole_texts(b).cast(pa.large_binary())
            fps = np.fromiter((fingerprint(t.as_buffer().to_pybytes(), n, seed) for t in raw), np.uint64, len(raw))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(docs["doc_id"], docs["text"]).mapInArrow(run, f"doc_id {id_type}, fp long")


def _masks(bits: int, most: int) -> list[int]:
    """All masks of up to ``most`` of the lowest ``bits`` bits, by how many they set."""
    masks, level = [0], [(0, -1)]
    for _ in range(most):
        level = [(m | 1 << i, i) for m, last in level for i in range(last + 1, bits)]
        masks += [m for m, _ in level]
    return masks


def _ball(bits: int, most: int) -> int:
    return sum(math.comb(bits, j) for j in range(most + 1))


def _stars(fps: np.ndarray, left: np.ndarray, low_bits: int) -> tuple[list, list]:
    """Links among fingerprints that share a variant: ``left[i]`` flips of the lowest ``low_bits`` bits are
    still free for fps[i]. Cuts by four more bits where the variants would not fit in memory."""
    if len(fps) < 2:
        return [], []
    total = sum(int((left == j).sum()) * _ball(low_bits, j) for j in range(int(left.max()) + 1))
    if total > MOST_VARIANTS and low_bits > 4:
        a, b, rest = [], [], low_bits - 4
        chunk = (fps >> np.uint64(rest)) & np.uint64(15)
        for sub in range(16):
            spent = np.bitwise_count(chunk ^ np.uint64(sub)).astype(np.int64)
            keep = spent <= left
            more = _stars(fps[keep], (left - spent)[keep], rest)
            a += more[0]
            b += more[1]
        return a, b
    low = np.uint64((1 << low_bits) - 1)
    variants, owner = [], []
    for j in range(int(left.max()) + 1):
        own = np.nonzero(left == j)[0]
        if len(own):
            masks = np.array(_masks(low_bits, j), np.uint64)
            variants.append(((fps[own] & low)[:, None] ^ masks[None, :]).ravel())
            owner.append((own, len(masks)))
    flat = np.concatenate(variants)
    ordered = np.sort(flat)
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(shared):
        return [], []
    del ordered
    place = np.minimum(np.searchsorted(shared, flat), len(shared) - 1)
    hit = np.nonzero(shared[place] == flat)[0]
    owners = np.concatenate([np.repeat(o, m) for o, m in owner])[hit]
    key, value = place[hit], fps[owners]
    order = np.lexsort((value, key))
    key, value = key[order], value[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    least = value[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
    pairs = np.unique(np.stack((least, value), 1)[least != value], axis=0)
    return [pairs[:, 0]], [pairs[:, 1]]


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``, enough to connect all that lie within ``radius`` bits
    of each other, each verified."""
    half = (radius + 1) // 2
    n = distinct.count()
    prefix = min(24, max(4, math.ceil(math.log2(max(2, n * _ball(64, half) / GROUP_VARIANTS)))))
    low_bits = 64 - prefix
    masks = F.array(*[F.lit(m).cast("long") for m in _masks(prefix, half)])
    dealt = distinct.select("fp", F.explode(F.transform(
        masks, lambda m: F.shiftrightunsigned("fp", low_bits).bitwiseXOR(m))).alias("prefix"))

    def run(key, table):
        fps = np.sort(table.column("fp").to_numpy().view(np.uint64))
        left = half - np.bitwise_count((fps >> np.uint64(low_bits)) ^ np.uint64(key[0].as_py())).astype(np.int64)
        a, b = _stars(fps, left, low_bits)
        empty = np.zeros(0, np.uint64)
        a, b = (np.concatenate(x) if x else empty for x in (a, b))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    met = dealt.groupBy("prefix").applyInArrow(run, "a long, b long")
    return met.distinct().filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(docs: DataFrame, n: int = SHINGLE_WORDS, radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """doc_id, fp, component_id (least doc_id reachable over links, its own included) for every row."""
    rows = staged(fingerprints(docs, n, seed), "fingerprints")
    distinct = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = connected_components(links(distinct.select("fp"), radius))
    classes = (distinct.join(roots, distinct["fp"] == roots["node"], "left")
               .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    named = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = classes.join(named, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def fingerprint_hex(fp="fp"):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, n: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the least of its class; rows that share a doc_id are one document
    and go together, rows without a doc_id stay. Only doc_ids are matched; other columns pass unchanged."""
    gone = (near_duplicates(docs, n, radius).filter("doc_id != component_id")
            .select(F.col("doc_id").alias("_gone")).distinct())
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
