"""Sharding by best-fit-decreasing bin packing of indivisible groups (operator 8).

Groups are rows with equal texts. A group enters, in descending order of size, the shard with the tightest
remaining capacity that holds it, found in a balanced tree of remaining capacities. Sizes are exact below
``EXACT`` bytes and rounded up to 12 significant bits above, so whatever the corpus there are at most
``EXACT`` x 52 different sizes; only that table of sizes and counts is packed on the driver. A size's
groups are placed together: the tightest shard that holds one takes as many as fit. Which groups of a size
go where follows from their number among them, assigned by Spark without gathering a size in one task.

With ``capacity`` as many shards are opened as needed. With ``n_shards`` the capacity is an equal share:
groups above it get a shard each, and groups that fit nowhere enter the shard with the most room.

Defined results: null texts have no bytes and group with empty ones; repeated rows share a group; rows
without doc_id are placed like others; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import gapless, staged, text_of

EXACT = 4096
ROW_BYTES = 8


class CapacityTree:
    """Treap of (remaining capacity, shard): insert, remove, and the least entry at or above a size."""

    def __init__(self):
        self.root = None

    @staticmethod
    def _weight(key):
        return zlib.crc32(repr(key).encode())

    def _split(self, node, key):
        """Nodes below ``key`` and the others."""
        if node is None:
            return None, None
        own, left, right = node
        if own < key:
            a, b = self._split(right, key)
            return (own, left, a), b
        a, b = self._split(left, key)
        return a, (own, b, right)

    def _join(self, a, b):
        if a is None or b is None:
            return a or b
        if self._weight(a[0]) >= self._weight(b[0]):
            return a[0], a[1], self._join(a[2], b)
        return b[0], self._join(a, b[1]), b[2]

    def insert(self, remaining: int, shard: int) -> None:
        a, b = self._split(self.root, (remaining, shard))
        self.root = self._join(self._join(a, ((remaining, shard), None, None)), b)

    def remove(self, remaining: int, shard: int) -> None:
        a, b = self._split(self.root, (remaining, shard))
        _, b = self._split(b, (remaining, shard + 1))
        self.root = self._join(a, b)

    def tightest(self, size: int):
        node, best = self.root, None
        while node is not None:
            if node[0][0] >= size:
                best, node = node[0], node[1]
            else:
                node = node[2]
        return best

    def roomiest(self):
        node = self.root
        while node is not None and node[2] is not None:
            node = node[2]
        return node and node[0]


def pack(sizes: list[tuple[int, int]], n_shards: int | None = None, capacity: int | None = None):
    """Best-fit-decreasing over (size, count) pairs. Returns (size, shard, first, last) runs of the groups of
    one size, numbered from 0, and the number of shards."""
    sizes = sorted(((s, c) for s, c in sizes if c), reverse=True)
    tree, runs, used = CapacityTree(), [], 0
    taken = dict.fromkeys((s for s, _ in sizes), 0)

    def place(size, shard, count):
        runs.append((size, shard, taken[size], taken[size] + count - 1))
        taken[size] += count

    left = dict(sizes)
    if n_shards is not None:
        total, free = sum(s * c for s, c in sizes), n_shards
        for size, _ in sizes:  # groups above an equal share of what is left
            while left[size] and free > 1 and size * free > total:
                place(size, used, 1)
                left[size] -= 1
                total, free, used = total - size, free - 1, used + 1
        capacity = -(-total // free)
        for shard in range(used, n_shards):
            tree.insert(capacity, shard)
        used = n_shards
    for size, _ in sizes:
        while left[size]:
            found = tree.tightest(size)
            if found is None and n_shards is None:
                found = (max(capacity, size), used)
                used += 1
                tree.insert(*found)
            if found is None:
                found, count = tree.roomiest(), 1
            else:
                count = min(left[size], found[0] // size) if size else left[size]
            place(size, found[1], count)
            left[size] -= count
            tree.remove(*found)
            tree.insert(found[0] - size * count, found[1])
    return runs, used


def assign_shards(docs: DataFrame, n_shards: int | None = None, capacity: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (gapless from 0 in each shard) for every row."""
    raw = text_of().cast("binary")
    rows = staged(docs.select(
        docs["doc_id"], (F.octet_length(raw) + ROW_BYTES).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.substring(F.unhex(F.sha2(raw, 256)), 1, 16).alias("grp")), "sized")
    groups = rows.groupBy("grp").agg(F.sum("size").alias("bytes"))
    drop = "greatest(0, length(bin(bytes)) - 12)"
    groups = staged(groups.withColumn("cls", F.expr(
        f"shiftleft(shiftright(bytes + shiftleft(1L, {drop}) - 1, {drop}), {drop})")), "groups")
    counts = [(r.cls, r.n) for r in groups.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).collect()]
    n_groups = sum(n for _, n in counts)
    runs, _ = pack(counts, n_shards, capacity)
    spark = docs.sparkSession
    runs = spark.createDataFrame(runs, "_cls long, shard int, _first long, _last long")
    ranked = gapless(groups, ["cls"], ["grp"], "n", F.xxhash64("grp"), n_groups)
    placed = staged(ranked.join(runs, (F.col("cls") == F.col("_cls")) & F.col("n").between(F.col("_first"), F.col("_last")))
                    .select(F.col("grp").alias("_grp"), "shard"), "placed")
    dealt = staged(rows.join(placed, F.col("grp") == F.col("_grp")).drop("_grp"), "dealt")
    n_rows = rows.count()
    return (gapless(dealt, ["shard"], ["doc_id", "grp"], "slot", F.xxhash64("doc_id", "grp"), n_rows)
            .select("doc_id", "size", "text_crc32", "shard", "slot"))
