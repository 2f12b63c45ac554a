"""Approximate nearest neighbours by multiprobe p-stable hashing (operator 5).

Each table hashes a vector with ``width``-wide cells of random Gaussian projections. A query visits its own
cell and perturbed cells in the order of their estimated success (least sum of squared distances to the
crossed cell borders first). Rows met in any table are ranked by exact Euclidean distance. A query that
meets fewer than ``k`` rows is searched exactly over all rows in blocks.

Every valid row is indexed. Of rows with one and the same vector only the k + 1 of least vec_id can be
among any query's k nearest (ties go to the smaller vec_id), so equal vectors are cut to these before the
shuffle; large cells are cut into chunks, each met by the queries that probe the cell.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part, nor
do rows without vec_id; vectors of other lengths than the query's are not compared; rows that repeat a
vec_id and vector are one; a query's own vec_id is never its neighbour; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnguard.llm.common import staged

TABLES = 8
#: Cell width as a share of the median distance between two rows of a bounded sample.
WIDTH_SHARE = 0.7
SAMPLE_ROWS = 1000
#: Cells that a query visits in each table at four hashes; four times as many for each hash more.
PROBES = 40
CHUNK_ROWS = 4096
GROUP_ROWS = 20_000
SEED = 20240607


def valid(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def projections(dim: int, hashes: int, table: int, width: float, seed: int):
    rng = np.random.default_rng([seed, dim, table])
    return rng.standard_normal((dim, hashes)), rng.random(hashes) * width


def probe_order(place: np.ndarray, probes: int) -> list[np.ndarray]:
    """The first ``probes`` perturbations of a query at ``place`` inside its cell (0 to 1 per hash), least
    summed squared border distance first; the first one is no perturbation."""
    hashes = len(place)
    steps = sorted([(float(p) ** 2, i, -1) for i, p in enumerate(place)]
                   + [((1 - float(p)) ** 2, i, 1) for i, p in enumerate(place)])
    out, heap = [np.zeros(hashes, np.int64)], [(steps[0][0], (0,))]
    while heap and len(out) < probes:
        cost, chosen = heapq.heappop(heap)
        moved = [steps[j][1] for j in chosen]
        if len(set(moved)) == len(moved):
            delta = np.zeros(hashes, np.int64)
            for j in chosen:
                delta[steps[j][1]] = steps[j][2]
            out.append(delta)
        top = chosen[-1]
        if top + 1 < len(steps):
            heapq.heappush(heap, (cost - steps[top][0] + steps[top + 1][0], (*chosen[:-1], top + 1)))
            heapq.heappush(heap, (cost + steps[top + 1][0], (*chosen, top + 1)))
    return out


def _cell_keys(cells: np.ndarray, table: int, dim: int) -> np.ndarray:
    """A 64-bit key per cell; a clash only adds candidates."""
    key = np.full(len(cells), (table + 1) * 0x9E3779B97F4A7C15 + dim & (1 << 64) - 1, np.uint64)
    for column in cells.T:
        key = (key ^ column.astype(np.int64).view(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


def _by_length(batch: pa.RecordBatch):
    lists = batch.column("v")
    lengths = np.diff(lists.offsets.to_numpy())
    for dim in np.unique(lengths):
        rows = np.nonzero(lengths == dim)[0]
        own = lists.take(pa.array(rows))
        yield int(dim), rows, own, own.values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _hashed(rows: DataFrame, hashes: int, width: float, tables: int, seed: int) -> DataFrame:
    def run(batches):
        for b in batches:
            for dim, at, own, x in _by_length(b):
                ids = b.column("id").take(pa.array(at))
                for t in range(tables):
                    a, shift = projections(dim, hashes, t, width, seed)
                    keys = _cell_keys(np.floor((x @ a + shift) / width), t, dim)
                    yield pa.RecordBatch.from_arrays([pa.array(keys), ids, own], ["cell", "id", "v"])

    return rows.mapInArrow(run, rows.select(F.lit(0).cast("long").alias("cell"), "id", "v").schema)


def _probing(queries: DataFrame, hashes: int, width: float, tables: int, probes: int, seed: int) -> DataFrame:
    def run(batches):
        for b in batches:
            for dim, at, own, x in _by_length(b):
                ids = b.column("id").take(pa.array(at))
                for t in range(tables):
                    a, shift = projections(dim, hashes, t, width, seed)
                    f = (x @ a + shift) / width
                    base = np.floor(f)
                    visits = [probe_order(p, probes) for p in f - base]
                    n = np.array([len(v) for v in visits])
                    cells = np.repeat(base.astype(np.int64), n, 0) + np.concatenate([np.stack(v) for v in visits])
                    which = pa.array(np.repeat(np.arange(len(at)), n))
                    yield pa.RecordBatch.from_arrays([pa.array(_cell_keys(cells, t, dim)), ids.take(which),
                                                      own.take(which)], ["cell", "id", "v"])

    return queries.mapInArrow(run, queries.select(F.lit(0).cast("long").alias("cell"), "id", "v").schema)


def _rank_within(k: int):
    def run(key, rows, asking):
        out_q, out_v, out_s = [], [], []
        if rows.num_rows and asking.num_rows:
            cells = rows.column("cell").to_numpy()
            order = np.argsort(cells, kind="stable")
            cells, ids = cells[order], rows.column("id").to_numpy()[order]
            lists = rows.column("v").combine_chunks().take(pa.array(order))
            begins, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            sizes = np.diff(begins)
            q_ids, q_cells = asking.column("id").to_numpy(), asking.column("cell").to_numpy()
            q_lists = asking.column("v")
            low, high = np.searchsorted(cells, q_cells), np.searchsorted(cells, q_cells, "right")
            by_query = np.argsort(q_ids, kind="stable")
            for own in np.split(by_query, np.nonzero(np.diff(q_ids[by_query]))[0] + 1):
                q = np.array(q_lists[int(own[0])].as_py(), np.float64)
                spans = [np.arange(low[j], high[j]) for j in own if high[j] > low[j]]
                if not spans:
                    continue
                met = np.unique(np.concatenate(spans))
                met = met[(sizes[met] == len(q)) & (ids[met] != q_ids[own[0]])]
                _, once = np.unique(ids[met], return_index=True)
                met = met[once]
                if not len(met):
                    continue
                x = values[(begins[met][:, None] + np.arange(len(q))[None, :])]
                score = np.sqrt(((x - q) ** 2).sum(1))
                best = np.lexsort((ids[met], score))[:k]
                out_q.append(np.full(len(best), q_ids[own[0]]))
                out_v.append(ids[met][best])
                out_s.append(score[best])
        cat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return pa.table({"query_id": cat(out_q, np.int64), "vec_id": cat(out_v, np.int64),
                         "score": cat(out_s, np.float64)})
    return run


def _meet(index: DataFrame, asking: DataFrame, k: int, n_groups: int) -> DataFrame:
    """Each asking row (cell, id, v) against the index rows of its cell, k best per query and group."""
    group = F.pmod(F.xxhash64("cell", "chunk"), F.lit(n_groups)).cast("int").alias("g")
    both = [d.select(group, F.xxhash64("cell", "chunk").alias("cell"), "id", "v").groupBy("g") for d in (index, asking)]
    return both[0].cogroup(both[1]).applyInArrow(_rank_within(k), "query_id long, vec_id long, score double")


def _best(partial: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (partial.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k))


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            tables: int = TABLES, hashes: int | None = None, probes: int | None = None,
            width: float | None = None, seed: int = SEED) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for the rows that ``is_query`` names, against all rows."""
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"),
                           F.coalesce(is_query, F.lit(False)).alias("q"))
            .filter(F.col("id").isNotNull() & valid(F.col("v"))))
    queries = staged(rows.filter("q").select("id", "v").dropDuplicates(["id", "v"]), "queries")
    order = Window.partitionBy("v").orderBy("id")
    index = staged(rows.select("id", "v").distinct().withColumn("_n", F.row_number().over(order))
                   .filter(F.col("_n") <= k + 1).drop("_n"), "vectors")
    n = index.count()
    sample = index.orderBy(F.xxhash64("id")).limit(SAMPLE_ROWS).select("v").collect()  # bounded, for the width only
    if width is None:
        by_dim: dict[int, list] = {}
        for r in sample:
            by_dim.setdefault(len(r.v), []).append(r.v)
        x = np.array(max(by_dim.values(), key=len), np.float64) if by_dim else np.zeros((1, 1))
        gaps = np.linalg.norm(x - np.roll(x, 1, axis=0), axis=1)
        width = float(np.median(gaps)) * WIDTH_SHARE or 1.0
    hashes = hashes or max(2, math.ceil(math.log2(max(n, 2)) / 4))
    probes = probes or max(20, int(PROBES * 4.0 ** (hashes - 4)))
    hashed = staged(_hashed(index, hashes, width, tables, seed), "cells")
    large = (hashed.groupBy("cell").agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > CHUNK_ROWS)
             .select(F.col("cell").alias("_cell"), F.ceil(F.col("_c") / CHUNK_ROWS).cast("int").alias("_chunks")))
    asking = _probing(queries, hashes, width, tables, probes, seed)
    dealt = (hashed.join(large, F.col("cell") == F.col("_cell"), "left")
             .withColumn("chunk", F.pmod(F.xxhash64("id"), F.coalesce("_chunks", F.lit(1))).cast("int")))
    asking = (asking.join(large, F.col("cell") == F.col("_cell"), "left")
              .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.coalesce("_chunks", F.lit(1)) - 1))))
    found = staged(_best(_meet(dealt, asking, k, max(1, -(-tables * n // GROUP_ROWS))), k), "found")
    short = (queries.select("id").distinct().join(found, F.col("id") == F.col("query_id"), "left")
             .groupBy("id").agg(F.count("vec_id").alias("_c")).filter(F.col("_c") < min(k, max(n - 1, 0)))
             .select(F.col("id").alias("_id")))
    short = staged(queries.join(short, F.col("id") == F.col("_id")).select("id", "v"), "short")
    if not short.isEmpty():
        blocks = max(1, -(-n // CHUNK_ROWS))
        every = index.select("id", "v", F.lit(-1).cast("long").alias("cell"),
                             F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("chunk"))
        each = short.select("id", "v", F.lit(-1).cast("long").alias("cell"),
                            F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("chunk"))
        exact = _best(_meet(every, each, k, blocks), k)
        found = found.join(short.select(F.col("id").alias("_id")).distinct(), F.col("query_id") == F.col("_id"),
                           "left_anti").unionByName(exact)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
