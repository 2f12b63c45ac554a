"""Embedding near-dedup by sorted projection passes (operator 13).

Each pass gives a vector a key, the concatenated signs of its products with random directions, and orders the
vectors of a label lexicographically by it. Every vector is compared with its ``window`` next neighbours; pairs are
verified by cosine in double precision. A pair belongs to the first pass that meets it, which both vectors' places in
the earlier passes tell where they meet, so the union over the passes needs no table of pairs: tasks return each vector's
number of links and a spanning forest of their links.

A window is bounded; what it could cut off is met exactly. Vectors of one label whose keys share a prefix long enough
for an eighth of a window of unrelated vectors form a run; a run that reaches beyond a window is compared in
tiles of neighbouring blocks, each pair in one tile. So a pair is missed only if its keys part within the prefix in every pass;
the number of passes keeps that below ``MISS`` for a pair at the threshold.

Defined results: equal vectors of one label are compared once and count one by one; vectors that are null, empty, zero or hold
null or non-finite components, or whose label is null, link with nothing and are their own component; vectors of other
lengths are not compared; rows that share a vec_id are vectors of their own; rows without a vec_id link with nothing
and have no component; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import numbered, staged
from txnguard.llm.components import connected_components

THRESHOLD = 0.98
#: Neighbours after it that a vector is compared with in a pass.
WINDOW = 64
#: Chance that a pair at the threshold is met in no pass.
MISS = 1e-6
#: Places of an order that one task group compares.
BLOCK = 2048
#: Signs in a key.
BITS = 60
SEED = 20240913


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def prefix_bits(n: float, window: int) -> int:
    """Signs after which n unrelated vectors are parted into runs of an eighth of a window."""
    return min(BITS, max(0, math.ceil(math.log2(max(8 * n / window, 1)))))


def passes_for(n: int, window: int, threshold: float, miss: float = MISS) -> int:
    """Passes after which a pair at the threshold has parted within the prefix in all of them with chance ``miss``."""
    together = (1 - math.acos(threshold) / math.pi) ** prefix_bits(n, window)
    return 1 if together >= 1 else math.ceil(math.log(miss) / math.log1p(-together))


def unit(values: np.ndarray, dim: int) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square leaves the range of doubles."""
    x = values.astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _vectors(column: pa.Array):
    """(rows, unit vectors) for each length in the column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    for dim in np.unique(sizes):
        at = np.nonzero(sizes == dim)[0]
        yield at, unit(column.take(pa.array(at)).values.to_numpy(zero_copy_only=False), int(dim))


def _keys(passes: int, seed: int):
    weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)

    def run(batches):
        for b in batches:
            out = np.zeros((b.num_rows, passes), np.int64)
            for at, x in _vectors(b.column("v")):
                for p in range(passes):
                    planes = np.random.default_rng([seed, x.shape[1], p]).standard_normal((x.shape[1], BITS))
                    out[at, p] = (x @ planes > 0) @ weights
            offsets = pa.array(np.arange(0, out.size + 1, passes), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("cid"), b.column("label"), b.column("dim"),
                                              pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))],
                                             ["cid", "label", "dim", "keys"])
    return run


def _classes(rows: DataFrame) -> DataFrame:
    """One row per distinct (label, vector): cid, id (its least vec_id), copies, label, dim, v."""
    return staged(rows.groupBy("label", "v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
                  .select(F.monotonically_increasing_id().alias("cid"), "id", "copies", "label",
                          F.size("v").alias("dim"), "v"), "vector-classes")


def _placed(classes: DataFrame, passes: int, window: int, seed: int) -> DataFrame:
    """The classes with their place in every pass, and the first and last place of the run that reaches beyond
    a window there (-1: none)."""
    label_type = classes.schema["label"].dataType.simpleString()
    sizes = (classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("_n"))
             .select(F.col("label").alias("_label"), F.col("dim").alias("_dim"),
                     F.least(F.lit(BITS), F.ceil(F.log2(F.greatest(8 * F.col("_n") / window, F.lit(1.0)))))
                     .cast("int").alias("_bits")))
    keyed = classes.select("cid", "label", "dim", "v").mapInArrow(
        _keys(passes, seed), f"cid long, label {label_type}, dim int, keys array<long>")
    keyed = keyed.select("cid", "label", "dim", F.posexplode("keys").alias("tree", "key"))
    order = [F.col(c) for c in ("tree", "label", "dim", "key", "cid")]
    placed = numbered(staged(keyed, "vector-keys"), order, "vector-orders")
    placed = (placed.join(sizes, (F.col("label") == F.col("_label")) & (F.col("dim") == F.col("_dim")))
              .withColumn("_run", F.expr(f"shiftright(key, {BITS} - _bits)"))
              .select("cid", "tree", "label", "dim", "pos", "_run"))
    runs = (placed.groupBy("tree", "label", "dim", "_run")
            .agg(F.count(F.lit(1)).alias("_c"), F.min("pos").alias("first"), F.max("pos").alias("last"))
            .filter(F.col("_c") > window + 1)
            .select(*[F.col(c).alias(f"_{c}") for c in ("tree", "label", "dim")], F.col("_run").alias("_of"), "first", "last"))
    on = [F.col(c) == F.col(f"_{c}") for c in ("tree", "label", "dim")] + [F.col("_run") == F.col("_of")]
    places = (placed.join(runs, on, "left")
              .groupBy("cid").agg(F.array_sort(F.collect_list(F.struct(
                  "tree", "pos", F.coalesce("first", F.lit(-1)).alias("first"), F.coalesce("last", F.lit(-1)).alias("last")))).alias("at"))
              .select(F.col("cid").alias("_cid"), *[F.col(f"at.{c}").alias(c) for c in ("pos", "first", "last")]))
    return staged(classes.join(places, F.col("cid") == F.col("_cid")).drop("_cid"), "placed-vectors")


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node that each of n nodes reaches by the edges (a, b)."""
    root = np.arange(n)
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            return root
        np.minimum.at(root, high[apart], low[apart])
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def _compare(window: int, threshold: float):
    """Links of one group. Of a window group the rows marked right are only met; in a tile the rows of the left block
    meet those of the right one that lie beyond their window in the same run."""

    def pairs(t, p: int, tile: bool):
        places = np.stack([t.column(c).combine_chunks().values.to_numpy().reshape(t.num_rows, -1)
                           for c in ("pos", "first")])  # (2, rows, passes)
        side = t.column("side").to_numpy()
        label = t.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
        for at, x in _vectors(t.column("v")):
            order = np.argsort(places[0, at, p], kind="stable")
            at, x = at[order], x[order]
            spot, run = places[:, at, p]
            left = np.nonzero(side[at] != 1)[0]
            right = np.nonzero(side[at] != 0)[0] if tile else np.arange(len(at))
            for start in range(0, len(left), 256):
                own = left[start:start + 256]
                if tile:
                    met = right
                else:
                    met = right[np.searchsorted(spot, spot[own[0]]):np.searchsorted(spot, spot[own[-1]] + window, "right")]
                sims = x[own] @ x[met].T
                i, j = np.nonzero(sims >= threshold - 1e-9)
                sims, i, j = sims[i, j], own[i], met[j]
                gap = spot[j] - spot[i]
                fits = (gap > window) & (run[i] == run[j]) & (run[i] >= 0) if tile else (gap > 0) & (gap <= window)
                fits &= label[at[i]] == label[at[j]]
                i, j, sims = i[fits], j[fits], sims[fits]
                border = sims < threshold + 1e-9
                if border.any():
                    exact = np.array([math.fsum(a * b) for a, b in zip(x[i[border]], x[j[border]], strict=True)])
                    sims[border] = exact
                    sure = sims >= threshold
                    i, j = i[sure], j[sure]
                i, j = at[i], at[j]
                new = np.ones(len(i), bool)
                for q in range(p):
                    a, b = places[:, i, q], places[:, j, q]
                    new &= ~((np.abs(a[0] - b[0]) <= window) | ((a[1] == b[1]) & (a[1] >= 0)))
                yield i[new], j[new]

    def run(key, t):
        found = list(pairs(t, key[0].as_py(), key[2].as_py() >= 0))
        i, j = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
        cid, ids, copies = (t.column(c).to_numpy() for c in ("cid", "id", "copies"))
        links = np.bincount(i, copies[j], t.num_rows) + np.bincount(j, copies[i], t.num_rows)
        linked = np.nonzero(links > 0)[0]
        root = forest(t.num_rows, i, j)
        top = root[linked]
        return pa.table({"cid": cid[linked], "id": ids[linked], "links": links[linked].astype(np.int64),
                         "root_id": ids[top], "root_cid": cid[top]})

    return run


def links(placed: DataFrame, passes: int, window: int, threshold: float, block: int) -> DataFrame:
    """cid, id, links (rows of other classes first met in this group), and an edge of the group's forest: the
    class that stands for those it is linked with there (root_cid, root_id)."""
    columns, id_type = ["cid", "id", "copies", "label", "v"], placed.schema["id"].dataType.simpleString()
    upto = [F.slice(F.col(c), 1, F.col("p") + 1).alias(c) for c in ("pos", "first")]  # a group asks for the passes before
    rows = (placed.withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
            .withColumns({"_b": F.expr(f"pos[p] div {block}"), "_low": F.expr(f"first[p] div {block}"),
                          "_high": F.expr(f"last[p] div {block}"), "_long": F.expr("first[p] >= 0")}))
    ahead = F.expr(f"_b > 0 and pos[p] % {block} < {window}")
    spot = "named_struct('bi', {}, 'bj', {}, 'side', {})"
    own = F.expr("array(" + spot.format("_b", "-1L", "2") + ")")
    halo = F.when(ahead, F.expr("array(" + spot.format("_b - 1", "-1L", "1") + ")"))
    tiles = F.when(F.col("_long"), F.expr(
        "concat(transform(sequence(_low, _high), o -> " + spot.format("least(o, _b)", "greatest(o, _b)",
                                                                      "if(o = _b, 2, if(o < _b, 1, 0))") + "))"))
    groups = F.concat(*[F.coalesce(g, F.expr("slice(array(" + spot.format("_b", "-1L", "2") + "), 1, 0)"))
                        for g in (own, halo, tiles)])
    return (rows.withColumn("g", F.explode(groups)).select("p", "g.bi", "g.bj", "g.side", *columns, *upto)
            .groupBy("p", "bi", "bj").applyInArrow(_compare(window, threshold),
                                                    f"cid long, id {id_type}, links long, root_id {id_type}, root_cid long"))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, window: int = WINDOW, passes: int | None = None,
                    block: int = BLOCK, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    seed: int = SEED) -> DataFrame:
    """One row per vector: its id, n_links (other rows linked with it), component_id (the least id reachable by
    links), kept (whether that is its own)."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"), F.col(label_col).alias("label"))
    takes_part = F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v"))
    classes = _classes(rows.filter(takes_part))
    largest = classes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 1
    passes = passes or passes_for(largest, window, threshold)
    found = staged(links(_placed(classes, passes, window, seed), passes, window, threshold, block), "vector-links")
    roots = connected_components(found.select(F.struct("id", "cid").alias("a"),
                                              F.struct(F.col("root_id").alias("id"), F.col("root_cid").alias("cid")).alias("b")))
    counts = found.groupBy(F.col("cid").alias("_cid")).agg(F.sum("links").alias("_links"))
    per_class = (classes.join(counts, F.col("cid") == F.col("_cid"), "left")
                 .join(roots, F.col("cid") == F.col("node.cid"), "left")
                 .select(F.col("label").alias("_label"), F.col("v").alias("_v"),
                         F.coalesce("root.id", classes["id"]).alias("_root"),
                         (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("_n")))
    root = F.coalesce("_root", "id")
    return (rows.join(per_class, takes_part & (F.col("label") == F.col("_label")) & (F.col("v") == F.col("_v")), "left")
            .select(F.col("id").alias(id_col), F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"),
                    root.alias("component_id"), F.coalesce(F.col("id") == root, F.lit(False)).alias("kept")))
