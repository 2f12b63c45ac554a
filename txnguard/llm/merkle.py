"""Merkle manifest of a dataset: a hash tree per group, their roots in one tree, a proof for each row (operator 11).

A leaf is the SHA-256 of a row's fields. Leaves of a group stand in key order; every ``FANOUT`` neighbours become
the digest of their concatenated hex digests until one is left, the group's subroot; the subroots become the
root in the same way. Rows are numbered by ranges, so no group is ordered in one task. Superblocks of
``FANOUT ** LEVELS`` neighbours are reduced each in its own group and only their roots go on, in as many rounds as
the largest group needs. On the way back the nodes of a superblock meet the one row of outer siblings that all of
them share in a cogrouped ``applyInPandas``, which finishes the local subtree, joins inner and outer siblings to
proofs and folds each claimed leaf up to the root.

Defined results: a null field is ``-``, any other its UTF-8 byte count, ``:`` and its text; the null group comes
first and is not the empty one; null keys come first; rows of one key are ordered by their leaf, and rows
equal in all fields are leaves of their own with equal digests but their own proofs; a lone row is its own subroot
with no siblings there; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import numbered, staged

FANOUT = 8
#: Levels of a superblock's subtree.
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_OUTER = "root string, subroot string, lefts array<string>, rights array<string>"


def leaf(fields: list[Column]) -> Column:
    """Digest of a row's fields, each null or with its length before it, so no two rows share an input."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def _digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def subtree(hashes: list[str], n: int, levels: int = LEVELS) -> list[list[str]]:
    """The levels above ``hashes``, a superblock of a tree that has ``n`` nodes at this height: up to ``levels``
    of them, fewer where the whole tree ends before."""
    out = [hashes]
    while n > 1 and len(out) <= levels:
        below = out[-1]
        out.append([_digest(*below[i:i + FANOUT]) for i in range(0, len(below), FANOUT)])
        n = -(-n // FANOUT)
    return out


def _sides(level: list[str]) -> list[tuple[str, str]]:
    """For each node its siblings to the left and to the right, concatenated."""
    out = []
    for start in range(0, len(level), FANOUT):
        run = level[start:start + FANOUT]
        out += [("".join(run[:i]), "".join(run[i + 1:])) for i in range(len(run))]
    return out


def fold(claimed: str, lefts: list[str], rights: list[str]) -> str:
    """The root that a leaf and its proof lead to."""
    for left, right in zip(lefts, rights, strict=True):
        claimed = _digest(left, claimed, right)
    return claimed


def _block(levels: int) -> Column:
    return F.floor(F.col("pos") / F.lit(FANOUT ** levels)).cast("long").alias("block")


def superblock_roots(nodes: DataFrame, levels: int) -> DataFrame:
    """One node (tree, pos, n, h) per superblock: the next round's nodes."""

    def run(key, own):
        own, n = own.sort_values("pos"), int(own["n"].iat[0])
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "n": [-(-n // FANOUT ** levels)],
                             "h": [subtree(own["h"].tolist(), n, levels)[-1][0]]})

    return (nodes.select("tree", "pos", "n", "h", _block(levels)).groupBy("tree", "block")
            .applyInPandas(run, "tree string, pos long, n long, h string"))


def rounds(nodes: DataFrame, levels: int, label: str) -> list[DataFrame]:
    """``nodes`` and the written nodes of each further round, up to the one where every tree has one node."""
    out, n = [nodes], nodes.agg(F.max("n")).first()[0] or 1
    while n > 1 or len(out) == 1:
        out.append(staged(superblock_roots(out[-1], levels), label))
        n = -(-n // FANOUT ** levels)
    return out


def _meet(nodes: DataFrame, outer: DataFrame, kept: list[str], levels: int, made) -> DataFrame:
    """Cogroup each superblock's nodes with its row of outer siblings. ``made`` names the columns that come of the
    nodes in order, their sides at each inner level, and the outer row."""
    schema, build = made

    def run(key, own, beyond):
        own = own.sort_values("pos", ignore_index=True)
        heights = subtree(own["h"].tolist(), int(own["n"].iat[0]), levels)
        sides = [_sides(level) for level in heights[:-1]]
        steps = [[sides[k][i // FANOUT ** k] for k in range(len(sides))] for i in range(len(own))]
        return build(key, own, steps, beyond.iloc[0])

    return (nodes.select("tree", "pos", "n", "h", *kept, _block(levels)).groupBy("tree", "block")
            .cogroup(outer.withColumnRenamed("pos", "block").groupBy("tree", "block"))
            .applyInPandas(run, schema))


def _paths(key, own, steps, beyond):
    """Siblings from each node to the root; a tree's own top is its rows' subroot."""
    inner_l, inner_r = ([[s[side] for s in own_steps] for own_steps in steps] for side in (0, 1))
    return pd.DataFrame({
        "tree": key[0], "pos": own["pos"], "h": own["h"], "name": own["name"] if "name" in own else None,
        "root": beyond["root"], "subroot": beyond["subroot"],
        "lefts": [x + list(beyond["lefts"]) for x in inner_l], "rights": [x + list(beyond["rights"]) for x in inner_r]})


_PATHS = ("tree string, pos long, h string, name string, " + _OUTER, _paths)


def _descend(levels_of: list[DataFrame], outer: DataFrame, down_to: int, levels: int, label: str,
             kept: list[str]) -> DataFrame:
    """Outer rows of the nodes of round ``down_to`` from those of the last round."""
    for k in range(len(levels_of) - 2, down_to - 1, -1):
        outer = staged(_meet(levels_of[k], outer, kept if k == 0 else [], levels, _PATHS), label)
    return outer


def _leaves(docs: DataFrame, fields: tuple[str, ...], key: str, group: str, changed: dict[str, Column]) -> DataFrame:
    """Numbered leaves: tree, pos, n, key, h and the claimed digest."""
    claimed = [changed.get(f, F.col(f)) for f in fields]
    rows = docs.select(docs[key].alias("key"), F.coalesce(F.concat(F.lit("="), docs[group].cast("string")), F.lit("")).alias("tree"),
                       leaf([docs[f] for f in fields]).alias("h"), leaf(claimed).alias("claimed"),
                       F.monotonically_increasing_id().alias("_tie"))  # parts rows equal in all fields
    order = [F.col("tree"), F.col("key").asc_nulls_first(), F.col("h"), F.col("_tie")]
    return numbered(staged(rows, "leaves"), order, "leaf-ranges").drop("_tie")


def _trees(leaves: DataFrame, levels: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Rounds of the groups' trees and of the tree over their subroots."""
    inside = rounds(leaves, levels, "subtrees")
    tops = inside[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "h")
    return inside, rounds(numbered(tops, [F.col("name")], "subroots"), levels, "top-tree")


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "lang",
             levels: int = LEVELS) -> DataFrame:
    """One row per group: the group, its rows, subroot and the root of all."""
    inside, above = _trees(_leaves(docs, fields, key, group, {}), levels)
    sizes = inside[0].groupBy(F.col("tree").alias("name")).agg(F.max("n").alias("n_rows"))
    root = above[-1].select("tree", F.col("h").alias("root"))  # one row
    name = F.when(F.col("name") != "", F.substring(F.col("name"), 2, 1 << 30)).alias(group)
    return (above[0].select("tree", "name", F.col("h").alias("subroot")).join(sizes, "name")
            .join(F.broadcast(root), "tree").select(name, "n_rows", "subroot", "root"))


def proofs(docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "lang",
           changed: dict[str, Column] | None = None, levels: int = LEVELS, digest: bool = False) -> DataFrame:
    """Per row: key, leaf, subroot, root, its proof (the siblings left and right of its way, level by level;
    with ``digest`` the SHA-256 of them all, left to right, as proof_sha256), folded_root of the claimed row and
    whether that is the root. The claimed row is the row itself, with the columns that ``changed`` replaces."""
    key_type = docs.schema[key].dataType.simpleString()
    inside, above = _trees(_leaves(docs, fields, key, group, changed or {}), levels)
    root = above[-1].select("tree", "pos", F.col("h").alias("root"), F.lit(None).cast("string").alias("subroot"),
                            F.array().cast("array<string>").alias("lefts"), F.array().cast("array<string>").alias("rights"))
    groups = _descend(above, root, 0, levels, "top-paths", ["name"])
    outer = groups.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"), "root",
                          F.col("h").alias("subroot"), "lefts", "rights")
    outer = _descend(inside, outer, 1, levels, "paths", []).select("tree", "pos", "root", "subroot", "lefts", "rights")

    def finished(of, own, steps, beyond):
        last_l, last_r = list(beyond["lefts"]), list(beyond["rights"])
        lefts = [[s[0] for s in way] + last_l for way in steps]
        rights = [[s[1] for s in way] + last_r for way in steps]
        out = {"key": own["key"], "leaf": own["h"], "subroot": beyond["subroot"], "root": beyond["root"]}
        if digest:
            out["proof_sha256"] = [_digest(*(x for pair in zip(a, b, strict=True) for x in pair))
                                   for a, b in zip(lefts, rights, strict=True)]
        else:
            out |= {"lefts": lefts, "rights": rights}
        return pd.DataFrame(out | {"folded_root": list(map(fold, own["claimed"], lefts, rights))})

    shape = "proof_sha256 string" if digest else "lefts array<string>, rights array<string>"
    rows = _meet(inside[0], outer, ["key", "claimed"], levels,
                 (f"key {key_type}, leaf string, subroot string, root string, {shape}, folded_root string", finished))
    return rows.withColumnRenamed("key", key).withColumn("verified", F.col("folded_root") == F.col("root"))
