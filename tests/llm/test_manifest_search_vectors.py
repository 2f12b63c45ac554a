"""Merkle manifest, ranked search and embedding near-dedup against brute force and SQL."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm.test_operators import EDGE, ordered
from txnguard.llm import merkle, ranked, vector_dedup
from txnguard.llm.queries import LLM_ORACLES, LLM_QUERIES
from txnguard.session import ship_package

DOCS = "doc_id long, source string, lang string, n_chars long, text string, key string, tree string, pos string, h string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def small_letters(text):
    return None if text is None else re.sub("[A-Z]", lambda m: m[0].lower(), text)


def plain_leaf(row):
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def plain_tree(hashes):
    """Levels from the leaves to the root."""
    levels = [hashes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i:i + 8])) for i in range(0, len(last), 8)])
    return levels


def plain_way(levels, i):
    """(siblings before, siblings after) of node i on each level below the top."""
    out = []
    for level in levels[:-1]:
        start = i // 8 * 8
        out.append((level[start:i], level[i + 1:start + 8]))
        i //= 8
    return out


def plain_proofs(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0], plain_leaf(r)))
        trees[lang] = plain_tree([plain_leaf(r) for r in groups[lang]])
    top = plain_tree([trees[x][-1][0] for x in langs])
    out = []
    for at, lang in enumerate(langs):
        for i, r in enumerate(groups[lang]):
            way = plain_way(trees[lang], i) + plain_way(top, at)
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            h = plain_leaf((*r[:4], small_letters(r[4]))) if changed else plain_leaf(r)
            for before, after in way:
                h = sha("".join([*before, h, *after]))
            root = top[-1][0]
            out.append((r[0], plain_leaf(r), trees[lang][-1][0], root, sha("".join("".join(a + b) for a, b in way)), h, h == root))
    return out


def edge_rows(n=300):
    rng = np.random.default_rng(5)
    langs = ["en"] * 5 + ["de", "", "é", "￮", "\U0001f600", None]
    rows = [(int(rng.integers(0, 10**int(rng.integers(1, 10)))), None if i % 9 == 0 else f"s{i % 4}", langs[int(rng.integers(11))],
             None if i % 13 == 0 else i, None if i % 17 == 0 else f"Text {i} É 漢" * int(rng.integers(0, 4))) for i in range(n)]
    rows += [(7, "s", "zz", 1, "A lone Row of its language"), (None, None, None, None, None), (None, None, None, None, None)]
    return rows + [(5, "x", "en", 1, "Same")] * 40 + [(5, "x", "en", 1, t) for t in ("b", "a", None, "")]


@pytest.mark.parametrize("levels", [1, 3])
def test_op11_equals_the_plain_tree(spark, levels):
    ship_package(spark)
    rows = edge_rows()
    df = spark.createDataFrame([(*r, "k", "t", "p", "h") for r in rows], DOCS).repartition(5)
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0,
                     F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    got = merkle.proofs(df, changed={"text": changed}, levels=levels, digest=True)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert ordered(map(tuple, got.collect())) == ordered(plain_proofs(rows))


def test_op11_real_proofs_and_manifest(spark):
    rows = edge_rows(90)
    df = spark.createDataFrame([(*r, "k", "t", "p", "h") for r in rows], DOCS)
    got = merkle.proofs(df, levels=1).collect()
    assert len(got) == len(rows) and all(r.verified for r in got)
    for r in got:
        assert merkle.fold(r.leaf, r.lefts, r.rights) == r.root
    want = collections.Counter((r[2]) for r in rows)
    table = merkle.manifest(df, levels=1).collect()
    assert {r.lang: r.n_rows for r in table} == want and {r.root for r in table} == {got[0].root}
    assert {r.subroot for r in table} == {r.subroot for r in got}
    forged = merkle.proofs(df, changed={"n_chars": F.col("n_chars") + F.when(F.col("n_chars") == 3, 1).otherwise(0)}, levels=2).collect()
    assert sum(not r.verified for r in forged) == sum(r[3] == 3 for r in rows)


def test_op11_one_document(spark):
    row = (3, "s", "en", 4, "Text")
    got = merkle.proofs(spark.createDataFrame([(*row, "k", "t", "p", "h")], DOCS), digest=True).collect()
    assert [tuple(r) for r in got] == [(3, plain_leaf(row), plain_leaf(row), plain_leaf(row), sha(""), plain_leaf(row), True)]


TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_search(docs, items, k=10):
    tf = [collections.Counter(TERM.findall(small_letters(t or ""))) for _, t in docs]
    n = [sum(c.values()) for c in tf]
    n_docs, total = sum(x > 0 for x in n), sum(n)
    df = collections.Counter(t for c in tf for t in c)
    asked = collections.defaultdict(set)
    for i, t in items:
        asked[i] |= set(TERM.findall(small_letters(t or "")))
    out = []
    for i, own in asked.items():
        scored = []
        for (d, _), c, size in zip(docs, tf, n, strict=True):
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10**9 * c[t] // (1000 * c[t] + 8 * (10 + 90 * size * n_docs // total))) for t in own if c[t])
            if score > 0:
                scored.append((-score, d is not None, d, score))
        out += [(i, r + 1, d, score) for r, (_, _, d, score) in enumerate(sorted(scored)[:k])]
    return out


@pytest.fixture(scope="module")
def texts(spark):
    ship_package(spark)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    return docs + EDGE + [(8000 + i, "The same common words of a copied passage " + "and more " * (i % 2)) for i in range(150)]


@pytest.fixture(scope="module")
def asked(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    items += [(900, "same COMMON words, of a copied passage and more"), (901, None), (902, ""), (903, "nowhereatall !?"),
              (None, "tel mail card"), (904, "word"), (904, "漢字 é"), (905, "z"), (906, "and of the")]
    return items


@pytest.mark.parametrize("shard,depth", [(None, 64), (7, 1), (100, 3)])
def test_op12_equals_scoring_every_document(spark, texts, asked, shard, depth, monkeypatch):
    monkeypatch.setattr(ranked.read_lists, "__defaults__", (depth,))
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("doc", "terms", "n", "item")})
    items = spark.createDataFrame(asked, "item_id long, text string").withColumn("item", F.lit(1))
    got = ranked.search(df.repartition(3), items, shard=shard).collect()
    assert ordered(map(tuple, got)) == ordered(plain_search(texts, asked))


def test_op12_reads_lists_only_until_the_best_are_settled():
    """Random lists against full sums; where rare terms settle the best, the long list is left after a few rounds."""
    rng = np.random.default_rng(2)
    for trial in range(200):
        n, k = int(rng.integers(1, 60)), int(rng.integers(1, 5))
        lists = [rng.choice(n, int(rng.integers(1, n + 1)), replace=False) for _ in range(int(rng.integers(1, 6)))]
        values = [np.sort(rng.integers(1, 6, len(x)))[::-1] for x in lists]
        total = np.zeros(n, np.int64)
        for d, x in zip(lists, values):
            total[d] += x
        ends = np.cumsum([len(x) for x in lists])
        floor = int(rng.integers(0, 4)) if trial % 2 else 0
        met, scores, _ = ranked.read_lists(ends - [len(x) for x in lists], ends, np.concatenate(lists), np.concatenate(values), n, k, floor, 1)
        assert (scores == total[met]).all()
        kth = max(floor, int(np.sort(total)[-k]) if n >= k else 0, 1)
        assert {d for d in range(n) if total[d] >= kth} <= set(met.tolist())
    docs = np.concatenate((np.arange(10), np.arange(100_000)))
    impact = np.concatenate((np.full(10, 10**6), np.arange(100_000, 0, -1)))
    met, scores, read = ranked.read_lists(np.array([0, 10]), np.array([10, 100_010]), docs, impact, 100_000, 10, 0)
    assert set(met) == set(range(10)) and read < 1000


def test_op12_portions_of_items_and_pieces_of_texts(spark, texts, asked, monkeypatch):
    monkeypatch.setattr(ranked, "ITEM_BYTES", 500)
    monkeypatch.setattr(ranked, "PIECE", 7)
    some = texts[-400:]
    df = spark.createDataFrame(some, "doc_id long, text string").coalesce(2)
    got = ranked.search(df, spark.createDataFrame(asked[-12:], "item_id long, text string")).collect()
    assert ordered(map(tuple, got)) == ordered(plain_search(some, asked[-12:]))
    assert [b for p in ranked.terms("Ab céd " * 9 + "x" * 40) for b in p] == ["ab".encode(), "céd".encode()] * 9 + [b"x" * 40]


def plain_links(rows, threshold=0.98):
    """rows: (vec_id, vector, label) -> sorted (vec_id, n_links, component_id, kept)."""
    ok = [i for i, (d, v, y) in enumerate(rows) if d is not None and y is not None and v
          and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    root, n = list(range(len(rows))), [0] * len(rows)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ok:
        for b in ok:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    n[a] += 1
                    n[b] += 1
                    root[max(top(a), top(b))] = min(top(a), top(b))
    least = {}
    for i in ok:
        least[top(i)] = min(least.get(top(i), rows[i][0]), rows[i][0])
    own = [least.get(top(i), rows[i][0]) for i in range(len(rows))]
    return [(d, n[i], own[i], d is not None and own[i] == d) for i, (d, _, _) in enumerate(rows)]


def vectors(n_random=150):
    """Random ones, chains, a dense group of different vectors, copies, scaled copies, and what takes no part."""
    rng = np.random.default_rng(3)
    f32 = lambda x: np.asarray(x, np.float32).tolist()
    rows = [(i, f32(rng.standard_normal(16)), i % 3) for i in range(n_random)]
    base = rng.standard_normal(16)
    rows += [(1000 + i, f32(base + 0.06 * rng.standard_normal(16)), i % 2) for i in range(160)]
    a, b = np.eye(16)[:2]
    rows += [(2000 + i, f32(a * math.cos(0.18 * i) + b * math.sin(0.18 * i)), 7) for i in range(12)]
    rows += [(3000 + i, f32(base), 5) for i in range(40)] + [(3100 + i, f32(base * (i + 2)), 5) for i in range(3)]
    rows += [(3000, f32(-base), 5), (3000, f32(base), 5)]
    rows += [(4000, None, 1), (4001, [], 1), (4002, [0.0] * 16, 1), (4003, [float("nan")] * 16, 1), (4004, [None] * 16, 1),
             (4005, [float("inf")] + [1.0] * 15, 1), (4006, f32(base), None), (None, f32(base), 5), (4007, [1.0, 2.0], 1),
             (4008, [2.0, 4.0], 1), (4009, f32(base * 1e30), 5)]
    return rows


@pytest.mark.parametrize("window,block", [(64, 2048), (4, 32), (1, 7)])
def test_op13_equals_all_pairs(spark, window, block):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns(
        {c: F.lit("x") for c in ("id", "v", "cid", "pos", "links", "first")}).repartition(3)
    got = vector_dedup.near_duplicates(df, window=window, block=block, passes=None if window > 1 else 30).collect()
    assert ordered(map(tuple, got)) == ordered(plain_links(rows))


def test_op13_doubles_and_text_labels(spark):
    rows = [(d, v and [x and x * 1e250 if x and math.isfinite(x) else x for x in v], None if y is None else f"l{y}")
            for d, v, y in vectors(40) if d is None or d < 3000 or d >= 4000 and d != 4009]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    plain = [(d, v and [x and x / 1e250 if x and math.isfinite(x) else x for x in v], y) for d, v, y in rows]
    got = vector_dedup.near_duplicates(df).collect()
    assert ordered(map(tuple, got)) == ordered(plain_links(plain))


def test_op13_passes_reach_the_stated_miss():
    """Pairs at the threshold among many others: the share not met in any pass, by the keys alone."""
    rng = np.random.default_rng(1)
    assert vector_dedup.passes_for(8, 64, 0.98) == 1
    n, passes = 100_000, vector_dedup.passes_for(100_000, 64, 0.98, miss=1e-2)
    bits = vector_dedup.prefix_bits(n, 64)
    x = rng.standard_normal((2000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal(x.shape)
    y -= (x * y).sum(1, keepdims=True) * x
    y = 0.98 * x + math.sqrt(1 - 0.98**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    met = np.zeros(len(x), bool)
    for p in range(passes):
        planes = np.random.default_rng([vector_dedup.SEED, 32, p]).standard_normal((32, vector_dedup.BITS))[:, :bits]
        met |= ((x @ planes > 0) == (y @ planes > 0)).all(1)
    assert (~met).mean() < 0.03


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_sql_gives_the_same(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.sql(LLM_ORACLES[name])
    got = LLM_QUERIES[name](ship_package(spark), SF_SMALL)
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert ordered(map(tuple, got.select(columns).collect())) == ordered(want.select(*columns).fetchall())
