"""Quality classifier by nearest-neighbour voting in a latent-semantic space (operator 6).

A text is the vector of its byte-trigram counts (hashed, log-scaled, weighted by inverse document
frequency) and of the share of its words that repeat the word before, projected on the leading singular
directions of a bounded labelled sample. The labelled
vectors are broadcast (at most ``per_label`` rows a label times ``rank`` floats); every document's cosines
with all of them come from blocked matrix products, and the ``k`` nearest vote with their similarity.

Only texts enter a score. Defined results: null and empty texts, and texts that share no direction with any
labelled one, get the share of label 1 among the training labels; rows are independent, so repeated rows
and ties give equal scores; without any label the score is 0.5; extra columns are not read. Texts are
read whole, in pieces of bounded size.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnguard.llm import rolling
from txnguard.llm.wordwise import whole_texts

BUCKETS = 4096
RANK = 48
PER_LABEL = 1500
NEIGHBOURS = 25
THRESHOLD = 0.3
REPEAT_WEIGHT = 2.0
#: Bytes whose trigrams are counted at a time.
STEP = 4_000_000


def trigram_counts(texts: pa.Array, buckets: int = BUCKETS) -> np.ndarray:
    """(rows, buckets) float32 counts of hashed byte trigrams that lie inside each text."""
    raw = texts.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2], np.uint8) if raw.buffers()[2] is not None else np.zeros(0, np.uint8)
    out = np.zeros((len(raw), buckets), np.float32)
    row = 0
    while row < len(raw):
        top = max(row + 1, int(np.searchsorted(offsets, offsets[row] + STEP, "right")) - 1)
        top = min(top, row + 1024, len(raw))
        for at in range(int(offsets[row]), int(offsets[top]), STEP):  # one very long text: piece by piece
            d = data[at:min(at + STEP + 2, int(offsets[top]))].astype(np.uint32)
            if len(d) < 3:
                continue
            h = d[:-2] * np.uint32(0x9E3779B1) ^ d[1:-1] * np.uint32(0x85EBCA77) ^ d[2:] * np.uint32(0xC2B2AE3D)
            h = (h ^ h >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> np.uint32(20)
            starts = np.arange(at, at + len(h))
            owner = np.searchsorted(offsets[row + 1:top + 1], starts, "right")
            inside = starts + 3 <= offsets[row + 1:top + 1][np.minimum(owner, top - row - 1)]
            flat = owner[inside] * buckets + (h[inside].astype(np.int64) % buckets)
            out[row:top] += np.bincount(flat, minlength=(top - row) * buckets)[:(top - row) * buckets] \
                .reshape(-1, buckets).astype(np.float32)
        row = top
    return out


def repeat_shares(texts: pa.Array) -> np.ndarray:
    """Share of each text's words that equal the word before."""
    out = np.zeros(len(texts), np.float32)
    for row, offsets, data in rolling.chunks(texts):
        hashes, _, _, ends = rolling.word_hashes(data, offsets)
        same = np.zeros(len(hashes) + 1, np.int64)
        same[2:] = np.cumsum(hashes[1:] == hashes[:-1])
        n = np.diff(ends)
        inside = same[ends[1:]] - same[np.minimum(ends[:-1] + 1, ends[1:])]
        out[row:row + len(n)] = np.where(n > 1, inside / np.maximum(n - 1, 1), 0)
    return out


def features(texts: pa.Array) -> np.ndarray:
    """Trigram counts and, last, the repeat share."""
    return np.concatenate((trigram_counts(texts), repeat_shares(texts)[:, None]), axis=1)


class Voter:
    """The fitted model: directions, labelled vectors, labels. Small arrays of documented size."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, prior: float, rank: int, k: int):
        self.k, self.prior, self.labels = k, prior, labels.astype(np.float32)
        if len(counts):
            df = (counts[:, :-1] > 0).sum(0)
            self.idf = np.log((1 + len(counts)) / (1 + df)).astype(np.float32) + 1
            x = self.weighted(counts)
            rng = np.random.default_rng(0)
            rank = min(rank, *x.shape)
            basis = np.linalg.qr(x.T @ (x @ rng.standard_normal((x.shape[1], rank + 8), np.float32)))[0]
            for _ in range(4):
                basis = np.linalg.qr(x.T @ (x @ basis))[0]
            _, _, right = np.linalg.svd(x @ basis, full_matrices=False)
            self.directions = (basis @ right.T)[:, :rank].astype(np.float32)
            self.vectors = self.unit(x @ self.directions)

    @staticmethod
    def unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def weighted(self, counts: np.ndarray) -> np.ndarray:
        """Unit trigram weights beside ``REPEAT_WEIGHT`` times the repeat share."""
        out = np.log1p(counts)
        weights = out[:, :-1]
        weights *= self.idf
        for at in range(0, len(out), 512):  # no second copy of all weights
            weights[at:at + 512] /= np.maximum(np.linalg.norm(weights[at:at + 512], axis=1, keepdims=True), 1e-12)
        out[:, -1] = counts[:, -1] * REPEAT_WEIGHT
        return out

    def score(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        out = np.empty(len(counts))
        for at in range(0, len(counts), 512):
            x = self.weighted(counts[at:at + 512]) @ self.directions
            sims = self.unit(x) @ self.vectors.T
            k = min(self.k, sims.shape[1])
            near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(sims, near, 1), 0).astype(np.float64) ** 8
            total = weight.sum(1)
            votes = (weight * self.labels[near]).sum(1)
            out[at:at + 512] = np.where(total > 0, votes / np.maximum(total, 1e-12), self.prior)
        return out.clip(0, 1)


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Rows kept from training: crc32 of the id as text divides by ``folds``; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_label: int = PER_LABEL,
        rank: int = RANK, k: int = NEIGHBOURS) -> Voter:
    """Learn from at most ``per_label`` rows of each label (those of least id hash) outside the held-out rows.
    One task fits the model on the counts of one row for each id (at most 2 x ``per_label`` rows of ``BUCKETS`` numbers);
    only the model reaches the driver: about 1.4 MB of frequencies, directions and labelled vectors."""
    known = (labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy(F.col("doc_id").alias("_id")).agg(F.min(label).alias("_y")))
    prior = known.agg(F.avg("_y")).first()[0]
    picked = None
    for value in (0, 1):
        part = known.filter(F.col("_y") == value).orderBy(F.xxhash64("_id"), "_id").limit(per_label)
        picked = part if picked is None else picked.unionByName(part)
    rows = (docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id"))  # <= 2 x per_label
            .select(F.col("_id"), "_y", "text"))

    def run(batches):
        least: dict = {}  # repeated documents count once, with the least counts; at most 2 x per_label ids a task
        schema = None
        for b in batches:
            schema = b.schema
            packed = [c.astype(np.float32).tobytes() for c in features(whole_texts(b))]
            for i, y, c in zip(b.column("_id").to_pylist(), b.column("_y").to_pylist(), packed, strict=True):
                if i not in least or c < least[i][1]:
                    least[i] = (y, c)
        if least:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(least), schema.field("_id").type), pa.array([y for y, _ in least.values()], schema.field("_y").type),
                 pa.array([c for _, c in least.values()], pa.binary())], ["_id", "_y", "counts"])

    id_type = picked.schema["_id"].dataType.simpleString()
    got = rows.mapInArrow(run, f"_id {id_type}, _y int, counts binary")
    got = got.groupBy("_id", "_y").agg(F.min("counts").alias("counts"))  # one row an id
    base = 0.5 if prior is None else float(prior)

    def learn(batches):
        ids, ys, counts = [], [], []
        for b in batches:
            ids += b.column("_id").to_pylist()
            ys += b.column("_y").to_pylist()
            counts += [np.frombuffer(c, np.float32) for c in b.column("counts").to_pylist()]
        order = sorted(range(len(ids)), key=ids.__getitem__)
        counts = np.array([counts[i] for i in order], np.float32).reshape(-1, BUCKETS + 1)
        model = Voter(counts, np.array([ys[i] for i in order], np.float32), base, rank, k)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    made = got.repartition(1).mapInArrow(learn, "model binary").collect()
    return pickle.loads(made[0].model) if made else Voter(np.zeros((0, BUCKETS + 1)), np.zeros(0), base, rank, k)


def score_documents(docs: DataFrame, model: Voter, out: str = "score") -> DataFrame:
    """doc_id and text's score in [0, 1] for every row; higher: label 1 likelier."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        voter = shared.value
        for b in batches:
            texts = whole_texts(b)
            scores = [voter.score(features(texts.slice(at, 512))) for at in range(0, len(texts), 512)]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in b.schema.names), pa.array(np.concatenate(scores) if scores else np.zeros(0))],
                [*b.schema.names, out])

    from pyspark.sql.types import DoubleType, StructType
    schema = StructType([*docs.schema.fields]).add(out, DoubleType())
    return docs.mapInArrow(run, schema)


def predictions(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    model = fit(docs, labels)
    scored = score_documents(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, unchanged."""
    name = "_score"
    while name in docs.columns:
        name += "_"
    scored = score_documents(docs, fit(docs, labels), name)
    return scored.filter(F.col(name) >= threshold).drop(name)
