"""Ranked lexical search without random access (operator 12).

Documents are searched in shards of at most ``SHARD`` rows, where they lie: a task sorts its shard's postings of the items'
terms into lists of falling impact and reads an item's lists side by side, ``DEPTH`` postings at first and twice as
many each time. What a document has shown so far is the lower end of its score; the upper end adds, for each term
not yet met in it, the impact of the next unread posting of the term's list. Documents whose upper end lies under the
k-th best lower end of the item, in this shard or those that the task read before, go. An item is open while an unread
document could still reach that end; after that only the documents left over are followed. Reading stops
when no unread document can come in and both ends of every document left agree, so membership, ties and scores are final. The k best
of each shard then meet, at most k an item from a task.

Scores are those of the whole-number formula in :func:`impacts`. Nothing is shuffled but the terms' document counts and
the k best of each task. Items are sent to the tasks in portions of at most ``ITEM_BYTES`` of terms.

Defined results: null texts and texts without a term hold nothing and count nowhere; items without a term (null, empty)
and items whose terms no document holds give no rows; rows that repeat an item_id are one item with the terms of all; rows
that repeat a doc_id are documents of their own; of equal scores the smaller doc_id comes first, a null one before
all; empty tables give no rows; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnguard.llm.common import staged

#: Documents whose lists a task holds at a time.
SHARD = 16_384
#: Postings read of each list in the first round.
DEPTH = 64
#: Bytes of items' terms that are sent to the tasks at a time.
ITEM_BYTES = 32 * 1024 * 1024
#: Bytes of one text that are cut into terms at a time.
PIECE = 4 * 1024 * 1024

#: What stands between terms: ASCII but digits and letters. Upper-case ASCII letters become small ones.
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def terms(text: str | None):
    """The terms of a text as UTF-8 bytes, in lists of those of a bounded piece each."""
    raw, at = (text or "").encode(), 0
    while at < len(raw):
        end = min(at + PIECE, len(raw))
        piece = raw[at:end].translate(_TERM_BYTES)
        if end < len(raw):  # a term that the piece cuts is left to the next one, however long it is
            while (cut := piece.rfind(b" ")) < 0 and end < len(raw):
                more = raw[end:end + PIECE].translate(_TERM_BYTES)
                piece, end = piece + more, end + len(more)
            if end < len(raw):
                piece = piece[:cut + 1]
        at += len(piece)
        yield piece.split()


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item, term)."""

    def run(batches):
        for b in batches:
            ids, out = [], []
            for i, t in enumerate(b.column("text")):
                own = sorted(set().union(*terms(t.as_py())))
                ids += [i] * len(own)
                out += own
            yield pa.RecordBatch.from_arrays([b.column("item").take(pa.array(ids, pa.int64())),
                                              pa.array(out, pa.binary()).cast(pa.string())], ["item", "term"])

    rows = items.select(F.col(item_id).alias("item"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"item {rows.schema['item'].dataType.simpleString()}, term string").distinct()


def counted(docs: DataFrame, vocabulary: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document with a term: doc_id, n (its terms with repeats), and for the terms of ``vocabulary`` that it holds
    their number in that list and their occurrences. The list is broadcast; the caller bounds it."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        number = {t.encode(): i for i, t in enumerate(known.value)}
        for b in batches:
            sizes, offsets, ids, tfs = [], [0], [], []
            for t in b.column("text"):
                n, own = 0, Counter()
                for some in terms(t.as_py()):
                    n += len(some)
                    own.update(filter(number.__contains__, some))
                sizes.append(n)
                ids += map(number.__getitem__, own)
                tfs += own.values()
                offsets.append(len(ids))
            at = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(at, pa.array(ids, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(tfs, pa.int64()))], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, n long, terms array<int>, tfs array<long>").filter("n > 0")


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What ``tf`` occurrences in documents of ``n`` terms are worth before the term's weight, in whole numbers."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))


def read_lists(starts: np.ndarray, ends: np.ndarray, docs: np.ndarray, impact: np.ndarray, n_docs: int, k: int,
               floor: int, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, int]:
    """The documents of one shard that may be among the k best of an item, with their scores, and how many postings were
    read. List j is docs[starts[j]:ends[j]] with falling impacts; ``floor``: a score that k documents reach already."""
    lists = len(starts)
    lower, seen, at, read = np.zeros(n_docs, np.int64), np.zeros((n_docs, lists), bool), starts.copy(), 0
    followed = None  # all documents, while one not yet read could come in
    while True:
        for j in np.nonzero(at < ends)[0]:
            stop = min(at[j] + depth, ends[j])
            d, x = docs[at[j]:stop], impact[at[j]:stop]
            read += len(d)
            at[j] = stop
            if followed is not None:
                keep = followed[d]
                d, x = d[keep], x[keep]
            lower[d] += x  # a document stands once in a list
            seen[d, j] = True
        bound = np.where(at < ends, impact[np.minimum(at, len(impact) - 1)], 0)
        met = np.nonzero(lower > 0 if followed is None else followed)[0]
        if len(met) >= k:
            floor = max(floor, int(np.partition(lower[met], len(met) - k)[len(met) - k]))
        slack = (~seen[met]) @ bound
        left = lower[met] + slack >= max(floor, 1)
        met, slack = met[left], slack[left]
        if bound.sum() < max(floor, 1):
            followed = np.zeros(n_docs, bool)
            followed[met] = True
            if not slack.any():
                return met, lower[met], read
        depth *= 2


def _best(scores: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, equal ones by ``order``."""
    return np.lexsort((order, -scores))[:k]


def _search(shared, n_docs: int, n_terms: int, k: int, shard: int):
    """Tasks: the k best documents of each item in each shard."""

    def run(batches):
        items, names, offsets, own_terms, weights = shared.value
        floors = [np.zeros(0, np.int64) for _ in range(items)]  # the best scores of the shards before
        held, rows = [], 0

        def finish():
            doc_id = pa.concat_arrays([b.column("doc_id") for b in held])
            n = np.concatenate([b.column("n").to_numpy() for b in held])
            lists = pa.concat_arrays([b.column("terms") for b in held])
            sizes = np.diff(lists.offsets.to_numpy())
            term = lists.flatten().to_numpy()
            tf = pa.concat_arrays([b.column("tfs") for b in held]).flatten().to_numpy()
            doc = np.repeat(np.arange(len(n)), sizes)
            value = weights[term] * impacts(tf, n[doc], n_docs, n_terms)
            order = np.lexsort((-value, term))
            term, doc, value = term[order], doc[order], value[order]
            first, last = np.searchsorted(term, own_terms), np.searchsorted(term, own_terms, "right")
            # places of the documents by doc_id, null first, then as they lie in the table
            rank = np.empty(len(n), np.int64)
            rank[pc.sort_indices(doc_id, null_placement="at_start").to_numpy()] = np.arange(len(n))
            which, found, score = [], [], []
            for i in range(items):
                a, b = first[offsets[i]:offsets[i + 1]], last[offsets[i]:offsets[i + 1]]
                some = (b > a) & (weights[own_terms[offsets[i]:offsets[i + 1]]] > 0)
                if not some.any():
                    continue
                floor = int(floors[i][0]) if len(floors[i]) == k else 0
                met, scores, _ = read_lists(a[some], b[some], doc, value, len(n), k, floor)
                best = _best(scores, rank[met], k)
                which += [i] * len(best)
                found.append(met[best])
                score.append(scores[best])
                floors[i] = np.sort(np.concatenate((floors[i], scores[best])))[-k:]
            at = np.concatenate(found) if found else np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays(
                [names.take(pa.array(which, pa.int64())), doc_id.take(pa.array(at)),
                 pa.array(np.concatenate(score) if score else np.zeros(0, np.int64))], ["item", "doc_id", "score"])

        for b in batches:
            for at in range(0, b.num_rows, shard):
                piece = b.slice(at, min(shard, b.num_rows - at))
                if rows + piece.num_rows > shard:
                    yield finish()
                    held, rows = [], 0
                held.append(piece)
                rows += piece.num_rows
        if held:
            yield finish()

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 10, item_id: str = "item_id", shard: int | None = None) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of each item's ``k`` best documents with a score above 0."""
    spark = docs.sparkSession
    asked = staged(item_terms(items, item_id), "item-terms")
    size = asked.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    portions = -(-size // ITEM_BYTES)
    portion = F.pmod(F.xxhash64(F.col("item").isNull(), "item"), F.lit(max(portions, 1)))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    item_type = asked.schema["item"].dataType.simpleString()
    found = spark.createDataFrame([], f"item {item_type}, doc_id {id_type}, score long")
    for p in range(portions):  # a stated set of items, in portions of bounded size
        own = asked.filter(portion == p)
        vocabulary = sorted(r.term for r in own.select("term").distinct().collect())
        if not vocabulary:
            continue
        rows = staged(counted(docs, vocabulary), "term-counts")
        n_docs, n_terms = rows.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            break
        df = np.zeros(len(vocabulary), np.int64)
        for r in rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row a term sent
            df[r.t] = r["count"]
        weights = np.where(df > 0, np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))), 0).astype(np.int64)
        number = {t: i for i, t in enumerate(vocabulary)}
        by_item: dict = {}
        for r in own.collect():
            by_item.setdefault(r.item, []).append(number[r.term])
        names = pa.array(list(by_item), _arrow_type(item_type))
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in by_item.values()])))
        terms_of = np.concatenate([np.sort(x) for x in by_item.values()])
        shared = spark.sparkContext.broadcast((len(by_item), names, offsets, terms_of, weights))
        best = rows.mapInArrow(_search(shared, n_docs, n_terms, k, shard or SHARD), found.schema)
        # each task's k best of an item, so that what meets does not grow with a task's shards
        found = found.unionByName(staged(best, "found"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first())
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select(F.col("item").alias(item_id), "rank", "doc_id", "score"))


def _arrow_type(name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType
    return to_arrow_type(StructType.fromDDL(f"x {name}")[0].dataType)
