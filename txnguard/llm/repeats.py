"""First steps shared by the two repeat removers: which windows of a fixed number of symbols can repeat.

Every window is owned by its minimiser (``rolling.anchors``): equal windows have equal owner grams at equal
places, so only windows that share an owner gram need be compared. Neighbouring windows of one owner form a
stretch (about 40 windows instead of one row each). A stretch equal to an earlier one is a repeat as a
whole; a stretch whose owner gram has no other stretch holds no repeat; what is left, stretches that share
their owner gram but differ, are ``open``: some of their windows may repeat, and the caller compares them.

Map tasks settle equal stretches among their own rows first, so a passage that a third of all documents
share sends one row a task to the shuffle. Rows are identified by doc_id and ``tag``, a hash of the text that
keeps apart different texts under one doc_id.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnguard.llm import rolling
from txnguard.llm.common import text_of
from txnguard.llm.wordwise import whole_texts

#: Symbols of a chunk: (value sums, symbol offsets of the texts).
Symbols = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def byte_symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return rolling.prefix_sums(rolling.BYTE_VALUES[data]), offsets


def word_symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes, _, _, ends = rolling.word_hashes(data, offsets)
    return rolling.prefix_sums(hashes), ends


def tagged(docs: DataFrame) -> DataFrame:
    """doc_id, tag, text; rows without a doc_id or text are left out, equal rows are kept."""
    return (docs.select("doc_id", F.shiftright(F.hash(text_of()), 16).cast("smallint").alias("tag"), "text")
            .filter("doc_id is not null and text is not null"))


def stretches_of(symbols: Symbols, data: np.ndarray, offsets: np.ndarray, window: int, gram: int):
    """(text, owner gram hash, stretch hash, first window, windows, owner's place in the stretch)."""
    sums, ends = symbols(data, offsets)
    n = len(sums) - 1
    if n < window:
        return None
    at = np.arange(n - gram + 1)
    grams = rolling.range_hash(sums, at, at + gram)
    owner, first, last = rolling.anchors(grams, ends, window, gram)
    if not len(owner):
        return None
    place = owner - first
    whole = rolling.mix(rolling.range_hash(sums, first, last + window) ^ rolling.mix(place.astype(np.uint64)))
    text = np.searchsorted(ends, first, "right") - 1
    # minimisers have small hashes; mixed again they are even
    return text, rolling.mix(~grams[owner]), whole, first - ends[text], last - first + 1, place


def repeat_flags(keys: list[np.ndarray], ids, tags, first, within: bool) -> np.ndarray:
    """Which rows repeat an earlier row of equal ``keys``: one of a smaller doc_id or, if ``within``, one that
    starts earlier in the same document."""
    n = len(first)
    if not n:
        return np.zeros(0, bool)
    order = np.lexsort((first, tags, ids, *keys))
    new = np.ones(n, bool)
    new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    at = np.arange(n)
    own, head = ids[order], np.maximum.accumulate(np.where(new, at, 0))
    repeat = own != own[head]
    if within:
        tag, start = tags[order], first[order]
        new[1:] |= (own[1:] != own[:-1]) | (tag[1:] != tag[:-1])
        repeat |= start > start[np.maximum.accumulate(np.where(new, at, 0))]
    out = np.zeros(n, bool)
    out[order] = repeat
    return out


def column(batch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch) \
        else batch.column(name).to_numpy()


#: Stretches that a map task settles and sends on together; what it holds does not grow with the rows of a batch.
SETTLED_AT_ONCE = 100_000


def stretches(docs: DataFrame, symbols: Symbols, window: int, gram: int, within: bool, settled: bool) -> DataFrame:
    """One row per stretch of ``tagged`` documents: owner, whole, doc_id, tag, first, n, place. ``settled`` picks
    the rows that repeat an earlier one of the same part of a batch, neighbouring texts with
    ``SETTLED_AT_ONCE`` stretches (else all others). ``within``: an earlier place in the same document counts too."""

    def parts_of(b):
        parts, size = [], 0
        for row, offsets, data in rolling.chunks(whole_texts(b)):
            got = stretches_of(symbols, data, offsets, window, gram)
            if got is not None:
                parts.append((got[0] + row, *got[1:]))
                size += len(got[0])
            if size >= SETTLED_AT_ONCE:
                yield parts
                parts, size = [], 0
        if parts:
            yield parts

    def run(batches):
        for b, parts in ((b, parts) for b in batches for parts in parts_of(b)):
            ids, tags = column(b, "doc_id"), column(b, "tag")
            text, owner, whole, first, n, place = (np.concatenate(x) for x in zip(*parts, strict=True))
            repeat = repeat_flags([owner ^ rolling.mix(whole)], ids[text], tags[text], first, within)
            keep = np.nonzero(repeat if settled else ~repeat)[0]
            text = pa.array(text[keep])
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner[keep].view(np.int64)), pa.array(whole[keep].view(np.int64)),
                 b.column("doc_id").take(text), b.column("tag").take(text), pa.array(first[keep].astype(np.int32)),
                 pa.array(n[keep].astype(np.int16)), pa.array(place[keep].astype(np.int16))],
                ["owner", "whole", "doc_id", "tag", "first", "n", "place"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"owner long, whole long, doc_id {id_type}, tag smallint, first int, n smallint, "
                                "place smallint")


def classify(docs: DataFrame, symbols: Symbols, window: int, gram: int, within: bool) -> DataFrame:
    """Stretches that repeat as a whole (open false) or may repeat in part (open true)."""
    rows = stretches(docs, symbols, window, gram, within, settled=False)
    same = Window.partitionBy("owner", "whole").orderBy("doc_id", "tag", "first")
    rows = rows.withColumn("_doc", F.first("doc_id").over(same))
    in_doc = Window.partitionBy("owner", "whole", "doc_id", "tag")
    rows = rows.withColumn("_first", F.min("first").over(in_doc))
    by_owner = Window.partitionBy("owner")
    rows = rows.withColumns({"_low": F.min("whole").over(by_owner), "_high": F.max("whole").over(by_owner)})
    repeat = F.col("doc_id") > F.col("_doc")
    if within:
        repeat = repeat | (F.col("first") > F.col("_first"))
    rows = (rows.withColumn("open", ~repeat).filter(repeat | (F.col("_low") != F.col("_high")))
            .select("owner", "doc_id", "tag", "first", "n", "place", "open"))
    early = stretches(docs, symbols, window, gram, within, settled=True)
    return rows.unionByName(early.select("owner", "doc_id", "tag", "first", "n", "place", F.lit(False).alias("open")))


#: Open stretches of one owner above which each window is compared on its own, by a hash of the whole of it.
HOT_STRETCHES = 4096


def open_by_document(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Documents with open stretches: doc_id, tag, text, todo (array of owner, first, n, place, hot)."""
    some = classes.filter("open")
    hot = (some.groupBy("owner").agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > HOT_STRETCHES)
           .select(F.col("owner").alias("_hot")))
    some = some.join(hot, F.col("owner") == F.col("_hot"), "left")
    todo = some.groupBy(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag")).agg(F.collect_list(F.struct(
        "owner", "first", "n", "place", F.col("_hot").isNotNull().alias("hot"))).alias("todo"))
    return (docs.join(todo, (F.col("doc_id") == F.col("_id")) & (F.col("tag") == F.col("_tag")))
            .select("doc_id", "tag", "text", "todo"))


def todo_arrays(batch: pa.RecordBatch):
    """The ``todo`` lists of a batch as flat arrays, with the row of each entry."""
    lists = batch.column("todo")
    flat = lists.flatten()
    counts = np.diff(lists.offsets.to_numpy())
    row = np.repeat(np.arange(batch.num_rows), counts)
    names = [f.name for f in flat.type]
    arrays = dict(zip(names, (x.to_numpy(zero_copy_only=False) for x in flat.flatten()), strict=True))
    return row, arrays


def second_values(sums_of: np.ndarray) -> np.ndarray:
    return rolling.mix(sums_of ^ np.uint64(0xD6E8FEB86659FD93))


def window_hashes(values: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of the windows that begin at ``starts`` of the symbols ``values``."""
    a, b = rolling.prefix_sums(values), rolling.prefix_sums(second_values(values))
    return rolling.range_hash(a, starts, starts + window), rolling.range_hash(b, starts, starts + window)


def hot_windows(values: np.ndarray, base: np.ndarray, first: np.ndarray, n: np.ndarray, window: int):
    """Every window of the hot stretches of one chunk: (stretch index, first symbol in its text, two hashes)."""
    which = np.repeat(np.arange(len(first)), n)
    ends = np.cumsum(n)
    step = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - n, n)
    starts = base[which] + first[which] + step
    return which, first[which] + step, *window_hashes(values, starts, window)


def resolve_hot(pieces: DataFrame, within: bool) -> DataFrame:
    """Repeats among hot windows (h1, h2, doc_id, tag, first): doc_id, tag, first, n. The earliest holder of each
    window comes from a partially aggregated minimum; no window's rows are gathered."""
    least = F.min(F.struct("doc_id", "tag", "first")).alias("_least")
    earliest = pieces.groupBy("h1", "h2").agg(least).select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "_least")
    rows = pieces.join(earliest, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")))
    repeat = F.col("doc_id") > F.col("_least.doc_id")
    if within:
        repeat = repeat | ((F.col("doc_id") == F.col("_least.doc_id")) & (F.col("tag") == F.col("_least.tag"))
                           & (F.col("first") > F.col("_least.first")))
    return rows.filter(repeat).select("doc_id", "tag", "first", F.lit(1).cast("smallint").alias("n"))


def runs_of(rows: np.ndarray, at: np.ndarray):
    """Join neighbouring (row, position) pairs, sorted, to (row, first, n) runs."""
    if not len(at):
        return rows, at, at
    new = np.ones(len(at), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.nonzero(new)[0]
    return rows[begin], at[begin], np.diff(np.append(begin, len(at)))


def with_repeats(docs: DataFrame, repeats: DataFrame) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its repeats as an array of (first, n), null if none."""
    found = repeats.groupBy(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag")).agg(
        F.collect_list(F.struct("first", "n")).alias("repeats"))
    rows = docs.select("doc_id", F.shiftright(F.hash(text_of()), 16).cast("smallint").alias("tag"), "text")
    return (rows.join(found, (F.col("doc_id") == F.col("_id")) & (F.col("tag") == F.col("_tag")), "left")
            .select("doc_id", "text", "repeats"))


def covered(size: int, spans, window: int) -> np.ndarray:
    """Symbols of a text covered by the windows of its repeat runs."""
    change = np.zeros(size + 1, np.int64)
    for s in spans or ():
        change[s["first"]] += 1
        change[s["first"] + s["n"] - 1 + window] -= 1
    return np.cumsum(change)[:size] > 0
