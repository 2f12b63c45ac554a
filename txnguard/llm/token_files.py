"""Token ids as Parquet list columns (operator 4).

One row per document in ascending doc_id order: doc_id, n_tokens, ids. Ids are dictionary-encoded (the
vocabulary fits one dictionary page); doc_id and the counts are delta-encoded. Row groups and pages have
set sizes, and the page indexes let a reader take the pages of some documents, or the counts without the
ids. Files are ranges of doc_id, so a file's number orders it among the others.

Defined results: null and empty texts hold the end id alone; null doc_ids come first; rows that share a
doc_id are ordered by their text; extra columns are not read; the string of an added token inside a text is
that token, as in the library, whatever stands around it.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnguard.llm.wordwise import WordCache, encode_texts, replaced, slices, whole_texts
from txnguard.session import new_work_path

ROW_GROUP_BYTES = 8 * 1024 * 1024
PAGE_BYTES = 64 * 1024
END_ID = 2
#: Pieces of words that one worker remembers.
PIECES = 500_000

_CACHES: dict[str, tuple[WordCache, list[str], Callable[[str], bytes]]] = {}
#: Words of printable ASCII and precomposed Latin letters (but the dotted capital I, whose lower case is two
#: characters): what the normaliser does to them is lower-casing alone.
_PLAIN = re.compile("[!-~\\t\\n\\r\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]*")
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u017f"
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\\s0-9{_LETTERS}]+")


def _byte_characters() -> dict[int, str]:
    """Byte -> the character that stands for it in a byte-level vocabulary: printable ones themselves, the others
    from 256 up, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_BYTE_CHARACTERS = _byte_characters()


def _cache(tokenizer_file: str) -> tuple[WordCache, list[str], Callable[[str], bytes]]:
    """Encoder of one word for a worker process, the strings of the added tokens, and the library's encoder of a
    whole text for texts that hold one. A word without white space meets the same normaliser and
    pre-splitting alone as inside its text, so words are encoded once each. Pieces go to the library's
    model directly; only words beyond ASCII need its normaliser and splitter."""
    if tokenizer_file not in _CACHES:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        lib = Tokenizer.from_file(tokenizer_file)
        model, pieces = lib.model, {}
        added = [t.content for t in lib.get_added_tokens_decoder().values()]

        def of_text(text: str) -> bytes:
            return np.array(lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

        def of_piece(piece: str) -> bytes:
            ids = pieces.get(piece)
            if ids is None:
                if not piece.isascii():
                    mapped = piece.encode().decode("latin-1").translate(_BYTE_CHARACTERS)
                else:
                    mapped = piece
                ids = array("I", [t.id for t in model.tokenize(mapped)]).tobytes()
                if len(pieces) < PIECES:
                    pieces[piece] = ids
            return ids

        def of_word(word: str) -> bytes:
            if _PLAIN.fullmatch(word):
                found = _PIECES.findall(word.lower())
                return of_piece(found[0]) if len(found) == 1 else b"".join(map(of_piece, found))
            split = lib.pre_tokenizer.pre_tokenize_str(lib.normalizer.normalize_str(word))
            return np.array([t.id for p, _ in split for t in model.tokenize(p)], "<u4").tobytes()

        if type(model).__name__ != "BPE" or not _direct(lib, of_word):
            of_word = of_text  # another kind of tokenizer file: the whole library path
        _CACHES[tokenizer_file] = WordCache(of_word), added, of_text
    return _CACHES[tokenizer_file]


def _direct(lib, of_word) -> bool:
    """Whether the direct path gives the library's ids on probes of every kind of character. ``encode_texts``
    lower-cases ASCII first, so the probes are tried both ways."""
    probes = ["Hello", "ÀÖØÞßàöøÿĀĸŉſƁƻǀǄȀɏ", "x\u00d7\u00f7y", "\u0130", "it's", "I'LL", "a1b22c", "x,y;z!!", "café", "Ångström", "漢字", "\U0001f600ok",
              "a\tb\nc", "_-_", "'", "''s", "\x01\x7f", "İΣσ", "ﬁΩ"]
    return all(np.frombuffer(of_word(p), "<u4").tolist() == lib.encode(p, add_special_tokens=False).ids
               for p in [*probes, *map(str.lower, probes)])


def write_token_files(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = END_ID,
                      n_files: int | None = None) -> None:
    """Encode every whole text, append ``end_id``, write by doc_id. Documents are ranged before they are
    encoded, so no id is shuffled and the encoder runs once a document."""
    spark = docs.sparkSession
    n = n_files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    ranged = (docs.select(docs["doc_id"], docs["text"])
              .repartitionByRange(n, F.col("doc_id").asc_nulls_first())
              .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
              .withColumn("part", F.spark_partition_id()))

    def run(batches):
        (cache, added, of_text), at = _cache(tokenizer_file), 0
        for b in slices(batches):
            raw = whole_texts(b)
            held = np.zeros(len(raw), bool)
            for token in added:  # any case: a tokenizer file may look for them before or after it lower-cases
                held |= pc.match_substring(raw, token, ignore_case=True).to_numpy(zero_copy_only=False)
            ids, offsets = encode_texts(pc.ascii_lower(raw), cache)  # lower case as the normaliser makes it later
            ids, offsets = replaced(ids, offsets, np.nonzero(held)[0], lambda t: of_text(raw[t].as_py()))  # noqa: B023
            ids = np.insert(ids.astype(np.int32), offsets[1:], end_id)
            offsets = offsets + np.arange(len(offsets))
            lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(ids))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("part"), pa.array(np.arange(at, at + b.num_rows), pa.int64()),
                 pa.array(np.diff(offsets), pa.int64()), lists.cast(pa.list_(pa.int32()))],
                ["doc_id", "part", "row", "n_tokens", "ids"])
            at += b.num_rows

    rows = ranged.mapInArrow(run, f"doc_id {id_type}, part int, row long, n_tokens long, ids array<int>")
    delta = {f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "part", "row", "n_tokens")}
    (rows.write.options(**delta)
     .option("parquet.writer.version", "v2")
     .option("parquet.enable.dictionary", "true")
     .option("parquet.dictionary.page.size", str(1024 * 1024))
     .option("parquet.block.size", str(ROW_GROUP_BYTES))
     .option("parquet.page.size", str(PAGE_BYTES))
     .option("compression", "zstd")
     .parquet(path))


def read_token_files(spark: SparkSession, path: str, first: int | None = None, last: int | None = None,
                     ids: bool = True) -> DataFrame:
    """Rows with their ``start`` (ids of all documents before). Starts come from the counts alone: a sum per
    file, then a running sum inside each file. ``first`` and ``last`` (doc_ids, inclusive) and ``ids=False``
    read only the pages and columns asked for; starts need the counts of all."""
    table = spark.read.parquet(path)
    rows = table.select("doc_id", "part", "row", "n_tokens")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = (rows.groupBy("part").agg(F.sum("n_tokens").alias("_sum"))  # one row a file
            .select(F.col("part").alias("_part"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base")))
    inside = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    rows = (rows.withColumn("_in", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(sums, F.col("part") == F.col("_part"))
            .select("doc_id", "part", "row", (F.col("_base") + F.col("_in")).alias("start"), "n_tokens"))
    wanted = F.lit(True)
    if first is not None:
        wanted = wanted & (F.col("doc_id") >= first)
    if last is not None:
        wanted = wanted & (F.col("doc_id") <= last)
    rows = rows.filter(wanted)
    return rows.join(table.filter(wanted).select("part", "row", "ids"), ["part", "row"]) if ids else rows


def token_digest(docs: DataFrame, tokenizer_file: str, end_id: int = END_ID) -> DataFrame:
    """Write the files, read them back: doc_id, start, n_tokens, ids_crc32. The checksums are taken in one
    scan of the ids; only they are joined with the starts."""
    spark = docs.sparkSession
    path = new_work_path(spark, "tokens")
    write_token_files(docs, path, tokenizer_file, end_id)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def crc(batches):
        for b in batches:
            lists = b.column("ids")
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            raw = memoryview(np.ascontiguousarray(values, "<u4").tobytes())
            sums = [zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("part"), b.column("row"), pa.array(sums, pa.int64())],
                                             ["part", "row", "ids_crc32"])

    sums = spark.read.parquet(path).select("part", "row", "ids").mapInArrow(crc, "part int, row long, ids_crc32 long")
    rows = read_token_files(spark, path, ids=False)
    return (rows.join(sums, ["part", "row"])
            .select(F.col("doc_id").cast(id_type), F.col("start").cast("long"), "n_tokens", "ids_crc32"))
