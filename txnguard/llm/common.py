"""Helpers shared by the text operators: table access, written intermediates, row keys, gapless numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnguard.session import new_work_path
from txnguard.sources.tables import read_table

#: Rows that one numbering bucket of :func:`gapless` holds on average.
ROWS_PER_BUCKET = 20_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once into the shared folder (``spark.checkpoint.dir``) and read it back: cuts the
    lineage, and an executor lost later costs a re-read of files instead of a recomputation."""
    path = new_work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Identifies a row's content: rows that repeat both doc_id and text share their results."""
    return F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), text_of(text))


def buckets_for(n_rows: int, per: int = ROWS_PER_BUCKET) -> int:
    return max(1, -(-n_rows // per))


def gapless(df: DataFrame, keys: list[str], order: list, out: str, salt: Column, n_rows: int) -> DataFrame:
    """Number the rows of every ``keys`` group from 0 without gaps, no group in one task: each group is cut
    into salted buckets, numbered inside them, and shifted by the buckets before (their counts are
    one row per group and bucket)."""
    n = buckets_for(n_rows)
    df = df.withColumn("_b", F.pmod(salt, F.lit(n)).cast("int"))
    counts = df.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_b").alias("_kb"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, "_b").orderBy(*order)
    df = df.withColumn("_i", F.row_number().over(inside) - 1)
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_b") == F.col("_kb")]
    return (df.join(counts, on, "left").withColumn(out, (F.col("_i") + F.col("_before")).cast("long"))
            .drop("_b", "_kb", "_i", "_before", *[f"_k_{k}" for k in keys]))


def numbered(rows: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``rows`` (tree, ...) in ``order`` (tree first) with pos, the place in the tree from 0 without gaps, and n, the rows of
    the tree. Ranges of the order are written once; one row per range and tree tells what stands before it, so
    neither a tree nor a range is numbered in one task. Equal rows go to ranges of their own only if ``order`` parts them."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = staged(rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
                    .withColumns({"_part": F.spark_partition_id(),
                                  "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), label)
    tree = Window.partitionBy("tree")
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (ranged.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("_c"), F.min("_at").alias("_first"))
            .select(F.col("tree").alias("_tree"), F.col("_part").alias("_of"), F.sum("_c").over(tree).alias("n"),
                    (F.coalesce(F.sum("_c").over(before), F.lit(0)) - F.col("_first")).alias("_shift")))
    return (ranged.join(runs, (F.col("tree") == F.col("_tree")) & (F.col("_part") == F.col("_of")))
            .withColumn("pos", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_tree", "_of", "_shift"))
