"""Dimension-side preparation for stream/batch-to-dimension joins.

A dimension is broadcast only behind a size check: it is first written as a
Parquet table into the shared folder (``spark.checkpoint.dir``; computed once,
lineage cut), then rows and data bytes are summed from that table in one
aggregate (no recomputation of the dimension's plan).
Larger dimensions are joined by shuffle, where AQE can still switch to a
broadcast at run time from the actual sizes and split skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from txnguard.session import new_work_path


def materialize(df: DataFrame, label: str = "dim") -> DataFrame:
    """Write ``df`` once into the shared folder and read it back (lineage cut;
    executor loss later re-reads files instead of recomputing the plan)."""
    path = new_work_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def payload_bytes(df: DataFrame) -> Column:
    """Aggregate column: data bytes of ``df`` (string/binary lengths, JSON length of
    nested values, fixed widths for the rest, 16 bytes per row for headers)."""
    widths = {"int": 4, "date": 4, "float": 4, "smallint": 2, "tinyint": 1, "boolean": 1}
    row = F.lit(16)
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        c = F.col(f.name)
        if t in ("string", "binary"):
            row = row + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            row = row + F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))
        else:
            row = row + F.lit(16 if t.startswith("decimal") else widths.get(t, 8))
    return F.sum(row.cast("long"))


def sized_dimension(df: DataFrame, max_rows: int, materialize_first: bool = True,
                    max_bytes: int = 50 * 1024 * 1024) -> DataFrame:
    """Broadcast hint only with a proven size bound: at most ``max_rows`` rows and
    ``max_bytes`` data bytes, both from one aggregate over the materialized table."""
    if max_rows <= 0:
        return df
    if materialize_first:
        df = materialize(df)
    n, size = df.agg(F.count(F.lit(1)), payload_bytes(df)).first()
    return F.broadcast(df) if n <= max_rows and (size or 0) <= max_bytes else df
