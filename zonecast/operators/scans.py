"""Ordered scans over time without a single-partition window on fine rows.

A running total over a time-ordered table is a prefix scan. Done with one unpartitioned window it pulls every row into one task.
Here it is two-level, as a distributed prefix scan is usually built:

1. inside each coarse block (a day by default) a window partitioned by the
   block does the local scan;
2. one row per block goes through the global window (a year is 365 rows);
3. a join on the block adds the block's carry-in to every row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY_SECONDS = 86400


def _block(time_col: str, block_seconds: int) -> Column:
    return F.window(F.col(time_col), f"{block_seconds} seconds").start


def running_sum(df: DataFrame, time_col: str, value_col: str, out_col: str,
                tie_cols: Sequence[str] = (), block_seconds: int = DAY_SECONDS,
                inclusive: bool = True) -> DataFrame:
    """``out_col`` = sum of ``value_col`` over rows ordered by (time, ties),
    up to and including (``inclusive``) or strictly before the current row."""
    order = [F.col(time_col)] + [F.col(c) for c in tie_cols]
    d = df.withColumn("__blk", _block(time_col, block_seconds))
    end = Window.currentRow if inclusive else -1
    w_in = Window.partitionBy("__blk").orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    d = d.withColumn("__in", F.coalesce(F.sum(value_col).over(w_in), F.lit(0)))
    blocks = d.groupBy("__blk").agg(F.sum(value_col).alias("__bt"))
    w_blk = Window.orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("__blk", F.coalesce(F.sum("__bt").over(w_blk), F.lit(0)).alias("__off"))
    return (d.join(blocks, "__blk")
            .withColumn(out_col, F.col("__in") + F.col("__off"))
            .drop("__blk", "__in", "__off"))


def time_spine(bounds: DataFrame, start_col: str, end_col: str, step_seconds: int,
               keys: Sequence[str] = (), out_col: str = "ts", chunk: int = 2048,
               parts: int | None = None) -> DataFrame:
    """Every ``step_seconds`` mark from start to end (inclusive) per row of
    ``bounds`` (one row per key). Two-level ``explode(sequence)``: chunk
    descriptors are spread over ``parts`` tasks (the shuffle partitions when
    not given) before the marks are made, so no task generates a whole history."""
    from ..functions.timefn import add_seconds
    span = (F.col(end_col) - F.col(start_col)).cast("long")   # zone-free seconds
    n = F.floor(span / step_seconds) + 1
    chunks = bounds.select(*keys, F.col(start_col).alias("__start"), n.alias("__n"),
                           F.explode(F.sequence(F.lit(0).cast("long"),
                                                F.floor((n - 1) / chunk))).alias("__c"))
    chunks = chunks.repartition(parts, *keys, "__c") if parts else chunks.repartition(*keys, "__c")
    lo = F.col("__c") * chunk
    hi = F.least(lo + (chunk - 1), F.col("__n") - 1)
    idx = chunks.select(*keys, "__start", F.explode(F.sequence(lo, hi)).alias("__i"))
    return idx.select(*keys, add_seconds(F.col("__start"), F.col("__i") * step_seconds).alias(out_col))


def with_row_id(df: DataFrame, out_col: str = "row_id", start: int = 1) -> DataFrame:
    """Consecutive ids start..start+N-1 in the input's own order
    (partition by partition, rows in scan order), as ``RDD.zipWithIndex``:
    one pass counts the rows of each partition (one row per partition), a
    running offset over those counts, then each row adds its position in
    its partition. No sort, no single-task step. The input must have a
    stable layout (a file scan or a written table), as for zipWithIndex.
    """
    pos = F.monotonically_increasing_id()          # (partition id << 33) + position
    d = df.withColumns({"__pid": F.spark_partition_id(), "__pos": pos})
    counts = d.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)   # one row per partition
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    local = F.col("__pos") - F.shiftleft(F.col("__pid").cast("long"), 33)
    return (d.join(F.broadcast(offsets), "__pid")
            .withColumn(out_col, F.col("__off") + local + F.lit(start))
            .drop("__pid", "__pos", "__off"))
