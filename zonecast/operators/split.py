"""Chronological train/test split (E9) and the simulation bin.

The reference sorts the whole table by time and cuts at row int(0.8 N).
Here: rows per bin, a blocked running count (``scans.running_sum``), and a
row number inside each bin (ties by zone_id) give every row its global
position without a global sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scans import running_sum


def chronological_split(df: DataFrame, frac: float = 0.8, time_col: str = "time_bin",
                        tie_col: str = "zone_id") -> DataFrame:
    """Adds ``row_idx`` (0-based position in (time, tie) order) and
    ``split`` ('train' for the first int(frac * N) rows, else 'test')."""
    per_bin = df.groupBy(time_col).agg(F.count(F.lit(1)).alias("__n"))
    per_bin = running_sum(per_bin, time_col, "__n", "__before", inclusive=False)
    total = per_bin.agg(F.sum("__n")).scalar()
    cut = (F.lit(frac) * total).cast("long")
    w = Window.partitionBy(time_col).orderBy(tie_col)
    d = df.join(per_bin.select(time_col, "__before"), time_col)
    d = d.withColumn("row_idx", F.col("__before") + F.row_number().over(w) - 1)
    return (d.withColumn("split", F.when(F.col("row_idx") < cut, F.lit("train")).otherwise(F.lit("test")))
            .drop("__before"))


def bin_counts(df: DataFrame, time_col: str = "time_bin") -> DataFrame:
    """(time bin, rows): one row a bin, what the simulation bin is taken from."""
    return df.groupBy(time_col).agg(F.count(F.lit(1)).alias("rows"))


def first_test_bin(counts: DataFrame, frac: float = 0.8, time_col: str = "time_bin") -> Column:
    """Scalar subquery over ``bin_counts``: the time bin of row int(frac * N), i.e.
    the first bin of the chronological test slice (the reference's simulation bin)."""
    upto = running_sum(counts, time_col, "rows", "__upto", inclusive=True)
    total = counts.agg(F.sum("rows")).scalar()
    cut = (F.lit(frac) * total).cast("long")
    return upto.where(F.col("__upto") > cut).agg(F.min(time_col)).scalar()
