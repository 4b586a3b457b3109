"""Connected components of an edge table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest reachable id of every id that has an edge
    in ``edges`` (a, b long). A large star hangs a node's larger neighbours on
    its smallest one, a small star its smaller ones; each pass is written to
    the checkpoint folder, and the driver gets a count and a digest only. The
    passes needed grow with the logarithm of the longest chain."""
    e = edges.where("a is not null and b is not null and a <> b")
    e = materialize(e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    last = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        large = materialize(large, "cc")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        e = materialize(small, "cc")
        now = e.agg(F.count("u"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == last:
            return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        last = now
