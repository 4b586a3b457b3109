"""Table scans, sinks and path guards."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Ride-log timestamp layout (pandas writes 'YYYY-MM-DD HH:MM:SS'); microseconds optional.
CSV_TS_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"

def _is_local(path: str) -> bool:
    return "://" not in path or path.startswith("file://")


def _local(path: str) -> str:
    return path[len("file://"):] if path.startswith("file://") else path


def require_path(path: str) -> str:
    """Missing-input guard (A5): fail at plan-build time with a clear error.

    Remote URIs are left to the scan, which raises on a missing path.
    """
    if _is_local(path) and not os.path.exists(_local(path)):
        raise FileNotFoundError(f"input {path} does not exist")
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    if _is_local(path):
        return os.path.exists(_local(path))
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)  # an error is an error


def table_version(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """(files, bytes, latest change) of a table's files, a file or a folder of part
    files: what a memo of results made from the table is keyed by."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = p.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(p, True)
    count = size = latest = 0
    while files.hasNext():
        f = files.next()
        count, size, latest = count + 1, size + f.getLen(), max(latest, f.getModificationTime())
    return count, size, latest


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table; parquet gives pushdown and pruning for free."""
    return spark.read.parquet(require_path(table_path(sf_dir, name)))


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """Sink (A3, A4). With ``partition_by`` an overwrite only replaces the
    partitions present in ``df`` (dynamic partition overwrite)."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True).option("timestampNTZFormat", CSV_TS_FORMAT)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.save(path)


def build_if_absent(spark: SparkSession, path: str, build: Callable[[], DataFrame],
                    fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Create a table only if it is missing, then read it.

    Write mode ``ignore`` makes two racing builders harmless.
    """
    if not path_exists(spark, path):
        write_table(build(), path, fmt=fmt, partition_by=partition_by, mode="ignore")
    return spark.read.format(fmt).load(path)
