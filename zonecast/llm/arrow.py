"""Arrow and numpy helpers shared by the operators that run Python inside tasks.

All of them work on one Arrow batch (or a bounded block of one) at a time, so
the memory of a task follows the block size and its longest row, not the table.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64
#: Bytes of text that the numpy kernels hold at once.
BLOCK_BYTES = 1 << 21
_BASE = 0x9E3779B97F4A7C55
_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def reach(spark: SparkSession) -> None:
    """Puts this package's folder on the Python path of tasks, so that a local
    session finds it wherever the driver was started; a cluster gets the package
    with ``--py-files`` or on its machines."""
    env, top = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if top not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, top])


def map_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    """``mapInArrow`` with this package within reach of the tasks."""
    reach(df.sparkSession)
    return df.mapInArrow(work, schema)


def mix(z: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    z = z.astype(U64, copy=True)
    z ^= z >> U64(33)
    z *= U64(0xFF51AFD7ED558CCD)
    z ^= z >> U64(33)
    z *= U64(0xC4CEB9FE1A85EC53)
    z ^= z >> U64(33)
    return z


#: One random odd 64-bit value per byte.
BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(base^0..base^(n-1), their inverses) modulo 2^64."""
    have = _powers.get(0)
    if have is None or len(have[0]) < n:
        m = max(n, BLOCK_BYTES + 1)
        one = np.ones(m, dtype=U64)
        up, down = one.copy(), one
        up[1:] = U64(_BASE)
        down[1:] = U64(_INV)
        have = (np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64))
        if m <= 4 * BLOCK_BYTES:
            _powers[0] = have
    return have[0][:n], have[1][:n]


class Prefix:
    """Prefix polynomial hashes of a byte block: any substring hashes in O(1)."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=U64)
        np.cumsum(BYTE_VALUE[data] * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        """Hashes of data[start:start+length]; equal strings have equal hashes."""
        return (self.sums[start + length] - self.sums[start]) * self.down[start]


def binary_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.fill_null("")
    else:
        column = column.fill_null(b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offs


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets from 0) of runs of whole rows of
    at most ``limit`` bytes; a longer row is a block of its own."""
    raw, offs = binary_parts(column)
    lo, n = 0, len(column)
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each lower-cased word, words before each row) of a block; words
    are runs without \\x20 and \\x09-\\x0D, only A-Z are lower-cased."""
    if not len(data):
        return np.zeros(0, U64), np.zeros(len(offs), np.int64)
    solid = ~_SPACE[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offs] = True  # a word ends where its row ends
    start = solid.copy()
    start[1:] &= ~solid[:-1] | first[1:-1]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | first[1:-1]
    at = np.flatnonzero(start)
    length = np.flatnonzero(end) + 1 - at
    hashes = mix(Prefix(_LOWER[data]).of(at, length) + length.astype(U64) * U64(0xD6E8FEB86659FD93))
    return hashes, np.searchsorted(at, offs)


def runs(batches: Iterator[pa.RecordBatch], key: str, most: int | None = None) -> Iterator[pa.Table]:
    """The rows of each key, one table a key, from batches sorted by the key.

    Holds one key's rows at a time (callers bound those by splitting keys)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if held and keys[lo] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = keys[lo]
    if held:
        yield pa.Table.from_batches(held)
