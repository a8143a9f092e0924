"""Which 64-bit keys of a corpus occur more than once, as a compact filter.

Tasks send sorted 32-bit remainders by bucket (4 bytes a key, few rows), reducers
count equal ones, and each bucket answers with a small Bloom segment. The filter has
no false negatives; false positives only cost work, since everything that passes is
checked exactly afterwards.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from seamfold.llm.core import mix, trim, trimmed

#: Keys that a task holds before it sends them on.
FLUSH = 1 << 20
_ODD = (np.uint64(0x9E3779B1), np.uint64(0x85EBCA77), np.uint64(0xC2B2AE3D))
_LOW32 = np.uint64(0xFFFFFFFF)


class Filter:
    """Bloom segments, one for each bucket of keys."""

    def __init__(self, bits: int, shift: np.ndarray, offset: np.ndarray, data: np.ndarray) -> None:
        self.bits, self.shift, self.offset, self.data = bits, shift, offset, data

    def contains(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), bool)
        if not len(keys) or not len(self.data):
            return out
        bucket = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        rest = (keys >> np.uint64(32 - self.bits)) & _LOW32
        at = np.flatnonzero(self.shift[bucket] < 64)
        for odd in _ODD:
            b, r = bucket[at], rest[at]
            slot = self.offset[b] + ((((r * odd) & _LOW32) ^ (r >> np.uint64(15))) >> self.shift[b])
            hit = (self.data[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1
            at = at[hit.astype(bool)]
        out[at] = True
        return out


def _segment(keys: np.ndarray, most: int) -> tuple[int, bytes]:
    """log2 of its bits, and the bits; 16 bits a key up to 2**most."""
    if not len(keys):
        return -1, b""
    size = min(max(6, math.ceil(math.log2(16 * len(keys)))), most, 32)
    flags = np.zeros(1 << size, bool)
    for odd in _ODD:
        flags[((((keys * odd) & _LOW32) ^ (keys >> np.uint64(15))) >> np.uint64(32 - size)).astype(np.int64)] = True
    return size, np.packbits(flags, bitorder="little").tobytes()


def repeated(df: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], levels: tuple[int, ...] = (2,), total_bits: int = 28) -> list[Filter]:
    """For each level, a filter of the keys that occur at least so often.

    keys_of yields key arrays for a batch (distinct within a document, as a rule).
    A filter takes at most 2**total_bits bits, whatever the input; beyond some
    16 million repeated keys it passes more keys, never fewer.
    """
    spark = df.sparkSession
    bits = max(10, math.ceil(math.log2(4 * int(spark.conf.get("spark.sql.shuffle.partitions")))))
    schema = pa.schema([("bucket", pa.int32()), ("rest", pa.binary())])

    def send(batches):
        held, size = [], 0

        def flush():
            keys = np.sort(np.concatenate(held))
            # a key that is held more often than any level asks for counts as much with fewer
            most = max(levels)
            keys = keys[np.concatenate([np.ones(min(most, len(keys)), bool), keys[most:] != keys[:-most]])]
            ends = np.searchsorted(keys, (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)))
            cuts = np.concatenate([[0], ends, [len(keys)]])
            rest = ((keys >> np.uint64(32 - bits)) & _LOW32).astype(np.uint32)
            full = np.flatnonzero(np.diff(cuts))
            return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array([rest[cuts[b] : cuts[b + 1]].tobytes() for b in full], pa.binary())], schema=schema)

        for batch in batches:
            for keys in keys_of(batch):
                held.append(keys)
                size += len(keys)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    out = pa.schema([("bucket", pa.int32()), *((f"size{i}", pa.int32()) for i in range(len(levels))), *((f"data{i}", pa.binary()) for i in range(len(levels)))])

    def count(table: pa.Table) -> pa.Table:
        rest = np.sort(np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table["rest"]]))
        first = np.flatnonzero(np.concatenate([[True], rest[1:] != rest[:-1]]))
        times = np.diff(np.concatenate([first, [len(rest)]]))
        made = [_segment(rest[first[times >= n]].astype(np.uint64), total_bits - bits) for n in levels]
        return pa.Table.from_pydict({"bucket": [table["bucket"][0].as_py()]} | {f"size{i}": [m[0]] for i, m in enumerate(made)} | {f"data{i}": [m[1]] for i, m in enumerate(made)}, schema=out)

    ddl = lambda s: ", ".join(f"{f.name} {'int' if pa.types.is_integer(f.type) else 'binary'}" for f in s)
    # at most 2**bits rows and 2**total_bits bits a level
    rows = df.mapInArrow(trimmed(send), ddl(schema)).groupBy("bucket").applyInArrow(count, ddl(out)).collect()
    filters = []
    for i in range(len(levels)):
        shift, offset = np.full(1 << bits, 64, np.uint64), np.zeros(1 << bits, np.uint64)
        data, at = [], 0
        for r in rows:
            if (size := r[f"size{i}"]) >= 0:
                shift[r["bucket"]], offset[r["bucket"]] = 32 - size, at
                data.append(np.frombuffer(bytes(r[f"data{i}"]), np.uint8))
                at += 1 << size
        filters.append(Filter(bits, shift, offset, np.concatenate(data) if data else np.zeros(0, np.uint8)))
    # the segments are many small pieces, which the driver's allocator would keep
    data = rows = None
    trim()
    return filters


def members(df: DataFrame, column: str, total_bits: int = 28) -> Filter:
    """A filter of the values of a long column of distinct values."""
    def keys(batch):
        yield mix(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))

    return repeated(df.select(column).where(f"{column} is not null"), keys, (1,), total_bits)[0]


def may_hold(f: Filter, values: np.ndarray) -> np.ndarray:
    return f.contains(mix(np.asarray(values, np.int64).view(np.uint64)))
