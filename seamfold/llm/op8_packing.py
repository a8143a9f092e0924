"""Best-fit decreasing packing of token sequences, over classes of equal pieces.

Pieces of one length are interchangeable, so best-fit decreasing is run over the exact
length histogram (at most `room` counts) instead of over pieces: bins with the same room
left form intervals, a segment tree over the rooms finds the tightest one that fits, and
each step fills a whole interval. The outcome is that of placing pieces one by one. The
plan's size depends on the number of lengths only; pieces find their place in it by
their rank among those of their length, which is counted in parallel.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seamfold.llm.core import prepare, scratch, send
from seamfold.llm.tokens import encoder

ROOM = 1024
END = 2
#: Pieces of one length that are ranked together, about.
RANKED = 1_000_000


class RoomTree:
    """Which rooms 0..n have open bins; the least at or above a need in logarithmic time."""

    def __init__(self, n: int) -> None:
        self.base = 1 << n.bit_length()
        self.any = bytearray(2 * self.base)

    def set(self, room: int, full: bool) -> None:
        i = room + self.base
        self.any[i] = full
        while i > 1:
            i >>= 1
            self.any[i] = self.any[2 * i] | self.any[2 * i + 1]

    def tightest(self, need: int) -> int | None:
        i = need + self.base
        if not self.any[i]:
            while i > 1 and (i & 1 or not self.any[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.base:
                i = 2 * i if self.any[2 * i] else 2 * i + 1
        return i - self.base


@dataclass(frozen=True)
class Step:
    """Pieces of this length with ranks from..to: `each` to a bin, from bin `bin` at place `offset` on."""

    length: int
    first: int
    last: int
    each: int
    bin: int
    offset: int


def plan(histogram: dict[int, int], room: int = ROOM) -> tuple[list[Step], int]:
    """The steps of best-fit decreasing, and the number of bins."""
    tree, open_bins, steps, bins = RoomTree(room), {}, [], 0

    def leave(left: int, bin_: int, count: int) -> None:
        if left and count:
            open_bins.setdefault(left, []).append((bin_, count))
            tree.set(left, True)

    for length in sorted((x for x, n in histogram.items() if n), reverse=True):
        if not 0 < length <= room:
            raise ValueError(f"a piece of {length} does not fit into {room}")
        rank, count = 0, histogram[length]

        def fill(bin_: int, number: int, left: int) -> int:
            """Put what is to be put into so many bins with so much left; how many were touched."""
            nonlocal rank, count
            each = left // length
            whole = min(number, count // each)
            if whole:
                steps.append(Step(length, rank, rank + whole * each, each, bin_, room - left))
                leave(left - each * length, bin_, whole)
                rank, count = rank + whole * each, count - whole * each
            if whole < number and count:
                steps.append(Step(length, rank, rank + count, count, bin_ + whole, room - left))
                leave(left - count * length, bin_ + whole, 1)
                rank, count, whole = rank + count, 0, whole + 1
            return whole

        while count:
            left = tree.tightest(length)
            if left is None:
                bins += fill(bins, -(-count // (room // length)), room)
                continue
            bin_, number = open_bins[left].pop()
            if not open_bins[left]:
                tree.set(left, False)
            used = fill(bin_, number, left)
            leave(left, bin_ + used, number - used)
    return steps, bins


def pieces(docs: DataFrame, room: int = ROOM, end: int | None = END, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the token sequences of docs, cut only where longer than room.

    All pieces but the first are of length room. A null text counts as empty; with no
    end token an empty text has no piece. Repeated rows and null ids are cut like all others; no rows give none.
    """
    prepare(docs.sparkSession)

    def run(batches):
        encode = encoder(tokenizer).ids
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text)
                ids = ids if end is None else np.append(ids, np.array([end], "<u4"))
                head = len(ids) % room
                cuts = [0, *range(head or room, len(ids), room), len(ids)] if len(ids) else [0]
                raw = ids.tobytes()
                for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    for x, v in zip(out, (doc, i, a, b - a, zlib.crc32(raw[4 * a : 4 * b])), strict=True):
                        x.append(v)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, room: int = ROOM, end: int | None = END, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of docs.

    Every sequence is filled from 0 without gaps, to room at most. Repeated rows and
    null ids are packed like all others; other columns are ignored; no rows give none.
    """
    spark = prepare(docs.sparkSession)
    cut = scratch(pieces(docs, room, end, tokenizer, id_col, text_col), "pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most room rows
    parts = np.array([1 + histogram.get(n, 0) // RANKED for n in range(room + 1)])
    first = np.concatenate([[0], np.cumsum(parts)])
    own = F.get(F.array(*(F.lit(int(n)) for n in parts)), F.col("length").cast("int"))
    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), own).cast("int")
    counts = np.zeros(int(first[-1]), np.int64)
    for r in cut.groupBy("length", part.alias("part")).count().collect():  # a row for each RANKED pieces, and room more
        counts[first[r["length"]] + r["part"]] = r["count"]
    # how many pieces of a length the parts before one have
    before = np.cumsum(counts) - counts
    before -= np.repeat(before[first[:-1]], parts)
    steps, _ = plan(histogram, room)
    table = np.array([(s.length, s.first, s.last, s.each, s.bin, s.offset) for s in steps], np.int64).reshape(-1, 6)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    shared = send(spark, (before, first, table))
    ranked = cut.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")) - 1)

    def place(batches):
        before, first, table = shared.value
        for batch in batches:
            length, part, rank = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (3, 5, 6))
            rank = rank + before[first[length] + part]
            # steps of one length follow each other by rank: one search over (length, rank) pairs
            key = table[:, 0] << np.int64(44) | table[:, 1]
            s = table[np.searchsorted(key, length << np.int64(44) | rank, side="right") - 1]
            inside = rank - s[:, 1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(s[:, 4] + inside // s[:, 3]), pa.array(s[:, 5] + inside % s[:, 3] * length)], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
