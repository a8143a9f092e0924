"""Vector codes: every vector's parts as indices into small codebooks that two rounds fit.

A ball tree over the entries of each part position finds the nearest entry: a part first
goes down to the leaf whose centres are nearest, then every ball that may still hold an
entry at the same distance or nearer is visited. All numbers are integers: centres are
rounded down, radii up, distances to centres down, and what is compared in the end are
exact squared distances. Tasks send sums and counts by entry, so that a round moves as
many numbers a task as the codebooks hold, however the vectors are spread.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamfold.llm.core import prepare, scratch, send, trimmed

#: Entries of a leaf.
LEAF = 8
#: Labels whose errors are broadcast; beyond, they are joined by a shuffle.
BROADCAST_LABELS = 1_000_000
_LONG = 1 << 63
_root = np.frompyfunc(math.isqrt, 1, 1)


def floor_root(x: np.ndarray) -> np.ndarray:
    """Square roots of integers, rounded down exactly."""
    if x.dtype == object:
        return _root(x)
    r = np.sqrt(x.astype(np.float64)).astype(np.int64)
    r -= r * r > x
    return r + ((r + 1) * (r + 1) <= x)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances along the last axis."""
    d = a - b
    return (d * d).sum(axis=-1)


class BallTree:
    """Over the rows of an integer matrix, of 64-bit or of Python integers."""

    def __init__(self, entries: np.ndarray, leaf: int = LEAF) -> None:
        self.entries, self.leaf = entries, leaf
        self.nodes: list[tuple] = []  # (centre, radius, left, right, members)
        self._grow(np.arange(len(entries)))

    def _grow(self, members: np.ndarray) -> int:
        own = self.entries[members]
        centre = np.array([sum(c) // len(c) for c in own.T.tolist()], self.entries.dtype)
        far = max(squares(own, centre).tolist())
        at = len(self.nodes)
        self.nodes.append(())
        left = right = -1
        if len(members) > self.leaf:
            axis = int(np.argmax([max(c) - min(c) for c in own.T.tolist()]))
            order = members[np.argsort(own[:, axis], kind="stable")]
            left, right = self._grow(np.sort(order[: len(order) // 2])), self._grow(np.sort(order[len(order) // 2 :]))
        self.nodes[at] = (centre, math.isqrt(far - 1) + 1 if far else 0, left, right, members)
        return at

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of each point's nearest entry, the lowest of several, and its squared distance."""
        index, best, home = np.zeros(len(points), np.int64), np.zeros(len(points), self.entries.dtype), np.zeros(len(points), np.int64)

        def measure(at: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            d = squares(points[at][:, None, :], self.entries[members][None, :, :])
            k = np.argmin(d, axis=1)
            return members[k], d[np.arange(len(at)), k]

        def descend(node: int, at: np.ndarray) -> None:
            _, _, left, right, members = self.nodes[node]
            if not len(at):
                return
            if left < 0:
                index[at], best[at] = measure(at, members)
                home[at] = node
                return
            nearer = (squares(points[at], self.nodes[left][0]) <= squares(points[at], self.nodes[right][0])).astype(bool)
            descend(left, at[nearer])
            descend(right, at[~nearer])

        def visit(node: int, at: np.ndarray) -> None:
            centre, radius, left, right, members = self.nodes[node]
            least = np.maximum(floor_root(squares(points[at], centre)) - radius, 0)
            at = at[(least * least <= best[at]).astype(bool)]  # as near counts: a lower index may be in there
            if not len(at):
                return
            if left >= 0:
                visit(left, at)
                visit(right, at)
                return
            at = at[home[at] != node]
            if len(at):
                k, d = measure(at, members)
                won = ((d < best[at]) | ((d == best[at]) & (k < index[at]))).astype(bool)
                index[at[won]], best[at[won]] = k[won], d[won]

        everyone = np.arange(len(points))
        descend(0, everyone)
        visit(0, everyone)
        return index, best


def whole(x: np.ndarray, scale: int, wide: bool) -> np.ndarray:
    """floor(scale * x), scale a power of two; exact."""
    if not wide:
        return np.floor(x * scale).astype(np.int64)
    return np.array([int(v) * scale if abs(v) >= 1e15 else math.floor(v * scale) for v in x.ravel().tolist()], object).reshape(x.shape)


def _usable(vector: Column, parts: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & (F.size(vector) % parts == 0) & finite


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) for every vector that is kept.

    Rows whose vector is null, empty or of a length that parts do not divide, or holds null
    or non-finite components, are dropped, and so are vectors of another length than that
    of the first one by id. Ids order the rows that codebooks begin with, null ids last, rows of one id by
    their vectors; repeated rows count each. With fewer rows than entries the codebooks have
    as many entries as there are rows; without rows the result is empty. Components of any
    size are computed with exactly (large ones as Python integers); an error that no 64-bit
    integer can hold is null, and then so is that of its label. Null labels count as one label.
    Other columns are ignored. entries: 256 at most; scale: a power of two.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hexadecimal digits a part: 1 to 256 entries")
    spark = prepare(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).alias("label"))
    rows = rows.where(_usable(F.col("v"), parts))
    out = f"vec_id long, code string, error long, label {dict(rows.dtypes)['label']}"
    order = [F.asc_nulls_last("vec_id"), "v"]
    first = rows.orderBy(*order).limit(1).collect()
    if not first:
        none = spark.createDataFrame([], out)
        return none.select("vec_id", "code", "error", F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    size = len(first[0].v)
    rows = rows.where(F.size("v") == size)
    start = np.array([r.v for r in rows.orderBy(*order).limit(entries).collect()])
    largest = rows.agg(F.max(F.greatest(F.array_max("v"), -F.array_min("v")))).first()[0]
    # every product and sum of a row stays below 2**62, or Python's integers are used
    wide = largest * scale + 1 >= math.isqrt((1 << 60) // size)
    books = list(whole(start, scale, wide).reshape(len(start), parts, -1).transpose(1, 0, 2))  # a matrix a part
    width = size // parts

    def points(batch: pa.RecordBatch, k: int) -> np.ndarray:
        x = batch.column(k)
        return whole(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), size), scale, wide).reshape(len(x), parts, width)

    def assign(trees: list[BallTree], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = [t.nearest(x[:, p, :]) for p, t in enumerate(trees)]
        return np.stack([f[0] for f in found], axis=1), sum(f[1] for f in found)

    def sums(shared):
        def run(batches):
            trees = [BallTree(b) for b in shared.value]
            total, n = np.zeros((parts * entries, width), object if wide else np.int64), np.zeros(parts * entries, np.int64)
            for batch in batches:
                x = points(batch, 0)
                slot = (assign(trees, x)[0] + np.arange(parts) * entries).ravel()
                np.add.at(total, slot, x.reshape(-1, width))
                n += np.bincount(slot, minlength=len(n))
            used = np.flatnonzero(n)
            if len(used):
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array([list(map(str, t)) for t in total[used].tolist()], pa.list_(pa.string())), pa.array(n[used])], names=["slot", "total", "n"])

        return run

    def add(table: pa.Table) -> pa.Table:
        total = [str(sum(int(t[k]) for t in table["total"].to_pylist())) for k in range(width)]
        return pa.table({"slot": table["slot"][:1], "total": pa.array([total], pa.list_(pa.string())), "n": pa.array([sum(table["n"].to_pylist())], pa.int64())})

    for _ in range(rounds):
        partial = rows.select("v").mapInArrow(trimmed(sums(send(spark, books))), "slot long, total array<string>, n long")
        if wide:
            found = partial.groupBy("slot").applyInArrow(add, "slot long, total array<string>, n long")
        else:
            each = partial.select("slot", "n", F.posexplode("total").alias("k", "t")).groupBy("slot", "k").agg(F.sum(F.col("t").cast("decimal(38,0)")).alias("t"), F.sum("n").alias("n"))
            found = each.groupBy("slot").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "t"))), lambda x: x.t.cast("string")).alias("total"), F.max("n").alias("n"))
        books = [b.copy() for b in books]
        for r in found.collect():  # a row an entry
            books[r.slot // entries][r.slot % entries] = [int(t) // r.n for t in r.total]

    def code(shared):
        def run(batches):
            trees = [BallTree(b) for b in shared.value]
            for batch in batches:
                if not batch.num_rows:
                    continue
                index, error = assign(trees, points(batch, 1))
                digits = index.astype(np.uint8).tobytes().hex()
                codes = [digits[i : i + 2 * parts] for i in range(0, len(digits), 2 * parts)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes), pa.array([e if e < _LONG else None for e in error.tolist()], pa.int64()), batch.column(2)], names=["vec_id", "code", "error", "label"])

        return run

    coded = scratch(rows.select("vec_id", "v", "label").mapInArrow(trimmed(code(send(spark, books))), out), "codes")
    exact = F.when(F.count("*") == F.count("error"), F.sum(F.col("error").cast("decimal(38,0)"))).try_cast("long")
    totals = coded.groupBy(F.col("label").alias("__label")).agg(exact.alias("label_error"))
    if totals.count() <= BROADCAST_LABELS:
        totals = F.broadcast(totals)
    digest = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()
    joined = coded.join(totals, F.col("label").eqNullSafe(F.col("__label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
