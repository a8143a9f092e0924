"""Quality classifier: naive Bayes features in a linear support vector machine.

Documents are sets of hashed n-grams (words, word pairs, runs of four bytes). Class
log-count ratios come from all labelled rows; each indicator is scaled by its ratio, the
vector to unit length, and a hinge-loss model is fitted by dual coordinate descent on a
bounded, hash-drawn sample of them, a fifth of which turns margins into probabilities.
The fit runs in one task, whose rows and slots are both bounded; the driver gets weights.
"""

from __future__ import annotations

import binascii

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamfold.llm.core import mix, prepare, send, trimmed, word_hashes

BITS = 18
SLOTS = 1 << BITS
#: Labelled rows that the support vector machine is fitted on, at most about.
FIT_ROWS = 12_000
#: Slots (4 bytes each) of these rows together, at most about.
FIT_SLOTS = 30_000_000
#: Labels that are broadcast; beyond, documents and labels are joined by a shuffle.
BROADCAST_LABELS = 2_000_000
_PARTS = 64


def held_out(id_col: str | Column, folds: int) -> Column:
    """Whether crc32 of the id as text is divisible by folds."""
    return F.pmod(F.crc32(F.col(id_col).cast("string") if isinstance(id_col, str) else id_col), F.lit(folds)) == 0


class Features:
    """Distinct feature slots of a text."""

    def __init__(self) -> None:
        self.stamp = np.zeros(SLOTS, np.int64)
        self.clock = 0

    def __call__(self, text: str | None) -> np.ndarray:
        raw = (text or "").encode()
        words = word_hashes(raw.lower().split())
        b = np.frombuffer(raw, np.uint8).astype(np.uint64)
        four = b[:-3] | b[1:-2] << np.uint64(8) | b[2:-1] << np.uint64(16) | b[3:] << np.uint64(24) if len(b) > 3 else b[:0]
        pairs = words[:-1] * np.uint64(3) + words[1:] if len(words) > 1 else words[:0]
        keys = np.concatenate([words, mix(pairs), mix(four + np.uint64(1 << 40))])
        slots = (keys >> np.uint64(64 - BITS)).astype(np.int64)
        marks = self.clock + np.arange(len(slots))
        self.clock += len(slots)
        self.stamp[slots] = marks
        return slots[self.stamp[slots] == marks]


def dual_coordinate_descent(rows: list[np.ndarray], ratio: np.ndarray, y: np.ndarray, c: np.ndarray, epochs: int = 12, seed: int = 7) -> np.ndarray:
    """Weights, the bias last, of min |w|^2/2 + sum c_i * max(0, 1 - y_i w.x_i).

    Row i is given by its slots; x_i holds their ratios, scaled to length 1, and a 1.
    """
    w, alpha = np.zeros(len(ratio) + 1), np.zeros(len(y))
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in order.permutation(len(y)):
            v = ratio[rows[i]]
            length = max(1e-12, float(v @ v)) ** 0.5
            g = y[i] * (float(w[rows[i]] @ v) / length + w[-1]) - 1
            new = min(max(alpha[i] - g / (float(v @ v) / length**2 + 1), 0.0), c[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[rows[i]] += step / length * v
                w[-1] += step
                worst = max(worst, abs(new - alpha[i]))
                alpha[i] = new
        if worst < 1e-3:
            break
    return w


def platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """a, b of P(1) = 1 / (1 + exp(-(a * margin + b))), by Newton steps."""
    pos, neg = float((y > 0).sum()), float((y < 0).sum())
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x, theta = np.stack([margin, np.ones_like(margin)], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), x.T @ (p - t) + 1e-3 * theta)
        theta -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


class Model:
    """ratio: the log-count ratios. Without labels of both classes, a constant."""

    def __init__(self, ratio=None, weight=None, a: float = 0.0, b: float = 0.0) -> None:
        self.ratio, self.weight, self.a, self.b = ratio, weight, a, b
        self.product = None if ratio is None else ratio * weight[:-1]
        self.square = None if ratio is None else ratio * ratio

    def margin(self, slots: np.ndarray) -> float:
        return float(self.product[slots].sum() / max(1e-12, float(self.square[slots].sum())) ** 0.5 + self.weight[-1])

    def score(self, slots: np.ndarray) -> float:
        z = self.b + (0.0 if self.ratio is None else self.a * self.margin(slots))
        return float(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, fit_rows: int = FIT_ROWS, fit_slots: int = FIT_SLOTS) -> Model:
    """Learn from the labelled rows that are not held out.

    Labels other than 0 and 1 and null ids are left aside; of several labels of one id
    the largest holds. Counts cover all such rows, repeated ones each time; the vector machine is fitted on
    a sample of them of about fit_rows rows and fit_slots slots at most, drawn by id. Null
    and empty texts are rows without features. An empty table, or one class only, gives a
    constant model.
    """
    spark = prepare(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where(f"label in (0, 1) and doc_id is not null").where(~held_out("doc_id", folds)).groupBy("doc_id").agg(F.max("label").alias("label"))
    n_known = known.count()
    if n_known <= BROADCAST_LABELS:
        known = F.broadcast(known)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(known, "doc_id")
    width = SLOTS // _PARTS

    def count(batches):
        features, counts, n = Features(), np.zeros((2, SLOTS), np.int32), np.zeros(2, np.int64)
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[y][features(text)] += 1
                n[y] += 1
        if n.any():
            parts = [counts[:, i * width : (i + 1) * width].tobytes() for i in range(_PARTS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(_PARTS), pa.int32()), pa.array(parts, pa.binary()), pa.array([int(n[0])] * _PARTS, pa.int64()), pa.array([int(n[1])] * _PARTS, pa.int64())], names=["part", "counts", "n0", "n1"])

    def total(table: pa.Table) -> pa.Table:
        counts = sum(np.frombuffer(x.as_py(), np.int32).astype(np.int64) for x in table["counts"])
        return pa.table({"part": pa.array([table["part"][0].as_py()], pa.int32()), "counts": pa.array([counts.tobytes()], pa.binary()), "n0": pa.array([sum(table["n0"].to_pylist())], pa.int64()), "n1": pa.array([sum(table["n1"].to_pylist())], pa.int64())})

    ddl = "part int, counts binary, n0 long, n1 long"
    parts = sorted(rows.select("text", "label").mapInArrow(trimmed(count), ddl).groupBy("part").applyInArrow(total, ddl).collect())  # _PARTS rows
    if not parts or not parts[0]["n0"] or not parts[0]["n1"]:
        one = bool(parts) and parts[0]["n1"] > 0
        return Model(b=0.0 if not parts else 4.0 if one else -4.0)
    counts = np.concatenate([np.frombuffer(bytes(p["counts"]), np.int64).reshape(2, width) for p in parts], axis=1) + 1.0
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())

    rows_known, slots_known = parts[0]["n0"] + parts[0]["n1"], float(counts.sum() - counts.size)
    share = min(1.0, fit_rows / rows_known, fit_slots / max(1.0, slots_known))
    drawn = rows.where(F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))

    def take(batches):
        features = Features()
        for batch in batches:
            slots = [features(t).astype(np.int32).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(slots, pa.binary())], names=["doc_id", "label", "slots"])

    shared = send(spark, ratio)

    def train(sample: pa.Table) -> pa.Table:
        model = learn(sample.sort_by("doc_id"), shared.value)
        return pa.table({"weight": pa.array([model.weight.tobytes()], pa.binary()), "a": [model.a], "b": [model.b]})

    sample = drawn.select("doc_id", "text", "label").mapInArrow(trimmed(take), "doc_id long, label int, slots binary")
    fitted = sample.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(train, "weight binary, a double, b double").first()
    if fitted is None:  # no row was drawn
        return Model(b=0.0)
    return Model(ratio, np.frombuffer(bytes(fitted["weight"])), fitted["a"], fitted["b"])


def learn(sample: pa.Table, ratio: np.ndarray) -> Model:
    """The model of a sample (doc_id, label, slots): four fifths for its weights, one fifth for its probabilities."""
    slots = [np.frombuffer(x.as_buffer(), np.int32) for x in sample["slots"]]
    ys = np.where(sample["label"].to_numpy() > 0, 1.0, -1.0)
    calibrate = np.array([binascii.crc32(b"c%d" % d) % 5 == 0 for d in sample["doc_id"].to_pylist()], bool)
    own = np.flatnonzero(~calibrate)
    balance = {s: len(own) / (2 * max(1, int((ys[own] == s).sum()))) for s in (-1.0, 1.0)}
    weight = dual_coordinate_descent([slots[i] for i in own], ratio, ys[own], np.array([balance[y] for y in ys[own]]))
    model = Model(ratio, weight)
    model.a, model.b = platt(np.array([model.margin(slots[i]) for i in np.flatnonzero(calibrate)]), ys[calibrate])
    return model


def score(docs: DataFrame, model: Model, folds: int = 5, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs.

    Null and empty texts are scored too, as texts without features. A null id counts
    as not held out. Repeated rows keep their rows; no rows give none. Other columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    shared = send(spark, model)

    def run(batches):
        features, m = Features(), shared.value
        for batch in batches:
            values = [m.score(features(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out("doc_id", folds), F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of docs that the model fitted on them does not reject; the columns stay."""
    spark = prepare(docs.sparkSession)
    shared = send(spark, fit(docs, labels))
    names, at = docs.columns, docs.columns.index("text")

    def run(batches):
        features, m = Features(), shared.value
        for batch in batches:
            keep = [m.score(features(t)) >= threshold for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema).select(*names)
