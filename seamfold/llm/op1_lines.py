"""Fuzzy line dedup: MinHash over character shingles, one line kept of each component.

A line's shingles are all runs of SHINGLE characters of its text, lower-cased and with
white space collapsed. Signatures take ROWS * BANDS minima: long lines use one hash
whose range is cut into that many bins (empty bins borrow from their right), short
lines independent hashes, and lines near the limit both; what counts is how many distinct
shingles a line has, so that similar lines always share a scheme.

Lines with an equal band are a bucket, and buckets with the same first line are a unit.
First each line is held against the first lines of its most frequent buckets, which joins
most of each group of copies. Units that still hold several components are then searched
within: their lines come to one task, or in blocks to several if they are many, and lines
of different components are compared by their exact numbers of shared shingles; only
links that join components leave the task. No pair of lines that share a band and are not
yet connected is left out, and no such pair is ever a row.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seamfold.llm.core import as_long, drop, mix, prepare, scratch, send, trimmed
from seamfold.llm.graph import UnionFind, components
from seamfold.llm.repeats import repeated
from seamfold.llm.setjoin import both_counts, count, few_counts, verify

SHINGLE = 8
#: A pair at similarity 0.8 is missed with probability (1 - 0.8**5)**16 = 0.0017.
ROWS, BANDS = 5, 16
#: Fewer distinct shingles than this: independent hashes; at least LONG_FROM: one binned hash.
SHORT_TO, LONG_FROM = 120, 96
#: Characters whose shingles are hashed at a time.
PIECE = 1 << 17
#: First lines of buckets that a line is held against before units are searched.
HEADS = 3
#: Lines of a block of a unit, and bytes of the lines that are decoded together.
MANY, DECODE = 400, 1 << 18
#: Pairs up to which a unit's lines are compared one by one.
FEW = 64

_P = np.uint64(0x100000001B3)
_K = ROWS * BANDS
_SEEDS = mix(np.arange(1, _K + 1, dtype=np.uint64)) | np.uint64(1)


def normal(line: str) -> str:
    return " ".join(line.lower().split())


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of non-empty lines, one line after the other, and how many each has."""
    pad = "\0" * (SHINGLE - 1)
    codes = np.frombuffer((pad.join(lines) + pad).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    count = np.maximum(size - SHINGLE + 1, 1)
    h, step = codes + np.uint64(1), 1
    while step < SHINGLE:
        h = h[:-step] * np.uint64(pow(int(_P), step, 1 << 64)) + h[step:]
        step *= 2
    start = np.concatenate([[0], np.cumsum(size + SHINGLE - 1)[:-1]])
    inside = np.zeros(len(codes) + 1, np.int8)
    np.add.at(inside, start, 1)
    np.add.at(inside, start + count, -1)
    return mix(h[np.cumsum(inside[: len(h)]).astype(bool)]), count


def shingle_sets(lines: list[str]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of non-empty lines."""
    if not lines:
        return []
    h, count = shingle_hashes(lines)
    out = []
    for s in np.split(h, np.cumsum(count)[:-1]):
        s.sort()
        out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
    return out


def shingle_set(line: str) -> np.ndarray:
    return shingle_sets([line])[0]


def _decode(blobs: list[bytes]) -> list[np.ndarray]:
    return shingle_sets([blob.decode("utf-8", "surrogatepass") for blob in blobs])


def _distinct(h: np.ndarray, count: np.ndarray) -> np.ndarray:
    """How many distinct shingles each line has, for lines that have LONG_FROM or more; of others, all are counted."""
    out = count.copy()
    long = count >= LONG_FROM
    if long.any():
        own = np.repeat(long, count)
        line = np.repeat(np.arange(len(count), dtype=np.uint64), count)[own]
        # 44 bits of a hash tell a line's shingles apart; all lines are sorted at once
        key = np.sort(line << np.uint64(44) | h[own] >> np.uint64(20))
        new = np.concatenate([[True], key[1:] != key[:-1]])
        out[long] = np.bincount((key[new] >> np.uint64(44)).astype(np.int64), minlength=len(count))[long]
    return out


def _binned(h: np.ndarray, count: np.ndarray) -> np.ndarray:
    sig = np.full(len(count) * _K, np.uint64(0xFFFFFFFFFFFFFFFF))
    place = ((h >> np.uint64(32)) * np.uint64(_K)) >> np.uint64(32)
    np.minimum.at(sig, np.repeat(np.arange(len(count)) * _K, count) + place.astype(np.int64), h * _SEEDS[0])
    sig = sig.reshape(-1, _K)
    twice = np.concatenate([sig, sig], axis=1)
    at = np.where(twice != np.uint64(0xFFFFFFFFFFFFFFFF), np.arange(2 * _K), 4 * _K)
    source = np.minimum.accumulate(at[:, ::-1], axis=1)[:, ::-1][:, :_K]
    far = (source - np.arange(_K)).astype(np.uint64)
    return mix(np.take_along_axis(twice, np.minimum(source, 2 * _K - 1), axis=1) + far)


def _independent(h: np.ndarray, count: np.ndarray) -> np.ndarray:
    starts = np.concatenate([[0], np.cumsum(count)[:-1]])
    out = np.empty((len(count), _K), np.uint64)
    high, x, y = h >> np.uint64(27), np.empty_like(h), np.empty_like(h)
    for i, s in enumerate(_SEEDS):
        np.bitwise_xor(np.multiply(h, s, out=x), np.multiply(high, s, out=y), out=x)
        out[:, i] = np.minimum.reduceat(x, starts)
    return out


def _bands(sig: np.ndarray, scheme: int) -> np.ndarray:
    """(lines, BANDS) keys."""
    sig = sig.reshape(len(sig), BANDS, ROWS)
    key = np.broadcast_to((np.arange(BANDS, dtype=np.uint64) + np.uint64(1 + 1000 * scheme)), sig.shape[:2]).copy()
    for r in range(ROWS):
        key = mix(key * _P + sig[:, :, r])
    return key


def band_keys(lines: list[str]) -> list[np.ndarray]:
    """Band keys of each non-empty normalized line."""
    out: list[np.ndarray] = []
    a = 0
    while a < len(lines):
        b, n = a, 0
        while b < len(lines) and (b == a or n + len(lines[b]) <= PIECE):
            n += len(lines[b])
            b += 1
        h, count = shingle_hashes(lines[a:b])
        keys: list[list] = [[] for _ in range(b - a)]
        size = _distinct(h, count)
        for scheme, pick, sign in ((0, size <= SHORT_TO, _independent), (1, size >= LONG_FROM, _binned)):
            if pick.any():
                own = np.repeat(pick, count) if not pick.all() else slice(None)
                for i, k in zip(np.flatnonzero(pick).tolist(), _bands(sign(h[own], count[pick]), scheme), strict=True):
                    keys[i].append(k)
        out += [np.concatenate(k) if len(k) > 1 else k[0] for k in keys]
        a = b
    return out


def _codes(line: str) -> tuple[int, int]:
    """The two halves of a 128-bit hash."""
    return struct.unpack("<qq", xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass")))


def _signed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines (doc_id, row, line, n_chars, node, check) of docs, and (node, check, keys, text) of those that share a band with another.

    node and check together tell lines apart; of lines with one node, one is searched.
    """
    spark = prepare(docs.sparkSession)

    def sign(batches):
        names = ["doc_id", "row", "line", "n_chars", "node", "check", "keys", "text"]
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            doc, rows, place, lines, codes = [], [], [], [], []
            for d, r, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for i, line in enumerate((text or "").split("\n")):
                    if line := normal(line):
                        doc.append(d)
                        rows.append(r)
                        place.append(i)
                        lines.append(line)
                        codes.append(_codes(line))
            # a line that this task has signed already needs no second signature
            new = [i for i, c in enumerate(codes) if not (c in seen or seen.add(c))]
            keys: list = [None] * len(lines)
            texts: list = [None] * len(lines)
            for i, k in zip(new, band_keys([lines[i] for i in new]), strict=True):
                keys[i] = as_long(k)
                texts[i] = lines[i].encode("utf-8", "surrogatepass")
            if len(seen) > 1_000_000:
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(rows, pa.int64()), pa.array(place, pa.int32()), pa.array([len(x) for x in lines], pa.int64()), *(pa.array([c[i] for c in codes], pa.int64()) for i in (0, 1)), pa.array(keys, pa.list_(pa.int64())), pa.array(texts, pa.binary())], names=names)

    signed = scratch(docs.mapInArrow(trimmed(sign), "doc_id long, row long, line int, n_chars long, node long, check long, keys array<long>, text binary"), "signed")

    def keys_of(batch):
        yield batch.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64)

    some = send(spark, repeated(signed.where("keys is not null").select("keys"), keys_of)[0])

    def shared(batches):
        for batch in batches:
            column = batch.column(2)
            keys = column.flatten().to_numpy(zero_copy_only=False)
            size = np.diff(column.offsets.to_numpy())
            hit = some.value.contains(keys.view(np.uint64))
            n = np.bincount(np.repeat(np.arange(len(size)), size)[hit], minlength=len(size)) if len(size) else size
            held = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(keys[hit]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), held, batch.column(3)], names=["node", "check", "keys", "text"]).filter(pa.array(n > 0))

    lines = scratch(signed.select("doc_id", "row", "line", "n_chars", "node", "check"), "lines")
    sharing = scratch(signed.where("keys is not null").select("node", "check", "keys", "text").mapInArrow(shared, "node long, check long, keys array<long>, text binary").dropDuplicates(["node"]), "sharing")
    drop(signed)
    return lines, sharing


def _search(num: int, den: int):
    """Links (a, b) between components, of rows (head, lo, hi, block, component, text) that come unit by unit."""

    def links(component: np.ndarray, block: np.ndarray, sets: list[np.ndarray], pair: tuple[int, int]):
        """Of one unit, or of two of its blocks."""
        kinds, at = np.unique(component, return_inverse=True)
        if len(kinds) < 2:
            return
        # lines of the largest component need not be held against each other
        most = np.bincount(at).argmax()
        second = block == pair[1] if pair[0] < pair[1] else np.ones(len(at), bool)
        first = block == pair[0]
        size = np.array([len(s) for s in sets], np.int64)
        uf = UnionFind()
        for xs, ys in ((np.flatnonzero(first & (at != most)), np.flatnonzero(second)), (np.flatnonzero(first & (at == most)), np.flatnonzero(second & (at != most))) if pair[0] < pair[1] else ((), ())):
            if not len(xs) or not len(ys):
                continue
            both = (both_counts if len(xs) * len(ys) > FEW else few_counts)([sets[i] for i in xs], [sets[i] for i in ys])
            near = (den * both >= num * (size[xs][:, None] + size[ys][None, :] - both)) & (at[xs][:, None] != at[ys][None, :])
            for i, j in zip(*np.nonzero(near), strict=True):
                a, b = int(component[xs[i]]), int(component[ys[j]])
                if uf.union(a, b):
                    yield a, b

    def run(batches):
        held: list[tuple] = []
        size = 0

        def flush():
            sets = _decode([r[5] for r in held])
            out: list[tuple[int, int]] = []
            a = 0
            for b in range(1, len(held) + 1):
                if b == len(held) or held[b][:3] != held[a][:3]:
                    out += links(np.array([r[4] for r in held[a:b]]), np.array([r[3] for r in held[a:b]]), sets[a:b], held[a][1:3])
                    a = b
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], names=["a", "b"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= DECODE and row[:3] != held[-1][:3]:
                    yield flush()
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield flush()

    return run


def _linked(sharing: DataFrame, num: int, den: int) -> DataFrame:
    """(node, component) of the lines that are linked to any other."""
    posts = sharing.select("node", F.explode("keys").alias("key"))
    heads = posts.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("high")).where("head < high").select("key", "head")
    votes = posts.join(heads, "key").where("node <> head").groupBy("node", "head").agg(F.count("*").alias("votes"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("votes"), "head"))
    units = scratch(votes.select("node", "head", (rank <= HEADS).alias("tried")), "units")
    texts = sharing.select("node", F.col("text").alias("keys"))
    near = scratch(components(verify(units.where("tried").select(F.col("head").alias("a"), F.col("node").alias("b")), texts, num, den, _decode, count)), "near")

    own = units.select("head", F.col("head").alias("node"), F.lit(True).alias("tried")).distinct()
    home = scratch(units.select("head", "node", "tried").unionByName(own).join(near, "node", "left").select("head", "node", "tried", F.coalesce("component", "node").alias("component")), "home")
    mixed = home.groupBy("head").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("n"), F.bool_and("tried").alias("all_tried")).where("least < most and (n > 2 or not all_tried)")
    left = home.join(mixed.select("head", F.ceil(F.col("n") / MANY).cast("int").alias("blocks")), "head").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("head", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "component", "node")
    rows = left.join(sharing.select("node", "text"), "node").select("head", "lo", "hi", "block", "component", "text").repartition("head", "lo", "hi").sortWithinPartitions("head", "lo", "hi")
    joined = components(rows.mapInArrow(trimmed(_search(num, den)), "a long, b long"))
    near = near.unionByName(joined.select("node", F.col("node").alias("component")).join(near.select("node"), "node", "left_anti"))
    further = joined.select(F.col("node").alias("component"), F.col("component").alias("whole"))
    return near.join(further, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))


def _components(docs: DataFrame, num: int, den: int) -> DataFrame:
    """What line_components returns, and row, which tells texts with equal ids apart."""
    lines, sharing = _signed(docs.select("doc_id", F.xxhash64("text").alias("row"), "text"))
    found = _linked(sharing, num, den).join(sharing.select("node", "check"), "node")
    firsts = lines.groupBy("node", "check").agg(F.min(F.struct("doc_id", "line")).alias("first"))
    placed = scratch(found.join(firsts, ["node", "check"]), "placed")
    owner = placed.groupBy("component").agg(F.min("first").alias("keep"))
    moved = placed.join(owner, "component").select("node", "check", "keep")
    whole = firsts.join(moved, ["node", "check"], "left").select("node", "check", F.coalesce("keep", "first").alias("keep"))
    out = lines.join(whole, ["node", "check"]).select("doc_id", "row", "line", "n_chars", F.col("keep.doc_id").alias("keep_doc"), F.col("keep.line").alias("keep_line"))
    return out.withColumn("kept", (F.col("doc_id") == F.col("keep_doc")) & (F.col("line") == F.col("keep_line")))


def line_components(docs: DataFrame, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line, n_chars, keep_doc, keep_line, kept) for each line of docs that is not blank.

    Lines are what newline characters part, counted from 0. (keep_doc, keep_line) is
    the first line, by document and place, of the component that den * |both| >= num *
    |either| over character shingles links it to; kept tells whether that is itself.
    n_chars counts the normalized characters. Lines that are equal once normalized are
    linked; a line shorter than a shingle is one shingle. Null or empty texts and blank
    lines give no rows, nor do rows with a null id; no rows give none. Rows that repeat an id share their
    place numbers: of them, all lines at a component's first place that belong to it are kept. Other columns are
    ignored. Lines are told apart by a 128-bit hash. The search for near lines goes by 64
    bits of it: should two different lines share those, only one of them is held near to others.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    return _components(docs, num, den).drop("row")


def drop_lines(docs: DataFrame, num: int = 80, den: int = 100) -> DataFrame:
    """docs without the lines that are not kept; the columns stay, n_chars is counted anew.

    Documents that lose every line that is not blank go; all others stay, null and
    empty texts and rows with a null id unchanged. Rows that repeat an id lose their own
    lines only. Columns may have any names.
    """
    gone = _components(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null"), num, den)
    gone = gone.where("not kept").groupBy(F.col("doc_id").alias("d"), F.col("row").alias("r")).agg(F.collect_set("line").alias("gone"))
    held = docs.select(F.struct("*").alias("x"), F.col("doc_id").cast("long").alias("d"), F.xxhash64(F.col("text").cast("string")).alias("r"))
    lines = F.split("x.text", "\n")
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "gone"), lambda i: F.get(lines, i))
    out = held.join(gone, ["d", "r"], "left").withColumn("kept", F.when(F.col("gone").isNull() | F.col("x.text").isNull(), F.col("x.text")).otherwise(F.array_join(left, "\n")))
    out = out.where("gone is null or x.text is null or trim(translate(kept, '\\n\\r\\t', '')) <> ''")
    new = lambda c: F.col("kept") if c == "text" else F.length("kept").cast("long") if c == "n_chars" else F.col(f"x.`{c}`")
    return out.select(*(new(c).alias(c) for c in docs.columns))
