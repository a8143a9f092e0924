"""Linking of sets by exact Jaccard similarity, from shared postings to components.

Candidates come from postings (key, node): two sets can only be linked if they share
a key. Groups of near copies would give a square number of pairs, so the search goes
in two rounds. First every node is held against the nodes that have the key of a list
earliest, having the fewest keys of their own, which gathers most of each group; then only pairs whose ends are not yet known
to be connected are tried, all of them. That loses no connection. All links within the
components, a square number in a group of near copies, are counted by degrees, block
against block, without a row for each pair.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamfold.llm.core import scratch, trimmed
from seamfold.llm.graph import components
from seamfold.llm.repeats import Filter

#: Sets that are held against one query set at a time.
BLOCK = 32
#: Sets, and bytes of sets, in a block of a component whose links are counted.
MANY, MANY_BYTES = 256, 1 << 22
#: Distinct keys that two blocks are held against each other by at a time.
WIDE = 2048
#: A key in this many sets counts as a long list.
LONG = 24
#: Sizes are banded by powers of this where sets meet.
STEP = 1.02
#: Bytes of sets that are decoded at a time.
SLICE = 1 << 18
#: DivideSkip's cost factor of a heap step against a binary probe.
MU = 0.01


def divide_skip(lists: list[list[int]], need: int) -> dict[int, int]:
    """Ids that stand in at least need of the sorted lists, with their counts.

    The longest lists are put aside, the others merged by a heap, where ids with too
    few hits are dropped; the rest is looked up in the long lists by binary search.
    """
    lists = sorted((x for x in lists if x), key=len)
    need = max(1, need)
    if len(lists) < need:
        return {}
    n_long = min(need - 1, int(need / (MU * math.log2(max(2, len(lists[-1]))) + 1)))
    short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
    heap = [(x[0], i) for i, x in enumerate(short)]
    heapq.heapify(heap)
    at = [0] * len(short)
    found: dict[int, int] = {}
    while heap:
        head, count = heap[0][0], 0
        while heap and heap[0][0] == head:
            i = heap[0][1]
            count += 1
            at[i] += 1
            if at[i] < len(short[i]):
                heapq.heapreplace(heap, (short[i][at[i]], i))
            else:
                heapq.heappop(heap)
        if count >= need - n_long:
            left = n_long
            for x in reversed(long):
                if count + left < need:
                    break
                k = bisect_left(x, head)
                count += k < len(x) and x[k] == head
                left -= 1
            if count >= need:
                found[head] = count
    return found


def search(query: np.ndarray, others: list[np.ndarray], num: int, den: int) -> dict[int, int]:
    """Which of the others (sorted, distinct keys) reach den*|both| >= num*|either|, with |both|."""
    n = len(query)
    fit = [j for j, y in enumerate(others) if den * len(y) >= num * n and den * n >= num * len(y)]
    if not n or not fit:
        return {}
    keys = np.concatenate([others[j] for j in fit])
    who = np.repeat(np.arange(len(fit)), [len(others[j]) for j in fit])
    place = np.searchsorted(query, keys)
    place[place == n] = 0
    hit = query[place] == keys
    place, who = place[hit], who[hit]
    order = np.lexsort((who, place))
    ids, ends = who[order].tolist(), np.cumsum(np.bincount(place, minlength=n)).tolist()
    lists = [ids[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True) if a < b]
    need = -(-num * n // den)  # |both| >= (num/den)*|either| >= (num/den)*n
    return {fit[j]: c for j, c in divide_skip(lists, need).items() if den * c >= num * (n + len(others[fit[j]]) - c)}


def count(query: np.ndarray, others: list[np.ndarray], num: int, den: int) -> dict[int, int]:
    """What search gives, by counting every shared key."""
    n, sizes = len(query), np.array([len(y) for y in others], np.int64)
    if not n or not len(sizes):
        return {}
    keys = np.concatenate(others)
    place = np.searchsorted(query, keys)
    place[place == n] = 0
    both = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[query[place] == keys], minlength=len(sizes))
    return {int(j): int(both[j]) for j in np.flatnonzero(den * both >= num * (n + sizes - both))}


def as_keys(blobs: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(blob, np.uint64) for blob in blobs]


def slices(blobs: list[bytes]) -> Iterator[tuple[int, int]]:
    """Bounds of runs of blobs that take SLICE bytes together, or one blob that takes more."""
    a = size = 0
    for i, blob in enumerate(blobs):
        if i > a and size + len(blob) > SLICE:
            yield a, i
            a, size = i, 0
        size += len(blob)
    if a < len(blobs):
        yield a, len(blobs)


def _searcher(num: int, den: int, decode: Callable[[list[bytes]], list[np.ndarray]], finder: Callable):
    names = ["a", "b", "both"]

    def run(batches: Iterator[pa.RecordBatch]):
        group, query, ids, sets = None, None, [], []

        def flush():
            got = finder(query, sets, num, den) if query is not None and ids else {}
            return pa.RecordBatch.from_arrays([pa.array([group[0]] * len(got), pa.int64()), pa.array([ids[j] for j in got], pa.int64()), pa.array(list(got.values()), pa.int64())], names=names)

        for batch in batches:
            x, s, role, node, blob = (batch.column(i).to_pylist() for i in range(5))
            for start, end in slices(blob):
                for i, keys in enumerate(decode(blob[start:end]), start):
                    if (x[i], s[i]) != group:
                        if ids:
                            yield flush()
                        group, query, ids, sets = (x[i], s[i]), None, [], []
                    if role[i] == 0:
                        query = keys
                    else:
                        ids.append(node[i])
                        sets.append(keys)
                        if len(ids) >= 2 * BLOCK:
                            yield flush()
                            ids, sets = [], []
        if ids:
            yield flush()

    return run


def verify(pairs: DataFrame, sets: DataFrame, num: int, den: int, decode: Callable[[list[bytes]], list[np.ndarray]] = as_keys, finder: Callable = search) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, as (a, b, both).

    pairs: distinct. sets: (node, keys), keys being what decode turns into sorted arrays.
    Partners of one a are dealt over as many groups as it takes, BLOCK to each.
    """
    load = pairs.groupBy("a").agg(F.count("*").alias("n"))
    dealt = pairs.join(load, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / F.lit(BLOCK))).alias("s"))
    others = dealt.join(sets.select(F.col("node").alias("b"), "keys"), "b").select("a", "s", F.lit(1).alias("role"), F.col("b").alias("node"), "keys")
    queries = dealt.select("a", "s").distinct().join(sets.select(F.col("node").alias("a"), "keys"), "a").select("a", "s", F.lit(0).alias("role"), F.col("a").alias("node"), "keys")
    rows = others.unionByName(queries).repartition("a", "s").sortWithinPartitions("a", "s", "role")
    return rows.mapInArrow(trimmed(_searcher(num, den, decode, finder)), "a long, b long, both long")


def rare_prefix(keys: np.ndarray, some: Filter, often: Filter, num: int, den: int, hashed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """The keys by which a set meets all similar ones, their places, and how many keys it has alone.

    The order is: keys that no other set has, keys that some have, keys that many have.
    Of the first n - ceil(t*n) + 1 keys, those of its own meet nothing and are left out.
    """
    hashed = keys if hashed is None else hashed
    shared = np.flatnonzero(some.contains(hashed))
    alone = len(keys) - len(shared)
    head = len(keys) + (-num * len(keys) // den) + 1
    if not len(keys) or alone >= head:
        return keys[:0], np.zeros(0, np.int64), alone
    rare = ~often.contains(hashed[shared])
    order = np.concatenate([shared[rare], shared[~rare]])[: head - alone]
    return keys[order], np.arange(alone, alone + len(order)), alone


def postings(outlines: DataFrame) -> DataFrame:
    """(key, node, n, pos) of (node, n, keys, places)."""
    return outlines.select("node", "n", F.explode(F.arrays_zip("keys", "places")).alias("k")).select(F.col("k.keys").alias("key"), "node", "n", F.col("k.places").alias("pos"))


def link(posts: DataFrame, load_sets: Callable[[DataFrame], DataFrame], num: int, den: int, decode: Callable[[list[bytes]], list[np.ndarray]] = as_keys, finder: Callable = search) -> tuple[DataFrame, DataFrame]:
    """Components and links of the sets whose postings are given.

    posts: (key, node, n, pos), one row for each node and key; n is the set's size and
    pos the key's place in it under an order that all sets share, rare keys first. Sets
    whose first shared key stands at places i and j have at most min(n-i, n-j) keys in
    common, and the smaller of two similar sets shares one of its first n - ceil(2t/(1+t)n)
    + 1 keys. load_sets takes the nodes (node) that are needed and returns (node,
    keys); finder is search or count.

    Returns (node, component) for linked nodes and the sets (node, keys) that were loaded,
    all linked ones among them.
    """
    lists = posts.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("key")
    shared = scratch(posts.join(lists, "key"), "shared")
    sets = scratch(load_sets(shared.select("node").distinct()), "sets")
    heads = shared.groupBy("key").agg(F.min(F.struct("pos", "node", "n")).alias("head"))
    most = lambda n, pos: F.floor((num + den) * (n - pos) / F.lit(num)) - n
    first = shared.join(heads, "key").where("node <> head.node").select("node", F.col("head.node").alias("first"), "n", F.col("head.n").alias("m"), most(F.col("n"), F.col("pos")).alias("to"), most(F.col("head.n"), F.col("head.pos")).alias("m_to"))
    viable = (F.col("m") <= F.col("to")) & (F.col("n") <= F.col("m_to")) & (den * F.least("n", "m") >= num * F.greatest("n", "m"))
    votes = first.groupBy("node", "first").agg(F.count("*").alias("votes"), F.max(viable).alias("viable")).where("viable").drop("viable")
    best = votes.groupBy("node").agg(F.slice(F.sort_array(F.collect_list(F.struct("votes", "first")), asc=False), 1, 3).alias("best"))
    stars = best.select(F.explode("best.first").alias("a"), F.col("node").alias("b"))
    near = scratch(verify(stars, sets, num, den, decode, finder), "near")

    home = shared.join(components(near), "node", "left").withColumn("component", F.coalesce("component", "node"))
    home = scratch(home.select("key", "node", "n", "pos", "component"), "home")
    mixed = home.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    left = home.join(mixed, "key")
    pairs = _in_reach(left, num, den)
    links = scratch(near.unionByName(verify(scratch(pairs, "pairs"), sets, num, den, decode, finder)), "links")
    return components(links), sets


def both_counts(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """How many keys each of xs has in common with each of ys."""
    out = np.zeros((len(xs), len(ys)), np.int64)
    _, key = np.unique(np.concatenate([*xs, *ys]), return_inverse=True)
    row = np.repeat(np.arange(len(xs) + len(ys)), [len(x) for x in (*xs, *ys)])
    some = np.bincount(key)[key] > 1
    _, key = np.unique(key[some], return_inverse=True)
    order = np.argsort(key, kind="stable")
    key, row = key[order], row[some][order]
    for low in range(0, int(key[-1]) + 1 if len(key) else 0, WIDE):
        a, b = np.searchsorted(key, (low, low + WIDE))
        held = np.zeros((len(xs) + len(ys), min(WIDE, int(key[-1]) + 1 - low)), np.float32)
        held[row[a:b], key[a:b] - low] = 1
        out += np.rint(held[: len(xs)] @ held[len(xs) :].T).astype(np.int64)
    return out


def few_counts(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """The same for a few sets, by binary search."""
    out = np.zeros((len(xs), len(ys)), np.int64)
    keys, size = np.concatenate(ys), [len(y) for y in ys]
    of = np.repeat(np.arange(len(ys)), size)
    for i, x in enumerate(xs):
        if len(x):
            place = np.searchsorted(x, keys)
            place[place == len(x)] = 0
            out[i] = np.bincount(of[x[place] == keys], minlength=len(ys))
    return out


def degrees(found: DataFrame, sets: DataFrame, num: int, den: int, decode: Callable[[list[bytes]], list[np.ndarray]] = as_keys) -> DataFrame:
    """(node, n_links): with how many other nodes of its component each node of found is similar enough.

    found: (node, component). Every pair of a component is compared, in blocks of about
    MANY sets or MANY_BYTES; a set is sent once for each block of its component.
    """
    held = found.join(sets, "node")
    size = held.groupBy("component").agg(F.greatest(F.ceil(F.count("*") / F.lit(MANY)), F.ceil(F.sum(F.octet_length("keys")) / F.lit(MANY_BYTES)), F.lit(1)).cast("int").alias("blocks"))
    dealt = held.join(size, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = dealt.select("component", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "keys").repartition("component", "lo", "hi").sortWithinPartitions("component", "lo", "hi", "block")

    def run(batches: Iterator[pa.RecordBatch]):
        group, block, nodes, blobs = None, [], [], []

        def flush():
            keys, second = decode(blobs), np.array(block) == group[2]
            size = np.array([len(k) for k in keys], np.int64)
            xs, ys = (np.flatnonzero(~second), np.flatnonzero(second)) if group[1] < group[2] else (np.arange(len(keys)), np.arange(len(keys)))
            n = np.zeros(len(keys), np.int64)
            if len(xs) and len(ys):
                both = both_counts([keys[i] for i in xs], [keys[i] for i in ys])
                hit = den * both >= num * (size[xs][:, None] + size[ys][None, :] - both)
                n[xs] += hit.sum(axis=1)
                if group[1] < group[2]:
                    n[ys] += hit.sum(axis=0)
                else:
                    n -= 1  # a set and itself
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(n)], names=["node", "n"])

        for batch in batches:
            for c, lo, hi, own, node, blob in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if (c, lo, hi) != group:
                    if nodes:
                        yield flush()
                    group, block, nodes, blobs = (c, lo, hi), [], [], []
                block.append(own)
                nodes.append(node)
                blobs.append(blob)
        if nodes:
            yield flush()

    return rows.mapInArrow(run, "node long, n long").groupBy("node").agg(F.sum("n").alias("n_links"))


def _in_reach(left: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) across components that sizes and places of their shared key allow.

    The smaller set x is held against the larger y, within bands of x's size.
    """
    left = left.withColumn("most", F.expr(f"{num + den} * (n - pos) div {num} - n"))
    band = lambda size: F.floor(F.log(size.cast("double")) / math.log(STEP)).cast("int")
    lowest, highest = F.expr(f"({num} * n + {den - 1}) div {den}"), F.least("n", "most")
    small = left.where(F.expr(f"pos <= n - (2 * {num} * n + {num + den - 1}) div {num + den}")).select("key", band(F.col("n")).alias("band"), F.col("component").alias("cx"), F.struct("node", "n", "most").alias("x"))
    large = left.where(lowest <= highest).select("key", F.explode(F.sequence(band(lowest), band(highest))).alias("band"), F.col("component").alias("cy"), F.struct("node", "n", "most").alias("y"))
    meet = small.select("key", "band", "cx").distinct().join(large.select("key", "band", "cy").distinct(), ["key", "band"]).where("cx <> cy")
    ordered = (F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.node") < F.col("y.node")))
    near_enough = (F.col("x.n") <= F.col("y.most")) & (F.col("y.n") <= F.col("x.most")) & (den * F.col("x.n") >= num * F.col("y.n"))
    return meet.join(small, ["key", "band", "cx"]).join(large, ["key", "band", "cy"]).where(ordered & near_enough).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
