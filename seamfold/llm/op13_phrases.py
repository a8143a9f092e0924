"""Phrase mining: contiguous patterns that grow to the right from frequent prefixes.

1. Words are counted by language; their 64-bit hashes are checked to tell all words of the
   corpus apart, and taken anew under another seed if they don't.
2. Pairs of frequent words that stand side by side are counted, by hash.
3. Every occurrence of a frequent pair is a pointer; what it points to, the words from there
   on as far as each next pair is frequent, is its projection. Equal projections are added
   up in their task, then sent to the prefix's (the first two words') partition and sorted.
4. Each prefix is extended to the right depth first: sorted projections are its tree of
   extensions in that order, so that a partition holds no more than a path and one batch.
5. Joins of the phrases with their parts give scores, of which each language's best stay.

Filters of frequent words and pairs are broadcast; they have a fixed size and no false
negatives, and what passes them wrongly is found out by its count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seamfold.llm.core import as_long, mix, prepare, scratch, send, trimmed
from seamfold.llm.repeats import members, may_hold
from seamfold.llm.scan import Scanner

# fixed values: what parts pieces of text, and what parts words
PIECES, SPACES = b".,;:!?\n\x0b\x0c\r", b" \t"
UNKNOWN = "und"
#: Distinct words, pairs or projections that a task holds before it sends them on.
FLUSH = 3 << 19
#: Counts of phrases and words that are broadcast to be joined; more are joined by shuffles.
BROADCAST_COUNTS = 1_000_000
#: Shares of a language that each rank their best before the language does.
SALTS = 32
_MIX = np.uint64(0xD6E8FEB86659FD93)


def key_of(columns: list[np.ndarray]) -> np.ndarray:
    """One 64-bit number for rows of several."""
    out = columns[0]
    for c in columns[1:]:
        out = mix(out * _MIX + c)
    return out


def distinct(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal rows added up; the list of columns is sorted in place. Different rows of one key may stay apart from equal ones; their counts are still right in sum."""
    order = np.argsort(key_of(columns), kind="stable")
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in range(len(columns)):
        columns[k] = columns[k][order]
        new[1:] |= columns[k][1:] != columns[k][:-1]
    first = np.flatnonzero(new)
    return [c[first] for c in columns], np.add.reduceat(n[order], first) if len(first) else n[:0]


class Sums:
    """Rows of numbers with counts, added up before they are sent on."""

    def __init__(self, names: list[str]) -> None:
        self.names, self.held, self.size = names, [], 0

    def add(self, columns: list[np.ndarray]) -> None:
        columns, n = distinct(columns, np.ones(len(columns[0]), np.int64))
        self.held.append((columns, n))
        self.size += len(n)

    def flush(self, least: int):
        if self.size < max(1, least):
            return
        held, self.held, self.size = self.held, [], 0
        columns, n = [np.concatenate(c) for c in zip(*(h[0] for h in held), strict=True)], np.concatenate([h[1] for h in held])
        held.clear()
        columns, n = distinct(columns, n)
        for a in range(0, len(n), 1 << 16):
            yield pa.RecordBatch.from_arrays([*(pa.array(as_long(c[a : a + (1 << 16)])) for c in columns), pa.array(n[a : a + (1 << 16)])], names=[*self.names, "n"])


def _words(scanner: Scanner, batch: pa.RecordBatch):
    """For some documents at a time, their words, the words' hashes and the documents' languages."""
    langs = batch.column(1).to_pylist()
    salts = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in langs], np.uint64)
    for words in scanner.chunks(batch.column(0)):
        yield words, words.hashes(salts[words.first + words.doc]), langs


def count_words(docs: DataFrame, seed: int) -> DataFrame:
    """(h, lang, word, n) of (text, lang): every word of each language with its hash and its count."""
    def run(batches):
        scanner, held, size = Scanner(SPACES, PIECES, seed=seed), [], 0

        def flush():
            h = np.concatenate([x[0] for x in held])
            hs, first, place = np.unique(h, return_index=True, return_inverse=True)
            n = np.bincount(place, np.concatenate([x[1] for x in held])).astype(np.int64)
            langs, words = [y for x in held for y in x[2]], [y for x in held for y in x[3]]
            for a in range(0, len(hs), 1 << 16):
                at = first[a : a + (1 << 16)].tolist()
                yield pa.RecordBatch.from_arrays([pa.array(as_long(hs[a : a + (1 << 16)])), pa.array([langs[i] for i in at], pa.string()), pa.array([words[i] for i in at], pa.binary()), pa.array(n[a : a + (1 << 16)])], names=["h", "lang", "word", "n"])

        for batch in batches:
            for words, h, langs in _words(scanner, batch):
                hs, first, n = np.unique(h, return_index=True, return_counts=True)
                held.append((hs, n, [langs[words.first + d] for d in words.doc[first].tolist()], words.spelled(first)))
                size += len(hs)
                if size >= FLUSH // 4:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    # dealt by hash, which serves both the count here and the check for words that share one
    parts = docs.select("text", "lang").mapInArrow(trimmed(run), "h long, lang string, word binary, n long").repartition("h")
    return parts.groupBy("h", "lang", "word").agg(F.sum("n").alias("n"))


def _sides(scanner: Scanner, batch: pa.RecordBatch, frequent):
    """The hashes of words, and where a frequent word has a frequent one beside it."""
    for words, h, _ in _words(scanner, batch):
        hs, place = np.unique(h, return_inverse=True)
        ok = may_hold(frequent, as_long(hs))[place]
        beside = words.beside
        beside[:-1] &= ok[:-1] & ok[1:]
        yield h, beside


def grow(most: int, least: int):
    """From projections (h1..hmost, n), sorted and with their prefixes whole in a partition, all phrases that occur often enough.

    Shorter projections have zeros behind. Each batch is extended to the right one word at
    a time; the last phrase of each length may go on in the next batch and is carried there.
    """

    def run(batches):
        open_: dict[int, tuple[tuple, int]] = {}

        def closed(found):
            found = [(w, n) for w, n in found if n >= least]
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in found], pa.list_(pa.int64())), pa.array([n for _, n in found], pa.int64())], names=["w", "n"])

        for batch in batches:
            columns, n = [batch.column(k).to_numpy() for k in range(most)], batch.column(most).to_numpy()
            if not len(n):
                continue
            new, found = np.zeros(len(n), bool), []
            new[0] = True
            new[1:] = columns[0][1:] != columns[0][:-1]
            for k in range(1, most):
                new[1:] |= columns[k][1:] != columns[k][:-1]
                first = np.flatnonzero(new)
                first_of, total = [c[first] for c in columns[: k + 1]], np.add.reduceat(n, first)
                grown = np.flatnonzero(first_of[k] != 0)  # projections that end before have no phrase of this length
                if not len(grown):
                    continue
                # whether the first and the last of them are whole is not known yet
                edge = np.isin(np.arange(len(grown)), (0, len(grown) - 1))
                grown = grown[edge | (total[grown] >= least)]
                runs = list(zip(zip(*(c[grown].tolist() for c in first_of), strict=True), total[grown].tolist(), strict=True))
                if k in open_:
                    key, before = open_[k]
                    if runs[0][0] == key:
                        runs[0] = (key, runs[0][1] + before)
                    else:
                        found.append(open_[k])
                found += runs[:-1]
                open_[k] = runs[-1]
            yield closed(found)
        yield closed(open_.values())

    return run


def frequent_phrases(docs: DataFrame, most: int, least: int) -> tuple[DataFrame, DataFrame]:
    """((h, lang, word, n) of all words; (w, n) of phrases of 2 to most words that occur least times, w being hashes) of (text, lang)."""
    spark, seed = docs.sparkSession, 0
    while True:
        words = scratch(count_words(docs, seed), "words")
        if not words.groupBy("h").count().where("count > 1").limit(1).count():
            break
        seed += 1
    frequent = send(spark, members(words.where(F.col("n") >= least).select("h"), "h"))

    def pairs(batches):
        scanner, sums = Scanner(SPACES, PIECES, seed=seed), Sums(["a", "b"])
        for batch in batches:
            for h, beside in _sides(scanner, batch, frequent.value):
                at = np.flatnonzero(beside)
                sums.add([h[at], h[at + 1]])
                yield from sums.flush(FLUSH)
        yield from sums.flush(1)

    text = docs.select("text", "lang")
    both = text.mapInArrow(trimmed(pairs), "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).where(F.col("n") >= least)

    def keyed(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(as_long(key_of([batch.column(k).to_numpy().view(np.uint64) for k in (0, 1)])))], names=["k"])

    linked = send(spark, members(scratch(both.select("a", "b").mapInArrow(keyed, "k long").distinct(), "pairs"), "k"))
    names = [f"h{k}" for k in range(most)]

    def project(batches):
        scanner, sums = Scanner(SPACES, PIECES, seed=seed), Sums(names)
        for batch in batches:
            for h, beside in _sides(scanner, batch, frequent.value):
                at = np.flatnonzero(beside)
                ks, place = np.unique(key_of([h[at], h[at + 1]]), return_inverse=True)
                go = np.zeros(len(h), bool)
                go[at] = may_hold(linked.value, as_long(ks))[place]
                at = np.flatnonzero(go)
                columns, on = [h[at]], np.ones(len(at), bool)
                for k in range(1, most):
                    on &= go[np.minimum(at + k - 1, len(h) - 1)]
                    columns.append(np.where(on, h[np.minimum(at + k, len(h) - 1)], np.uint64(0)))
                sums.add(columns)
                yield from sums.flush(FLUSH)
        yield from sums.flush(1)

    projected = text.mapInArrow(trimmed(project), ", ".join(f"{x} long" for x in names) + ", n long").repartition("h0", "h1")
    sorted_ = projected.groupBy(*names).agg(F.sum("n").alias("n")).sortWithinPartitions(*names)
    return words, scratch(sorted_.mapInArrow(trimmed(grow(most, least)), "w array<long>, n long"), "phrases")


def phrases(docs: DataFrame, least: int = 10, most: int = 3, inside: int = 50, top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 to most words.

    Null and empty texts have no words and count for nothing; null languages are "und". A and the
    counts of parts cover every row, repeated ones each time, and no phrase spans two pieces or
    rows. Ties are broken by count, then by the bytes of the phrase, so that ranks are unique. No
    candidates, as in an empty table, give no rows. Other columns are ignored. Words may be
    of any length. Products are exact up to counts of 10**15.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"))
    words, found = frequent_phrases(docs, most, least)
    common = words.where(F.col("n") >= least)
    counts = found.where(F.size("w") < most).unionByName(common.select(F.array("h").alias("w"), "n"))
    few = counts.count() <= BROADCAST_COUNTS
    near = F.broadcast if few else (lambda df: df)

    # how often a phrase is at most part of a longer one
    cut = [F.slice("w", i, k) for k in range(2, most) for i in range(1, most - k + 2)]
    within = found.where(F.size("w") > 2).select("n", F.explode(F.array_distinct(F.filter(F.array(*cut), lambda x: F.size(x) < F.size("w")))).alias("w"))
    held = within.groupBy("w").agg(F.max("n").alias("longer"))
    kept = found.join(held, "w", "left").where(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("n"))).select("w", F.col("n").alias("a"))

    cuts = kept.select("w", "a", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.select("w", "a", "k", F.slice("w", F.lit(1), F.col("k")).alias("first"), F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")).alias("rest"))
    cuts = cuts.join(near(counts.select(F.col("w").alias("first"), F.col("n").alias("l"))), "first").join(near(counts.select(F.col("w").alias("rest"), F.col("n").alias("r"))), "rest")
    big = lambda c: f"cast({c} as decimal(38, 0))"
    cuts = cuts.withColumn("score", F.expr(f"({big('a')} * {big('a')} * 1000000) div ({big('l')} * {big('r')})"))
    scored = cuts.groupBy("w", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x")).select("w", "a", "x.score", "x.l", "x.r")
    spoken = near(common.select(F.col("h").alias("h0"), "lang")) if few else common.select(F.col("h").alias("h0"), "lang")
    scored = scored.withColumn("h0", F.element_at("w", 1)).join(spoken, "h0")

    # ranks that ties share keep all that may be among the best; the rest need not be spelled
    by = [F.desc("score"), F.desc("a")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("w"), F.lit(SALTS))).orderBy(*by)
    best = scored.withColumn("rank", F.rank().over(salted)).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.rank().over(Window.partitionBy("lang").orderBy(*by))).where(F.col("rank") <= top).drop("rank")
    best = scratch(best, "best")
    spelled = best.select("w", F.posexplode("w").alias("i", "h")).join(common.select("h", "word"), "h")
    text = spelled.groupBy("w").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", F.col("word").cast("string").alias("word")))), lambda x: x.word), " ").alias("phrase"))
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    ranked = best.join(text, "w").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by, "phrase"))).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
