"""Substring dedup: words that an earlier document already has, by suffix automata.

0. Documents whose whole text an earlier document has are set aside by digest.
1. A filter finds the word windows whose hash occurs more than once in the corpus.
2. Each document sends its runs of such windows, cut where the window's minimizer (the
   least hash of its 6-word grams) changes, so that equal windows meet under one
   minimizer whatever stands around them. Equal runs are merged before the shuffle.
3. Each minimizer's distinct runs are a reference shard. They are streamed through the
   shard's suffix automaton in the order of their first documents: matching statistics
   tell where a whole window is matched, the automaton's state which document had it
   first, and a run enters the automaton only if it has a window that is not there.
4. Runs with an earlier owner are sent back to their documents, which drop the words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamfold.llm.core import ngrams, prepare, scratch, send, word_hashes
from seamfold.llm.repeats import may_hold, members, repeated

#: Exact copies whose marks are broadcast; beyond, they are parted from the rest by a shuffle.
BROADCAST_COPIES = 2_000_000
#: Words of the grams that minimizers are taken from.
GRAM = 6


class SuffixAutomaton:
    """Of token sequences that come in ascending order of their labels.

    owner[state] is the label of the first sequence that has the state's strings: a new
    state's strings are new with it, a split state's strings came with the old state.
    """

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.owner: list = [None]

    def _state(self, length: int, edges: dict, link: int, owner) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.owner.append(owner)
        return len(self.next) - 1

    def _split(self, p: int, token, q: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q], self.owner[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = clone
            p = self.link[p]
        return clone

    def add(self, tokens: list, label) -> None:
        last = 0
        for token in tokens:
            q = self.next[last].get(token)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, token, q)
                continue
            new, p = self._state(self.length[last] + 1, {}, 0, label), last
            while p >= 0 and token not in self.next[p]:
                self.next[p][token] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][token]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, token, q)
            last = new

    def owners(self, tokens: list, window: int) -> list:
        """For each window of tokens: the label of the first sequence that has it, or None."""
        out, state, matched = [], 0, 0
        for i, token in enumerate(tokens):
            while state and token not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if token in self.next[state]:
                state = self.next[state][token]
                matched += 1
            if i >= window - 1:
                if matched < window:
                    out.append(None)
                    continue
                while self.length[self.link[state]] >= window:
                    state = self.link[state]
                    matched = self.length[state]
                out.append(self.owner[state])
        return out


def _minimizers(h: np.ndarray, window: int) -> np.ndarray:
    """For each window of word hashes, the least hash of its grams."""
    gram = min(GRAM, window)
    g = ngrams(h, gram)
    return np.lib.stride_tricks.sliding_window_view(g, window - gram + 1).min(axis=1)


def _spans(flags: np.ndarray, cut: np.ndarray) -> Iterator[tuple[int, int]]:
    """[start, end) of the runs of set flags, also cut where cut changes."""
    at = np.flatnonzero(flags)
    if len(at):
        breaks = np.flatnonzero((np.diff(at) > 1) | (cut[at[1:]] != cut[at[:-1]])) + 1
        yield from zip(at[np.concatenate([[0], breaks])].tolist(), (at[np.concatenate([breaks - 1, [len(at) - 1]])] + 1).tolist(), strict=True)


def repeated_windows(docs: DataFrame, window: int = 13) -> DataFrame:
    """(mark, doc_id, spots): starts of the windows that a document with a smaller id has.

    docs: (doc_id, text, mark), mark telling rows of one id with different texts apart.
    """
    spark = prepare(docs.sparkSession)

    def all_windows(batch):
        for text in batch.column(1).to_pylist():
            words = (text or "").encode().split()
            if len(words) >= window:
                yield ngrams(word_hashes(words), window)

    some = send(spark, repeated(docs, all_windows)[0])

    def runs(batches):
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for doc, text, mark in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = (text or "").encode().split()
                if doc is None or len(words) < window:
                    continue
                h = word_hashes(words)
                hit = some.value.contains(ngrams(h, window))
                if hit.any():
                    least = _minimizers(h, window)
                    for a, b in _spans(hit, least):
                        run = b" ".join(words[a : b + window - 1])
                        for x, v in zip(out, (doc, mark, a, int(least[a].view(np.int64)), _signed(xxhash.xxh3_64_intdigest(run)), run), strict=True):
                            x.append(v)
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in out[:5]), pa.array(out[5], pa.binary())], names=["doc_id", "mark", "start", "shard", "code", "words"])

    sent = scratch(docs.mapInArrow(runs, "doc_id long, mark long, start long, shard long, code long, words binary"), "runs")
    contents = sent.groupBy("shard", "words").agg(F.min("doc_id").alias("first"))

    def match(batches):
        """Runs come shard by shard, by first document within; only unseen windows enlarge the automaton."""
        shard, sam, held, out = None, None, None, [[], [], []]

        def answer(words, first, owners):
            for x, v in zip(out, (shard, _signed(xxhash.xxh3_64_intdigest(words)), owners), strict=True):
                x.append(v)

        for batch in batches:
            for s, words, first in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                tokens = words.split()
                if s != shard:
                    shard, sam, held = s, None, (tokens, first)
                    answer(words, first, [first] * (len(tokens) - window + 1))
                    continue
                if sam is None:
                    sam = SuffixAutomaton()
                    sam.add(*held)
                owners = sam.owners(tokens, window)
                if None in owners:
                    sam.add(tokens, first)
                answer(words, first, [first if o is None else o for o in owners])
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int64()))], names=["shard", "code", "owners"])
            out[:] = [], [], []

    owned = contents.select("shard", "words", "first").repartition("shard").sortWithinPartitions("shard", "first").mapInArrow(match, "shard long, code long, owners array<long>")
    spots = F.filter(F.transform("owners", lambda o, i: F.when(o < F.col("doc_id"), F.col("start") + i)), lambda x: x.isNotNull())
    late = sent.drop("words").join(owned, ["shard", "code"]).select("mark", "doc_id", spots.alias("spots")).where("size(spots) > 0")
    return late.groupBy("mark", "doc_id").agg(F.flatten(F.collect_list("spots")).alias("spots"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def remove_repeats(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every row of docs without the words of repeated windows.

    Words are runs of bytes other than ASCII white space. A window is so many
    consecutive words; each word under a window that also starts in a document with a
    smaller id goes, windows being those of the input. kept is what stays, joined by
    one space, as UTF-8. Null and empty texts have no words; shorter texts have no
    window; rows with a null id keep all words and own none. Rows that repeat an id
    are held against smaller ids only, each for itself, told apart by a 64-bit hash of
    the text. Other columns are ignored. No rows give no rows.
    """
    spark = prepare(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("mark", F.xxhash64("doc_id", "text"))
    outlines = docs.where("doc_id is not null and text is not null").select("doc_id", "mark", F.md5("text").alias("digest"))
    earliest = outlines.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    copies = scratch(outlines.join(earliest, "digest").where("doc_id > first").select("mark", "doc_id").distinct(), "copies")
    copies = F.broadcast(copies) if copies.count() <= BROADCAST_COPIES else copies
    firsts, copied = (docs.join(copies, ["mark", "doc_id"], how).select(docs.columns) for how in ("left_anti", "left_semi"))
    late = scratch(repeated_windows(firsts, window), "late")
    touched = send(spark, members(late, "mark"))
    names = ["doc_id", "n_words", "n_removed", "kept"]

    def hits(batch):
        return may_hold(touched.value, batch.column(2).to_numpy(zero_copy_only=False))

    def rows(batch, words, removed, kept):
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(w) for w in words], pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())], names=names)

    def whole(batches):
        for batch in batches:
            batch = batch.filter(pa.array(~hits(batch)))
            words = [(t or "").encode().split() for t in batch.column(1).to_pylist()]
            yield rows(batch, words, [0] * len(words), [b" ".join(w) for w in words])

    def gone(batches):
        for batch in batches:
            words = [(t or "").encode().split() for t in batch.column(1).to_pylist()]
            yield rows(batch, words, [len(w) if len(w) >= window else 0 for w in words], [b"" if len(w) >= window else b" ".join(w) for w in words])

    def taken(batches):
        for batch in batches:
            yield batch.filter(pa.array(hits(batch)))

    def drop(batches):
        for batch in batches:
            all_words, removed, kept = [], [], []
            for text, spots in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = (text or "").encode().split()
                edges = np.zeros(len(words) + 1, np.int64)
                at = np.array(spots or [], np.int64)
                np.add.at(edges, at, 1)
                np.add.at(edges, at + window, -1)
                stay = np.cumsum(edges)[:-1] == 0
                all_words.append(words)
                removed.append(len(words) - int(stay.sum()))
                kept.append(b" ".join([w for w, k in zip(words, stay.tolist(), strict=True) if k]))
            yield rows(batch, all_words, removed, kept)

    ddl = "doc_id long, n_words long, n_removed long, kept binary"
    joined = firsts.mapInArrow(taken, docs.schema).join(late, ["mark", "doc_id"], "left").select("doc_id", "text", "spots")
    return firsts.mapInArrow(whole, ddl).unionByName(joined.mapInArrow(drop, ddl)).unionByName(copied.mapInArrow(gone, ddl))
