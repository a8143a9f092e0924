"""LM scoring: a trigram model of the whole corpus, beside an add-0.1 unigram model.

Nothing is capped: every word, pair and triple of the learned rows has its exact count,
smoothed by absolute discounting and interpolation down to the unigram model. The trie
is cut into shards by first words, which grow in number with the tokens:

1. Texts are gathered into flushes of FLUSH tokens, as places in their distinct words.
   Word shards, dealt by ranges of hashes, count the words and give small ids to frequent ones.
2. Each flush sends its distinct pairs and triples to the shards of their first words, as
   columns of ids whose bytes are laid out by significance and compressed. The first words
   that are very frequent are split by their second ones.
3. A shard adds up what was learned and builds a trie of it: for each first word its
   ascending successors, for each of these pairs its own, both in Elias-Fano form under
   monotone pointers, with counts in codebooks, in one mapped block. All distinct pairs and
   triples of the texts, learned or not, are then searched by descending from word to
   word; those that were never learned are not found.
4. The answers meet again in their flush, which makes shares of the counts, adds up what a
   split word has in its shards, and then its texts' probabilities.

Flushes are written in buckets, so that they are not shuffled for steps 2 and 4.
"""

from __future__ import annotations

import mmap
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamfold.llm.core import bucketed, mix, prepare, scratch, word_hashes
from seamfold.llm.eliasfano import EliasFano, Successors, dump, load
from seamfold.llm.op5_quality import held_out

DISCOUNT = 0.75
ADD = 0.1
#: Tokens that a task gathers before it asks for them.
FLUSH = 1 << 21
#: Tokens of the corpus for each shard; a word that is learned from so often is split once more for each such number.
SHARD = 1 << 20
#: For callers that want at most so many different numbers: steps of a scale for each factor of e, and its code for 0.
SCALE, ZERO = 64.0, (1 << 16) - 1
#: A text's end as a word's hash, and what stands before its first word as a word's id.
END, BEGIN = np.uint64(0x2545F4914F6CDD1D), np.uint64(1 << 63)
_U8, _32 = np.dtype("<u8"), np.uint64(32)


def tokens(text: str | None) -> np.ndarray:
    """Hashes of the words of a text, A-Z lower-cased, and of its end."""
    return np.append(word_hashes((text or "").encode().lower().split()), END)


def pack(*columns: np.ndarray) -> bytes:
    """Columns of one length and of 8-byte numbers, each as its lowest bytes, its second lowest and so on, compressed."""
    raw = b"".join(np.ascontiguousarray(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), 8).T).tobytes() for c in columns)
    return struct.pack("<qq", len(raw), len(columns)) + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def unpack(data: bytes) -> list[np.ndarray]:
    size, n = struct.unpack_from("<qq", data)
    raw = np.frombuffer(pa.Codec("zstd").decompress(memoryview(data)[16:], size), np.uint8).reshape(n, 8, -1)
    return [np.ascontiguousarray(c.T).view(_U8)[:, 0] for c in raw]


def ascending(x: np.ndarray) -> np.ndarray:
    """The differences of an ascending column; np.cumsum undoes it."""
    return np.diff(x, prepend=np.uint64(0))


def quantise(x: np.ndarray, size: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A book of the different numbers with a code for each of x, without loss.

    With a size, more different numbers than that get no book but codes on a fixed scale,
    on which code k stands for exp(-k / SCALE), and the last one for 0.
    """
    book, place = np.unique(x, return_inverse=True)
    if size is None or len(book) <= size:
        return book, place.astype(np.uint16 if len(book) <= 1 << 16 else np.uint32)
    with np.errstate(divide="ignore"):
        return book[:0], np.minimum(np.rint(-SCALE * np.log(x)), ZERO).astype(np.uint16)


def values(book: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return book[codes] if len(book) else np.where(codes == ZERO, 0.0, np.exp(codes / -SCALE))


def shares(n: np.ndarray, total: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The share of a word after a context, its discounted count over the context's, and what the context leaves for the shorter one to share out; 0 and 1 where nothing was learned."""
    n, total, kinds = (np.asarray(x).astype(np.float64) for x in (n, total, kinds))
    return np.where(n > 0, (n - DISCOUNT) / np.maximum(total, 1), 0.0), np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)


class Level:
    """A level of a trie: the successors of its contexts with their counts, and every context's count and number of different successors."""

    N_ARRAYS = 14

    def __init__(self, arrays: list[np.ndarray]) -> None:
        self.counts, self.totals, self.kinds = (tuple(arrays[i : i + 2]) for i in (0, 2, 4))
        self.successors = Successors.of(arrays[6:])

    @classmethod
    def sorted(cls, context: np.ndarray, word: np.ndarray, count: np.ndarray, n_contexts: int, totals: np.ndarray | None = None) -> list[np.ndarray]:
        """The arrays of a level of distinct ascending entries; totals: counts of contexts that have more successors elsewhere, 0 for the others."""
        total, kinds = np.bincount(context, count, n_contexts), np.bincount(context, count > 0, n_contexts)
        if totals is not None:
            total = np.where(totals > 0, totals, total)
        books = [y for x in (count, total, kinds) for y in quantise(np.rint(x).astype(np.int64))]
        return [*books, *Successors.build(context, word, n_contexts).arrays()]

    @classmethod
    def build(cls, context: np.ndarray, word: np.ndarray, n: np.ndarray) -> tuple[Level, np.ndarray, np.ndarray, np.ndarray]:
        """The level of entries, equal ones added up; the distinct entries' contexts and words as places in it; which one each entry is."""
        contexts, c = np.unique(context, return_inverse=True)
        words, w = np.unique(word, return_inverse=True)
        keys, place = np.unique(c * len(words) + w, return_inverse=True)
        of, own = keys // max(1, len(words)), keys % max(1, len(words))
        return cls(load(mapped(cls.sorted(of, own, np.bincount(place, n.astype(np.float64), len(keys)), len(contexts))))), of, own, place

    def numbers(self, context: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
        """Counts of entries, and totals and kinds of their contexts; places and contexts of -1 have none."""
        take = lambda book, at: np.where(at >= 0, book[0][book[1][at]], 0) if len(book[1]) else np.zeros(len(at), np.int64)
        return [take(self.counts, place), take(self.totals, context), take(self.kinds, context)]

    def find(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The share of each word after its context, and what the context leaves; contexts and words are places."""
        return shares(*self.numbers(context, self.successors.find(context, word)))

    def search(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The place of each entry, or -1, also for contexts and words of -1."""
        out = np.full(len(context), -1, np.int64)
        at = np.flatnonzero((context >= 0) & (word >= 0))
        out[at] = self.successors.find(context[at], word[at])
        return out

    def told(self, context: np.ndarray, place: np.ndarray) -> bytes:
        """What was found at these places, to be sent."""
        return pack(*(x.astype(_U8) for x in self.numbers(context, place)))


def heard(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Shares and rests out of what a level told."""
    return shares(*unpack(data))


def mapped(arrays: list[np.ndarray]) -> mmap.mmap:
    """Arrays in one block of mapped memory."""
    whole = dump(arrays)
    block = mmap.mmap(-1, len(whole))
    block.write(whole)
    return block


#: What stands before a text's first word, where ids have 32 bits.
_BEGIN32 = np.uint64(0xFFFFFFFF)


class Trie:
    """The learned pairs and triples of a shard: words, their successors, and these pairs' successors.

    Words are places in an Elias-Fano sequence of ids; the pairs' level has a context for
    each of them, the triples' level one for each pair, so that a place that is found in a
    level is the context to go on with in the next one.
    """

    def __init__(self, arrays: list[np.ndarray]) -> None:
        self.words, self.pairs, self.triples = EliasFano.of(*arrays[:4]), Level(arrays[4 : 4 + Level.N_ARRAYS]), Level(arrays[4 + Level.N_ARRAYS :])

    @classmethod
    def build(cls, pairs: tuple[np.ndarray, np.ndarray, np.ndarray], triples: tuple[np.ndarray, np.ndarray, np.ndarray], split: tuple[np.ndarray, np.ndarray]) -> Trie:
        """pairs: distinct ascending (first, second) with counts; triples: distinct ascending (place of a pair, third) with counts; split: ascending first words that have successors in other shards too, with their totals."""
        ids = np.unique(np.concatenate([pairs[0], pairs[1], triples[1]]))
        totals = np.zeros(len(ids), np.int64)
        at = np.searchsorted(split[0], ids)
        own = at < len(split[0])
        own[own] = split[0][at[own]] == ids[own]
        totals[own] = split[1][at[own]]
        place = lambda x: np.searchsorted(ids, x)
        arrays = [*EliasFano.build(ids).arrays(), *Level.sorted(place(pairs[0]), place(pairs[1]), pairs[2], len(ids), totals), *Level.sorted(triples[0].astype(np.int64), place(triples[1]), triples[2], len(pairs[0]))]
        return cls(load(mapped(arrays)))

    def word(self, ids: np.ndarray) -> np.ndarray:
        """Places of words, or -1."""
        if not self.words.n:
            return np.full(len(ids), -1, np.int64)
        return self.words.find(ids, np.zeros(len(ids), np.int64), np.full(len(ids), self.words.n))


class Flush:
    """The distinct words, pairs and triples of texts that lie one after the other.

    words: distinct ascending hashes; ids: the tokens as places in them; lengths: tokens of each text.
    """

    def __init__(self, words: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.words, self.ids, self.lengths = words, ids.astype(np.int64), lengths
        self.starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)

    def grams(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put the words in the order of their ids and find the distinct pairs and triples; ids and counts in that order."""
        order = np.argsort(ids)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.words, self.ids = self.words[order], place[self.ids]
        size = len(self.words) + 1
        before = np.concatenate([[0], self.ids[:-1]])
        before[self.starts] = size - 1
        pairs, self.pair = np.unique(before * size + self.ids, return_inverse=True)
        self.v, self.w = pairs // size, pairs % size
        first = np.zeros(len(self.ids), bool)
        first[self.starts] = True
        self.later = np.flatnonzero(~first)
        triples, self.triple = np.unique(self.pair[self.later - 1] * size + self.ids[self.later], return_inverse=True)
        self.context, self.last = triples // size, triples % size
        return ids[order], counts[order]

    def entries(self, level: int, known: np.ndarray) -> list[np.ndarray]:
        """Columns of ids of the distinct pairs (2) or triples (3), known being the words' ids; in ascending order."""
        ids = np.append(known, BEGIN)
        if level == 2:
            return [ids[self.v], ids[self.w]]
        return [ids[self.v[self.context]], ids[self.w[self.context]], ids[self.last]]

    def times(self, level: int, train: np.ndarray) -> np.ndarray:
        """How often each word (1), pair (2) or triple (3) occurs in the texts that are learned from."""
        learned = np.repeat(train, self.lengths).astype(np.float64)
        n = np.bincount(self.triple, learned[self.later], len(self.last)) if level == 3 else np.bincount(self.pair, learned, len(self.w)) if level == 2 else np.bincount(self.ids, learned, len(self.words))
        return n.astype(_U8)


def dealt(shard: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of entries by shard, and each shard's first place in it."""
    return np.argsort(shard, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=shards))])


def parts_of(times: np.ndarray, most: int) -> np.ndarray:
    """Over how many parts the successors of a first word are dealt that is learned from so often."""
    return (1 + times // most).astype(np.int64)


def shard_of(first: np.ndarray, part: np.ndarray, shards: int) -> np.ndarray:
    return (mix(mix(first) + part.astype(_U8)) % np.uint64(shards)).astype(np.int64)


def _places(f: Flush, ids: np.ndarray, times: np.ndarray, shards: int, most: int) -> tuple[dict[int, np.ndarray], tuple[np.ndarray, ...]]:
    """The shards of a flush's pairs (2) and triples (3), and (first word, its times, shard) for all parts of all split words of it.

    times: how often each word is learned from as a first one, what stands before a text last.
    """
    first = np.append(ids, BEGIN)
    parts = parts_of(times, most)
    part = (mix(first[f.w] + np.uint64(1)) % parts[f.v].astype(_U8)).astype(np.int64)
    pairs = shard_of(first[f.v], part, shards)
    split = np.flatnonzero(parts > 1)
    each = np.repeat(split, parts[split])
    k = np.arange(len(each)) - np.repeat(np.cumsum(parts[split]) - parts[split], parts[split])
    return {2: pairs, 3: pairs[f.context]}, (first[each], times[each].astype(_U8), shard_of(first[each], k, shards))


def _parts(flush: int, level: int, cuts: np.ndarray, columns: list[np.ndarray], split: tuple[np.ndarray, ...] | None = None) -> pa.RecordBatch:
    """Messages (flush, level, shard, data) of columns in the order of shards; the first one ascends within each. split: rows of _places, sent before a shard's columns."""
    full = np.flatnonzero(np.diff(cuts))
    if split is not None:
        full = np.union1d(full, split[2])
    data = [pack(ascending(columns[0][a:b]), *(c[a:b] for c in columns[1:])) for a, b in ((cuts[k], cuts[k + 1]) for k in full)]
    if split is not None:
        data = [_two(pack(*(x[split[2] == k] for x in split[:2])), d) for k, d in zip(full, data, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array([flush] * len(full), pa.int64()), pa.array([level] * len(full), pa.int32()), pa.array(full, pa.int64()), pa.array(data, pa.binary())], names=["flush", "level", "shard", "data"])


def _two(first: bytes, second: bytes) -> bytes:
    return struct.pack("<q", len(first)) + first + second


def _one_two(data: bytes) -> tuple[bytes, bytes]:
    (size,) = struct.unpack_from("<q", data)
    return data[8 : 8 + size], data[8 + size :]


_SENT = "flush long, level int, shard long, data binary"


def _own(table: pa.Table | pa.RecordBatch, i: int = 0) -> tuple[int, Flush | None, np.ndarray]:
    """A row of flushes: its number, the flush, and which texts are learned from."""
    get = lambda k: table[k][i].as_py()
    words = np.cumsum(unpack(get("words"))[0], dtype=_U8)
    return get("flush"), Flush(words, unpack(get("ids"))[0], np.array(get("lengths"), np.int64)), np.array(get("train"), bool)


def _joined(answers: pa.Table, level: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """A level's answers, shard after shard, and (word, kinds) of the parts of split words."""
    at = np.flatnonzero(answers["level"].to_numpy() == level)
    at = at[np.argsort(answers["shard"].to_numpy()[at])]
    both = [_one_two(answers["data"][int(i)].as_py()) for i in at]
    found, split = [heard(x) for _, x in both], [unpack(x) for x, _ in both]
    join = lambda parts, k, kind: np.concatenate([*(p[k] for p in parts), np.zeros(0, kind)])
    return join(found, 0, np.float64), join(found, 1, np.float64), [join(split, k, _U8) for k in (0, 1)]


def _ask_words(shards: int):
    """Words go to shards by ranges of their hashes, so that ids that are given by shard ascend with hashes."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                flush, f, train = _own(batch, i)
                shard = ((f.words >> _32) * np.uint64(shards) >> _32).astype(np.int64)
                yield _parts(flush, 1, np.searchsorted(shard, np.arange(shards + 1)), [f.words, f.times(1, train)])

    return run


def _count_words(table: pa.Table) -> pa.Table:
    """Each flush's words of a shard: their numbers and counts; known: the words with a count, once a shard."""
    parts = [unpack(x.as_py()) for x in table["data"]]
    hashes = [np.cumsum(p[0], dtype=_U8) for p in parts]
    words, place = np.unique(np.concatenate(hashes), return_inverse=True)
    count = np.bincount(place, np.concatenate([p[1] for p in parts]).astype(np.float64), len(words)).astype(_U8)
    # frequent words have small numbers, which take less room wherever they are sent
    number = np.empty(len(words), _U8)
    number[np.lexsort((words, -count.astype(np.int64)))] = np.arange(len(words), dtype=_U8)
    cuts = np.concatenate([[0], np.cumsum([len(h) for h in hashes])])
    data = [pack(number[place[a:b]], count[place[a:b]]) for a, b in zip(cuts, cuts[1:], strict=False)]
    known = [int((count > 0).sum())] + [0] * (len(parts) - 1)
    return pa.Table.from_arrays([table["flush"], table["level"], table["shard"], pa.array(data, pa.binary()), pa.array(known, pa.int64())], names=["flush", "level", "shard", "data", "known"])


def _known(answers: pa.Table, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and counts of a flush's words, in the order of their hashes."""
    shard = answers["shard"].to_numpy()
    at = np.argsort(shard)
    parts = [unpack(answers["data"][int(i)].as_py()) for i in at]
    ids = [p[0] * np.uint64(shards) + np.uint64(int(shard[i])) for i, p in zip(at, parts, strict=True)]
    return np.concatenate(ids), np.concatenate([p[1] for p in parts])


def _ask(shards: int, texts: int, most: int):
    def run(own: pa.Table, single: pa.Table) -> pa.Table:
        flush, f, train = _own(own)
        ids, count = f.grams(*_known(single, shards))
        place, split = _places(f, ids, np.append(count, texts).astype(np.int64), shards, most)
        out = []
        for level in (2, 3):
            order, cuts = dealt(place[level], shards)
            out.append(_parts(flush, level, cuts, [c[order] for c in [*f.entries(level, ids), f.times(level, train)]], split if level == 2 else None))
        return pa.Table.from_batches(out)

    return run


def _narrow(columns: list[list[np.ndarray]]) -> tuple[list[list[np.ndarray]], np.ndarray | None]:
    """Columns of ids with 32 bits: as they are, but for what stands before texts, or as places in a sorted list of them if some are larger."""
    largest = max((int(c[c != BEGIN].max(initial=0)) for group in columns for c in group), default=0)
    if largest < int(_BEGIN32):
        return [[np.where(c == BEGIN, _BEGIN32, c) for c in group] for group in columns], None
    ids = np.unique(np.concatenate([c for group in columns for c in group]))
    return [[np.searchsorted(ids, c).astype(_U8) for c in group] for group in columns], ids


def _answer(table: pa.Table) -> pa.Table:
    """What each flush asked of a shard, found in the trie of what was learned there.

    Each distinct pair and triple is searched once, whatever number of flushes ask for it.
    """
    level = table["level"].to_numpy()
    rows2, rows3 = np.flatnonzero(level == 2), np.flatnonzero(level == 3)
    both = [_one_two(table["data"][int(i)].as_py()) for i in rows2]
    splits = [unpack(x) for x, _ in both]
    parts = {2: [unpack(x) for _, x in both], 3: [unpack(table["data"][int(i)].as_py()) for i in rows3]}
    for p in (*parts[2], *parts[3]):
        p[0] = np.cumsum(p[0], dtype=_U8)
    join = lambda k, level, n: np.concatenate([*(p[k] for p in parts[level]), np.zeros(0, _U8)]) if parts[level] else np.zeros(0, _U8)
    hot, first = np.unique(np.concatenate([*(s[0] for s in splits), np.zeros(0, _U8)]), return_index=True)
    hot_times = np.concatenate([*(s[1] for s in splits), np.zeros(0, _U8)])[first]
    (two, three, (split,)), ids = _narrow([[join(k, 2, 3) for k in range(2)], [join(k, 3, 4) for k in range(3)], [hot]])
    n2, n3 = join(2, 2, 3), join(3, 3, 4)

    pairs, at2 = np.unique(two[0] << _32 | two[1], return_inverse=True)
    triples, at3 = np.unique(np.searchsorted(pairs, three[0] << _32 | three[1]).astype(_U8) << _32 | three[2], return_inverse=True)
    del two, three
    count2, count3 = (np.rint(np.bincount(at, n.astype(np.float64), len(keys))).astype(np.int64) for at, n, keys in ((at2, n2, pairs), (at3, n3, triples)))
    low = np.uint64(0xFFFFFFFF)
    of, third = (triples >> _32).astype(np.int64), triples & low

    # the trie has what was learned; a learned triple's pair was learned with it
    own2, own3 = count2 > 0, count3 > 0
    node = np.cumsum(own2) - 1
    order = np.argsort(split)
    trie = Trie.build(((pairs >> _32)[own2], (pairs & low)[own2], count2[own2]), (node[of[own3]], third[own3], count3[own3]), (split[order], hot_times[order].astype(np.int64)))

    # pairs that follow each other share their first word
    first2 = pairs >> _32
    begins = np.flatnonzero(np.concatenate([np.ones(min(1, len(first2)), bool), first2[1:] != first2[:-1]]))
    context2 = np.repeat(trie.word(first2[begins]), np.diff(np.append(begins, len(first2))))
    place2 = trie.pairs.search(context2, trie.word(pairs & low))
    place3 = trie.triples.search(place2[of], trie.word(third))
    found = {2: [x.astype(_U8) for x in trie.pairs.numbers(context2, place2)], 3: [x.astype(_U8) for x in trie.triples.numbers(place2[of], place3)]}
    at = trie.word(split)
    kinds = pack(hot, trie.pairs.numbers(at, np.full(len(at), -1))[2].astype(_U8))
    none = pack(hot[:0], hot[:0])
    data: list = [None] * len(level)
    for rows, k, where in ((rows2, 2, at2), (rows3, 3, at3)):
        cuts = np.concatenate([[0], np.cumsum([len(p[0]) for p in parts[k]])]).astype(np.int64)
        for i, a, b in zip(rows, cuts, cuts[1:], strict=False):
            data[i] = _two(kinds if k == 2 else none, pack(*(x[where[a:b]] for x in found[k])))
    return pa.Table.from_arrays([table["flush"], table["level"], table["shard"], pa.array(data, pa.binary())], names=["flush", "level", "shard", "data"])


def _score(shards: int, bottom: float, texts: int, most: int):
    def run(own: pa.Table, answers: pa.Table) -> pa.Table:
        _, f, _ = _own(own)
        ids, count = f.grams(*_known(answers.filter(pa.array(answers["level"].to_numpy() == 1)), shards))
        p1 = (count.astype(np.float64) + ADD) / bottom
        times = np.append(count, texts).astype(np.int64)
        place, _ = _places(f, ids, times, shards, most)

        def found(level: int) -> tuple[np.ndarray, np.ndarray]:
            order, _ = dealt(place[level], shards)
            share, left = np.empty(len(order)), np.empty(len(order))
            share[order], left[order], (word, kinds) = _joined(answers, level)
            if level == 2 and len(word):
                # a split word's different successors are counted over all its parts
                words, at = np.unique(word, return_inverse=True)
                whole = np.bincount(at, kinds.astype(np.float64), len(words))
                split = np.flatnonzero(parts_of(times, most)[f.v] > 1)
                v = f.v[split]
                left[split] = shares(np.zeros(len(v)), times[v], whole[np.searchsorted(words, np.append(ids, BEGIN)[v])])[1]
            return share, left

        share, left = found(2)
        model = (share + left * p1[f.w])[f.pair]
        if len(f.later):
            share, left = found(3)
            model[f.later] = share[f.triple] + left[f.triple] * model[f.later]
        add = lambda x: pa.array(np.add.reduceat(x, f.starts))
        return pa.Table.from_arrays([own["doc_ids"].combine_chunks().flatten(), pa.array(f.lengths), add((count > 0).astype(np.int64)[f.ids]), add(np.log10(p1)[f.ids]), add(np.log10(model))], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return run


def lm_scores(docs: DataFrame, folds: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of docs.

    Learns from the rows whose id's crc32 is not divisible by folds; rows with a null id
    are neither held out nor learned from. Tokens are words and each text's end; null
    and empty texts have their end only. Repeated rows are learned from and scored each. Words and contexts are told apart by a 64-bit
    hash. Shares are exact, whatever the number of shards. Without any training token both models give every token the same probability.
    Other columns are ignored; no rows give no rows.
    """
    spark = prepare(docs.sparkSession)
    out = F.coalesce(held_out("doc_id", folds), F.col("doc_id").isNull())
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).select("doc_id", "text", (~out).alias("train"), F.spark_partition_id().alias("part"))

    def gather(batches):
        held, ids, train, size, at = [], [], [], 0, 0

        def flush():
            words, place = np.unique(np.concatenate(held), return_inverse=True)
            row = {"flush": [part << 32 | at], "doc_ids": [ids], "train": [train], "lengths": [[len(h) for h in held]], "words": [pack(ascending(words))], "ids": [pack(place.astype(_U8))], "n": [size], "n_train": [sum(len(h) for h, t in zip(held, train, strict=True) if t)]}
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("flush", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int64())), ("words", pa.binary()), ("ids", pa.binary()), ("n", pa.int64()), ("n_train", pa.int64())]))

        for batch in batches:
            for doc, text, learn, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(tokens(text))
                ids.append(doc)
                train.append(learn)
                size += len(held[-1])
                if size >= FLUSH:
                    yield flush()
                    held, ids, train, size, at = [], [], [], 0, at + 1
        if size:
            yield flush()

    flushes = bucketed(docs.mapInArrow(gather, "flush long, doc_ids array<long>, train array<boolean>, lengths array<long>, words binary, ids binary, n long, n_train long"), "flush", "flushes")
    whole = flushes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_train"), F.lit(0)).alias("total"), F.coalesce(F.sum(F.size(F.filter("train", lambda x: x))), F.lit(0)).alias("texts")).first()
    texts = int(whole["texts"])
    total, shards = int(whole["total"]), max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(whole["n"]) // SHARD)

    own = flushes.select("flush", "doc_ids", "train", "lengths", "words", "ids")
    single = scratch(own.mapInArrow(_ask_words(shards), _SENT).groupBy("shard").applyInArrow(_count_words, _SENT + ", known long"), "words")
    known = int(single.agg(F.coalesce(F.sum("known"), F.lit(0))).first()[0])
    single = single.drop("known")
    asked = own.groupBy("flush").cogroup(single.groupBy("flush")).applyInArrow(_ask(shards, texts, SHARD), _SENT)
    answered = single.unionByName(asked.groupBy("shard").applyInArrow(_answer, _SENT))
    scored = own.groupBy("flush").cogroup(answered.groupBy("flush")).applyInArrow(_score(shards, total + ADD * (known + 1), texts, SHARD), "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id").cast("string"), folds), F.lit(False)).alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
