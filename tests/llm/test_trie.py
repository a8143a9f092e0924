"""The language model's trie: it is searched, misses what was never learned, and gives the same scores however it is cut."""

import binascii
import random

import numpy as np
import pyarrow as pa
import pytest

from seamfold.llm import op7_lm


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def rows(n=120, seed=3):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice("abcdefgh") * rng.choice([1, 1, 2]) for _ in range(rng.randint(0, 40)))) for i in range(n)] + [(n, "never said before"), (n + 1, None), (n + 2, "the " * 3000), (None, "a b c")]


def learned(i):
    return i is not None and binascii.crc32(str(i).encode()) % 10 != 0


def scores(spark, docs, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        return {(r.doc_id, r.n_tokens): (r.score, r.base_score) for r in op7_lm.lm_scores(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_scores_do_not_depend_on_partitions_or_splits(spark, monkeypatch):
    docs = frame(spark, rows())
    one = scores(spark, docs, "2")
    many = scores(spark, docs.repartition(9), "64")
    monkeypatch.setattr(op7_lm, "SHARD", 50)  # frequent first words are split many times
    split = scores(spark, docs.repartition(3), "4")
    for other in (many, split):
        assert other.keys() == one.keys()
        assert all(abs(a - b) < 1e-9 for k in one for a, b in zip(one[k], other[k], strict=True))


def asked(pairs, triples, flushes=2, hot=((), ())):
    """A shard's messages: entries dealt to flushes."""
    out = []
    for k in range(flushes):
        for level, entries in ((2, pairs), (3, triples)):
            own = sorted(entries[k::flushes])
            columns = [np.array(c, np.uint64) for c in zip(*own, strict=True)] or [np.zeros(0, np.uint64)] * (level + 1)
            data = op7_lm.pack(op7_lm.ascending(columns[0]), *columns[1:])
            if level == 2:
                data = op7_lm._two(op7_lm.pack(np.array(hot[0], np.uint64), np.array(hot[1], np.uint64)), data)
            out.append((k, level, 0, data, own))
    table = pa.table({"flush": [x[0] for x in out], "level": pa.array([x[1] for x in out], pa.int32()), "shard": [x[2] for x in out], "data": pa.array([x[3] for x in out], pa.binary())})
    return table, [x[4] for x in out]


@pytest.mark.parametrize("wide", [False, True])
def test_a_shard_answers_with_counts_and_misses(wide):
    rng = random.Random(5)
    shift = (1 << 40) if wide else 0
    word = lambda: rng.choice([rng.randrange(12) + shift, rng.randrange(12) + shift, int(op7_lm.BEGIN)])
    pairs = {(word(), rng.randrange(12) + shift): rng.choice([0, 0, 1, 2, 5]) for _ in range(90)}
    triples = {(a, b, rng.randrange(12) + shift): rng.choice([0, 1, 3]) if n else 0 for (a, b), n in pairs.items() for _ in range(3)}
    hot = (3 + shift,)
    table, sent = asked([(*k, n) for k, n in pairs.items()], [(*k, n) for k, n in triples.items()], hot=(hot, (1000,)))
    answer = op7_lm._answer(table)
    total, kinds = {}, {}
    for k, n in [*pairs.items(), *triples.items()]:
        total[k[:-1]], kinds[k[:-1]] = total.get(k[:-1], 0) + n, kinds.get(k[:-1], 0) + (n > 0)
    known = {x for k, n in pairs.items() if n for x in k} | {x for k, n in triples.items() if n for x in k}
    if hot[0] in known:
        total[hot] = 1000
    misses = 0
    for data, own in zip(answer["data"].to_pylist(), sent, strict=True):
        split, found = op7_lm._one_two(data)
        n, t, k = (x.tolist() for x in op7_lm.unpack(found))
        want = [(e[-1] if e[-1] else 0, total[e[:-2]], kinds[e[:-2]]) for e in own]
        assert list(zip(n, t, k, strict=True)) == want
        misses += sum(x == 0 for x in n)
        if len(own[0]) == 3:
            assert [x.tolist() for x in op7_lm.unpack(split)] == [[hot[0]], [kinds.get(hot, 0)]]
    assert misses > 10


def test_trie_descends_and_a_removed_successor_is_gone():
    a, b, n = (np.array(x, np.uint64) for x in ([1, 1, 4, 9], [4, 7, 9, 1], [3, 1, 2, 1]))
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    trie = op7_lm.Trie.build((a, b, n.astype(np.int64)), (np.array([0, 0, 2]), np.array([9, 7, 1], np.uint64)[[1, 0, 2]], np.array([1, 2, 2])), none)

    def path(*ids):
        w = [trie.word(np.array([i], np.uint64)) for i in ids]
        at = trie.pairs.search(w[0], w[1])
        return int(at[0]) if len(ids) == 2 else int(trie.triples.search(at, w[2])[0])

    assert [path(1, 4), path(1, 7), path(4, 9), path(9, 1)] == [0, 1, 2, 3]
    assert [path(1, 4, 7), path(1, 4, 9), path(4, 9, 1)] == [0, 1, 2]
    assert [path(1, 9), path(7, 1), path(1, 5), path(100, 4), path(1, 4, 1), path(9, 1, 4), path(1, 7, 9), path(8, 8, 8)] == [-1] * 8
    less = op7_lm.Trie.build((a, b, n.astype(np.int64)), (np.array([0, 2]), np.array([7, 1], np.uint64), np.array([1, 2])), none)
    trie = less
    assert path(1, 4, 9) == -1 and path(1, 4, 7) == 0
    empty = op7_lm.Trie.build((a[:0], b[:0], n[:0].astype(np.int64)), (np.zeros(0, np.int64), a[:0], np.zeros(0, np.int64)), none)
    trie = empty
    assert path(1, 4) == path(1, 4, 7) == -1


def test_a_removed_successor_changes_the_score(spark):
    """What is scored is what the trie finds: without one of its successors the score of a text falls."""
    base = [(i, "x y z") for i in range(40) if learned(i)] + [(i, "x y w") for i in range(40, 60) if learned(i)]
    probe = next(i for i in range(1000, 2000) if not learned(i))
    after = lambda text: {r.doc_id: r.score for r in op7_lm.lm_scores(frame(spark, [*base, (2001, text), (probe, "x y q")])).collect()}[probe]
    assert learned(2001) and after("x y q") > after("q y x") > after("a b c")
