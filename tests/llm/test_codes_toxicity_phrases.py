"""Vector codes, toxicity and phrases against brute force, with nulls, empty and long texts, ties and clashing columns."""

import binascii
import collections
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from seamfold.llm import op11_codes, op12_toxicity, op13_phrases, scan

RND = random.Random(11)
DOCS = "doc_id long, text string, lang string, source string, n_chars long, h long, word string, w long, votes int, y int, label int, toxic int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 1, 2, "x", 3, 4, 5, 6, 1) for i, t, lang in rows], DOCS)


# --- words of columns

def test_scanner_splits_and_hashes_like_a_regular_expression():
    texts = ["", None, "a", " a  b\t", "A.b, c!!d\ne", "x" * 100 + " " + "x" * 101, "Ünï cödé — 漢字. z", "\x00q \x01"] + ["".join(RND.choice("ab C.,\t\né") for _ in range(60)) for _ in range(200)]
    scanner = scan.Scanner(op13_phrases.SPACES, op13_phrases.PIECES)
    want, hashes = [], {}
    for i, t in enumerate(texts):
        low = (t or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))
        for piece in re.split(rb"[.,;:!?\n-\r]", low):
            own = [w for w in re.split(rb"[ \t]+", piece) if w]
            want += [(i, w, k + 1 < len(own)) for k, w in enumerate(own)]
    for chunk in (scan.CHUNK, 50):
        scan.CHUNK, old = chunk, scan.CHUNK
        try:
            got = []
            for words in scanner.chunks(pa.array(texts)):
                h = words.hashes()
                got += [(words.first + int(d), w, bool(b)) for d, w, b in zip(words.doc, words.spelled(np.arange(len(h))), words.beside, strict=True)]
                for w, x in zip(words.spelled(np.arange(len(h))), h.tolist(), strict=True):
                    assert hashes.setdefault(w, x) == x
            assert got == want
        finally:
            scan.CHUNK = old
    assert len(set(hashes.values())) == len(hashes)
    assert list(scanner.chunks(pa.array([], pa.string()))) == []


# --- vector codes

def brute_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(x * 256) if abs(x) < 1e15 else int(x) * 256 for x in v], label) for i, v, label in rows if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = len(kept[0][1]) // parts
    cut = [[r[1][p * width : (p + 1) * width] for p in range(parts)] for r in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    assign = lambda: [[min(range(len(books[p])), key=lambda k: (dist(c[p], books[p][k]), k)) for p in range(parts)] for c in cut]
    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [c[p] for c, f in zip(cut, found, strict=True) if f[p] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = assign()
    errors = [sum(dist(c[p], books[p][f[p]]) for p in range(parts)) for c, f in zip(cut, found, strict=True)]
    by_label = collections.Counter()
    for r, e in zip(kept, errors, strict=True):
        by_label[r[2]] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for k in b for x in k).encode()).hexdigest()
    return sorted((str(r[0]), "".join(f"{k:02x}" for k in f), e, by_label[r[2]], digest) for r, f, e in zip(kept, found, errors, strict=True))


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, label, "a", 1, 2) for i, v, label in rows], f"vec_id long, embedding array<{kind}>, label int, code string, error long, __label int")


def coded(df, **k):
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in op11_codes.vector_codes(df, **k).collect())


def test_codes_match_brute_force(spark):
    f32 = lambda x: float(np.float32(x))
    rows = [(i, [f32(RND.gauss(0, 0.3)) for _ in range(32)], RND.choice([0, 1, 2, None])) for i in range(150)]
    rows += [(200 + i, [f32(RND.choice([-1, 0, 1]) / 256) for _ in range(32)], 3) for i in range(80)]  # many ties
    rows += [(3, rows[7][1], 1), (None, rows[8][1], 0), (400, rows[9][1], 5), (401, rows[9][1], 5), rows[9]]
    bad = [(-5, None, 0), (-4, [], 0), (-3, [float("nan")] * 32, 0), (-2, [float("inf")] + [0.0] * 31, 0), (-1, [None] + [0.0] * 31, 0), (900, [0.5] * 16, 0), (901, [0.5] * 17, 0)]
    RND.shuffle(rows)
    assert coded(vectors(spark, rows + bad).repartition(7)) == brute_codes(rows)
    few = rows[:5]
    assert coded(vectors(spark, few)) == brute_codes(few)
    assert coded(vectors(spark, rows[:40]), entries=8, rounds=3, parts=4) == brute_codes(rows[:40], 4, 8, 3)


def test_codes_of_huge_components_are_exact(spark):
    fits = lambda rows: [(i, c, *(x if x < 1 << 63 else None for x in (e, s)), d) for i, c, e, s, d in rows]
    rows = [(i, [RND.choice([-1, 1]) * 10.0 ** RND.choice([0, 3, 6]) * RND.random() for _ in range(16)], i % 2) for i in range(30)]
    assert coded(vectors(spark, rows, "double"), entries=8) == fits(brute_codes(rows, 16, 8))
    rows += [(40 + k, [1e300 * s] + [0.5 * k] * 15, 7) for k, s in enumerate([1, -1, 0.25, 0.3, 0.7])]
    want = brute_codes(rows, 16, 4)
    # a label's error is null where one of its rows' is
    lost = {7} if any(r[2] >= 1 << 63 for r in want) else set()
    assert lost and coded(vectors(spark, rows, "double"), entries=4) == fits(want)


def test_codes_of_nothing(spark):
    out = op11_codes.vector_codes(vectors(spark, []))
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and out.count() == 0
    assert op11_codes.vector_codes(vectors(spark, [(1, None, 1)])).count() == 0
    with pytest.raises(ValueError, match="256"):
        op11_codes.vector_codes(vectors(spark, []), entries=300)


def test_ball_tree_visits_what_ties(spark):
    rng = np.random.default_rng(3)
    for _ in range(30):
        entries = rng.integers(-4, 5, (int(rng.integers(1, 90)), 3))
        points = rng.integers(-6, 7, (200, 3))
        for kind in (np.int64, object):
            index, best = op11_codes.BallTree(entries.astype(kind), leaf=int(rng.integers(1, 9))).nearest(points.astype(kind))
            d = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
            assert index.tolist() == d.argmin(axis=1).tolist() and best.tolist() == d.min(axis=1).tolist()
    x = np.array([k * k + e for k in (1, 2**26, 94906267, 2**31 - 1) for e in (-1, 0, 1)], np.int64)
    assert op11_codes.floor_root(x).tolist() == [math.isqrt(int(v)) for v in x]


# --- toxicity

GOOD = ["".join(RND.choice("aeioubcdfg") for _ in range(RND.randint(2, 7))) for _ in range(300)]
BAD = ["zorkel", "zorkette", "zorkum", "vilebad", "grumf", "snarp"]


def texts(n, seed, long=False):
    rnd, rows = random.Random(seed), []
    for i in range(n):
        own = [rnd.choice(GOOD) for _ in range(rnd.randint(5, 80))]
        toxic = i % 7 == 0
        if toxic:
            for _ in range(rnd.randint(2, 5)):
                own.insert(rnd.randrange(len(own)), rnd.choice(BAD) + rnd.choice(["", ",", "!"]))
        rows.append((i, " ".join(own), toxic))
    return rows


def held(i, folds=5):
    return binascii.crc32(str(i).encode()) % folds == 0


def test_toxicity_is_learned_and_scores_every_row(spark):
    rows = texts(1500, 4)
    extra = [(5001, None, "en"), (5002, "", "en"), (5003, " .,! ", "en"), (5004, " ".join(GOOD) * 400, "en"), (5005, " ".join(GOOD * 60) + " grumf snarp zorkel", "en"), (None, "grumf you snarp", "en"), (7, rows[7][1], "en")]
    d = docs(spark, [(i, t, "en") for i, t, _ in rows] + extra)
    labels = spark.createDataFrame([(i, int(t), 0) for i, _, t in rows if i % 10 < 8] + [(3, 9, 0), (None, 1, 0), (4, None, 1)], "doc_id long, toxic int, quality int")
    got = op12_toxicity.toxicity(d, labels).collect()
    assert len(got) == len(rows) + len(extra)
    by = {r.doc_id: r for r in got}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is not None and held(r.doc_id)) for r in got)
    unseen = [(by[i].predicted, t) for i, _, t in rows if held(i) or i % 10 >= 8]
    assert sum(p == t for p, t in unseen) >= 0.98 * len(unseen) and len(unseen) > 300
    assert by[5001].predicted == by[5002].predicted == by[5003].predicted == by[5004].predicted == 0 and by[5001].score == by[5002].score
    assert by[None].predicted == 1 and by[5005].predicted == 1
    assert len({r.score for r in got if r.doc_id == 7}) == 1


def test_held_out_labels_do_not_count(spark):
    rows = texts(400, 5)
    d = docs(spark, [(i, t, "en") for i, t, _ in rows])
    scores = lambda flip: sorted((r.doc_id, r.score) for r in op12_toxicity.toxicity(d, spark.createDataFrame([(i, int(t) ^ (flip and held(i)),) for i, _, t in rows], "doc_id long, toxic int")).collect())
    assert scores(False) == scores(True)


def test_toxicity_without_labels(spark):
    d = docs(spark, [(1, "a b", "en"), (2, None, "en")])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in op12_toxicity.toxicity(d, none).collect()} == {0.5}
    ids = [i for i in range(1, 50) if not held(i)][:5]
    one = spark.createDataFrame([(i, 0) for i in ids], "doc_id long, toxic int")
    assert {r.predicted for r in op12_toxicity.toxicity(docs(spark, [(i, "a b", "en") for i in ids]), one).collect()} == {0}
    assert op12_toxicity.toxicity(d.limit(0), one).count() == 0
    same = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, toxic int")
    assert op12_toxicity.toxicity(docs(spark, [(i, "", "en") for i in ids]), same).count() == 5  # both classes, no words


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(8)
    n, m = 60_000, op12_toxicity.VOTERS
    y = rng.random(n) < 0.2
    speak = np.where(y[:, None], np.linspace(0.3, 0.9, m), np.linspace(0.01, 0.1, m))
    votes = rng.random((n, m)) < speak
    votes[:, 9] = np.where(rng.random(n) < 0.9, votes[:, 8], votes[:, 9])  # nearly a copy
    state = votes @ (1 << np.arange(m))
    count = lambda rows: np.bincount(state[rows], minlength=1 << m).astype(float)
    known = np.arange(n) < 2000
    model = op12_toxicity.LabelModel().fit(count(~known), count(known & ~y), count(known & y))
    assert (8, 9) in model.edges and abs(model.prior - 0.2) < 0.02
    rates = model.rates()
    for k, own in enumerate((~y, y)):
        assert np.abs(rates[k] - votes[own].mean(axis=0)).max() < 0.03
    q = model.posterior()
    assert ((q[state] >= 0.5) == y).mean() > 0.98
    # probabilities of each class add up over all states, and Bayes' rule holds
    one, zero = (np.exp(model._log(w)) for w in model.weights[::-1])
    assert abs(one.sum() - 1) < 1e-9 and abs(zero.sum() - 1) < 1e-9
    assert np.allclose(q, model.prior * one / (model.prior * one + (1 - model.prior) * zero))
    # a copy must not count as a second witness
    only8, both = 1 << 8, (1 << 8) | (1 << 9)
    lone = op12_toxicity.LabelModel()
    assert q[both] <= 0.99 and lone.posterior()[0] == 0.5 and q[only8] <= 1


def test_logistic_is_at_its_minimum():
    rng = np.random.default_rng(2)
    rows = [np.flatnonzero(rng.random(12) < 0.3) for _ in range(400)]
    target = np.array([float(2 in r or 5 in r) * 0.9 + 0.05 for r in rows])
    weight = rng.random(400) + 0.5
    w = op12_toxicity.logistic(rows, 12, target, weight, steps=2000)
    p = np.array([1 / (1 + math.exp(-(w[r].sum() + w[-1]))) for r in rows])
    gradient = np.append(np.sum([[weight[i] * (p[i] - target[i]) * (k in r) for k in range(12)] for i, r in enumerate(rows)], axis=0) + w[:-1], (weight * (p - target)).sum())
    assert np.abs(gradient).max() / weight.sum() < 1e-3 and w[2] > 1 and w[5] > 1


def test_lexicon_lists_what_tells(spark):
    rows = texts(900, 6)
    near = [(2000 + i, rows[0][1] + f" tail{i % 3}", True) for i in range(200)]  # near copies of one toxic text count about once
    d = spark.createDataFrame([(i, t, int(x)) for i, t, x in rows + near], "doc_id long, text string, y int")
    lexicon = op12_toxicity.lexicon_of(d)
    words = {int(h): w for w in BAD + GOOD for h in op12_toxicity.Features().scanner.chunks(pa.array([w])).__next__().hashes()}
    listed = {words.get(int(h)) for h, k in zip(lexicon.hashes, lexicon.kinds, strict=True) if k == 0}
    assert {"grumf", "snarp", "vilebad"} <= listed and not listed & set(GOOD)
    assert (np.diff(lexicon.hashes.astype(object)) > 0).all() and lexicon.find(lexicon.hashes).tolist() == list(range(len(lexicon.hashes)))
    assert op12_toxicity.lexicon_of(d.where("y = 1")) is None


def test_voters_match_brute_force():
    words = ["grumf", "snarp", "zorkel", "zorkum"]
    features = op12_toxicity.Features()
    h = {w: int(next(features.scanner.chunks(pa.array([w]))).hashes()[0]) for w in [*words, "calm"]}
    stem = next(iter(features.chunks(pa.array(["zorkel"]))))[2][1][2][0]
    hashes = np.array([h["grumf"], h["snarp"], stem, h["calm"]], np.uint64)
    lexicon = op12_toxicity.Lexicon(hashes, np.array([0, 0, 4, 0]), np.array([3.0, 3.0, 3.0, -3.0]))
    said = ["grumf", "a b grumf c", "nothing here", "zorkum zorkel", "snarp " + "x " * 300, None, "", "calm!! #$%", "grumf " + "y " * 20 + "snarp", "hey ?!", "###"]
    got = list(op12_toxicity.Voters(lexicon)(pa.array(said)))
    n, stems = op12_toxicity.LEXICONS, len(op12_toxicity.STEMS)

    def vote(text):
        w = re.findall(r"[a-z0-9']+", text or "")
        strong = [x for x in w if x in ("grumf", "snarp") or (len(x) > 4 and x.startswith("zork"))]
        bits = {h[x] % n for x in strong if x in ("grumf", "snarp")} | ({n} if any(x.startswith("zork") for x in strong) else set()) | ({op12_toxicity.VOTERS - 1} if "calm" in w else set())
        at = [k for k, x in enumerate(w) if x in strong]
        bits |= {b for b, yes in zip(range(n + stems, n + stems + 5), (len(set(strong)) >= 2, len(strong) * 100 >= max(1, len(w)), any(b - a <= 10 for a, b in zip(at, at[1:], strict=False)), re.search(r"[!?]{2}", text or ""), re.search(r"[#$%&*@]{3}", text or "")), strict=True) if yes}
        return sum(1 << b for b in bits)

    assert [v for v, _ in got] == [vote(t) for t in said]
    assert [len(e) for _, e in got] == [1, 1, 0, 1, 1, 0, 0, 1, 2, 0, 0]


# --- phrases

def brute_phrases(rows, least=10, most=3, inside=50, top=2000):
    n, f = collections.Counter(), collections.Counter()
    for _, text, lang in rows:
        low = (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))
        for piece in re.split(rb"[.,;:!?\n-\r]", low):
            w = [x for x in re.split(rb"[ \t]+", piece) if x]
            n[lang or "und"] += len(w)
            for k in range(1, most + 1):
                for i in range(len(w) - k + 1):
                    f[lang or "und", tuple(w[i : i + k])] += 1
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    gone = {(lang, w[i : i + k]) for (lang, w), a in cand.items() for k in range(2, len(w)) for i in range(len(w) - k + 1) if 100 * a >= inside * f[lang, w[i : i + k]]}
    out = collections.defaultdict(list)
    for (lang, w), a in cand.items():
        if (lang, w) not in gone:
            score, k = min((1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
            out[lang].append((-score, -a, b" ".join(w), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, x in out.items() for i, (s, a, p, l, r) in enumerate(sorted(x)[:top], 1))


def phrase_rows():
    rnd = random.Random(9)
    vocabulary = ["the", "of", "New", "york", "city", "a", "b", "É", "é", "x" * 40]
    rows = [(i, "".join(rnd.choice(vocabulary) + rnd.choice([" ", " ", " ", "\t ", ". ", "\n", ","]) for _ in range(rnd.randint(0, 60))), rnd.choice(["en", "en", "de", None, "und"])) for i in range(250)]
    rows += [(300, None, "en"), (301, "", "en"), (302, "aa " * 500, "fr"), (303, "new york city " * 20, "en"), (303, "new york city " * 20, "en"), (None, "of the " * 15, "it"), (305, "one two", "xx"), (306, "the of " * 8000, "en")]
    return rows


def test_phrases_match_brute_force(spark):
    rows = phrase_rows()
    got = lambda **k: sorted(tuple(r) for r in op13_phrases.phrases(docs(spark, rows).repartition(5), **k).collect())
    assert got() == brute_phrases(rows)
    assert got(least=3, most=4, top=7) == brute_phrases(rows, 3, 4, 50, 7)
    assert got(least=2, most=2, inside=101) == brute_phrases(rows, 2, 2, 101)


def test_phrases_across_batches_flushes_and_shuffles(spark, monkeypatch):
    rows = phrase_rows()
    monkeypatch.setattr(op13_phrases, "FLUSH", 64)
    monkeypatch.setattr(op13_phrases, "BROADCAST_COUNTS", 0)
    assert sorted(tuple(r) for r in op13_phrases.phrases(docs(spark, rows)).collect()) == brute_phrases(rows)
    # sorted projections cut into batches at every place
    names, columns = ["a", "b", "c", "n"], [[1, 1, 1, 1, 2, 2], [5, 5, 5, 7, 5, 5], [0, 6, 8, 0, 1, 2], [4, 3, 2, 9, 1, 1]]
    want = {(1, 5): 9, (1, 5, 6): 3, (1, 5, 8): 2, (1, 7): 9, (2, 5): 2}
    for cuts in ([6], [1, 5], [2, 4], [3, 3], [1, 1, 1, 1, 1, 1]):
        batches, at = [], 0
        for c in cuts:
            batches.append(pa.RecordBatch.from_arrays([pa.array(x[at : at + c], pa.int64()) for x in columns], names=names))
            at += c
        found = [(tuple(w), n) for out in op13_phrases.grow(3, 2)(batches) for w, n in zip(out["w"].to_pylist(), out["n"].to_pylist(), strict=True)]
        assert len(found) == len(want) and dict(found) == want


def test_words_that_share_a_hash_get_another_seed(spark, monkeypatch):
    # tasks have the scanner by reference, so the clash is made where counts are read
    rows, seeds, real = phrase_rows()[:80], [], op13_phrases.count_words

    def clash(docs, seed):
        seeds.append(seed)
        out = real(docs, seed)
        return out.withColumn("h", out.h % 3) if seed == 0 else out

    monkeypatch.setattr(op13_phrases, "count_words", clash)
    assert sorted(tuple(r) for r in op13_phrases.phrases(docs(spark, rows), least=5).collect()) == brute_phrases(rows, 5)
    assert seeds == [0, 1]


def test_phrases_of_nothing(spark):
    out = op13_phrases.phrases(docs(spark, [(1, "a b", "en")]).limit(0))
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and out.count() == 0
    assert op13_phrases.phrases(docs(spark, [(1, None, None), (2, "a b", "en")])).count() == 0
