"""The corpus operators against brute force, with nulls, empty and long texts, ties and clashing columns."""

import binascii
import collections
import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from seamfold.llm import eliasfano, graph, op1_lines, op2_decontaminate, op3_jaccard, op4_chat, op5_quality, op6_media, op7_lm, op8_packing, op9_lengths, op10_substrings, setjoin, tiff
from seamfold.llm.graph import components
from seamfold.llm.template import Template, TemplateError

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, item_id long, node long, key long"
RND = random.Random(5)
VOCABULARY = ["".join(RND.choice("abcdefgh") for _ in range(RND.randint(2, 7))) for _ in range(400)]


def words(n):
    return [RND.choice(VOCABULARY) for _ in range(n)]


def corpus():
    rows = [(i, " ".join(words(RND.randint(20, 90)))) for i in range(60)]
    base = words(120)
    for i in range(60, 90):
        w = base[:]
        for _ in range(RND.randint(0, 3)):
            w[RND.randrange(len(w))] = RND.choice(VOCABULARY)
        rows.append((i, " ".join(w)))
    passage = " ".join(words(30))
    rows += [(i, " ".join(words(15)) + "\n" + passage + "\n" + " ".join(words(15))) for i in range(90, 110)]
    rows += [(110, None), (111, ""), (112, " \n\t "), (113, "one two"), (114, "one two"), (115, "ONE two"), (116, " ".join(words(20_000))), (117, rows[0][1]), (118, rows[0][1]), (119, "x" * 100_000), (3, rows[3][1]), (None, "a text without an id"), (120, "Ünï cödé <|endoftext|>    漢字")]
    return rows


ROWS = corpus()


def frame(spark, rows=None):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, 2, 3) for i, t in (ROWS if rows is None else rows)], SCHEMA)


def split(text):
    return (text or "").encode().split()


def test_jaccard_components_match_brute_force(spark):
    got = op3_jaccard.jaccard_components(frame(spark)).collect()
    sets = collections.defaultdict(list)
    for i, t in ROWS:
        w = split((t or "").lower() if (t or "").isascii() else t)
        sets[i].append({tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set())
    flat = [(i, s) for i, ss in sets.items() for s in ss if i is not None]
    up = {i: i for i, _ in flat}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for (i, a), (j, b) in itertools.combinations(flat, 2):
        if a and b and 100 * len(a & b) >= 85 * len(a | b) and find(i) != find(j):
            up[max(find(i), find(j))] = min(find(i), find(j))
    assert len(got) == len(ROWS)
    for r in got:
        assert r.component_id == (None if r.doc_id is None else find(r.doc_id))
        assert r.doc_id is None or r.n_shingles in [len(s) for s in sets[r.doc_id]]


def test_jaccard_keeps_every_set_of_a_repeated_id(spark):
    near = lambda t: " ".join(t.split()[:-1] + ["other"])
    a, b, c = (" ".join(words(60)) for _ in range(3))
    rows = [(3, a), (3, b), (10, near(a)), (11, near(b)), (12, c), (13, near(c)), (3, None), (None, a), (20, "one two"), (21, "one two"), (20, a)]
    got = sorted((r.doc_id or 0, r.n_shingles > 0, r.component_id) for r in op3_jaccard.jaccard_components(frame(spark, rows), links=False).collect())
    assert got == sorted([(3, True, 3), (3, True, 3), (10, True, 3), (11, True, 3), (12, True, 12), (13, True, 12), (3, False, 3), (0, True, None), (20, True, 3), (21, True, 3), (20, True, 3)])
    assert op3_jaccard.jaccard_components(frame(spark, [])).count() == 0


def test_jaccard_counts_every_link(spark, monkeypatch):
    monkeypatch.setattr(setjoin, "MANY", 7)
    rng = random.Random(11)
    base, rows = [str(rng.randrange(900)) for _ in range(150)], []
    for i in range(40):
        w = base[:]
        for _ in range(i % 6):
            w[rng.randrange(len(w))] = str(rng.randrange(900))
        rows.append((i, " ".join(w)))
    rows += [(40, rows[1][1]), (41, rows[5][1].upper()), (42, "one two"), (43, None), (None, rows[2][1])]
    sets = {i: frozenset(zip(*((t or "").lower().split()[k:] for k in range(4)), strict=False)) or frozenset([t] if t else []) for i, t in rows}
    want = {i: sum(100 * len(s & o) >= 85 * len(s | o) for o in set(sets.values()) - {s} if s and o) for i, s in sets.items()}
    got = {r.doc_id: r.n_links for r in op3_jaccard.jaccard_components(frame(spark, rows)).collect()}
    assert got == want and max(want.values()) > 10 and len({x for x in want.values() if x}) > 2
    xs = [np.array(sorted(rng.sample(range(9000), rng.randint(0, 3000))), np.uint64) for _ in range(8)]
    assert setjoin.both_counts(xs[:3], xs[3:]).tolist() == setjoin.few_counts(xs[:3], xs[3:]).tolist() == [[len(np.intersect1d(x, y)) for y in xs[3:]] for x in xs[:3]]


def test_divide_skip_counts():
    for _ in range(200):
        lists = [sorted(RND.sample(range(30), RND.randint(0, 20))) for _ in range(RND.randint(1, 25))]
        need = RND.randint(1, 12)
        count = collections.Counter(itertools.chain(*lists))
        assert setjoin.divide_skip(lists, need) == {k: v for k, v in count.items() if v >= need}


def test_search_and_count_agree():
    for _ in range(50):
        q = np.unique(np.array(RND.sample(range(200), 60), np.uint64))
        others = [np.unique(np.array(RND.sample(range(200), RND.randint(40, 80)), np.uint64)) for _ in range(8)] + [q]
        assert setjoin.search(q, others, 30, 100) == setjoin.count(q, others, 30, 100)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(1, 50)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_line_components(spark):
    line = " ".join(words(40))
    rows = [(1, line + "\nshort one\n\n" + " ".join(words(30))), (2, line.upper() + " tail"), (3, "short  ONE"), (4, None), (5, ""), (None, line)]
    got = {(r.doc_id, r.line): (r.keep_doc, r.keep_line, r.kept) for r in op1_lines.line_components(frame(spark, rows)).collect()}
    assert got == {(1, 0): (1, 0, True), (1, 1): (1, 1, True), (1, 3): (1, 3, True), (2, 0): (1, 0, False), (3, 0): (1, 1, False)}
    kept = {r.doc_id: r.text for r in op1_lines.drop_lines(frame(spark, rows)).collect()}
    assert set(kept) == {1, 4, 5, None} and kept[1] == rows[0][1]


def test_lines_that_share_half_a_hash_stay_apart(spark, monkeypatch):
    whole = op1_lines._codes

    def half(line):
        return 7, whole(line)[1]

    monkeypatch.setattr(op1_lines, "_codes", half)
    rows = [(1, "the first of two lines"), (2, "quite another thing"), (3, "The first of  two lines"), (4, "quite another thing")]
    got = {r.doc_id: r.keep_doc for r in op1_lines.line_components(frame(spark, rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 2}
    assert {r.doc_id: r.text for r in op1_lines.drop_lines(frame(spark, rows)).collect()} == dict(rows[:2])


def test_line_components_of_near_copies_match_brute_force(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    base = [rng.choice(words) for _ in range(60)]
    lines = []
    for _ in range(150):
        own = list(base)
        for _ in range(rng.randrange(0, 9)):
            own[rng.randrange(len(own))] = rng.choice(words)
        lines.append(" ".join(own))
    rows = [(i, line) for i, line in enumerate(lines)]
    sets = [set(op1_lines.shingle_set(x).tolist()) for x in lines]
    uf = graph.UnionFind()
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                uf.union(i, j)
    got = {r.doc_id: r.keep_doc for r in op1_lines.line_components(frame(spark, rows)).collect()}
    assert got == {i: uf.find(i) for i in range(len(lines))}
    assert 1 < len(set(got.values())) < len(lines)


def test_lines_of_repeated_ids(spark):
    a, b, c = (" ".join(words(20)) for _ in range(3))
    rows = [(1, b), (3, a), (3, b), (3, a), (4, c + "\n" + a), (5, None), (5, b + " tail")]
    docs = frame(spark, rows).withColumnsRenamed({"lang": "gone", "source": "kept"})
    kept = op1_lines.drop_lines(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "", r.n_chars or 0) for r in kept.collect()) == sorted((i, t or "", len(t or "")) for i, t in [(1, b), (3, a), (3, a), (4, c), (5, None)])
    assert op1_lines.line_components(frame(spark, [])).count() == 0 and op1_lines.drop_lines(frame(spark, [])).count() == 0


def test_large_buckets_are_searched_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(op1_lines, "MANY", 5)
    monkeypatch.setattr(op1_lines, "HEADS", 1)
    rng = random.Random(7)
    lines = [[rng.choice(VOCABULARY) for _ in range(40)]]
    for _ in range(80):
        own = list(rng.choice(lines))
        for _ in range(rng.randrange(1, 6)):
            own[rng.randrange(len(own))] = rng.choice(VOCABULARY)
        lines.append(own)
    lines = [" ".join(x) for x in lines]
    sets, uf = [set(op1_lines.shingle_set(x).tolist()) for x in lines], graph.UnionFind()
    for i, j in itertools.combinations(range(len(sets)), 2):
        both = len(sets[i] & sets[j])
        if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            uf.union(i, j)
    got = {r.doc_id: r.keep_doc for r in op1_lines.line_components(frame(spark, list(enumerate(lines)))).collect()}
    assert got == {i: uf.find(i) for i in range(len(lines))} and 1 < len(set(got.values())) < len(lines)


def test_slices():
    assert [b - a for a, b in setjoin.slices([b"x" * setjoin.SLICE, b"", b"y", b"z" * setjoin.SLICE])] == [2, 1, 1]
    assert list(setjoin.slices([])) == []


def test_line_signatures_find_similar_lines():
    found = 0
    for _ in range(200):
        w = words(RND.randint(8, 60))
        v = w[:]
        v[RND.randrange(len(v))] = RND.choice(VOCABULARY)
        a, b = " ".join(w), " ".join(v)
        x, y = (set(op1_lines.shingle_set(s).tolist()) for s in (a, b))
        if len(x & y) < 0.8 * len(x | y):
            continue
        keys = op1_lines.band_keys([a, b])
        found += 1
        assert set(keys[0].tolist()) & set(keys[1].tolist())
    assert found > 50


def test_repetitive_lines_share_bands():
    for unit in ("-", "= ", "ab cd ef "):
        lines = [(unit * 400)[:n].strip() for n in (50, 110, 130, 200, 3000)]
        keys = [set(k.tolist()) for k in op1_lines.band_keys(lines)]
        assert all(keys[0] & k for k in keys)
    long = " ".join(words(80))
    assert set(op1_lines.band_keys([long])[0].tolist()) & set(op1_lines.band_keys([long + " " + "-" * 900])[0].tolist())


def test_overlaps(spark):
    item = words(30)
    near = item[:]
    near[14] = "other"
    rows = [(1, " ".join(words(20) + item + words(20))), (2, " ".join(words(5) + near)), (3, " ".join(item[:12])), (4, " ".join(words(60))), (5, None), (6, ""), (None, " ".join(item)), (7, " ".join(item).upper().replace(" ", ", "))]
    bench = frame(spark, [(1, " ".join(item)), (2, None), (3, "too short")]).withColumn("item_id", F.col("doc_id"))
    got = op2_decontaminate.overlaps(frame(spark, rows), bench).collect()
    assert sorted(r.doc_id for r in got) == [1, 2, 7] and {r.item_id for r in got} == {1}
    assert next(r for r in got if r.doc_id == 1).first_word == 20
    left = op2_decontaminate.decontaminate(frame(spark, rows), bench)
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 3, 4, 5, 6] and left.columns == frame(spark, rows).columns
    assert op2_decontaminate.overlaps(frame(spark, []), bench).count() == 0


def test_overlaps_are_found_wherever_words_differ(spark):
    rng = random.Random(17)
    items = {n: [f"w{n}x{k}" for k in range(n)] for n in (1, 4, 5, 9, 10, 12, 13, 15)}
    rows, want = [], set()
    for n, item in items.items():
        span = min(n, 13)
        most = max(k for k in range(span) if span - k >= 0.8 * span)
        for gone in [g for k in range(min(most, 2) + 2) for g in itertools.combinations(range(n), k)]:
            if rng.random() < 0.3 and n > 13:
                continue
            w = [f"other{k}" if k in gone else x for k, x in enumerate(item)]
            doc = len(rows)
            rows.append((doc, " ".join(["before"] * (doc % 3) + w + ["after"] * (doc % 2))))
            if any(sum(k in gone for k in range(a, a + span)) <= most for a in range(n - span + 1)):
                want.add((doc, n))
    bench = frame(spark, [(n, " ".join(w)) for n, w in items.items()]).withColumn("item_id", F.col("doc_id"))
    got = op2_decontaminate.overlaps(frame(spark, rows), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(want) < len(rows)
    assert all(r.best >= 0.8 and r.last_word - r.first_word >= min(r.item_id, 13) for r in got)


def test_masks_find_windows_wherever_two_words_differ():
    masks, span = op2_decontaminate.MASKS, op2_decontaminate.SPAN
    assert all("0" in m and m[0] == m[-1] == "1" and len(m) < span for m in masks)
    for gone in itertools.combinations(range(span), 2):
        assert any(all(m[p - at] == "0" for p in gone if 0 <= p - at < len(m)) for m in masks for at in range(span - len(m) + 1))


def test_overlaps_by_shuffle_are_the_same(spark):
    rng = random.Random(23)
    items = [[rng.choice("abcdefghijklmnopqrst") for _ in range(n)] for n in (13, 20, 40, 6, 1)]
    rows = []
    for k in range(60):
        w = items[k % 5][:]
        for _ in range(k % 4):
            w[rng.randrange(len(w))] = "zz"
        rows.append((k % 50, " ".join([rng.choice("uvwxy") for _ in range(k % 3)] + w + ["end"])))
    bench = frame(spark, [(n, " ".join(w)) for n, w in enumerate(items)] + [(2, "other text of an item whose id comes twice")]).withColumn("item_id", F.col("doc_id"))
    docs = frame(spark, [*rows, (None, rows[0][1]), (7, None)])
    want = {}
    for (i, t), (n, w) in itertools.product(rows, enumerate(items)):
        d, span = t.split(), min(13, len(w))
        for a, b in itertools.product(range(len(d) - span + 1), range(len(w) - span + 1)):
            if (equal := sum(x == y for x, y in zip(d[a : a + span], w[b : b + span], strict=True))) >= 0.8 * span:
                want.setdefault((i, n), {})[a, b] = max(equal / span, want.get((i, n), {}).get((a, b), 0))
    want = {k: (len(v), min(a for a, _ in v), max(v.values())) for k, v in want.items()}
    for most in (10**6, 0):
        got = op2_decontaminate.overlaps(docs, bench, broadcast=most).collect()
        assert {(r.doc_id, r.item_id): (r.n_hits, r.first_word, r.best) for r in got} == want
    assert len(want) > 20


def test_template():
    render = lambda s, **names: Template(s).render(**names)
    assert render("{% for x in xs -%} {{ loop.index ~ x }}{% if not loop.last %},{% endif %}{% endfor %}", xs="ab")[0] == "1a,2b"
    assert render("{% if a.b is defined %}y{% elif a[0] %}z{% else %}n{% endif %}{# c #}", a={"c": 1})[0] == "n"
    assert render("a{% generation %}bc{% endgeneration %}d{% generation %}{% endgeneration %}") == ("abcd", [(1, 3), (4, 4)])
    assert render("{{ 'x' if 2 > 1 and 3 in [3] else 'y' }}{{ missing }}{{ none|default('d') }}")[0] == "xd"
    assert len(Template("a{{ 1 + 1 }}{% if true %}b{% endif %}c").tree) == 1
    for bad in ("{{ x.__class__ }}", "{{ f() }}", "{% for x %}{% endfor %}", "{% if x %}", "{{ 'a'|nothing }}", "{% import os %}"):
        with pytest.raises(TemplateError):
            Template(bad)
    with pytest.raises(TemplateError):
        Template("{% for x in xs %}aaaa{% endfor %}", limit=10).render(xs=range(5))


def test_chats(spark):
    texts = ["</s>[INST] ok [/INST]", "a\\b<|end|>\n", "<|en", None, "", "\\", "<\\|end|>", "Ünï 漢"]
    rows = [(c, k, RND.choice(["user", "assistant", "sys<|text|>\n", None]), RND.choice(texts)) for c in range(30) for k in range(RND.randint(1, 6))] + [(1, 0, "user", "again"), (1, 0, "user", "again"), (None, None, None, None)]
    got = op4_chat.digests(op4_chat.format_chats(spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, n_turns int"))).collect()
    by = collections.defaultdict(list)
    for c, k, r, t in rows:
        by[c].append((-1 if k is None else k, r or "", t or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert len(got) == len(by)
    for r in got:
        turns = sorted(by[r.conv_id])
        loss = "".join(t for _, role, t in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(turns), sha("".join(f"{a}\n{b}\n" for _, a, b in turns)), len(loss), sha(loss))
    for t in filter(None, texts):
        e = op4_chat.escape(t)
        assert op4_chat.unescape(e) == t and not any(c in e for c in op4_chat.CONTROL)


def test_classifier_learns_and_covers_all_rows(spark):
    good, bad = words(50), ["zz$%", "##q", "!!x", "%%"]
    rows = [(i, " ".join(RND.choices(good if i % 3 else bad, k=30))) for i in range(300)] + [(300, None), (301, ""), (None, "x")]
    labels = spark.createDataFrame([(i, int(bool(i % 3)), 0) for i in range(300)] + [(5, None, 0), (None, 1, 0), (999, 0, 0)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows)
    got = op5_quality.score(docs, op5_quality.fit(docs, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (binascii.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    labelled = [r for r in held if r.doc_id is not None and r.doc_id < 300]
    assert sum(r.predicted == int(bool(r.doc_id % 3)) for r in labelled) >= 0.95 * len(labelled)
    assert {r.score for r in op5_quality.score(docs, op5_quality.fit(docs, labels.where("false"))).collect()} == {0.5}
    assert op5_quality.keep_good(docs, labels).columns == docs.columns


def test_tiff_forms():
    a = np.random.default_rng(1).integers(0, 256, (37, 45, 3), dtype=np.uint8)
    a[:20] = 7
    for order, kind, predictor, how in itertools.product("<>", (tiff.NONE, tiff.LZW, tiff.DEFLATE, tiff.PACKBITS), (1, 2), ({"rows": 7}, {"tile": (16, 32)}, {})):
        pages = list(tiff.walk(tiff.write([{"samples": a, "compression": kind, "predictor": predictor, **how}] * 2, order)))
        assert len(pages) == 2 and all((p.samples == a).all() for p in pages)
    for n in (0, 1, 5000, 60_000):
        data = bytes(RND.choice(b"abcd") for _ in range(n))
        assert tiff.lzw_decode(tiff.lzw_encode(data), n) == data and tiff.unpack_bits(tiff.pack_bits(data), n) == data
    for broken in (b"", b"II*\0", b"II*\0\x08\0\0\0\xff", tiff.write([{"samples": a}])[:-40]):
        with pytest.raises(tiff.TiffError):
            list(tiff.walk(broken))


def test_media(spark):
    got = {(r.doc_id, r.payload_sha256): r for r in op6_media.media_digests(frame(spark)).collect()}
    for i, t in ROWS:
        n, data = op6_media.payload(t)
        r = got[i, hashlib.sha256(data).hexdigest()]
        assert (r.n_bytes, r.payload_bytes, r.tail_crc32) == (n, len(data), zlib.crc32(data[-32:])) and len(data) % 576 == 0
    media = op6_media.text_media(frame(spark, [(1, "abc"), (2, None)])).select("doc_id", "media").unionByName(spark.createDataFrame([(3, bytearray(b"no")), (4, None)], "doc_id long, media binary"))
    rows = op6_media.tiff_pages(media).orderBy("doc_id").collect()
    assert [(r.doc_id, r.page, r.error is None) for r in rows] == [(1, 0, True), (2, 0, True), (3, None, False)]


def test_feature_matches_brute_force():
    for n in (1, 30, 130):
        data = bytes(RND.choice(b"abcz") for _ in range(n * 576))
        pages = list(tiff.walk(op6_media.store(data)))
        assert b"".join(p.samples.tobytes() for p in pages) == data
        if n == 130:
            assert {p.compression for p in pages} == {tiff.LZW, tiff.PACKBITS, tiff.DEFLATE}
        got = dict(x.split("=") for x in op6_media.feature(pages).split(";"))
        dx = dy = 0
        hist = [0] * 16
        for page in range(0, len(data), op6_media.PAGE):
            rows = [data[a : a + 48] for a in range(page, min(len(data), page + op6_media.PAGE), 48)]
            dx += sum(abs(r[i] - r[i + 1]) for r in rows for i in range(47))
            dy += sum(abs(a - b) for x, y in itertools.pairwise(rows) for a, b in zip(x, y, strict=True))
        for x in data:
            hist[x // 16] += 1
        mean = sum(data) / len(data)
        std = math.sqrt(sum((x - mean) ** 2 for x in data) / len(data))
        assert (int(got["dx"]), int(got["dy"]), got["hist"]) == (dx, dy, ",".join(map(str, hist)))
        assert abs(float(got["mean"]) - mean) < 1e-3 and abs(float(got["std"]) - std) < 1e-3 and int(got["pages"]) == len(pages)


def test_damaged_files_are_error_rows(spark):
    import struct

    good = tiff.write([{"samples": np.arange(48 * 48, dtype=np.uint8).reshape(48, 48), "compression": tiff.DEFLATE, "rows": 12}])
    (at,) = struct.unpack_from("<I", good, 4)
    (n,) = struct.unpack_from("<H", good, at)

    def changed(tag, value, count=None):
        out = bytearray(good)
        for i in range(n):
            place = at + 2 + 12 * i
            if struct.unpack_from("<H", out, place)[0] == tag:
                struct.pack_into("<I", out, place + 8, value) if count is None else struct.pack_into("<I", out, place + 4, count)
        return bytes(out)

    damaged = [changed(tiff.HEIGHT, 96), changed(tiff.ROWS_PER_STRIP, 0), changed(tiff.STRIP_SIZES, 0, 2), changed(tiff.HEIGHT, 1 << 31), changed(tiff.WIDTH, 0), changed(tiff.STRIPS, 0, 1 << 31), changed(tiff.COMPRESSION, 7), good[:50], b"II*", b"x" * 99]
    rng = random.Random(3)
    for _ in range(60):
        out = bytearray(good)
        for _ in range(3):
            out[rng.randrange(len(out))] = rng.randrange(256)
        damaged.append(bytes(out))
    media = spark.createDataFrame([(i, bytearray(d)) for i, d in enumerate(damaged)] + [(1000, bytearray(good)), (None, bytearray(good)), (1001, None)], "doc_id long, media binary")
    rows = op6_media.tiff_pages(media).collect()
    bad = {r.doc_id for r in rows if r.error is not None}
    assert set(range(10)) <= bad and {r.page for r in rows if r.doc_id in (None, 1000)} == {0} and 1001 not in {r.doc_id for r in rows}
    assert op6_media.tiff_pages(media.where("false")).count() == 0 and op6_media.media_digests(frame(spark, [])).count() == 0


def test_elias_fano():
    rng = np.random.default_rng(0)
    for n in (0, 1, 7, 5000):
        v = np.sort(rng.integers(0, 10**7, n)).astype(np.uint64)
        assert (eliasfano.EliasFano.build(v).access(np.arange(n)) == v).all()
        c = np.unique(rng.integers(0, 90_000, n))
        s = eliasfano.Successors.build(c // 300, c % 300, 300)
        q = rng.integers(0, 90_000, 3000)
        place = {x: i for i, x in enumerate(c.tolist())}
        assert s.find(q // 300, q % 300).tolist() == [place.get(x, -1) for x in q.tolist()]


def test_lm_counts_and_normalisation(spark):
    docs = frame(spark)
    got = op7_lm.lm_scores(docs).collect()
    assert len(got) == len(ROWS)
    texts = [(i, [w.lower() for w in split(t)] + [None]) for i, t in ROWS]
    held = lambda i: i is not None and binascii.crc32(str(i).encode()) % 10 == 0
    c = collections.Counter(w for i, t in texts if i is not None and not held(i) for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), len(t), sum(w in c for w in t), round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 4)) for i, t in texts)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 4)) for r in got) == want
    assert all(r.train_tokens == n and (r.doc_id is None or r.held_out == held(r.doc_id)) for r in got)


def test_lm_keeps_every_pair_and_triple(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.choice([1, 1, 2]) for _ in range(rng.randint(0, 12)))) for i in range(80)] + [(80, "never twice said"), (None, "a b c")]
    texts = [(i, t.split() + ["<end>"]) for i, t in rows]
    learned = [t for i, t in texts if i is not None and binascii.crc32(str(i).encode()) % 10]
    c1, c2, c3 = (collections.Counter() for _ in range(3))
    for t in learned:
        w = ["<begin>", *t]
        c1.update(t)
        c2.update(zip(w, w[1:], strict=False))
        c3.update(zip(w, w[1:], w[2:], strict=False))
    bottom = sum(c1.values()) + 0.1 * (len(c1) + 1)

    def mixed(table, context, w, below):
        n = sum(c for k, c in table.items() if k[:-1] == context)
        if not n:
            return below
        return (max(table[(*context, w)] - 0.75, 0) + 0.75 * sum(k[:-1] == context for k in table) * below) / n

    def score(t):
        w, s = ["<begin>", *t], 0
        for k in range(1, len(w)):
            p = mixed(c2, (w[k - 1],), w[k], (c1[w[k]] + 0.1) / bottom)
            s += math.log10(mixed(c3, (w[k - 2], w[k - 1]), w[k], p) if k > 1 else p)
        return s

    got = op7_lm.lm_scores(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), round(r.score, 6)) for r in got) == sorted((str(i), round(score(t), 6)) for i, t in texts)
    assert op7_lm.lm_scores(frame(spark, [])).count() == 0


def test_levels_add_up_and_find_every_successor(monkeypatch):
    rng = np.random.default_rng(2)
    context, word = rng.zipf(1.3, 5000).astype(np.uint64) % np.uint64(300), rng.zipf(1.5, 5000).astype(np.uint64) % np.uint64(90)
    n = rng.integers(0, 3, 5000).astype(np.uint64)
    level, c, w, entry = op7_lm.Level.build(context, word, n)
    c, w = c[entry], w[entry]
    share, left = level.find(c, w)
    assert (level.successors.find(c, w) == entry).all()
    count, total, kinds = collections.Counter(), collections.Counter(), collections.Counter()
    for a, b, k in zip(context.tolist(), word.tolist(), n.tolist(), strict=True):
        count[a, b] += k
        total[a] += k
    for (a, _), k in count.items():
        kinds[a] += k > 0
    for a, b, s, r in zip(context.tolist(), word.tolist(), share.tolist(), left.tolist(), strict=True):
        assert s == (max(count[a, b] - 0.75, 0) / total[a] if total[a] else 0) and r == (0.75 * kinds[a] / total[a] if total[a] else 1)
    sums = collections.Counter()
    for (a, b), s in {(a, b): s for a, b, s in zip(context.tolist(), word.tolist(), share.tolist(), strict=True)}.items():
        sums[a] += s
    assert all(abs(sums[a] + r - 1) < 1e-9 for a, r in zip(context.tolist(), left.tolist(), strict=True))
    told = op7_lm.heard(level.told(c[:700], entry[:700]))
    assert told[0].tolist() == share[:700].tolist() and told[1].tolist() == left[:700].tolist()
    absent = np.array([90], np.int64)
    assert level.find(c[:1], absent)[0][0] == 0
    x = np.concatenate([rng.random(5000), [0.0, 1.0, 1e-12]])
    for size in (256, 10_000):
        got = op7_lm.values(*op7_lm.quantise(x, size))
        assert np.allclose(got, x, rtol=0 if size > len(x) else 1 / 125, atol=0)
    a = np.sort(rng.integers(0, 1 << 63, 40).astype(np.uint64))
    assert [y.tolist() for y in op7_lm.unpack(op7_lm.pack(op7_lm.ascending(a), a[::-1]))] == [np.diff(a, prepend=np.uint64(0)).tolist(), a[::-1].tolist()]


def test_lm_flushes_and_shards(spark, monkeypatch):
    rows = [r for r in ROWS if r[0] is not None][:60]
    whole = {r.doc_id: r for r in op7_lm.lm_scores(frame(spark, rows)).collect()}
    monkeypatch.setattr(op7_lm, "SHARD", 64)
    parts = {r.doc_id: r for r in op7_lm.lm_scores(frame(spark, rows).repartition(7)).collect()}
    assert all(abs(whole[i].score - parts[i].score) < 1e-6 and abs(whole[i].base_score - parts[i].base_score) < 1e-6 for i in whole) and len(parts) == len(whole)


def best_fit(lengths, room):
    bins = []
    for n in sorted(lengths, reverse=True):
        fit = [(left, k) for k, left in enumerate(bins) if left >= n]
        if fit:
            bins[min(fit)[1]] -= n
        else:
            bins.append(room - n)
    return sorted(bins)


def test_plan_is_best_fit_decreasing():
    for _ in range(200):
        room = RND.choice([5, 16, 100])
        lengths = [RND.randint(1, room) for _ in range(RND.randint(0, 80))]
        steps, n = op8_packing.plan(collections.Counter(lengths), room)
        left = {}
        for s in steps:
            for r in range(s.last - s.first):
                b = s.bin + r // s.each
                assert room - left.get(b, room) == s.offset + r % s.each * s.length
                left[b] = left.get(b, room) - s.length
        assert len(left) == n and sorted(left.values()) == best_fit(lengths, room)


def encode(text):
    import public_tokenizers
    import tokenizers

    t = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return t.encode(text or "", add_special_tokens=False).ids


def test_special_tokens_are_read_as_the_library_reads_them():
    from seamfold.llm.tokens import encoder

    for text in ("<|endoftext|> hi", "a<|endoftext|>b", "<|endoftext", "plain", "Ünï 漢<|endoftext|>", ""):
        assert encoder().ids(text).tolist() == encode(text)
    assert 50256 in encode("a<|endoftext|>b")


def test_packing_ranks_in_parts(spark, monkeypatch):
    monkeypatch.setattr(op8_packing, "RANKED", 3)
    got = op8_packing.pack(frame(spark, [(i % 7, "same words here" if i % 3 else "x") for i in range(60)])).collect()
    places = sorted((r.sequence_id, r.offset, r.length) for r in got)
    assert len(got) == len(set(places)) == 60
    for a, b in itertools.pairwise(places):
        assert b[1] == (a[1] + a[2] if a[0] == b[0] else 0)
    lengths = [r.length for r in got]
    assert len({r.sequence_id for r in got}) == len(best_fit(lengths, 1024))


def test_packing(spark):
    got = op8_packing.pack(frame(spark)).collect()
    seq = collections.defaultdict(list)
    for r in got:
        seq[r.sequence_id].append((r.offset, r.length))
    for parts in seq.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 1024
    want = []
    for i, t in ROWS:
        ids, at, k = encode(t) + [2], 0, 0
        while at < len(ids):
            n = (len(ids) - at - 1) % 1024 + 1 if at == 0 else 1024
            want.append((str(i), k, at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes())))
            at, k = at + n, k + 1
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    assert op8_packing.pack(frame(spark, [])).count() == 0


def test_length_sums(spark):
    sums = op9_lengths.suffix_sums(op9_lengths.length_histogram(frame(spark)))
    n = np.array([len(encode(t)) for _, t in ROWS])
    rows = sums.collect()
    assert sorted(r.n_tokens for r in rows) == sorted(set(n.tolist()))
    for r in rows:
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least, r.truncated_total) == ((n == r.n_tokens).sum(), (n >= r.n_tokens).sum(), n[n >= r.n_tokens].sum(), np.minimum(n, r.n_tokens).sum())
    for r in op9_lengths.truncated_totals(sums, [0, 50, 10**7]).collect():
        assert (r.docs_cut, r.truncated_total) == ((n > r.limit).sum(), np.minimum(n, r.limit).sum())
    for r in op9_lengths.quantiles(sums, [0.1, 0.5, 1.0]).collect():
        assert r.n_tokens == np.quantile(n, r.share, method="inverted_cdf")


def test_substrings(spark):
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, bytes(r.kept)) for r in op10_substrings.remove_repeats(frame(spark)).collect())
    first = {}
    for i, t in sorted((r for r in ROWS if r[0] is not None), key=lambda r: r[0]):
        w = split(t)
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    want = []
    for i, t in ROWS:
        w = split(t)
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if i is not None and first[tuple(w[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        want.append((str(i), len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    assert got == sorted(want)


def test_automaton_owners():
    sam, seqs = op10_substrings.SuffixAutomaton(), []
    for label in range(30):
        seqs.append([RND.choice("ab") for _ in range(12)])
        want = [next((j for j, s in enumerate(seqs[:-1]) if any(s[q : q + 5] == seqs[-1][k : k + 5] for q in range(8))), None) for k in range(8)]
        assert sam.owners(seqs[-1], 5) == want
        sam.add(seqs[-1], label)


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = frame(spark, [])
    assert op3_jaccard.keep_first(docs).columns == docs.columns and op1_lines.drop_lines(docs).columns == docs.columns
    kept = op3_jaccard.keep_first(frame(spark)).collect()
    assert {110, 111, 112, None, 60} <= {r.doc_id for r in kept} and 118 not in {r.doc_id for r in kept}
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality classifier" and len(corpus_pipeline.STAGES) == 5
