"""Operators that no query over the driver's tables reaches: sources, sinks, prompts, audits, budgets, display."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from seamfold import errors
from seamfold.operators import audit, budget, classify, dataset, display, effects, metrics, prompts, textcheck
from seamfold.sources import acquire, readers, sinks
from seamfold.streaming import replay

HOSTS = ("example.org",)


def archive(path, entries):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in entries.items():
            z.writestr(name, text)
    return path


def test_urls_and_downloads(tmp_path):
    assert acquire.check_url("https://example.org/a.zip", HOSTS)
    for bad in ("http://example.org/a", "https://other.org/a", "file:///etc/passwd", "https://example.org.evil.org/"):
        with pytest.raises(errors.SourceError):
            acquire.check_url(bad, HOSTS)
    got = acquire.download("https://example.org/a", tmp_path / "x" / "a", HOSTS, 10, lambda url: [b"12345", b"6789"])
    assert got.read_bytes() == b"123456789"
    with pytest.raises(errors.SourceError):
        acquire.download("https://example.org/a", tmp_path / "b", HOSTS, 5, lambda url: [b"12345", b"6"])

    def broken(url):
        yield b"1"
        raise OSError("gone")

    with pytest.raises(errors.SourceError):
        acquire.download("https://example.org/a", tmp_path / "b", HOSTS, 5, broken)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["x"]
    with pytest.raises(errors.SourceError):
        acquire._Redirects(HOSTS).redirect_request(None, None, 302, "", {}, "https://other.org/")


def test_archives_stay_in_their_folder(tmp_path):
    for name in ("../out.json", "/abs.json", "a/../../out.json"):
        with pytest.raises(errors.UnsafeArchive):
            acquire.unpack(archive(tmp_path / "bad.zip", {"ok.json": "{}", name: "{}"}), tmp_path / "to")
    good = archive(tmp_path / "good.zip", {"b.json": "{}", "d/a.json": "{}", "readme.txt": "x"})
    for limit in ({"max_entries": 2}, {"max_bytes": 3}):
        with pytest.raises(errors.UnsafeArchive):
            acquire.unpack(good, tmp_path / "to", **limit)
    (tmp_path / "no.zip").write_text("no zip")
    with pytest.raises(errors.UnsafeArchive):
        acquire.unpack(tmp_path / "no.zip", tmp_path / "to")
    assert not any(p.is_file() for p in (tmp_path / "to").rglob("*"))
    first = acquire.acquire(tmp_path / "raw", archive=good)
    again = acquire.acquire(tmp_path / "raw", url="https://example.org/a", hosts=HOSTS, fetch=lambda url: [good.read_bytes()])
    assert [f.name for f in first.files] == ["b.json", "a.json"] and not first.from_cache and again.from_cache and again.files == first.files
    (tmp_path / "raw" / acquire.MARKER).write_text("{oops")
    assert not acquire.acquire(tmp_path / "raw", archive=good).from_cache
    assert acquire.acquire(tmp_path, folder=tmp_path / "raw").from_cache
    with pytest.raises(errors.SourceError):
        acquire.acquire(tmp_path)


PAIRS = "match_id string, ball_id string, persona string, bucket string, event string, state string, commentary string"


def test_pair_files_and_sinks(spark, tmp_path):
    rows = [("m2", "0-10-1", "b", "four", "FOUR off the bat", "A 10/1", "Cracked for four. é"), ("m2", "0-2-1", "a", None, "dot ball", "A 10/1", "Nothing"), ("m1", "0-0-1", "a", "six", "SIX off the bat", "A 6/0", "Six!")]
    pairs = spark.createDataFrame(rows, PAIRS)
    sinks.append_pairs(pairs.limit(2), f"{tmp_path}/pairs")
    sinks.append_pairs(pairs.where("match_id = 'm1'"), f"{tmp_path}/pairs")
    assert spark.read.json(f"{tmp_path}/pairs").count() == 3
    (tmp_path / "files").mkdir()
    for name, row in (("a", rows[1]), ("judge_dropped", rows[0])):
        (tmp_path / "files" / f"{name}.jsonl").write_text(json.dumps(dict(zip(pairs.columns, row, strict=True))) + "\n")
    assert [r.file for r in readers.read_pairs(spark, f"{tmp_path}/files").collect()] == ["a.jsonl"]
    assert readers.read_pairs(spark, f"{tmp_path}/files", bookkeeping=True).count() == 2
    examples = pairs.select("match_id", "ball_id", "persona", "bucket", F.lit("train").alias("split"), "commentary")
    sinks.write_splits(examples, f"{tmp_path}/sets", metrics.assembly_stats(examples, F.col("commentary")))
    lines = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/sets/train.jsonl").collect()]
    assert [(x["match_id"], x["ball_id"]) for x in lines] == [("m1", "0-0-1"), ("m2", "0-10-1"), ("m2", "0-2-1")] and list(lines[0]) == sorted(lines[0])
    assert spark.read.text(f"{tmp_path}/sets/val.jsonl").count() == 0
    stats = json.loads(spark.read.text(f"{tmp_path}/sets/stats.json").first().value)
    assert stats["total"] == 3 and stats["by_persona"] == {"a": 2, "b": 1} and stats["words_mean"] == 2.0 and stats["words_p95"] == 4
    assert sinks.plan_push(spark, f"{tmp_path}/sets", "some/where").files == ["test.jsonl", "train.jsonl", "val.jsonl"]
    sinks.snapshot_without(pairs, pairs.where("persona = 'b'"), ["match_id", "ball_id", "persona"], f"{tmp_path}/rest")
    assert spark.read.parquet(f"{tmp_path}/rest").count() == 2
    assert readers.reference_texts(spark.createDataFrame([(" a ",), ('{"text": "b"}',), ("",), ('{"x": 1}',)], "value string")).count() == 2
    specs = readers.unfaithful_specs(spark.createDataFrame([(json.dumps({"line": str(v), "verdict": v}),) for v in ({"faithful": False}, {"faithful": True}, {}, None)], "value string"))
    assert [r.line for r in specs.collect()] == ["{'faithful': False}"]


def test_canonical_json_sorts_all_levels(spark):
    df = spark.createDataFrame([({"b": 1, "a": 2}, [(1, None)], None)], "z map<string, int>, y array<struct<q: int, p: string>>, x struct<d: int, c: int>")
    assert df.select(sinks.canonical_json(df)).first()[0] == '{"x":null,"y":[{"p":null,"q":1}],"z":{"a":2,"b":1}}'


def test_manifests(spark, tmp_path):
    schema = "match_id string, input_sha256 string, status string"
    empty = sinks.load_manifest(spark, f"{tmp_path}/none", schema)
    assert empty.count() == 0
    one = sinks.upsert(empty, spark.createDataFrame([("m1", "x", "built"), ("m2", "y", "failed")], schema), "match_id")
    sinks.save_manifest(one, f"{tmp_path}/one")
    two = sinks.upsert(sinks.load_manifest(spark, f"{tmp_path}/one", schema), spark.createDataFrame([("m2", "z", "built")], schema), "match_id")
    assert {tuple(r) for r in two.collect()} == {("m1", "x", "built"), ("m2", "z", "built")}
    hashes = spark.createDataFrame([("m1", "x"), ("m2", "new"), ("m3", "w")], "match_id string, input_sha256 string")
    outputs = spark.createDataFrame([("m1",), ("m2",)], "match_id string")
    assert {r.match_id for r in sinks.needs_build(hashes, two, outputs).collect()} == {"m2", "m3"} and sinks.needs_build(hashes, two, outputs, True).count() == 3
    assert {r.match_id for r in sinks.pending(hashes, two, ["match_id"]).collect()} == {"m3"}


def test_prompts(spark):
    table = prompts.personas(spark, [("a", "The A", "Speak A.", True), ("b", "The B", "Speak B.", False)]).withColumn("place", F.when(F.col("key") == "a", 0).otherwise(1))
    assert prompts.primary(table).first().key == "a" and prompts.secondary(table).count() == 1
    shown = spark.createDataFrame([(0, "dot ball", "A 0/0", {"a": "None.", "b": "Dot."}), (1, "wide", "A 1/0", {"a": "Wide."})], prompts.EXEMPLAR)
    assert sorted(r.text for r in prompts.seed_lines(shown).collect()) == ["Dot.", "None.", "Wide."]
    assert prompts.exemplars_for(shown, "b").first().line == "Dot."
    block = prompts.example_block(shown, table).first().text
    assert block == "VOICE EXAMPLES\n\n## The A (a)\nBALL: dot ball\nSTATE: A 0/0\nLINE: None.\nBALL: wide\nSTATE: A 1/0\nLINE: Wide.\n\n## The B (b)\nBALL: dot ball\nSTATE: A 0/0\nLINE: Dot."
    items = spark.createDataFrame([("a", "dot ball", "A 0/0", "No run.")], "persona string, event string, state string, line string")
    row = prompts.with_persona(items, table).select(prompts.teacher_turn().alias("t"), prompts.judge_turn().alias("j"), prompts.system_prompt("As {display_name}: {instruction}").alias("s"), prompts.token_estimate(F.lit("x" * 9)).alias("n")).first()
    assert row.t == "PERSONA: a - Speak A.\nBALL: dot ball\nSTATE: A 0/0\n\nWrite one line of commentary in the The A voice."
    assert row.j.endswith("LINE: No run.\n\nAudit the LINE. Call record_verdict.") and row.s == "As The A: Speak A." and row.n == 2
    with pytest.raises(errors.UnknownKey, match="unknown personas"):
        prompts.with_persona(items.withColumn("persona", F.lit("z")), table)
    pairs = items.select(F.lit("m").alias("match_id"), F.lit("0").alias("ball_id"), "persona", F.lit("four").alias("bucket"), "event", "state", F.col("line").alias("commentary"))
    with pytest.raises(Exception, match="unknown persona"):
        dataset.examples(pairs, {"b": "x"}).collect()


def test_budgets(spark, tmp_path):
    price = budget.Price(5.0, 25.0)
    with pytest.raises(errors.UnknownKey):
        budget.price_of({"a": price}, "b")
    assert budget.generation_estimate(100, price, 1000, 10, 10, batch=False) == round((1000 * 2 * 5 + 100 * (1000 * 0.1 * 5 + 10 * 5 + 10 * 25)) / 1e6, 2)
    assert budget.judge_estimate(0, price) == round(4830 * 10 / 1e6, 2)
    usage = spark.createDataFrame([(100, 10, 5, 7), (None, None, None, 1)], "i int, r int, w int, o int")
    cost = lambda **k: [r[0] for r in usage.select(budget.usage_cost({"tokens_in": F.col("i"), "cache_read": F.col("r"), "cache_write": F.col("w"), "tokens_out": F.col("o")}, price, **k)).collect()]
    assert cost() == pytest.approx([(500 + 5 + 50 + 175) / 1e6, 25 / 1e6]) and cost(batch=True, writes=False)[0] == pytest.approx((500 + 5 + 175) / 2e6)
    targets = spark.createDataFrame([(i, b) for i, b in enumerate(["four", "other", "tight_finish", "six", "four"])], "i int, bucket string")
    pay = budget.cache_write_cost(price) + 3.5 * budget.marginal_judge_cost(price)
    kept, left = budget.affordable_targets(targets, pay, price, classify.PRIORITY, ["i"])
    assert sorted(r.i for r in kept.collect()) == [0, 2, 3] and left == 2
    assert budget.affordable_targets(targets, 100.0, price, classify.PRIORITY, ["i"])[1] == 0
    assert budget.dry_run(targets, price)[0] == 5
    assert classify.high_risk(targets).count() == 4

    items = spark.range(20).select(F.col("id").alias("i"))
    done = items.where("i < 3")
    call = lambda wave: wave.select("i", F.when(F.col("i") == 5, "failed").otherwise("kept").alias("status"), F.when(F.col("i") != 5, 1.0).alias("cost"))
    run = budget.run_waves(items, done, ["i"], ["i"], call, f"{tmp_path}/a", budget=6.0, size=4, alone=1)
    assert (run.waves, run.spent, run.statuses, run.stopped, run.processed) == (3, 8.0, {"kept": 8, "failed": 1}, True, 8)
    more = spark.read.parquet(*run.answers).select("i").union(done)
    rest = budget.run_waves(items, more, ["i"], ["i"], call, f"{tmp_path}/b", budget=100.0, size=50)
    assert (rest.waves, rest.statuses, rest.stopped) == (1, {"kept": 8}, False)
    assert budget.run_waves(items, items, ["i"], ["i"], call, f"{tmp_path}/c", budget=1.0).waves == 0


def verdict(good, severity="none", modes=(), persona=True):
    return (good, severity, list(modes), persona, "high", "because")


def test_audit(spark, tmp_path):
    rows = [("a", "dot ball", "A 10/1", "Nothing doing", "four"), ("b", "dot ball", "A 10/1", "A huge six!", None), ("a", "dot ball", "A 10/1", "Bowled him", "six"), ("a", "dot ball", "A 10/1", "Left alone", "six"), ("a", "dot ball", "A 10/1", "Blocked", "six")]
    held = audit.items(spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "persona string, event string, state string, commentary string, bucket string, i int"))
    assert [(r.bucket, r.match_id, r.heuristic_ok) for r in held.orderBy("line").collect()] == [("?", "?", False), ("six", "?", True), ("six", "?", False), ("six", "?", True), ("four", "?", True)]
    verdicts = {"Nothing doing": verdict(False, "minor", ["other"]), "A huge six!": verdict(False, "critical", ["invented_event", "other"], False), "Bowled him": verdict(True), "Left alone": verdict(True), "Blocked": None}
    given = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(verdicts.items())], f"line string, verdict {audit.VERDICT}, place int")
    judged = held.join(given, "line")
    r = audit.report(judged, "place", 1.23456).first()
    assert (r.n, r.n_judged, r.n_judge_failed, r.faithful, r.unfaithful, r.false_negatives, r.false_positives, r.true_rejects) == (5, 4, 1, 2, 2, 1, 1, 1)
    assert (r.faithfulness_rate, r.persona_match_rate, r.judge_spend_usd) == (0.5, 0.75, 1.2346) and r.severity == {"minor": 1, "critical": 1, "none": 2}
    assert [(m.mode, m.n) for m in r.failure_modes] == [("other", 2), ("invented_event", 1)] and r.by_bucket == {"four": [0, 1], "?": [0, 1], "six": [2, 2]}
    assert [x.line for x in audit.defects(judged, "place").collect()] == ["A huge six!", "Nothing doing"]
    audit.write_outputs(judged, str(tmp_path), "round", "place", 1.5)
    page = "\n".join(x.value for x in spark.read.text(f"{tmp_path}/round.catalog").collect())
    assert "- judge faithfulness rate: 50.0% (2 faithful / 2 defects)" in page and "### [critical] invented_event, other  (dropped by heuristic)" in page
    assert spark.read.json(f"{tmp_path}/round.judged").count() == 5
    assert [x.persona for x in audit.rotated(spark.range(4), F.col("id"), ["x", "y", "z"]).orderBy("id").collect()] == ["x", "y", "z", "x"]
    assert audit.generated(held.select("persona", "event", "state", "line")).first().source == "generated"


def test_systems_and_gate(spark):
    lines = spark.createDataFrame([("t", "dot ball", "", "no run there"), ("t", "dot ball", "", "left alone outside off"), ("b", "dot ball", "", "A huge six"), ("b", "dot ball", "", "played with soft hands")], "system string, event string, state string, line string")
    s = metrics.score_systems(lines)
    assert {(r.system, r.n, r.faithful, r.rate, r.n_defects) for r in s.collect()} == {("t", 2, 2, 1.0, 0), ("b", 2, 1, 0.5, 1)}
    assert metrics.comparison(s).columns == ["system", "n", "faithfulness", "distinct_2", "self_dup_rate"] and metrics.defects(lines).count() == 1
    one = lambda rate, d, u: spark.createDataFrame([(rate, d, u)], "rate double, distinct_2 double, duplicate_rate double")
    text = lambda t, b: tuple(metrics.gate(t, b).first())
    assert text(one(0.52, 0.6, 0.05), one(0.5, 0.6, 0.05)) == (False, "margin", "faithfulness gain +2.0% below the 5% margin (fine-tuned 52.0% vs base 50.0%)")
    assert text(one(0.9, 0.4, 0.05), one(0.5, 0.6, 0.05)) == (False, "distinct_2", "diversity collapse: distinct-2 0.40 < 0.50")
    assert text(one(0.9, 0.6, 0.25), one(0.5, 0.6, 0.05)) == (False, "duplicate_rate", "repetition: self-dup 0.25 > 0.10")
    assert text(one(0.9, 0.6, 0.05), one(0.5, 0.6, 0.05)) == (True, "passed", "PASS: faithfulness 90.0% vs base 50.0% (+40.0%); distinct-2 0.60")


def test_lengths(spark):
    df = spark.range(1003).select("id", (F.col("id") * 7 % 1003).alias("n"))
    r = metrics.length_check(df, "n", ["id"], 900).first()
    held = sorted(i * 7 % 1003 for i in range(0, 1003, 2))
    assert (r.n_total, r.n_measured, r.p50, r.p95, r.longest, r.over) == (1003, len(held), held[len(held) // 2], held[int(0.95 * len(held))], held[-1], sum(n > 900 for n in held))
    assert metrics.indexed_percentile(df.limit(0), "n", 0.95).first().p is None


def test_display(spark):
    names = spark.createDataFrame([("Mumbai Indians", 0), ("Knights of the North", 1), ("of", 2), ("Xi", 3)], "n string, i int")
    got = [tuple(r) for r in names.orderBy("i").select(display.team_code(F.col("n")), display.hue(F.col("n"))).collect()]
    hue = lambda s: __import__("functools").reduce(lambda h, c: (h * 31 + ord(c)) % 360, s, 0)
    assert got == [("MI", hue("Mumbai Indians")), ("KN", hue("Knights of the North")), ("OF", hue("of")), ("X", hue("Xi"))]
    t = spark.createDataFrame([("W",), ("6",), ("0",), ("1",), ("3",)], "t string")
    assert [tuple(r) for r in t.select(display.ball_label(F.col("t")), display.ball_class(F.col("t"))).collect()] == [("Wicket", "wicket"), ("Six", "boundary"), ("Dot ball", "dot"), ("1 run", ""), ("3 runs", "")]
    label = lambda r, semi: spark.range(1).select(display.round_label(F.lit(r), F.lit(semi))).first()[0]
    assert [label(0, True), label(1, True), label(1, False), label(2, False), label(3, True)] == ["Group Stage", "Semi-Finals", "Playoffs", "Qualifier 2", "Final"]
    assert spark.range(1).select(display.persona_tag(F.lit("text")), display.persona_tag(F.lit("mine")), display.is_blank(F.lit("  \n")), display.is_blank(F.lit("x"))).first() == ("WIRE", "MINE", True, False)
    assert [r.id for r in display.newest_first(spark.range(3), "id").collect()] == [2, 1, 0]


def test_replays(spark, tmp_path):
    records = spark.createDataFrame([("m1", 0, "a b"), ("m1", 1, "c"), ("m2", 0, "d")], "match_id string, seq int, line string")
    f = dataset.frames(records, ["match_id"], "seq", "line", start=1, done=F.to_json(F.struct("match_id")))
    assert {(r.match_id, r.seq, r.kind) for r in f.collect()} == {("m1", 1, "state"), ("m1", 1, "token"), ("m1", 1, "ball"), ("m1", 2, "done"), ("m2", 1, "done")}
    whole = dataset.frames(records, ["match_id"], "seq", "line")
    assert {r.seq for r in dataset.resume(whole, 0).collect()} == {1} and {r.seq for r in dataset.resume(whole, 0, True).collect()} == {0, 1}
    assert [r[0] for r in spark.createDataFrame([(None,), (-1.0,), (9.0,), (2.0,)], "p double").select(dataset.pace(F.col("p"))).collect()] == [1.8, 0.0, 8.0, 2.0]
    assert dataset.balls_of(records, "m1").count() == 2
    with pytest.raises(errors.UnknownKey, match="unknown match"):
        dataset.balls_of(records, "m9")
    assert [r.match_id for r in dataset.listed(records, most=1).collect()] == ["m1"] and [r.match_id for r in dataset.listed(records, ["m2", "x"], 0).collect()] == ["m2"]

    def go():
        q = replay.run_once(replay.stream_frames(spark, f"{tmp_path}/in", records.schema.simpleString()[7:-1].replace(":", " "), ["match_id"], "seq", "line"), f"{tmp_path}/out", f"{tmp_path}/at")
        q.awaitTermination()
        return spark.read.parquet(f"{tmp_path}/out").count()

    records.where("match_id = 'm1'").write.parquet(f"{tmp_path}/in")
    assert go() == 7
    records.where("match_id = 'm2'").write.mode("append").parquet(f"{tmp_path}/in")
    assert go() == 10 and go() == 10


def test_validated_lines(spark):
    draws = [(["A huge six!", "Left alone\nsecond"], "Left alone", 2), (["", "  "], "fall", 2), (["Bowled him", "Six!"], "fall", 2)]
    df = spark.createDataFrame([(d,) for d, _, _ in draws], "d array<string>")
    got = [r.v for r in df.select(textcheck.validated(F.col("d"), F.lit("dot ball"), F.lit("A 1/0"), F.lit("fall")).alias("v")).collect()]
    assert [(v.line, v.attempts) for v in got] == [(line, n) for _, line, n in draws] and all(v.faithful for v in got)
    assert [v.source for v in got] == ["model", "fallback", "fallback"] and got[2].reasons == ["claims a six that did not happen"] and got[1].reasons == []


def test_generated_items(spark):
    items = spark.createDataFrame([(1, "dot ball"), (2, "wide")], "i int, event string")
    lines = effects.generate(items, lambda rows: [None if r["i"] == 2 else "No run" for r in rows])
    status = lines.select(effects.status(F.col("line"), F.lit(True), F.lit(False)).alias("s"))
    assert sorted(r.s for r in status.collect()) == ["failed", "kept"]
    assert metrics.counters(status, "s").count() == 2
