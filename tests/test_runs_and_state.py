"""Runs over models, snapshots, ordered streams, increments and places, with what breaks off in between."""

import json

import pytest
from pyspark.sql import functions as F

from seamfold import errors
from seamfold.functions.ranks import placed, placed_within
from seamfold.operators import audit, budget, classify, dataset, fold, runs
from seamfold.sources import readers, sinks
from seamfold.sources.snapshots import Snapshots, rewrite_without, upserted
from seamfold.streaming import replay

PRICE = budget.Price(3.0, 15.0)


def test_places(spark):
    rows = [(i * 7919 % 1009, "abc"[i % 3] if i % 11 else None, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a long, g string, i long").repartition(5)
    key = lambda r: (r[1] is not None, r[1] or "", r[0], r[2])
    assert [r.i for r in placed(df, ["g", "a", "i"]).orderBy("__place").collect()] == [r[2] for r in sorted(rows, key=key)]
    assert sorted(r["__place"] for r in placed(df, [-F.col("a"), "i"]).collect()) == list(range(3000))
    within = {r.i: r.p for r in placed_within(df, "g", ["a", "i"], "p").collect()}
    for g in (None, "a", "b", "c"):
        own = sorted((r for r in rows if r[1] == g), key=lambda r: (r[0], r[2]))
        assert [within[r[2]] for r in own] == list(range(len(own)))
    assert placed(df.limit(0), ["a"]).count() == 0
    same = spark.createDataFrame([(1,)] * 50, "a long")
    assert sorted(r["__place"] for r in placed(same, ["a"]).collect()) == list(range(50))


def test_pilot_draws_places_of_a_sorted_list(spark):
    import random

    df = spark.range(200).select(F.col("id"), (F.col("id") * 37 % 200).alias("k"))
    got = {r.id for r in classify.pilot(df, 20, ["k"], seed=5).collect()}
    by = {r.k: r.id for r in df.collect()}
    assert got == {by[p] for p in random.Random(5).sample(range(200), 20)}
    assert classify.pilot(df, 500, ["k"]).count() == 200


def test_redraw_asks_only_for_what_failed(spark, tmp_path):
    items = spark.createDataFrame([(1, "dot ball", None, "f1"), (2, "SIX off the bat", "A 6/0", "f2"), (3, "dot ball", "A 6/0", None)], "i int, event string, state string, fallback string").coalesce(1)
    log = tmp_path / "asked"

    def draw(rows, attempt):
        with open(log, "a") as f:
            f.write(f"{attempt}:{sorted(r['i'] for r in rows)}\n")
        texts = {1: {1: "Bowled him!", 2: "A huge six!", 3: None}, 2: {1: "Left alone\nmore", 3: "  "}, 3: {3: "They are 9/9"}}
        return [texts[attempt][r["i"]] for r in rows]

    got = {r.i: r.validated.asDict() for r in runs.redraw(items, draw).collect()}
    assert got[1] == {"line": "Left alone", "faithful": True, "source": "model", "attempts": 2, "reasons": []}
    assert got[2]["attempts"] == 1 and got[2]["line"] == "A huge six!"
    assert got[3] == {"line": None, "faithful": True, "source": "fallback", "attempts": 3, "reasons": ["score (9, 9) != state (6, 0)"]}
    assert log.read_text().split("\n")[:3] == ["1:[1, 2, 3]", "2:[1, 3]", "3:[3]"]
    assert runs.redraw(items.limit(0), draw).count() == 0
    regen = runs.regenerated(items.select("i", "event", "state", F.lit("old").alias("line"), F.lit("pairs").alias("source")), lambda rows, attempt: ["A huge six!\nx"] * len(rows))
    assert {(r.i, r.source, r.line, r.heuristic_ok) for r in regen.collect()} == {(1, "regen", "A huge six!", False), (2, "regen", "A huge six!", True), (3, "regen", "A huge six!", False)}


class Slow:
    """Ends at the second poll, answers in reverse, drops "c" and fails on "b"."""

    def __init__(self, folder):
        self.folder = str(folder)

    def submit(self, requests, key):
        import pathlib

        pathlib.Path(self.folder, key[:16]).write_text(json.dumps([r["custom_id"] for r in requests]))
        return key[:16]

    def poll(self, batch):
        import pathlib

        seen = pathlib.Path(self.folder, batch + ".seen")
        if not seen.exists():
            seen.write_text("")
            return None
        ids = json.loads(pathlib.Path(self.folder, batch).read_text())
        return [{"custom_id": i, "succeeded": i != "b", "text": f" {i}! ", "tokens_in": 3} for i in reversed(ids) if i != "c"]


def test_batches(spark, tmp_path):
    (tmp_path / "s").mkdir()
    service = Slow(tmp_path / "s")
    requests = spark.createDataFrame([(x,) for x in "abcde"], "custom_id string").coalesce(1)
    held = runs.submit(requests, service, f"{tmp_path}/held", size=2)
    assert sorted(r.n for r in held.collect()) == [1, 2, 2]
    got = {r.custom_id: (r.ok, r.text, r.tokens_in, r.cache_read) for r in runs.answered(requests, runs.collected(held, service, pause=0.01)).collect()}
    assert got == {"a": (True, "a!", 3, 0), "b": (False, None, 0, 0), "c": (False, None, 0, 0), "d": (True, "d!", 3, 0), "e": (True, "e!", 3, 0)}
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        runs.submit(requests, service, f"{tmp_path}/held")
    with pytest.raises(Exception, match="has not ended"):
        (tmp_path / "never").mkdir()
        runs.collected(runs.submit(requests.limit(1), Slow(tmp_path / "never"), f"{tmp_path}/never/held"), Slow(tmp_path / "never"), pause=0.01, patience=0.0).collect()


def test_message_text(spark):
    df = spark.createDataFrame([([("tool", "x"), ("text", " first "), ("text", "second")],), ([],), (None,)], "b array<struct<type: string, text: string>>")
    assert [r.t for r in df.select(runs.message_text(F.col("b")).alias("t")).collect()] == ["first", "", ""]


def say(row):
    if row["i"] % 5 == 0:
        raise errors.CallFailed("no answer")
    faithful = row["i"] % 2 == 0
    return {"text": json.dumps({"faithful": faithful, "severity": "none", "failure_modes": [], "persona_match": True, "confidence": "low", "explanation": ""}), "tokens_in": 1_000_000}


def test_judge_filter_fails_open_and_resumes(spark, tmp_path):
    pairs = spark.range(20).select(F.col("id").cast("int").alias("i"), (F.col("id") < 12).alias("risky"))
    # waves of 4 cost 3 dollars a call that is answered: the second wave passes the cap of 10
    kept, dropped, run = runs.judge_filter(pairs, F.col("risky"), say, PRICE, ["i"], f"{tmp_path}/j", 10.0, size=4)
    assert (run.waves, run.stopped, run.statuses) == (2, True, {"judged": 6, "failed": 2})
    assert sorted(r.i for r in dropped.collect()) == [1, 3, 7] and kept.count() == 17
    kept, dropped, run = runs.judge_filter(pairs, F.col("risky"), say, PRICE, ["i"], f"{tmp_path}/j", 10.0, size=4)
    assert (run.waves, run.statuses) == (1, {"judged": 3, "failed": 1})
    assert sorted(r.i for r in dropped.collect()) == [1, 3, 7, 9, 11]
    kept, dropped, run = runs.judge_filter(pairs, F.col("risky"), say, PRICE, ["i"], f"{tmp_path}/j", 10.0, size=4)
    assert run.waves == 0 and dropped.count() == 5
    kept, dropped, run = runs.judge_filter(pairs, F.lit(False), say, PRICE, ["i"], f"{tmp_path}/none", 10.0)
    assert kept.count() == 20 and dropped.count() == 0


def test_audit_run_judges_the_first_item_alone(spark, tmp_path):
    items = spark.range(1, 8).select(F.col("id").cast("int").alias("i"))
    judged, run = runs.audit_run(items, say, PRICE, ["i"], f"{tmp_path}/a", cap=2.0, size=3)
    assert (run.waves, run.stopped, run.spent) == (1, True, 3.0) and [r.i for r in judged.collect()] == [1]
    judged, run = runs.audit_run(items, say, PRICE, ["i"], f"{tmp_path}/a", cap=1e9, size=3)
    assert judged.count() == 7 and [r.i for r in judged.where("verdict is null").collect()] == [5]
    with pytest.raises(errors.BudgetExceeded):
        runs.affordable_or_raise(1_000_000, PRICE, 1.0)


def test_seed_copies_need_no_second_read(spark):
    lines = spark.createDataFrame([(1, "One two three four five six seven"), (2, "one two three"), (3, None)], "i int, line string")
    seeds = spark.createDataFrame([("zero one two three four five six",)], "text string")
    from seamfold.operators import textcheck

    assert {r.i: r.c for r in textcheck.with_copies(lines, seeds, "line", "c").collect()} == {1: True, 2: False, 3: False}
    assert {r.c for r in textcheck.with_copies(lines, seeds.limit(0), "line", "c").collect()} == {False}


MARKS = "key string, status string"


def test_snapshots_survive_what_breaks_off(spark, tmp_path, monkeypatch):
    table = Snapshots(spark, f"{tmp_path}/t", MARKS)
    assert table.read().count() == 0 and table.versions() == []
    assert table.commit(spark.createDataFrame([("a", "kept"), ("b", "failed")], MARKS)) == 1
    whole = Snapshots._publish
    monkeypatch.setattr(Snapshots, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        table.commit(spark.createDataFrame([("c", "kept")], MARKS))
    monkeypatch.setattr(Snapshots, "_publish", whole)
    assert table.versions() == [1] and table.read().count() == 2
    assert upserted(table, spark.createDataFrame([("b", "kept", 2), ("b", "failed", 1), ("c", "kept", 1)], MARKS + ", at int"), "key", "at") == 2
    assert {tuple(r) for r in table.read().collect()} == {("a", "kept"), ("b", "kept"), ("c", "kept")} and table.read(1).count() == 2
    with pytest.raises(errors.ConcurrentWrite):
        table.commit(table.read(), after=1)
    assert table.versions() == [1, 2]
    with pytest.raises(errors.BadDocument):
        table.read(9)


def test_rewrites_keep_a_log_of_what_was_dropped(spark, tmp_path, monkeypatch):
    pairs, log = Snapshots(spark, f"{tmp_path}/p", "id int, file string, line string"), Snapshots(spark, f"{tmp_path}/d", "id int, file string, line string, why string")
    pairs.commit(spark.createDataFrame([(i, f"f{i % 2}", f"l{i}") for i in range(6)], pairs.schema))
    bad = spark.createDataFrame([(1, "x"), (4, "y"), (9, "z")], "id int, why string")
    whole, calls = Snapshots._publish, []

    def once(self, number, name):
        calls.append(number)
        if len(calls) == 2:  # the log is there, the pairs are not
            raise RuntimeError("lost")
        whole(self, number, name)

    monkeypatch.setattr(Snapshots, "_publish", once)
    with pytest.raises(RuntimeError, match="lost"):
        rewrite_without(pairs, bad, ["id"], log)
    assert pairs.read().count() == 6
    assert rewrite_without(pairs, bad, ["id"], log) == 2
    assert sorted(r.id for r in pairs.read().collect()) == [0, 2, 3, 5]
    assert sorted((r.id, r.file, r.why) for r in log.read().collect()) == [(1, "f1", "x"), (4, "f0", "y")]


def test_a_damaged_manifest_is_no_empty_one(spark, tmp_path):
    schema = "match_id string, status string"
    spark.createDataFrame([("m", "built")], schema).write.parquet(f"{tmp_path}/m")
    part = next(p for p in (tmp_path / "m").iterdir() if p.name.startswith("part-"))
    part.write_bytes(b"PAR1 no parquet PAR1")
    for crc in (tmp_path / "m").glob(".*.crc"):
        crc.unlink()
    with pytest.raises(errors.BadDocument):
        sinks.load_manifest(spark, f"{tmp_path}/m", schema)
    assert sinks.load_manifest(spark, f"{tmp_path}/m", schema, damaged_is_empty=True).count() == 0


def test_scans(spark, tmp_path):
    assert readers.read_reference(spark, f"{tmp_path}/none.jsonl").count() == 0
    (tmp_path / "ref.jsonl").write_text('{"text": " a "}\nbare\n\n')
    assert sorted(r.text for r in readers.read_reference(spark, f"{tmp_path}/ref.jsonl").collect()) == ["a", "bare"]
    good = {"schema_version": 1, "match_id": "m", "ball_id": "0-0-1", "persona": "p", "bucket": "four", "split": "train", "messages": [{"role": "user", "content": "x"}], "more": 1}
    (tmp_path / "train.jsonl").write_text(json.dumps(good) + "\n")
    row = readers.read_examples(spark, "hub/name", "train", fetch=lambda name: str(tmp_path)).first()
    assert row.messages[0].content == "x" and row.split == "train"
    (tmp_path / "val.jsonl").write_text('{"match_id": "m"}\n')
    with pytest.raises(Exception, match="no example"):
        readers.read_examples(spark, str(tmp_path), "val").collect()
    (tmp_path / "rec.jsonl").write_text(json.dumps({"match_id": "m", "innings": 0, "over": 1, "state": {"score_runs": 4}, "unknown": 1}) + "\n")
    assert [(r.match_id, r.over, r.state.score_runs, r.ball_id) for r in readers.read_records(spark, f"{tmp_path}/rec.jsonl").collect()] == [("m", 1, 4, None)]
    matches = spark.createDataFrame([("a", None), ("b", "no innings")], "match_id string, invalid string")
    assert readers.good_matches(matches).count() == 1
    with pytest.raises(errors.BadDocument, match="no innings"):
        readers.good_matches(matches, required=True)


def test_writes_count_on_their_way(spark, tmp_path):
    rows = [("m1", 0, 0, 1), ("m1", 0, 0, 2), ("m1", 1, 0, 1), ("m2", 0, 0, 1)]
    df = spark.createDataFrame(rows, "match_id string, innings int, over int, ball_in_over int")
    assert sinks.write_records(df, f"{tmp_path}/r") == sinks.Written(4, 3, 2)
    assert sinks.write_records(df.limit(0), f"{tmp_path}/e") == sinks.Written(0, 0, 0)


def test_pages_list_all_defects(spark, tmp_path):
    v = "struct<faithful: boolean, severity: string, failure_modes: array<string>, persona_match: boolean, confidence: string, explanation: string>"
    n = 1500
    rows = [(i, "p", "b", "m", str(i), "e", "s", f"line {i:05d}", True, [], "pairs", (False, ["minor", "major"][i % 2], ["x"], True, "high", "y")) for i in range(n)]
    judged = spark.createDataFrame(rows, f"i int, persona string, bucket string, match_id string, ball_id string, event string, state string, line string, heuristic_ok boolean, heuristic_reasons array<string>, source string, verdict {v}")
    audit.write_outputs(judged, str(tmp_path), "r", "i")
    page = "\n".join(r.value for r in spark.read.text(f"{tmp_path}/r.catalog").collect())
    parts = sorted(p for p in (tmp_path / "r.catalog").iterdir() if p.name.startswith("part-"))
    text = "".join(p.read_text() for p in parts)
    assert page.count("- LINE: ") == n and text.startswith("# Failure-mode audit - r")
    at = [int(x.split()[-1]) for x in text.split("\n") if x.startswith("- LINE: ")]
    assert at == [*range(1, n, 2), *range(0, n, 2)]


def test_streamed_frames_equal_batch_frames_also_after_a_restart(spark, tmp_path):
    schema = "match_id string, seq long, line string, total long"
    lines = [("m1", i, f"ball {i} of m1", 7) for i in range(7)] + [("m2", i, f"x{i}", 3) for i in range(3)]
    batch = dataset.frames(spark.createDataFrame(lines, schema), ["match_id"], "seq", "line", done=F.col("match_id"))
    want = sorted(tuple(r) for r in batch.collect())

    def arrive(*which):
        spark.createDataFrame([lines[k] for k in which], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def go():
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        live = replay.live_frames(stream, ["match_id"], "seq", "line", "total", done=F.col("match_id"))
        replay.run_once(live, f"{tmp_path}/out", f"{tmp_path}/at").awaitTermination()
        return sorted(tuple(r)[:5] for r in spark.read.parquet(f"{tmp_path}/out").select(*batch.columns, "due").collect())

    arrive(0, 1, 3, 4, 7)
    first = go()
    assert {r[1] for r in first if r[0] == "m1"} == {0, 1} and not any(r[3] == "done" for r in first)  # 3 and 4 wait for 2
    arrive(2, 2, 1, 8, 9)
    second = go()
    assert {r[1] for r in second if r[0] == "m1"} == {0, 1, 2, 3, 4} and ("m2", 3, 0, "done", "m2") in second
    arrive(5, 6, 0)
    assert go() == want and go() == want


def test_increments_of_innings_that_stop_and_start(spark):
    """Two balls by two, with an innings that gets none in between, against the fold at once."""
    delivery = lambda k: {"batter": f"p{k % 3}", "bowler": "b0" if k < 6 else "b1", "non_striker": "q", "runs": {"batter": k % 5, "extras": 0, "total": k % 5}, "wickets": [{"player_out": f"p{k % 3}", "kind": "bowled"}] if k in (1, 2, 4, 7) else None}
    overs = [{"over": o, "deliveries": [delivery(6 * o + k) for k in range(6)]} for o in range(2)]
    doc = {"info": {"balls_per_over": 6, "overs": 2, "teams": ["A", "B"], "registry": {"people": {"p0": "id0"}}}, "innings": [{"team": "A", "overs": overs}, {"team": "B", "target": {"runs": 20, "overs": 2}, "overs": overs[:1]}]}
    from seamfold import schemas

    df = spark.createDataFrame([("m", json.dumps(doc))], "match_id string, doc string").select("match_id", F.from_json("doc", schemas.MATCH).alias("d")).select("match_id", "d.*")
    balls = fold.explode_balls(df)
    figures = ["innings", "over_at", "ball_in_over", "score_runs", "score_wickets", "legal_ball_number", "legal_ball_in_over", "striker_runs", "striker_balls", "bowler_runs", "bowler_wickets", "bowler_on_hat_trick", "partnership_runs", "partnership_balls", "last_deliveries", "required_run_rate", "milestones"]
    want = sorted(map(str, (tuple(r) for r in fold.innings_state(balls).select(*figures).collect())))
    assert any("True" in x for x in want)
    carried, got = None, []
    for upto in ((2, 0), (4, 0), (6, 3), (9, 6), (12, 6)):
        place = F.col("over_at") * 6 + F.col("ball_in_over")
        come = balls.where(F.when(F.col("innings") == 0, place <= upto[0]).otherwise(place <= upto[1]))
        state = fold.innings_state(come if carried is None else fold.unseen(come, carried), carried)
        got += [tuple(r) for r in state.select(*figures).collect()]
        rows = fold.carry(state, carried)
        carried = spark.createDataFrame(rows.collect(), rows.schema)
    assert sorted(map(str, got)) == want


def test_lengths_of_rendered_chats(spark):
    df = spark.createDataFrame([(1, [("user", "hé"), ("assistant", "ok")]), (2, None)], "i int, m array<struct<role: string, content: string>>")
    text = runs.rendered(F.col("m"), lambda ms: "|".join(m["content"] for m in ms))
    got = {r.i: (r.t, r.n) for r in df.select("i", text.alias("t"), runs.token_length(text, lambda s: list(s.encode())).alias("n")).collect()}
    assert got == {1: ("hé|ok", 6), 2: (None, None)}


def test_costs_have_one_formula(spark):
    row = spark.createDataFrame([(100, 10, 5, 7, 3.0, 15.0)], "i int, r int, w int, o int, p double, q double").select(classify.call_cost(*(F.col(c) for c in "irwo"), F.col("p"), F.col("q"), batch=True).alias("c")).first()
    assert row.c == pytest.approx((100 * 3 + 10 * 0.3 + 5 * 6 + 7 * 15) / 2e6)
    assert classify.plan_cost(10, 1000, 10, 10, 3.0, 15.0) == budget.generation_estimate(10, PRICE, 1000, 10, 10, batch=False)
