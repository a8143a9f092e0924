import random

import pytest
from pyspark.sql import functions as F

from seamfold.functions.hashing import hash_split
from seamfold.functions.rounding import round_exact
from seamfold.operators import classify, dataset, effects, metrics, textcheck

CASES = [
    ("A huge six, gone", "FOUR off the bat", "", ["calls a four a six"]),
    ("Six over the ropes", "FOUR off the bat", "", []),
    ("Cracking four through cover", "SIX off the bat", "", ["calls a six a four"]),
    ("Six down now", "dot ball", "x | A 40/6", []),
    ("55 for four and rebuilding", "1 run(s)", "", []),
    ("They want six an over", "dot ball", "", []),
    ("Inside six overs", "dot ball", "", []),
    ("What a maximum!", "dot ball", "", ["claims a six that did not happen"]),
    ("Bowled him!", "dot ball", "", ["claims a wicket that did not happen"]),
    ("Run out by yards", "WICKET, run out", "", []),
    ("They are 41/2", "dot ball", "x | A 40/2", ["score (41, 2) != state (40, 2)"]),
    ("Three down already", "dot ball", "x | A 40/2", ["wickets 3 != state 2"]),
    ("The third wicket to fall", "WICKET, bowled", "x | A 40/3", []),
    ("Drives one down the ground", "1 run(s)", "x | A 40/3", []),
    ("5 more needed from 4 balls", "dot ball", "x | need 6 off 4", ["equation (5, 4) != state (6, 4)"]),
    ("He has 27 off 24", "dot ball", "x | need 6 off 4", []),
]


def test_check_on_columns(spark):
    df = spark.createDataFrame([(*c[:3], i) for i, c in enumerate(CASES)] + [(None, None, None, 99)], "l string, e string, s string, i int")
    got = {r.i: list(r.c.reasons) for r in df.select("i", textcheck.check(F.col("l"), F.col("e"), F.col("s")).alias("c")).collect()}
    assert got == {i: c[3] for i, c in enumerate(CASES)} | {99: []}


def test_rounding_is_exact(spark):
    rates = [r * 6 / b for r in range(1, 120) for b in range(1, 90)] + [0.125, 0.375, 2.675, 1.005, 0.0]
    df = spark.createDataFrame([(x,) for x in rates], "x double").select("x", round_exact(F.col("x")).alias("r"), round_exact(F.col("x"), 4).alias("q"))
    assert all(r.r == round(r.x, 2) and r.q == round(r.x, 4) for r in df.collect())


def test_split_shares(spark):
    got = {r.s: r["count"] for r in spark.range(5000).select(hash_split(F.col("id")).alias("s")).groupBy("s").count().collect()}
    assert 0.74 < got["train"] / 5000 < 0.86 and got["val"] and got["test"]
    assert spark.range(50).where(hash_split(F.col("id"), 0, 0) != "train").count() == 0


def test_draws_match_a_sorted_list(spark):
    rows = [("a", f"k{i:03d}") for i in range(40)] + [("b", f"k{i:03d}") for i in range(3)]
    df = spark.createDataFrame(rows, "s string, k string")
    got = sorted(tuple(r) for r in classify.stratified_sample(df, "s", ["k"], [("a", 10), ("b", 5)], 17).collect())
    rng = random.Random(17)
    want = sorted([*rng.sample(sorted(r for r in rows if r[0] == "a"), 10), *(r for r in rows if r[0] == "b")])
    assert got == want


def test_diversity(spark):
    df = spark.createDataFrame([("g", "a b c"), ("g", "A b"), ("g", "a b"), ("h", "")], "k string, t string")
    got = {r.k: tuple(r)[1:] for r in metrics.diversity(df, "t", ["k"]).collect()}
    assert got == {"g": (3, round(3 / 7, 4), 0.5, round(1 / 3, 4)), "h": (1, 0.0, 0.0, 0.0)}


def test_overlap_needs_six_words(spark):
    lines = spark.createDataFrame([(1, "one two three four five six"), (2, "one two three four five")], "i int, text string")
    assert [r.i for r in textcheck.overlapping(lines, lines.where("i = 1"), "i").collect()] == [1]


def test_examples_and_verdicts(spark):
    pairs = spark.createDataFrame([("m", "0-0-1", "plain", "four", "e", "s", "c")], "match_id string, ball_id string, persona string, bucket string, event string, state string, commentary string")
    row = dataset.examples(pairs, {"plain": "Be plain."}).first()
    assert [m.content for m in row.messages] == ["Be plain.", "BALL: e\nSTATE: s", "c"]
    answers = spark.createDataFrame([('ok {"faithful": true, "severity": "major", "confidence": "high", "failure_modes": [], "persona_match": true, "explanation": ""} x',), ('{"faithful": true, "severity": "moderate", "confidence": "high", "failure_modes": [], "persona_match": true, "explanation": ""}',), ("none",)], "a string")
    assert [r.v is not None for r in answers.select(effects.parse_verdict(F.col("a")).alias("v")).collect()] == [True, False, False]


def test_costs():
    assert classify.affordable(1.0, 2.0, 0.1) == 0
    assert classify.plan_cost(0, 1000, 10, 10, 3.0, 15.0) == 0.01


FAMILIES = [
    ("Four down and they need a stand", None, "4", False, False),
    ("55 for four and counting", None, None, False, False),
    ("two for six in his spell", None, None, False, False),
    ("six an over from here", None, None, False, False),
    ("six runs per over", None, None, False, False),
    ("four balls left", None, None, False, False),
    ("the first six overs went well", None, None, False, False),
    ("162/4 now, and that is four more", ("162", "4"), None, False, True),
    ("162/four on the board", None, None, False, False),
    ("his second wicket from that over", None, None, False, False),
    ("the second-wicket partnership grows", None, None, False, False),
    ("the third wicket to fall", None, "3", False, False),
    ("they lose their fifth", None, "5", False, False),
    ("12 wickets down", None, "12", False, False),
    ("gets one down to the ropes", None, None, False, False),
    ("walks two down the track", None, None, False, False),
    ("Six overs gone, then a six!", None, None, True, False),
    ("٤١/٢ on the board", ("41", "2"), None, False, False),
    ("007/000123", ("7", "123"), None, False, False),
    ("9" * 60 + "/1", ("9" * 60, "1"), None, False, False),
]


def test_claims_by_family(spark):
    df = spark.createDataFrame([(i, x[0]) for i, x in enumerate(FAMILIES)], "i int, l string")
    got = {r.i: r.c for r in df.select("i", textcheck.claims(F.col("l")).alias("c")).collect()}
    for i, (line, score, fallen, six, four) in enumerate(FAMILIES):
        assert (got[i].score and tuple(got[i].score), got[i].fallen, got[i].six, got[i].four) == (score, fallen, six, four), line


def test_equations_by_context(spark):
    cases = [("they need 12 more runs to win from the last 9", ("12", "9")), ("He has 27 off 24 so far, and they need 11 off 6", ("11", "6")), ("27 off 24", None), ("required now: 5 from the final 3", ("5", "3")), ("a chase of 40 off 30", ("40", "30"))]
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(cases)], "i int, l string")
    got = {r.i: r.q and tuple(r.q) for r in df.select("i", textcheck.equation(F.col("l")).alias("q")).collect()}
    assert got == {i: w for i, (_, w) in enumerate(cases)}


def test_claims_of_very_long_lines(spark):
    lines = ["1" * 300_000, " " * 300_000, "need 5 " * 60_000, "six " * 60_000, "a " * 100_000 + "they are 41/2"]
    df = spark.createDataFrame([(x,) for x in lines], "l string")
    got = [r.c for r in df.select("l", textcheck.check(F.col("l"), F.lit("dot ball"), F.lit("A 40/2")).alias("c")).collect()]
    assert [list(c.reasons) for c in got] == [[], [], [], ["claims a six that did not happen"], ["score (41, 2) != state (40, 2)"]]


def test_checks_read_each_line_once(spark):
    df = spark.createDataFrame([("a", "b", "c")], "l string, e string, s string").select(textcheck.check(F.col("l"), F.col("e"), F.col("s")).alias("c")).select("c.ok", "c.reasons")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "regexp" not in plan and "split(" not in plan


def test_diversity_is_linear_in_a_line(spark):
    n = 200_000
    text = " ".join("abcdefghij"[i % 10] + "klm"[i % 3] for i in range(n))
    df = spark.createDataFrame([("g", text), ("g", "ak"), ("h", None), ("h", "12")], "k string, t string")
    got = {r.k: tuple(r)[1:] for r in metrics.diversity(df, "t", ["k"]).collect()}
    assert got == {"g": (2, round(30 / (n + 1), 4), round(30 / (n - 1), 4), 0.0), "h": (2, 0.0, 0.0, 0.5)}
