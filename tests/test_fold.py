"""The whole fold on a small match: values worked out by hand."""

import json

import pytest
from pyspark.sql import functions as F

from seamfold.operators import classify, fold, render
from seamfold.sources import readers


def ball(batter, bat, extra=0, total=None, non="N", **more):
    return {"batter": batter, "bowler": more.pop("bowler", "P"), "non_striker": non, "runs": {"batter": bat, "extras": extra, "total": bat + extra if total is None else total}, **more}


def match(**info):
    first = [
        ball("A", 4), ball("A", 1), ball("N", 0, 1, extras={"wides": 1}, non="A"), ball("N", 0, non="A"), ball("N", 1, 1, extras={"noballs": 1}, non="A"),
        ball("N", 0, non="A", wickets=[{"player_out": "N", "kind": "bowled"}]), ball("C", 6, non="A"), ball("C", 1, non="A"),
    ]
    second = [ball("X", 1, bowler="Q"), ball("Y", 4, bowler="Q"), ball("Y", 0, bowler="Q", wickets=[{"player_out": "X", "kind": "run out"}])]
    base = {"teams": ["One", "Two"], "overs": 1, "match_type": "T20", "season": "2007/08", "registry": {"people": {"A": "a1"}}}
    return {"info": base | info, "innings": [
        {"team": "One", "overs": [{"over": 0, "deliveries": first}]},
        {"team": "One", "super_over": True, "overs": [{"over": 0, "deliveries": [ball("A", 6)]}]},
        {"team": "Two", "target": {"runs": 16, "overs": 1}, "overs": [{"over": 0, "deliveries": second}]},
    ]}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("m")
    (d / "m1.json").write_text(json.dumps(match()))
    (d / "bad.json").write_text("{oops")
    (d / "short.json").write_text(json.dumps({"info": {"season": 2020}, "innings": []}))
    return str(d)


def test_validity_and_selection(spark, folder):
    m = readers.read_matches(spark, folder)
    assert {r.match_id: r.invalid for r in m.collect()} == {"m1": None, "bad": "malformed", "short": "info.teams"}
    assert [r.match_id for r in readers.select_matches(m, season="2007/08", limit=5).collect()] == ["m1"]
    assert readers.select_matches(m, limit=0).count() == 0
    assert readers.file_hashes(spark, folder).count() == 3


def test_state(spark, folder):
    s = fold.innings_state(fold.explode_balls(readers.read_matches(spark, folder)))
    rows = render.records(s).orderBy("innings", "over", "ball_in_over").collect()
    assert [r.ball_id for r in rows] == [f"0-0-{i}" for i in range(1, 9)] + [f"1-0-{i}" for i in range(1, 4)]
    st = [r.state for r in rows]
    assert [x.score_runs for x in st] == [4, 5, 6, 6, 8, 8, 14, 15, 1, 5, 5]
    assert [x.score_wickets for x in st] == [0] * 5 + [1] * 3 + [0, 0, 1]
    assert [r.legal_ball_number for r in rows] == [1, 2, 2, 3, 3, 4, 5, 6, 1, 2, 3]
    assert [(x.striker_runs, x.striker_balls) for x in st][:8] == [(4, 1), (5, 2), (0, 0), (0, 1), (1, 1), (1, 2), (6, 1), (7, 2)]
    assert [(x.bowler_wickets, x.bowler_runs) for x in st][-4:] == [(1, 15), (0, 1), (0, 5), (0, 5)]
    assert [(x.partnership_runs, x.partnership_balls) for x in st][5:8] == [(8, 4), (6, 1), (7, 2)]
    assert [x.current_run_rate for x in st] == [24.0, 15.0, 18.0, 12.0, 16.0, 12.0, 16.8, 15.0, 6.0, 15.0, 10.0]
    assert [x.required_run_rate for x in st][8:] == [18.0, 16.5, 22.0]
    assert st[6].last_deliveries == ["1", "1", "0", "2", "W", "6"]
    assert {x.phase for x in st} == {"powerplay"}
    assert rows[0].striker.id == "a1" and rows[2].striker.id == "N" and rows[8].bowling_team == "One"
    assert rows[2].state_string.startswith("T20 2007/08 | Inns 1 | 0.2+wide | One 6/0 | CRR 18.0 | Striker N 0(0)")
    assert " | need 15 off 5 | CRR 6.0 RRR 18.0 | " in rows[8].state_string


def test_events_and_buckets(spark, folder):
    r = render.records(fold.innings_state(fold.explode_balls(readers.read_matches(spark, folder))))
    e = render.record_event()
    got = [tuple(x) for x in r.select(e, classify.bucket(), render.fallback_line(e)).orderBy("innings", "ball_in_over").collect()]
    assert [g[0] for g in got][:7] == ["FOUR off the bat", "1 run(s)", "wide", "dot ball", "no-ball", "WICKET, bowled", "SIX off the bat"]
    assert [g[1] for g in got][:7] == ["four", "powerplay_routine", "powerplay_routine", "powerplay_routine", "powerplay_routine", "wicket", "six"]
    assert got[5][2] == "Wicket. N bowled. One 8/1." and got[2][2] == "Wide, an extra to the total. One 6/0."
    assert r.select(*render.scoreboard()).count() == 11


def test_streak_runs_through_a_credited_wide(spark):
    rows = [(1, i, c) for i, c in enumerate([True, True, False, True, True, True])]
    df = spark.createDataFrame(rows, "k int, i int, c boolean")
    assert [x[0] for x in df.select(fold.streak_before(F.col("c"), ["k"], ["i"]), "i").orderBy("i").collect()] == [False, False, True, False, False, True]
