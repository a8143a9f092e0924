"""Match documents built from the event table, and the fold and what follows it as queries with SQL.

Each user's events are a match: innings of 60 balls in overs of seven, so that overs, labels
and legal balls part ways. The SQL starts from the events and never sees a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seamfold import schemas
from seamfold.functions.folders import written
from seamfold.functions.hashing import SPLIT_SALT
from seamfold.functions.rounding import round_exact_sql
from seamfold.operators import budget, classify, dataset, fold, render
from seamfold.plans.suite import ORACLES, _t, query

KINDS = ("bowled", "caught", "run out", "retired hurt", "stumped")
STAGES = ("Final", "Qualifier 2", "Eliminator", "Some Other", None, None)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(match_id, info, innings): every user's events as a match document; dealt by match, so that the fold needs no exchange of its own."""
    name = lambda prefix, n: F.concat(F.lit(prefix), n.cast("string"))
    e = _t(spark, sf_dir, "events").withColumn("match_id", name("m", F.col("user_id")))
    e = e.repartition(fold.tasks(spark, e.count()), "match_id")
    k = F.row_number().over(Window.partitionBy("match_id").orderBy("ts", "event_id")) - 1
    e = e.withColumn("k", k).withColumns({"inn": F.floor(F.col("k") / 60), "at": F.col("k") % 60})
    e = e.withColumns({"over": F.floor(F.col("at") / 7).cast("int"), "bat": F.pmod(F.floor("value"), F.lit(7)).cast("int"), "wides": (F.col("event_type") == "signup").cast("int"), "noballs": (F.col("event_id") % 11 == 0).cast("int"), "legbyes": (F.col("event_id") % 13 == 0).cast("int")})
    extra = F.col("wides") + F.col("noballs") + F.col("legbyes")
    batter = name("p", F.col("event_id") % 3)
    kind = F.get(F.array(*map(F.lit, KINDS)), (F.col("event_id") % 5).cast("int"))
    delivery = F.struct(
        batter.alias("batter"), name("b", F.col("over") % 2).alias("bowler"), name("p", (F.col("event_id") + 1) % 3).alias("non_striker"),
        F.struct(F.col("bat").alias("batter"), extra.alias("extras"), (F.col("bat") + extra).alias("total")).alias("runs"), F.struct("wides", "noballs", "legbyes").alias("extras"),
        F.when(F.col("event_type") == "error", F.array(F.struct(batter.alias("player_out"), kind.alias("kind")))).alias("wickets"),
    )
    listed = lambda place, what: F.transform(F.array_sort(F.collect_list(F.struct(F.col(place), what.alias("x")))), lambda s: s.x)
    u = F.col("user_id")
    overs = e.groupBy("match_id", "user_id", "inn", "over").agg(listed("at", delivery).alias("deliveries"))
    innings = overs.groupBy("match_id", "user_id", "inn").agg(listed("over", F.struct("over", "deliveries")).alias("overs"))
    teams = F.array(name("A", u % 4), name("B", u % 4))
    one = F.struct(
        F.get(teams, (F.col("inn") % 2).cast("int")).alias("team"), "overs", F.when(F.col("inn") >= 1, F.struct((u % 50 + 60).alias("runs"), F.when(u % 2 == 1, 8.4).alias("overs"))).alias("target"),
        F.when(u % 3 == 1, F.array(F.struct(F.lit(0.1).alias("from"), F.lit(3.6).alias("to"), F.lit("mandatory").alias("type")))).alias("powerplays"), F.lit(False).alias("super_over"),
    )
    # a super over stands first in some matches and must not count
    none = F.array().cast("array<struct<over: int, deliveries: array<struct<batter: string>>>>")
    whole = innings.groupBy("match_id", "user_id").agg(listed("inn", one).alias("innings"), F.count("*").alias("n"))
    stage = F.get(F.array(*map(F.lit, STAGES)), (u % 6).cast("int"))
    info = F.struct(
        teams.alias("teams"), F.when(u % 3 != 0, 20).alias("overs"), F.lit("T20").alias("match_type"), (u % 5 + 2000).cast("string").alias("season"),
        F.struct(F.when(u % 2 == 0, "Cup").alias("name"), F.when(u % 7 != 0, u % 7).alias("match_number"), stage.alias("stage")).alias("event"),
        F.array(F.concat(F.lit("2008-04-"), F.lpad((u % 28 + 1).cast("string"), 2, "0"))).alias("dates"), F.struct(F.create_map(F.lit("p0"), F.lit("id0")).alias("people")).alias("registry"), F.struct(F.when(u % 4 == 0, name("A", u % 4)).alias("winner")).alias("outcome"),
    )
    super_over = F.when(u % 4 == 0, F.array(F.to_json(F.struct(F.lit("S").alias("team"), none.alias("overs"), F.lit(True).alias("super_over"))))).otherwise(F.array().cast("array<string>"))
    text = F.concat(F.lit('{"info":'), F.to_json(info), F.lit(',"innings":['), F.array_join(F.concat(super_over, F.transform("innings", lambda i: F.to_json(i))), ","), F.lit("]}"))
    return whole.select("match_id", F.from_json(text, schemas.MATCH).alias("d")).select("match_id", "d.info", "d.innings")


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold.innings_state(fold.explode_balls(documents(spark, sf_dir)))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.records(_state(spark, sf_dir))


_I = "PARTITION BY match_id, innings ORDER BY k ROWS UNBOUNDED PRECEDING"
_BOWL = "PARTITION BY match_id, innings, bowler ORDER BY k"
_CRR = "CASE WHEN legal_n > 0 THEN score * 6 / legal_n ELSE 0.0 END::DOUBLE"
_RRR = "CASE WHEN innings = 0 THEN NULL WHEN balls_left > 0 THEN runs_required * 6 / balls_left ELSE 0.0 END::DOUBLE"
_ROUND = "CASE WHEN user_id % 6 = 0 THEN 3 WHEN user_id % 6 = 1 THEN 2 WHEN user_id % 6 IN (2, 3) THEN 1 ELSE 0 END"
_LABEL = "over || '.' || legal_in_over || CASE WHEN wides > 0 THEN '+wide' WHEN noballs > 0 THEN '+no-ball' ELSE '' END"

BALLS = f"""WITH k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS k FROM events),
    b AS (SELECT 'm' || user_id AS match_id, user_id, k, k // 60 AS innings, (k % 60) // 7 AS over, k % 60 % 7 + 1 AS ball_in_over, 'p' || event_id % 3 AS striker, 'p' || (event_id + 1) % 3 AS non_striker,
        'b' || ((k % 60) // 7) % 2 AS bowler, floor(value)::BIGINT % 7 AS bat, (event_type = 'signup')::BIGINT AS wides, (event_id % 11 = 0)::BIGINT AS noballs, (event_id % 13 = 0)::BIGINT AS legbyes,
        CASE WHEN event_type = 'error' THEN {list(KINDS)}[event_id % 5 + 1] END AS kind, CASE WHEN (k // 60) % 2 = 0 THEN 'A' ELSE 'B' END || user_id % 4 AS team, CASE WHEN (k // 60) % 2 = 0 THEN 'B' ELSE 'A' END || user_id % 4 AS other FROM k),
    s AS (SELECT *, bat + wides + noballs + legbyes AS total, wides = 0 AND noballs = 0 AS legal, coalesce(kind IN ('bowled', 'caught', 'stumped'), false) AS credited, coalesce(kind <> 'retired hurt', false) AS gone, kind IS NOT NULL AS fell FROM b),
    t AS (SELECT *, sum(total) OVER i::BIGINT AS score, sum(gone::INT) OVER i::BIGINT AS wickets, sum(legal::INT) OVER i::BIGINT AS legal_n, coalesce(sum(fell::INT) OVER (PARTITION BY match_id, innings ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stand,
        sum(legal::INT) OVER (PARTITION BY match_id, innings, over ORDER BY k ROWS UNBOUNDED PRECEDING)::BIGINT AS legal_in_over, sum(bat) OVER a::BIGINT AS striker_runs, sum(legal::INT) OVER a::BIGINT AS striker_balls,
        sum(bat + wides + noballs) OVER o::BIGINT AS bowler_runs, sum(legal::INT) OVER o::BIGINT AS bowler_balls, sum(credited::INT) OVER o::BIGINT AS bowler_wickets, coalesce(lag(credited, 1) OVER ({_BOWL}), false) AND coalesce(lag(credited, 2) OVER ({_BOWL}), false) AS hat_trick,
        array_to_string(list(CASE WHEN fell THEN 'W' ELSE total::VARCHAR END) OVER (PARTITION BY match_id, innings ORDER BY k ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), ' ') AS last_six,
        CASE WHEN innings > 0 AND user_id % 2 = 1 THEN 50 ELSE 120 END AS allotted, CASE WHEN innings > 0 THEN 60 + user_id % 50 END AS target
        FROM s WINDOW i AS ({_I}), a AS (PARTITION BY match_id, innings, striker ORDER BY k ROWS UNBOUNDED PRECEDING), o AS ({_BOWL} ROWS UNBOUNDED PRECEDING)),
    v AS (SELECT *, sum(total) OVER p::BIGINT AS stand_runs, sum(legal::INT) OVER p::BIGINT AS stand_balls, greatest(allotted - legal_n, 0)::BIGINT AS balls_left, CASE WHEN target IS NOT NULL THEN greatest(target - score, 0)::BIGINT END AS runs_required FROM t WINDOW p AS (PARTITION BY match_id, innings, stand ORDER BY k ROWS UNBOUNDED PRECEDING)),
    w AS (SELECT *, {round_exact_sql(_CRR)} AS crr, {round_exact_sql(_RRR)} AS rrr, CASE WHEN over < CASE WHEN user_id % 3 = 1 THEN 4 ELSE 6 END THEN 'powerplay' WHEN over >= allotted // 6 - 5 THEN 'death' ELSE 'middle' END AS phase,
        concat_ws(',', CASE WHEN striker_runs BETWEEN 40 AND 49 THEN 'batter_nearing_50' WHEN striker_runs BETWEEN 90 AND 99 THEN 'batter_nearing_100' WHEN striker_runs BETWEEN 140 AND 149 THEN 'batter_nearing_150' END,
            CASE WHEN score > 0 AND (score // 50 + 1) * 50 - score <= 10 THEN 'team_nearing_' || (score // 50 + 1) * 50 END, CASE WHEN hat_trick THEN 'bowler_on_hat_trick' END) AS marks,
        CASE WHEN gone THEN 'WICKET, ' || kind WHEN bat = 6 THEN 'SIX off the bat' WHEN bat = 4 THEN 'FOUR off the bat' WHEN wides > 0 THEN 'wide' WHEN noballs > 0 THEN 'no-ball' WHEN total = 0 THEN 'dot ball' ELSE total || ' run(s)' END AS event FROM v),
    r AS (SELECT *, match_id AS m, innings || '-' || over || '-' || ball_in_over AS ball_id, CASE WHEN gone THEN 'wicket' WHEN hat_trick THEN 'hat_trick' WHEN bat = 4 THEN 'four' WHEN phase = 'death' AND rrr >= 12 THEN 'death_chase_pressure' WHEN bat = 6 THEN 'six'
            WHEN contains(marks, 'batter_nearing') OR (striker_runs - bat < 50 AND striker_runs >= 50) OR (striker_runs - bat < 100 AND striker_runs >= 100) OR (striker_runs - bat < 150 AND striker_runs >= 150) THEN 'batter_milestone'
            WHEN legal AND total = 0 AND (phase = 'death' OR coalesce(rrr >= 9, false)) THEN 'dot_under_pressure' WHEN phase = 'powerplay' AND bat <= 3 THEN 'powerplay_routine' WHEN runs_required BETWEEN 1 AND 12 AND balls_left BETWEEN 1 AND 12 THEN 'tight_finish'
            WHEN contains(marks, 'team_nearing') THEN 'team_milestone' WHEN phase = 'middle' AND bat BETWEEN 1 AND 3 THEN 'middle_routine' WHEN phase = 'death' THEN 'death_routine' END AS bucket,
        concat_ws(' | ', 'T20 ' || CASE WHEN user_id % 2 = 0 THEN 'Cup' ELSE (2000 + user_id % 5)::VARCHAR END, 'Inns ' || (innings + 1), {_LABEL}, team || ' ' || score || '/' || wickets, 'need ' || runs_required || ' off ' || balls_left, 'CRR ' || crr || coalesce(' RRR ' || rrr, ''),
            'Striker ' || striker || ' ' || striker_runs || '(' || striker_balls || ')', 'Bowler ' || bowler || ' ' || bowler_wickets || '/' || bowler_runs, 'P''ship ' || stand_runs || '(' || stand_balls || ')', 'Last ' || last_six, phase, CASE WHEN marks <> '' THEN 'nearing: ' || marks END) AS state_string FROM w)
    """

_FIGURES = ("score_runs", "score_wickets", "legal_ball_number", "legal_ball_in_over", "striker_runs", "striker_balls", "bowler_runs", "bowler_balls", "bowler_wickets", "partnership_runs", "partnership_balls", "balls_left", "runs_required", "target_runs")


@query(f"""{BALLS} SELECT match_id, innings, over, ball_in_over, score AS score_runs, wickets AS score_wickets, legal_n AS legal_ball_number, legal_in_over AS legal_ball_in_over, striker_runs, striker_balls, bowler_runs, bowler_balls, bowler_wickets,
    stand_runs AS partnership_runs, stand_balls AS partnership_balls, balls_left, runs_required, target AS target_runs, {_CRR} AS current_run_rate, {_RRR} AS required_run_rate, hat_trick AS bowler_on_hat_trick, phase, marks AS milestones, last_six AS last_deliveries,
    CASE WHEN striker = 'p0' THEN 'id0' ELSE striker END AS striker_id, team AS batting_team, other AS bowling_team, kind, credited, legbyes > 0 AS has_legbyes FROM w""")
def innings_fold(spark, sf_dir):
    """The whole fold: every figure of the state after each ball, from match documents."""
    return _figures(_state(spark, sf_dir))


def _figures(state: DataFrame) -> DataFrame:
    first = F.try_element_at("wickets", F.lit(1))
    return state.select(
        "match_id", F.col("innings").cast("long"), F.col("over").cast("long"), F.col("ball_in_over").cast("long"), *(F.col(c).cast("long").alias(c) for c in _FIGURES), "current_run_rate", "required_run_rate", "bowler_on_hat_trick", "phase",
        F.array_join("milestones", ",").alias("milestones"), F.array_join("last_deliveries", " ").alias("last_deliveries"), F.col("sid").alias("striker_id"), "batting_team", "bowling_team", first.kind.alias("kind"), F.coalesce(first.credited_to_bowler, F.lit(False)).alias("credited"), F.map_contains_key("extras", "legbyes").alias("has_legbyes"),
    )


@query(ORACLES["innings_fold"])
def innings_increments(spark, sf_dir):
    """The same in three increments, each of which starts from what the one before it has carried.

    Balls and states are written once, since several steps read them, and dealt by innings for
    every join and window.
    """
    balls = written(fold.explode_balls(documents(spark, sf_dir)).drop("info"), "balls")
    n = fold.tasks(spark, balls.count())
    carried, out, at = None, None, F.col("over_at") * 7 + F.col("ball_in_over")
    for upto in (5 + F.col("innings") * 9, 31 + F.length("match_id"), F.lit(1000)):
        come = balls.where(at <= upto).repartition(n, "match_id", "innings")
        state = fold.innings_state(come) if carried is None else fold.innings_state(fold.unseen(come, carried), carried)
        state = written(state.drop("people", "raw_wickets"), "state")
        out = _figures(state) if out is None else out.unionByName(_figures(state))
        carried = written(fold.carry(state.repartition(n, "match_id", "innings"), carried), "carried")
    return out


@query(f"""{BALLS} SELECT match_id, ball_id, state_string, event, bucket, CASE WHEN event LIKE 'WICKET%' THEN 'Wicket. ' || striker || ' ' || kind WHEN bat = 6 THEN striker || ' clears the rope for six' WHEN bat = 4 THEN striker || ' finds the boundary for four'
    WHEN event = 'wide' THEN 'Wide, an extra to the total' WHEN event = 'no-ball' THEN 'No-ball, an extra to the total' WHEN event = 'dot ball' THEN 'Beaten, no run there' WHEN total = 1 THEN striker || ' pushes a single' ELSE striker || ' works it for ' || total || ' runs' END || '. ' || team || ' ' || score || '/' || wickets || '.' AS fallback FROM r""")
def record_lines(spark, sf_dir):
    """Records: their ids, state lines, event phrases, classes and fallback lines."""
    event = render.record_event()
    return _records(spark, sf_dir).select("match_id", "ball_id", "state_string", event.alias("event"), classify.bucket().alias("bucket"), render.fallback_line(event).alias("fallback"))


@query(f"""{BALLS} SELECT match_id, ball_id, (innings + 1)::INT AS innings, over || '.' || (legal_n - 6 * over) AS over, team AS batting_team, other AS bowling_team, score || '/' || wickets AS score, score::INT AS runs, wickets::INT AS wickets, striker, striker_runs::INT AS striker_runs, striker_balls::INT AS striker_balls, bowler,
    bowler_wickets || '/' || bowler_runs AS bowler_figures, crr AS current_run_rate, rrr AS required_run_rate, target::INT AS target, runs_required::INT AS runs_required, balls_left::INT AS balls_left, last_six AS last_deliveries, phase, event FROM r""")
def scoreboards(spark, sf_dir):
    return _records(spark, sf_dir).select(*render.scoreboard()).withColumn("last_deliveries", F.array_join("last_deliveries", " "))


@query(f"{BALLS} SELECT bucket, count(*) AS n FROM r GROUP BY bucket")
def class_counts(spark, sf_dir):
    return _records(spark, sf_dir).select(classify.bucket().alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


_P = f"('0x' || left(sha256('{SPLIT_SALT}' || match_id), 8))::UBIGINT / 4294967295.0::DOUBLE"


@query(f"{BALLS} SELECT match_id, ball_id, bucket, event, state_string AS state FROM r WHERE bucket IS NOT NULL AND {_P} >= 0.1::DOUBLE + 0.1::DOUBLE")
def train_candidates(spark, sf_dir):
    """Classified balls of the matches of the training split."""
    return classify.candidates(_records(spark, sf_dir))


@query()
def drawn_candidates(spark, sf_dir):
    """A stratified draw, the secondary subset of it, and a pilot of the plan, by size."""
    records = _records(spark, sf_dir)
    primary = classify.draw(classify.candidates(records), 200)
    some = classify.secondary_subset(primary)
    both = primary.withColumn("kind", F.lit("primary")).unionByName(some.withColumn("kind", F.lit("secondary")))
    return both.unionByName(classify.pilot(both, 20, ["kind", "match_id", "ball_id"]).withColumn("kind", F.lit("pilot"))).groupBy("kind", "bucket").agg(F.count("*").alias("n"))


@query(f"""{BALLS} SELECT match_id, min_by(team, (innings, k)) AS first_team, min_by(other, (innings, k)) AS second_team, max(innings) + 1 AS innings, count(*) AS balls FROM b GROUP BY match_id""")
def match_list(spark, sf_dir):
    s = dataset.summaries(_records(spark, sf_dir), ["over", "ball_in_over"])
    return s.select("match_id", F.col("teams")[0].alias("first_team"), F.col("teams")[1].alias("second_team"), F.col("innings").cast("long").alias("innings"), "balls")


@query(f"""WITH m AS (SELECT user_id, 'm' || user_id AS match_id, count(*) AS balls, {_ROUND} AS round, user_id % 7 AS place, '2008-04-' || lpad((user_id % 28 + 1)::VARCHAR, 2, '0') AS iso, (2000 + user_id % 5)::VARCHAR AS season, CASE WHEN user_id % 4 = 0 THEN 'A' || user_id % 4 ELSE '' END AS winner
        FROM events WHERE user_id % 2 = 0 GROUP BY user_id)
    SELECT season, coalesce(min_by(winner, (round, place, iso, match_id)) FILTER (user_id % 6 = 0), '') AS champion, count(*) AS n, string_agg(match_id || ' ' || strftime(iso::DATE, '%-d %b %Y') || ' ' || balls || ' r' || round, ';' ORDER BY round, place, iso, match_id) AS matches FROM m GROUP BY season""")
def catalog(spark, sf_dir):
    """A competition's matches by season, in the order of rounds, numbers and dates, with its champion."""
    docs = documents(spark, sf_dir)
    stats = dataset.summaries(render.records(fold.innings_state(fold.explode_balls(docs))), ["over", "ball_in_over"])
    c = dataset.catalog(dataset.catalog_matches(docs, stats, "Cup"))
    shown = lambda m: F.concat_ws(" ", m.match_id, m.date, m.balls.cast("string"), F.concat(F.lit("r"), m.round.cast("string")))
    return c.select("season", "champion", F.size("matches").cast("long").alias("n"), F.array_join(F.transform("matches", shown), ";").alias("matches"))


@query(f"""{BALLS}, f AS (SELECT match_id, k, event, state_string, string_split(event, ' ') AS t FROM r)
    SELECT match_id, k AS seq, 0 AS frame, 'state' AS kind, 'event: state' || chr(10) || 'data: ' || state_string || chr(10) || chr(10) AS wire FROM f UNION ALL
    SELECT match_id, k, i, 'token', 'event: token' || chr(10) || 'data: {{"t":"' || CASE WHEN i > 1 THEN ' ' ELSE '' END || t[i] || '"}}' || chr(10) || chr(10) FROM (SELECT match_id, k, t, unnest(range(1, len(t) + 1)) AS i FROM f) UNION ALL
    SELECT match_id, k, len(t) + 1, 'ball', 'event: ball' || chr(10) || 'data: ' || event || chr(10) || chr(10) FROM f UNION ALL
    SELECT match_id, max(k) + 1, 0, 'done', 'event: done' || chr(10) || 'data: {{"match_id":"' || match_id || '"}}' || chr(10) || chr(10) FROM f GROUP BY match_id""")
def replay_stream(spark, sf_dir):
    """Every match as a stream of events: the state, the line in pieces, the ball, and an end."""
    place = F.col("innings") * 60 + F.col("over") * 7 + F.col("ball_in_over") - 1
    lines = _records(spark, sf_dir).withColumns({"seq": place.cast("long"), "line": render.record_event()})
    f = dataset.frames(lines, ["match_id"], "seq", "line", state=F.col("state_string"), done=F.to_json(F.struct("match_id")))
    return dataset.stream(f).select("match_id", "seq", F.col("frame").cast("long").alias("frame"), "kind", "wire")


@query(f"""{BALLS}, c AS (SELECT match_id, k, total * 1000 + 7 AS cost, CASE WHEN k < 1 THEN k ELSE (k - 1) // 6 + 1 END AS wave FROM r), x AS (SELECT match_id, wave, sum(cost) AS cost FROM c GROUP BY match_id, wave),
    y AS (SELECT match_id, wave, coalesce(sum(cost) OVER (PARTITION BY match_id ORDER BY wave ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS spent FROM x)
    SELECT c.match_id, k, c.wave, spent FROM c JOIN y ON c.match_id = y.match_id AND c.wave = y.wave WHERE spent < 60000""")
def wave_budget(spark, sf_dir):
    """Waves of six after one item alone, each started while what earlier ones spent is below a cap."""
    k = (F.col("innings") * 60 + F.col("over") * 7 + F.col("ball_in_over") - 1).cast("long")
    items = _records(spark, sf_dir).select("match_id", k.alias("k"), (F.col("delivery.runs_total") * 1000 + 7).cast("long").alias("cost"))
    return budget.spent_before_wave(items, "cost", ["match_id"], ["k"], 6, alone=1).where("spent < 60000").select("match_id", "k", "wave", "spent")
