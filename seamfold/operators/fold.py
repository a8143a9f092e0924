"""Running state of ordered sequences by window functions.

All innings-level windows share one partitioning and order, so Spark plans one exchange
and one sort for them; actor-level windows keep that distribution and only sort again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Kinds credited to the bowler, kinds that are no dismissal.
CREDITED = ("bowled", "caught", "caught and bowled", "lbw", "stumped", "hit wicket")
NOT_OUT = ("retired hurt", "retired not out")
MARKS = (50, 100, 150)
NEAR = 10
LAST = 6
DEATH_OVERS = 5
DEFAULT_OVERS = 20
DEFAULT_POWERPLAY = 6
#: Balls that one task folds; each is a row of up to 1 kB in several sorts.
BALLS_PER_TASK = 50_000


def tasks(spark: SparkSession, balls: int) -> int:
    """How many tasks fold so many balls: their number grows with the input, not what one of them sorts.

    Shuffled balls are far smaller than sorted ones, so that partitions which are
    put together by their shuffled size would outgrow a task.
    """
    return max(spark.sparkContext.defaultParallelism, -(-balls // BALLS_PER_TASK))


def running(value: Column, keys: list, order: list) -> Column:
    return F.sum(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))


def islands(reset: Column, keys: list, order: list) -> Column:
    """The number of resets before a row: rows up to and with a reset share an island."""
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(reset.cast("int")).over(before), F.lit(0))


def streak_before(flag: Column, keys: list, order: list, length: int = 2) -> Column:
    """Whether the rows just before all have the flag."""
    w = Window.partitionBy(*keys).orderBy(*order)
    out = F.lit(True)
    for i in range(1, length + 1):
        out = out & F.coalesce(F.lag(flag, i).over(w), F.lit(False))
    return out


def trail(token: Column, keys: list, order: list, length: int = LAST) -> Column:
    return F.collect_list(token).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(length - 1), Window.currentRow))


def rate(total: Column, count: Column, unit: Column) -> Column:
    return F.when(count > 0, total * unit / count).otherwise(F.lit(0.0)).cast("double")


def phase(over: Column, powerplay: Column, overs: Column, last: int = DEATH_OVERS) -> Column:
    return F.when(over < powerplay, "powerplay").when(over >= overs - last, "death").otherwise("middle")


def milestones(striker_runs: Column, score: Column, on_streak: Column) -> Column:
    near = F.coalesce(*(F.when((striker_runs >= m - NEAR) & (striker_runs < m), F.lit(f"batter_nearing_{m}")) for m in MARKS))
    step = (F.floor(score / F.lit(50)) + 1) * 50
    team = F.when((score > 0) & (step - score <= NEAR), F.concat(F.lit("team_nearing_"), step.cast("string")))
    return F.filter(F.array(near, team, F.when(on_streak, F.lit("bowler_on_hat_trick"))), lambda x: x.isNotNull())


def explode_balls(matches: DataFrame) -> DataFrame:
    """One row a ball, in the order of the arrays: super overs are dropped before innings are counted."""
    i = matches.where("invalid is null" if "invalid" in matches.columns else "true").select("match_id", "info", F.posexplode(F.filter("innings", lambda x: ~F.coalesce(x.super_over, F.lit(False)))).alias("innings", "inns"))
    o = i.select("match_id", "info", "innings", "inns", F.posexplode("inns.overs").alias("over_at", "o"))
    b = o.select("match_id", "info", "innings", "inns", "over_at", F.col("o.over").alias("over"), F.posexplode("o.deliveries").alias("ball_at", "b"))
    bpo = F.when(F.coalesce("info.balls_per_over", F.lit(6)) == 0, 6).otherwise(F.coalesce("info.balls_per_over", F.lit(6)))
    match_overs = F.when(F.coalesce("info.overs", F.lit(0)) == 0, DEFAULT_OVERS).otherwise(F.col("info.overs"))
    spans = F.filter(F.coalesce("inns.powerplays", F.array()), lambda p: p["from"] <= 1.0)
    extras = {k: F.coalesce(F.col(f"b.extras.{k}"), F.lit(0)) for k in ("byes", "legbyes", "noballs", "penalty", "wides")}
    return b.select(
        "match_id", "innings", "over_at", "over", (F.col("ball_at") + 1).alias("ball_in_over"), "info", F.col("info.registry.people").alias("people"),
        F.col("inns.team").alias("batting_team"),
        F.coalesce(F.try_element_at(F.filter("info.teams", lambda t: t != F.col("inns.team")), F.lit(1)), F.lit("")).alias("bowling_team"),
        F.col("b.batter").alias("batter"), F.col("b.bowler").alias("bowler_name"), F.col("b.non_striker").alias("non_striker_name"),
        F.col("b.runs.batter").alias("runs_batter"), F.col("b.runs.extras").alias("runs_extras"), F.col("b.runs.total").alias("runs_total"),
        F.map_filter(F.create_map(*(x for k, v in extras.items() for x in (F.lit(k), v))), lambda _, v: v != 0).alias("extras"),
        ((extras["wides"] == 0) & (extras["noballs"] == 0)).alias("is_legal"),
        (F.col("b.runs.batter") + extras["wides"] + extras["noballs"]).alias("conceded"),
        F.coalesce("b.wickets", F.array()).alias("raw_wickets"), F.col("inns.target").alias("target"), bpo.alias("bpo"),
        F.coalesce("inns.target.overs", match_overs.cast("double")).alias("total_overs"),
        F.when(F.size(spans) > 0, F.floor(F.array_max(F.transform(spans, lambda p: p["to"]))).cast("int") + 1).otherwise(DEFAULT_POWERPLAY).alias("powerplay"),
    )


def unseen(balls: DataFrame, carried: DataFrame) -> DataFrame:
    """The balls of explode_balls that come after what an innings has carried."""
    last = carried.select("match_id", "innings", F.struct("over_at", "ball_in_over").alias("__last"))
    return balls.join(last, ["match_id", "innings"], "left").where(F.col("__last").isNull() | (F.struct("over_at", "ball_in_over") > F.col("__last"))).drop("__last")


def innings_state(balls: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """The state after each ball (the streak flag: before it), from explode_balls.

    With carried, the balls go on from there: each running figure starts from what its
    innings, over, batter, bowler or stand had, so that earlier balls need not be read again.
    """
    keys, order = ["match_id", "innings"], ["over_at", "ball_in_over"]
    sid, bid = (F.coalesce(F.try_element_at("people", F.col(c)), F.col(c)) for c in ("batter", "bowler_name"))
    legal = F.col("is_legal").cast("int")
    wickets = F.transform("raw_wickets", lambda w: F.struct(F.coalesce(F.try_element_at("people", w.player_out), w.player_out).alias("player_out_id"), w.player_out.alias("player_out_name"), w.kind.alias("kind"), w.kind.isin(*CREDITED).alias("credited_to_bowler")))
    credited = F.size(F.filter("raw_wickets", lambda w: w.kind.isin(*CREDITED)))
    out = F.size(F.filter("raw_wickets", lambda w: ~w.kind.isin(*NOT_OUT)))
    b = balls.withColumns({"sid": sid, "bid": bid, "wickets": wickets, "credited": credited, "outs": out, "fell": F.size("raw_wickets") > 0, "non_sid": F.coalesce(F.try_element_at("people", F.col("non_striker_name")), F.col("non_striker_name"))})
    if carried is not None:
        b = b.join(carried.select(*keys, F.struct(*(c for c in carried.columns if c not in keys)).alias("c")), keys, "left")

    def had(figure: Callable[[], Column], when: Callable[[], Column] | None = None) -> Column:
        """What was carried of a figure, 0 without."""
        if carried is None:
            return F.lit(0)
        return F.coalesce(figure() if when is None else F.when(when(), figure()), F.lit(0))

    of = lambda who, key, figure: lambda: F.try_element_at(F.col(f"c.{who}"), F.col(key))[figure]
    token = F.when(F.col("fell"), F.lit("W")).otherwise(F.col("runs_total").cast("string"))
    b = b.withColumns({
        "score_runs": running(F.col("runs_total"), keys, order) + had(lambda: F.col("c.score_runs")), "score_wickets": running(F.col("outs"), keys, order) + had(lambda: F.col("c.score_wickets")), "legal_ball_number": running(legal, keys, order) + had(lambda: F.col("c.legal_ball_number")),
        "last_deliveries": trail(token, keys, order), "stand": islands(F.col("fell"), keys, order) + had(lambda: F.col("c.stand") + F.col("c.fell").cast("int")),
    })
    if carried is not None:
        whole = F.concat(F.coalesce("c.last_deliveries", F.array().cast("array<string>")), "last_deliveries")
        b = b.withColumn("last_deliveries", F.slice(whole, F.greatest(F.size(whole) - LAST, F.lit(0)) + 1, F.lit(LAST)))
    over, striker, bowler, stand = [*keys, "over_at"], [*keys, "sid"], [*keys, "bid"], [*keys, "stand"]
    by_bowler = Window.partitionBy(*bowler).orderBy(*order)
    flag, none = F.col("credited") > 0, F.lit(None).cast("boolean")
    one, two = (none if carried is None else F.try_element_at(F.col("c.bowlers"), F.col("bid"))[k] for k in ("one", "two"))
    b = b.withColumns({
        "legal_ball_in_over": running(legal, over, ["ball_in_over"]) + had(lambda: F.col("c.legal_ball_in_over"), lambda: F.col("c.over_at") == F.col("over_at")),
        "striker_runs": running(F.col("runs_batter"), striker, order) + had(of("strikers", "sid", "runs")), "striker_balls": running(legal, striker, order) + had(of("strikers", "sid", "balls")),
        "bowler_runs": running(F.col("conceded"), bowler, order) + had(of("bowlers", "bid", "runs")), "bowler_balls": running(legal, bowler, order) + had(of("bowlers", "bid", "balls")), "bowler_wickets": running(F.col("credited"), bowler, order) + had(of("bowlers", "bid", "wickets")),
        "bowler_before": F.coalesce(F.lag(flag, 1).over(by_bowler), one, F.lit(False)),
        "bowler_before_that": F.coalesce(F.lag(flag, 2).over(by_bowler), F.when(F.row_number().over(by_bowler) == 1, two).otherwise(one), F.lit(False)),
        "partnership_runs": running(F.col("runs_total"), stand, order) + had(lambda: F.col("c.partnership_runs"), lambda: F.col("c.stand") == F.col("stand")), "partnership_balls": running(legal, stand, order) + had(lambda: F.col("c.partnership_balls"), lambda: F.col("c.stand") == F.col("stand")),
    })
    b = b.withColumn("bowler_on_hat_trick", F.col("bowler_before") & F.col("bowler_before_that"))
    chase = F.col("target").isNotNull()
    allotted = F.rint(F.col("total_overs") * F.col("bpo"))
    left = F.greatest(allotted.cast("int") - F.col("legal_ball_number"), F.lit(0))
    b = b.withColumns({"balls_left": left, "target_runs": F.col("target.runs")}).withColumn("runs_required", F.when(chase, F.greatest(F.col("target_runs") - F.col("score_runs"), F.lit(0))))
    b = b.withColumns({
        "current_run_rate": rate(F.col("score_runs"), F.col("legal_ball_number"), F.col("bpo")),
        "required_run_rate": F.when(chase, rate(F.col("runs_required"), F.col("balls_left"), F.col("bpo"))),
        "phase": phase(F.col("over"), F.col("powerplay"), F.floor(allotted / F.col("bpo"))),
        "milestones": milestones(F.col("striker_runs"), F.col("score_runs"), F.col("bowler_on_hat_trick")),
    })
    return b.drop("c", "bowler_before_that")


def carry(state: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """What the next balls of each innings start from, a row an innings: its last ball's figures, and each batter's and bowler's.

    carried: what was there before state's balls; innings without new balls stay as they are.
    """
    keys, at = ["match_id", "innings"], F.struct("over_at", "ball_in_over")
    figures = ["over_at", "ball_in_over", "score_runs", "score_wickets", "legal_ball_number", "legal_ball_in_over", "last_deliveries", "stand", "fell", "partnership_runs", "partnership_balls"]

    def by_player(who: str, key: str, **figure: str | Column) -> DataFrame:
        own = F.struct(*((F.col(c) if isinstance(c, str) else c).alias(k) for k, c in figure.items()))
        each = state.where(F.col(key).isNotNull()).groupBy(*keys, key).agg(F.max_by(own, at).alias("v"))
        return each.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(key, "v"))).alias(who))  # an innings has some dozen players

    new = state.groupBy(*keys).agg(F.max_by(F.struct(*figures), at).alias("x")).select(*keys, "x.*")
    new = new.join(by_player("strikers", "sid", runs="striker_runs", balls="striker_balls"), keys, "left")
    new = new.join(by_player("bowlers", "bid", runs="bowler_runs", balls="bowler_balls", wickets="bowler_wickets", one=F.col("credited") > 0, two="bowler_before"), keys, "left")
    if carried is None:
        return new
    o, n = carried.alias("o"), new.alias("n")
    joined = o.join(n, keys, "full")

    def both(who: str) -> Column:
        old, own = F.col(f"o.{who}"), F.col(f"n.{who}")
        kept = F.map_filter(old, lambda k, _: ~F.coalesce(F.map_contains_key(own, k), F.lit(False)))
        return F.when(old.isNull(), own).when(own.isNull(), old).otherwise(F.map_concat(kept, own)).alias(who)

    return joined.select(*keys, *(F.when(F.col("n.over_at").isNotNull(), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in figures), both("strikers"), both("bowlers"))
