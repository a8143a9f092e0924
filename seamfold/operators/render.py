"""Strings and records out of running state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamfold.functions.rounding import round_exact
from seamfold.operators.fold import NOT_OUT


def ball_id() -> Column:
    return F.concat_ws("-", "innings", "over", "ball_in_over")


def over_label() -> Column:
    base = F.concat_ws(".", "over", "legal_ball_in_over")
    return F.when(F.col("is_legal"), base).when(F.map_contains_key("extras", "wides"), F.concat(base, F.lit("+wide"))).when(F.map_contains_key("extras", "noballs"), F.concat(base, F.lit("+no-ball"))).otherwise(F.concat(base, F.lit("+extra")))


def competition_label() -> Column:
    full = lambda c: F.when(c != "", c)
    label = F.concat_ws(" ", full(F.col("info.match_type")), F.coalesce(full(F.col("info.event.name")), F.col("info.season")))
    return F.when(label == "", "match").otherwise(label)


def state_string() -> Column:
    text = lambda *parts: F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))
    s = lambda c: F.col(c).cast("string")
    rates = text("CRR ", round_exact(F.col("current_run_rate")).cast("string"), F.coalesce(text(" RRR ", round_exact(F.col("required_run_rate")).cast("string")), F.lit("")))
    return F.concat_ws(
        " | ", competition_label(), text("Inns ", (F.col("innings") + 1).cast("string")), over_label(), text(s("batting_team"), " ", s("score_runs"), "/", s("score_wickets")),
        F.when(F.col("runs_required").isNotNull(), text("need ", s("runs_required"), " off ", s("balls_left"))), rates,
        text("Striker ", s("batter"), " ", s("striker_runs"), "(", s("striker_balls"), ")"), text("Bowler ", s("bowler_name"), " ", s("bowler_wickets"), "/", s("bowler_runs")),
        text("P'ship ", s("partnership_runs"), "(", s("partnership_balls"), ")"), F.when(F.size("last_deliveries") > 0, text("Last ", F.array_join("last_deliveries", " "))), F.col("phase"),
        F.when(F.size("milestones") > 0, text("nearing: ", F.array_join("milestones", ","))),
    )


def records(state: DataFrame) -> DataFrame:
    """The versioned per-ball record of innings_state rows."""
    who = lambda i, n: F.struct(F.col(i).alias("id"), F.col(n).alias("name"))
    fields = ("score_runs", "score_wickets", "balls_left", "target_runs", "runs_required", "striker_runs", "striker_balls", "bowler_runs", "bowler_balls", "bowler_wickets", "partnership_runs", "partnership_balls")
    return state.select(
        F.lit(1).alias("schema_version"), "match_id", ball_id().alias("ball_id"), "innings", "over", "ball_in_over", F.col("legal_ball_number").cast("int").alias("legal_ball_number"), "is_legal", "batting_team", "bowling_team",
        who("sid", "batter").alias("striker"), who("non_sid", "non_striker_name").alias("non_striker"), who("bid", "bowler_name").alias("bowler"),
        F.struct("runs_batter", "runs_extras", "runs_total", "extras", "wickets").alias("delivery"),
        F.struct(*(F.col(f).cast("int").alias(f) for f in fields), round_exact(F.col("current_run_rate")).alias("current_run_rate"), round_exact(F.col("required_run_rate")).alias("required_run_rate"), "bowler_on_hat_trick", "last_deliveries", "phase", "milestones").alias("state"),
        state_string().alias("state_string"),
    )


def real_wicket(kinds: Column) -> Column:
    """The first kind that is a dismissal, or null."""
    return F.try_element_at(F.filter(kinds, lambda k: ~k.isin(*NOT_OUT)), F.lit(1))


def event_phrase(runs_batter: Column, runs_total: Column, extras: Column, kinds: Column) -> Column:
    # fixed values: the phrases that texts are checked against
    out = real_wicket(kinds)
    return (
        F.when(out.isNotNull(), F.concat(F.lit("WICKET, "), out))
        .when(runs_batter == 6, "SIX off the bat").when(runs_batter == 4, "FOUR off the bat")
        .when(F.map_contains_key(extras, "wides"), "wide").when(F.map_contains_key(extras, "noballs"), "no-ball")
        .when(runs_total == 0, "dot ball").otherwise(F.concat(runs_total.cast("string"), F.lit(" run(s)")))
    )


def record_event() -> Column:
    return event_phrase(F.col("delivery.runs_batter"), F.col("delivery.runs_total"), F.col("delivery.extras"), F.transform("delivery.wickets", lambda w: w.kind))


def fallback_line(event: Column) -> Column:
    """A line that states nothing but what the record holds; of records."""
    score = F.concat(F.col("batting_team"), F.lit(" "), F.col("state.score_runs").cast("string"), F.lit("/"), F.col("state.score_wickets").cast("string"))
    name, total = F.col("striker.name"), F.col("delivery.runs_total")
    out = F.coalesce(F.when(F.try_element_at("delivery.wickets", F.lit(1)).player_out_name != "", F.try_element_at("delivery.wickets", F.lit(1)).player_out_name), name)
    # fixed values: the sentences
    kind = F.coalesce(F.when(event.contains(", "), F.regexp_extract(event, "^.*?, (.*)$", 1)), F.lit("out"))
    head = (
        F.when(event.startswith("WICKET"), F.concat(F.lit("Wicket. "), out, F.lit(" "), kind))
        .when(event == "SIX off the bat", F.concat(name, F.lit(" clears the rope for six")))
        .when(event == "FOUR off the bat", F.concat(name, F.lit(" finds the boundary for four")))
        .when(event.isin("wide", "no-ball"), F.concat(F.upper(F.substring(event, 1, 1)), F.substring(event, 2, 100), F.lit(", an extra to the total")))
        .when(event == "dot ball", F.lit("Beaten, no run there"))
        .when(total == 1, F.concat(name, F.lit(" pushes a single")))
        .otherwise(F.concat(name, F.lit(" works it for "), total.cast("string"), F.lit(" runs")))
    )
    return F.concat(head, F.lit(". "), score, F.lit("."))


def scoreboard() -> list[Column]:
    """Display columns of a record; its over label counts six balls an over, whatever was bowled."""
    ball = F.col("legal_ball_number") - 6 * F.col("over")
    slash = lambda a, b: F.concat(F.col(a).cast("string"), F.lit("/"), F.col(b).cast("string"))
    return [
        F.col("match_id"), F.col("ball_id"), (F.col("innings") + 1).alias("innings"), F.concat(F.col("over").cast("string"), F.lit("."), ball.cast("string")).alias("over"), F.col("batting_team"), F.col("bowling_team"),
        slash("state.score_runs", "state.score_wickets").alias("score"), F.col("state.score_runs").alias("runs"), F.col("state.score_wickets").alias("wickets"),
        F.col("striker.name").alias("striker"), F.col("state.striker_runs"), F.col("state.striker_balls"), F.col("bowler.name").alias("bowler"), slash("state.bowler_wickets", "state.bowler_runs").alias("bowler_figures"),
        F.col("state.current_run_rate"), F.col("state.required_run_rate"), F.col("state.target_runs").alias("target"), F.col("state.runs_required"), F.col("state.balls_left"), F.col("state.last_deliveries"), F.col("state.phase"), record_event().alias("event"),
    ]


def scoreboard_json() -> Column:
    """The scoreboard as JSON, absent figures as nulls."""
    return F.to_json(F.struct(*scoreboard()), {"ignoreNullFields": "false"})


def token_chunks(line: Column) -> Column:
    return F.transform(F.split(line, " ", -1), lambda w, i: F.when(i == 0, w).otherwise(F.concat(F.lit(" "), w)))


def display_date(iso: Column) -> Column:
    return F.coalesce(F.date_format(F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")), "d MMM yyyy"), iso)


def sse(event: str, data: Column) -> Column:
    return F.concat(F.lit(f"event: {event}\ndata: "), data, F.lit("\n\n"))
