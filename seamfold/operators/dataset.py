"""Chat examples, catalogs and replays out of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamfold.errors import UnknownKey
from seamfold.functions.hashing import SPLIT_SALT, hash_split
from seamfold.operators.render import display_date, sse, token_chunks

# fixed values: rounds of stages, and the pace of a replay in seconds
ROUNDS = {"Semi Final": 1, "Qualifier 1": 1, "Eliminator": 1, "Elimination Final": 1, "3rd Place Play-Off": 1, "Qualifier 2": 2, "Final": 3}
PACE, SLOWEST = 1.8, 8.0


def user_turn(event: Column, state: Column) -> Column:
    """What a model is asked; fixed wording."""
    return F.concat(F.lit("BALL: "), event, F.lit("\nSTATE: "), state)


def examples(pairs: DataFrame, instructions: dict[str, str], val: float = 0.1, test: float = 0.1, salt: str = SPLIT_SALT) -> DataFrame:
    """Three-message chat examples with their split, decided by match so none straddles two; an unknown persona is an error."""
    prompt = F.create_map(*(F.lit(x) for kv in instructions.items() for x in kv))
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    system = F.coalesce(F.try_element_at(prompt, F.col("persona")), F.raise_error(F.concat(F.lit("unknown persona: "), F.coalesce("persona", F.lit("null")))).cast("string"))
    return pairs.select(F.lit(1).alias("schema_version"), "match_id", "ball_id", "persona", "bucket", hash_split(F.col("match_id"), val, test, salt).alias("split"), F.array(message("system", system), message("user", user_turn(F.col("event"), F.col("state"))), message("assistant", F.col("commentary"))).alias("messages"))


def trained_span(rendered: Column, marker: str) -> Column:
    """What follows the last marker; empty without one."""
    return F.when(rendered.contains(marker), F.substring_index(rendered, marker, -1)).otherwise("")


def pace(seconds: Column) -> Column:
    """The pause between balls that a client asked for, within bounds; the default without one."""
    return F.when(seconds.isNull(), PACE).otherwise(F.greatest(F.lit(0.0), F.least(seconds, F.lit(SLOWEST))))


def frames(lines: DataFrame, keys: list[str], order: str, text: str, start: int = 0, state: Column | None = None, ball: Column | None = None, done: Column | None = None, end: Column | None = None) -> DataFrame:
    """(keys, seq, frame, kind, data): state, tokens and end of each line from place start on.

    state and ball are payloads of the frames before and after a line's tokens (by default
    nothing, and the line); with done, each group of keys ends with one more frame that holds it.
    Where rows tell themselves which of them are ends and no lines (end), no group is gathered.
    """
    at = lines.where(F.col(order) >= max(start, 0))
    body = F.transform(token_chunks(F.col(text)), lambda c: F.struct(F.lit("token").alias("kind"), c.alias("data")))
    one = lambda kind, data: F.array(F.struct(F.lit(kind).alias("kind"), data.alias("data")))
    whole = F.concat(one("state", F.lit("") if state is None else state), body, one("ball", F.col(text) if ball is None else ball))
    if end is not None:
        whole = F.when(end, one("done", F.lit("") if done is None else done)).otherwise(whole)
    out = at.select(*keys, F.col(order).alias("seq"), F.posexplode(whole).alias("frame", "x")).select(*keys, "seq", "frame", "x.kind", "x.data")
    if done is None or end is not None:
        return out
    ends = lines.groupBy(*keys).agg((F.max(order) + 1).alias("seq")).select(*keys, "seq", F.lit(0).alias("frame"), F.lit("done").alias("kind"), done.alias("data"))
    return out.unionByName(ends)


def stream(frame: DataFrame) -> DataFrame:
    """frames with wire, the frame as a server-sent event."""
    token = F.to_json(F.struct(F.col("data").alias("t")))
    kinds = {"token": token, "state": F.col("data"), "ball": F.col("data"), "done": F.col("data")}
    return frame.withColumn("wire", F.coalesce(*(F.when(F.col("kind") == k, sse(k, c)) for k, c in kinds.items())))


def folded(frame: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, seq, text): lines put together again from their token frames."""
    tokens = F.sort_array(F.collect_list(F.when(F.col("kind") == "token", F.struct("frame", "data"))))
    return frame.where("kind <> 'done'").groupBy(*keys, "seq").agg(F.array_join(F.transform(tokens, lambda x: x.data), "").alias("text"))


def resume(frame: DataFrame, last: int | None, switched: bool = False) -> DataFrame:
    """The frames after the last whole line; with another persona, that line once more."""
    return frame if last is None else frame.where(F.col("seq") >= (last if switched else last + 1))


def match_ids(records: DataFrame) -> DataFrame:
    return records.select("match_id").distinct()


def listed(records: DataFrame, allowed: list[str] | None = None, most: int | None = None) -> DataFrame:
    """The match ids to be shown: those allowed, all of them; else the first `most` in order."""
    ids = match_ids(records)
    if allowed:
        return ids.where(F.col("match_id").isin(*allowed))
    return ids if most is None else ids.orderBy("match_id").limit(most)


def balls_of(records: DataFrame, match_id: str) -> DataFrame:
    """A match's records; UnknownKey if there are none."""
    own = records.where(F.col("match_id") == match_id)
    if not own.limit(1).count():
        raise UnknownKey(f"unknown match {match_id!r}")
    return own


def match_summary(records: DataFrame, keys: list[str], order: str, first: str, last: str) -> DataFrame:
    return records.groupBy(*keys).agg(F.min_by(first, order).alias("first"), F.max_by(last, order).alias("last"), F.count("*").alias("n"))


def summaries(records: DataFrame, order: list[str]) -> DataFrame:
    """(match_id, teams, innings, balls) of records: the teams of the first ball, the innings of the last."""
    at = F.struct("innings", *order)
    return records.groupBy("match_id").agg(F.min_by(F.array("batting_team", "bowling_team"), at).alias("teams"), (F.max("innings") + 1).alias("innings"), F.count("*").alias("balls"))


def round_of(stage: Column) -> Column:
    """0 without a stage, a known stage's round, 1 for any other."""
    rounds = F.create_map(*(F.lit(x) for kv in ROUNDS.items() for x in kv))
    return F.when(F.coalesce(stage, F.lit("")) == "", 0).otherwise(F.coalesce(F.try_element_at(rounds, stage), F.lit(1)))


def catalog_matches(matches: DataFrame, stats: DataFrame, competition: str | None = None) -> DataFrame:
    """Match documents (match_id, info) that have balls, as a catalog's rows; stats: (match_id, balls, innings)."""
    own = matches if competition is None else matches.where(F.col("info.event.name") == competition)
    stage, date = F.col("info.event.stage"), F.coalesce(F.try_element_at("info.dates", F.lit(1)), F.lit(""))
    rows = own.select(
        "match_id", F.coalesce("info.season", F.lit("None")).alias("season"), F.slice(F.coalesce("info.teams", F.array()), 1, 2).alias("teams"), display_date(date).alias("date"), date.alias("iso"),
        F.coalesce(F.when(stage != "", stage), F.lit("league")).alias("stage"), round_of(stage).alias("round"), F.col("info.event.match_number").alias("match_number"), F.coalesce("info.outcome.winner", F.lit("")).alias("winner"),
    )
    return rows.join(stats.where("balls > 0").select("match_id", "balls", F.col("innings").alias("n_innings")), "match_id")


def catalog(rows: DataFrame) -> DataFrame:
    """(season, champion, matches): the matches of catalog_matches by season; in it by round, number and date.

    The champion is the winner of the first match whose stage is 'Final', or empty.
    """
    row = F.struct("round", F.coalesce("match_number", F.lit(0)).alias("place"), "iso", "match_id", "match_number", "teams", "date", "balls", "n_innings", "stage", "winner")
    g = rows.groupBy("season").agg(F.sort_array(F.collect_list(row)).alias("matches"))
    final = F.try_element_at(F.filter("matches", lambda x: x.stage == "Final"), F.lit(1)).winner
    return g.select("season", F.coalesce(final, F.lit("")).alias("champion"), F.transform("matches", lambda x: x.dropFields("place")).alias("matches"))


def find_match(catalog_: DataFrame, match_id: str) -> DataFrame:
    return catalog_.select("season", F.explode("matches").alias("m")).where(F.col("m.match_id") == match_id).select("season", "m.*")
