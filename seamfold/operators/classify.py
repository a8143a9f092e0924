"""First-match classification, stratified sampling and plans of items."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seamfold.functions.folders import written
from seamfold.functions.hashing import SPLIT_SALT, hash_split
from seamfold.functions.ranks import placed, placed_within
from seamfold.operators.budget import Price, affordable, generation_estimate, usage_cost  # noqa: F401  affordable is part of this module's interface
from seamfold.operators.fold import MARKS
from seamfold.operators.render import real_wicket, record_event

# fixed values: classes that verdicts are paid for, the order in which a short budget pays, and shares of a sample
HIGH_RISK = ("wicket", "tight_finish", "death_chase_pressure", "batter_milestone", "four", "six")
PRIORITY = ("tight_finish", "six", "batter_milestone", "wicket", "four", "death_chase_pressure")
STRATA = {
    "wicket": 0.18, "hat_trick": 0.02, "four": 0.15, "death_chase_pressure": 0.12, "six": 0.12, "batter_milestone": 0.08,
    "dot_under_pressure": 0.07, "powerplay_routine": 0.07, "tight_finish": 0.06, "team_milestone": 0.05, "middle_routine": 0.05, "death_routine": 0.03,
}
SEED = 17


def crosses_mark(after: Column, runs: Column) -> Column:
    """Whether a striker has passed one of the marks with these runs."""
    return F.exists(F.array(*map(F.lit, MARKS)), lambda m: (after - runs < m) & (m <= after))


def bucket() -> Column:
    """The situation of a record, by the first rule that holds, or null."""
    bat, total, phase = F.col("delivery.runs_batter"), F.col("delivery.runs_total"), F.col("state.phase")
    chase, rrr, req, left = F.col("innings") >= 1, F.col("state.required_run_rate"), F.col("state.runs_required"), F.col("state.balls_left")
    near = lambda what: F.exists("state.milestones", lambda m: m.startswith(what))
    yes = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(real_wicket(F.transform("delivery.wickets", lambda w: w.kind)).isNotNull(), "wicket")
        .when(F.col("state.bowler_on_hat_trick"), "hat_trick").when(bat == 4, "four")
        .when(yes((phase == "death") & chase & (rrr >= 12)), "death_chase_pressure").when(bat == 6, "six")
        .when(near("batter_nearing") | crosses_mark(F.col("state.striker_runs"), bat), "batter_milestone")
        .when(yes(F.col("is_legal") & (total == 0) & ((phase == "death") | yes(chase & (rrr >= 9)))), "dot_under_pressure")
        .when((phase == "powerplay") & bat.between(0, 3), "powerplay_routine")
        .when(yes(chase & (req > 0) & (req <= 12) & (left > 0) & (left <= 12)), "tight_finish")
        .when(near("team_nearing"), "team_milestone").when((phase == "middle") & bat.between(1, 3), "middle_routine").when(phase == "death", "death_routine")
    )


def high_risk(pairs: DataFrame, buckets: tuple[str, ...] = HIGH_RISK) -> DataFrame:
    """Pairs of a class that verdicts are paid for; a missing one is none of them."""
    return pairs.where(F.coalesce(F.col("bucket"), F.lit("")).isin(*buckets))


def candidates(records: DataFrame, split: str = "train", val: float = 0.1, test: float = 0.1, salt: str = SPLIT_SALT) -> DataFrame:
    """(match_id, ball_id, bucket, event, state) of a split's records that have a class.

    The split is a function of the match, so it filters before anything else is computed.
    """
    own = records.where(hash_split(F.col("match_id"), val, test, salt) == split)
    return own.select("match_id", "ball_id", bucket().alias("bucket"), record_event().alias("event"), F.col("state_string").alias("state")).where("bucket is not null")


def at_places(rows: DataFrame, stratum: str, order: list[str], places: DataFrame, held: bool = False) -> DataFrame:
    """The rows at places (stratum, __place), counted from 0 in order within their stratum; numbered by ranges, so that no task has a whole stratum."""
    return placed_within(rows, stratum, order, held=held).join(places, [stratum, "__place"], "left_semi").drop("__place")


def stratified_sample(rows: DataFrame, stratum: str, order: list[str], targets: list[tuple[str, int]], seed: int = SEED) -> DataFrame:
    """Draw targets[i] rows of each stratum, in this order, from one seeded generator.

    Only counts come to the driver (one for each stratum) and only drawn places go out
    (as many as are drawn): rows are numbered within their stratum and joined to them.
    Rows are computed once, and so is what is drawn.
    """
    wanted = written(rows.where(F.col(stratum).isin([t for t, _ in targets])), "wanted")
    counts = {r[stratum]: r["count"] for r in wanted.groupBy(stratum).count().collect()}
    rng, places = random.Random(seed), []
    for name, target in targets:
        n = counts.get(name, 0)
        places += [(name, i) for i in (rng.sample(range(n), target) if target < n else range(n))]
    at = rows.sparkSession.createDataFrame(places, f"`{stratum}` string, `__place` long")
    return written(at_places(wanted, stratum, order, at, held=True), "drawn")


def sample_targets(size: int, strata: dict[str, float] = STRATA) -> list[tuple[str, int]]:
    """How many rows of each stratum a sample of this size has, in the strata's order."""
    return [(name, round(share * size)) for name, share in strata.items()]


def draw(rows: DataFrame, size: int, seed: int = SEED, strata: dict[str, float] = STRATA) -> DataFrame:
    """A stratified sample of candidates, by match and ball as strings."""
    return stratified_sample(rows, "bucket", ["match_id", "ball_id"], sample_targets(size, strata), seed)


def secondary_subset(rows: DataFrame, fraction: float = 0.25, seed: int = SEED + 1) -> DataFrame:
    """The same share of every class of drawn candidates, classes in alphabetical order."""
    sizes = rows.where("bucket is not null").groupBy("bucket").count().orderBy("bucket").collect()  # one row a class
    return stratified_sample(rows, "bucket", ["match_id", "ball_id"], [(r["bucket"], round(fraction * r["count"])) for r in sizes], seed)


def pilot(items: DataFrame, n: int, order: list[str], seed: int = SEED) -> DataFrame:
    """n items of a plan, drawn by place from one seeded generator."""
    total = items.count()
    places = random.Random(seed).sample(range(total), min(n, total))
    drawn = items.sparkSession.createDataFrame([(i,) for i in places], "`__place` long")
    return placed(items, order).join(drawn, "__place", "left_semi").drop("__place")


def hash_quota(rows: DataFrame, stratum: str, key: str, quota: int, salt: str = "") -> DataFrame:
    """The quota rows of each stratum with the least hash: a sample that needs no counts."""
    w = Window.partitionBy(stratum).orderBy(F.sha2(F.concat(F.lit(salt), F.col(key).cast("string")), 256), key)
    return rows.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= quota).drop("__rank")


def persona_plan(primary: DataFrame, secondary: DataFrame, personas: DataFrame) -> DataFrame:
    """All items for the primary persona, the subset for each other one; personas: (persona, primary), a few rows."""
    pair = lambda items, flag: items.join(F.broadcast(personas.where(F.col("primary") == flag).select("persona")))
    return pair(primary, True).unionByName(pair(secondary, False))


def rotation(place: Column, n: int) -> Column:
    """Whose turn it is at a place counted from 0."""
    return F.pmod(place, F.lit(n))


def chunk(place: Column, size: int) -> Column:
    """The number of the chunk that a place counted from 0 is in."""
    return F.floor(place / F.lit(size))


def spent_before(cost: Column, order: list, keys: list | None = None) -> Column:
    """What was spent before a row, in order; for waves of rows, see budget.spent_before_wave."""
    w = Window.partitionBy(*(keys or [])).orderBy(*order)
    return F.coalesce(F.sum(cost).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))


def call_cost(tokens_in: Column, read: Column, write: Column, out: Column, price_in: Column, price_out: Column, batch: bool = False) -> Column:
    """budget.usage_cost of calls whose prices are columns."""
    return usage_cost({"tokens_in": tokens_in, "cache_read": read, "cache_write": write, "tokens_out": out}, Price(price_in, price_out), batch)


def plan_cost(n: int, prefix: int, volatile: int, out: int, price_in: float, price_out: float, batch: bool = False, cached: bool = True) -> float:
    """budget.generation_estimate of n calls that share a prefix."""
    return generation_estimate(n, Price(price_in, price_out), prefix, volatile, out, cached, batch)
