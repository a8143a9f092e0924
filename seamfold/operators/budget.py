"""Costs, and runs that stop before their budget is spent.

Where costs are known in advance, what a wave may spend is a window over waves. Where
they are only known after each call, waves are run one after the other: each is a
distributed job that writes its answers, and the driver sees its sum.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from seamfold.errors import UnknownKey
from seamfold.functions.ranks import placed

# fixed values: shares of an input token's price, and measured sizes of calls
READ_SHARE, WRITE_SHARE, BATCH_SHARE = 0.1, 2.0, 0.5
JUDGE_PREFIX, JUDGE_IN, JUDGE_OUT = 4830, 280, 230
SEED_TOKENS, LINE_IN, LINE_OUT = 7917, 190, 65


@dataclass(frozen=True)
class Price:
    """Of a million tokens; columns where calls have prices of their own."""

    tokens_in: float | Column
    tokens_out: float | Column


def price_of(prices: dict[str, Price], model: str) -> Price:
    if model not in prices:
        raise UnknownKey(f"no price for {model!r}; known: {sorted(prices)}")
    return prices[model]


def usage_cost(usage: dict[str, Column], price: Price, batch: bool = False, writes: bool = True) -> Column:
    """What calls cost by their counters (tokens_in, cache_read, cache_write, tokens_out); null counters are 0."""
    n = {k: F.coalesce(c, F.lit(0)) for k, c in usage.items()}
    shares = {"tokens_in": price.tokens_in, "cache_read": price.tokens_in * READ_SHARE, "cache_write": price.tokens_in * (WRITE_SHARE if writes else 0.0), "tokens_out": price.tokens_out}
    terms = [n[k] * (each if isinstance(each, Column) else F.lit(float(each))) for k, each in shares.items() if k in n]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total / 1e6 * (BATCH_SHARE if batch else 1.0)


def marginal_judge_cost(price: Price, batch: bool = True) -> float:
    """One more verdict, once the rubric is cached."""
    return (JUDGE_PREFIX * READ_SHARE * price.tokens_in + JUDGE_IN * price.tokens_in + JUDGE_OUT * price.tokens_out) / 1e6 * (BATCH_SHARE if batch else 1.0)


def cache_write_cost(price: Price) -> float:
    return JUDGE_PREFIX * WRITE_SHARE * price.tokens_in / 1e6


def judge_estimate(n: int, price: Price, batch: bool = True) -> float:
    return round(cache_write_cost(price) + n * marginal_judge_cost(price, batch), 2)


def generation_estimate(n: int, price: Price, seed: int = SEED_TOKENS, tokens_in: int = 80, tokens_out: int = 60, cached: bool = True, batch: bool = True) -> float:
    """n calls that share a prefix: written once at full price and read by each, or sent in full each time."""
    once = seed * WRITE_SHARE * price.tokens_in if cached else 0.0
    each = seed * price.tokens_in * (READ_SHARE if cached else 1.0) + tokens_in * price.tokens_in + tokens_out * price.tokens_out
    return round((once + n * each * (BATCH_SHARE if batch else 1.0)) / 1e6, 2)


def dry_run(items: DataFrame, price: Price, seed: int = SEED_TOKENS) -> tuple[int, float, float]:
    """How many items there are, and what they would cost in batches and one by one."""
    n = items.count()
    return n, *(generation_estimate(n, price, seed, LINE_IN, LINE_OUT, batch=b) for b in (True, False))


def affordable(budget: float, fixed: float, marginal: float) -> int:
    return int(max(0.0, budget - fixed) / marginal)


def affordable_targets(targets: DataFrame, budget: float, price: Price, priority: tuple[str, ...], order: list[str], bucket: str = "bucket", batch: bool = True) -> tuple[DataFrame, int]:
    """The targets that a budget pays verdicts for, and how many it does not; if it is short, by their bucket's priority.

    Without need to cut, all targets stay; else an ordered limit, which Spark takes
    from each partition first.
    """
    n, most = targets.count(), affordable(budget, cache_write_cost(price), marginal_judge_cost(price, batch))
    if most >= n:
        return targets, 0
    rank = F.coalesce(*(F.when(F.col(bucket) == b, i) for i, b in enumerate(priority)), F.lit(len(priority)))
    return targets.withColumn("__rank", rank).orderBy("__rank", *order).limit(most).drop("__rank"), n - most


def wave(place: Column, size: int, alone: int = 0) -> Column:
    """The wave of a place counted from 0: the first `alone` places are waves of their own, then size places each."""
    return F.when(place < alone, place).otherwise(F.floor((place - alone) / F.lit(size)) + alone).cast("long")


def spent_before_wave(items: DataFrame, cost: str, keys: list[str], order: list[str], size: int, alone: int = 0) -> DataFrame:
    """items with wave and spent: what their group's earlier waves cost. Only waves are summed in order, not items."""
    w = Window.partitionBy(*keys).orderBy(*order)
    placed = items.withColumn("wave", wave(F.row_number().over(w) - 1, size, alone))
    waves = placed.groupBy(*keys, "wave").agg(F.sum(cost).alias("__cost"))
    before = Window.partitionBy(*keys).orderBy("wave").rowsBetween(Window.unboundedPreceding, -1)
    waves = waves.select(*keys, "wave", F.coalesce(F.sum("__cost").over(before), F.lit(0)).alias("spent"))
    return placed.join(waves, [*keys, "wave"])


@dataclass
class Run:
    """What a run did: items by status, and what it spent."""

    statuses: dict[str, int] = field(default_factory=dict)
    spent: float = 0.0
    waves: int = 0
    stopped: bool = False
    answers: list[str] = field(default_factory=list)

    @property
    def processed(self) -> int:
        return sum(n for s, n in self.statuses.items() if s != "failed")


def run_waves(items: DataFrame, done: DataFrame, keys: list[str], order: list[str], call: Callable[[DataFrame], DataFrame], path: str, budget: float, size: int = 500, alone: int = 0) -> Run:
    """Call items wave by wave until what was spent reaches the budget.

    items not in done (keys, any status) are numbered in order; call returns a wave's
    rows with status and cost (null counts as 0), and may fail rows one by one. Each wave's rows
    are written under path/wave=N before the next begins, so that a run that breaks off is
    resumed by giving what is there as done. The cap can be passed by one wave at most.
    """
    todo = items.join(done.select(*keys).distinct(), keys, "left_anti")
    numbered = placed(todo, order).withColumn("__wave", wave(F.col("__place"), size, alone))
    spark = items.sparkSession
    numbered.drop("__place").write.mode("overwrite").partitionBy("__wave").parquet(f"{path}/todo")
    first = len(_paths(spark, path))
    plan = spark.read.schema(numbered.drop("__place").schema).parquet(f"{path}/todo")
    run = Run()
    for (number,) in sorted(plan.select("__wave").distinct().collect()):  # one row a wave
        if run.spent >= budget:
            run.stopped = True
            break
        to = f"{path}/answers/wave={first + number}"
        seen = Observation()
        call(plan.where(F.col("__wave") == number).drop("__wave")).observe(seen, F.sum("cost").alias("cost")).write.mode("overwrite").parquet(to)
        run.spent += float(seen.get["cost"] or 0.0)
        run.waves += 1
        run.answers.append(to)
    if run.answers:  # all waves at once: a wave is one job
        run.statuses = {r.status: r.n for r in spark.read.schema("status string").parquet(*run.answers).groupBy("status").agg(F.count("*").alias("n")).collect()}
    return run


def _paths(spark: SparkSession, path: str) -> list[str]:
    """The waves that earlier runs have written whole under a path."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/answers")
    store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    waves = [s.getPath() for s in store.listStatus(root)] if store.exists(root) else []
    whole = [p.toString() for p in waves if store.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(whole)


def read_answers(spark: SparkSession, path: str) -> DataFrame | None:
    """All answers that runs have written under a path; None if there are none. A wave that broke off is not among them."""
    found = _paths(spark, path)
    return spark.read.parquet(*found) if found else None


def answers_at(items: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """The keys of what earlier runs have answered under a path, in any status."""
    found = read_answers(items.sparkSession, path)
    return items.select(*keys).limit(0) if found is None else found.select(*keys)
