"""Tasks grow in number with the input, not in size."""

import os

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seamfold.functions import values
from seamfold.operators import budget, classify, fold, metrics
from seamfold.plans import matches, runs
from seamfold.sources import sinks
from seamfold.streaming import replay

DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
def test_folds_deal_balls_over_as_many_tasks_as_they_need(spark, monkeypatch):
    monkeypatch.setattr(fold, "BALLS_PER_TASK", 20)
    n = spark.read.parquet(f"{DIR}/events.parquet").count()
    balls = fold.explode_balls(matches.documents(spark, DIR))
    assert balls.rdd.getNumPartitions() == fold.tasks(spark, n) == -(-n // 20) > 8
    assert fold.innings_state(balls).rdd.getNumPartitions() == -(-n // 20)
    plan = fold.innings_state(balls)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    made = matches.innings_increments(spark, DIR)
    assert sorted(map(str, made.collect())) == sorted(map(str, matches.innings_fold(spark, DIR).collect()))


def test_a_wave_is_one_job(spark, tmp_path):
    e = spark.range(20).withColumnRenamed("id", "k")
    call = lambda w: w.select("k", F.when(F.col("k") % 3 == 0, "failed").otherwise("kept").alias("status"), F.when(F.col("k") % 3 != 0, 0.5).alias("cost"))
    sc = spark.sparkContext
    sc.setJobGroup("waves", "waves")
    run = budget.run_waves(e, e.limit(0), ["k"], ["k"], call, f"{tmp_path}/a", 1e9, size=1)
    many = len(sc.statusTracker().getJobIdsForGroup("waves"))
    sc.setJobGroup("few", "few")
    few = budget.run_waves(e, e.limit(0), ["k"], ["k"], call, f"{tmp_path}/b", 1e9, size=10)
    assert many - len(sc.statusTracker().getJobIdsForGroup("few")) <= run.waves - few.waves + 2
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert (run.statuses, run.spent, run.waves) == ({"failed": 7, "kept": 13}, 6.5, 20) and few.statuses == run.statuses


def test_a_draw_reads_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 2).cast("string").alias("s")).mapInArrow(look, "k long, s string")
    drawn = classify.stratified_sample(rows, "s", ["k"], [("0", 10), ("1", 600)])
    assert drawn.count() == 510 and drawn.count() == 510 and seen.value == 1000


def test_diversity_adds_up_values_in_tasks(spark, monkeypatch):
    texts = [("a", "x Y x y"), ("a", "x y x y"), ("a", None), ("b", "it's x"), (None, "x"), ("b", "12")]
    df = spark.createDataFrame(texts, "k string, t string")
    made = {r.k: tuple(r)[1:] for r in metrics.diversity(df, "t", ["k"]).collect()}
    assert made == {"a": (3, 0.25, 0.3333, 0.3333), "b": (2, 1.0, 1.0, 0.0), None: (1, 1.0, 0.0, 0.0)}
    schema = pa.schema([("k", pa.string()), ("kind", pa.string()), ("g", pa.int64()), ("h", pa.int64()), ("n", pa.int64())])
    batch = pa.RecordBatch.from_pydict({"k": ["a"] * 100, "t": ["x y"] * 100})
    whole = [r for b in values.counted(schema)([batch]) for r in b.to_pylist()]
    assert len(whole) == 4 and {r["n"] for r in whole} == {100}
    monkeypatch.setattr(values, "HELD", 30)
    parts = [r for b in values.counted(schema)([batch]) for r in b.to_pylist()]
    assert len(parts) == 40 and sum(r["n"] for r in parts) == 400


def test_files_grow_with_records_and_not_with_matches(spark, tmp_path):
    rows = spark.range(1200).select(F.concat(F.lit("m"), F.col("id") % 300).alias("match_id"), F.lit(0).alias("innings"), F.lit(0).alias("over"), (4 - F.floor(F.col("id") / 300)).cast("int").alias("ball_in_over"))
    assert sinks.write_records(rows, f"{tmp_path}/r") == sinks.Written(1200, 300, 300)
    got = spark.read.parquet(f"{tmp_path}/r").withColumn("file", F.input_file_name()).cache()
    assert len(list((tmp_path / "r").glob("**/*.parquet"))) <= 8
    assert got.groupBy("match_id").agg(F.count_distinct("file").alias("n")).where("n = 1").count() == 300
    assert sorted(map(tuple, got.drop("file").collect())) == sorted(map(tuple, rows.collect()))
    one = got.select("file").first().file
    own = [(r.match_id, r.ball_in_over) for r in spark.read.parquet(one).collect()]
    assert own == sorted(own) and len(own) % 4 == 0
    assert sinks.write_records(rows, f"{tmp_path}/a", apart=True) == sinks.Written(1200, 300, 300)
    assert len(list((tmp_path / "a").glob("match_id=*"))) == 300


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
def test_lines_come_in_as_many_files_as_they_need(spark, monkeypatch, tmp_path):
    want = sorted(map(str, runs.live_replay(spark, DIR).collect()))
    monkeypatch.setattr(runs, "LINES_PER_FILE", 20)
    monkeypatch.setattr(runs, "fresh", lambda _, label: f"{tmp_path}/{label}")
    n = spark.read.parquet(f"{DIR}/conversations.parquet").count()
    assert sorted(map(str, runs.live_replay(spark, DIR).collect())) == want
    assert len(list((tmp_path / "stream").glob("*.parquet"))) == 3 * -(-n // 20) > 3
    assert len(list((tmp_path / "state" / "commits").glob("[0-9]*"))) == 3


def test_a_group_without_new_lines_makes_no_frame(spark):
    class Lines:
        """Stands in for a stream; keeps the function that it is given."""

        sparkSession, schema = spark, spark.createDataFrame([], "k string, seq long, line string, total long").schema
        select = groupBy = lambda self, *_: self

        def applyInPandasWithState(self, advance, *_):  # noqa: N802
            return advance

    class State:
        exists, hasTimedOut, get = False, False, None  # noqa: N815

        def update(self, value):
            self.exists, self.get = True, value

    advance, state = replay.in_order(Lines(), ["k"], "seq", "line", "total"), State()
    come = lambda *rows: list(advance(("a",), iter([pd.DataFrame(rows, columns=["k", "seq", "line", "total"])]), state))
    assert come(("a", 1, None, 3)) == [] and state.get == (0, 3, [(1, None)])
    (out,) = come(("a", 0, "x", float("nan")), ("a", 0, "y", 3))
    assert list(map(tuple, out[["k", "seq", "text", "done"]].values)) == [("a", 0, "x", False), ("a", 1, "", False)]
    assert come(("a", 1, "z", 3)) == [] and state.get == (2, 3, [])
    (out,) = come(("a", 2, "w", 3), ("a", 4, "v", 3))
    assert list(map(tuple, out.values)) == [("a", 2, "w", False), ("a", 3, None, True)] and come(("a", 2, "w", 3)) == []
