"""Runs over models: lines drawn again until one holds, batch calls, and loops that stop at a budget and can be resumed.

Models are injected: functions of rows that answer, or raise CallFailed for a row, which
then is marked as failed while the run goes on.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from seamfold.errors import BudgetExceeded, CallFailed
from seamfold.functions import claims as reader
from seamfold.functions.folders import importable
from seamfold.operators import budget, effects, textcheck

#: Draws for a line: one and its repetitions.
DRAWS = 3
#: Counters of a call.
USAGE = ("tokens_in", "tokens_out", "cache_read", "cache_write")


def _with(df: DataFrame, *fields: StructField) -> StructType:
    return StructType([*df.schema.fields, *fields])


def _appended(batch: pa.RecordBatch, schema: pa.Schema, columns: list[list]) -> pa.RecordBatch:
    fields = list(schema)[batch.num_columns :]
    return pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, f.type) for c, f in zip(columns, fields, strict=True))], schema=schema)


def redraw(items: DataFrame, draw: Callable[[list[dict], int], list[str | None]], most: int = DRAWS, event: str = "event", state: str = "state", fallback: str = "fallback") -> DataFrame:
    """items with validated: struct(line, faithful, source, attempts, reasons), lines drawn again only where the last one failed.

    draw is given the rows of a batch that have no line yet and the number of the attempt, from 1. A draw
    is cut to its first line; an empty one, or one whose call failed, counts as an attempt. After most
    attempts the fallback stands, with the reasons against the last line that was checked.
    """
    importable(items.sparkSession)
    schema = _with(items, StructField("validated", StructType.fromDDL(textcheck.VALIDATED[7:-1])))
    arrow = to_arrow_schema(schema)

    def run(batches):
        check = reader.Checker()
        for batch in batches:
            rows = batch.to_pylist()
            drawn = [reader.Drawing() for _ in rows]
            for attempt in range(1, most + 1):
                left = [i for i, d in enumerate(drawn) if d.line is None]
                if not left:
                    break
                for i, text in zip(left, draw([rows[i] for i in left], attempt), strict=True):
                    drawn[i].offer(text, lambda line, r=rows[i]: check(line, r[event], r[state]))
            yield _appended(batch, arrow, [[d.result(r[fallback]) for d, r in zip(drawn, rows, strict=True)]])

    return items.mapInArrow(run, schema)


def regenerated(defects: DataFrame, draw: Callable[[list[dict], int], list[str | None]]) -> DataFrame:
    """Defects with one new line each, checked again; their source is "regen"."""
    lines = effects.generate(defects.drop("line", "source"), lambda rows: [reader.first_line(x) for x in draw(rows, 1)])
    found = textcheck.check(F.col("line"), F.col("event"), F.col("state"))
    return lines.withColumn("__found", found).withColumns({"source": F.lit("regen"), "heuristic_ok": F.col("__found.ok"), "heuristic_reasons": F.col("__found.reasons")}).drop("__found")


def called(items: DataFrame, call: Callable[[dict], dict]) -> DataFrame:
    """items with text and the counters of USAGE: what call answers for each row; CallFailed leaves nulls and the error's text in error."""
    importable(items.sparkSession)
    schema = _with(items, StructField("text", StringType()), *(StructField(c, LongType()) for c in USAGE), StructField("error", StringType()))
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                try:
                    got = call(row)
                    out.append([got.get("text"), *(got.get(c) or 0 for c in USAGE), None])
                except CallFailed as e:
                    out.append([None] * (1 + len(USAGE)) + [str(e)])
            yield _appended(batch, arrow, [list(c) for c in zip(*out, strict=True)] if out else [[] for _ in range(2 + len(USAGE))])

    return items.mapInArrow(run, schema)


def message_text(blocks: Column) -> Column:
    """The first text of a message's blocks (array of struct(type, text)), trimmed; empty without one."""
    return F.coalesce(F.trim(F.try_element_at(F.filter(blocks, lambda b: b.type == "text"), F.lit(1)).text), F.lit(""))


# --- batches


class BatchService(Protocol):
    """Takes chunks of requests and answers them later, in any order and not all of them."""

    def submit(self, requests: list[dict], key: str) -> str:
        """The id of a batch; the same key is the same batch, also when a lost task is run again."""

    def poll(self, batch: str) -> list[dict] | None:
        """None while it runs, then rows with custom_id, succeeded, text and counters."""


def submit(requests: DataFrame, service: BatchService, path: str, size: int = 500) -> DataFrame:
    """(batch_id, n) of all chunks, written at path: what is paid for is on record before anything is waited for.

    requests have custom_id, distinct. Chunks are cut within partitions.
    """

    def run(batches):
        held: list[dict] = []

        def one():
            key = hashlib.sha256("\n".join(r["custom_id"] for r in held).encode()).hexdigest()
            return pa.RecordBatch.from_pydict({"batch_id": [service.submit(held, key)], "n": [len(held)]}, schema=pa.schema([("batch_id", pa.string()), ("n", pa.int64())]))

        for batch in batches:
            for row in batch.to_pylist():
                held.append(row)
                if len(held) == size:
                    yield one()
                    held = []
        if held:
            yield one()

    importable(requests.sparkSession)
    requests.mapInArrow(run, "batch_id string, n long").write.mode("errorifexists").parquet(path)
    return requests.sparkSession.read.schema("batch_id string, n long").parquet(path)


def collected(batches: DataFrame, service: BatchService, pause: float = 30.0, patience: float = 86_400.0) -> DataFrame:
    """(custom_id, succeeded, text, counters) of all batches; each is polled in a task of its own until it has ended."""
    fields = [("custom_id", pa.string()), ("succeeded", pa.bool_()), ("text", pa.string()), *((c, pa.int64()) for c in USAGE)]
    schema = pa.schema(fields)

    def run(parts):
        for part in parts:
            for batch in part.column(0).to_pylist():
                until = time.monotonic() + patience
                while (rows := service.poll(batch)) is None:
                    if time.monotonic() >= until:
                        raise CallFailed(f"batch {batch} has not ended")
                    time.sleep(pause)
                yield pa.RecordBatch.from_pylist([{k: r.get(k) for k, _ in fields} for r in rows], schema=schema)

    importable(batches.sparkSession)
    n = max(1, batches.count())
    return batches.select("batch_id").repartition(n, "batch_id").mapInArrow(run, "custom_id string, succeeded boolean, text string, " + ", ".join(f"{c} long" for c in USAGE))


def answered(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """Requests with their answers by custom id, whatever their order; what did not succeed, or was not answered, has no text and ok = false. Null counters are 0."""
    told = answers.select("custom_id", F.col("succeeded").alias("__ok"), F.trim("text").alias("text"), *(F.coalesce(c, F.lit(0)).alias(c) for c in USAGE))
    ok = F.coalesce("__ok", F.lit(False))
    out = requests.join(told, "custom_id", "left").withColumns({"ok": ok, "text": F.when(ok, F.col("text")), **{c: F.when(ok, F.col(c)).otherwise(0) for c in USAGE}})
    return out.drop("__ok")


# --- loops


def generating(call: Callable[[dict], dict], price: budget.Price, seeds: DataFrame, batch: bool = False) -> Callable[[DataFrame], DataFrame]:
    """What budget.run_waves calls to generate: a wave's items (with event and state) with line, status, reasons and cost.

    Failed calls cost nothing; a line that contradicts its facts, or shares six words with a seed, is rejected but paid.
    """

    def wave(items: DataFrame) -> DataFrame:
        lines = called(items, call).withColumn("line", textcheck.drawn_line(F.col("text"))).withColumn("found", textcheck.check(F.col("line"), F.col("event"), F.col("state")))
        lines = textcheck.with_copies(lines, seeds, "line", "copy")
        failed = F.col("error").isNotNull()
        status = effects.status(F.when(~failed, F.col("line")), F.col("found.ok"), F.col("copy"))
        cost = F.when(failed, 0.0).otherwise(budget.usage_cost({c: F.col(c) for c in USAGE}, price, batch))
        return lines.select(*items.columns, "line", status.alias("status"), F.col("found.reasons").alias("reasons"), cost.alias("cost"))

    return wave


def judging(call: Callable[[dict], dict], price: budget.Price, batch: bool = False) -> Callable[[DataFrame], DataFrame]:
    """What budget.run_waves calls to judge: a wave's items with verdict, status (judged or failed) and cost. A failed call, or an answer without a valid verdict, leaves null."""

    def wave(items: DataFrame) -> DataFrame:
        got = called(items, call)
        verdict = effects.parse_verdict(F.col("text"))
        out = got.withColumn("verdict", verdict).withColumn("status", F.when(F.col("verdict").isNotNull(), "judged").otherwise("failed"))
        return out.withColumn("cost", F.when(F.col("error").isNull(), budget.usage_cost({c: F.col(c) for c in USAGE}, price, batch)).otherwise(0.0)).drop("text", "error", *USAGE)

    return wave


def judge_filter(pairs: DataFrame, high_risk: Column, call: Callable[[dict], dict], price: budget.Price, keys: list[str], path: str, cap: float, size: int = 500) -> tuple[DataFrame, DataFrame, budget.Run]:
    """(kept, dropped, run): pairs of high risk are judged wave by wave until the cap; those that are judged and not faithful go, all others stay.

    Fails open: pairs that were not judged, for want of money or of an answer, stay. An
    earlier run's answers at path are not paid for again.
    """
    judged = pairs.where(high_risk)
    run = budget.run_waves(judged, budget.answers_at(judged, path, keys), keys, keys, judging(call, price), path, cap, size)
    answers = budget.read_answers(judged.sparkSession, path)
    if answers is None:
        return pairs, pairs.limit(0), run
    bad = effects.dropped(answers, F.lit(True), F.col("verdict")).select(*keys, "verdict")
    return pairs.join(bad.select(*keys), keys, "left_anti"), pairs.join(bad, keys), run


def audit_run(items: DataFrame, call: Callable[[dict], dict], price: budget.Price, keys: list[str], path: str, cap: float, size: int = 100) -> tuple[DataFrame, budget.Run]:
    """(judged, run): audit items with their verdicts, the first alone so that the cache is warm; an error is a null verdict that costs nothing."""
    run = budget.run_waves(items, budget.answers_at(items, path, keys), keys, keys, judging(call, price), path, cap, size, alone=1)
    answers = budget.read_answers(items.sparkSession, path)
    return (items.withColumn("verdict", F.lit(None).cast(effects.VERDICT)).limit(0) if answers is None else answers), run


def affordable_or_raise(n: int, price: budget.Price, cap: float) -> None:
    """BudgetExceeded before a run that the cap cannot pay for."""
    cost = budget.judge_estimate(n, price)
    if cost > cap:
        raise BudgetExceeded(f"{n} verdicts cost about {cost}, more than {cap}")


# --- rendering with a tokenizer


def rendered(messages: Column, render: Callable[[list[dict]], str]) -> Column:
    """Chats (array of struct(role, content)) as the injected template shows them."""

    def run(chats: pa.Array) -> pa.Array:
        return pa.array([None if x is None else render(x) for x in chats.to_pylist()], pa.string())

    run.__annotations__ = {"chats": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, StringType())(messages)


def token_length(text: Column, encode: Callable[[str], list[int]]) -> Column:
    """How many tokens the injected tokenizer makes of a text; null of none."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if x is None else len(encode(x)) for x in texts.to_pylist()], pa.int32())

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, IntegerType())(text)
