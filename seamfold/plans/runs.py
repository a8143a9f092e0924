"""Runs over models as queries: their models are stubs, functions of a row's id that SQL can follow."""

from __future__ import annotations

import base64
import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from seamfold.errors import CallFailed
from seamfold.functions.folders import fresh, importable, written
from seamfold.functions.ranks import placed
from seamfold.operators import budget, classify, metrics, runs
from seamfold.plans import matches
from seamfold.plans.suite import _PHRASE, _phrase, _t, query
from seamfold.sources import sinks
from seamfold.streaming import replay

PRICE = budget.Price(3.0, 15.0)
#: Lines of a replay that come in one file, at most about.
LINES_PER_FILE = 50_000


@query("SELECT event_id, row_number() OVER (ORDER BY event_type, value, event_id) - 1 AS place FROM events")
def global_places(spark, sf_dir):
    """Every row's place in the order of the whole table."""
    return placed(_t(spark, sf_dir, "events").select("event_id", "event_type", "value"), ["event_type", "value", "event_id"], "place").select("event_id", "place")


#: Places that a seeded generator might have drawn.
DRAWN = [(f"src{i}", p) for i in range(20) for p in (0, 1, 4 + i, 9, 13, 40)]


@query(f"""SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS p FROM documents) d
    JOIN (VALUES {", ".join(f"('{s}', {p})" for s, p in sorted(set(DRAWN)))}) t(s, q) ON d.source = t.s AND d.p = t.q""")
def drawn_places(spark, sf_dir):
    """A stratified draw whose places are given; the operator that stratified_sample draws for."""
    places = spark.createDataFrame(sorted(set(DRAWN)), "source string, __place long")
    return classify.at_places(_t(spark, sf_dir, "documents").select("source", "doc_id"), "source", ["doc_id"], places)


def _draw(rows: list[dict], attempt: int) -> list[str | None]:
    texts = (None, "Bowled him!", " Left alone. \nA huge six!", "A huge six!", "  ")
    return [texts[(r["event_id"] + 3 * attempt) % 5] for r in rows]


_WHY = "CASE WHEN k = 1 AND phrase NOT LIKE 'WICKET%' THEN 'claims a wicket that did not happen' WHEN k = 3 AND phrase LIKE 'FOUR%' THEN 'calls a four a six' WHEN k = 3 AND phrase NOT LIKE 'SIX%' THEN 'claims a six that did not happen' ELSE '' END"


@query(f"""WITH e AS (SELECT event_id, {_PHRASE} AS phrase FROM events), d AS (SELECT *, (event_id + 3 * attempt) % 5 AS k FROM e, range(1, 4) t(attempt)), w AS (SELECT *, {_WHY} AS why, k BETWEEN 1 AND 3 AS line FROM d),
    ok AS (SELECT event_id, min(attempt) AS attempts, arg_min(k, attempt) AS k FROM w WHERE line AND why = '' GROUP BY event_id), bad AS (SELECT event_id, arg_max(why, attempt) AS why FROM w WHERE line GROUP BY event_id)
    SELECT e.event_id, CASE ok.k WHEN 1 THEN 'Bowled him!' WHEN 2 THEN 'Left alone.' WHEN 3 THEN 'A huge six!' ELSE 'fall ' || e.event_id END AS line, CASE WHEN ok.k IS NULL THEN 'fallback' ELSE 'model' END AS source, coalesce(ok.attempts, 3)::INT AS attempts,
    CASE WHEN ok.k IS NULL THEN coalesce(bad.why, '') ELSE '' END AS reasons FROM e LEFT JOIN ok USING (event_id) LEFT JOIN bad USING (event_id)""")
def redrawn_lines(spark, sf_dir):
    """Lines drawn again only where the last one failed, at most three times."""
    importable(spark)
    e = _t(spark, sf_dir, "events").select("event_id", _phrase().alias("event"), F.lit("").alias("state"), F.concat(F.lit("fall "), F.col("event_id").cast("string")).alias("fallback"))
    v = runs.redraw(e, _draw).select("event_id", "validated.*")
    return v.select("event_id", "line", "source", "attempts", F.array_join("reasons", "; ").alias("reasons"))


class Stub:
    """A batch service that keeps a batch in its id, answers in another order, drops some requests and fails on others."""

    def submit(self, requests, key):
        return base64.b64encode(json.dumps([[r["custom_id"], r["source"], r["n_chars"]] for r in requests]).encode()).decode()

    def poll(self, batch):
        rows = json.loads(base64.b64decode(batch))
        return [{"custom_id": i, "succeeded": int(i) % 11 != 0, "text": f" about {source}\n", "tokens_in": n, "tokens_out": n % 50} for i, source, n in reversed(rows) if int(i) % 7]


@query("""SELECT doc_id, doc_id % 7 <> 0 AND doc_id % 11 <> 0 AS ok, CASE WHEN doc_id % 7 <> 0 AND doc_id % 11 <> 0 THEN 'about ' || source END AS text, CASE WHEN doc_id % 7 <> 0 AND doc_id % 11 <> 0 THEN n_chars ELSE 0 END AS tokens_in,
    CASE WHEN doc_id % 7 <> 0 AND doc_id % 11 <> 0 THEN n_chars % 50 ELSE 0 END AS tokens_out, 0::BIGINT AS cache_read FROM documents""")
def batch_answers(spark, sf_dir):
    """Requests in batches, with their answers by custom id; those that failed or were dropped are marked."""
    importable(spark)
    requests = _t(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("custom_id"), "source", "n_chars")
    held = runs.submit(requests, Stub(), fresh(spark, "batches"), size=64)
    return runs.answered(requests, runs.collected(held, Stub(), pause=0.0)).select("doc_id", "ok", F.trim(F.regexp_replace("text", r"\s+$", "")).alias("text"), "tokens_in", "tokens_out", "cache_read")


@query("""WITH w AS (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 1000 AS wave, CASE WHEN event_id % 9 = 0 THEN 'failed' ELSE 'kept' END AS status, CASE WHEN event_id % 9 = 0 THEN 0 ELSE (event_id % 3) * 0.25 END AS cost FROM events WHERE event_id % 4 <> 0),
    s AS (SELECT wave, sum(cost) AS c FROM w GROUP BY wave), b AS (SELECT wave, coalesce(sum(c) OVER (ORDER BY wave ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM s)
    SELECT event_id, status FROM w JOIN b USING (wave) WHERE spent < 600""")
def run_by_waves(spark, sf_dir):
    """A run that goes on, wave by wave, until what was spent reaches the budget; what was done before is left out."""
    e, path = _t(spark, sf_dir, "events").select("event_id"), fresh(spark, "run")
    status = F.when(F.col("event_id") % 9 == 0, "failed").otherwise("kept")
    call = lambda w: w.select("event_id", status.alias("status"), F.when(status == "kept", (F.col("event_id") % 3) * 0.25).alias("cost"))
    budget.run_waves(e, e.where("event_id % 4 = 0"), ["event_id"], ["event_id"], call, path, 600.0, size=1000)
    return budget.read_answers(spark, path).select("event_id", "status")


def _write(row: dict) -> dict:
    if row["event_id"] % 17 == 0:
        raise CallFailed("the stub is out")
    texts = ("Bowled him!", "The ball is left alone outside off stump", "Nothing in it.", "")
    return {"text": texts[row["event_id"] % 4], "tokens_in": row["event_id"] % 100, "tokens_out": 8}


@query(f"""WITH e AS (SELECT event_id, {_PHRASE} AS phrase FROM events), s AS (SELECT event_id, CASE WHEN event_id % 17 = 0 THEN 'failed' WHEN event_id % 4 = 0 AND phrase NOT LIKE 'WICKET%' THEN 'rejected_faithfulness' WHEN event_id % 4 = 1 THEN 'rejected_seed_dedup' ELSE 'kept' END AS status FROM e)
    SELECT event_id, status, CASE WHEN status = 'failed' THEN 0 ELSE event_id % 100 * 3000 + 8 * 15000 END AS nano FROM s""")
def generation_wave(spark, sf_dir):
    """Generated lines with their statuses and costs: failed calls, contradictions and copies of seeds are told apart."""
    importable(spark)
    items = _t(spark, sf_dir, "events").select("event_id", _phrase().alias("event"), F.lit("").alias("state"))
    seeds = spark.createDataFrame([("The ball is left alone outside off stump today",)], "text string")
    return runs.generating(_write, PRICE, seeds)(items).select("event_id", "status", F.round(F.col("cost") * 1e9).cast("long").alias("nano"))


def _judge(row: dict) -> dict:
    if row["event_id"] % 5 == 0:
        raise CallFailed("the stub is out")
    if row["event_id"] % 7 == 0:
        return {"text": "no verdict"}
    verdict = {"faithful": row["event_id"] % 3 != 0, "severity": "minor", "failure_modes": [], "persona_match": True, "confidence": "high", "explanation": "x"}
    return {"text": f"Verdict: {json.dumps(verdict)}.", "tokens_in": 10, "tokens_out": 5}


@query("SELECT event_id, NOT (event_type = 'purchase' AND event_id % 5 <> 0 AND event_id % 7 <> 0 AND event_id % 3 = 0) AS kept FROM events")
def judged_pairs(spark, sf_dir):
    """Pairs of high risk that a judge finds unfaithful go; those without a verdict stay."""
    importable(spark)
    pairs = _t(spark, sf_dir, "events").select("event_id", "event_type")
    kept, dropped, _ = runs.judge_filter(pairs, F.col("event_type") == "purchase", _judge, PRICE, ["event_id"], fresh(spark, "judge"), 1e9, size=10_000)
    return kept.select("event_id", F.lit(True).alias("kept")).unionByName(dropped.select("event_id", F.lit(False).alias("kept")))


def _show(messages: list[dict]) -> str:
    return "".join(f"<{m['role']}>{m['content']}" for m in messages)


def _bytes(text: str) -> list[int]:
    return list(text.encode())


@query("""WITH c AS (SELECT conv_id, sum(strlen('<' || role || '>' || coalesce(text, '')))::INT AS n FROM conversations GROUP BY conv_id), o AS (SELECT n, row_number() OVER (ORDER BY conv_id) - 1 AS p, count(*) OVER () AS total FROM c),
    k AS (SELECT n, total FROM o WHERE p % greatest(1, total // 500) = 0), s AS (SELECT n, row_number() OVER (ORDER BY n) - 1 AS i, count(*) OVER () AS m, total FROM k)
    SELECT max(total) AS n_total, count(*) AS n_measured, max(CASE WHEN i = m // 2 THEN n END) AS p50, max(CASE WHEN i = floor(0.95::DOUBLE * m) THEN n END) AS p95, max(n) AS longest, count_if(n > 400)::BIGINT AS over FROM s""")
def length_check(spark, sf_dir):
    """Lengths of rendered chats by an injected tokenizer (here of bytes): of every k-th one in order."""
    importable(spark)
    part = F.struct("turn", F.struct("role", F.coalesce("text", F.lit("")).alias("content")).alias("m"))
    chats = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(part)), lambda x: x.m).alias("messages"))
    lengths = chats.select("conv_id", runs.token_length(runs.rendered(F.col("messages"), _show), _bytes).alias("n"))
    return metrics.length_check(lengths, "n", ["conv_id"], 400)


@query("""WITH l AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS seq, coalesce(text, '') AS text FROM conversations), p AS (SELECT *, string_split(text, ' ') AS t FROM l),
    f AS (SELECT conv_id, seq, 0 AS frame, 'state' AS kind, '' AS data FROM l UNION ALL SELECT conv_id, seq, i, 'token', CASE WHEN i = 1 THEN t[i] ELSE ' ' || t[i] END FROM (SELECT *, unnest(range(1, len(t) + 1)) AS i FROM p)
    UNION ALL SELECT conv_id, seq, len(t) + 1, 'ball', text FROM p UNION ALL SELECT conv_id, max(seq) + 1, 0, 'done', conv_id::VARCHAR FROM l GROUP BY conv_id) SELECT *, seq * 0.5::DOUBLE AS due FROM f""")
def live_replay(spark, sf_dir):
    """Conversations as a stream that comes in pieces, out of order: every frame once, in order, and an end for each."""
    at = Window.partitionBy("conv_id")
    place = (F.row_number().over(at.orderBy("turn")) - 1).cast("long")
    lines = _t(spark, sf_dir, "conversations").select("conv_id", place.alias("seq"), F.coalesce("text", F.lit("")).alias("text"), F.count("*").over(at).alias("total"))
    come, out, state = (fresh(spark, k) for k in ("stream", "frames", "state"))
    lines = written(lines, "lines")
    files = -(-lines.count() // LINES_PER_FILE) or 1
    for part in (2, 0, 1):  # every third line comes in later files than the lines behind it
        lines.where(F.col("seq") % 3 == part).repartition(files).write.mode("append").parquet(come)
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", files).parquet(come)
    live = replay.live_frames(stream, ["conv_id"], "seq", "text", "total", done=F.col("conv_id").cast("string"), pace=0.5)
    replay.run_once(live, out, state).awaitTermination()
    return spark.read.schema(live.schema).parquet(out).withColumn("frame", F.col("frame").cast("long"))


@query(f"{matches.BALLS} SELECT count(*) AS records, count(DISTINCT (match_id, innings)) AS innings, count(DISTINCT match_id) AS matches FROM r")
def counted_write(spark, sf_dir):
    """What a write of records has counted on its way."""
    done = sinks.write_records(matches._records(spark, sf_dir).select("match_id", "innings", "over", "ball_in_over", "state_string"), fresh(spark, "records"))
    return spark.createDataFrame([(done.records, done.innings, done.matches)], "records long, innings long, matches long")
