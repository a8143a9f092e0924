"""All queries of the library over the driver's tables, each with its SQL equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seamfold.functions.hashing import SPLIT_SALT, hash_split, holdout
from seamfold.functions.rounding import round_exact, round_exact_sql
from seamfold.operators import classify, dataset, fold, metrics, render, textcheck

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

USER, ORDER = ["user_id"], ["ts", "event_id"]
W = "PARTITION BY user_id ORDER BY ts, event_id"
def _legal():
    return F.col("event_type") != "error"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents():
    return F.rint(F.col("value") * 100).cast("long")


@query(f"""SELECT event_id, user_id, sum(round_even(value * 100, 0)::BIGINT) OVER w::BIGINT AS total, sum((event_type <> 'error')::INT) OVER w::BIGINT AS legal,
    array_to_string(list(CASE WHEN event_type = 'error' THEN 'W' ELSE event_type END) OVER ({W} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), ' ') AS trail
    FROM events WINDOW w AS ({W} ROWS UNBOUNDED PRECEDING)""")
def running_state(spark, sf_dir):
    """Running totals, conditional counts and the trail of the last six, in one window sort."""
    token = F.when(~_legal(), "W").otherwise(F.col("event_type"))
    return _t(spark, sf_dir, "events").select("event_id", "user_id", fold.running(_cents(), USER, ORDER).alias("total"), fold.running(_legal().cast("int"), USER, ORDER).alias("legal"), F.array_join(fold.trail(token, USER, ORDER), " ").alias("trail"))


@query(f"""WITH s AS (SELECT *, coalesce(sum((event_type = 'purchase')::INT) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS stand FROM events)
    SELECT event_id, stand, sum(round_even(value * 100, 0)::BIGINT) OVER (PARTITION BY user_id, stand ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS stand_total FROM s""")
def stand_reset(spark, sf_dir):
    """Running sums that start anew after a reset."""
    e = _t(spark, sf_dir, "events").withColumn("stand", fold.islands(F.col("event_type") == "purchase", USER, ORDER))
    return e.select("event_id", "stand", fold.running(_cents(), [*USER, "stand"], ORDER).alias("stand_total"))


@query(f"SELECT event_id, coalesce(lag(event_type = 'click', 1) OVER ({W}), false) AND coalesce(lag(event_type = 'click', 2) OVER ({W}), false) AS on_streak FROM events")
def streak_flag(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", fold.streak_before(F.col("event_type") == "click", USER, ORDER).alias("on_streak"))


@query("""SELECT event_id, row_number() OVER d::BIGINT AS place, sum((event_type <> 'error')::INT) OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS legal_place,
    concat_ws('-', user_id, strftime(ts, '%Y%m%d'), row_number() OVER d) AS place_id FROM events WINDOW d AS (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id)""")
def over_position(spark, sf_dir):
    """Places within a sub-sequence (here a day), all and legal only."""
    day = F.to_date("ts")
    e = _t(spark, sf_dir, "events").withColumn("day", day)
    w = Window.partitionBy("user_id", "day").orderBy(*ORDER)
    e = e.withColumns({"place": F.row_number().over(w).cast("long"), "legal_place": fold.running(_legal().cast("int"), ["user_id", "day"], ORDER)})
    return e.select("event_id", "place", "legal_place", F.concat_ws("-", "user_id", F.date_format("day", "yyyyMMdd"), "place").alias("place_id"))


@query("""SELECT event_id, sum(round_even(value * 100, 0)::BIGINT) OVER a::BIGINT AS actor_total, count(*) OVER a AS actor_n
    FROM events WINDOW a AS (PARTITION BY user_id, event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def keyed_actor_state(spark, sf_dir):
    keys = ["user_id", "event_type"]
    return _t(spark, sf_dir, "events").select("event_id", fold.running(_cents(), keys, ORDER).alias("actor_total"), fold.running(F.lit(1), keys, ORDER).alias("actor_n"))


@query(f"""WITH s AS (SELECT event_id, row_number() OVER ({W}) - 1 AS n, sum(round_even(value, 0)::BIGINT) OVER ({W} ROWS UNBOUNDED PRECEDING)::BIGINT AS score FROM events)
    SELECT event_id, CASE WHEN n < 6 THEN 'powerplay' WHEN n >= 15 THEN 'death' ELSE 'middle' END AS band,
    concat_ws(',', CASE WHEN score >= 40 AND score < 50 THEN 'batter_nearing_50' WHEN score >= 90 AND score < 100 THEN 'batter_nearing_100' WHEN score >= 140 AND score < 150 THEN 'batter_nearing_150' END,
    CASE WHEN score > 0 AND (floor(score / 50) + 1) * 50 - score <= 10 THEN 'team_nearing_' || ((floor(score / 50) + 1) * 50)::BIGINT END) AS marks FROM s""")
def phase_and_milestones(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("event_id", (fold.running(F.lit(1), USER, ORDER) - 1).alias("n"), fold.running(F.rint("value").cast("long"), USER, ORDER).alias("score"))
    return e.select("event_id", fold.phase(F.col("n"), F.lit(6), F.lit(20)).alias("band"), F.array_join(fold.milestones(F.col("score"), F.col("score"), F.lit(False)), ",").alias("marks"))


_CRR = "CASE WHEN legal > 0 THEN total * 6 / legal ELSE 0.0 END::DOUBLE"


@query(f"""WITH s AS (SELECT event_id, user_id, sum(round_even(value * 100, 0)::BIGINT) OVER w::DOUBLE AS total, sum((event_type <> 'error')::INT) OVER w::DOUBLE AS legal FROM events WINDOW w AS ({W} ROWS UNBOUNDED PRECEDING))
    SELECT event_id, {round_exact_sql(_CRR)} AS crr FROM s""")
def current_rate(spark, sf_dir):
    """A rate rounded by its exact binary value."""
    e = _t(spark, sf_dir, "events").select("event_id", fold.running(_cents(), USER, ORDER).cast("double").alias("total"), fold.running(_legal().cast("int"), USER, ORDER).cast("double").alias("legal"))
    return e.select("event_id", round_exact(fold.rate(F.col("total"), F.col("legal"), F.lit(6))).alias("crr"))


_OW = "PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING"


@query(f"""WITH s AS (SELECT o_orderkey, sum(round_even(o_totalprice, 0)::BIGINT) OVER w::BIGINT AS score, count(*) OVER w AS n FROM orders WINDOW w AS ({_OW}))
    SELECT o_orderkey, greatest(1000000 - score, 0)::BIGINT AS required, greatest(20 - n, 0)::BIGINT AS balls_left, CASE WHEN greatest(20 - n, 0) > 0 THEN greatest(1000000 - score, 0) * 6 / greatest(20 - n, 0) ELSE 0.0 END::DOUBLE AS rrr FROM s""")
def chase_equation(spark, sf_dir):
    """What is required of a target, in how many steps, and at what rate."""
    k, o = ["o_custkey"], ["o_orderdate", "o_orderkey"]
    s = _t(spark, sf_dir, "orders").select("o_orderkey", fold.running(F.rint("o_totalprice").cast("long"), k, o).alias("score"), fold.running(F.lit(1), k, o).alias("n"))
    s = s.select("o_orderkey", F.greatest(1000000 - F.col("score"), F.lit(0)).alias("required"), F.greatest(20 - F.col("n"), F.lit(0)).alias("balls_left"))
    return s.withColumn("rrr", fold.rate(F.col("required"), F.col("balls_left"), F.lit(6)))


@query(f"""WITH s AS (SELECT event_id, user_id, event_type, sum(round_even(value * 100, 0)::BIGINT) OVER w::BIGINT AS total, sum((event_type = 'error')::INT) OVER w::BIGINT AS outs, count(*) OVER w AS n FROM events WINDOW w AS ({W} ROWS UNBOUNDED PRECEDING))
    SELECT event_id, concat_ws(' | ', 'user ' || user_id, n || '.' || (n % 6) || CASE WHEN event_type = 'error' THEN '+wide' ELSE '' END, total || '/' || outs, CASE WHEN total < 5000 THEN 'need ' || (5000 - total) END) AS line FROM s""")
def state_line(spark, sf_dir):
    """A one-line state with segments that come and go."""
    s = lambda c: c.cast("string")
    e = _t(spark, sf_dir, "events").select("event_id", "user_id", "event_type", fold.running(_cents(), USER, ORDER).alias("total"), fold.running((~_legal()).cast("int"), USER, ORDER).alias("outs"), fold.running(F.lit(1), USER, ORDER).alias("n"))
    n, total = F.col("n"), F.col("total")
    label = F.concat(s(n), F.lit("."), s(n % 6), F.when(_legal(), "").otherwise("+wide"))
    return e.select("event_id", F.concat_ws(" | ", F.concat(F.lit("user "), s(F.col("user_id"))), label, F.concat(s(total), F.lit("/"), s(F.col("outs"))), F.when(total < 5000, F.concat(F.lit("need "), s(5000 - total)))).alias("line"))


_PHRASE = "CASE WHEN event_type = 'error' THEN 'WICKET, error' WHEN floor(value) % 7 = 6 THEN 'SIX off the bat' WHEN floor(value) % 7 = 4 THEN 'FOUR off the bat' WHEN event_type = 'signup' THEN 'wide' WHEN floor(value) % 7 = 0 THEN 'dot ball' ELSE (floor(value) % 7)::BIGINT || ' run(s)' END"


def _phrase():
    runs = F.pmod(F.floor("value"), F.lit(7))
    return render.event_phrase(runs, runs, F.when(F.col("event_type") == "signup", F.create_map(F.lit("wides"), F.lit(1))).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>"))), F.when(F.col("event_type") == "error", F.array(F.lit("error"))).otherwise(F.array().cast("array<string>")))


@query(f"SELECT event_id, {_PHRASE} AS phrase FROM events")
def event_phrase(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", _phrase().alias("phrase"))


@query(f"SELECT phrase, count(*) AS n FROM (SELECT {_PHRASE} AS phrase FROM events) GROUP BY phrase")
def bucket_histogram(spark, sf_dir):
    return _t(spark, sf_dir, "events").select(_phrase().alias("phrase")).groupBy("phrase").agg(F.count("*").alias("n"))


def _unit(key: str) -> str:
    return f"('0x' || left(sha256('{SPLIT_SALT}' || {key}), 8))::UBIGINT / 4294967295.0::DOUBLE"


def _split(key: str) -> str:
    return f"CASE WHEN {_unit(key)} < 0.1::DOUBLE THEN 'test' WHEN {_unit(key)} < 0.1::DOUBLE + 0.1::DOUBLE THEN 'val' ELSE 'train' END"


@query(f"SELECT doc_id, {_split('doc_id')} AS split FROM documents")
def hash_splits(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", hash_split(F.col("doc_id")).alias("split"))


@query("""SELECT doc_id, list_reduce([('0x' || substr(sha256('evalholdout-' || doc_id), 8 * i + 1, 8))::UBIGINT::BIGINT FOR i IN range(0, 8)], lambda a, x: (a * 296 + x) % 1000, 0::BIGINT) < 100 AS held FROM documents""")
def holdout_split(spark, sf_dir):
    """A 256-bit hash modulo 1000, folded over limbs."""
    return _t(spark, sf_dir, "documents").select("doc_id", holdout(F.col("doc_id"), 0.1).alias("held"))


@query(f"SELECT {_split('conv_id')} AS split, count(*) AS n FROM conversations GROUP BY 1")
def split_counts(spark, sf_dir):
    """How many rows each split gets; rows of one key share theirs."""
    return metrics.counters(_t(spark, sf_dir, "conversations").select(hash_split(F.col("conv_id")).alias("split")), "split")


@query("SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY sha256(doc_id::VARCHAR), doc_id) AS r FROM documents) WHERE r <= 7")
def stratified_take(spark, sf_dir):
    """A quota of each stratum by hash order; the sampling operator's own limit."""
    return classify.hash_quota(_t(spark, sf_dir, "documents").select("source", "doc_id"), "source", "doc_id", 7)


@query()
def stratified_draw(spark, sf_dir):
    """Seeded draws of given sizes from each stratum, by place."""
    return classify.stratified_sample(_t(spark, sf_dir, "documents").select("source", "doc_id"), "source", ["doc_id"], [(f"src{i}", 5 + i) for i in range(20)])


_PERSONAS = [("plain", True), ("warm", False), ("dry", False), ("wry", False)]


@query("""SELECT doc_id, 'plain' AS persona FROM documents UNION ALL
    SELECT doc_id, persona FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY sha256(doc_id::VARCHAR), doc_id) AS r FROM documents), (VALUES ('warm'), ('dry'), ('wry')) p(persona) WHERE r <= 5""")
def secondary_plan(spark, sf_dir):
    """All items for the primary persona and a drawn subset for each other."""
    d = _t(spark, sf_dir, "documents").select("source", "doc_id")
    return classify.persona_plan(d.select("doc_id"), classify.hash_quota(d, "source", "doc_id", 5).select("doc_id"), spark.createDataFrame(_PERSONAS, "persona string, primary boolean"))


@query("SELECT conv_id, turn, (row_number() OVER w - 1) % 4 AS persona, (row_number() OVER w - 1) // 3 AS wave FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def rotation_and_waves(spark, sf_dir):
    n = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")).cast("long") - 1
    return _t(spark, sf_dir, "conversations").select("conv_id", "turn", classify.rotation(n, 4).alias("persona"), classify.chunk(n, 3).alias("wave"))


_TOK = "regexp_extract_all(lower(text), '[a-z'']+')"


@query(f"""WITH d AS (SELECT doc_id, {_TOK} AS t FROM documents), b AS (SELECT {_TOK} AS t FROM benchmark),
    g AS (SELECT DISTINCT doc_id, array_to_string(t[i : i + 5], ' ') AS g FROM (SELECT doc_id, t, unnest(range(1, len(t) - 4)) AS i FROM d))
    SELECT DISTINCT doc_id FROM g SEMI JOIN (SELECT array_to_string(t[i : i + 5], ' ') AS g FROM (SELECT t, unnest(range(1, len(t) - 4)) AS i FROM b)) s ON g.g = s.g""")
def ngram_overlap(spark, sf_dir):
    """Documents that share six consecutive words with a benchmark item."""
    return textcheck.overlapping(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "benchmark"), "doc_id")


@query(f"""WITH d AS (SELECT lang, doc_id, {_TOK} AS t FROM documents), u AS (SELECT lang, unnest(t) AS v FROM d),
    b AS (SELECT lang, t[i] || ' ' || t[i + 1] AS v FROM (SELECT lang, t, unnest(range(1, len(t))) AS i FROM d)),
    x AS (SELECT lang, count(*) AS n_lines, count(DISTINCT array_to_string(t, ' ')) AS dl FROM d GROUP BY lang),
    y AS (SELECT lang, count(DISTINCT v) / count(*)::DOUBLE AS r FROM u GROUP BY lang), z AS (SELECT lang, count(DISTINCT v) / count(*)::DOUBLE AS r FROM b GROUP BY lang)
    SELECT x.lang, n_lines, {round_exact_sql("y.r", 4)} AS distinct_1, {round_exact_sql("z.r", 4)} AS distinct_2, {round_exact_sql("1.0::DOUBLE - dl / n_lines::DOUBLE", 4)} AS duplicate_rate FROM x JOIN y USING (lang) JOIN z USING (lang)""")
def distinct_n(spark, sf_dir):
    return metrics.diversity(_t(spark, sf_dir, "documents"), "text", ["lang"])


@query("""SELECT event_id, regexp_extract(l, '(\\d+)\\s*/\\s*(\\d+)', 1)::BIGINT AS runs, regexp_extract(l, '(\\d+)\\s*/\\s*(\\d+)', 2)::BIGINT AS outs
    FROM (SELECT event_id, 'now ' || user_id || ' / ' || floor(value)::BIGINT || ' and 1/2' AS l FROM events)""")
def score_extract(spark, sf_dir):
    line = F.concat(F.lit("now "), F.col("user_id").cast("string"), F.lit(" / "), F.floor("value").cast("string"), F.lit(" and 1/2"))
    return _t(spark, sf_dir, "events").select("event_id", textcheck.score(line).alias("s")).select("event_id", F.col("s.a").cast("long").alias("runs"), F.col("s.b").cast("long").alias("outs"))


#: Lines with what they claim: a six, a four, a wicket, and how many have fallen.
CLAIMS = (
    ("A huge six! ", True, False, False, None), ("Cracked for four. ", False, True, False, None), ("Six down now. ", False, False, False, 6), ("They want six an over. ", False, False, False, None), ("The third wicket to fall. ", False, False, False, 3),
    ("Bowled him! ", False, False, True, None), ("Drives one down the ground. ", False, False, False, None), ("Inside six overs. ", False, False, False, None), ("What a maximum! ", True, False, False, None), ("They lose their fifth. ", False, False, False, 5),
    ("Run out by yards. ", False, False, True, None), ("Two for four, then six more. ", True, False, False, None), ("Worked away. ", False, False, False, None), ("12 wickets down, no: 4 down already. ", False, False, False, 12), ("He has 27 off 24. ", False, False, False, None),
)
_SQL_CLAIMS = ", ".join(f"({i}, {six}, {four}, {out}, {'NULL' if n is None else n})" for i, (_, six, four, out, n) in enumerate(CLAIMS))
_FACTS = f"""WITH c(place, six, four, out, n) AS (VALUES {_SQL_CLAIMS}),
    e AS (SELECT *, {_PHRASE} AS phrase, floor(value)::BIGINT AS runs, CASE WHEN event_id % 4 = 0 THEN 11 ELSE 12 END AS said FROM events), f AS (SELECT * FROM e JOIN c ON c.place = event_id % {len(CLAIMS)})"""


def _facts(spark, sf_dir):
    """Lines written from events, some wrong on purpose, with their events and states."""
    e = F.col("event_id")
    text = lambda c: c.cast("string")
    runs = text(F.floor(F.col("value")))
    line = F.concat(F.get(F.array(*(F.lit(c[0]) for c in CLAIMS)), (e % len(CLAIMS)).cast("int")), F.lit("A "), runs, F.lit("/"), text(e % 7), F.when(e % 4 == 0, ", they need it: 11 more from 6").otherwise(", 12 needed off the last 6"))
    state = F.concat(F.lit("x | A "), runs, F.lit("/"), text(e % 10), F.lit(" | need 12 off 6"))
    return _t(spark, sf_dir, "events").select("event_id", line.alias("line"), _phrase().alias("event"), state.alias("state"))


@query(f"""{_FACTS}, r AS (SELECT event_id, concat_ws('; ', CASE WHEN phrase LIKE 'SIX%' AND four THEN 'calls a six a four' END, CASE WHEN phrase LIKE 'FOUR%' AND six THEN 'calls a four a six' END,
    CASE WHEN phrase NOT LIKE 'SIX%' AND phrase NOT LIKE 'FOUR%' AND six THEN 'claims a six that did not happen' END, CASE WHEN phrase NOT LIKE 'SIX%' AND phrase NOT LIKE 'FOUR%' AND four THEN 'claims a boundary that did not happen' END,
    CASE WHEN phrase NOT LIKE 'WICKET%' AND out THEN 'claims a wicket that did not happen' END, CASE WHEN event_id % 7 <> event_id % 10 THEN 'score (' || runs || ', ' || event_id % 7 || ') != state (' || runs || ', ' || event_id % 10 || ')' END,
    CASE WHEN n <> event_id % 10 THEN 'wickets ' || n || ' != state ' || event_id % 10 END, CASE WHEN said <> 12 THEN 'equation (11, 6) != state (12, 6)' END) AS reasons FROM f) SELECT event_id, reasons = '' AS ok, reasons FROM r""")
def faith_check(spark, sf_dir):
    """Lines against their facts: whether they hold, and every reason why not."""
    return _facts(spark, sf_dir).select("event_id", textcheck.check(F.col("line"), F.col("event"), F.col("state")).alias("c")).select("event_id", "c.ok", F.array_join("c.reasons", "; ").alias("reasons"))


@query(f"{_FACTS} SELECT event_id, six AND place <> 8 AS six, four, n::BIGINT AS fallen, said::BIGINT AS need, 6::BIGINT AS balls FROM f")
def line_claims(spark, sf_dir):
    """What lines claim, one claim at a time."""
    c = _facts(spark, sf_dir).select("event_id", textcheck.claims(F.col("line")).alias("c"))
    f = c.select("event_id", "c.six", "c.four", F.col("c.fallen").cast("long").alias("fallen"), F.col("c.equation").alias("q"))
    return f.select("event_id", "six", "four", "fallen", F.col("q.a").cast("long").alias("need"), F.col("q.b").cast("long").alias("balls"))


@query("""SELECT conv_id, string_agg('<' || role || '>' || coalesce(text, ''), '' ORDER BY turn) AS chat, len(list(turn)) AS n,
    CASE WHEN contains(string_agg('<' || role || '>' || coalesce(text, ''), '' ORDER BY turn), '<assistant>') THEN list_last(string_split(string_agg('<' || role || '>' || coalesce(text, ''), '' ORDER BY turn), '<assistant>')) ELSE '' END AS span FROM conversations GROUP BY conv_id""")
def chat_span(spark, sf_dir):
    """Chats as one string and what follows the last assistant marker."""
    part = F.struct("turn", F.concat(F.lit("<"), F.col("role"), F.lit(">"), F.coalesce("text", F.lit(""))).alias("s"))
    g = _t(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("x"))
    g = g.select("conv_id", F.array_join(F.transform("x", lambda y: y.s), "").alias("chat"), F.size("x").cast("long").alias("n"))
    return g.withColumn("span", dataset.trained_span(F.col("chat"), "<assistant>"))


_NW = "len(list_filter(string_split_regex(trim(coalesce(text, '')), '\\s+'), lambda x: x <> ''))"


@query(f"""WITH w AS (SELECT role, {_NW} AS n FROM conversations), s AS (SELECT n, row_number() OVER (ORDER BY n) AS r, count(*) OVER () AS c FROM w WHERE role = 'assistant')
    SELECT count(*) AS examples, {round_exact_sql("sum(n)::DOUBLE / count(*)")} AS mean_words, max(CASE WHEN r = least(floor(0.95::DOUBLE * c), c - 1) + 1 THEN n END) AS p95 FROM s""")
def assembly_stats(spark, sf_dir):
    """Mean and 95th percentile of answer lengths, by index into the sorted lengths."""
    c = _t(spark, sf_dir, "conversations").where("role = 'assistant'").select(F.size(F.filter(F.split(F.trim(F.coalesce("text", F.lit(""))), r"\s+"), lambda x: x != "")).cast("long").alias("n"))
    p = metrics.indexed_percentile(c, "n", 0.95)
    return c.agg(F.count("*").alias("examples"), round_exact(F.sum("n").cast("double") / F.count("*")).alias("mean_words")).join(F.broadcast(p.select(F.col("p").alias("p95"))))


@query("""WITH l AS (SELECT d.doc_id, lang, length(text) < 800 AS ok, quality = 1 AS faithful FROM documents d LEFT JOIN labels USING (doc_id))
    SELECT lang, count(*) AS n, count(faithful) AS judged, count_if(faithful)::BIGINT AS faithful, count_if(ok AND NOT faithful)::BIGINT AS false_negatives, count_if(NOT ok AND faithful)::BIGINT AS false_positives, count_if(NOT ok AND NOT faithful)::BIGINT AS true_rejects FROM l GROUP BY lang""")
def audit_cross_tab(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select("doc_id", "lang", (F.length("text") < 800).alias("ok"))
    return metrics.cross_tab(d.join(_t(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("faithful")), "doc_id", "left"), ["lang"], "ok", "faithful")


@query("""WITH m AS (SELECT doc_id, unnest([CASE WHEN length(text) < 400 THEN 'short' END, CASE WHEN contains(text, '|') THEN 'table' END, CASE WHEN contains(text, '$') THEN 'noise' END]) AS mode FROM documents)
    SELECT mode, count(*) AS n FROM m WHERE mode IS NOT NULL GROUP BY mode""")
def failure_mode_counts(spark, sf_dir):
    modes = F.filter(F.array(F.when(F.length("text") < 400, "short"), F.when(F.contains("text", F.lit("|")), "table"), F.when(F.contains("text", F.lit("$")), "noise")), lambda x: x.isNotNull())
    return metrics.failure_modes(_t(spark, sf_dir, "documents").withColumn("modes", modes), "modes", "doc_id")


@query(f"""WITH s AS (SELECT lang, count(*) AS n, count_if(quality = 1)::BIGINT AS good FROM documents JOIN labels USING (doc_id) GROUP BY lang)
    SELECT lang, n, good, {round_exact_sql("good / n::DOUBLE", 4)} AS rate FROM s""")
def system_score(spark, sf_dir):
    s = _t(spark, sf_dir, "documents").select("doc_id", "lang").join(_t(spark, sf_dir, "labels"), "doc_id").groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("quality") == 1).alias("good"))
    return s.withColumn("rate", round_exact(F.col("good") / F.col("n"), 4))


@query("""WITH s AS (SELECT lang, count_if(quality = 1) / count(*)::DOUBLE AS rate, 0.6 AS d, 0.05 AS u FROM documents JOIN labels USING (doc_id) GROUP BY lang)
    SELECT t.rate - b.rate >= 0.05 AS passed, CASE WHEN t.rate - b.rate < 0.05 THEN 'margin' ELSE 'passed' END AS reason FROM s t, s b WHERE t.lang = 'en' AND b.lang = 'de'""")
def release_gate(spark, sf_dir):
    s = system_score(spark, sf_dir).select("lang", (F.col("good") / F.col("n")).alias("rate"), F.lit(0.6).alias("distinct_2"), F.lit(0.05).alias("duplicate_rate"))
    return metrics.gate(s.where("lang = 'en'"), s.where("lang = 'de'")).select("passed", "reason")


_COST = "((length(props) * 3.0::DOUBLE + event_id % 100 * 3.0::DOUBLE * 0.1::DOUBLE + event_id % 7 * 3.0::DOUBLE * 2.0::DOUBLE + event_id % 50 * 15.0::DOUBLE) / 1000000.0::DOUBLE)"


def _cost():
    e = F.col("event_id")
    return classify.call_cost(F.length("props"), e % 100, e % 7, e % 50, F.lit(3.0), F.lit(15.0))


@query(f"SELECT event_id, round({_COST} * 1e9)::BIGINT AS nano FROM events")
def cost_ledger(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", F.round(_cost() * 1e9).cast("long").alias("nano"))


@query(f"SELECT event_id FROM (SELECT event_id, coalesce(sum(round({_COST} * 1e9)::BIGINT) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM events) WHERE spent < 20000000")
def budget_prefix(spark, sf_dir):
    """Items that are started while what was spent before is below the cap."""
    return _t(spark, sf_dir, "events").select("event_id", classify.spent_before(F.round(_cost() * 1e9).cast("long"), ORDER, keys=USER).alias("spent")).where("spent < 20000000").select("event_id")


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY lang ORDER BY CASE source WHEN 'src3' THEN 0 WHEN 'src1' THEN 1 ELSE 2 END, doc_id) AS r FROM documents) WHERE r <= 16")
def affordable_top(spark, sf_dir):
    """As many items as the budget pays for, by priority, ties in order."""
    k = classify.affordable(1.0, 0.0, 0.0625)
    priority = F.when(F.col("source") == "src3", 0).when(F.col("source") == "src1", 1).otherwise(2)
    r = F.row_number().over(Window.partitionBy("lang").orderBy(priority, "doc_id"))
    return _t(spark, sf_dir, "documents").select("doc_id", r.alias("r")).where(F.col("r") <= k).select("doc_id")


@query("SELECT user_id, arg_min(event_type, (ts, event_id)) AS first, arg_max(event_type, (ts, event_id)) AS last, count(*) AS n FROM events GROUP BY user_id")
def match_summary(spark, sf_dir):
    return dataset.match_summary(_t(spark, sf_dir, "events").withColumn("at", F.struct(*ORDER)), ["user_id"], "at", "event_type", "event_type")


@query("""SELECT year(o_orderdate)::VARCHAR AS season, count(*) AS n, arg_max(c_name, (o_totalprice, o_orderkey)) AS champion, min(strftime(o_orderdate, '%-d %b %Y')) AS a_date
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_name <> 'none' GROUP BY ALL""")
def season_catalog(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").join(_t(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(_t(spark, sf_dir, "nation").where("n_name <> 'none'").select("n_nationkey"), F.col("c_nationkey") == F.col("n_nationkey"))
    return o.groupBy(F.year("o_orderdate").cast("string").alias("season")).agg(F.count("*").alias("n"), F.max_by("c_name", F.struct("o_totalprice", "o_orderkey")).alias("champion"), F.min(render.display_date(F.date_format("o_orderdate", "yyyy-MM-dd"))).alias("a_date"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus <> 'P' AND o_custkey IS NOT NULL)")
def pending_items(spark, sf_dir):
    done = _t(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return _t(spark, sf_dir, "customer").select("c_custkey").join(done, "c_custkey", "left_anti")


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def allow_list(spark, sf_dir):
    known = _t(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(known, "o_custkey", "left_semi").select("o_orderkey")


_TURN = "conv_id, turn, coalesce(text, '') AS text"


@query(f"""WITH l AS (SELECT {_TURN} FROM conversations), p AS (SELECT conv_id, turn, text, string_split(text, ' ') AS t FROM l)
    SELECT conv_id, turn AS seq, 0 AS frame, 'state' AS kind, '' AS data FROM l UNION ALL
    SELECT conv_id, turn, i, 'token', CASE WHEN i = 1 THEN t[i] ELSE ' ' || t[i] END FROM (SELECT conv_id, turn, t, unnest(range(1, len(t) + 1)) AS i FROM p) UNION ALL
    SELECT conv_id, turn, len(t) + 1, 'ball', text FROM p""")
def replay_frames(spark, sf_dir):
    c = _t(spark, sf_dir, "conversations").withColumn("text", F.coalesce("text", F.lit("")))
    return dataset.frames(c, ["conv_id"], "turn", "text").withColumn("frame", F.col("frame").cast("long"))


@query(f"SELECT conv_id, turn AS seq, text FROM (SELECT {_TURN} FROM conversations)")
def fold_frames(spark, sf_dir):
    """Frames put together again: the lines they came from."""
    return dataset.folded(replay_frames(spark, sf_dir), ["conv_id"])


@query("SELECT event_id, json_extract_string(props, '$.ref') AS ref, len(json_keys(props)) AS n_keys FROM events")
def json_props(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.ref").alias("ref"), F.size(F.json_object_keys("props")).cast("long").alias("n_keys"))


@query("""SELECT event_id, CASE WHEN value >= 30 AND event_id % 3 <> 0 THEN 'draw 1' WHEN event_id % 5 <> 0 THEN 'draw 2' ELSE 'fallback' END AS line,
    CASE WHEN value >= 30 AND event_id % 3 <> 0 THEN 1 WHEN event_id % 5 <> 0 THEN 2 ELSE 3 END AS attempts FROM events""")
def fallback_pick(spark, sf_dir):
    """The first of several draws that passes, or the fallback after all of them."""
    e = F.col("event_id")
    ok = F.array((F.col("value") >= 30) & (e % 3 != 0), e % 5 != 0)
    first = textcheck.first_faithful(F.array(F.lit("draw 1"), F.lit("draw 2")), ok)
    return _t(spark, sf_dir, "events").select("event_id", F.coalesce(first, F.lit("fallback")).alias("line"), F.when(first.isNull(), 3).otherwise(F.substring(first, 6, 1).cast("int")).alias("attempts"))
