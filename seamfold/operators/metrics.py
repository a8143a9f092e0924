"""Aggregates over texts, systems and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from seamfold.functions import values
from seamfold.functions.folders import importable
from seamfold.functions.ranks import placed
from seamfold.functions.rounding import round_exact
from seamfold.operators import textcheck


def _share(part, total):
    return F.when(total > 0, part / total).otherwise(0.0)


def diversity(lines: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """(keys, n_lines, distinct_1, distinct_2, duplicate_rate); pairs of words do not cross lines, and null lines are empty ones.

    One scan: every word, pair and line becomes two 64-bit values with its kind. Tasks add up
    equal ones of a million words at a time; the sums are added up by value after one shuffle,
    so a group with many lines is not gathered anywhere. What is counted is added up by kind.
    """
    importable(lines.sparkSession)
    low = lines.select(*keys, F.lower(F.coalesce(text, F.lit(""))).alias("__text"))
    schema = StructType([*low.schema.fields[:-1], *StructType.fromDDL("kind string, g long, h long, n long").fields])
    each = low.mapInArrow(values.counted(to_arrow_schema(schema)), schema)
    counted = each.groupBy(*keys, "kind", "g", "h").agg(F.sum("n").alias("n"))
    of = lambda kind, c: F.coalesce(F.sum(F.when(F.col("kind") == kind, c)), F.lit(0))
    sums = counted.groupBy(*keys).agg(*(a for k in "l12" for a in (of(k, F.lit(1)).alias(f"d_{k}"), of(k, F.col("n")).alias(f"n_{k}"))))
    rate = lambda k: _share(F.col(f"d_{k}"), F.col(f"n_{k}"))
    return sums.select(*keys, F.col("n_l").alias("n_lines"), round_exact(rate("1"), 4).alias("distinct_1"), round_exact(rate("2"), 4).alias("distinct_2"), round_exact(1.0 - rate("l"), 4).alias("duplicate_rate"))


def value_at(rows: DataFrame, value: str, place: Column, buckets: int = 4096) -> DataFrame:
    """(p): the value at a place, counted from 0, of the sorted ones; place may use __n, their number.

    Values are counted, their histogram is cut into ranges by value, and only the range
    that holds the place is summed in order.
    """
    h = rows.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count("*").alias("c"))
    whole = h.agg(F.sum("c").alias("__n"), F.min("v").cast("double").alias("lo"), F.max("v").cast("double").alias("hi"))
    cut = F.when(F.col("hi") > F.col("lo"), F.floor((F.col("v").cast("double") - F.col("lo")) / (F.col("hi") - F.col("lo")) * buckets)).otherwise(0)
    dealt = h.crossJoin(F.broadcast(whole)).withColumn("cut", cut)  # whole is one row
    sums = dealt.groupBy("cut", "__n").agg(F.sum("c").alias("c"))  # at most buckets + 1 rows
    upto = F.sum("c").over(Window.orderBy("cut"))
    held = sums.select("cut", (upto - F.col("c")).alias("before"), upto.alias("upto"), place.alias("place")).where("before <= place and place < upto").select("cut", "before", "place")
    inside = dealt.join(F.broadcast(held), "cut").withColumn("upto", F.col("before") + F.sum("c").over(Window.partitionBy("cut").orderBy("v")))
    return inside.where("upto > place").agg(F.min("v").alias("p"))


def indexed_percentile(rows: DataFrame, value: str, share: float) -> DataFrame:
    """(p): the value at place int(share * n) of the sorted ones, the last at most; no interpolation."""
    return value_at(rows, value, F.least(F.floor(F.lit(share).cast("double") * F.col("__n")), F.col("__n") - 1))


def length_check(examples: DataFrame, length: str, order: list[str], most: int, sample: int = 500) -> DataFrame:
    """(n_total, n_measured, p50, p95, longest, over): lengths of every k-th example in order, k leaving about `sample` of them.

    The sample is the report's own limit; p50 is the value at n // 2, p95 that at int(0.95 * n).
    """
    total = examples.count()
    step = max(1, total // sample)
    held = placed(examples, order).where(F.col("__place") % step == 0)
    p50, p95 = value_at(held, length, F.floor(F.col("__n") / 2)), value_at(held, length, F.floor(F.lit(0.95).cast("double") * F.col("__n")))
    one = held.agg(F.lit(total).cast("long").alias("n_total"), F.count("*").alias("n_measured"), F.max(length).alias("longest"), F.count_if(F.col(length) > most).alias("over"))
    return one.join(F.broadcast(p50.withColumnRenamed("p", "p50"))).join(F.broadcast(p95.withColumnRenamed("p", "p95")))


def words_of(text: Column) -> Column:
    """How many words a text has."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda w: w != ""))


def assembly_stats(examples: DataFrame, text: Column) -> DataFrame:
    """One row: total, maps of counts by split, persona and bucket, mean and 95th percentile of the answers' words."""
    held = examples.withColumn("__words", words_of(text).cast("long"))
    counts = lambda key: held.groupBy(F.coalesce(key, F.lit("?")).alias(key)).count().agg(F.map_from_entries(F.collect_list(F.struct(key, "count"))).alias(f"by_{key}"))
    mean = round_exact(F.coalesce(F.sum("__words").cast("double") / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)))
    out = held.agg(F.count("*").alias("total"), mean.alias("words_mean"))
    for part in (*map(counts, ("split", "persona", "bucket")), indexed_percentile(held, "__words", 0.95).select(F.coalesce("p", F.lit(0)).alias("words_p95"))):
        out = out.join(F.broadcast(part))  # each is one row
    return out


def score_systems(lines: DataFrame, text: str = "line", key: str = "system") -> DataFrame:
    """(system, n, faithful, rate, n_defects, distinct_1, distinct_2, duplicate_rate) of lines with event and state."""
    checked = lines.withColumn("__ok", textcheck.check(F.col(text), F.col("event"), F.col("state")).ok)
    counts = checked.groupBy(key).agg(F.count("*").alias("n"), F.count_if("__ok").alias("faithful"))
    counts = counts.withColumns({"rate": _share(F.col("faithful"), F.col("n")), "n_defects": F.col("n") - F.col("faithful")})
    return counts.join(diversity(lines, text, [key]).drop("n_lines"), key)


def defects(lines: DataFrame, text: str = "line") -> DataFrame:
    """lines with reasons, those that contradict their event or state."""
    return lines.withColumn("reasons", textcheck.check(F.col(text), F.col("event"), F.col("state")).reasons).where(F.size("reasons") > 0)


def comparison(scores: DataFrame, key: str = "system") -> DataFrame:
    """(system, n, faithfulness, distinct_2, self_dup_rate) of score_systems."""
    return scores.select(key, "n", round_exact(F.col("rate"), 4).alias("faithfulness"), "distinct_2", F.col("duplicate_rate").alias("self_dup_rate"))


def gate(tuned: DataFrame, base: DataFrame, margin: float = 0.05, least_distinct: float = 0.5, most_duplicates: float = 0.1) -> DataFrame:
    """(passed, reason, text) of one row each of (rate, distinct_2, duplicate_rate): the first condition that fails, and its figures."""
    t, b = tuned.alias("t"), base.alias("b")
    delta = F.col("t.rate") - F.col("b.rate")
    reason = F.when(delta < margin, "margin").when(F.col("t.distinct_2") < least_distinct, "distinct_2").when(F.col("t.duplicate_rate") > most_duplicates, "duplicate_rate").otherwise("passed")
    fixed = lambda x, form: F.format_string(form, x)
    share = lambda x, form="%.1f%%": fixed(round_exact(x * 100, 1), form)
    two = lambda c: fixed(round_exact(F.col(c), 2), "%.2f")
    text = (
        F.when(reason == "margin", F.concat(F.lit("faithfulness gain "), share(delta, "%+.1f%%"), F.lit(f" below the {margin:.0%} margin (fine-tuned "), share(F.col("t.rate")), F.lit(" vs base "), share(F.col("b.rate")), F.lit(")")))
        .when(reason == "distinct_2", F.concat(F.lit("diversity collapse: distinct-2 "), two("t.distinct_2"), F.lit(f" < {least_distinct:.2f}")))
        .when(reason == "duplicate_rate", F.concat(F.lit("repetition: self-dup "), two("t.duplicate_rate"), F.lit(f" > {most_duplicates:.2f}")))
        .otherwise(F.concat(F.lit("PASS: faithfulness "), share(F.col("t.rate")), F.lit(" vs base "), share(F.col("b.rate")), F.lit(" ("), share(delta, "%+.1f%%"), F.lit("); distinct-2 "), two("t.distinct_2")))
    )
    # a row each
    return t.join(F.broadcast(b)).select((reason == "passed").alias("passed"), reason.alias("reason"), text.alias("text"))


def cross_tab(items: DataFrame, keys: list[str], heuristic: str = "heuristic_ok", verdict: str = "faithful") -> DataFrame:
    """Cells of a check against a verdict; rows without a verdict count in n only."""
    h, v = F.col(heuristic), F.col(verdict)
    return items.groupBy(*keys).agg(F.count("*").alias("n"), F.count(v).alias("judged"), F.count_if(v).alias("faithful"), F.count_if(h & ~v).alias("false_negatives"), F.count_if(~h & v).alias("false_positives"), F.count_if(~h & ~v).alias("true_rejects"))


def failure_modes(items: DataFrame, modes: str, order: str) -> DataFrame:
    """(mode, n) by count, ties by first appearance."""
    e = items.select(order, F.posexplode(modes).alias("at", "mode"))
    return e.groupBy("mode").agg(F.count("*").alias("n"), F.min(F.struct(order, "at")).alias("first")).orderBy(F.desc("n"), "first").select("mode", "n")


def counters(rows: DataFrame, key: str = "status") -> DataFrame:
    """(key, n): what a run did, or a plan's examples by split."""
    return rows.groupBy(key).agg(F.count("*").alias("n"))


def build_counts(records: DataFrame) -> DataFrame:
    """(match_id, n_records, n_innings) of records; many matches, few innings each."""
    return records.groupBy("match_id").agg(F.count("*").alias("n_records"), F.countDistinct("innings").alias("n_innings"))


def catalog_counts(catalog: DataFrame) -> DataFrame:
    """(seasons, matches) of a catalog."""
    return catalog.agg(F.count("*").alias("seasons"), F.coalesce(F.sum(F.size("matches")), F.lit(0)).alias("matches"))
