"""Audits of lines: items, cross-tabulation against verdicts, the report and its page."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamfold.functions.rounding import round_exact
from seamfold.operators import textcheck

# fixed values: severities from the worst, and verdicts' shape
SEVERITIES = ("critical", "major", "minor", "none")
VERDICT = "struct<faithful: boolean, severity: string, failure_modes: array<string>, persona_match: boolean, confidence: string, explanation: string>"


def items(pairs: DataFrame, line: str = "commentary", source: str = "pilot") -> DataFrame:
    """Pairs as audit items with the check's result; a missing bucket, match or ball is '?'."""
    text = F.col(line)
    known = lambda c: (F.coalesce(F.col(c), F.lit("?")) if c in pairs.columns else F.lit("?")).alias(c)
    found = textcheck.check(text, F.col("event"), F.col("state"))
    held = pairs.select(F.col("persona"), "event", "state", text.alias("line"), *(known(c) for c in ("bucket", "match_id", "ball_id")), found.alias("__c"))
    return held.withColumns({"heuristic_ok": F.col("__c.ok"), "heuristic_reasons": F.col("__c.reasons"), "source": F.lit(source)}).drop("__c")


def generated(candidates: DataFrame, line: str = "line") -> DataFrame:
    """Candidates with drawn lines as items, kept and rejected ones alike."""
    return items(candidates, line, "generated")


def rotated(candidates: DataFrame, place: Column, keys: list[str]) -> DataFrame:
    """Candidates with persona keys dealt in turn by place, counted from 0."""
    return candidates.withColumn("persona", F.get(F.array(*map(F.lit, keys)), F.pmod(place, F.lit(len(keys))).cast("int")))


def cells(judged: DataFrame, by: list[str]) -> DataFrame:
    """Counts by group: n, judged, faithful, persona_ok, and how the check and the verdict met."""
    good, ok = F.col("verdict.faithful"), F.col("heuristic_ok")
    n = lambda c, name: F.count_if(F.coalesce(c, F.lit(False))).alias(name)
    return judged.groupBy(*by).agg(
        F.count("*").alias("n"), n(F.col("verdict").isNotNull(), "n_judged"), n(good, "faithful"), n(~good, "unfaithful"), n(F.col("verdict.persona_match"), "persona_ok"),
        n(ok & ~good, "false_negatives"), n(~ok & good, "false_positives"), n(~ok & ~good, "true_rejects"),
    )


def by_group(judged: DataFrame, key: str) -> DataFrame:
    """(key, faithful, total) of judged items."""
    return judged.where("verdict is not null").groupBy(key).agg(F.count_if(F.col("verdict.faithful")).alias("faithful"), F.count("*").alias("total"))


def severities(judged: DataFrame) -> DataFrame:
    return judged.where("verdict is not null").groupBy(F.col("verdict.severity").alias("severity")).agg(F.count("*").alias("n"))


def modes(judged: DataFrame, order: str) -> DataFrame:
    """(mode, n): how often each failure mode was given, the most frequent first, ties by first appearance."""
    each = judged.where("verdict is not null").select(order, F.posexplode("verdict.failure_modes").alias("__at", "mode"))
    return each.groupBy("mode").agg(F.count("*").alias("n"), F.min(F.struct(order, "__at")).alias("__first")).orderBy(F.desc("n"), "__first").select("mode", "n")


def report(judged: DataFrame, order: str, spent: float = 0.0, generation: float = 0.0) -> DataFrame:
    """One row with all counts, rates to four places, histograms as maps, and what was spent."""
    ratio = lambda a: round_exact(F.when(F.col("n_judged") > 0, F.col(a) / F.col("n_judged")).otherwise(0.0), 4)
    entries = lambda df, key, value: df.agg(F.map_from_entries(F.collect_list(F.struct(F.col(key), value))).alias("m"))
    pair = F.array("faithful", "total")
    # each of these is one row
    parts = {
        "severity": entries(severities(judged), "severity", F.col("n")),
        "failure_modes": modes(judged, order).agg(F.collect_list(F.struct("mode", "n")).alias("m")),
        "by_bucket": entries(by_group(judged, "bucket"), "bucket", pair),
        "by_persona": entries(by_group(judged, "persona"), "persona", pair),
    }
    one = cells(judged.withColumn("__all", F.lit(1)), ["__all"]).drop("__all")
    for name, df in parts.items():
        one = one.join(F.broadcast(df.withColumnRenamed("m", name)))
    money = lambda x: F.lit(float(f"{x:.4f}"))
    return one.withColumns({"n_judge_failed": F.col("n") - F.col("n_judged"), "faithfulness_rate": ratio("faithful"), "persona_match_rate": ratio("persona_ok"), "judge_spend_usd": money(spent), "gen_spend_usd": money(generation)}).drop("persona_ok")


def defects(judged: DataFrame, order: str) -> DataFrame:
    """Items that a verdict calls unfaithful, the worst severity first, else in order."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, SEVERITIES)), F.col("verdict.severity")), F.lit(0)), F.lit(len(SEVERITIES) + 1))
    return judged.where("verdict is not null and not verdict.faithful").withColumn("__rank", rank).orderBy("__rank", order).drop("__rank")


# fixed values: the wording of the page, line by line
def defect_text() -> Column:
    """The entry of a defect on the page."""
    v = lambda f: F.coalesce(F.col(f"verdict.{f}"), F.lit(""))
    tags = F.array_join("verdict.failure_modes", ", ")
    kept = F.when(F.col("heuristic_ok"), "KEPT by heuristic").otherwise("dropped by heuristic")
    rows = [
        F.concat(F.lit("### ["), v("severity"), F.lit("] "), F.when(tags != "", tags).otherwise("unspecified"), F.lit("  ("), kept, F.lit(")")),
        F.concat(F.lit("- persona/bucket: "), F.col("persona"), F.lit(" / "), F.col("bucket"), F.lit("  (match "), F.col("match_id"), F.lit(" ball "), F.col("ball_id"), F.lit(")")),
        F.concat(F.lit("- EVENT: "), F.col("event")), F.concat(F.lit("- STATE: "), F.col("state")), F.concat(F.lit("- LINE: "), F.col("line")), F.concat(F.lit("- judge: "), v("explanation")),
    ]
    return F.concat_ws("\n", *rows, F.lit(""))


def page(summary: dict, entries: list[str], label: str) -> str:
    """The audit's page of a report row, and the texts of some defects behind it."""
    # fixed values: the wording of the head
    share = lambda x: f"{x:.1%}"
    tags = [f"- {m['mode']}: {m['n']}" for m in summary["failure_modes"]] or ["- none"]
    head = [
        f"# Failure-mode audit - {label}", "",
        f"- items judged: {summary['n_judged']} (judge failures: {summary['n_judge_failed']})",
        f"- judge faithfulness rate: {share(summary['faithfulness_rate'])} ({summary['faithful']} faithful / {summary['unfaithful']} defects)",
        f"- persona-match rate: {share(summary['persona_match_rate'])}",
        f"- heuristic vs judge: false-negatives (kept but bad) = {summary['false_negatives']}, false-positives (dropped but fine) = {summary['false_positives']}, true-rejects = {summary['true_rejects']}",
        f"- severity: {dict(sorted(summary['severity'].items()))}",
        f"- spend: judge ${summary['judge_spend_usd']:.4f} + generation ${summary['gen_spend_usd']:.4f}",
        "", "## Failure modes (judge tags)", "", *tags, "", "## Defects (judge ruled unfaithful), worst first", "",
    ]
    return "\n".join(head + entries)


def write_outputs(judged: DataFrame, folder: str, label: str, order: str, spent: float = 0.0, generation: float = 0.0) -> None:
    """folder/label.report, .catalog and .judged: the report as JSON, the page, and every judged item as JSON lines.

    The page lists all defects: its files follow each other, the first has the head and the
    others the defects in their order, sorted by ranges.
    """
    spark = judged.sparkSession
    summary = report(judged, order, spent, generation).first().asDict(recursive=True)
    text = lambda s, kind: spark.createDataFrame([(s,)], "value string").coalesce(1).write.mode("overwrite").option("lineSep", "\n").text(f"{folder}/{label}.{kind}")
    text(json.dumps(summary, sort_keys=True), "report")
    head = spark.createDataFrame([(page(summary, [], label),)], "value string").coalesce(1)
    head.unionByName(defects(judged, order).select(defect_text().alias("value"))).write.mode("overwrite").option("lineSep", "\n").text(f"{folder}/{label}.catalog")
    fields = ("persona", "bucket", "match_id", "ball_id", "event", "state", "line", "heuristic_ok", "heuristic_reasons", "verdict", "source")
    judged.select(*fields).write.mode("overwrite").option("ignoreNullFields", False).json(f"{folder}/{label}.judged")
