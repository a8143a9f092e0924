"""Prompts out of rows: personas and exemplars are small tables, texts are templates that the caller gives.

A template names its fields in braces. Instructions and rubrics are the caller's own
texts: what matters for results is which fields stand where, and in which order.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seamfold.errors import UnknownKey

PERSONA = "key string, display_name string, instruction string, primary boolean"
EXEMPLAR = "place int, event string, state string, lines map<string, string>"

# fixed values: turns that answers are read against
EXAMPLE_HEADING = "VOICE EXAMPLES"
TEACHER_TURN = "PERSONA: {key} - {instruction}\nBALL: {event}\nSTATE: {state}\n\nWrite one line of commentary in the {display_name} voice."
JUDGE_TURN = "PERSONA: {key} - {instruction}\nEVENT: {event}\nSTATE: {state}\nLINE: {line}\n\nAudit the LINE. Call record_verdict."


#: Personas that a table may have to be broadcast.
PERSONAS = 10_000


def _few(table: DataFrame) -> DataFrame:
    """A table of personas, checked to be small enough to be broadcast."""
    if table.limit(PERSONAS + 1).count() > PERSONAS:
        raise ValueError(f"more than {PERSONAS} personas")
    return F.broadcast(table)


def filled(template: str, **fields: Column) -> Column:
    """A template with its {names} replaced by columns; a null field makes it null."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*(fields[x] if i % 2 else F.lit(x) for i, x in enumerate(parts)))


def personas(spark: SparkSession, rows: list[tuple[str, str, str, bool]]) -> DataFrame:
    return spark.createDataFrame(rows, PERSONA)


def with_persona(items: DataFrame, table: DataFrame, column: str = "persona") -> DataFrame:
    """Items with their persona's attributes; UnknownKey if one's persona is not in the table.

    The check is one distinct over the column and brings at most a few unknown keys to the driver.
    """
    unknown = items.select(F.col(column).alias("key")).distinct().join(_few(table.select("key")), "key", "left_anti").limit(5).collect()
    if unknown:
        raise UnknownKey(f"unknown personas {[r.key for r in unknown]}; known: {[r.key for r in table.select('key').orderBy('key').collect()]}")
    own = table.select(F.col("key").alias(column), "display_name", "instruction")
    return items.join(_few(own), column)


def primary(table: DataFrame) -> DataFrame:
    return table.where("primary")


def secondary(table: DataFrame) -> DataFrame:
    return table.where("not primary")


def system_prompt(template: str) -> Column:
    """Of rows with a persona's attributes."""
    return filled(template, display_name=F.col("display_name"), instruction=F.col("instruction"))


def teacher_turn() -> Column:
    return filled(TEACHER_TURN, key=F.col("persona"), instruction=F.col("instruction"), event=F.col("event"), state=F.col("state"), display_name=F.col("display_name"))


def judge_turn() -> Column:
    return filled(JUDGE_TURN, key=F.col("persona"), instruction=F.col("instruction"), event=F.col("event"), state=F.col("state"), line=F.col("line"))


def seed_lines(exemplars: DataFrame) -> DataFrame:
    """(text): every line of every exemplar."""
    return exemplars.select(F.explode(F.map_values("lines")).alias("text"))


def exemplars_for(exemplars: DataFrame, persona: str) -> DataFrame:
    """The exemplars that have a line of a persona, with it."""
    return exemplars.where(F.map_contains_key("lines", F.lit(persona))).withColumn("line", F.col("lines")[persona])


def example_block(exemplars: DataFrame, table: DataFrame) -> DataFrame:
    """(text): one row, all exemplars by persona, in the tables' order; table has a column place.

    Both are tables of a prompt's size.
    """
    shown = exemplars.select("place", "event", "state", F.explode("lines").alias("key", "line")).join(_few(table.select("key", F.col("place").alias("persona_place"))), "key")
    part = F.struct("place", filled("BALL: {event}\nSTATE: {state}\nLINE: {line}", event=F.col("event"), state=F.col("state"), line=F.col("line")).alias("text"))
    by = table.select("key", "display_name", "place").join(shown.groupBy("key").agg(F.sort_array(F.collect_list(part)).alias("parts")), "key", "left")
    heading = filled("\n## {display_name} ({key})", display_name=F.col("display_name"), key=F.col("key"))
    block = F.array_join(F.concat(F.array(heading), F.coalesce(F.transform("parts", lambda p: p.text), F.array().cast("array<string>"))), "\n")
    rows = by.select(F.struct("place", block.alias("text")).alias("b")).agg(F.sort_array(F.collect_list("b")).alias("b"))
    return rows.select(F.concat_ws("\n", F.lit(EXAMPLE_HEADING), F.transform("b", lambda b: b.text)).alias("text"))


def token_estimate(text: Column) -> Column:
    """About how many tokens a text takes: a quarter of its characters."""
    return F.floor(F.char_length(text) / 4)
