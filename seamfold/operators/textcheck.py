"""Checks of text against the facts that it was written from, by Arrow functions over columns (see functions/claims.py)."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seamfold.functions import claims as reader


def _arrow(f: Callable[..., pa.Array], kind: str, *columns: Column) -> Column:
    def one(a: pa.Array) -> pa.Array:
        return f(a)

    def three(a: pa.Array, b: pa.Array, c: pa.Array) -> pa.Array:
        return f(a, b, c)

    def four(a: pa.Array, b: pa.Array, c: pa.Array, d: pa.Array) -> pa.Array:
        return f(a, b, c, d)

    call = {1: one, 3: three, 4: four}[len(columns)]
    call.__annotations__ = dict.fromkeys((*call.__annotations__,), pa.Array)
    return F.arrow_udf(call, kind)(*columns)


def claims(line: Column) -> Column:
    """struct(score, equation, fallen, six, big, four, out) of a line; numbers as digits, what it does not claim is null or false."""
    return _arrow(reader.read_column, reader.DDL, line)


def score(text: Column) -> Column:
    """The first "a/b", as a struct (a, b)."""
    return claims(text).score


def equation(text: Column) -> Column:
    """The first "a off b" with a word of chasing near it, as a struct (a, b)."""
    return claims(text).equation


def check(line: Column, event: Column, state: Column) -> Column:
    """struct(ok, reasons): how a line contradicts its event and state, in a fixed order; nulls count as empty."""
    return _arrow(reader.check_columns, "struct<ok: boolean, reasons: array<string>>", line, event, state)


def tokens(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit("[a-z']+"), F.lit(0))


def ngrams(words: Column, n: int) -> Column:
    """Arrays of n words each; none if there are fewer."""
    return F.when(F.size(words) < n, F.array().cast("array<array<string>>")).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1))), lambda i: F.slice(words, i, n)))


#: Grams of seeds that are broadcast.
BROADCAST_GRAMS = 2_000_000


def overlapping(lines: DataFrame, seeds: DataFrame, key: str, text: str = "text", n: int = 6) -> DataFrame:
    """The keys of lines that share n consecutive words with any seed.

    Grams travel as pairs of 64-bit hashes; the seeds' are broadcast if they are few, after counting them.
    """

    def grams(df: DataFrame, *keep: str) -> DataFrame:
        held = [F.col(c).alias(f"__{c}") for c in keep]
        words = df.select(*held, F.transform(tokens(F.col(text)), lambda w: F.xxhash64(w)).alias("t"))
        # the words are a column of their own, so that they are not found again for each gram
        spots = words.select("*", F.posexplode_outer("t").alias("i", "w")).where(F.col("i") + n <= F.size("t"))
        each = [F.get("t", F.col("i") + k) for k in range(n)]
        return spots.select(*(F.col(f"__{c}") for c in keep), F.xxhash64(*each).alias("g"), F.xxhash64(F.lit(n), *reversed(each)).alias("h"))

    own = grams(seeds).distinct()
    own = F.broadcast(own) if own.count() <= BROADCAST_GRAMS else own
    return grams(lines, key).join(own, ["g", "h"], "left_semi").select(F.col(f"__{key}").alias(key)).distinct()


#: Grams of seeds that are held beside each line.
HELD_GRAMS = 100_000


def with_copies(lines: DataFrame, seeds: DataFrame, text: str, column: str, n: int = 6) -> DataFrame:
    """lines with whether they share n consecutive words with any seed; each line is read once, so lines may come out of paid calls.

    The seeds' grams are one row that is broadcast; more than HELD_GRAMS of them raise ValueError (overlapping has no such bound).
    """
    grams = lambda c: F.transform(ngrams(tokens(F.coalesce(c, F.lit(""))), n), lambda g: F.array_join(g, " "))
    own = seeds.select(F.explode(grams(F.col("text"))).alias("g")).distinct()
    if own.count() > HELD_GRAMS:
        raise ValueError(f"more than {HELD_GRAMS} grams of seeds; use overlapping")
    held = own.agg(F.collect_list("g").alias("__seeds"))
    return lines.crossJoin(F.broadcast(held)).withColumn(column, F.arrays_overlap(grams(F.col(text)), F.col("__seeds"))).drop("__seeds")


def drawn_line(text: Column) -> Column:
    """A draw cut to its first line, trimmed."""
    return F.trim(F.element_at(F.split(F.trim(F.coalesce(text, F.lit("")), F.lit(" \t\r\n")), r"\R", 2), 1))


VALIDATED = "struct<line: string, faithful: boolean, source: string, attempts: int, reasons: array<string>>"


def validated(draws: Column, event: Column, state: Column, fallback: Column) -> Column:
    """struct(line, faithful, source, attempts, reasons): the first of several draws that holds, or the fallback.

    Draws are cut to their first lines; empty ones are no lines but count as attempts. If
    none holds, reasons are those of the last line that was checked. Draws after the first
    that holds are not looked at. Where draws are made one by one, see runs.redraw.
    """
    return _arrow(reader.validate_columns, VALIDATED, draws, event, state, fallback)


def first_faithful(draws: Column, ok: Column) -> Column:
    """The first draw whose ok is true, or null."""
    return F.try_element_at(F.transform(F.filter(F.arrays_zip(draws.alias("d"), ok.alias("k")), lambda x: x.k), lambda x: x.d), F.lit(1))
