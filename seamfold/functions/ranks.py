"""Places of rows in a global order, without any task that sees all of them.

Bounds that cut the order into ranges of about equal size are taken from a sample by hash.
Every row finds its range by two short searches, ranges are counted, and a row's place is
what its range's predecessors hold plus its number within the range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seamfold.functions.folders import written

#: Groups of ranges, and ranges of a group.
FAN = 24
#: Sampled keys for each range.
SAMPLED = 16


def _ranged(rows: DataFrame, order: list[Column | str], total: int) -> DataFrame:
    """rows with __key, what they are ordered by, and __range, ascending with it."""
    keyed = rows.withColumn("__key", F.struct(*(F.col(c) if isinstance(c, str) else c for c in order)))
    share = min(1.0, FAN * FAN * SAMPLED / max(1, total))
    drawn = keyed.where(F.pmod(F.xxhash64("__key"), F.lit(1 << 30)) < int(share * (1 << 30))).select("__key")
    # one task numbers a sample whose expected size is fixed
    spots = drawn.select("__key", F.row_number().over(Window.orderBy("__key")).alias("i"), F.count("*").over(Window.partitionBy(F.lit(0))).alias("n"))
    step = F.greatest(F.lit(1), F.floor(F.col("n") / (FAN * FAN)))
    cuts = spots.where((F.col("i") % step == 0) & (F.floor(F.col("i") / step) < FAN * FAN)).select(F.floor(F.floor(F.col("i") / step) / FAN).alias("g"), "__key")
    groups = cuts.groupBy("g").agg(F.array_sort(F.collect_list("__key")).alias("fine"))
    one = groups.agg(F.array_sort(F.collect_list(F.struct("g", "fine"))).alias("groups"))  # FAN rows become one
    one = one.select(F.transform("groups", lambda x: x.fine).alias("__fine"), F.transform("groups", lambda x: F.element_at(x.fine, 1)).alias("__coarse"))
    upto = lambda bounds: F.size(F.filter(bounds, lambda b: b <= F.col("__key")))
    held = keyed.join(F.broadcast(one)).withColumn("__group", upto(F.col("__coarse")))
    inside = F.coalesce(upto(F.try_element_at("__fine", F.col("__group"))), F.lit(0))
    return held.withColumn("__range", F.when(F.col("__group") == 0, 0).otherwise(F.col("__group") * (FAN + 1) + inside)).drop("__fine", "__coarse", "__group")


def placed(rows: DataFrame, order: list[Column | str], column: str = "__place") -> DataFrame:
    """rows with their places, counted from 0, in ascending order of some columns or expressions, nulls first.

    Rows of one key share a range, so the key should tell rows apart; ties are in no fixed order. The
    ranges' counts, at most FAN * (FAN + 2) rows, are summed in one task. Names that begin with __ are this function's.
    The rows are written to the shared folder first, since they are read several times.
    """
    return _placed(written(rows, "placed"), order, column)


def _placed(rows: DataFrame, order: list[Column | str], column: str) -> DataFrame:
    ranged = _ranged(rows, order, rows.count())
    sizes = ranged.groupBy("__range").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__range", before.alias("__start"))
    number = F.row_number().over(Window.partitionBy("__range").orderBy("__key")) - 1
    return ranged.withColumn("__number", number).join(F.broadcast(starts), "__range").withColumn(column, (F.col("__start") + F.col("__number")).cast("long")).drop("__key", "__range", "__start", "__number")


def placed_within(rows: DataFrame, groups: str, order: list[Column | str], column: str = "__place", held: bool = False) -> DataFrame:
    """The same within each value of a column of few values; a group of any size is dealt over ranges. held: rows are a written table already."""
    rows = rows if held else written(rows, "placed")
    whole = _placed(rows, [groups, *order], "__whole")
    sizes = rows.groupBy(F.col(groups).alias("__group")).agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy(F.asc_nulls_first("__group")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__group", before.alias("__start"))
    return whole.join(F.broadcast(starts), F.col(groups).eqNullSafe(F.col("__group"))).withColumn(column, F.col("__whole") - F.col("__start")).drop("__whole", "__group", "__start")
