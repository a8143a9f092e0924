"""Replays as streams: the frames of record files as they arrive, in order and to their end."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from seamfold.functions.folders import importable
from seamfold.operators.dataset import PACE, frames


def stream_frames(spark: SparkSession, path: str, schema: str, keys: list[str], order: str, text: str, start: int = 0) -> DataFrame:
    """A streaming DataFrame of frames; stateless, so it resumes from its source's offsets."""
    return frames(spark.readStream.schema(schema).parquet(path), keys, order, text, start)


def in_order(lines: DataFrame, keys: list[str], order: str, text: str, total: str, start: int = 0, patience: float | None = None) -> DataFrame:
    """(keys, seq, text, done) of a stream: each group's lines once and in order, then a row with done.

    A line waits until those before it have come, and one that comes again is left out. A group
    ends after its total of lines, told by any of its rows (null: not known); or, with
    patience, when nothing of it has come for so many seconds. State is kept in the query's
    checkpoint, so that a query that is started again goes on where it stopped. What it holds
    of a group are the next place and the lines that wait.
    """
    importable(lines.sparkSession)
    kinds = {f.name: f.dataType for f in lines.schema.fields}
    out = StructType([*(StructField(k, kinds[k]) for k in keys), StructField("seq", LongType()), StructField("text", StringType()), StructField("done", BooleanType())])
    names = [f.name for f in out.fields]

    def advance(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        place, n, waiting = state.get if state.exists else (start, None, [])
        held = dict(waiting or [])
        lines: list[tuple[int, str | None, bool]] = []
        if not state.hasTimedOut:
            for part in parts:
                for seq, line, whole in zip(*(part[c].tolist() for c in (order, text, total)), strict=True):
                    n = n if whole is None or whole != whole else int(whole)  # a null number is a NaN here
                    if place is not None and seq >= place:
                        held.setdefault(int(seq), line if isinstance(line, str) else None)
        while place is not None and place in held:
            lines.append((place, held.pop(place) or "", False))
            place += 1
        if place is not None and (state.hasTimedOut or (n is not None and place >= n)):
            lines.append((place, None, True))
            place, held = None, {}
        state.update((place, n, sorted(held.items())))
        if patience is not None and place is not None:
            state.setTimeoutDuration(int(patience * 1000))
        if lines:  # a frame, also an empty one, costs more than all else that is done for a group
            yield pd.DataFrame({**{k: [v] * len(lines) for k, v in zip(keys, key, strict=True)}, **dict(zip(names[len(keys) :], zip(*lines, strict=True), strict=True))})

    kept = StructType.fromDDL("place long, n long, waiting array<struct<seq: long, line: string>>")
    timeout = GroupStateTimeout.NoTimeout if patience is None else GroupStateTimeout.ProcessingTimeTimeout
    return lines.select(*keys, order, text, total).groupBy(*keys).applyInPandasWithState(advance, out, kept, "append", timeout)


def live_frames(lines: DataFrame, keys: list[str], order: str, text: str, total: str, start: int = 0, patience: float | None = None, done: Column | None = None, pace: float = PACE) -> DataFrame:
    """The frames of dataset.frames with their ends, of a stream, each with due: after how many seconds of a group's replay it is sent."""
    ordered = in_order(lines, keys, order, text, total, start, patience)
    out = frames(ordered, keys, "seq", "text", start, done=done, end=F.col("done"))
    return out.withColumn("due", (F.col("seq") - start) * F.lit(float(pace)))


def run_once(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what is there and stop; a later call goes on where this one ended."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
