"""What calls a model, behind an injected function, and what surrounds the calls."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# fixed values: a verdict's fields and what they may hold
SEVERITIES, CONFIDENCES = ("none", "minor", "major", "critical"), ("high", "medium", "low")
VERDICT = "struct<faithful: boolean, severity: string, failure_modes: array<string>, persona_match: boolean, confidence: string, explanation: string>"


def generate(items: DataFrame, call: Callable[[list[dict]], list[str]], column: str = "line") -> DataFrame:
    """items with a column of what call gives for a batch of rows."""

    def run(batches):
        for batch in batches:
            yield batch.append_column(column, pa.array(call(batch.to_pylist()), pa.string()))

    return items.mapInArrow(run, StructType([*items.schema.fields, StructField(column, StringType())]))


def status(line: Column, ok: Column, seed_copy: Column) -> Column:
    """Faithfulness first, then copies of the seeds, then kept; no line at all is a failure."""
    return F.when(line.isNull(), "failed").when(~ok, "rejected_faithfulness").when(seed_copy, "rejected_seed_dedup").otherwise("kept")


def parse_verdict(answer: Column) -> Column:
    """The verdict in an answer, from the first brace to the last; null unless all its fields are there and valid."""
    v = F.from_json(F.regexp_extract(answer, r"(?s)\{.*\}", 0), VERDICT)
    valid = v.faithful.isNotNull() & v.severity.isin(*SEVERITIES) & v.confidence.isin(*CONFIDENCES) & v.failure_modes.isNotNull() & v.persona_match.isNotNull() & v.explanation.isNotNull()
    return F.when(valid, v)


def dropped(pairs: DataFrame, high_risk: Column, verdict: Column) -> DataFrame:
    """Pairs that go: of high risk, judged, and not faithful. Without a verdict a pair stays."""
    return pairs.where(high_risk & verdict.isNotNull() & ~F.coalesce(verdict.faithful, F.lit(True)))
