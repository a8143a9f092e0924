"""Scans: match documents with validity, record and pair files, reference texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seamfold import schemas
from seamfold.errors import BadDocument
from seamfold.sources.sinks import exists


def _missing(rows: Column, *fields: str) -> Column:
    return F.exists(F.coalesce(rows, F.array()), lambda x: F.greatest(*(F.coalesce(_at(x, f).isNull(), F.lit(True)) for f in fields)) if len(fields) > 1 else _at(x, fields[0]).isNull())


def _at(x: Column, path: str) -> Column:
    for part in path.split("."):
        x = x.getField(part)
    return x


def invalid_reason(innings: Column = None) -> Column:
    """Why a parsed match document breaks the schema, or null."""
    innings = F.col("innings") if innings is None else innings
    overs = F.flatten(F.transform(innings, lambda i: F.coalesce(i.overs, F.array())))
    balls = F.flatten(F.transform(overs, lambda o: F.coalesce(o.deliveries, F.array())))
    wickets = F.flatten(F.transform(balls, lambda b: F.coalesce(b.wickets, F.array())))
    spans = F.flatten(F.transform(innings, lambda i: F.coalesce(i.powerplays, F.array())))
    return (
        F.when(F.col("_corrupt_record").isNotNull(), "malformed")
        .when(F.col("info.teams").isNull(), "info.teams")
        .when(F.col("innings").isNull(), "innings")
        .when(_missing(innings, "team"), "innings.team")
        .when(F.exists(innings, lambda i: i.target.isNotNull() & i.target.runs.isNull()), "target.runs")
        .when(_missing(overs, "over"), "over")
        .when(_missing(balls, "batter", "bowler", "non_striker", "runs.batter", "runs.extras", "runs.total"), "delivery")
        .when(_missing(wickets, "player_out", "kind"), "wicket")
        .when(_missing(spans, "from", "to", "type"), "powerplay")
    )


def read_matches(spark: SparkSession, path: str) -> DataFrame:
    """All match documents under a folder with match_id (the file's stem), content hash and invalid (null if good)."""
    df = spark.read.schema(schemas.MATCH + ", _corrupt_record string").option("multiLine", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)
    name = F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), r"\.json$", "")
    return df.select(F.url_decode(name).alias("match_id"), F.col("_metadata.file_path").alias("file"), "meta", "info", "innings", "_corrupt_record").withColumn("invalid", invalid_reason()).drop("_corrupt_record")


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(match_id, input_sha256) of each JSON file under a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(path)
    return files.select(F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.json$", "").alias("match_id"), F.sha2("content", 256).alias("input_sha256"))


def select_matches(matches: DataFrame, ids: list[str] | None = None, season: str | None = None, limit: int | None = None) -> DataFrame:
    """Ids, then season, then the first limit by file; in this order."""
    if ids is not None:
        matches = matches.where(F.col("match_id").isin(ids))
    if season is not None:
        matches = matches.where(F.col("invalid").isNull() & (F.col("info.season") == season))
    return matches if limit is None else matches.orderBy("file").limit(limit)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RECORD).json(path)


def read_pairs(spark: SparkSession, path: str, bookkeeping: bool = False) -> DataFrame:
    """Pair files with their origin; files named judge_* only if bookkeeping is asked for."""
    df = spark.read.schema(schemas.PAIR).option("pathGlobFilter", "*.jsonl").json(path).withColumn("file", F.col("_metadata.file_name"))
    return df if bookkeeping else df.where(~F.col("file").startswith("judge_"))


def reference_texts(lines: DataFrame, column: str = "value") -> DataFrame:
    """(text): bare lines or {"text": ...} lines, trimmed, without empty ones."""
    line = F.trim(F.col(column))
    return lines.select(F.trim(F.when(line.startswith("{"), F.get_json_object(line, "$.text")).otherwise(line)).alias("text")).where("text <> ''")


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """The reference texts of a file or folder; none where there is nothing."""
    return reference_texts(spark.read.text(path)) if exists(spark, path) else spark.createDataFrame([], "text string")


def read_examples(spark: SparkSession, path: str, split: str | None = None, fetch: Callable[[str], str] | None = None) -> DataFrame:
    """Chat examples of JSON lines, of one split or all; fetch turns a hub's name into a path that can be read. Lines that are no examples raise BadDocument when they are met."""
    where = path if fetch is None else fetch(path)
    if split is not None:
        where = f"{where}/{split}.jsonl"
    df = spark.read.schema(schemas.EXAMPLE + ", _corrupt_record string").option("mode", "PERMISSIVE").json(where)
    bad = F.col("_corrupt_record").isNotNull() | F.col("messages").isNull()
    checked = F.when(bad, F.raise_error(F.concat(F.lit("no example: "), F.coalesce("_corrupt_record", F.lit("without messages"))))).otherwise(F.col("messages"))
    return df.withColumn("messages", checked).drop("_corrupt_record")


def good_matches(matches: DataFrame, required: bool = False) -> DataFrame:
    """The valid documents of read_matches; with required, one that is not valid is an error."""
    if required:
        bad = matches.where("invalid is not null").select("match_id", "invalid").limit(1).collect()
        if bad:
            raise BadDocument(f"match {bad[0].match_id}: {bad[0].invalid}")
    return matches.where("invalid is null")


def unfaithful_specs(lines: DataFrame, column: str = "value") -> DataFrame:
    """Judged items whose verdict is there and not faithful."""
    schema = "event string, state string, line string, persona_key string, bucket string, match_id string, ball_id string, verdict struct<faithful: boolean>"
    return lines.select(F.from_json(column, schema).alias("x")).select("x.*").where("verdict is not null and not coalesce(verdict.faithful, true)")
