"""A training corpus from raw documents: filter, dedup, decontaminate, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of
documents. What a stage has broadcast or written on its way is freed when the next one
begins, since its result is written by then.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from seamfold.llm import core, op1_lines, op2_decontaminate, op3_jaccard, op5_quality, op8_packing


_before: list[core.Held] = []


def _alone(stage):
    @functools.wraps(stage)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _before:
            _before.pop().free()
        with core.Held() as held:
            out = stage(spark, docs, sf_dir)
        _before.append(held)
        return out

    return call


@_alone
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return op5_quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_alone
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go, and documents that have no other."""
    return op1_lines.drop_lines(docs)


@_alone
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five words, a similarity of 0.8."""
    return op3_jaccard.keep_first(docs, words=5, num=80, den=100)


@_alone
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with benchmark items go."""
    return op2_decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_alone
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 1024, as pieces of documents with their places."""
    return op8_packing.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

#: No SQL: the classifier and the tokenizer cannot be expressed in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each from the written result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            out = core.scratch(out, f"stage{i}")
            if i:
                core.drop(docs)
        docs = out
    return docs
