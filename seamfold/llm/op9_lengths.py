"""Token counts: the exact histogram of encoded lengths and what follows from its suffix sums."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seamfold.llm.core import prepare, scratch
from seamfold.llm.tokens import encoder

#: Lengths whose sums are taken together; the sums over such blocks are few.
BLOCK = 1024


def length_histogram(docs: DataFrame, tokenizer: str | None = None, text_col: str = "text") -> DataFrame:
    """(n_tokens, n_docs): how many rows of docs encode to so many tokens.

    Null texts count as empty, repeated rows each time; other columns are ignored; no rows give none.
    """
    prepare(docs.sparkSession)

    def run(batches):
        encode = encoder(tokenizer).ids
        for batch in batches:
            sizes: dict[int, int] = {}
            for text in batch.column(0).to_pylist():
                n = len(encode(text))
                sizes[n] = sizes.get(n, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(sizes), pa.int64()), pa.array(list(sizes.values()), pa.int64())], names=["n_tokens", "n"])

    return docs.select(F.col(text_col).cast("string")).mapInArrow(run, "n_tokens long, n long").groupBy("n_tokens").agg(F.sum("n").alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For each length of a histogram, what holds for texts at least so long and for a context of that limit.

    (n_tokens, n_docs, docs_at_least, tokens_at_least, docs_below, tokens_below,
    truncated_total, total_docs, total_tokens): truncated_total is the number of tokens
    left if every text is cut to n_tokens. An empty histogram gives no rows. Sums run
    within blocks of lengths and over the blocks, so no task sees all lengths at once.
    """
    h = scratch(histogram, "histogram").select("n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"), F.floor(F.col("n_tokens") / F.lit(BLOCK)).alias("block"))
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("bd"), F.sum("tokens").alias("bt"))
    # one row for each thousand token lengths: a few, whatever the number of texts
    later = Window.orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    everything = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0)
    blocks = blocks.select("block", F.coalesce(F.sum("bd").over(later), zero).alias("ld"), F.coalesce(F.sum("bt").over(later), zero).alias("lt"), F.sum("bd").over(everything).alias("total_docs"), F.sum("bt").over(everything).alias("total_tokens"))
    within = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    s = h.select("n_tokens", "n_docs", "block", F.sum("n_docs").over(within).alias("d"), F.sum("tokens").over(within).alias("t")).join(blocks, "block")
    s = s.select("n_tokens", "n_docs", (F.col("d") + F.col("ld")).alias("docs_at_least"), (F.col("t") + F.col("lt")).alias("tokens_at_least"), "total_docs", "total_tokens")
    below = F.col("total_tokens") - F.col("tokens_at_least")
    return s.select("n_tokens", "n_docs", "docs_at_least", "tokens_at_least", (F.col("total_docs") - F.col("docs_at_least")).alias("docs_below"), below.alias("tokens_below"), (below + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_total"), "total_docs", "total_tokens")


def truncated_totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(limit, docs_cut, truncated_total) for any limits, from suffix sums, in one aggregation."""
    # the least length above a limit starts the suffix that is cut; without one nothing is
    above = lambda x: F.min(F.when(F.col("n_tokens") > x, F.struct("n_tokens", "docs_at_least", "tokens_below")))
    answers = [F.struct(F.lit(int(x)).cast("long").alias("limit"), above(int(x)).alias("cut")) for x in limits]
    row = sums.agg(F.array(*answers).alias("x"), F.coalesce(F.max("total_tokens"), F.lit(0)).alias("total")).select(F.explode("x").alias("x"), "total")
    return row.select("x.limit", F.coalesce("x.cut.docs_at_least", F.lit(0)).alias("docs_cut"), F.coalesce(F.col("x.cut.tokens_below") + F.col("x.limit") * F.col("x.cut.docs_at_least"), "total").alias("truncated_total"))


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the least length that at least this share of the texts does not exceed; null without texts."""
    upto = F.col("docs_below") + F.col("n_docs")
    answers = [F.struct(F.lit(float(x)).alias("share"), F.min(F.when(upto >= F.lit(float(x)) * F.col("total_docs"), F.col("n_tokens"))).alias("n_tokens")) for x in shares]
    return sums.agg(F.array(*answers).alias("x")).select(F.explode("x").alias("x")).select("x.share", "x.n_tokens")
