"""Token counts for every context limit, from the exact histogram of encoded lengths.

Documents are aggregated by their number of tokens; sums over the histogram answer totals,
quantiles and truncated totals at every limit.  The histogram has one row for each length that
occurs.  Its running sums are taken in bands of lengths: one sum for each band, then within bands,
so no task holds more than the bands or the lengths of one band.

Defined results: null and empty texts have no tokens; equal rows count each; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.llm.token_ids import encoder, vocabulary_path

BAND = 512


def token_lengths(docs: DataFrame, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(n_tokens) of every document."""
    path = vocabulary or vocabulary_path()

    def lengths(batches):
        ids = encoder(path).ids
        for batch in batches:
            counts = [len(ids(body or "")) // 2 for body in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_pydict({"n_tokens": pa.array(counts, pa.int64())})

    return docs.select(F.col(text).alias("text")).mapInArrow(lengths, "n_tokens long")


def length_histogram(docs: DataFrame, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(n_tokens, n_docs)."""
    return token_lengths(docs, text, vocabulary).groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def with_running_sums(histogram: DataFrame) -> DataFrame:
    """For the limit ``n_tokens``: documents and tokens up to it, beyond it, and kept by truncation.

    ``docs_longer`` and ``tokens_longer`` are suffix sums; ``truncated_total`` is the sum of
    ``min(length, n_tokens)`` over all documents, ``quantile`` the share of documents that fit.
    For a limit c between two lengths l < c the total is ``truncated_total(l) + (c - l) *
    docs_longer(l)``; ``at_limits`` gives it.
    """
    banded = histogram.withColumn("band", F.floor(F.col("n_tokens") / BAND)).withColumn(
        "tokens", F.col("n_tokens") * F.col("n_docs")
    )
    totals = banded.groupBy("band").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    later = Window.orderBy("band").rowsBetween(1, Window.unboundedFollowing)
    whole = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select(
        "band",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("d_after"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t_after"),
        F.sum("d").over(whole).alias("all_docs"),
        F.sum("t").over(whole).alias("all_tokens"),
    )
    inside = Window.partitionBy("band").orderBy("n_tokens").rowsBetween(1, Window.unboundedFollowing)
    summed = banded.join(totals, "band").select(
        "n_tokens",
        "n_docs",
        "all_docs",
        "all_tokens",
        (F.coalesce(F.sum("n_docs").over(inside), F.lit(0)) + F.col("d_after")).alias("docs_longer"),
        (F.coalesce(F.sum("tokens").over(inside), F.lit(0)) + F.col("t_after")).alias("tokens_longer"),
    )
    return summed.select(
        "n_tokens",
        "n_docs",
        (F.col("all_docs") - F.col("docs_longer")).alias("docs_fitting"),
        "docs_longer",
        "tokens_longer",
        (F.col("all_tokens") - F.col("tokens_longer") + F.col("n_tokens") * F.col("docs_longer")).alias("truncated_total"),
        (F.col("tokens_longer") - F.col("n_tokens") * F.col("docs_longer")).alias("tokens_lost"),
        ((F.col("all_docs") - F.col("docs_longer")) / F.col("all_docs")).alias("quantile"),
    )


def at_limits(summed: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, truncated_total, docs_longer) for limits that need not occur as lengths."""
    asked = summed.sparkSession.createDataFrame([(limit,) for limit in limits], "context_limit long")
    below = F.max(F.when(F.col("n_tokens") <= F.col("context_limit"), F.struct("n_tokens", "truncated_total", "docs_longer")))
    everyone = F.max(F.col("docs_longer") + F.col("docs_fitting"))
    # The limits are the caller's list, so this is a small table against the histogram.
    return (
        summed.join(F.broadcast(asked))
        .groupBy("context_limit")
        .agg(below.alias("b"), everyone.alias("all_docs"))
        .select(
            "context_limit",
            F.coalesce(
                F.col("b.truncated_total") + (F.col("context_limit") - F.col("b.n_tokens")) * F.col("b.docs_longer"),
                F.col("context_limit") * F.col("all_docs"),
            ).alias("truncated_total"),
            F.coalesce("b.docs_longer", "all_docs").alias("docs_longer"),
        )
    )
