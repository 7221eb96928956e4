"""Request bodies, few-shot blocks and settings grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipyard.functions.prompts import example_block

# Settings tried for every sampled article, in tenths.
TOP_P_TENTHS = (9, 10, 11)
TEMPERATURE_TENTHS = (10, 11)


def request_batches(
    df: DataFrame,
    text: Column,
    position: str,
    size: int,
    temperature: float = 0.5,
    top_p: float = 0.7,
) -> DataFrame:
    """Request bodies with the texts of `size` consecutive positions each.

    Positions are unique, so a body holds at most `size` texts; a row without a position is an error.
    """
    missing = F.raise_error(F.lit("a row has no position"))
    batch = F.when(F.col(position).isNull(), missing).otherwise(F.floor(F.col(position) / F.lit(size))).cast("bigint")
    entries = F.sort_array(F.collect_list(F.struct(F.col("position"), F.col("text"))))
    return (
        df.select(batch.alias("batch_id"), F.col(position).alias("position"), text.alias("text"))
        .groupBy("batch_id")
        .agg(entries.alias("entries"))
        .select(
            "batch_id",
            F.col("entries.text").alias("list_of_title_article_text"),
            F.lit(temperature).alias("temperature"),
            F.lit(top_p).alias("top_p"),
        )
    )


def few_shot_block(examples: DataFrame, k: int, num_words: int = 300) -> DataFrame:
    """One row, `few_shot`: the first k examples by position, one after the other.

    Only k rows reach the final aggregate. Fewer than k examples are an error.
    """
    block = example_block(F.col("title_article_text"), F.col("comment"), num_words)
    first = examples.orderBy("position").limit(k).select("position", block.alias("block"))
    blocks = F.sort_array(F.collect_list(F.struct("position", "block")))
    count = F.count(F.lit(1))
    return first.agg(
        F.when(count < k, F.raise_error(F.format_string(f"asked for {k} examples, found %d", count)))
        .otherwise(F.array_join(blocks.getField("block"), ""))
        .alias("few_shot")
    )


def with_settings_grid(
    df: DataFrame,
    top_p_tenths: Sequence[int] = TOP_P_TENTHS,
    temperature_tenths: Sequence[int] = TEMPERATURE_TENTHS,
) -> DataFrame:
    """Every row once per (top_p, temperature)."""
    grid = [(p, t) for p in top_p_tenths for t in temperature_tenths]
    settings = F.array(
        *[F.struct(F.lit(p / 10).alias("top_p"), F.lit(t / 10).alias("temperature")) for p, t in grid]
    )
    return df.select("*", F.inline(settings))
