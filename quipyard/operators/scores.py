"""Token scores of generations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipyard.functions.votes import percent_text, token_probability


def with_token_probability(scores: DataFrame) -> DataFrame:
    """Add `probability` and its percent text to (…, logprob) rows."""
    probability = token_probability(F.col("logprob"))
    return scores.select("*", probability.alias("probability"), percent_text(probability).alias("percent"))


def mean_token_probability(scores: DataFrame) -> DataFrame:
    return scores.groupBy("generation_id").agg(
        F.avg(token_probability(F.col("logprob"))).alias("mean_probability"),
        F.count(F.lit(1)).alias("tokens"),
    )
