"""Check generated comments and log the good ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipyard.functions.text import iso_timestamp
from quipyard.operators.filters import generation_problems


def with_problems(generated: DataFrame) -> DataFrame:
    """Add `reasons`, empty for a good comment."""
    return generated.withColumn("reasons", generation_problems(F.col("comment")))


def review_generations(generated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with reasons), both read off one mark per row.

    A generator need not repeat itself: store its output first, as `review_batch` does.
    """
    marked = with_problems(generated)
    good = F.size("reasons") == 0
    return marked.where(good).drop("reasons"), marked.where(~good)


def log_records(accepted: DataFrame, now=None) -> DataFrame:
    """Log rows (comment_id, url, comment, datetime); `now` defaults to the current time."""
    moment = F.current_timestamp() if now is None else now
    return accepted.select("comment_id", "url", "comment", moment.alias("datetime"))


def log_json(records: DataFrame) -> DataFrame:
    """(comment_id, json): one JSON object per log record, nulls included."""
    record = F.struct("comment_id", "url", "comment", iso_timestamp(F.col("datetime")).alias("datetime"))
    return records.select("comment_id", F.to_json(record, {"ignoreNullFields": "false"}).alias("json"))
