"""Few-shot examples kept as one base64 text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipyard.functions.prompts import COMMENT_HEAD, EXAMPLE_SUMMARY_HEAD
from quipyard.functions.text import decode_base64


def read_few_shot_text(spark: SparkSession, path: str) -> DataFrame:
    """One row, `few_shot`: the decoded text of the file."""
    return spark.read.text(path, wholetext=True).select(decode_base64(F.col("value")).alias("few_shot"))


def few_shot_examples(texts: DataFrame) -> DataFrame:
    """Examples (position, title_article_text, comment) found in decoded few-shot texts."""
    blocks = F.split("few_shot", rf"\Q{EXAMPLE_SUMMARY_HEAD}\E", -1)
    parts = F.split("block", rf"\Q{COMMENT_HEAD}\E", 2)
    return (
        texts.select(F.posexplode(blocks).alias("position", "block"))
        # What precedes the first heading is no example.
        .where("position > 0")
        .select(
            "position",
            parts[0].alias("title_article_text"),
            F.regexp_replace(parts[1], r"\n\n\z", "").alias("comment"),
        )
    )
