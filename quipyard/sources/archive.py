"""Addresses of archive list pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def archive_pages_between(spans: DataFrame, base_url: str, catids: Sequence[int] = (0,)) -> DataFrame:
    """List pages newest first for every (first_year, last_year) row."""
    years = F.sequence(F.col("last_year"), F.col("first_year"), F.lit(-1))
    months = F.sequence(F.lit(12), F.lit(1), F.lit(-1))
    grid = (
        spans.select(F.explode(years).alias("year"))
        .select("year", F.explode(months).alias("month"))
        .select("year", "month", F.explode(F.array(*[F.lit(c) for c in catids])).alias("catid"))
    )
    return grid.select(*[F.col(c).cast("int").alias(c) for c in grid.columns]).withColumn(
        "url", F.format_string(f"{base_url.replace('%', '%%')}catid=%d&year=%d&month=%d", "catid", "year", "month")
    )


def archive_pages(
    spark: SparkSession,
    base_url: str,
    first_year: int = 2000,
    last_year: int = 2023,
    catids: Sequence[int] = (0,),
) -> DataFrame:
    span = spark.range(1).select(F.lit(first_year).alias("first_year"), F.lit(last_year).alias("last_year"))
    return archive_pages_between(span, base_url, catids)


def month_pages(df: DataFrame, as_of, base_url: str, catid: int = 0) -> DataFrame:
    """The list page of the month of a timestamp column, for every row."""
    return df.withColumns({"year": F.year(as_of), "month": F.month(as_of)}).withColumn(
        "url",
        F.format_string(f"{base_url.replace('%', '%%')}catid={catid}&year=%d&month=%d", F.year(as_of), F.month(as_of)),
    )
