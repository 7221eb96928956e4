"""From captured pages to the article and comment tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quipyard.operators.columns import normalize_columns
from quipyard.schemas import RAW_COMMENTS
from quipyard.session import store
from quipyard.sources.pages import (
    DEFAULT_LAYOUT,
    PageLayout,
    clean_details,
    comments_of,
    details_of,
    errors_of,
    parse_pages,
)
from quipyard.sources.tables import write_csv


#: What is counted while pages are parsed.
COUNTS = ("pages", "failed_pages", "comments", "comments_without_text", "comments_without_user")


@dataclass(frozen=True)
class Ingested:
    """The three tables, and COUNTS by name."""

    details: DataFrame
    comments: DataFrame
    errors: DataFrame
    counts: dict[str, int]


def _counts() -> list[Column]:
    """Quality of parsed pages as aggregates."""

    def comments(keep=None) -> Column:
        of = F.col("comments") if keep is None else F.filter("comments", keep)
        return F.coalesce(F.sum(F.when(F.col("comments").isNotNull(), F.size(of))), F.lit(0)).cast("bigint")

    counts = [
        F.count(F.lit(1)),
        F.count_if(F.col("error").isNotNull()),
        comments(),
        comments(lambda c: c["comment_text"].isNull()),
        comments(lambda c: c["username"].isNull()),
    ]
    return [count.alias(name) for name, count in zip(COUNTS, counts)]


def ingest_pages(pages: DataFrame, layout: PageLayout = DEFAULT_LAYOUT, separator: str = ": ") -> Ingested:
    """Parse every page once; the three results and the counts share that pass."""
    seen = Observation()
    parsed = store(parse_pages(pages, layout, ["details", "comments"]).observe(seen, *_counts()), "parsed-pages")
    return Ingested(
        counts=seen.get,
        details=clean_details(details_of(parsed), separator),
        comments=normalize_columns(comments_of(parsed).select(*RAW_COMMENTS.names)),
        errors=errors_of(parsed),
    )


def write_ingested(ingested: Ingested, folder: str) -> None:
    """`article_details.csv`, `article_comments.csv` and `page_errors.csv` below the folder."""
    write_csv(ingested.details, f"{folder}/article_details.csv")
    write_csv(ingested.comments, f"{folder}/article_comments.csv")
    write_csv(ingested.errors, f"{folder}/page_errors.csv")
