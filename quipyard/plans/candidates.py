"""Which articles to comment on next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipyard.functions.text import title_and_text
from quipyard.operators.filters import filter_candidates
from quipyard.operators.joins import uncommented_articles
from quipyard.operators.sampling import first_n


def select_candidates(
    articles: DataFrame,
    comments: DataFrame,
    username: str,
    n: int = 3,
    position: str = "position",
    **filters,
) -> DataFrame:
    """The first n articles in archive order that suit and that the user has not commented on.

    An article listed or captured many times counts once, at its first position; equal
    positions go by url. The texts join only after the choice, so at most n urls look for
    them; of several texts of a url the least is taken.
    """
    listed = articles.where("url IS NOT NULL").groupBy("url").agg(F.min(position).alias(position))
    order = filter_candidates(listed, **filters)
    chosen = first_n(uncommented_articles(order, comments, username), position, n, "url")
    text = title_and_text(F.col("title"), F.col("article_text")).alias("title_article_text")
    # n rows at most
    texts = articles.join(F.broadcast(chosen.select("url")), "url").groupBy("url").agg(F.min(text).alias("title_article_text"))
    return chosen.join(texts, "url").select("url", position, "title_article_text")
