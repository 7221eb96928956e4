"""Best and worst row per article.

Every pick is the minimum of a struct of sort key and row: map-side partial
aggregation leaves one row per article and task before the shuffle, so an article
that holds a third of all comments costs no more than any other, and both picks
share one shuffle. Rows that tie in the whole key are told apart by their values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quipyard.functions.votes import net_votes


def _nulls_last(*keys: Column) -> list[Column]:
    return [part for key in keys for part in (key.isNull(), key)]


def most_upvoted_key(up: Column, tie: Column) -> Column:
    """Sorts by up votes descending, nulls last, then `tie`."""
    return F.struct(*_nulls_last(-up), tie)


def worst_key(up: Column, down: Column, tie: Column) -> Column:
    """Sorts by net votes, then up votes, both ascending with nulls last, then `tie`."""
    return F.struct(*_nulls_last(net_votes(up, down), up), tie)


def _pick(df: DataFrame, key: str, picks: dict[str, tuple[Sequence[str], Column]]) -> DataFrame:
    """One row per non-null `key` with a struct of columns for each pick."""
    least = {
        name: F.min(F.struct(order.alias("order"), F.struct(*columns).alias("row"))).getField("row")
        for name, (columns, order) in picks.items()
    }
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*[row.alias(name) for name, row in least.items()])


def top_comment(comments: DataFrame) -> DataFrame:
    """Whole row of the most upvoted comment per url."""
    rest = [c for c in comments.columns if c != "url"]
    order = most_upvoted_key(F.col("pcu_value"), F.col("comment_id"))
    return _pick(comments, "url", {"top": (rest, order)}).select("url", "top.*")


def worst_comment(comments: DataFrame) -> DataFrame:
    """Whole row of the comment with the lowest net votes per url, with its `delta`."""
    rest = [c for c in comments.columns if c != "url"]
    order = worst_key(F.col("pcu_value"), F.col("pcd_value"), F.col("comment_id"))
    return _pick(comments, "url", {"worst": (rest, order)}).select(
        "url", "worst.*", net_votes(F.col("worst.pcu_value"), F.col("worst.pcd_value")).alias("delta")
    )


def top_worst_pairs(
    comments: DataFrame,
    columns: Sequence[str] = ("comment_id", "comment_text", "pcu_value", "pcd_value"),
    key: str = "url",
    tie: str = "comment_id",
) -> DataFrame:
    """Top and worst comment per article side by side: columns end in `_top` / `_worst`."""
    up, down, last = F.col("pcu_value"), F.col("pcd_value"), F.col(tie)
    pairs = _pick(
        comments,
        key,
        {"top": (columns, most_upvoted_key(up, last)), "worst": (columns, worst_key(up, down, last))},
    )
    return pairs.select(key, *[F.col(f"{side}.{c}").alias(f"{c}_{side}") for c in columns for side in ("top", "worst")])


def top_worst_pairs_by_window(
    comments: DataFrame,
    columns: Sequence[str] = ("comment_id", "comment_text", "pcu_value", "pcd_value"),
) -> DataFrame:
    """The same result from two ranked windows and a join; kept to check the above."""
    delta = net_votes(F.col("pcu_value"), F.col("pcd_value"))
    tie = F.col("comment_id").asc_nulls_first()
    orders = {
        "top": [F.col("pcu_value").desc_nulls_last(), tie],
        "worst": [delta.asc_nulls_last(), F.col("pcu_value").asc_nulls_last(), tie],
    }
    sides = {
        side: comments.where("url IS NOT NULL")
        .withColumn("_rank", F.row_number().over(W.partitionBy("url").orderBy(*order)))
        .where("_rank = 1")
        .select("url", *[F.col(c).alias(f"{c}_{side}") for c in columns])
        for side, order in orders.items()
    }
    return sides["top"].join(sides["worst"], "url").select(
        "url", *[f"{c}_{side}" for c in columns for side in ("top", "worst")]
    )


def first_user_comment(comments: DataFrame, username: str, position: str = "position") -> DataFrame:
    """First comment of a user on each page, in page order."""
    rest = [c for c in comments.columns if c != "url"]
    mine = comments.where(F.col("username") == username)
    return _pick(mine, "url", {"first": (rest, F.col(position))}).select("url", "first.*")
