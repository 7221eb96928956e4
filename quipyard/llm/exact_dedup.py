"""Exact duplicates: frequent digests leave on the map side, the others meet in one shuffle.

Two texts are equal when they are identical after every ASCII whitespace character is deleted. Of
equal texts the row with the most code points stays, then the smallest `doc_id` (null last), then
the first row of the stored digests. A null text counts as empty. Repeated rows are rows of their
own: one of them stays. An empty table gives an empty result; other columns are never looked at.

A Misra-Gries summary finds every digest that holds more than a small share of the rows. Their
exact winners, HOT_DIGESTS rows at most whatever the input, are broadcast, so that rows of a hot
digest are settled where they are read. The remaining digests are small groups and are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quipyard.llm.rows import keep_once, row_key, wrapped
from quipyard.session import store

WHITESPACE = " \t\n\v\f\r"
#: Counters of the summary; a digest with more than about 1 / TRACKED of all rows is always found.
TRACKED = 4096
#: Most digests that are settled on the map side; bounds what is broadcast.
HOT_DIGESTS = 4096


def without_whitespace(text: Column) -> Column:
    """Text without ASCII whitespace, null as empty."""
    kept = F.coalesce(text, F.lit(""))
    for character in WHITESPACE:
        kept = F.replace(kept, F.lit(character), F.lit(""))
    return kept


def text_digest(text: Column) -> Column:
    """SHA-256 of the text without whitespace, lowercase hex."""
    return F.sha2(without_whitespace(text), 256)


def _length(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit("")))


def _rank(length: Column, doc_id: Column) -> list[Column]:
    return [(-length).alias("shorter"), doc_id.isNull().alias("unnamed"), doc_id.alias("doc_id")]


def hot_digests(digests: DataFrame, tracked: int = TRACKED, most: int = HOT_DIGESTS) -> DataFrame:
    """Digest, best row and group size of frequent digests: at most `most` rows.

    `digests` has text_sha256, length, doc_id, row. The summary only proposes; sizes and winners
    are counted exactly.
    """
    summary = digests.agg(F.expr(f"approx_top_k(text_sha256, {most}, {tracked})").alias("top"))
    proposed = summary.select(F.explode("top.item").alias("text_sha256"))
    best = F.min(F.struct(*_rank(F.col("length"), F.col("doc_id")), "row")).alias("best")
    return (
        digests.join(F.broadcast(proposed), "text_sha256")
        .groupBy("text_sha256")
        .agg(best, F.count("*").alias("group_size"))
        .filter("group_size > 1")
    )


def mark_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, length.

    Only digests are stored and moved, never texts.
    """
    digests = store(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            text_digest(F.col(text)).alias("text_sha256"),
            _length(F.col(text)).alias("length"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    hot = store(hot_digests(digests), "hot_digests")
    settled = digests.join(F.broadcast(hot), "text_sha256")
    same = Window.partitionBy("text_sha256")
    best = F.min(F.struct(*_rank(F.col("length"), F.col("doc_id")), "row")).over(same)
    others = (
        digests.join(F.broadcast(hot.select("text_sha256")), "text_sha256", "left_anti")
        .withColumn("best", best)
        .withColumn("group_size", F.count("*").over(same))
    )
    return settled.unionByName(others).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
        "length",
    )


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` without its duplicates; all columns as they were.

    Texts of hot digests are dropped where they are read; the others are shuffled once, by the
    digest, length and id of the row that stays.
    """
    marks = store(mark_duplicates(docs, doc_id, text), "marks")
    key = _key(F.col("text_sha256"), F.col("length"), F.col("doc_id"))
    winners = marks.filter("kept").select("text_sha256", "group_size", key.alias("key"))
    # fewer than TRACKED digests can hold more than 1 / TRACKED of the rows each
    crowd = max(1, marks.count() // TRACKED)
    hot = winners.filter(F.col("group_size") > crowd).select(F.col("text_sha256").alias("hot"), F.col("key").alias("best"))
    digest = text_digest(F.col(text))
    rows = wrapped(docs, digest=digest, key=_key(digest, _length(F.col(text)), F.col(doc_id)))
    left = rows.join(F.broadcast(hot), F.col("digest") == F.col("hot"), "left").filter("hot IS NULL OR best = key")
    return keep_once(left.select("row", "key"), winners)


def _key(digest: Column, length: Column, doc_id: Column) -> Column:
    return row_key(doc_id, digest, length)
