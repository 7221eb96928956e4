"""Pack texts into token blocks of one fixed length.

All texts form one stream, ordered by a hash of their key, each followed by a
separator token; the stream is cut every `length` tokens and the short rest at
the end is dropped. Tokens are words between whitespace.

The hash range is divided into buckets. A first reading of the texts sums up tokens and
bytes in CELLS equal parts of the range, from which follow the number of buckets and
their totals. The totals give each bucket its place in the stream, a window
inside the bucket gives each text its place, and the text is sliced once per block
it touches. Order and cuts do not depend on the number of buckets.

The one shuffle of texts is the one into buckets: blocks are built there, once, and
stored. Only those that reach over a bucket's edge, at most two per bucket, move
again to be joined. Buckets grow in number with the texts, not in size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quipyard.functions.hashing import hash32
from quipyard.functions.text import words
from quipyard.session import store

#: Buckets up to which their table is broadcast.
BROADCAST_BUCKETS = 100_000
#: Bytes of text in a bucket, about.
BUCKET_BYTES = 32 << 20
#: Parts of the hash range that are summed up before the number of buckets is known.
CELLS = 1 << 20


def pack_sequences(
    df: DataFrame,
    key: str,
    text: str,
    length: int = 4096,
    separator: str = "</s>",
    buckets: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """Rows (block_id, tokens) with exactly `length` tokens each; keys are unique.

    Texts without a key are placed by a hash of the text. Without `buckets` their number, a
    power of two, follows from the bytes of all texts.
    """
    texts = df.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    place = F.coalesce(hash32(F.col("key"), seed), hash32(F.col("text"), seed))
    tokens = F.array_append(words(F.col("text")), F.lit(separator))
    placed = texts.select(place.alias("place"), "key", "text", F.size(tokens).cast("bigint").alias("n"))
    if buckets is None:
        seen = Observation()
        cells = store(_totals(placed, CELLS).observe(seen, F.sum("bytes").alias("bytes")), "cells")
        size = seen.get["bytes"] or 0
        wanted = max(-(-size // BUCKET_BYTES), df.sparkSession.sparkContext.defaultParallelism)
        buckets = min(CELLS, 1 << (wanted - 1).bit_length())
        per_bucket = F.floor(F.col("bucket") / (CELLS // buckets)).cast("int")
        totals = cells.groupBy(per_bucket.alias("bucket")).agg(F.sum("total").alias("total"))
    else:
        totals = _totals(placed, buckets)
    rows = placed.withColumn("bucket", _part(F.col("place"), buckets))

    starts = _bucket_starts(totals)
    # Equal keys should not occur; the text keeps their order the same in every run.
    in_bucket = W.partitionBy("bucket").orderBy("place", "key", "text")
    before = F.sum("n").over(in_bucket.rowsBetween(W.unboundedPreceding, -1))
    placed = (
        # Texts travel as they are: arrays of words take several times the space.
        rows.withColumn("before", F.coalesce(before, F.lit(0)))
        # One row per bucket, with `buckets` fixed above.
        .join(F.broadcast(starts) if buckets <= BROADCAST_BUCKETS else starts, "bucket")
        .withColumn("start", F.col("first") + F.col("before"))
        .withColumn("tokens", tokens)
    )
    whole = F.col("block_id") * length >= F.col("first")
    whole &= (F.col("block_id") + 1) * length <= F.col("last")
    blocks = store(_join_pieces(_cut(placed, length), ["bucket", "block_id"], whole), "blocks")
    inner = blocks.where("whole").select("block_id", "tokens")
    parts = blocks.where("NOT whole").select("block_id", "start", F.col("tokens").alias("piece"))
    edge = _join_pieces(parts, ["block_id"], F.lit(False)).select("block_id", "tokens")
    return inner.union(edge.where(F.size("tokens") == length))


def _part(place: Column, parts: int) -> Column:
    """Number of the equal part of the hash range that holds a place."""
    return F.floor(place * F.lit(parts) / F.lit(float(1 << 32))).cast("int")


def _totals(placed: DataFrame, parts: int) -> DataFrame:
    """(bucket, total, bytes) of every part of the hash range that holds a text."""
    size = F.sum(F.octet_length("text")).alias("bytes")
    return placed.groupBy(_part(F.col("place"), parts).alias("bucket")).agg(F.sum("n").alias("total"), size)


def _bucket_starts(totals: DataFrame) -> DataFrame:
    """(bucket, first, last): the half-open range of stream positions of each bucket."""
    upto = F.sum("total").over(W.orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow))
    return totals.select("bucket", (upto - F.col("total")).alias("first"), upto.alias("last"))


def _cut(placed: DataFrame, length: int) -> DataFrame:
    """One row per text and block it touches, with the tokens that fall into it."""
    end = F.col("start") + F.col("n")
    touched = F.sequence(
        F.floor(F.col("start") / length).cast("bigint"), F.floor((end - 1) / length).cast("bigint")
    )
    lower = F.greatest(F.col("start"), F.col("block_id") * length)
    upper = F.least(end, (F.col("block_id") + 1) * length)
    piece = F.slice("tokens", (lower - F.col("start") + 1).cast("int"), (upper - lower).cast("int"))
    return (
        placed.select("*", F.explode(touched).alias("block_id"))
        .select("bucket", "block_id", "first", "last", "start", piece.alias("piece"))
    )


def _join_pieces(pieces: DataFrame, by: list[str], whole: Column) -> DataFrame:
    """Tokens of each block in stream order, from where they start; bounded by a block's length."""
    ordered = F.sort_array(F.collect_list(F.struct("start", "piece")))
    return (
        pieces.withColumn("whole", whole)
        .groupBy(*by)
        .agg(ordered.alias("parts"), F.min("start").alias("start"), F.first("whole").alias("whole"))
        .select("block_id", "start", "whole", F.flatten(F.col("parts.piece")).alias("tokens"))
    )
