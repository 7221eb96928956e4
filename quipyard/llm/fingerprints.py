"""Bottom-k fingerprints of texts, in Spark SQL alone.

A fingerprint holds the k smallest distinct hashes of a text's shingles of five words (fewer words:
the whole sequence is the one shingle; none: the fingerprint is empty). Words are what stands between
ASCII whitespace. The hash of a shingle is the XXH64 of its words' XXH64 values, so a text's words
are hashed once each. Hashes are ordered as signed numbers.

Fingerprints of parts merge into the one of the whole: `merged` for two columns, `merge_parts` for any
number of rows. From two fingerprints follow the resemblance of the shingle sets (shared ones among all)
and the containment of one in the other, from each the number of distinct shingles; all three are exact
while no more than k shingles are there, and have a standard error of about 1 / sqrt(k) otherwise.

A null text counts as empty. Two empty fingerprints resemble each other fully, an empty one and another
not at all. Equal texts, and so repeated rows, have equal fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hashes in a fingerprint, and words in a shingle.
SIZE = 128
SHINGLE = 5

WHITESPACE = r"[\x20\x09-\x0D]+"


def _bound(value: Column, use) -> Column:
    """`use(value)` with the value worked out once, also where `use` reads it for every element."""
    return F.transform(F.array(value), use)[0]


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """Hash of every shingle in text order, repeats included."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITESPACE), "")

    def of(h: Column) -> Column:
        whole = F.array(F.aggregate(h, F.lit(0).cast("bigint"), lambda before, x: F.xxhash64(before, x)))
        starts = F.slice(h, F.lit(1), F.greatest(F.size(h) - (shingle - 1), F.lit(0)))
        each = F.transform(starts, lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, shingle)]))
        return F.when(F.size(h) >= shingle, each).when(F.size(h) > 0, whole).otherwise(each)

    return _bound(F.transform(words, lambda w: F.xxhash64(w)), of)


def bottom(hashes: Column, k: int = SIZE) -> Column:
    """The k smallest distinct hashes in order."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def fingerprint(text: Column, k: int = SIZE, shingle: int = SHINGLE) -> Column:
    """Fingerprint of a text, an array of whole numbers."""
    return bottom(shingle_hashes(text, shingle), k)


def merged(a: Column, b: Column, k: int = SIZE) -> Column:
    """Fingerprint of two parts together; shingles across the seam belong to neither part."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_parts(parts: DataFrame, by: str, sketch: str = "sketch", k: int = SIZE) -> DataFrame:
    """(by, sketch): one fingerprint for all rows with the same value, null one of them.

    Equal hashes of a group become one before any shuffle, and each task hands on k hashes of a group
    at most, so a group that holds a third of all rows is spread like any other. A group whose rows have
    empty fingerprints only has an empty one.
    """
    hashes = parts.select(F.col(by).alias("by"), F.explode_outer(sketch).alias("hash")).distinct()
    # a null hash stands for an empty fingerprint and comes first
    place = F.row_number().over(Window.partitionBy("by").orderBy(F.col("hash").asc_nulls_first()))
    least = hashes.withColumn("place", place).filter(F.col("place") <= k + 1).groupBy("by")
    return least.agg(F.slice(F.sort_array(F.collect_list("hash")), 1, k).alias("sketch")).select(F.col("by").alias(by), "sketch")


def resemblance(a: Column, b: Column, k: int = SIZE) -> Column:
    """Estimated share of the shingles of either text that both have."""
    least = merged(a, b, k)
    shared = F.size(F.array_intersect(least, F.array_intersect(a, b)))
    return F.when(F.size(least) == 0, F.lit(1.0)).otherwise(shared / F.size(least))


def distinct_shingles(sketch: Column, k: int = SIZE) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    size = F.size(sketch)
    # place of the largest hash in the range of all hashes
    share = (F.element_at(sketch, -1) / F.lit(2.0**64)) + 0.5
    return F.when(size < k, size.cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = SIZE) -> Column:
    """Estimated share of the shingles of `a` that are in `b` too; 1 for an empty `a`."""
    both = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def to_text(sketch: Column) -> Column:
    """16 lowercase hex digits for each hash, without a separator."""
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def from_text(text: Column) -> Column:
    """The fingerprint written by `to_text`."""
    high = lambda i: F.conv(F.substr(text, i * 16 + 1, F.lit(8)), 16, 10).cast("bigint")
    low = lambda i: F.conv(F.substr(text, i * 16 + 9, F.lit(8)), 16, 10).cast("bigint")
    places = F.sequence(F.lit(0), F.greatest(F.floor(F.length(text) / 16).cast("int") - 1, F.lit(0)))
    found = F.transform(places, lambda i: F.shiftleft(high(i), 32).bitwiseOR(low(i)))
    return F.when(F.length(text) >= 16, found).otherwise(F.array().cast("array<bigint>"))
