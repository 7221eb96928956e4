"""Limits, samples and splits; all repeatable, decided by row keys and a seed."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipyard.functions.hashing import hash32, hash60
from quipyard.operators.ranks import StoredKeys

# Share and seed of the held-out part.
TEST_SHARE = 0.1
SEED = 42


def first_n(df: DataFrame, position: str, n: int = 3, *ties: str) -> DataFrame:
    """First rows in page order, equal positions by the columns `ties`."""
    return df.orderBy(F.col(position).asc_nulls_last(), *ties).limit(n)


def sample_one(df: DataFrame, key: Column, seed: int = SEED) -> DataFrame:
    """One row at random: the one with the lowest seeded hash, equal hashes by key."""
    return df.orderBy(hash60(key, seed), key).limit(1)


def in_test_bucket(key: Column, share: float = TEST_SHARE, seed: int = SEED) -> Column:
    """True for about `share` of the keys."""
    return F.pmod(hash32(key, seed), F.lit(1000)) < round(share * 1000)


def with_split(
    df: DataFrame, key: str = "url", share: float = TEST_SHARE, seed: int = SEED, exact: bool = False
) -> DataFrame:
    """Add `split` = `train` or `test`.

    By default the hash bucket of the key decides, row by row. With `exact`, the
    test part has ceil(share * rows) rows: those with the lowest hashes. This
    needs unique non-null keys, which are stored and ranked first.
    """
    column = F.col(key)
    if not exact:
        in_test = in_test_bucket(column, share, seed)
    else:
        hashed = hash60(column, seed)
        keys = StoredKeys.of(df, hashed)
        size = math.ceil(share * keys.rows)
        in_test = hashed <= keys.at([size])[0] if size else F.lit(False)
        keys.discard()
    return df.withColumn("split", F.when(in_test, F.lit("test")).otherwise(F.lit("train")))


def train_test_split(
    df: DataFrame, key: str = "url", share: float = TEST_SHARE, seed: int = SEED, exact: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Train and test tables: disjoint, together the whole input."""
    marked = with_split(df, key, share, seed, exact)
    return tuple(marked.where(F.col("split") == part).drop("split") for part in ("train", "test"))
