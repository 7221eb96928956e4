"""Row hashes from md5, the same in every engine and under any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60


def _hex_prefix(key: Column, seed: int | str, digits: int) -> Column:
    text = F.concat(F.lit(f"{seed}:"), key.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("bigint")


def hash32(key: Column, seed: int | str = 0) -> Column:
    return _hex_prefix(key, seed, 8)


def hash60(key: Column, seed: int | str = 0) -> Column:
    return _hex_prefix(key, seed, HASH_BITS // 4)
