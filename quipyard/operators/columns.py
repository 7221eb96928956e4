"""Column-level operators: names, sentinels, missing values, arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipyard.schemas import MISSING, NA_TOKENS


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case column names, blanks as underscores."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def _map_strings(df: DataFrame, change) -> DataFrame:
    return df.select(
        *[
            change(F.col(f"`{field.name}`")).alias(field.name)
            if isinstance(field.dataType, T.StringType)
            else F.col(f"`{field.name}`")
            for field in df.schema.fields
        ]
    )


def sentinel_to_null(df: DataFrame, sentinel: str = MISSING) -> DataFrame:
    """Null every text cell that is exactly the sentinel."""
    return _map_strings(df, lambda c: F.nullif(c, F.lit(sentinel)))


def na_tokens_to_null(df: DataFrame, na_tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Null every text cell that is one of the null tokens; an empty list keeps all."""
    if not na_tokens:
        return df
    return _map_strings(df, lambda c: F.when(~c.isin(*na_tokens), c))


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def drop_null_in(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop("any", subset=list(columns))


def flatten_results(df: DataFrame, column: str, position: str | None = None) -> DataFrame:
    """One row per element of an array column; rows with a null or empty array vanish."""
    rest = [c for c in df.columns if c != column]
    if position is None:
        return df.select(*rest, F.explode(column).alias(column))
    return df.select(*rest, F.posexplode(column).alias(position, column))


def zip_results(df: DataFrame, left: str, right: str) -> DataFrame:
    """Pair two array columns by position; arrays of unequal length are an error."""
    rest = [c for c in df.columns if c not in (left, right)]
    unequal = F.raise_error(F.lit("arrays of unequal length"))
    same = F.size(left) == F.size(right)
    pairs = F.arrays_zip(F.when(~same, unequal).otherwise(F.col(left)), F.col(right))
    return df.select(*rest, F.inline(pairs).alias(left, right))


def select_renamed(df: DataFrame, names: dict[str, str | Column]) -> DataFrame:
    """Output columns in order, each from an input column or an expression."""
    return df.select(*[(F.col(src) if isinstance(src, str) else src).alias(dst) for dst, src in names.items()])
