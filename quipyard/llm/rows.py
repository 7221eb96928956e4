"""Helpers for stages that keep some rows of a table and all of its columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_key(doc_id: Column, *more: Column) -> Column:
    """Text that names a row by its id and further values; null has a name of its own."""
    return F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("none")), *[x.cast("string") for x in more])


def wrapped(docs: DataFrame, **more: Column) -> DataFrame:
    """All columns as one, `row`, so that none clashes with the others."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in more.items()])


def keep_once(rows: DataFrame, staying: DataFrame) -> DataFrame:
    """Rows (row, key) whose key is among `staying`, unwrapped; of rows with the same key the first.

    One shuffle of the rows, by the key, which is nearly unique.
    """
    first = Window.partitionBy("key").orderBy("key")
    return (
        rows.join(staying.select("key"), "key", "left_semi")
        .withColumn("copy", F.row_number().over(first))
        .filter("copy = 1")
        .select("row.*")
    )
