"""Every row beside its successor in the order of an id, with one shuffle of the rows.

Ids are cut into ranges of about equal bytes by a quantile sketch over a narrow, stored column. A row goes
to its range, and the first row of a range goes to the range before as well, as a guest behind that range's
own rows; the very first row is the guest of the last range. A window inside each range does the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quipyard.operators.ranks import places_below
from quipyard.session import store

#: Bytes of text in a range, about, and most ranges: the cut points go to every task.
RANGE_BYTES = 2 << 20
MOST_RANGES = 1 << 16


def _starts(ids: DataFrame, range_bytes: int) -> list[int]:
    """First ids of all ranges but the first, in order; `ids` has id and bytes."""
    rows, size = ids.filter("id IS NOT NULL").agg(F.count("*"), F.sum("bytes")).first()
    ranges = min(MOST_RANGES, -(-(size or 0) // range_bytes), rows)
    if ranges < 2:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    guess = sorted(set(ids.agg(F.percentile_approx("id", shares, max(10_000, 10 * ranges))).first()[0]))
    # the guesses are rounded; what counts is the least id of each range
    first = ids.filter("id IS NOT NULL").groupBy(_range(F.col("id"), guess)).agg(F.min("id").alias("id"))
    return sorted(r.id for r in first.collect())[1:]


def _range(value: Column, starts: list[int]) -> Column:
    return F.coalesce(places_below(value, [s - 1 for s in starts]), F.lit(0))


def with_next(
    rows: DataFrame, order: str, text: str, added: dict[str, Column], following: list[str], range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """`rows` with the columns `added`, and of the next row the columns `following` as `next_...`.

    `order` is a whole-number column, null first; equal ids go by a hash of the text. The last row
    is followed by the first. Columns are added after the shuffle, once per row. Ids are taken to be
    nearly unique: rows with the same id are in one range. The names `range`, `guest` and `place` are taken.
    """
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
    ids = store(rows.select(F.col(order).cast("bigint").alias("id"), size.alias("bytes")), "ids")
    starts = _starts(ids, range_bytes)
    low, nulls = ids.agg(F.min("id"), F.count_if(F.col("id").isNull())).first()
    last = len(starts)
    at, own = F.col(order).cast("bigint"), _range(F.col(order).cast("bigint"), starts)
    is_first = at.isNull() if nulls else at.eqNullSafe(F.lit(low))
    starts_range = own > F.coalesce(places_below(at, starts), F.lit(0))
    guest = F.when(is_first, F.lit(last)).when(starts_range, own - 1)
    places = F.array_compact(
        F.array(
            F.struct(own.alias("range"), F.lit(0).alias("guest")),
            F.when(guest.isNotNull(), F.struct(guest.alias("range"), F.lit(1).alias("guest"))),
        )
    )
    dealt = rows.select("*", F.explode(places).alias("place")).select(*rows.columns, "place.range", "place.guest")
    near = dealt.repartition("range").withColumns(added)
    order_in = Window.partitionBy("range").orderBy("guest", F.col(order).asc_nulls_first(), F.xxhash64(text))
    return (
        near.withColumns({f"next_{c}": F.lead(c).over(order_in) for c in following})
        .filter("guest = 0")
        .drop("range", "guest")
    )
