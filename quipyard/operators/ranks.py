"""Exact positions in a global order without a global sort.

A rank limit becomes a key limit. The keys are stored once, and while they are written a mergeable
quantile sketch is made, which bounds each wanted key from both sides. A first reading counts exactly
what lies below those bounds and in FANOUT buckets between them; a second fetches the keys of the buckets
that hold the wanted ranks. A bucket that still holds too many keys is counted in finer ones first, and a bound that proves
wrong gives way to the whole range, so the sketch decides about speed only. Every reading aggregates
before the shuffle, and MOST_COUNTS bounds what comes to the driver. The result is then a comparison
or a search per row: no shuffle, no single-task window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quipyard.session import discard, store

FANOUT = 1 << 16
#: Counts or keys that one pass brings to the driver, for all ranks together.
MOST_COUNTS = 1 << 20
#: Size of the sketch, the quantiles read off it, and the error in rank allowed for: 0.2 % is to be expected.
SKETCH = 4096
QUANTILES = 1024
ERROR = 0.004


@dataclass(frozen=True)
class _Span:
    """Keys from low to high, `rows` of them, all wanted keys among them."""

    low: int
    high: int
    rows: int
    fan: int

    @property
    def width(self) -> int:
        """Keys per bucket."""
        return -(-(self.high - self.low + 1) // self.fan)

    @property
    def is_open(self) -> bool:
        return self.low < self.high and self.rows > self.fan


@dataclass(frozen=True)
class StoredKeys:
    """Whole-number keys of a table, stored, with their number and quantiles; null keys are left out."""

    table: DataFrame
    low: int | None
    high: int | None
    rows: int
    quantiles: list[int]

    @staticmethod
    def of(df: DataFrame, key: Column) -> StoredKeys:
        keys = df.select(key.cast("bigint").alias("k")).where("k IS NOT NULL")
        sketch = F.kll_sketch_agg_bigint("k", F.lit(SKETCH))
        shares = F.expr("array(" + ",".join(f"{i / QUANTILES}D" for i in range(QUANTILES + 1)) + ")")
        quantiles = F.when(F.count("k") > 0, F.kll_sketch_get_quantile_bigint(sketch, shares))
        facts = {"low": F.min("k"), "high": F.max("k"), "rows": F.count("k"), "quantiles": quantiles}
        seen = Observation()
        # in the tasks that write, each of which counts once
        table = store(keys.observe(seen, *[fact.alias(name) for name, fact in facts.items()]), "keys")
        return StoredKeys(table, **{name: seen.get[name] for name in facts})

    def at(self, ranks: Sequence[int]) -> list[int]:
        """The r-th smallest key for each 1-based rank r."""
        if not self.rows:
            raise ValueError("no rows to rank")
        fan = max(2, min(FANOUT, MOST_COUNTS // max(1, len(ranks))))
        whole = _Span(self.low, self.high, self.rows, fan)
        return _find(self.table, whole, ranks, self._bounds(whole, ranks) if whole.is_open else [])

    def _bounds(self, whole: _Span, ranks: Sequence[int]) -> list[_Span]:
        """Spans that hold the wanted keys unless the sketch is worse than expected; sorted, apart."""
        spans: list[_Span] = []
        for rank in sorted(ranks):
            share = rank / self.rows
            first, last = math.floor((share - ERROR) * QUANTILES), math.ceil((share + ERROR) * QUANTILES)
            low = self.quantiles[first] if first > 0 else self.low
            high = self.quantiles[last] if last < QUANTILES else self.high
            if spans and low <= spans[-1].high:
                low, high = spans[-1].low, max(high, spans.pop().high)
            spans.append(_Span(low, high, 0, whole.fan))
        return spans

    def discard(self) -> None:
        """Remove the stored keys."""
        discard(self.table)


def keys_at_ranks(df: DataFrame, key: Column, ranks: Sequence[int]) -> list[int]:
    """The r-th smallest whole-number key for each 1-based rank r."""
    keys = StoredKeys.of(df, key)
    found = keys.at(ranks)
    keys.discard()
    return found


def _find(keys: DataFrame, whole: _Span, ranks: Sequence[int], bounds: Sequence[_Span]) -> list[int]:
    # Per wanted rank: the span that holds it, and its rank within the span.
    at = _start(keys, whole, ranks, bounds) if bounds else [(whole, r) for r in ranks]
    while any(span.is_open for span, _ in at):
        counts = _bucket_counts(keys, {span for span, _ in at if span.is_open})
        at = [_narrow(span, left, counts[span]) if span.is_open else (span, left) for span, left in at]
    few = _fetch(keys, {span for span, _ in at if span.low < span.high})
    return [span.low if span.low == span.high else few[span][left - 1] for span, left in at]


def _start(keys: DataFrame, whole: _Span, ranks: Sequence[int], bounds: Sequence[_Span]) -> list[tuple[_Span, int]]:
    """The bucket of each rank inside the bounds, or the whole range where it lies outside."""
    counts, below = _counts_with_gaps(keys, bounds)
    at = []
    for rank in ranks:
        i = max((i for i, b in enumerate(below) if b < rank), default=0)
        left = rank - below[i]
        inside = 1 <= left <= sum(counts[i].values())
        at.append(_narrow(bounds[i], left, counts[i]) if inside else (whole, rank))
    return at


def _counts_with_gaps(keys: DataFrame, spans: Sequence[_Span]) -> tuple[list[dict[int, int]], list[int]]:
    """Keys per bucket of each span, and how many keys are below each span."""
    spans = list(spans)
    found = _in_spans(keys, spans, True, gaps=True).groupBy("s", "v").count().collect()
    counts: list[dict[int, int]] = [{} for _ in spans]
    gaps = [0] * (len(spans) + 1)
    for i, bucket, n in found:
        if bucket < 0:
            gaps[i + 1] += n
        else:
            counts[i][bucket] = n
    below, before = [], 0
    for i, inside in enumerate(counts):
        before += gaps[i]
        below.append(before)
        before += sum(inside.values())
    return counts, below


def _in_spans(keys: DataFrame, spans: Sequence[_Span], buckets: bool, gaps: bool = False) -> DataFrame:
    """(s, v) for keys in span number s, v the bucket or the key; sorted spans that do not overlap.

    With `gaps` also the other keys, v = -1 and s the span before them or -1.
    """
    lows, highs, widths = (_longs([getattr(s, name) for s in spans]) for name in ("low", "high", "width"))
    at = (places_below(F.col("k") + 1, [s.low for s in spans]) - 1).alias("s")
    is_in = (F.col("s") >= 0) & (F.col("k") <= F.get(highs, F.col("s")))
    found = keys.select("k", at) if gaps else keys.select("k", at).where(is_in)
    inside = (F.col("k") - F.get(lows, F.col("s")), F.get(widths, F.col("s")))
    value = F.floor((inside[0] - inside[0] % inside[1]) / inside[1]) if buckets else F.col("k")
    return found.select("s", (F.when(is_in, value).otherwise(F.lit(-1)) if gaps else value).alias("v"))


def _longs(values: Sequence[int]) -> Column:
    """Array literal, folded once."""
    return F.expr("array(" + ",".join(f"{v}L" for v in values) + ")")


def _bucket_counts(keys: DataFrame, wanted: set[_Span]) -> dict[_Span, dict[int, int]]:
    spans = sorted(wanted, key=lambda s: s.low)
    counts: dict[_Span, dict[int, int]] = {s: {} for s in spans}
    for i, bucket, n in _in_spans(keys, spans, True).groupBy("s", "v").count().collect():
        counts[spans[i]][bucket] = n
    return counts


def _narrow(span: _Span, left: int, counts: dict[int, int]) -> tuple[_Span, int]:
    for bucket in sorted(counts):
        rows = counts[bucket]
        if left <= rows:
            low = span.low + bucket * span.width
            return _Span(low, min(low + span.width - 1, span.high), rows, span.fan), left
        left -= rows
    raise ValueError("rank beyond the number of rows")


def _fetch(keys: DataFrame, wanted: set[_Span]) -> dict[_Span, list[int]]:
    """All keys of spans that hold FANOUT rows at most, in order."""
    if not wanted:
        return {}
    spans = sorted(wanted, key=lambda s: s.low)
    found: dict[_Span, list[int]] = {s: [] for s in spans}
    for i, k in _in_spans(keys, spans, False).collect():
        found[spans[i]].append(k)
    return {s: sorted(ks) for s, ks in found.items()}


def chunk_sizes(rows: int, chunks: int) -> list[int]:
    """Near-equal sizes, the first ones get the remainder."""
    return [rows // chunks + (i < rows % chunks) for i in range(chunks)]


def assign_chunks(df: DataFrame, position: str, chunks: int = 8) -> DataFrame:
    """Contiguous near-equal chunks by a unique whole-number position, numbered from 1."""
    keys = StoredKeys.of(df, F.col(position))
    if not keys.rows:
        return df.withColumn("chunk", F.lit(None).cast("int"))
    sizes = [n for n in chunk_sizes(keys.rows, chunks) if n]
    cuts = keys.at(list(accumulate(sizes[:-1])))
    keys.discard()
    # chunks in front of the position's own, by binary search in the sorted cut points
    before = places_below(F.col(position).cast("bigint"), cuts)
    return df.withColumn("chunk", F.when(F.col(position).isNotNull(), before + 1).cast("int"))


def places_below(value: Column, cuts: Sequence[int]) -> Column:
    """How many of the sorted cut points are less than the value."""
    if not cuts:
        return F.lit(0)
    array = _longs(cuts)
    middle = lambda s: F.floor((s["lo"] + s["hi"]) / 2).cast("int")

    def halve(s: Column, _: Column) -> Column:
        below = F.get(array, middle(s)) < value
        return F.struct(
            F.when((s["lo"] < s["hi"]) & below, middle(s) + 1).otherwise(s["lo"]).alias("lo"),
            F.when((s["lo"] < s["hi"]) & ~below, middle(s)).otherwise(s["hi"]).alias("hi"),
        )

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi"))
    steps = F.sequence(F.lit(1), F.lit(len(cuts).bit_length()))
    return F.aggregate(steps, start, halve)["lo"]


def spread(df: DataFrame, chunks: int | None = None) -> DataFrame:
    """At least so many even partitions, where order does not matter; by default one per core.

    Tables read from as many files are left as they are; nothing is run to find out.
    """
    chunks = chunks or df.sparkSession.sparkContext.defaultParallelism
    return df if len(df.inputFiles()) >= chunks else df.repartition(chunks)
