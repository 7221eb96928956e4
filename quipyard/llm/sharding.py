"""Reproducible shuffle into shards: a Feistel permutation of the global row numbers.

Rows are numbered from 0 in the order of `doc_id` (null first), then of size, checksum and text
hash; rows that are equal in all of these are interchangeable. A keyed permutation of 0..n-1 sends
row r to p, and p to shard p mod shards, slot p div shards. So shard sizes differ by one at most,
slots have no gaps, and either direction is a formula: `place` and `row_number_at`.

The permutation is a generalised Feistel network on Z_a x Z_b with a * b >= n, walked along its
cycle until it is back below n. a * b - n is less than a, about the square root of n, and so is the
length of any walk.

A null text has no bytes. Repeated rows get numbers of their own. An empty table gives an empty
result.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quipyard.session import store

PRIME = 2_147_483_647
#: Fixed odd constants: a linear generator's factor and step make the keys of the rounds.
FACTOR, STEP = 48_271, 12_345
ROUNDS = 8
#: Bytes that a row counts besides its text.
ROW_BYTES = 16


@dataclass(frozen=True)
class Permutation:
    """Keyed permutation of 0..n-1 as column expressions."""

    n: int
    seed: int = 7

    @property
    def a(self) -> int:
        root = isqrt(max(self.n, 1))
        return root if root * root >= self.n else root + 1

    @property
    def b(self) -> int:
        return -(-max(self.n, 1) // self.a)

    def rounds(self) -> list[tuple[int, int, int]]:
        """Key, factor and modulus of each round."""
        found, state = [], self.seed % PRIME
        for i in range(ROUNDS):
            key = state = (state * FACTOR + STEP) % PRIME
            factor = state = (state * FACTOR + STEP) % PRIME
            found.append((key, factor | 1, self.b if i % 2 else self.a))
        return found

    def _consts(self, rounds) -> Column:
        return F.array(*[F.struct(*[F.lit(x).cast("long").alias(k) for k, x in zip("kfm", r)]) for r in rounds])

    @staticmethod
    def _mix(x: Column, r: Column) -> Column:
        shifted = (x + r["k"]) % PRIME
        return ((shifted * shifted) % PRIME * r["f"] + r["k"]) % PRIME

    def _once(self, x: Column) -> Column:
        """x div b and x mod b swap and mix in turn; after an even number of rounds they are in place.

        The division is exact up to 2**53 rows.
        """
        if self.n < 2:
            return x
        start = F.struct(F.floor((x - x % self.b) / self.b).alias("l"), (x % self.b).alias("r"))
        end = F.aggregate(
            self._consts(self.rounds()),
            start,
            lambda s, r: F.struct(s["r"].alias("l"), ((s["l"] + self._mix(s["r"], r)) % r["m"]).alias("r")),
        )
        return end["l"] * self.b + end["r"]

    def _once_back(self, x: Column) -> Column:
        if self.n < 2:
            return x
        start = F.struct(F.floor((x - x % self.b) / self.b).alias("l"), (x % self.b).alias("r"))
        end = F.aggregate(
            self._consts(self.rounds()[::-1]),
            start,
            lambda s, r: F.struct(
                F.pmod(s["r"] - self._mix(s["l"], r) % r["m"], r["m"]).alias("l"), s["l"].alias("r")
            ),
        )
        return end["l"] * self.b + end["r"]

    def _walk(self, first: Column, step) -> Column:
        outside = self.a * self.b - self.n
        if outside == 0:
            return first
        walked = F.aggregate(
            F.sequence(F.lit(1), F.lit(outside)), first, lambda x, _: F.when(x >= self.n, step(x)).otherwise(x)
        )
        return F.when(first >= self.n, walked).otherwise(first)

    def forward(self, x: Column) -> Column:
        return self._walk(self._once(x), self._once)

    def backward(self, x: Column) -> Column:
        return self._walk(self._once_back(x), self._once_back)


def place(row: Column, n: int, shards: int, seed: int = 7) -> tuple[Column, Column]:
    """Shard and slot of a row number."""
    at = Permutation(n, seed).forward(row)
    return (at % shards).cast("int"), F.floor((at - at % shards) / shards)


def row_number_at(shard: Column, slot: Column, n: int, shards: int, seed: int = 7) -> Column:
    """Number of the row in a slot of a shard."""
    return Permutation(n, seed).backward(slot * shards + shard)


def number_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and the global row number, stored.

    One range shuffle of a few numbers per row; texts stay where they are. The only table that is
    broadcast has a row for each partition of the shuffle.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    facts = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(content) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        F.xxhash64(content).alias("hash"),
    )
    order = ["doc_id", "size", "text_crc32", "hash"]
    ordered = store(
        facts.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            *order[:3],
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("index"),
        ),
        "ordered",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ordered.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    return ordered.join(F.broadcast(starts), "part").select(
        *order[:3], (F.col("start") + F.col("index")).alias("row")
    )


def shuffle_into_shards(
    docs: DataFrame, shards: int = 40, seed: int = 7, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, row, shard, slot."""
    numbered = number_rows(docs, doc_id, text)
    n = numbered.count()
    at = numbered.withColumn("_at", Permutation(n, seed).forward(F.col("row")))
    return at.select(
        "doc_id",
        "size",
        "text_crc32",
        "row",
        (F.col("_at") % shards).cast("int").alias("shard"),
        F.floor((F.col("_at") - F.col("_at") % shards) / shards).alias("slot"),
    )
