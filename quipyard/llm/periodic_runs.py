"""Periodic runs of words, by Kruskal's rule on longest common prefixes.

Words are what stands between ASCII whitespace, numbered from 0 in each text. A run is a stretch of
consecutive words with smallest period q and at least max(`least`, 2 * q) words that no neighbouring
word extends keeping period q. Its `collapsed` text keeps, of every run, the first q words.

Suffixes of a text are sorted by prefix doubling, and neighbours in that order are united by decreasing
length of their common prefix. Every class of united suffixes is an ordered set of positions; the
smaller set moves into the larger one, and whenever two positions become neighbours in a set at a
distance d within the common prefix l, the words from the first on repeat with period d for d + l words.
The two first positions of a run are neighbours at the moment they meet, so no run is missed; a pair
whose distance is a multiple of the period covers the same stretch as the pair of the period itself,
so of equal stretches the least distance is right.

Two suffixes that seed a run share at least half of `least` words, so only positions whose first words
occur again in the same text are sorted, and the descent ends there. A text is worked on by one task,
in memory that grows with its length; nothing is shuffled.

A null or blank text has no words, no runs and an empty collapsed text. Equal rows have equal results.
An empty table gives an empty result; further columns are named by the caller and carried along, and
no column's name matters to the method.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipyard.llm.words import slices, split_words

#: Fewest words of a run.
LEAST = 12
#: Positions in a block of an ordered set.
BLOCK = 1024

RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])


class Positions:
    """Ordered set of whole numbers, in sorted blocks."""

    def __init__(self, first: int):
        self.blocks, self.tops, self.size = [[first]], [first], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def add(self, x: int) -> tuple[int | None, int | None]:
        """Put in a number that is not there yet; its neighbours."""
        b = bisect(self.tops, x) if len(self.blocks) > 1 else 0
        if b == len(self.blocks):
            b -= 1
        block = self.blocks[b]
        at = bisect(block, x)
        before = block[at - 1] if at else self.blocks[b - 1][-1] if b else None
        after = block[at] if at < len(block) else self.blocks[b + 1][0] if b + 1 < len(self.blocks) else None
        block.insert(at, x)
        self.size += 1
        self.tops[b] = block[-1]
        if len(block) > BLOCK:
            self.blocks[b : b + 1] = [block[: BLOCK // 2], block[BLOCK // 2 :]]
            self.tops[b : b + 1] = [block[BLOCK // 2 - 1], block[-1]]
        return before, after


def _recurring(codes: np.ndarray, text: np.ndarray, left: np.ndarray, gram: int) -> np.ndarray:
    """Positions whose next `gram` words probably occur again in the same text; none that do is left out."""
    at = np.flatnonzero(left >= gram)
    if len(at) < 2:
        return at[:0]
    factors = np.random.default_rng(gram).integers(1 << 40, 1 << 63, gram + 1, dtype=np.uint64) | np.uint64(1)
    hashed = text[at].astype(np.uint64) * factors[gram]
    for j in range(gram):
        hashed += codes[at + j].astype(np.uint64) * factors[j]
    ordered = np.sort(hashed)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return at[:0]
    place = np.minimum(np.searchsorted(twice, hashed), len(twice) - 1)
    return at[twice[place] == hashed]


class _Suffixes:
    """Suffixes of some texts, laid end to end, by prefix doubling from `gram` words on.

    `levels` has for each prefix length the rank of every position; equal ranks mean equal prefixes
    within one text.
    """

    def __init__(self, codes: np.ndarray, text: np.ndarray, left: np.ndarray, gram: int):
        self.codes, self.left, self.gram = codes, left, gram
        self.places = np.arange(len(codes))
        self.levels: list[tuple[int, np.ndarray]] = []
        self.pairs: list[tuple[np.ndarray, np.ndarray, int]] = []
        self._sort(text)

    def _shifted(self, values: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
        """Values `step` further on, 0 beyond the end of the text."""
        inside = self.left[at] > step
        return np.where(inside, values[np.where(inside, at + step, 0)], 0)

    def _first_ranks(self, text: np.ndarray) -> np.ndarray:
        rank, length = self.codes.astype(np.int64) + 1, 1
        while length < self.gram:
            step = min(length, self.gram - length)
            rank = _dense(rank, self._shifted(rank, self.places, step))
            length += step
        return _dense(text, rank)

    def _sort(self, text: np.ndarray) -> None:
        dense = self._first_ranks(text)
        sizes = np.bincount(dense)
        # the rank of a class is the place of its first member, counted from 1
        rank = (np.cumsum(sizes) - sizes)[dense] + 1
        active, k = np.flatnonzero(sizes[dense] > 1), self.gram
        while len(active):
            self.levels.append((k, rank.astype(np.int32 if len(rank) < 1 << 31 else np.int64)))
            after = self._shifted(rank, active, k)
            order = np.lexsort((after, rank[active]))
            at, head, after = active[order], rank[active][order], after[order]
            same = np.concatenate(([False], head[1:] == head[:-1]))
            parted = ~same | np.concatenate(([True], after[1:] != after[:-1]))
            cut = np.flatnonzero(parted & same)
            self.pairs.append((at[cut - 1], at[cut], len(self.levels) - 1))
            index = np.arange(len(at))
            group = np.maximum.accumulate(np.where(same, 0, index))
            part = np.maximum.accumulate(np.where(parted, index, 0))
            rank[at] = head + part - group
            alone = parted & np.concatenate((parted[1:], [True]))
            active, k = at[~alone], 2 * k

    def neighbours(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of neighbours in suffix order and the length of their common prefix, longest first.

        A pair stands for the classes of its two members, which have the same common prefix.
        """
        found = [(a, b, self._common(a, b, level)) for a, b, level in self.pairs]
        if not found:
            return (np.empty(0, np.int64),) * 3
        a, b, length = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(-length, kind="stable")
        return a[order], b[order], length[order]

    def _common(self, a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
        """Common prefix of pairs that agree at a level and not at the next."""
        length = np.full(len(a), self.levels[level][0])
        for k, rank in reversed(self.levels[:level]):
            length += k * self._equal(rank, a, b, length)
        open_ = np.ones(len(a), dtype=bool)
        for _ in range(self.gram):
            open_ &= self._equal(self.codes, a, b, length)
            length += open_
        return length

    def _equal(self, values: np.ndarray, a: np.ndarray, b: np.ndarray, step: np.ndarray) -> np.ndarray:
        inside = (self.left[a] > step) & (self.left[b] > step)
        return inside & (values[np.where(inside, a + step, 0)] == values[np.where(inside, b + step, 0)])


def _dense(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Ranks from 1 of pairs of whole numbers."""
    return np.unique(high.astype(np.int64) * (int(low.max()) + 1) + low, return_inverse=True)[1] + 1


def _seeds(a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """(first, second, common prefix) of positions that become neighbours within their common prefix."""
    found, sets, parent = [], {}, {}

    def root(x: int) -> int:
        while (up := parent[x]) != x:
            parent[x] = x = parent[up]
        return x

    for x, y, common in zip(a.tolist(), b.tolist(), length.tolist()):
        for new in (x, y):
            if new not in parent:
                parent[new], sets[new] = new, Positions(new)
        x, y = root(x), root(y)
        if sets[x].size < sets[y].size:
            x, y = y, x
        parent[y], large, last = x, sets[x], None
        for position in sets.pop(y):
            before, after = large.add(position)
            if before is not None and position - before <= common and before != last:  # those two met before
                found.append((before, position, common))
            if after is not None and after - position <= common:
                found.append((position, after, common))
            last = position
    return np.array(found, dtype=np.int64).reshape(-1, 3)


def find_runs(codes: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """Number of the text, start, length and period of every run, by text, start and period.

    `codes` are the words of all texts end to end, `sizes` their numbers.
    """
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(sizes)), sizes)
    left = ends[text] - np.arange(len(codes))
    gram = max(1, -(-least // 2))
    chosen = np.zeros(len(sizes), dtype=bool)
    chosen[text[_recurring(codes, text, left, gram)]] = True
    mine = np.flatnonzero(chosen[text])
    none = np.empty(0, np.int64)
    if not len(mine):
        return none, none, none, none
    codes, text, left = codes[mine], text[mine], left[mine]
    first, second, common = _seeds(*_Suffixes(codes, text, left, gram).neighbours()).T
    period = second - first
    at_start = (first == 0) | (text[first] != text[first - 1])
    starts = at_start | (codes[first - 1] != codes[second - 1])
    whole = starts & (period + common >= least)
    first, length, period = first[whole], (period + common)[whole], period[whole]
    order = np.lexsort((period, length, first))
    first, length, period = first[order], length[order], period[order]
    least_period = np.ones(len(first), dtype=bool)
    least_period[1:] = (first[1:] != first[:-1]) | (length[1:] != length[:-1])
    first, length, period = first[least_period], length[least_period], period[least_period]
    start = mine[first] - (ends - sizes)[text[first]]
    order = np.lexsort((period, start, text[first]))
    return text[first][order], start[order], length[order], period[order]


def _kept(sizes: np.ndarray, text: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether each word stays: no run contains it after the run's first period."""
    change = np.zeros(int(sizes.sum()) + 1, dtype=np.int64)
    begin = (np.cumsum(sizes) - sizes)[text] + start
    np.add.at(change, begin + period, 1)
    np.add.at(change, begin + length, -1)
    return np.cumsum(change[:-1]) == 0


def _collapse(batch: pa.RecordBatch, text: str, least: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    sizes, codes, distinct = split_words(batch.column(text))
    owner, start, length, period = find_runs(codes, sizes, least)
    runs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], RUN.names)
    offsets = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(sizes)))))
    kept = _kept(sizes, owner, start, length, period)
    ends = np.concatenate(([0], np.cumsum(kept)))[np.concatenate(([0], np.cumsum(sizes)))]
    words = pa.LargeListArray.from_arrays(pa.array(ends), distinct.take(pa.array(codes[kept])))
    return (
        pa.array(sizes),
        pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), runs),
        pc.binary_join(words, pa.scalar(" ", distinct.type)),
    )


def collapse_runs(
    docs: DataFrame, text: str = "text", carry: Sequence[str] = ("doc_id",), least: int = LEAST
) -> DataFrame:
    """One row per input row: the columns `carry`, n_words, runs (start, length, period), collapsed.

    Runs stand in order of start, then period.
    """
    added = [("n_words", T.LongType()), ("runs", T.ArrayType(RUN)), ("collapsed", T.StringType())]
    kept = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)], F.col(f"`{text}`").alias("text"))
    schema = T.StructType([*kept.schema.fields[:-1], *[T.StructField(name, kind) for name, kind in added]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n_words, runs, collapsed = _collapse(batch, "text", least)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], n_words, runs, collapsed.cast(pa.string())], schema.names)

    return kept.mapInArrow(work, schema).toDF(*carry, *[name for name, _ in added])
