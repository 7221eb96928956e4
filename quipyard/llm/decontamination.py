"""Benchmark passages in documents by greedy string tiling.

Texts are lower-cased (A-Z) and cut into tokens at ASCII whitespace and punctuation. A document and a
benchmark item that share a run of SEED tokens are compared: their matching runs are found by rolling
Karp-Rabin hashes of SEED tokens, verified token by token, and the longest run whose tokens are still
unmarked on both sides is marked again and again, ties by the earliest place in the item, then in the
document. Marked tokens of the item, divided by all of its tokens, are its coverage; passages that
were reordered are covered by several tiles. An item of fewer than SEED tokens is covered by a run of
all of its tokens.

The benchmark is the stated query set. It goes to the executors in blocks of bounded size, each of
which is compared with all documents in one narrow pass, so neither side is shuffled and no document
leaves its task. One block holds BLOCK_TOKENS tokens; a larger benchmark takes more passes.

Texts that repeat themselves may have a match for every pair of places. An item with more than MOST_PAIRS
pairs of equal seeds is tiled without listing them, with the same tiles, in time and memory that grow
with the lengths of the two texts.

Null or blank texts and items match nothing. Repeated documents give a row each, as do repeated
items. Empty tables give an empty result.
"""

from __future__ import annotations

import heapq
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipyard.llm.words import slices

#: Tokens of a seed, and of the shortest tile.
SEED = 5
#: Covered share of an item's tokens from which a document counts as contaminated.
COVERAGE = 0.6
#: Tokens of benchmark items in one block: some tens of megabytes on an executor.
BLOCK_TOKENS = 1_000_000
#: Pairs of equal seeds of a document and an item up to which all matches are listed.
MOST_PAIRS = 1 << 16
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TABLE = bytes.maketrans(
    (string.ascii_uppercase + string.punctuation).encode(),
    (string.ascii_lowercase + " " * len(string.punctuation)).encode(),
)


def tokens(text: str | bytes | None) -> list[bytes]:
    """Lower-case tokens between ASCII whitespace and punctuation."""
    data = text.encode() if isinstance(text, str) else text or b""
    return data.translate(_TABLE).split()


def rolling(codes: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash of each run of `length` codes, modulo 2**64."""
    n = len(codes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    found = np.zeros(n, np.uint64)
    for k in range(length):
        found = found * _BASE + codes[k : k + n]
    return found


def merge_seeds(doc: np.ndarray, item: np.ndarray, d: np.ndarray, i: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Maximal matches (place in the document, place in the item, length) from the places of shared seeds."""
    for k in range(least):  # two runs of one hash
        same = doc[d + k] == item[i + k]
        d, i = d[same], i[same]
    order = np.lexsort((d, d - i))
    d, i = d[order], i[order]
    if not len(d):
        return []
    new = np.ones(len(d), bool)
    new[1:] = (np.diff(d - i) != 0) | (np.diff(d) != 1)
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, len(d))) + least - 1
    return list(zip(d[starts].tolist(), i[starts].tolist(), lengths.tolist()))


def tile(doc: np.ndarray, item: np.ndarray, runs: list[tuple[int, int, int]], least: int) -> list[tuple[int, int, int]]:
    """Tiles (place in the document, place in the item, length) from all maximal matches.

    A match that has lost tokens to longer ones goes back with what is left of it.
    """
    heap = [(-n, i, d) for d, i, n in runs]
    heapq.heapify(heap)
    in_doc, in_item, found = np.zeros(len(doc), bool), np.zeros(len(item), bool), []
    while heap:
        n, i, d = heapq.heappop(heap)
        n = -n
        taken = np.flatnonzero(in_doc[d : d + n] | in_item[i : i + n])
        if not len(taken):
            in_doc[d : d + n] = in_item[i : i + n] = True
            found.append((d, i, n))
            continue
        edges = [-1, *taken.tolist(), n]
        for a, b in zip(edges, edges[1:]):
            if b - a - 1 >= least:
                heapq.heappush(heap, (-(b - a - 1), i + a + 1, d + a + 1))
    return sorted(found)


class _Side:
    """One of two texts that are tiled: hashes of its runs of any length, and what is marked."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.marked = codes, np.zeros(len(codes) + 1, bool)
        base, inverse = int(_BASE), pow(int(_BASE), -1, 1 << 64)
        powers = np.full(len(codes) + 1, np.uint64(base))
        back = np.full(len(codes) + 1, np.uint64(inverse))
        powers[0] = back[0] = 1
        powers, self.back = np.cumprod(powers), np.cumprod(back)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * powers[:-1])))

    def open(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the runs of one length without a marked token."""
        n = len(self.codes) - length + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        marks = np.concatenate(([0], np.cumsum(self.marked[:-1])))
        at = np.flatnonzero(marks[length:] == marks[:n])
        return at, (self.sums[at + length] - self.sums[at]) * self.back[at]


def tile_by_length(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """The tiles of `tile` without listing the matches, for texts that repeat themselves.

    The greatest length at which open runs of both sides have a hash in common is searched for; the runs
    of that length are marked, in order of the item's places, each with the first open one of the
    document, until there is none; then the next length is. Time grows with the lengths of the texts and
    the number of different tile lengths, memory with the lengths only.
    """
    sides, found = (_Side(doc), _Side(item)), []

    def common(length: int) -> bool:
        (_, a), (_, b) = (side.open(length) for side in sides)
        return bool(np.isin(b, a).any())

    longest = min(len(doc), len(item))
    while longest >= least:
        low, high = least - 1, longest
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if common(middle) else (low, middle - 1)
        if low < least:
            break
        found += _mark_runs(*sides, low)
        longest = low - 1
    return sorted(found)


def _mark_runs(doc: _Side, item: _Side, length: int) -> list[tuple[int, int, int]]:
    (at, hashes), (wanted, keys) = doc.open(length), item.open(length)
    some = np.isin(hashes, keys)
    at, hashes = at[some], hashes[some]
    order = np.argsort(hashes, kind="stable")
    at, hashes = at[order], hashes[order]
    first, last = np.searchsorted(hashes, keys, "left").tolist(), np.searchsorted(hashes, keys, "right").tolist()
    begun: dict[int, int] = {}  # where the open places of a hash begin; those before are marked
    found, free = [], 0
    for i, a, b in zip(wanted.tolist(), first, last):
        if i < free:
            continue
        k = begun.get(a, a)
        # no shorter stretch is marked at this length, so the ends tell
        while k < b and (doc.marked[at[k]] or doc.marked[at[k] + length - 1]):
            k += 1
        begun[a] = k
        for d in at[k:b]:
            if doc.marked[d] or doc.marked[d + length - 1]:
                continue
            if (doc.codes[d : d + length] == item.codes[i : i + length]).all():
                doc.marked[d : d + length] = item.marked[i : i + length] = True
                found.append((int(d), i, length))
                free = i + length
                break
    return found


class Block:
    """Items of one block by the hashes of their seeds."""

    def __init__(self, items: list[tuple[int, str]], seed: int = SEED):
        self.seed, self.words = seed, {}
        code = lambda w: self.words.setdefault(w, len(self.words) + 1)  # noqa: E731  0: in no item
        self.items = [(i, np.fromiter(map(code, tokens(t)), np.uint64)) for i, t in items]
        hashes, owners, places, self.short = [], [], [], []
        for k, (_, codes) in enumerate(self.items):
            if 0 < len(codes) < seed:
                self.short.append(k)
            found = rolling(codes, seed)
            hashes.append(found)
            owners.append(np.full(len(found), k))
            places.append(np.arange(len(found)))
        every = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.hashes = every[order]
        self.owners = np.concatenate(owners)[order].astype(np.int64) if hashes else np.zeros(0, np.int64)
        self.places = np.concatenate(places)[order].astype(np.int64) if hashes else np.zeros(0, np.int64)
        # one bit for each value of a hash's top 16 bits: most runs of a document are no seed
        self.some = np.zeros(1 << 16, bool)
        self.some[(self.hashes >> np.uint64(48)).astype(np.int64)] = True

    def matches(self, text: bytes) -> Iterator[tuple[int, float, list[tuple[int, int, int]]]]:
        """(item number, coverage, tiles) of items that share a seed with a text."""
        get = self.words.get
        words = tokens(text)
        codes = np.fromiter((get(w, 0) for w in words), np.uint64, len(words))
        yield from self._short(codes)
        hashes = rolling(codes, self.seed)
        maybe = np.flatnonzero(self.some[(hashes >> np.uint64(48)).astype(np.int64)])
        low = np.searchsorted(self.hashes, hashes[maybe], "left")
        high = np.searchsorted(self.hashes, hashes[maybe], "right")
        hit = high > low
        if not hit.any():
            return
        low, which, times = np.unique(low[hit], return_inverse=True, return_counts=True)
        sizes = np.searchsorted(self.hashes, self.hashes[low], "right") - low
        # the items' places with each of the hashes, and how many pairs of places every item has
        entries = np.repeat(low - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        pairs = np.bincount(self.owners[entries], np.repeat(times, sizes), len(self.items))
        tiled = {k: tile_by_length(codes, self.items[k][1], self.seed) for k in np.flatnonzero(pairs > MOST_PAIRS).tolist()}
        entries = np.split(entries, np.cumsum(sizes)[:-1])
        entries = [e[pairs[self.owners[e]] <= MOST_PAIRS] for e in entries]
        sizes = np.array([len(e) for e in entries])
        d = np.repeat(maybe[hit], sizes[which])
        e = np.concatenate([entries[k] for k in which.tolist()])
        order = np.argsort(self.owners[e], kind="stable")
        d, e = d[order], e[order]
        cuts = np.flatnonzero(np.diff(self.owners[e])) + 1
        for d_of, e_of in zip(np.split(d, cuts), np.split(e, cuts)):
            if len(e_of):
                k = int(self.owners[e_of[0]])
                runs = merge_seeds(codes, self.items[k][1], d_of, self.places[e_of], self.seed)
                tiled[k] = tile(codes, self.items[k][1], runs, self.seed)
        for k in sorted(tiled):
            yield k, sum(n for _, _, n in tiled[k]) / len(self.items[k][1]), tiled[k]

    def _short(self, codes: np.ndarray):
        for k in self.short:
            item = self.items[k][1]
            at = np.flatnonzero(rolling(codes, len(item)) == rolling(item, len(item))[0])
            for d in at.tolist():
                if (codes[d : d + len(item)] == item).all():
                    yield k, 1.0, [(d, 0, len(item))]
                    break


def _item_blocks(benchmark: DataFrame, item_id: str, text: str, block_tokens: int) -> Iterator[list]:
    """The benchmark's rows in blocks; only one is held at a time."""
    block, held = [], 0
    rows = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).toLocalIterator()
    for row in rows:
        block.append((row.i, row.t))
        held += len(tokens(row.t))
        if held >= block_tokens:
            yield block
            block, held = [], 0
    yield block


_FOUND = (
    "doc_id BIGINT, item_id BIGINT, coverage DOUBLE, item_tokens BIGINT, "
    "tiles ARRAY<STRUCT<doc_at: INT, item_at: INT, tokens: INT>>"
)


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """A row for each document and item with at least that coverage: ids, coverage and tiles."""
    tile_type = pa.list_(pa.struct([("doc_at", pa.int32()), ("item_at", pa.int32()), ("tokens", pa.int32())]))
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), tile_type]
    names = ["doc_id", "item_id", "coverage", "item_tokens", "tiles"]
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = None
    for items in _item_blocks(benchmark, item_id, item_text, block_tokens):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = Block(shared.value)
            for batch in slices(batches, "text"):
                texts = batch.column("text").cast(pa.binary()).to_pylist()
                rows = []
                for doc, data in zip(batch.column("doc_id").to_pylist(), texts):
                    for k, share, tiles in block.matches(data) if data else ():
                        if share >= coverage:
                            item, codes = block.items[k]
                            places = [dict(zip(("doc_at", "item_at", "tokens"), t)) for t in tiles]
                            rows.append((doc, item, share, len(codes), places))
                columns = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, names)

        part = source.mapInArrow(run, _FOUND)
        found = part if found is None else found.union(part)
    return found


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """`docs` without documents that cover an item; all columns as they were, and no shuffle."""
    schema = docs.schema
    for items in _item_blocks(benchmark, item_id, item_text, block_tokens):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = Block(shared.value)
            for batch in slices(batches, text):
                texts = batch.column(text).cast(pa.binary()).to_pylist()
                clean = [not data or all(share < coverage for _, share, _ in block.matches(data)) for data in texts]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, schema)
    return docs
