"""Records that may hold line breaks, read from one large file by many tasks.

The text source deals a file out in byte ranges and cuts at a separator that also occurs inside records: a
line break in CSV, a closing brace in a JSON array. Whether such a cut ends a record depends on all that
stands before it: whether a quoted text is open, and how deep the brackets are nested. A piece, and so a
range, turns either of the two quote states into a state and a change of depth.

1. Every range is read once and gives one row: where it leads from either state.
2. A running composition over the ranges of a file gives each its true first state.
3. Every range is read again and cut into records. What lies over its borders comes out as fragments;
   those of a record, few and small, are put together by a group of their own.

Ranges are those of Spark's file scans, which depend on `spark.sql.files.*` and on the number of cores;
`spark.sql.files.minPartitionNum` is set where it is not, so that both readings see the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quipyard.session import store
from quipyard.sources.batches import in_parts

#: Ranges up to which their table, one short row each, is broadcast; beyond, it is joined.
BROADCAST_RANGES = 100_000
RECORD, HEAD, TAIL = 0, 1, 2

Steps = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


class CsvLines:
    """Lines: a record ends where no quoted cell is open. A quote opens a cell at its start only."""

    separator, end_depth = "\n", 0
    _cell = '(?:"(?:[^"]|"")*"[^,"]*|[^",][^,]*|)'
    _open = '"(?:[^"]|"")*$'
    _opens = f"^(?:{_cell},)*{_open}"
    _stays = f'^(?:(?:[^"]|"")*$|(?:[^"]|"")*"[^,"]*,(?:{_cell},)*{_open})'

    def steps(self, values: pa.Array) -> Steps:
        """State after each piece from state 0 and from state 1, and the changes of depth."""
        n = len(values)
        after = [np.zeros(n, dtype=np.int8), np.ones(n, dtype=np.int8)]
        quoted = np.flatnonzero(pc.match_substring(values, '"').to_numpy(zero_copy_only=False))
        some = values.take(pa.array(quoted))
        for result, pattern in zip(after, (self._opens, self._stays)):
            result[quoted] = pc.match_substring_regex(some, pattern).to_numpy(zero_copy_only=False)
        none = np.zeros(n, dtype=np.int64)
        return after[0], after[1], none, none


class JsonPieces:
    """What stands between closing braces: a record of an array ends where the depth is back at 1."""

    separator, end_depth = "}", 1

    def steps(self, values: pa.Array) -> Steps:
        plain = pc.replace_substring_regex(values, r"(?s)\\.", "")
        outside = self._from_outside(plain)
        closes = pc.match_substring(plain, '"').to_numpy(zero_copy_only=False)
        inside = self._from_outside(pc.replace_substring_regex(plain, r'^[^"]*"', ""))
        stays = ~closes
        return outside[0], np.where(stays, 1, inside[0]).astype(np.int8), outside[1], np.where(stays, 0, inside[1])

    @staticmethod
    def _from_outside(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        left = pc.replace_substring_regex(values, r'"[^"]*"', "")
        opens = pc.match_substring(left, '"').to_numpy(zero_copy_only=False)
        left = pc.replace_substring_regex(left, r'"[^"]*$', "")
        depth = sum(sign * pc.count_substring(left, c).to_numpy(zero_copy_only=False).astype(np.int64) for c, sign in (("{", 1), ("[", 1), ("]", -1)))
        # the brace the piece was cut at closes, unless a text is open
        return opens.astype(np.int8), depth - ~opens


def _walk(steps: Steps, state: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """State and depth after each piece."""
    from0, from1, depth0, depth1 = steps
    places = np.arange(len(from0))
    last = np.maximum.accumulate(np.where(from0 == from1, places, -1))
    swaps = np.cumsum((from0 == 1) & (from1 == 0))
    known = last >= 0
    after = np.where(known, from0[last], state) ^ ((swaps - np.where(known, swaps[last], 0)) & 1)
    before = np.concatenate(([state], after[:-1]))
    return after, depth + np.cumsum(np.where(before == 1, depth1, depth0))


def read_pieces(spark: SparkSession, paths: str | list[str], kind: CsvLines | JsonPieces) -> DataFrame:
    """(file, block, value): the pieces of each byte range in order; `file` is a hash of its path."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", spark.sparkContext.defaultParallelism)
    pieces = spark.read.text(paths, lineSep=kind.separator)
    return pieces.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.Array]]:
    """Rows of one range, which stand together: its key columns and its pieces."""
    names = [n for n in batch.schema.names if n != "value"]
    file, block = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("file", "block"))
    begins = np.flatnonzero(np.concatenate(([True], (file[1:] != file[:-1]) | (block[1:] != block[:-1])))) if len(file) else []
    for a, b in zip(begins, [*begins[1:], batch.num_rows]):
        yield tuple(batch.column(c)[int(a)].as_py() for c in names), batch.column("value").slice(a, b - a)


def find_ranges(pieces: DataFrame, kind: CsvLines | JsonPieces) -> DataFrame:
    """One stored row per range with a piece: file, block, state and depth before and after it, and for
    the first range of a file its first record that is not blank, `head`."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ends, head, whole = None, [], [], False

        def row() -> pa.RecordBatch:
            (s0, d0), (s1, d1) = ends
            text = "".join(head) if whole else None
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*current, s0, s1, d0, d1, text), types)], names)

        for batch in in_parts(batches, "value"):
            for key, values in _runs(batch):
                if key != current:
                    if current is not None:
                        yield row()
                    current, ends, head, whole = key, [(0, 0), (1, 0)], [], False
                steps = kind.steps(values)
                if key[1] == 0 and not whole:
                    states, depths = _walk(steps, *ends[0])
                    for value, state, depth in zip(values, states, depths):
                        head.append(value.as_py() + kind.separator)
                        if state == 0 and depth == kind.end_depth:
                            if "".join(head).strip():
                                whole = True
                                break
                            head = []
                walked = [_walk(steps, *end) for end in ends]
                ends = [(int(states[-1]), int(depths[-1])) for states, depths in walked]
        if current is not None:
            yield row()

    names = ["file", "block", "from0", "from1", "depth0", "depth1", "head"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
    schema = "file BIGINT, block BIGINT, from0 INT, from1 INT, depth0 BIGINT, depth1 BIGINT, head STRING"
    return store(_with_starts(pieces.mapInArrow(measure, schema)), "ranges")


def _with_starts(ranges: DataFrame) -> DataFrame:
    """States and depths before and after each range, from where it leads from either state."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.coalesce(F.sum(F.when((F.col("from0") == 1) & (F.col("from1") == 0), 1).otherwise(0)).over(before), F.lit(0))
    counted = ranges.withColumn("swaps", swaps)
    # the last range before this one that leads to one state from both
    fixed = F.max(F.when(F.col("from0") == F.col("from1"), F.struct("block", "from0", "swaps"))).over(before)
    state = F.coalesce(F.col("fixed.from0"), F.lit(0)).bitwiseXOR(
        ((F.col("swaps") - F.coalesce(F.col("fixed.swaps"), F.lit(0))) % 2).cast("int")
    )
    started = counted.withColumn("fixed", fixed).withColumn("state", state)
    change = F.when(F.col("state") == 1, F.col("depth1")).otherwise(F.col("depth0"))
    depth = F.coalesce(F.sum(change).over(before), F.lit(0))
    return started.withColumns({"depth": depth, "change": change}).select(
        "file",
        "block",
        "state",
        "depth",
        F.when(F.col("state") == 1, F.col("from1")).otherwise(F.col("from0")).alias("end_state"),
        (F.col("depth") + F.col("change")).alias("end_depth"),
        "head",
    )


@dataclass
class _Open:
    """A range while it is cut."""

    key: list  # file, block, tag
    state: int
    depth: int
    whole: bool  # whether the next piece begins a record
    first: bool  # whether the next record is the first of its file
    pending: list[str] = field(default_factory=list)


def cut_records(pieces: DataFrame, ranges: DataFrame, kind: CsvLines | JsonPieces, tag: Column) -> DataFrame:
    """(tag, first, record): every record with the separators it holds; `first` of its file or not.

    `tag` is a whole number for each range. Blank records before the first one have `first` false.
    """
    ranges = ranges.withColumn("tag", tag)
    few = ranges.count() <= BROADCAST_RANGES
    at_end = lambda state, depth: (F.col(state) == 0) & (F.col(depth) == kind.end_depth)
    starts_whole = at_end("state", "depth") | (F.col("block") == 0)
    found = _cut(_with_state(pieces, ranges, few), kind)
    parts = _cut(_with_state(pieces, ranges.where(~(starts_whole & at_end("end_state", "end_depth"))), few, True), kind)
    records = found.where(F.col("kind") == RECORD).select("tag", "first", F.col("text").alias("record"))
    return records.union(_join_fragments(parts.where(F.col("kind") != RECORD)))


def _with_state(pieces: DataFrame, ranges: DataFrame, few: bool, some: bool = False) -> DataFrame:
    """Pieces in order beside the state of their range; with `some`, those of the given ranges only."""
    states = ranges.select("file", "block", "state", "depth", "tag")
    how = "inner" if some else "left"
    if few:
        joined = pieces.join(F.broadcast(states), ["file", "block"], how)
    else:
        numbered = pieces.withColumn("line", F.monotonically_increasing_id())
        joined = numbered.join(states, ["file", "block"], how).sortWithinPartitions("file", "block", "line")
    unknown = F.raise_error(F.lit("a file changed, or was dealt out in other ranges, while it was read"))
    state = F.when(F.col("state").isNull(), unknown.cast("int")).otherwise(F.col("state"))
    return joined.select("file", "block", "tag", state.alias("state"), "depth", "value")


def _cut(pieces: DataFrame, kind: CsvLines | JsonPieces) -> DataFrame:
    separator, end_depth = kind.separator, kind.end_depth
    names = ["file", "block", "tag", "kind", "first", "text"]

    def out(of: _Open, kinds: list[int], first: list[bool], texts: pa.Array) -> pa.RecordBatch:
        keys = [pa.array(np.full(len(kinds), x, dtype=np.int64)) for x in of.key]
        return pa.RecordBatch.from_arrays([*keys, pa.array(kinds, pa.int32()), pa.array(first, pa.bool_()), texts], names)

    def rest(of: _Open) -> Iterator[pa.RecordBatch]:
        if of.pending:
            texts = pa.array(["".join(p + separator for p in of.pending)], pa.string())
            yield out(of, [TAIL if of.whole else HEAD], [of.first], texts)

    def texts_of(values: pa.Array, stops: np.ndarray) -> pa.Array:
        values = values.slice(0, int(stops[-1]))
        if len(stops) < len(values):
            offsets = pa.array(np.concatenate(([0], stops)), pa.int32())
            values = pc.binary_join(pa.ListArray.from_arrays(offsets, values), separator)
        return pc.binary_join_element_wise(values, "", separator)

    def records(of: _Open, values: pa.Array) -> Iterator[pa.RecordBatch]:
        states, depths = _walk(kind.steps(values), of.state, of.depth)
        of.state, of.depth = int(states[-1]), int(depths[-1])
        stops = np.flatnonzero((states == 0) & (depths == end_depth)) + 1
        if not len(stops):
            of.pending += values.to_pylist()
            return
        texts = texts_of(values, stops)
        if of.pending:
            begun = "".join(p + separator for p in of.pending) + texts[0].as_py()
            texts = pa.concat_arrays([pa.array([begun], pa.string()), texts.slice(1)])
        first = [False] * len(texts)
        if of.first:
            for i, text in enumerate(texts):
                if text.as_py().strip():
                    first[i], of.first = True, False
                    break
        kinds = [RECORD] * len(texts)
        if not of.whole:
            kinds[0], of.whole = HEAD, True
        yield out(of, kinds, first, texts)
        of.pending = values.slice(int(stops[-1])).to_pylist()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Open | None = None
        for batch in in_parts(batches, "value"):
            for key, values in _runs(batch):
                (*key, state, depth) = key
                if current is None or key != current.key:
                    if current is not None:
                        yield from rest(current)
                    at_start = key[1] == 0
                    current = _Open(key, state, depth, at_start or (state == 0 and depth == end_depth), at_start)
                yield from records(current, values)
        if current is not None:
            yield from rest(current)

    return pieces.mapInArrow(work, "file BIGINT, block BIGINT, tag BIGINT, kind INT, first BOOLEAN, text STRING")


def _join_fragments(parts: DataFrame) -> DataFrame:
    """Records that lie over borders of ranges: each begins with a tail and ends with a head."""
    begun = F.sum((F.col("kind") == TAIL).cast("int"))
    order = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, 0)
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "kind", "text"))), lambda p: p["text"]), "")
    # texts take no part in the running count
    narrow = parts.select("file", "block", "kind").withColumn("record", begun.over(order))
    records = parts.join(narrow, ["file", "block", "kind"]).groupBy("file", "record")
    return records.agg(F.max("tag").alias("tag"), F.max("first").alias("first"), text.alias("text")).select(
        "tag", "first", F.col("text").alias("record")
    )


def last_ranges(ranges: DataFrame) -> DataFrame:
    """(file, end_state, end_depth) after the last range of each file."""
    last = F.max(F.struct("block", "end_state", "end_depth"))
    return ranges.groupBy("file").agg(last.alias("last")).select("file", "last.end_state", "last.end_depth")
