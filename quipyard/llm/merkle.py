"""Merkle manifest of a table: a hash tree per group, a tree over the groups' roots, a proof per row.

A leaf is H (SHA-256, lowercase hex) of the row's columns, each `-` if null, else its UTF-8 byte count,
`:` and its value. Inside a group leaves ascend by id (null first), equal ids by leaf; rows equal in
both are interchangeable. While several nodes remain, every two consecutive ones become the H of their
digests' text; a last one alone becomes the H of itself. What remains is the group's subroot; subroots,
ordered by group (null first, then by UTF-8 bytes), give the root in the same way.

Leaf coordinates come from bitmaps, not from a sort. Ids of a group are cut into chunks of 2^13; each
chunk is a compressed bitmap with a directory of the ones before every 512 bits, put together from parts
of any number of tasks. A running sum over the chunks' totals gives each chunk its first coordinate, and
a leaf's own is that plus its rank in the bitmap. Only chunks are ordered, ranges of them at a time.

Coordinates are slots: blocks of 2^LEVELS consecutive nodes are keyed by group and block number, filled
into a slot array and reduced all levels at once, then blocks of block roots, and so on, so a round
divides the nodes by 2^LEVELS whatever the size of a group. Each task holds the nodes of one block.
Paths of blocks are joined back down to the leaves, once per round.

Ids that several rows share are counted in the bitmaps; their rows are told apart by leaf, in slices of
the leaf's first digits, so one id may hold any share of the rows. An empty table has no root and no rows.
Columns are named by the caller; further ones are never looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from quipyard.session import store

#: Ids in a chunk, bits in an entry of its directory.
CHUNK = 1 << 13
ENTRY = 512
#: Levels that one round reduces.
LEVELS = 10
#: Parts of one chunk that meet at once.
FAN_IN = 256
#: Rows that share an id are dealt out by so many hex digits of their leaf.
DIGITS = 4


def leaf_hash(columns: Sequence[Column]) -> Column:
    """H of the columns as they would be written."""

    def field(column: Column) -> Column:
        text = column.cast("string")
        return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


# Bitmaps


def pack_ids(low: np.ndarray, count: np.ndarray) -> bytes:
    """Chunk of distinct places with their numbers of rows, compressed.

    Holds the number of entries, which covers CHUNK places and those behind them that are there (65,536 at most),
    the directory, the bitmap, and places and numbers of rows where that is not 1.
    """
    entries = max(CHUNK // ENTRY, int(low.max(initial=0)) // ENTRY + 1)
    bits = np.zeros(entries * ENTRY, dtype=np.uint8)
    bits[low] = 1
    packed = np.packbits(bits, bitorder="little")
    per_entry = bits.reshape(-1, ENTRY).sum(axis=1, dtype=np.int64)
    directory = (np.cumsum(per_entry) - per_entry).astype("<u2")
    many = np.flatnonzero(count > 1)
    extra = low[many].astype("<u2").tobytes() + count[many].astype("<i8").tobytes()
    return zlib.compress(np.array([entries], "<u2").tobytes() + directory.tobytes() + packed.tobytes() + extra, 1)


class Bitmap:
    """An opened chunk."""

    def __init__(self, packed: bytes):
        data = zlib.decompress(packed)
        entries, data = int.from_bytes(data[:2], "little"), data[2:]
        self.directory = np.frombuffer(data, "<u2", entries).astype(np.int64)
        self.words = np.frombuffer(data, "<u8", entries * ENTRY // 64, 2 * entries)
        rest = data[2 * entries + entries * ENTRY // 8 :]
        many = len(rest) // 10
        self.repeated = np.frombuffer(rest, "<u2", many).astype(np.int64)
        self.count = np.frombuffer(rest, "<i8", many, 2 * many)

    def rank(self, low: np.ndarray) -> np.ndarray:
        """Rows whose place is below each of the given ones: directory, whole words, part of a word."""
        word = low >> 6
        found = self.directory[low // ENTRY].copy()
        first = (low // ENTRY) * (ENTRY // 64)
        for step in range(ENTRY // 64 - 1):
            before = first + step < word
            found += np.where(before, np.bitwise_count(self.words[first + step]).astype(np.int64), 0)
        mask = (np.uint64(1) << (low & 63).astype(np.uint64)) - np.uint64(1)
        found += np.bitwise_count(self.words[word] & mask).astype(np.int64)
        if len(self.repeated):
            extra = np.concatenate(([0], np.cumsum(self.count - 1)))
            found += extra[np.searchsorted(self.repeated, low)]
        return found

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and their numbers of rows."""
        low = np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little"))
        count = np.ones(len(low), dtype=np.int64)
        count[np.searchsorted(low, self.repeated)] = self.count
        return low, count


PARTS = pa.schema([("grp", pa.string()), ("chunk", pa.int64()), ("part", pa.int32()), ("ids", pa.binary())])
CHUNKS = pa.schema([("grp", pa.string()), ("chunk", pa.int64()), ("n", pa.int64()), ("repeated", pa.bool_()), ("ids", pa.binary())])


def _chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks of each batch of (grp, chunk, low), as parts of the whole chunks."""
    task = TaskContext.get().partitionId()
    for number, batch in enumerate(batches):
        groups = batch.column("grp").dictionary_encode()
        code = groups.indices.to_numpy(zero_copy_only=False)
        chunk, low = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("chunk", "low"))
        order = np.lexsort((low, chunk, code))
        code, chunk, low = code[order], chunk[order], low[order]
        begins = np.flatnonzero(np.concatenate(([True], (code[1:] != code[:-1]) | (chunk[1:] != chunk[:-1]))))
        part = (task * 31 + number) % FAN_IN
        rows = [
            {"grp": groups.dictionary[int(code[a])].as_py(), "chunk": int(chunk[a]), "part": part, "ids": pack_ids(*np.unique(low[a:b], return_counts=True))}
            for a, b in zip(begins, [*begins[1:], len(low)])
            if b > a
        ]
        yield pa.RecordBatch.from_pylist(rows, schema=PARTS)


def _merged(parts: pa.Table) -> dict:
    """One chunk from its parts."""
    total = np.zeros(CHUNK, dtype=np.int64)
    for ids in parts.column("ids"):
        low, count = Bitmap(ids.as_py()).places()
        total[low] += count
    low = np.flatnonzero(total)
    return {
        "grp": parts.column("grp")[0].as_py(),
        "chunk": parts.column("chunk")[0].as_py(),
        "part": 0,
        "n": int(total.sum()),
        "repeated": bool((total > 1).any()),
        "ids": pack_ids(low, total[low]),
    }


def bitmaps(ids: DataFrame) -> DataFrame:
    """(grp, chunk, n, repeated, ids): one compressed bitmap per group and chunk, from rows (grp, chunk, low).

    Parts meet FAN_IN ways first, so no task gets all parts of a chunk that every task has seen.
    """

    def merge(schema: pa.Schema):
        return lambda parts: pa.Table.from_pylist([_merged(parts)], schema=schema)

    parts = ids.mapInArrow(_chunks_of, from_arrow_schema(PARTS))
    fewer = parts.groupBy("grp", "chunk", "part").applyInArrow(merge(PARTS), from_arrow_schema(PARTS))
    return fewer.groupBy("grp", "chunk").applyInArrow(merge(CHUNKS), from_arrow_schema(CHUNKS))


def running_total(rows: DataFrame, by: str, order: str, amount: str) -> DataFrame:
    """(by, order, before): the sum of `amount` over the rows of the same `by` that come earlier.

    Ranges of the order are summed up by themselves; only one sum per range and `by` is put in order.
    `by` and `order` name a row.
    """
    narrow = rows.select(by, order, amount).repartitionByRange(by, order).withColumn("part", F.spark_partition_id())
    dealt = store(narrow, "ranges")
    inside = Window.partitionBy("part", by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy(by, "part").agg(F.sum(amount).alias("sum"))
    firsts = sums.select(by, "part", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("first"))
    placed = dealt.withColumn("inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return placed.join(firsts, [by, "part"]).select(by, order, (F.col("first") + F.col("inside")).alias("before"))


# Coordinates


def _shared_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(grp, chunk, low, before) of places that hold several rows."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            chunk = Bitmap(row["ids"])
            for low, before in zip(chunk.repeated.tolist(), chunk.rank(chunk.repeated).tolist()):
                rows.append({"grp": row["grp"], "chunk": row["chunk"], "low": low, "before": row["before"] + before})
        yield pa.RecordBatch.from_pylist(rows, schema=SHARED)


SHARED = pa.schema([("grp", pa.string()), ("chunk", pa.int64()), ("low", pa.int32()), ("before", pa.int64())])


def _rank(rows: pa.Table, chunk: pa.Table) -> pa.Table:
    """Coordinates of the rows of one chunk."""
    ids = Bitmap(chunk.column("ids")[0].as_py())
    at = chunk.column("before")[0].as_py() + ids.rank(rows.column("low").to_numpy().astype(np.int64))
    return pa.table([rows.column("grp"), pa.array(at), rows.column("row").combine_chunks()], ["grp", "at", "row"])


def _among_equals(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """(grp, at, row) for rows of ids that several rows share, in order of leaf.

    Equal rows travel as one with a number; rows of one id are dealt to slices of their leaf.
    """
    on = ["grp", "chunk", "low"]
    leaf = F.col("row.leaf")
    counted = rows.join(shared, on).groupBy(*on, "before", "row").agg(F.count(F.lit(1)).alias("copies"))
    sliced = counted.withColumn("slice", F.substring(leaf, 1, DIGITS))
    sums = sliced.groupBy(*on, "slice").agg(F.sum("copies").alias("sum"))
    slices = Window.partitionBy(*on).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sums.select(*on, "slice", F.coalesce(F.sum("sum").over(slices), F.lit(0)).alias("first"))
    inside = Window.partitionBy(*on, "slice").orderBy(leaf, "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = sliced.withColumn("inside", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(firsts, [*on, "slice"])
    at = F.col("before") + F.col("first") + F.col("inside")
    step, last = 10_000, F.col("copies") - 1
    every = F.explode(F.sequence(F.lit(0), F.floor(last / step)))
    steps = placed.select("grp", at.alias("at"), "row", last.alias("last"), every.alias("step"))
    each = F.explode(F.sequence(F.col("step") * step, F.least(F.col("last"), F.col("step") * step + step - 1)))
    copies = steps.repartition("grp", "at", "step").select("grp", "at", "row", each.alias("copy"))
    return copies.select("grp", (F.col("at") + F.col("copy")).alias("at"), "row")


def coordinates(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (grp, at, row) with `at` counted from 0 in each group, and (grp, n); stored.

    `rows` has grp, chunk, low and a struct `row` with a field `leaf`, stored as well.
    """
    found = store(bitmaps(rows.select("grp", "chunk", "low")), "bitmaps")
    before = running_total(found, "grp", "chunk", "n")
    chunks = store(found.join(before, ["grp", "chunk"]), "chunks")
    groups = store(found.groupBy("grp").agg(F.sum("n").alias("n")), "groups")
    some = chunks.filter("repeated").select("grp", "chunk", "before", "ids")
    shared = None
    if some.head(1):
        shared = store(some.mapInArrow(_shared_ids, from_arrow_schema(SHARED)), "shared-ids")
    single = rows if shared is None else rows.join(shared, ["grp", "chunk", "low"], "left_anti")
    schema = T.StructType([T.StructField("grp", T.StringType()), T.StructField("at", T.LongType()), rows.schema["row"]])

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        return _rank(left, right) if left.num_rows else to_arrow_schema(schema).empty_table()

    keys = ["grp", "chunk"]
    placed = single.groupBy(*keys).cogroup(chunks.groupBy(*keys)).applyInArrow(rank, schema)
    if shared is not None:
        placed = placed.unionByName(_among_equals(rows, shared))
    return placed, groups


# Trees


def node_hash(*digests: bytes) -> bytes:
    """H of digests, written in hex one behind the other."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def height(n: int) -> int:
    """Levels above `n` leaves."""
    return max(n - 1, 0).bit_length()


def reduce_block(nodes: list[bytes], levels: int) -> tuple[bytes, list[bytes]]:
    """What the nodes of one block become after so many levels, and each one's siblings from below."""
    paths: list[list[bytes]] = [[] for _ in nodes]
    for level in range(levels):
        for i, path in enumerate(paths):
            sibling = (i >> level) ^ 1
            if sibling < len(nodes):
                path.append(nodes[sibling])
        nodes = [node_hash(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], [b"".join(p) for p in paths]


def fold(node: bytes, at: int, n: int, path: bytes) -> tuple[bytes, bytes]:
    """The root that a node at a coordinate among `n` has with these siblings, and the rest of the path."""
    while n > 1:
        if at ^ 1 < n:
            sibling, path = path[:32], path[32:]
            node = node_hash(sibling, node) if at & 1 else node_hash(node, sibling)
        else:
            node = node_hash(node)
        at, n = at >> 1, (n + 1) >> 1
    return node, path


def _reduce_round(nodes: DataFrame, done: int) -> DataFrame:
    """One row per node with its `path` inside its block, and one with `top` for each block's result.

    `nodes` has grp, at, n (leaves of the group), node and a struct `row` that travels along.
    """
    fields = [T.StructField(f.name, f.dataType) for f in nodes.schema]  # all of them nullable
    schema = T.StructType([*fields, T.StructField("path", T.BinaryType()), T.StructField("top", T.BooleanType())])
    out = to_arrow_schema(schema)

    def reduce(key: tuple, block: pa.Table) -> pa.Table:
        at = block.column("at").to_numpy()
        slots = np.empty(block.num_rows, dtype=np.int64)
        slots[at & ((1 << LEVELS) - 1)] = np.arange(block.num_rows)
        block = block.take(pa.array(slots))
        n = block.column("n")[0].as_py()
        node, paths = reduce_block(block.column("node").to_pylist(), min(LEVELS, max(0, height(n) - done)))
        mine = block.select(columns)
        mine = mine.append_column("path", pa.array(paths, pa.binary())).append_column("top", pa.array([False] * len(paths)))
        top = {"grp": block.column("grp")[0].as_py(), "at": int(at[0]) >> LEVELS, "n": n, "node": node, "row": None, "path": b"", "top": True}
        return pa.concat_tables([mine.select(out.names).cast(out), pa.Table.from_pylist([top], schema=out)])

    columns = nodes.columns
    keyed = nodes.withColumn("block", F.shiftright("at", LEVELS))
    return keyed.groupBy("grp", "block").applyInArrow(reduce, schema)


def _climb(nodes: DataFrame, tallest: int) -> tuple[list[DataFrame], DataFrame]:
    """Nodes of every round with their paths, and (grp, node): what each group became."""
    rounds = []
    for done in range(0, max(1, tallest), LEVELS):
        reduced = store(_reduce_round(nodes, done), "round")
        rounds.append(reduced.filter("NOT top").drop("top"))
        nodes = reduced.filter("top").drop("path", "top")
    return rounds, nodes.select("grp", "node")


def _descend(rounds: list[DataFrame], above: DataFrame, carried: list[str]) -> DataFrame:
    """Nodes of the first round with their whole paths; `above` has grp, path and the columns `carried`.

    In the last round a group has one block, so no join has more rows of a key than a block has nodes.
    """
    renamed = above.select("grp", F.col("path").alias("upper"), *carried)
    on = ["grp"]
    for i, nodes in reversed(list(enumerate(rounds))):
        if i < len(rounds) - 1:
            nodes = nodes.withColumn("block", F.shiftright("at", LEVELS))
        nodes = nodes.join(renamed, on).withColumn("path", F.concat("path", "upper")).drop("upper", "block")
        renamed = nodes.select("grp", F.col("at").alias("block"), F.col("path").alias("upper"), *carried)
        on = ["grp", "block"]
    return nodes


@dataclass(frozen=True)
class Manifest:
    """`root` in hex (None for an empty table), the number of groups, and a row for each leaf.

    `proofs` has grp (as given), the struct `row`, at, n, group_at, subroot (hex) and path: the siblings'
    digests from the leaf's level to the root's.
    """

    root: str | None
    groups: int
    proofs: DataFrame


def build(leaves: DataFrame, group: str, id: str, leaf: str, carry: Sequence[str] = ()) -> Manifest:
    """Manifest of the leaves; `row` holds id, leaf and the columns `carry`. Ids are whole numbers."""
    number = F.col(id).cast("bigint")
    # null ids have a chunk of their own below all others
    chunk = F.coalesce(F.shiftright(number, CHUNK.bit_length() - 1), F.lit(-(1 << 62)))
    low = F.coalesce(number.bitwiseAND(F.lit(CHUNK - 1)), F.lit(0)).cast("int")
    row = F.struct(number.alias("id"), F.col(leaf).alias("leaf"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])
    # '' for null, which sorts first; other names keep their byte order
    name = F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit(""))
    rows = store(leaves.select(name.alias("grp"), chunk.alias("chunk"), low.alias("low"), row.alias("row")), "leaves")
    placed, sizes = coordinates(rows)
    tallest, groups = sizes.agg(F.max("n"), F.count("*")).first()
    nodes = placed.join(sizes, "grp").withColumn("node", F.unhex("row.leaf")).select("grp", "at", "n", "node", "row")
    rounds, subroots = _climb(nodes, height(tallest or 0))

    order = running_total(sizes.select(F.lit("").alias("of"), "grp", F.lit(1).alias("one")), "of", "grp", "one")
    tops = subroots.join(order, "grp").select(
        F.lit("").alias("grp"),
        F.col("before").alias("at"),
        F.lit(groups).cast("bigint").alias("n"),
        "node",
        F.struct("grp", F.col("node").alias("subroot")).alias("row"),
    )
    upper, root = _climb(tops, height(groups))
    found = root.first()
    whole = _descend(upper, root.select("grp", F.lit(b"").alias("path")), [])
    above = whole.select("row.grp", "path", F.col("at").alias("group_at"), F.lower(F.hex("row.subroot")).alias("subroot"))
    proofs = _descend(rounds, above, ["group_at", "subroot"])
    named = F.when(F.col("grp") != "", F.expr("substring(grp, 2)")).alias("grp")
    fields = ["row", "at", "n", "group_at", "subroot", "path"]
    return Manifest(found.node.hex() if found else None, groups, proofs.select(named, *fields))


def check_rows(manifest: Manifest, claimed: Column) -> DataFrame:
    """The proofs with proof_sha256, folded_root (of the claimed leaf and the siblings) and verified."""
    root, groups = manifest.root, manifest.groups
    rows = manifest.proofs.withColumn("claimed", claimed)
    added = [("proof_sha256", T.StringType()), ("folded_root", T.StringType())]
    schema = T.StructType([*rows.schema.fields, *[T.StructField(name, kind) for name, kind in added]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            proofs, folded = [], []
            columns = (batch.column(c).to_pylist() for c in ("claimed", "at", "n", "group_at", "path"))
            for leaf, at, n, group_at, path in zip(*columns):
                proofs.append(hashlib.sha256(path.hex().encode()).hexdigest())
                node, rest = fold(bytes.fromhex(leaf), at, n, path)
                folded.append(fold(node, group_at, groups, rest)[0].hex())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(proofs, pa.string()), pa.array(folded, pa.string())], schema.names)

    return rows.mapInArrow(work, schema).withColumns(
        {"root": F.lit(root).cast("string"), "verified": F.col("folded_root") == F.lit(root).cast("string")}
    )
