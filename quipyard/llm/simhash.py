"""SimHash near-duplicates by the generalised pigeonhole principle.

A text is lower-cased (A-Z), cut into words between ASCII whitespace and into shingles of `shingle`
words, repeats included; fewer words make one shingle, none makes fingerprint zero. A bit is set
when more than half of the shingles' XXH64 values (seed 42) have it. Distinct fingerprints link at
`distance` or fewer differing bits, and documents of one component of links are near-duplicates.

All work after the fingerprints is on distinct ones. Their 64 bits are split into parts of correlated
bits. If the thresholds t of the parts sum up to distance - parts + 1, two linked fingerprints differ
by at most t bits in some part (t = -1 leaves a part out). Each fingerprint gets its own thresholds by
dynamic programming over the numbers of candidates that counts of all part values predict. It is
stored under its value of each part and looked up under all values within the threshold; candidates
are verified on all 64 bits.

A part value that very many fingerprints share is compared in blocks of bounded size, block against
block; of the links found in one comparison only a spanning forest goes on, so the links of a dense
group stay linear. What the driver sees is bounded: 64 x 64 bit counts and 2**16 counts per part.

A null text is an empty one. Repeated rows share a fingerprint. `component_id` is the least doc_id of
the component, null only if all are null. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipyard.llm.components import connected_components
from quipyard.llm.rows import keep_once, row_key, wrapped
from quipyard.llm.words import slices
from quipyard.session import store

SEED = 42
#: Most fingerprints on either side of a comparison.
BLOCK = 2048
#: Bits of a part that the counts of its values tell apart.
COUNTED = 16
#: Largest threshold of a part.
MOST = 2


def fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = [0, *(blanks + 1).tolist()], [*blanks.tolist(), len(joined)]
    size, digest = min(shingle, len(words)), xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :])], ">u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    # sums of 255 rows fit a byte
    counts = np.zeros(64, np.int64)
    for i in range(0, len(bits), 255):
        counts += bits[i : i + 255].sum(axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(counts * 2 > len(bits)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, print (the 64 bits as a signed number) and text_hash of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            prints = np.array([fingerprint(t or b"", shingle) for t in texts], np.uint64).view(np.int64)
            columns = [batch.column("doc_id"), pa.array(prints), batch.column("text_hash")]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "print", "text_hash"])

    content = F.coalesce(F.col(text), F.lit(""))
    source = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), content.alias("text"), F.xxhash64(content).alias("text_hash")
    )
    return source.mapInArrow(run, "doc_id BIGINT, print BIGINT, text_hash BIGINT")


def _print_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        yield batch.column("print").to_numpy(zero_copy_only=False).view(np.uint64)


def _bit_counts(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how often each two bits are set together."""

    def run(batches):
        total, n = np.zeros((64, 64)), 0
        for x in _print_batches(batches):
            bits = (x[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)).astype(np.float32)
            total, n = total + bits.T @ bits, n + len(x)
        i, j = np.triu_indices(64)
        places = np.concatenate((i * 64 + j, [4096]))
        counts = np.concatenate((total[i, j].astype(np.int64), [n]))
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(counts)], ["place", "n"])

    sums = prints.mapInArrow(run, "place BIGINT, n BIGINT").groupBy("place").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(4097)
    for row in sums:
        flat[row.place] = row.n
    upper = flat[:4096].reshape(64, 64)
    return int(flat[4096]), np.triu(upper) + np.triu(upper, 1).T


def correlated_parts(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """The 64 bits in parts of near-equal size, each grown from the bits most correlated with it."""
    share = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    strength = np.abs((together / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(strength, 0)
    free, found = list(range(64)), []
    for k in range(parts, 0, -1):
        size = -(-len(free) // k)
        part = [max(free, key=lambda b: strength[b, free].sum())]
        free.remove(part[0])
        while len(part) < size:
            part.append(max(free, key=lambda b: strength[b, part].sum()))
            free.remove(part[-1])
        found.append(sorted(part))
    return found


def part_values(x: np.ndarray, parts: list[list[int]]) -> np.ndarray:
    """Value of each part of each fingerprint."""
    one = np.uint64(1)
    values = np.zeros((len(parts), len(x)), np.uint64)
    for p, bits in enumerate(parts):
        for place, bit in enumerate(bits):
            values[p] |= (x >> np.uint64(bit) & one) << np.uint64(place)
    return values


def _value_counts(prints: DataFrame, parts: list[list[int]]) -> list[np.ndarray]:
    """How often each value of each part occurs, told apart by its low COUNTED bits."""

    def run(batches):
        counts = np.zeros((len(parts), 1 << COUNTED), np.int64)
        for x in _print_batches(batches):
            for p, v in enumerate(part_values(x, parts)):
                counts[p] += np.bincount((v & np.uint64((1 << COUNTED) - 1)).astype(np.int64), minlength=1 << COUNTED)
        p, v = np.nonzero(counts)
        columns = [pa.array(p.astype(np.int64)), pa.array(v.astype(np.int64)), pa.array(counts[p, v])]
        yield pa.RecordBatch.from_arrays(columns, ["part", "value", "n"])

    sums = prints.mapInArrow(run, "part BIGINT, value BIGINT, n BIGINT").groupBy("part", "value").agg(F.sum("n").alias("n"))
    table = sums.toArrow()
    part, value, n = (table[c].to_numpy() for c in ("part", "value", "n"))
    found = []
    for p, bits in enumerate(parts):
        counts = np.zeros(1 << COUNTED)
        counts[value[part == p]] = n[part == p]
        found.append(counts / 2 ** max(0, len(bits) - COUNTED))
    return found


def expected_candidates(counts: np.ndarray, bits: int) -> np.ndarray:
    """Candidates of each value at thresholds 0, 1 and 2, and a unit for each look-up."""
    flips = min(bits, COUNTED)
    near = lambda c: sum(c[np.arange(len(c)) ^ (1 << b)] for b in range(flips))
    first = near(counts)
    second = (near(first) - flips * counts) / 2
    one, two = bits, bits * (bits - 1) / 2
    return np.stack((counts + 1, counts + first + 1 + one, counts + first + second + 1 + one + two))


def thresholds(costs: np.ndarray, total: int) -> np.ndarray:
    """Cheapest thresholds per part (rows) and fingerprint with the given sum, by dynamic programming.

    costs: part x threshold (0 to MOST) x fingerprint; threshold -1 costs nothing.
    """
    parts, _, n = costs.shape
    width = parts * (MOST + 1) + 1  # sums from -parts
    best = np.full((width, n), np.inf)
    best[0] = 0
    chosen = []
    for p in range(parts):
        after, choice = np.full((width, n), np.inf), np.zeros((width, n), np.int8)
        for t in range(-1, MOST + 1):
            step = t + 1
            cost = best[: width - step] + (costs[p, t] if t >= 0 else 0)
            better = cost < after[step:]
            after[step:][better] = cost[better]
            choice[step:][better] = t
        best = after
        chosen.append(choice)
    at, found = np.full(n, total + parts), np.zeros((parts, n), np.int64)
    for p in range(parts - 1, -1, -1):
        found[p] = chosen[p][at, np.arange(n)]
        at = at - found[p] - 1
    return found


def _entries(prints: DataFrame, parts: list[list[int]], counts: list[np.ndarray], distance: int) -> DataFrame:
    """key, print, look_up: each fingerprint under its part values, and under those it looks up."""
    context = prints.sparkSession.sparkContext
    tables = context.broadcast([expected_candidates(c, len(b)).astype(np.float32) for c, b in zip(counts, parts)])
    total = distance - len(parts) + 1

    def run(batches):
        for x in _print_batches(batches):
            values = part_values(x, parts)
            low = (values & np.uint64((1 << COUNTED) - 1)).astype(np.int64)
            costs = np.stack([table[:, low[p]] for p, table in enumerate(tables.value)])
            chosen = thresholds(costs, total)
            keys, prints_, looks = [], [], []
            for p, bits in enumerate(parts):
                base = np.uint64(p << 58)
                keys.append(values[p] | base)
                prints_.append(x)
                looks.append(np.zeros(len(x), bool))
                for t in range(MOST + 1):
                    some = chosen[p] >= t
                    if not some.any():
                        break
                    for flipped in combinations(range(len(bits)), t):
                        mask = np.uint64(sum(1 << b for b in flipped))
                        keys.append((values[p][some] ^ mask) | base)
                        prints_.append(x[some])
                        looks.append(np.ones(int(some.sum()), bool))
            columns = [np.concatenate(keys).view(np.int64), np.concatenate(prints_).view(np.int64), np.concatenate(looks)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "print", "look_up"])

    return prints.mapInArrow(run, "key BIGINT, print BIGINT, look_up BOOLEAN")


def _blocks(entries: DataFrame, block: int) -> DataFrame:
    """key, own, other, print, look_up: entries of keys that many share, split into blocks.

    A stored entry of block i meets the look-ups of each block j, and the other way round.
    """
    crowded = (
        entries.groupBy("key")
        .agg(F.count("*").alias("n"), F.count(F.when(~F.col("look_up"), 1)).alias("stored"))
        .filter("stored > 0 AND n > 1")
        .select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")
    met = entries.join(crowded, "key").withColumn("own", own)
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.select(
        "key",
        F.when(F.col("look_up"), F.col("other")).otherwise(F.col("own")).alias("stored_block"),
        F.when(F.col("look_up"), F.col("own")).otherwise(F.col("other")).alias("look_block"),
        "print",
        "look_up",
    )


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (node, root) of links between numbers."""
    nodes, places = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = places[: len(a)], places[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        after = label.copy()
        np.minimum.at(after, label[u], low)
        np.minimum.at(after, label[v], low)
        after = after[after]
        if (after == label).all():
            break
        label = after
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _compare(distance: int):
    """Links in sorted runs of (key, blocks): streamed, one run in memory."""

    def links(stored: np.ndarray, looking: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = [], []
        for i in range(0, len(looking), 512):
            some = looking[i : i + 512]
            near = np.bitwise_count(some[:, None] ^ stored[None, :]) <= distance
            p, q = np.nonzero(near)
            other = some[p] != stored[q]
            x, y = some[p[other]], stored[q[other]]
            if len(x):
                x, y = _forest(x, y)  # what goes on stays linear in the block
                a.append(x)
                b.append(y)
        return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.uint64),) * 2

    def finish(runs: list[tuple[np.ndarray, np.ndarray]]):
        x = np.concatenate([r[0] for r in runs])
        look = np.concatenate([r[1] for r in runs])
        stored, looking = np.unique(x[~look]), np.unique(x[look])
        if len(stored) and len(looking) and (len(stored) > 1 or stored[0] != looking[0] or len(looking) > 1):
            return links(stored, looking)
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last, out = [], None, []

        def batch_of(out):
            a, b = (np.concatenate([o[k] for o in out]).view(np.int64) for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            ids = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "stored_block", "look_block")]
            x = batch.column("print").to_numpy(zero_copy_only=False).view(np.uint64)
            look = batch.column("look_up").to_numpy(zero_copy_only=False)
            change = np.flatnonzero(np.any([np.diff(c) != 0 for c in ids], axis=0)) + 1
            for start, stop in zip([0, *change.tolist()], [*change.tolist(), len(x)]):
                if start == stop:
                    continue
                name = tuple(int(c[start]) for c in ids)
                if held and name != last:
                    out.append(finish(held))
                    held = []
                held.append((x[start:stop], look[start:stop]))
                last = name
            if out:
                yield batch_of(out)
                out = []
        if held:
            yield batch_of([finish(held)])

    return run


def near_links(prints: DataFrame, distance: int, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within `distance` bits of each other.

    Every two linked ones are in one component of the result; not every pair is listed.
    """
    n, together = _bit_counts(prints)
    parts = correlated_parts(n, together, parts_for(n, distance))
    entries = store(_entries(prints, parts, _value_counts(prints, parts), distance), "entries")
    runs = ["key", "stored_block", "look_block"]
    met = _blocks(entries, block).repartition(*runs).sortWithinPartitions(*runs)
    return met.mapInArrow(_compare(distance), "a BIGINT, b BIGINT")


def parts_for(n: int, distance: int) -> int:
    """Number of parts: fewer and longer ones for more fingerprints; all give the same links."""
    return max(1, min(distance, 4 if n < 1 << 24 else 3))


def near_duplicates(
    docs: DataFrame, shingle: int = 4, distance: int = 4, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, print, text_hash, component_id."""
    marked = store(fingerprints(docs, shingle, doc_id, text), "fingerprints")
    prints = store(marked.groupBy("print").agg(F.min("doc_id").alias("least")), "prints")
    links = store(near_links(prints.select("print"), distance), "near")
    stars = connected_components(links)
    rooted = prints.join(stars, F.col("print") == F.col("node"), "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    heads = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = store(rooted.join(heads, "root").select("print", "component_id", "root"), "components")
    return marked.join(named, "print").select("doc_id", "print", "text_hash", "root", "component_id")


def keep_one_of_each(
    docs: DataFrame, shingle: int = 4, distance: int = 4, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`docs` with one row of each component, the one with the least doc_id; all columns as they were."""
    near = near_duplicates(docs, shingle, distance, doc_id, text)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")).alias("best")
    heads = store(near.groupBy("root").agg(best), "heads")
    staying = heads.select(row_key(F.col("best.doc_id"), F.col("best.text_hash")).alias("key"))
    hash_of = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    return keep_once(wrapped(docs, key=row_key(F.col(doc_id).cast("long"), hash_of)), staying)


def print_hex(column: str = "print"):
    """The 64 bits as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
