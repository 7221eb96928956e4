"""Passages that repeat across documents, found by chaining shared word k-mers.

Texts are lower-cased (A-Z) and cut at ASCII whitespace and punctuation into words.

1. Seeds. Of the hashes of K words in each window of WINDOW places the least is a seed, so two equal
   runs of K + WINDOW - 1 words share one. The owner of a seed is the document with the least id that
   has it, at its first place there. All other documents with the seed are joined to the owner, not to
   each other, so the links of a seed grow with its documents, not with their square (see 4). All periods of a
   repeated phrase have the same seeds, which meet at the owner's first period only. So stretches of
   LEAST words or more that repeat up to WINDOW words get further seeds, numbered from their start.
   Two stretches that start at other words of the phrase may lose a period at their ends, and a passage
   of a shorter stretch and a few other words has too few seeds to be found.
2. Chains. The seeds that a document shares with one owner are merged along diagonals and chained in
   order of both texts: a Fenwick tree over the owner's places keeps the best chain so far, and a gap
   costs GAP_COST a word on either side. A chain is cut where a gap is longer than MOST_GAP.
3. Alignment. The words of the chain and of MARGIN words on both sides are fetched from the two texts as
   16-bit codes. Segments are compared word by word, gaps between them by their longest common
   subsequence, and the ends are extended while they agree. A passage of LEAST words or more with a
   share of SIMILAR equal words is reported; a worse chain is cut at its worst gap and tried again.
4. Second owners. Early documents may own all seeds of a passage and yet hold only pieces of it. So runs of
   LONG words are seeds as well, in the same windows, of which every run of LEAST words has one. Where two
   documents share one that lies in no passage found so far, all runs of LEAST words around it elect an
   owner of their own, which has at least those words in common with every other document. So no document
   with LEAST equal words in a row is left out, whatever else holds parts of them.
5. Partners beside the owners. A place of a seed is settled if a passage leads from it to the owner of the seed,
   or to another document that has the seed there: that document stands for it. Documents where a seed is not
   settled, and its owner, are compared with each other as far as they share two such seeds that stand as
   a chain may begin (see 2). First a few of the documents with the same two
   seeds, HEADS of them, are compared with all others; then those that are still not settled with every document
   that has both seeds. So edited passages whose seeds belong to others are found whoever owns them, no number of
   documents with a seed is too high, and the pairs of a group of edited copies grow with its documents, not with
   their square. Only documents that share two seeds and no passage are compared all with all.

Only links and the words near them are shuffled, and a join of seeds with owners can be split where
many documents share a seed. Repeats inside one document are not reported. Rows with the same id count
as one document, and so do rows without an id. Null, blank and short texts have no passages. Documents
that are wholly copies are passages as well. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipyard.llm.decontamination import _TABLE
from quipyard.llm.words import slices, split_words
from quipyard.session import store

K, WINDOW = 5, 12
LEAST, SIMILAR = 50, 0.8
MOST_GAP, MARGIN = 50, 64
GAP_COST = 0.05
#: Words of a long seed: with a window of WINDOW places, each run of LEAST words has one.
LONG = LEAST - WINDOW + 1
#: Words from first to last of a chain; the ends of a passage hold no seed.
SPAN = max(K, LEAST - 2 * (K + WINDOW))
#: Numbers of documents with the same two unsettled seeds that the others are compared with, by round; at last all (None).
HEADS = (8, None)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STRETCH = np.uint64(0xD6E8FEB86659FD93)
_NO_ID = -(1 << 63)
#: Rows, each of a document or a chain of the second owners, up to which they are broadcast; beyond, they are joined.
BROADCAST_ROWS = 20_000
#: Words of 64 bits, 8 MB in all, that tell which documents have a chain.
SLOTS = 1 << 20


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of words of each text and a 64-bit hash of each word."""
    data = [(t or b"").translate(_TABLE) for t in texts.cast(pa.binary()).to_pylist()]
    sizes, codes, distinct = split_words(pa.array(data, pa.large_binary()).cast(pa.large_string()))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))
    return sizes, hashes[codes] if len(distinct) else np.zeros(0, np.uint64)


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, words): the upper 32 bits of each word's hash."""
    for batch in slices(batches, "text"):
        sizes, words = word_hashes(batch.column("text"))
        ends, codes = np.cumsum(sizes).tolist(), (words >> np.uint64(32)).astype("<u4")
        data = [codes[e - n : e].tobytes() for e, n in zip(ends, sizes.tolist())]
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(data, pa.binary())], ["doc", "words"])


def _words_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The words of each row as whole numbers."""
    for value in batch.column("words"):
        yield np.frombuffer(value.as_buffer(), "<u4").astype(np.uint64)


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the `length` words from each place on; a run is put together from two shorter ones."""
    runs, size = words, 1
    for bit in bin(length)[3:]:
        power = np.uint64(pow(int(_BASE), size, 1 << 64))
        runs, size = runs[: len(runs) - size] * power + runs[size:], 2 * size
        if bit == "1":
            runs, size = runs[:-1] * _BASE + words[size:], size + 1
    runs = runs ^ runs >> np.uint64(29)
    runs *= np.uint64(0xBF58476D1CE4E5B9)
    return runs ^ runs >> np.uint64(32)


def least_in_windows(hashes: np.ndarray) -> np.ndarray:
    """Places of the least hash in each window of WINDOW places."""
    windows = np.lib.stride_tricks.sliding_window_view(hashes, min(WINDOW, len(hashes)))
    return np.unique(windows.argmin(axis=1) + np.arange(len(windows)))


def long_seeds(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and hashes of the long seeds of one text."""
    if len(words) < LEAST:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    runs = run_hashes(words, LONG)
    places = least_in_windows(runs)
    seeds, first = np.unique(runs[places], return_index=True)
    return places[first], seeds


def minimizers(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the seeds of one text."""
    n = len(words) - K + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = run_hashes(words, K)
    places = least_in_windows(grams)
    seeds = grams[places]
    if len(np.unique(seeds)) < len(seeds):  # so in every stretch of a repeated phrase
        more = stretches(words, grams)
        places, seeds = np.concatenate([places, *[p for p, _ in more]]), np.concatenate([seeds, *[h for _, h in more]])
    return places, seeds


def stretches(words: np.ndarray, grams: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Numbered seeds in each stretch of LEAST words or more that repeats a phrase of up to WINDOW words."""
    found, known = [], []
    for period in range(1, WINDOW + 1 if len(words) >= LEAST else 1):
        breaks = np.flatnonzero(words[period:] != words[:-period])
        starts, ends = np.append(0, breaks + 1), np.append(breaks, len(words) - period) + period
        for i in np.flatnonzero(ends - starts >= LEAST).tolist():
            start, end = int(starts[i]), int(ends[i])
            if any(a <= start and end <= b for a, b in known):  # by a shorter period
                continue
            known.append((start, end))
            first = start + int(grams[start : start + period].argmin())
            places = np.arange(first, end - K + 1, -(-WINDOW // period) * period)
            seeds = (grams[first] ^ _STRETCH) + _BASE * np.arange(1, len(places) + 1, dtype=np.uint64)
            seeds *= np.uint64(0xBF58476D1CE4E5B9)
            found.append((places, seeds ^ seeds >> np.uint64(32)))
    return found


def _seeds_by(choose):
    """Rows (seed, doc, at) of what `choose` finds in the coded words of each text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "words"):
            yield _seed_rows(batch.column("doc"), [choose(words) for words in _words_of(batch)])

    return work


def _seed_rows(docs: pa.Array, found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    counts = np.array([len(p) for p, _ in found])
    columns = [
        pa.array(np.concatenate([h for _, h in found]).view(np.int64)),
        pa.array(np.repeat(docs.to_numpy(zero_copy_only=False), counts), pa.int64()),
        pa.array(np.concatenate([p for p, _ in found]).astype(np.int32)),
    ]
    return pa.RecordBatch.from_arrays(columns, ["seed", "doc", "at"])


def _runs_around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seed, doc, at) of every run of LEAST words that holds one of the long seeds at `places`."""
    for batch in slices(batches, "words"):
        found = []
        for words, places in zip(_words_of(batch), batch.column("places").to_pylist()):
            if len(words) < LEAST:  # other rows with the same id hold the seed
                found.append((np.zeros(0, np.int64), np.zeros(0, np.uint64)))
                continue
            runs = run_hashes(words, LEAST)
            around = np.unique(np.add.outer(np.array(places), np.arange(LONG - LEAST, 1)))
            around = around[(around >= 0) & (around < len(runs))]
            seeds, first = np.unique(runs[around], return_index=True)
            found.append((around[first], seeds))
        yield _seed_rows(batch.column("doc"), found)


def merge_diagonals(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Segments (x, y, words, seeds) of seeds on one diagonal with small gaps, in order of x."""
    order = np.lexsort((x, x - y))
    x, y = x[order], y[order]
    new = np.ones(len(x), bool)
    new[1:] = (np.diff(x - y) != 0) | (np.diff(x) > MOST_GAP)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(x)) - 1
    return sorted(zip(x[starts].tolist(), y[starts].tolist(), (x[ends] - x[starts] + K).tolist(), (ends - starts + 1).tolist()))


def chain(segments: list[tuple[int, int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Best chains of segments (x, y, words), each segment in one of them."""
    ends_y = sorted({y + n for _, y, n, _ in segments})
    place = {v: i + 1 for i, v in enumerate(ends_y)}
    size = len(ends_y)
    tree: list[tuple[float, int]] = [(-1e18, -1)] * (size + 1)  # best (score + cost of its end, segment) below

    def best(limit: int) -> tuple[float, int]:
        found, i = (-1e18, -1), int(np.searchsorted(ends_y, limit, side="right"))
        while i:
            found = max(found, tree[i])
            i -= i & -i
        return found

    scores, before = [0.0] * len(segments), [-1] * len(segments)
    # a segment can follow those that have ended in both texts
    events = sorted([(x, 1, i) for i, (x, _, _, _) in enumerate(segments)] + [(x + n, 0, i) for i, (x, _, n, _) in enumerate(segments)])
    for _, begins, i in events:
        x, y, n, _ = segments[i]
        if begins:
            value, j = best(y)
            value -= GAP_COST * (x + y)
            scores[i] = n + max(0.0, value)
            before[i] = j if value > 0 else -1
        else:
            entry, at = (scores[i] + GAP_COST * (x + y + 2 * n), i), place[y + n]
            while at <= size:
                tree[at] = max(tree[at], entry)
                at += at & -at
    used, found = [False] * len(segments), []
    for i in sorted(range(len(segments)), key=lambda i: -scores[i]):
        path: list[tuple[int, int, int]] = []
        while i >= 0 and not used[i]:
            used[i] = True
            x, y, n, _ = segments[i]
            if path and (path[-1][0] - x - n > MOST_GAP or path[-1][1] - y - n > MOST_GAP):
                found.append(path[::-1])
                path = []
            path.append((x, y, n))
            i = before[i]
        if path:
            found.append(path[::-1])
    return found


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, a word of bits per row."""
    if not len(a) or not len(b):
        return 0
    if len(a) == len(b) and (same := int((a == b).sum())) * 2 >= len(a):
        return same
    masks: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b.tolist():
        hit = row & masks.get(w, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def align(a: np.ndarray, b: np.ndarray, path: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Passages (start, end, other start, other end, equal words) along a chain of segments."""
    equal = [int((a[x : x + n] == b[y : y + n]).sum()) for x, y, n in path]
    gaps = [
        (common(a[p[0] + p[2] : q[0]], b[p[1] + p[2] : q[1]]), max(q[0] - p[0] - p[2], q[1] - p[1] - p[2]))
        for p, q in zip(path, path[1:])
    ]
    found, todo = [], [(0, len(path))]
    while todo:
        lo, hi = todo.pop()
        x0, y0 = path[lo][:2]
        x1, y1 = path[hi - 1][0] + path[hi - 1][2], path[hi - 1][1] + path[hi - 1][2]
        matched = sum(equal[lo:hi]) + sum(m for m, _ in gaps[lo : hi - 1])
        left, more_left = _extend(a[:x0][::-1], b[:y0][::-1])
        right, more_right = _extend(a[x1:], b[y1:])
        x0, y0, x1, y1 = x0 - left, y0 - left, x1 + right, y1 + right
        matched += more_left + more_right
        if min(x1 - x0, y1 - y0) < LEAST:
            continue
        if matched >= SIMILAR * max(x1 - x0, y1 - y0):
            found.append((x0, x1, y0, y1, matched))
        elif hi - lo > 1:
            worst = max(range(lo, hi - 1), key=lambda g: gaps[g][1] - gaps[g][0])
            todo += [(lo, worst + 1), (worst + 1, hi)]
    return found


def _extend(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Words to go on while most of them agree, and how many of those agree."""
    n = min(len(a), len(b))
    if not n:
        return 0, 0
    gain = np.cumsum(np.where(a[:n] == b[:n], 1, -3))
    stop = np.flatnonzero(gain < np.maximum.accumulate(gain) - 12)
    gain = gain[: stop[0]] if len(stop) else gain
    best = int(gain.argmax()) if len(gain) else 0
    if not len(gain) or gain[best] <= 0:
        return 0, 0
    return best + 1, int((a[: best + 1] == b[: best + 1]).sum())


_PATH = "ARRAY<STRUCT<x: INT, y: INT, n: INT>>"


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chains of sorted links; one pair of documents in memory."""
    kind = pa.list_(pa.struct([("x", pa.int32()), ("y", pa.int32()), ("n", pa.int32())]))

    def finish(pair, parts):
        x, y = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        paths = [p for p in chain(merge_diagonals(x, y)) if p[-1][0] + p[-1][2] - p[0][0] >= SPAN]
        return [(*pair, [dict(zip("xyn", s)) for s in path]) for path in paths]

    def batch_of(rows):
        columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], kind)]
        return pa.RecordBatch.from_arrays(columns, ["doc", "owner", "path"])

    last, held, rows = None, [], []
    for batch in batches:
        doc, owner, x, y = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("doc", "owner", "at", "owner_at"))
        cuts = np.flatnonzero((np.diff(doc) != 0) | (np.diff(owner) != 0)) + 1
        for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(doc)]):
            if start == stop:
                continue
            pair = (int(doc[start]), int(owner[start]))
            if held and pair != last:
                rows += finish(last, held)
                held = []
            held.append((x[start:stop], y[start:stop]))
            last = pair
        yield batch_of(rows)
        rows = []
    if held:
        yield batch_of(finish(last, held))


def _owned(seeds: DataFrame) -> DataFrame:
    """(seed, owner, owner_at) of seeds that several documents have; stored, so that a join with it has a
    shuffle on either side, of which large parts can be split."""
    return store(
        seeds.groupBy("seed")
        .agg(F.min(F.struct("doc", "at")).alias("first"), F.max("doc").alias("last"))
        .filter("first.doc <> last")
        .select("seed", F.col("first.doc").alias("owner"), F.col("first.at").alias("owner_at")),
        "owners",
    )


def first_links(docs: DataFrame) -> DataFrame:
    """(seed, doc, owner, at, owner_at): the seeds of each document and their owners; `docs` has doc and words."""
    seeds = docs.mapInArrow(_seeds_by(minimizers), "seed BIGINT, doc BIGINT, at INT")
    return seeds.join(_owned(seeds), "seed").filter("doc <> owner").select("seed", "doc", "owner", "at", "owner_at")


def second_links(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Links of documents that share LEAST words in a row of which one of them is in no passage of `found`."""
    seeds = docs.mapInArrow(_seeds_by(long_seeds), "seed BIGINT, doc BIGINT, at INT")
    shared = store(seeds.join(_owned(seeds).select("seed"), "seed"), "long-seeds")
    spans = found.select("doc", "start", "end").union(found.select("owner", "owner_start", "owner_end")).distinct()
    inside = (F.col("s.doc") == F.col("p.doc")) & (F.col("at") >= F.col("start")) & (F.col("at") + LONG <= F.col("end"))
    open_ = store(shared.alias("s").join(spans.alias("p"), inside, "left_anti"), "open-seeds")
    # documents that hold a seed which is open in one of them
    marked = shared.join(open_.select("seed").distinct(), "seed", "left_semi").join(
        open_.select("seed", "doc", F.lit(True).alias("open")), ["seed", "doc"], "left"
    )
    places = store(marked.groupBy("doc").agg(F.collect_set("at").alias("places"), F.max("open").alias("open")), "places")
    runs = docs.join(_hinted(places), "doc").select("doc", "words", "places").mapInArrow(_runs_around, "seed BIGINT, doc BIGINT, at INT")
    runs = store(runs.join(places.select("doc", F.coalesce("open", F.lit(False)).alias("open")), "doc"), "runs")
    owners = _owned(runs).join(places.select(F.col("doc").alias("owner"), F.col("open").alias("owner_open")), "owner")
    links = runs.join(owners, "seed").filter("doc <> owner AND (open OR owner_open)")
    # a run is two seeds on one diagonal
    ends = F.explode(F.array(F.lit(0), F.lit(LEAST - K))).alias("step")
    return links.select("doc", "owner", "at", "owner_at", ends).select(
        "doc", "owner", (F.col("at") + F.col("step")).alias("at"), (F.col("owner_at") + F.col("step")).alias("owner_at")
    )


def _within(at: str, start: str, end: str) -> Column:
    """Whether a seed of K words lies in a passage."""
    return (F.col(at) >= F.col(start)) & (F.col(at) + K <= F.col(end))


def unsettled(links: DataFrame, found: DataFrame) -> DataFrame:
    """The links of `first_links` whose document has no passage there with another one that has the seed; stored."""
    with_owner = (F.col("l.doc") == F.col("p.doc")) & (F.col("l.owner") == F.col("p.owner"))
    with_owner &= _within("at", "start", "end") & _within("owner_at", "owner_start", "owner_end")
    open_ = store(links.alias("l").join(found.alias("p"), with_owner, "left_anti"), "open-links")
    spans = found.select("doc", "start", "end", F.col("owner").alias("other"), "owner_start", "owner_end")
    beside = open_.join(spans, "doc").filter(_within("at", "start", "end") & (F.col("other") != F.col("owner")))
    partners = links.select("seed", F.col("doc").alias("other"), F.col("at").alias("other_at"))
    settled = beside.join(partners, ["seed", "other"]).filter(_within("other_at", "owner_start", "owner_end"))
    return store(open_.join(settled.select("seed", "doc", "at").distinct(), ["seed", "doc", "at"], "left_anti"), "unsettled")


def _seed_pairs(places: DataFrame) -> DataFrame:
    """(s, t, doc, behind, apart): two seeds of a document as a chain may begin with them, where several documents have
    both; stored.

    A chain begins with a segment of SPAN words, or with a shorter one and the first seed of the next segment, a gap off.
    So its first seed s and a seed t are at most SPAN + MOST_GAP words apart in both texts. In the owner they stand
    `apart`, at their first places there; no number if an owner of both, which was compared by then. For each place of t
    in the document, `behind` holds how far it is from places of s.
    """
    most = SPAN + MOST_GAP
    part = F.floor(F.col("at") / most)
    columns = lambda c: [F.col("seed").alias(c), *[F.col(x).alias(f"{c}_{x}") for x in ("at", "first", "owns")]]
    before = places.select("doc", *columns("s"), F.explode(F.array(part, part + 1)).alias("part"))
    both = before.join(places.select("doc", *columns("t"), part.alias("part")), ["doc", "part"])
    both = both.withColumn("apart", F.col("t_at") - F.col("s_at")).filter(F.col("apart").between(K, most) & (F.col("s") != F.col("t")))
    rows = both.groupBy("s", "t", "doc", "t_at").agg(
        F.collect_set("apart").alias("behind"),
        F.max(F.when((F.col("s_at") == F.col("s_first")) & (F.col("t_at") == F.col("t_first")), F.col("apart"))).alias("apart"),
        F.max(F.col("s_owns") & F.col("t_owns")).alias("known"),
    )
    rows = rows.groupBy("s", "t", "doc").agg(F.collect_list("behind").alias("behind"), F.max("apart").alias("apart"), F.max("known").alias("known"))
    rows = store(rows.select("s", "t", "doc", "behind", F.when(~F.col("known"), F.col("apart")).alias("apart")), "seed-pairs")
    several = rows.groupBy("s", "t").agg(F.min(F.when(F.col("apart").isNotNull(), F.col("doc"))).alias("least"), F.max("doc").alias("last"))
    return store(rows.join(several.filter("least < last").select("s", "t"), ["s", "t"]), "shared-pairs")


def _partners(rows: DataFrame, buckets: int | None) -> DataFrame:
    """(doc, owner) of documents that may have a chain and of which one is open in its first two seeds; of the owners
    only the least of each bucket of each two seeds (None: all)."""
    owners = rows.filter("apart IS NOT NULL").select("s", "t", F.col("doc").alias("owner"), "apart", F.col("open").alias("owner_open"))
    if buckets:
        least = owners.groupBy("s", "t", F.pmod(F.hash("owner"), F.lit(buckets)).alias("bucket")).agg(F.min(F.struct(*owners.columns[2:])).alias("head"))
        owners = least.select("s", "t", "head.*")
    # t is not the first seed of a segment if s stands on the same diagonal just before it
    begins = (F.col("apart") >= SPAN - K) | F.exists("behind", lambda x: ~F.array_contains(x, F.col("apart")))
    pairs = rows.drop("apart").join(owners, ["s", "t"]).filter((F.col("doc") > F.col("owner")) & (F.col("open") | F.col("owner_open")) & begins)
    return pairs.select("doc", "owner").distinct()


def _still_open(rows: DataFrame, places: DataFrame, found: DataFrame) -> DataFrame:
    """`rows` of `_seed_pairs` less the seeds without an open document; a document is open where no passage of `found`
    leads from one of its seeds to another document that has the seed there. Stored."""
    spans = found.select("doc", "start", "end", F.col("owner").alias("other"), "owner_start", "owner_end")
    spans = spans.union(found.select("owner", "owner_start", "owner_end", "doc", "start", "end"))
    partners = places.select("seed", F.col("doc").alias("other"), F.col("at").alias("other_at"))
    inside = places.join(spans, "doc").filter(_within("at", "start", "end"))
    settled = inside.join(partners, ["seed", "other"]).filter(_within("other_at", "owner_start", "owner_end"))
    settled = settled.select("seed", "doc", "at").distinct()
    left = places.join(settled, ["seed", "doc", "at"], "left_anti").select("seed", "doc").distinct()
    left = store(left, "open-places")
    for seed in ("s", "t"):
        rows = rows.join(left.select(F.col("seed").alias(seed), "doc", F.lit(True).alias(f"open_{seed}")), [seed, "doc"], "left")
    still = F.col("open") & (F.col("open_s").isNotNull() | F.col("open_t").isNotNull())
    rows = store(rows.select("s", "t", "doc", "behind", "apart", still.alias("open")), "marked-pairs")
    return store(rows.join(rows.filter("open").select("s", "t").distinct(), ["s", "t"], "left_semi"), "open-pairs")


def further_passages(links: DataFrame, named: DataFrame) -> DataFrame:
    """Passages of documents of unsettled links, and their owners, with each other, beside those known by then."""
    mine = links.select("seed", "doc", "at", F.lit(False).alias("owns"))
    owners = links.select("seed", F.col("owner").alias("doc"), F.col("owner_at").alias("at"), F.lit(True).alias("owns")).distinct()
    places = store(mine.union(owners), "unsettled-places")
    firsts = store(places.groupBy("seed", "doc").agg(F.min("at").alias("first")), "first-places")
    rows = _seed_pairs(places.join(firsts, ["seed", "doc"])).withColumn("open", F.lit(True))
    firsts = firsts.select("seed", F.col("doc").alias("owner"), F.col("first").alias("owner_at"))
    found = compared = None
    for buckets in HEADS:
        pairs = _partners(rows, buckets)
        pairs = store(pairs if compared is None else pairs.join(compared, ["doc", "owner"], "left_anti"), "pairs")
        compared = pairs if compared is None else compared.union(pairs)
        more = pairs.join(places, "doc").join(firsts, ["seed", "owner"]).select("doc", "owner", "at", "owner_at")
        more = store(passages_along(more, named), "further-passages")
        found = more if found is None else found.union(more)
        if buckets:
            rows = _still_open(rows, places, more)
    return found


def _hinted(rows: DataFrame) -> DataFrame:
    """Broadcast a stored table of few rows, each of which is short."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def chains_of(links: DataFrame) -> DataFrame:
    """doc, owner and path of each chain of seeds."""
    pairs = ["doc", "owner"]
    links = links.select(*pairs, "at", "owner_at")
    return links.repartition(*pairs).sortWithinPartitions(*pairs).mapInArrow(_chains, f"doc BIGINT, owner BIGINT, path {_PATH}")


def _documents(ids: DataFrame) -> np.ndarray:
    """Bits of the ids in a column `doc`, SLOTS words of 64; ids that are equal in those bits share one."""
    slot, bit = F.col("doc").bitwiseAND(F.lit(SLOTS - 1)), F.shiftright("doc", SLOTS.bit_length() - 1).bitwiseAND(F.lit(63))
    table = ids.select(slot.alias("slot"), F.expr("1L").alias("one"), bit.cast("int").alias("bit")).groupBy("slot")
    table = table.agg(F.bit_or(F.expr("shiftleft(one, bit)")).alias("bits")).toArrow()  # SLOTS rows at most
    bits = np.zeros(SLOTS, np.uint64)
    bits[table["slot"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return bits


def _codes_of(named: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc, codes): 16-bit codes of all words of the documents with one of the ids, and of few others."""
    shared = named.sparkSession.sparkContext.broadcast(_documents(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column("doc").to_numpy()
            shift = (doc >> (SLOTS.bit_length() - 1) & 63).astype(np.uint64)
            batch = batch.filter(pa.array((shared.value[doc & (SLOTS - 1)] >> shift & np.uint64(1)).astype(bool)))
            data = [(words >> np.uint64(16)).astype("<u2").tobytes() for words in _words_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(data, pa.binary())], ["doc", "codes"])

    return named.mapInArrow(run, "doc BIGINT, codes BINARY")


_PASSAGE = (
    "doc BIGINT, start INT, end INT, owner BIGINT, owner_start INT, owner_end INT, words INT, equal_words INT"
)


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _PASSAGE.split(", ")]
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            path = [(s["x"] - r["a_from"], s["y"] - r["b_from"], s["n"]) for s in r["path"]]
            a, b = (np.frombuffer(r[c] or b"", "<u2") for c in ("a", "b"))
            for x0, x1, y0, y1, matched in align(a, b, path):
                rows.append((r["doc"], x0 + r["a_from"], x1 + r["a_from"], r["owner"], y0 + r["b_from"], y1 + r["b_from"], x1 - x0, matched))
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), *[pa.int32()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)], names)


def passages_along(links: DataFrame, named: DataFrame) -> DataFrame:
    """Passages of the documents (doc, words) along chains of links, as `_PASSAGE`."""
    first, final = F.col("path")[0], F.element_at("path", -1)
    chains = store(
        chains_of(links).select(
            "doc",
            "owner",
            "path",
            F.greatest(first["x"] - MARGIN, F.lit(0)).alias("a_from"),
            (final["x"] + final["n"] + MARGIN).alias("a_to"),
            F.greatest(first["y"] - MARGIN, F.lit(0)).alias("b_from"),
            (final["y"] + final["n"] + MARGIN).alias("b_to"),
            F.monotonically_increasing_id().alias("chain"),
        ),
        "chains",
    )
    wanted = chains.select("chain", F.lit(True).alias("own"), "doc", F.col("a_from").alias("at"), F.col("a_to").alias("to")).union(
        chains.select("chain", F.lit(False), "owner", "b_from", "b_to")
    )
    codes = _codes_of(named, wanted.select("doc"))  # the other texts are not shuffled
    if chains.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    # the words of each region, two bytes each, meet under the number of the chain
    regions = wanted.join(codes, "doc").select(
        "chain", "own", F.expr("substring(codes, 2 * at + 1, 2 * (to - at))").alias("part")
    )
    sides = regions.groupBy("chain").agg(
        F.max(F.when(F.col("own"), F.col("part"))).alias("a"), F.max(F.when(~F.col("own"), F.col("part"))).alias("b")
    )
    return chains.drop("a_to", "b_to").join(sides, "chain").drop("chain").mapInArrow(_aligned, _PASSAGE)


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per passage: doc_id, start, end, source_id, source_start, source_end (in words), words,
    similarity. `source_id` is the owner that the document is compared with, always another document."""
    texts = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID)).alias("doc"), F.col(text).alias("text"))
    named = store(texts.mapInArrow(_coded, "doc BIGINT, words BINARY"), "words")  # texts are cut up once
    links = store(first_links(named), "links")
    found = store(passages_along(links, named), "passages")
    more = passages_along(second_links(named, found), named)
    found = found.union(store(more.join(found, found.columns, "left_anti"), "more-passages"))
    rest = further_passages(unsettled(links, found), named)
    same = [F.col(f"r.{c}") == F.col(f"f.{c}") for c in ("doc", "owner")]
    inside = [F.col("r.start") >= F.col("f.start"), F.col("r.end") <= F.col("f.end")]
    rest = rest.alias("r").join(found.alias("f"), [*same, *inside], "left_anti")
    known = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    return found.union(rest).select(
        known("doc").alias("doc_id"),
        "start",
        "end",
        known("owner").alias("source_id"),
        F.col("owner_start").alias("source_start"),
        F.col("owner_end").alias("source_end"),
        "words",
        (F.col("equal_words") / F.greatest("words", F.col("owner_end") - F.col("owner_start"))).alias("similarity"),
    )
