"""Bottom-k fingerprints against sets of shingle hashes."""

import hashlib
import random
import re
import struct

import xxhash
from pyspark.sql import functions as F

from quipyard.llm import fingerprints, neighbours
from quipyard.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
ARRAY = "array<bigint>"


def _combined(hashes, seed=42):
    for h in hashes:
        seed = xxhash.xxh64_intdigest(struct.pack("<Q", h), seed=seed)
    return seed


def shingles(text):
    """Signed hashes of a text's shingles of five words."""
    h = [xxhash.xxh64_intdigest(w.encode(), seed=42) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    found = {_combined(h[i : i + 5]) for i in range(len(h) - 4)}
    if 0 < len(h) < 5:
        whole = 0
        for x in h:
            whole = _combined([whole, x])
        found = {whole}
    return {x - (1 << 64) if x >> 63 else x for x in found}


def bottom(hashes, k=128):
    return sorted(hashes)[:k]


def written(sketch):
    return "".join(f"{x & (2**64 - 1):016x}" for x in sketch)


def test_query_against_sets(spark):
    got = {r.doc_id: r for r in QUERIES["op12_fingerprints"](spark, FOLDER).collect()}
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())
    assert len(got) == len(docs)
    errors = []
    for i, (doc_id, text) in enumerate(docs):
        following = docs[(i + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row, own, other = got[doc_id], shingles(text), shingles(edited)
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == written(bottom(own)) and row.edited_fingerprint == written(bottom(other))
        least = bottom(own | other)
        expected = len(own & other & set(least)) / len(least) if least else 1.0
        assert abs(row.near_edited - expected) < 1e-12
        errors.append(abs(row.near_edited - (len(own & other) / len(own | other) if own | other else 1.0)))
    assert sum(errors) / len(errors) < 0.04 and max(errors) < 0.2


def test_estimates(spark, table):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(20_000)]
    a = words[:8000]
    b = words[4000:12_000]
    few = rng.sample(words, 30)
    rows = table("a STRING, b STRING", (" ".join(a), " ".join(b)), (" ".join(few), " ".join(few[:20])), ("", None), ("x", ""))
    f, g = (fingerprints.fingerprint(F.col(c)) for c in "ab")
    pairs = rows.select(f.alias("f"), g.alias("g"))
    got = pairs.select(
        F.size("f").alias("k"),
        fingerprints.resemblance(F.col("f"), F.col("g")).alias("near"),
        fingerprints.containment(F.col("g"), F.col("f")).alias("inside"),
        fingerprints.distinct_shingles(F.col("f")).alias("n"),
    ).collect()
    large, small, empty, one = sorted(got, key=lambda r: -r.n)[0], *[next(r for r in got if r.n == n) for n in (26, 0, 1)]
    assert abs(large.near - 1 / 3) < 0.13 and abs(large.inside - 0.5) < 0.2 and abs(large.n - 7996) < 2400
    assert (small.near, small.inside) == (16 / 26, 1.0)  # exact below k
    assert (empty.near, empty.inside, empty.k) == (1.0, 1.0, 0)
    assert (one.near, one.inside, one.k) == (0.0, 1.0, 1)


def test_text_form_round_trip(table):
    rows = table(f"sketch {ARRAY}", ([-(1 << 63), -1, 0, 5, (1 << 63) - 1],), ([],))
    text = fingerprints.to_text(F.col("sketch"))
    for sketch, back in rows.select("sketch", fingerprints.from_text(text)).collect():
        assert sketch == back


def test_parts_merge_into_the_whole(table):
    rng = random.Random(9)
    parts = [(rng.choice(["hot", "hot", "cold", None]), [rng.randrange(-1000, 1000) for _ in range(rng.randint(0, 6))]) for _ in range(400)]
    parts += [("empty", []), ("empty", [])]
    rows = table(f"part STRING, sketch {ARRAY}", *[(p, bottom(set(h), 16)) for p, h in parts])
    got = {r.part: r.sketch for r in fingerprints.merge_parts(rows, "part", k=16).collect()}
    expected = {p: bottom({x for q, h in parts if q == p for x in h}, 16) for p, _ in parts}
    assert got == expected
    a, b = F.col("a"), F.col("b")
    pair = table(f"a {ARRAY}, b {ARRAY}", ([1, 4, 9], [2, 4, 8]))
    assert pair.select(fingerprints.merged(a, b, 4)).first()[0] == [1, 2, 4, 8]


def test_next_row_over_many_ranges(table):
    rng = random.Random(1)
    ids = [rng.randrange(-(1 << 62), 1 << 62) for _ in range(200)]
    rows = [(i, f"text {i}", "x") for i in ids] + [(None, "no id", "y"), (None, "no id either", "y")]
    docs = table("doc_id BIGINT, text STRING, kind STRING", *rows)
    for range_bytes in (100, 1000, 1 << 20):
        got = neighbours.with_next(docs, "doc_id", "text", {"n": F.length("text")}, ["text", "n"], range_bytes).collect()
        order = [r for r in got if r.doc_id is not None]
        assert len(got) == len(rows)
        texts = [t for _, t, _ in sorted((r for r in rows if r[0] is not None))]
        unnamed = [r for r in got if r.doc_id is None]
        first = next(r.text for r in unnamed if r.next_text in {u.text for u in unnamed})
        expected = dict(zip(texts, [*texts[1:], first]))
        assert {r.text: r.next_text for r in order} == expected
        assert all(r.next_n == len(r.next_text) for r in got)
    assert neighbours.with_next(docs.limit(0), "doc_id", "text", {}, ["text"]).count() == 0
    alone = neighbours.with_next(docs.filter(F.col("doc_id") == ids[0]), "doc_id", "text", {}, ["text"]).collect()
    assert [r.text for r in alone] == [r.next_text for r in alone]
