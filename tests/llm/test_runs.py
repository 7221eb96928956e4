"""Periodic runs against trying every period."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quipyard.llm import periodic_runs
from quipyard.llm.queries import QUERIES, with_planted_period

FOLDER = "/root/testdata/sf0.001"


def runs_of(words, least=12):
    """(start, period, length), every period tried at every place."""
    best = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(least, 2 * p):
                best.setdefault((i, j - i + p), p)
            i = j
    return sorted((start, p, length) for (start, length), p in best.items())


def kept(words, runs):
    dropped = {i for start, p, length in runs for i in range(start + p, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def edited_words(doc_id, text):
    words = words_of(text)
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


@pytest.mark.parametrize("least", [2, 7, 12])
def test_random_texts(least):
    rng = random.Random(least)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(0, 5)):
            letters, n = rng.choice([1, 2, 3, 5]), rng.randint(0, 120)
            words = [rng.randrange(letters) for _ in range(n)]
            if n and rng.random() < 0.5:
                a = rng.randrange(n)
                p = 1 + rng.randrange(max(1, (n - a) // 2))
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            texts.append(words)
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        codes = np.array([w for t in texts for w in t], dtype=np.int32)
        found = [[] for _ in texts]
        for owner, start, length, period in zip(*(x.tolist() for x in periodic_runs.find_runs(codes, sizes, least))):
            found[owner].append((start, period, length))
        assert found == [runs_of(t, least) for t in texts]


def test_positions_keep_order_over_many_blocks():
    rng = random.Random(5)
    numbers = rng.sample(range(100_000), 5000)
    found, seen = periodic_runs.Positions(numbers[0]), [numbers[0]]
    for x in numbers[1:]:
        before, after = found.add(x)
        if len(seen) < 400 or x % 50 == 0:
            assert before == max((y for y in seen if y < x), default=None)
            assert after == min((y for y in seen if y > x), default=None)
        seen.append(x)
    assert list(found) == sorted(numbers) and len(found.blocks) > 1


def test_a_very_long_repeated_word():
    n = 200_000
    found = periodic_runs.find_runs(np.zeros(n, dtype=np.int32), np.array([n]))
    assert [x.tolist() for x in found] == [[0], [0], [n], [1]]


def test_special_rows(table):
    loop = "\tx y\nx y x y x y x y x y x  y x y "
    rows = [
        (1, None, "a"),
        (2, "", "a"),
        (3, " \t\n", "a"),
        (4, loop, "a"),
        (4, loop, "a"),
        (None, "one two", "b"),
        (6, "é " * 12, None),
        (7, "w " * 11, None),
    ]
    docs = table("doc_id BIGINT, text STRING, runs STRING", *rows)
    found = periodic_runs.collapse_runs(docs, carry=["doc_id", "runs"]).toDF("doc_id", "mine", "n", "found", "collapsed")
    got = sorted(((r.doc_id, r.n, [tuple(x) for x in r.found], r.collapsed) for r in found.collect()), key=str)
    expected = [
        (1, 0, [], ""),
        (2, 0, [], ""),
        (3, 0, [], ""),
        (4, 16, [(0, 16, 2)], "x y"),
        (4, 16, [(0, 16, 2)], "x y"),
        (None, 2, [], "one two"),
        (6, 12, [(0, 12, 1)], "é"),
        (7, 11, [], " ".join("w" * 11)),
    ]
    assert got == sorted(expected, key=str)
    assert periodic_runs.collapse_runs(docs.limit(0)).count() == 0


def test_query_against_every_period(spark):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_periodic_runs"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc_id, text in docs:
        words = edited_words(doc_id, text)
        if len(words) > 3000:
            continue
        runs = runs_of(words)
        longest = min(((-length, start, p) for start, p, length in runs), default=None)
        best = (None,) * 4
        if longest:
            best = (longest[1], -longest[0], longest[2], 1000 * -longest[0] // longest[2])
        listed = "".join(f"{start},{length},{p}\n" for start, p, length in runs)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept(words, runs))]
        assert got[doc_id] == (len(runs), *best, *digests), doc_id


def test_planted_periods(table):
    docs = table("doc_id BIGINT, text STRING", *[(i, f" a{i}  b c\td e f g h i j ") for i in range(300)], (None, "x  y"), (10, None))
    for r in docs.select("doc_id", "text", with_planted_period(F.col("doc_id"), F.col("text")).alias("edited")).collect():
        if r.doc_id is None or r.text is None:
            assert r.edited == r.text
        else:
            assert words_of(r.edited) == edited_words(r.doc_id, r.text)
