import random
from collections import Counter

import brute
import numpy as np
import pytest

from quipyard.llm import decontamination, passages, sharding
from pyspark.sql import functions as F

PICK = random.Random(5)
VOCABULARY = ["".join(PICK.choices("abcdefgh", k=5)) for _ in range(4000)]


def prose(n):
    return PICK.choices(VOCABULARY, k=n)


def test_tiling_equals_its_definition():
    pick = random.Random(2)
    for _ in range(150):
        item = pick.choices("abc", k=pick.randint(1, 14))
        doc = pick.choices("abc", k=pick.randint(0, 25))
        block = decontamination.Block([(1, " ".join(item))], seed=3)
        found = list(block.matches(" ".join(doc).encode()))
        want = brute.tiling(doc, item, 3) if len(item) >= 3 else 0
        if len(item) < 3:
            want = len(item) if any(doc[d : d + len(item)] == item for d in range(len(doc))) else 0
        assert round(sum(share for _, share, _ in found) * len(item)) == want
        for _, _, tiles in found:
            assert all(doc[d : d + n] == item[i : i + n] for d, i, n in tiles)


def test_repetitive_texts_have_the_same_tiles(monkeypatch):
    pick = random.Random(8)
    for _ in range(200):
        seed, letters = pick.choice([2, 3, 5]), pick.choice(["a", "ab", "aab", "abcde"])
        items = [(i, " ".join(pick.choices(letters, k=pick.randint(1, 30)))) for i in range(3)]
        doc = " ".join(pick.choices(letters, k=pick.randint(0, 70))).encode()
        found = []
        for most in (1 << 16, 0):
            monkeypatch.setattr(decontamination, "MOST_PAIRS", most)
            found.append(list(decontamination.Block(items, seed).matches(doc)))
        assert found[0] == found[1]


def test_a_million_equal_words():
    block = decontamination.Block([(1, "a " * 10_000)])
    [(_, share, tiles)] = block.matches(b"a " * 1_000_000)
    assert share == 1 and tiles == [(0, 0, 10_000)]


def contaminated(table):
    a, b = prose(40), prose(30)
    turned = [*b[20:], *prose(9), *b[:10], *prose(7), *b[10:20]]
    edited = list(a)
    edited[20] = "other"
    texts = {
        0: None,
        1: "",
        2: " ".join(prose(300)),
        3: " ".join([*prose(50), *a, *prose(50)]).upper(),
        4: ", ".join(turned) + ".",
        5: " ".join(a[:15]),
        6: " ".join(edited),
        7: " ".join([*a, *b]) + " w" * 30_000,
        8: "tiny item here",
    }
    docs = table("doc_id BIGINT, text STRING, item_id STRING, tiles INT", *[(i, t, "clash", 1) for i, t in texts.items()], (3, texts[3], "again", 2))
    items = table("item_id BIGINT, text STRING", (10, " ".join(a)), (11, "; ".join(b)), (12, None), (13, "tiny item"), (14, ""))
    return docs, items


@pytest.mark.parametrize("block_tokens", [1, 1_000_000])
def test_passages_of_a_benchmark(table, block_tokens):
    docs, items = contaminated(table)
    found = decontamination.find_passages(docs, items, block_tokens=block_tokens).collect()
    pairs = sorted((r.doc_id, r.item_id) for r in found)
    assert pairs == [(3, 10), (3, 10), (4, 11), (6, 10), (7, 10), (7, 11), (8, 13)]
    kept = decontamination.drop_contaminated(docs, items, block_tokens=block_tokens)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 5]


def test_empty_benchmark_and_documents(table):
    docs, items = contaminated(table)
    assert decontamination.find_passages(docs, items.filter("false")).count() == 0
    assert decontamination.drop_contaminated(docs, items.filter("false")).count() == docs.count()
    assert decontamination.find_passages(docs.filter("false"), items).count() == 0


def test_repeated_passages(table):
    shared, other = prose(60), prose(80)
    fuzzy = list(other)
    for i in (20, 45, 46):
        fuzzy[i] = "edited"
    del fuzzy[60]
    short = prose(30)
    long = prose(3000)
    texts = [
        (1, [*prose(100), *shared, *prose(20)]),
        (2, [*shared, *prose(70)]),
        (3, [*prose(5), *other, *short]),
        (4, [*fuzzy, *prose(90)]),
        (5, [*prose(40), *short, *prose(40)]),
        (6, long),
        (7, long),
        (8, [*prose(10), *shared]),
        (9, [*short, *prose(9), *short]),
    ]
    rows = [(i, " ".join(w), "x") for i, w in texts] + [(10, None, "x"), (11, "", "x"), (None, " ".join(shared), "x"), (2, " ".join(texts[1][1]), "x")]
    docs = table("doc_id BIGINT, text STRING, start STRING", *rows)
    found = passages.repeated_passages(docs).collect()
    pairs = {(r.doc_id, r.source_id) for r in found}
    # the row without an id comes first of all, so it owns the shared passage
    assert pairs == {(1, None), (2, None), (8, None), (4, 3), (7, 6)}
    words = {i: w for i, w in texts}
    for r in found:
        mine = words[r.doc_id][r.start : r.end]
        theirs = (words[r.source_id] if r.source_id else shared)[r.source_start : r.source_end]
        assert r.words == len(mine) >= 50 and r.similarity >= 0.8
        if r.similarity == 1:
            assert mine == theirs
    [near] = [r for r in found if r.doc_id == 4]
    assert near.words >= 75 and near.similarity < 1
    [whole] = [r for r in found if r.doc_id == 7]
    assert (whole.start, whole.end) == (0, 3000)
    assert passages.repeated_passages(docs.filter("false")).count() == 0


def test_passages_of_repeated_phrases(table):
    a, b, c = prose(3)
    line = prose(11)
    texts = [
        [*prose(20), *[a] * 30, *prose(9)],
        [*[a] * 12, *prose(15), *[a] * 55],
        [*prose(4), *[a] * 300],
        [*prose(7), *[a] * 50],
        [*[a] * 49],
        [*prose(3), *[b, c] * 40],
        [*[c, b] * 60, *prose(30)],
        [*prose(30), *line * 9],
        [*line[4:], *line * 12, *prose(5)],
        [*line * 4],
        [*[c] * 200],
        [*[b, b, c] * 30],
    ]
    docs = table("doc_id BIGINT, text STRING", *[(i, " ".join(w)) for i, w in enumerate(texts)])
    found = passages.repeated_passages(docs).collect()
    runs = [{tuple(w[i : i + 50]) for i in range(len(w) - 49)} for w in texts]
    repeated = {i for i, r in enumerate(runs) if any(r & other for j, other in enumerate(runs) if j != i)}
    assert repeated == {1, 2, 3, 5, 6, 7, 8}
    assert {r.doc_id for r in found} | {r.source_id for r in found} == repeated
    for r in found:
        assert texts[r.doc_id][r.start : r.end] == texts[r.source_id][r.source_start : r.source_end]


def test_longest_common_subsequence():
    pick = random.Random(4)
    for _ in range(200):
        a, b = ([pick.randint(0, 3) for _ in range(pick.randint(0, 12))] for _ in "ab")
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        found = passages.common(np.array(a), np.array(b))
        same = sum(x == y for x, y in zip(a, b))
        assert found == table[-1][-1] or (len(a) == len(b) and found == same and 2 * same >= len(a))


def test_every_run_of_a_window_has_a_seed_in_common():
    words = np.array([PICK.getrandbits(64) for _ in range(400)], np.uint64)
    length = passages.K + passages.WINDOW - 1
    for start in range(0, 380, 17):
        run = words[start : start + length]
        _, every = passages.minimizers(words)
        _, own = passages.minimizers(run)
        assert set(own.tolist()) & set(every.tolist())


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 64, 1000])
def test_feistel_is_a_permutation_and_turns_back(spark, n):
    rows = spark.range(n).select(
        "id", *[c.alias(a) for c, a in zip(sharding.place(F.col("id"), n, 7), ("shard", "slot"))]
    )
    found = rows.select("*", sharding.row_number_at(F.col("shard"), F.col("slot"), n, 7).alias("back")).collect()
    assert all(r.back == r.id for r in found)
    assert sorted(r.slot * 7 + r.shard for r in found) == list(range(n))
    if n == 1000:
        assert [r.slot * 7 + r.shard for r in found] != list(range(n))


def test_shards(table):
    rows = [(i, "é" * (i % 9), "x") for i in range(97)] + [(None, None, "x"), (None, None, "x"), (5, "é" * 5, "x")]
    docs = table("doc_id BIGINT, text STRING, shard STRING", *rows)
    found = sharding.shuffle_into_shards(docs, 40).collect()
    sizes = Counter(r.shard for r in found)
    assert len(found) == 100 and max(sizes.values()) - min(sizes.values()) == 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(n))
    assert {(r.doc_id, r.size) for r in found} == {(i, 16 + 2 * len(t or "")) for i, t, _ in rows}
    again = sharding.shuffle_into_shards(docs.repartition(7), 40).collect()
    key = lambda r: (str(r.doc_id), r.size, r.shard, r.slot)
    assert sorted(map(key, again)) == sorted(map(key, found))
    assert sharding.shuffle_into_shards(docs.filter("false")).count() == 0
