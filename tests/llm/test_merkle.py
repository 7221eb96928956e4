"""Merkle manifests against trees built by hand."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quipyard.llm import merkle
from quipyard.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id BIGINT, source STRING, lang STRING, n_chars BIGINT, text STRING"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, more=0):
    doc_id, source, lang, n_chars, text = row
    values = (doc_id, source, lang, None if n_chars is None else n_chars + more, text)
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels_of(nodes):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [H(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        levels.append(nodes)
    return levels


def siblings(levels, i):
    for level in levels[:-1]:
        yield (i & 1, level[i ^ 1]) if i ^ 1 < len(level) else None
        i >>= 1


def manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of every row, sorted."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[g] = levels_of([leaf_of(r) for r in groups[g]])
    top = levels_of([trees[g][-1][0] for g in names])
    root, found = top[-1][0] if names else None, []
    for at, g in enumerate(names):
        for i, row in enumerate(groups[g]):
            path = [*siblings(trees[g], i), *siblings(top, at)]
            node = leaf_of(row, row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0)
            for step in path:
                node = H(node) if step is None else H(step[1], node) if step[0] else H(node, step[1])
            proof = H(*[step[1] for step in path if step])
            found.append((row[0], leaf_of(row), trees[g][-1][0], root, proof, node, node == root))
    return sorted(found, key=str)


def checked(spark, tmp_path, docs):
    folder = tmp_path / "tables"
    docs.write.parquet(f"{folder}/documents.parquet")
    return sorted(map(tuple, QUERIES["op13_merkle"](spark, str(folder)).collect()), key=str)


def test_query_against_trees_by_hand(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    got = sorted(map(tuple, QUERIES["op13_merkle"](spark, FOLDER).collect()), key=str)
    assert got == manifest([tuple(r) for r in docs.collect()])
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


@pytest.mark.parametrize("levels", [1, 2, 10])
def test_special_rows(spark, table, tmp_path, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rng = random.Random(levels)
    rows = [(rng.randrange(-(1 << 63), 1 << 63), "s", rng.choice(["en", "é", "z", "", None]), i, f"t{i}") for i in range(60)]
    rows += [(i * 3, None, "en", None, None) for i in range(70)]
    rows += [(7, "s", "en", 1, "same")] * 5 + [(7, "s", "en", 1, f"other {i}") for i in range(5)]
    rows += [(None, None, None, None, None)] * 3 + [(None, "s", "z", 2, "x" * 5000), (65536, "s", "lone", 2, "")]
    docs = table(SCHEMA, *rows).withColumn("row", F.lit("clash")).withColumn("grp", F.lit(1))
    assert checked(spark, tmp_path, docs) == manifest(rows)


def test_empty_table(spark, table, tmp_path):
    assert checked(spark, tmp_path, table(SCHEMA)) == []


def test_tampered_rows_fail_unless_they_have_no_count(spark, table, tmp_path):
    hit = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 0][:2]
    rows = [(hit[0], "s", "en", 1, "a"), (hit[1], "s", "en", None, "a")]
    assert {r[0]: r[-1] for r in checked(spark, tmp_path, table(SCHEMA, *rows))} == {hit[0]: False, hit[1]: True}


def test_bitmap_ranks():
    rng = np.random.default_rng(2)
    for size in (1, 50, 5000, merkle.CHUNK):
        low = np.sort(rng.choice(merkle.CHUNK, size, replace=False))
        count = np.where(rng.random(size) < 0.1, rng.integers(2, 9, size), 1)
        bitmap = merkle.Bitmap(merkle.pack_ids(low, count))
        assert (bitmap.rank(low) == np.cumsum(count) - count).all()
        back = bitmap.places()
        assert (back[0] == low).all() and (back[1] == count).all()


def test_bitmaps_of_dense_ids_are_small():
    full = merkle.pack_ids(np.arange(merkle.CHUNK), np.ones(merkle.CHUNK, dtype=np.int64))
    few = merkle.pack_ids(np.array([5, 9000]), np.array([1, 1]))
    assert len(full) < 1000 and len(few) < 1000


def test_fold_follows_reduce():
    for n in (1, 2, 3, 7, 1025):
        nodes = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
        root, paths = merkle.reduce_block(nodes, merkle.height(n))
        for at in {0, n // 2, n - 1}:
            assert merkle.fold(nodes[at], at, n, paths[at] + b"rest") == (root, b"rest")


def test_bitmap_ranks_behind_the_chunk():
    low, count = np.array([5, merkle.CHUNK - 1, merkle.CHUNK, 9000, 65535]), np.array([1, 3, 1, 2, 1])
    bitmap = merkle.Bitmap(merkle.pack_ids(low, count))
    assert bitmap.rank(low).tolist() == [0, 1, 4, 5, 7]
    assert [x.tolist() for x in bitmap.places()] == [low.tolist(), count.tolist()]
