import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quipyard.functions.text import words
from quipyard.operators import ranks, sampling
from quipyard.operators.packing import pack_sequences


def test_keys_at_ranks_over_many_passes(spark, monkeypatch):
    monkeypatch.setattr(ranks, "FANOUT", 5)
    rng = random.Random(3)
    keys = [rng.choice([rng.randrange(100), rng.randrange(1 << 60), 77]) for _ in range(400)]
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)], "k BIGINT")
    wanted = [1, 2, 100, 200, 399, 400]
    assert ranks.keys_at_ranks(df, F.col("k"), wanted) == [sorted(keys)[r - 1] for r in wanted]
    with pytest.raises(ValueError):
        ranks.keys_at_ranks(df, F.col("k"), [401])


def test_at_most_two_readings(spark, monkeypatch):
    monkeypatch.setattr(ranks, "FANOUT", 64)
    keys = ranks.StoredKeys.of(spark.range(20_000).select((F.xxhash64("id") % 1_000_003).alias("k")), F.col("k"))
    readings = []
    for name in ("_counts_with_gaps", "_bucket_counts", "_fetch"):
        monkeypatch.setattr(ranks, name, lambda *a, f=getattr(ranks, name), n=name: readings.append(n) or f(*a))
    wanted = [1, 7000, 20_000]
    ordered = sorted(r.k for r in keys.table.collect())
    assert keys.at(wanted) == [ordered[r - 1] for r in wanted]
    assert readings == ["_counts_with_gaps", "_fetch"]


def test_wrong_bounds_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(ranks, "FANOUT", 8)
    keys = ranks.StoredKeys.of(spark.range(500).select((F.col("id") * F.col("id")).alias("k")), F.col("k"))
    for quantiles in ([0] * 1025, [499 * 499] * 1025, [i * 7 for i in range(1025)]):
        wrong = ranks.StoredKeys(keys.table, keys.low, keys.high, keys.rows, quantiles)
        assert wrong.at([1, 2, 250, 500]) == [0, 1, 249**2, 499**2]


def test_negative_and_single_keys(spark):
    df = spark.createDataFrame([(-(1 << 61),), (-5,), (0,), (9,)], "k BIGINT")
    assert ranks.keys_at_ranks(df, F.col("k"), [1, 2, 3, 4]) == [-(1 << 61), -5, 0, 9]
    assert ranks.keys_at_ranks(df.where("k = 9"), F.col("k"), [1]) == [9]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(-(10**6), 10**12), max_size=60), st.integers(1, 9))
def test_chunks_are_near_equal_and_contiguous(spark, positions, chunks):
    df = spark.createDataFrame([(p,) for p in positions], "p BIGINT")
    found = {r.p: r.chunk for r in ranks.assign_chunks(df, "p", chunks).collect()}
    expected, rest = {}, sorted(positions)
    for i, size in enumerate(ranks.chunk_sizes(len(positions), chunks)):
        expected.update(dict.fromkeys(rest[:size], i + 1))
        rest = rest[size:]
    assert found == expected


def test_chunk_sizes():
    assert ranks.chunk_sizes(21, 8) == [3, 3, 3, 3, 3, 2, 2, 2]


def test_split_is_disjoint_exhaustive_and_stable(spark):
    df = spark.range(2000).select(F.concat(F.lit("u"), "id").alias("url"))
    train, test = sampling.train_test_split(df)
    a, b = ({r.url for r in part.collect()} for part in (train, test))
    assert not a & b and len(a | b) == 2000 and 150 < len(b) < 250
    again = sampling.train_test_split(df.repartition(7))[1]
    assert {r.url for r in again.collect()} == b
    other = sampling.train_test_split(df, seed=43)[1]
    assert {r.url for r in other.collect()} != b


@pytest.mark.parametrize("rows", [1, 9, 10, 11, 505])
def test_exact_split_size(spark, rows):
    df = spark.range(rows).select(F.concat(F.lit("u"), "id").alias("url"))
    train, test = sampling.train_test_split(df, exact=True)
    assert (train.count(), test.count()) == (rows - math.ceil(rows / 10), math.ceil(rows / 10))


def test_empty_split(spark):
    train, test = sampling.train_test_split(spark.createDataFrame([], "url STRING"), exact=True)
    assert train.count() == test.count() == 0


def test_sample_one(spark):
    df = spark.range(50)
    assert sampling.sample_one(df, F.col("id")).first() == sampling.sample_one(df.repartition(5), F.col("id")).first()
    assert len({sampling.sample_one(df, F.col("id"), seed).first().id for seed in range(8)}) > 1


def expected_blocks(spark, rows, length):
    from quipyard.functions.hashing import hash32

    df = spark.createDataFrame(rows, "k STRING, t STRING").where("t IS NOT NULL")
    ordered = df.select(hash32(F.col("k"), 42).alias("h"), "k", words(F.col("t")).alias("w")).collect()
    stream = [w for row in sorted(ordered, key=lambda r: (r.h, r.k)) for w in [*row.w, "</s>"]]
    return {i: stream[i * length : (i + 1) * length] for i in range(len(stream) // length)}


@pytest.mark.parametrize("length,buckets", [(1, 3), (7, 1), (7, 4), (7, 200), (64, 16), (10_000, 4)])
def test_packing_matches_one_stream(spark, length, buckets):
    rng = random.Random(length)
    rows = [(f"k{i}", " ".join(f"w{i}.{j}" for j in range(rng.choice([0, 1, 3, 9, 150])))) for i in range(60)]
    rows.append(("none", None))
    df = spark.createDataFrame(rows, "k STRING, t STRING").repartition(5)
    found = pack_sequences(df, "k", "t", length, buckets=buckets).collect()
    assert len({r.block_id for r in found}) == len(found)
    assert {r.block_id: r.tokens for r in found} == expected_blocks(spark, rows, length)


def test_packing_moves_texts_once(spark):
    df = spark.createDataFrame([(f"k{i}", "a b c " * i) for i in range(30)], "k STRING, t STRING")
    packed = pack_sequences(df, "k", "t", 16, buckets=4)
    packed.collect()
    plan = packed._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # The blocks are built once and stored: no window and no split of a text is left for either branch.
    assert "Window" not in plan and "split(" not in plan and "Scan parquet" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_many_chunks(spark):
    rows = spark.range(12_000).select((F.col("id") * 3).alias("position"))
    found = ranks.assign_chunks(rows, "position", 10_000).orderBy("position").collect()
    want = [i + 1 for i, n in enumerate(ranks.chunk_sizes(12_000, 10_000)) for _ in range(n)]
    assert [r.chunk for r in found] == want


def test_packing_spreads_texts_without_key(spark):
    rows = [(None, f"t{i} a b") for i in range(60)] + [(f"k{i}", "c d") for i in range(10)]
    df = spark.createDataFrame(rows, "k STRING, t STRING")
    packed = [sorted(map(str, pack_sequences(df, "k", "t", 10, buckets=n).collect())) for n in (1, 7)]
    assert packed[0] == packed[1] and len(packed[0]) == (60 * 4 + 10 * 3) // 10
