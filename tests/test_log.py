"""Commits of the log: concurrent and killed writers, merging, repeated batches."""

import datetime
import os
import random
import threading
from pathlib import Path

import pytest

from quipyard.schemas import COMMENT_LOG
from quipyard.sources import log
from quipyard.streaming.review_log import without_repeats

KIND = "comment_id STRING, url STRING, comment STRING, datetime TIMESTAMP"
MOMENT = datetime.datetime(2024, 1, 1)


def rows_of(table, ids, comment="x"):
    return table(KIND, *[(i, "u", comment, MOMENT) for i in ids], partitions=1)


def append(rows, path, **batch):
    log.append(rows, path, COMMENT_LOG, "comment_id", **batch)


def held(spark, path):
    return {r.comment_id: r.comment for r in log.read(spark, path, COMMENT_LOG, "comment_id").collect()}


def test_first_row_of_a_key_counts_through_merges(spark, table, tmp_path, monkeypatch):
    monkeypatch.setattr(log, "FAN", 3)
    path, rng, expected = str(tmp_path / "log"), random.Random(1), {}
    for n in range(20):
        ids = [f"c{rng.randrange(12)}" for _ in range(3)]
        append(rows_of(table, ids, f"batch {n:02d}"), path)
        for i in ids:
            expected.setdefault(i, f"batch {n:02d}")
        if n % 5 == 4:
            assert held(spark, path) == expected
    folders = log.state_of(spark, path).folders
    assert len(folders) <= 3 * 3 and max(level for _, level in folders) == 2


def test_old_files_go(spark, table, tmp_path, monkeypatch):
    monkeypatch.setattr(log, "FAN", 2)
    monkeypatch.setattr(log, "KEEP", 4)
    path = tmp_path / "log"
    for n in range(12):
        append(rows_of(table, [f"c{n}"]), str(path))
    assert len(held(spark, str(path))) == 12
    state = log.state_of(spark, str(path))
    commits = [p for p in (path / "commits").iterdir() if not p.name.startswith(".")]
    assert len(commits) <= 4
    assert len(list((path / "data").iterdir())) == len(state.folders) + len(state.dropped)
    assert not list((path / "drafts").iterdir())


def test_concurrent_writers_lose_nothing(spark, table, tmp_path):
    path, errors = str(tmp_path / "log"), []
    batches = [[f"w{w}-{n}" for n in range(4)] + ["shared"] for w in range(6)]
    frames = [rows_of(table, ids, f"writer {w}") for w, ids in enumerate(batches)]

    def write(frame):
        try:
            append(frame, path)
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=write, args=(f,)) for f in frames]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    found = held(spark, path)
    assert not errors and set(found) == {i for ids in batches for i in ids}
    assert log.state_of(spark, path).version == 6


def test_a_taken_number_is_not_taken_again(spark, tmp_path):
    files = log._Files(spark, str(tmp_path))
    assert files.publish("commits/1.json", "a") and not files.publish("commits/1.json", "b")
    assert files.read("commits/1.json") == "a"


def test_a_killed_writer_leaves_nothing_visible(spark, table, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    append(rows_of(table, ["a"]), path)
    with monkeypatch.context() as patch:
        patch.setattr(log, "_commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            append(rows_of(table, ["b"]), path)
    assert set(held(spark, path)) == {"a"} and len(list(Path(path, "data").iterdir())) == 2
    append(rows_of(table, ["b"]), path)
    assert set(held(spark, path)) == {"a", "b"}


def test_a_batch_is_logged_once(spark, table, tmp_path):
    path = str(tmp_path / "log")
    for number, ids in ((0, ["a"]), (0, ["again"]), (1, ["b"]), (0, ["late"])):
        append(rows_of(table, ids), path, source="stream", batch=number)
    append(rows_of(table, ["c"]), path, source="other", batch=0)
    assert set(held(spark, path)) == {"a", "b", "c"}
    assert log.state_of(spark, path).batches == {"stream": 1, "other": 0}


def test_no_log_yet(spark, tmp_path):
    assert held(spark, str(tmp_path / "nothing")) == {}


def test_repeats_end_in_the_state_store(spark, tmp_path):
    """Four files one by one: what reaches a batch is new, however old its date."""
    source, seen = tmp_path / "in", []
    good, bad = "a decent comment of five words", "bad"
    files = [
        [("a", good, "2024-05-01"), ("a", good, "2024-05-02"), (None, good, "2024-05-01")],
        [("a", "another decent comment of five words", "2024-06-01"), ("a", bad, "2024-06-01"), ("b", good, "1990-01-01")],
        [(None, good, "2024-05-01"), (None, good, "2024-05-03"), ("b", good, "2024-05-01")],
        [("c", good, None), ("a", bad, "2024-06-01")],
    ]
    source.mkdir()
    for i, rows in enumerate(files):
        lines = [
            "{" + ", ".join(f'"{k}": "{v}"' for k, v in zip(("comment_id", "comment", "datetime"), r) if v) + ', "url": "u"}' for r in rows
        ]
        (source / f"{i}.json").write_text("\n".join(lines))
        os.utime(source / f"{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    stream = spark.readStream.schema(KIND).option("maxFilesPerTrigger", 1).json(str(source))
    (
        without_repeats(stream)
        .writeStream.foreachBatch(lambda batch, n: seen.append((n, sorted(str(r.comment_id) for r in batch.select("comment_id").collect()))))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    batches = dict(seen)
    assert [batches.get(n, []) for n in range(4)] == [["None", "a"], ["a", "b"], ["None"], ["c"]]


def test_stored_rows_move_only_where_a_key_is_repeated(spark, table, tmp_path, monkeypatch):
    alone = rows_of(table, ["a", "b", "c"])
    assert "Exchange" in log._least(alone, COMMENT_LOG, "comment_id")._jdf.queryExecution().executedPlan().toString()
    path, rows = str(tmp_path / "one"), spark.createDataFrame([("a", "u", "x", MOMENT)], KIND).coalesce(1)
    rows.write.parquet(path)
    stored = spark.read.parquet(path)
    assert "Exchange" not in log._once(stored, COMMENT_LOG, "comment_id")._jdf.queryExecution().executedPlan().toString()
    some = rows_of(table, ["a", "b", "a", "c", "a"]).union(rows_of(table, ["a", "d", "d"], "w"))
    for most in (log.REPEATED, 1):
        monkeypatch.setattr(log, "REPEATED", most)
        least = log._least(some, COMMENT_LOG, "comment_id").collect()
        assert sorted(log._once(some, COMMENT_LOG, "comment_id").collect()) == sorted(least)
