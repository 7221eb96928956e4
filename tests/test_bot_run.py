"""Runs that are stopped and go on: what was done is not done again."""

import sys
from collections import Counter

import pytest
from pyspark import cloudpickle

from quipyard.plans import bot_run, resumable
from quipyard.sources.tables import read_comment_log

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Stopped(Exception):
    pass


def counting(folder, wrong=()):
    """Makes a generator that leaves one file per prompt asked and fails on some."""

    def make():
        import uuid
        from pathlib import Path

        def generator(prompts, temperature, top_p):
            bad = [p for p in prompts if any(w in p for w in wrong)]
            if bad:
                for p in bad:
                    Path(folder, f"bad-{uuid.uuid4().hex}").write_text(p)
                raise RuntimeError(f"no answer to {bad[0]}")
            for p in prompts:
                Path(folder, uuid.uuid4().hex).write_text(p)
            return [f"this is the answer to {p[-4:].strip()}" for p in prompts]

        return generator

    return make


@pytest.fixture
def asked(tmp_path):
    folder = tmp_path / "asked"
    folder.mkdir()
    return str(folder), lambda: Counter(p.read_text() for p in folder.iterdir())


def test_a_stopped_generation_goes_on(spark, table, tmp_path, asked, monkeypatch):
    folder, calls = asked
    requests = table("url STRING, prompt STRING", *[(f"u{i}", f"prompt {i % 18}") for i in range(20)])
    path, append, slices = str(tmp_path / "answers"), resumable.log.append, []

    def stopping(rows, where, *rest):
        append(rows, where, *rest)
        slices.append(where)
        if len(slices) == 4:  # the results and dead letters of two slices
            raise Stopped

    with monkeypatch.context() as patch:
        patch.setattr(resumable.log, "append", stopping)
        with pytest.raises(Stopped):
            resumable.generate_resumable(requests, counting(folder), path, rows_per_slice=4)
    first = calls()
    assert 0 < len(first) < 18
    found = resumable.generate_resumable(requests, counting(folder), path, rows_per_slice=4)
    assert calls() == Counter({f"prompt {i}": 1 for i in range(18)})
    assert sorted((r.url, r.comment) for r in found.answered.collect()) == sorted(
        (f"u{i}", f"this is the answer to {f'prompt {i % 18}'[-4:].strip()}") for i in range(20)
    )
    resumable.generate_resumable(requests, counting(folder), path)
    assert sum(calls().values()) == 18 and found.dead.count() == 0


def test_failures_become_dead_letters(spark, table, tmp_path, asked):
    folder, calls = asked
    requests = table("url STRING, prompt STRING", *[(f"u{i}", f"prompt {i}") for i in range(8)])
    path = str(tmp_path / "answers")
    found = resumable.generate_resumable(requests, counting(folder, ["t 3", "t 5"]), path, attempts=2)
    dead = {r.prompt: (r.attempts, r.error) for r in found.dead.collect()}
    assert dead == {p: (2, f"RuntimeError: no answer to {p}") for p in ("prompt 3", "prompt 5")}
    assert {r.url for r in found.answered.collect()} == {"u0", "u1", "u2", "u4", "u6", "u7"}
    before = calls()
    resumable.generate_resumable(requests, counting(folder, ["t 3"]), path)
    assert calls() == before  # dead letters are left alone
    found = resumable.generate_resumable(requests, counting(folder, ["t 3"]), path, retry_dead=True)
    assert [r.prompt for r in found.dead.collect()] == ["prompt 3"] and found.answered.count() == 7


def test_an_answer_for_every_prompt(spark, table, tmp_path):
    requests = table("url STRING, prompt STRING", ("u", "p"))
    found = resumable.generate_resumable(requests, lambda: lambda *a: [], str(tmp_path / "answers"))
    assert found.answered.count() == 0 and found.dead.count() == 1
    assert resumable.generate_resumable(requests.limit(0), lambda: None, str(tmp_path / "none")).answered.count() == 0


def test_a_stopped_run_resumes_at_the_first_missing_stage(spark, table, tmp_path, asked, monkeypatch):
    folder, calls = asked
    articles = table("url STRING, title STRING, article_text STRING, position INT", *[(f"u{i}", f"T{i}", "text", i) for i in range(6)])
    comments = table("url STRING, username STRING", ("u1", "me"))

    def run(run_id="r1"):
        return bot_run.run_bot(
            articles, comments, "me", counting(folder), str(tmp_path / "runs"), run_id, str(tmp_path / "log"), n=4
        )

    with monkeypatch.context() as patch:
        patch.setattr(bot_run, "with_problems", lambda *_: (_ for _ in ()).throw(Stopped))
        with pytest.raises(Stopped):
            run()
    state = bot_run.Run(spark, str(tmp_path / "runs"), "r1")
    assert set(state.done()) == {"candidates", "requests", "generations"}
    with monkeypatch.context() as patch:
        patch.setattr(bot_run, "select_candidates", lambda *_, **__: (_ for _ in ()).throw(AssertionError("done before")))
        reviewed = run()
    assert {r.url for r in reviewed.collect()} == {"u0", "u2", "u3", "u4"}
    assert sum(calls().values()) == 4 and read_comment_log(spark, str(tmp_path / "log")).count() == 4
    run()
    assert read_comment_log(spark, str(tmp_path / "log")).count() == 4 and len(state.done()) == 5
    run("r2")
    assert read_comment_log(spark, str(tmp_path / "log")).count() == 8
