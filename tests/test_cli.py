import base64
import json

import pytest

from quipyard.__main__ import main
from quipyard.sources.tables import read_comment_log, read_log
from quipyard.streaming.review_log import REJECTED_LOG

PAGE = """<title>T{n}</title><meta name="description" content="d"><div class="blog-section-inside"><p>Text {n}</div>
<div id="comment_wrap"><div class="ppcont"><div class="comtext">top {n}</div></div>
<div class="cmcont" id="{n}1"><div class="comtext">top {n}</div><div class="pcp"><span class="pcu">20</span>
<span class="pcd">1</span></div><a href="/u/ann">ann</a></div>
<div class="cmcont" id="{n}2"><div class="comtext">bad {n}</div><div class="pcp"><span class="pcu">1</span>
<span class="pcd">60</span></div><a href="/u/bob">bob</a></div></div>"""


def read(folder):
    return [json.loads(line) for part in folder.rglob("part-*") for line in part.read_text().splitlines()]


def test_pages_to_prepared_sets(spark, table, tmp_path, capsys):
    """The whole way from captured pages, each step from the files of the one before."""
    at = lambda name: str(tmp_path / name)
    rows = [(f"https://n.example/news/{n}.html", 200, PAGE.format(n=n)) for n in range(12)]
    rows.append(("https://n.example/news/video-1.html", 200, PAGE.format(n="v")))
    rows.append(("https://n.example/news/gone.html", 404, ""))
    table("url STRING, status_code INT, html STRING", *rows).write.parquet(at("pages"))
    links = "".join(f'<a href="{url}">x</a>' for url, *_ in rows)
    archive = [("https://n.example/list", 200, f'<div class="news-style1">{links}<a href="/other">o</a></div>')]
    table("url STRING, status_code INT, html STRING", *archive).write.parquet(at("archive"))

    main(["list_urls", "--pages_path", at("archive"), "--output_path", at("urls.csv"), "--pattern", "^https://.*"])
    assert spark.read.csv(at("urls.csv"), header=True).count() == 14

    main(["ingest_pages", "--pages_path", at("pages"), "--output_path", at("in")])
    inputs = ["--df_comments_path", at("in/article_comments.csv")]
    inputs += ["--df_article_details_path", at("in/article_details.csv")]

    main(["build_sft_dataset", *inputs, "--output_path", at("sft.jsonl")])
    sft = read(tmp_path / "sft.jsonl")
    assert {r["comment_id"] for r in sft} == {f"{n}1" for n in range(12)}

    main(["build_dpo_dataset", *inputs, "--output_path", at("dpo.jsonl")])
    dpo = read(tmp_path / "dpo.jsonl")
    assert len(dpo) == 12
    one = next(r for r in dpo if r["url"].endswith("/3.html"))
    assert (one["chosen"], one["rejected"], one["chosen_pcu"], one["rejected_pcd"]) == ("top 3", "bad 3", 20, 60)

    capsys.readouterr()
    main(["prepare_sft", "--dataset_name", at("sft.jsonl"), "--output_path", at("sft-ready.jsonl"),
          "--seq_length", "16"])
    assert json.loads(capsys.readouterr().out) == {"rows_before": 12, "rows_after": 12}
    ready = read(tmp_path / "sft-ready.jsonl")
    assert all(r["text"].endswith(f"### Response:\n{r['top_comment_text']}\n") for r in ready)
    blocks = spark.read.parquet(at("sft-ready.jsonl.packed")).collect()
    assert len(blocks) == sum(len(r["text"].split()) + 1 for r in ready) // 16
    assert all(len(b.tokens) == 16 for b in blocks)

    main(["prepare_dpo", "--dataset_name", at("dpo.jsonl"), "--output_path", at("dpo-ready"), "--exact"])
    assert json.loads(capsys.readouterr().out) == {"rows_before": 12, "rows_after": 12}
    assert (len(read(tmp_path / "dpo-ready/split=train")), len(read(tmp_path / "dpo-ready/split=test"))) == (10, 2)

    main(["select_candidates", "--archive_pages_path", at("archive"), *inputs, "--output_path", at("next"),
          "--username", "nobody", "--num_comments_desired", "2"])
    assert sorted(r["title_article_text"] for r in read(tmp_path / "next")) == ["T0 Text 0", "T1 Text 1"]

    capsys.readouterr()
    for _ in range(2):
        main(["bot", "--archive_pages_path", at("archive"), *inputs, "--output_path", at("runs"), "--username", "nobody",
              "--run_id", "r1", "--log_path", at("log"), "--generator", "quipyard.plans.generation:dry_run"])
        printed = json.loads(capsys.readouterr().out)
        assert sum(printed.values()) == 3
    assert read_comment_log(spark, at("log")).count() == printed["accepted"]

    shots = "".join(f"### Article Summary: \n\nE{i}: text\n\n### Comment:\n\nha {i}\n\n" for i in range(3))
    (tmp_path / "shots.txt").write_bytes(base64.b64encode(shots.encode()))
    files = [*inputs[2:], "--few_shot_path", at("shots.txt"), "--num_shots", "2"]
    main(["chat_requests", *files, "--output_path", at("chat")])
    requests = read(tmp_path / "chat")
    assert len(requests) == 13 and all("ha 1" in r["prompt"] and "ha 2" not in r["prompt"] for r in requests)
    both = ["--first_generator", "quipyard.plans.generation:dry_run", "--second_generator", "quipyard.plans.generation:dry_run"]
    main(["compare_generations", *files, *both, "--output_path", at("both")])
    assert all(r["first_comment"] and r["second_comment"] for r in read(tmp_path / "both"))


def test_review_commands(spark, table, tmp_path):
    at = lambda name: str(tmp_path / name)
    rows = [("1", "u", "a good comment of six words", None), ("2", "u", "bad", None)]
    table("comment_id STRING, url STRING, comment STRING, datetime TIMESTAMP", *rows).write.json(at("generated"))
    for _ in range(2):
        main(["review", "--generated_path", at("generated"), "--log_path", at("log")])
    assert [r.comment_id for r in read_comment_log(spark, at("log")).collect()] == ["1"]
    main(["review_stream", "--generated_path", at("generated"), "--log_path", at("log"),
          "--rejected_path", at("rejected"), "--checkpoint", at("checkpoint"), "--available_now"])
    assert [r.comment_id for r in read_comment_log(spark, at("log")).collect()] == ["1"]
    assert [r.reasons for r in read_log(spark, at("rejected"), REJECTED_LOG).collect()] == [["too short"]]


def test_unknown_command():
    with pytest.raises(SystemExit):
        main(["train"])
