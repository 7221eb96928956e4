import datetime
import json

import pytest
from pyspark.sql import functions as F

from quipyard.operators import columns
from quipyard.schemas import COMMENT_LOG, COMMENTS, DPO_DATASET, SFT_DATASET
from quipyard.sources import archive, few_shot, tables

CSV = '''Comment ID,url,comment_text,pcu_value,pcd_value,username
1,u,"a, ""quoted""
second line",12,3.0,ann
2,u,NA,,x,None
3,u,"","1 ",-2,bob
4,u,  padded  ,0,0,"n/a later"
'''


def test_read_comments_csv(spark, tmp_path):
    path = tmp_path / "comments.csv"
    path.write_text(CSV)
    df = tables.read_comments_csv(spark, str(path))
    assert df.schema == COMMENTS
    rows = {r.comment_id: tuple(r)[2:] for r in df.collect()}
    assert rows == {
        "1": ('a, "quoted"\nsecond line', 12, 3, "ann"),
        "2": (None, None, None, None),
        "3": (None, 1, -2, "bob"),
        "4": ("  padded  ", 0, 0, "n/a later"),
    }
    kept = tables.read_comments_csv(spark, str(path), na_tokens=())
    assert {r.comment_id: r.comment_text for r in kept.collect()}["2"] == "NA"


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("username,extra,url,comment_id,comment_text,pcu_value\nann,e,u,1,t,5\n")
    row = tables.read_comments_csv(spark, str(path)).first()
    assert (row.comment_id, row.username, row.pcu_value, row.pcd_value) == ("1", "ann", 5, None)


def test_csv_round_trip_keeps_texts(spark, table, tmp_path):
    texts = ["plain", " blanks ", 'quote " and ""', "line\nbreak", "carriage\rreturn", "comma,"]
    texts += ["\\ back\\", "é😀", "'", None]
    df = table("comment_id STRING, url STRING, comment_text STRING", *[(str(i), "u", t) for i, t in enumerate(texts)])
    tables.write_csv(df, str(tmp_path / "out.csv"), rows_per_file=2)
    back = tables.read_comments_csv(spark, str(tmp_path / "out.csv"), na_tokens=("",))
    assert {int(r.comment_id): r.comment_text for r in back.collect()} == dict(enumerate(texts))


def test_details_formats(spark, tmp_path):
    record = {"url": "u", "title": "T", "article_text": "a\nb", "top_comment_text": None, "more": 1}
    (tmp_path / "d.json").write_text(json.dumps([record, {**record, "url": "v"}], indent=1))
    (tmp_path / "d.jsonl").write_text(json.dumps(record) + "\n" + json.dumps({**record, "url": "v"}) + "\n")
    (tmp_path / "d.csv").write_text('url,title,description,article_text,top_comment_text\nu,T,,"a\nb",\nv,T,,"a\nb",\n')
    for name in ("d.json", "d.jsonl", "d.csv"):
        rows = tables.read_details(spark, str(tmp_path / name)).collect()
        assert {(r.url, r.title, r.description, r.article_text, r.top_comment_text) for r in rows} == {
            ("u", "T", None, "a\nb", None),
            ("v", "T", None, "a\nb", None),
        }, name


def test_jsonl_keeps_null_fields(spark, table, tmp_path):
    path = str(tmp_path / "pairs.jsonl")
    df = table("prompt STRING, chosen STRING, chosen_pcu BIGINT", ("p", None, None), partitions=1)
    tables.write_jsonl(df, path)
    lines = [line for part in (tmp_path / "pairs.jsonl").glob("part-*") for line in part.read_text().splitlines()]
    assert [json.loads(line) for line in lines] == [{"prompt": "p", "chosen": None, "chosen_pcu": None}]
    assert tables.read_dataset(spark, path, DPO_DATASET).schema == DPO_DATASET


def test_dataset_by_table_name(spark, table):
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SFT_DATASET)
    rows = table(schema, ("x", "x", "x", 1, 2, *["y"] * 5))
    rows.createOrReplaceTempView("kept_examples")
    assert tables.read_dataset(spark, "kept_examples", SFT_DATASET).count() == 1


def test_url_list(spark, tmp_path):
    (tmp_path / "urls.csv").write_text("anything\nhttps://a\nhttps://b\nhttps://a\n")
    assert sorted(r.url for r in tables.read_urls(spark, str(tmp_path / "urls.csv")).collect()) == [
        "https://a",
        "https://a",
        "https://b",
    ]


def test_comment_log_is_insert_only(spark, table, tmp_path):
    path = str(tmp_path / "log")
    schema = "comment_id STRING, url STRING, comment STRING, datetime TIMESTAMP"
    first = table(schema, ("1", "u", "old", None), ("1", "u", "older?", None), (None, "u", "no id", None))
    tables.append_comment_log(first, path)
    tables.append_comment_log(table(schema, ("1", "u", "new", None), ("2", "v", "second", None)), path)
    tables.append_comment_log(first, path)
    found = sorted((r.comment_id, r.comment) for r in tables.read_comment_log(spark, path).collect())
    assert found == [("1", "old"), ("2", "second")]


def test_archive_pages(spark):
    rows = archive.archive_pages(spark, "https://n.example/list?").collect()
    assert len(rows) == 24 * 12
    assert (rows[0].year, rows[0].month, rows[-1].year, rows[-1].month) == (2023, 12, 2000, 1)
    assert rows[0].url == "https://n.example/list?catid=0&year=2023&month=12"
    assert archive.archive_pages(spark, "https://n.example/100%25?", 2001, 2001, (1, 2)).count() == 24


def test_few_shot_file(spark, tmp_path):
    import base64

    blocks = "".join(f"### Article Summary: \n\nT{i}: text {i}\n\n### Comment:\n\nha {i}\n\n" for i in range(3))
    (tmp_path / "shots.txt").write_bytes(base64.b64encode(blocks.encode()))
    text = few_shot.read_few_shot_text(spark, str(tmp_path / "shots.txt"))
    assert text.first().few_shot == blocks
    found = few_shot.few_shot_examples(text).orderBy("position").collect()
    assert [(r.title_article_text, r.comment) for r in found] == [(f"T{i}: text {i}", f"ha {i}") for i in range(3)]
    from quipyard.operators.batching import few_shot_block

    assert few_shot_block(few_shot.few_shot_examples(text), 2).first().few_shot == "".join(
        f"### Article Summary: \n\nT{i}: text {i}\n\n### Comment:\n\nha {i}\n\n" for i in range(2)
    )


def test_column_operators(table):
    df = table("`Page URL` STRING, `N` INT", ("N/A", 1), ("x N/A", None), ("NA", 3))
    named = columns.normalize_columns(df)
    assert named.columns == ["page_url", "n"]
    cleaned = columns.sentinel_to_null(named)
    assert {r.page_url for r in cleaned.collect()} == {None, "x N/A", "NA"}
    assert [r.page_url for r in columns.drop_any_null(cleaned).collect()] == ["NA"]
    assert columns.drop_null_in(cleaned, ["page_url"]).count() == 2


def test_flatten_and_zip(spark):
    rows = [(1, ["a", "b"], ["x", "y"]), (2, [], []), (3, None, None)]
    df = spark.createDataFrame(rows, "k INT, left ARRAY<STRING>, right ARRAY<STRING>")
    flat = columns.flatten_results(df.drop("right"), "left", "at")
    assert sorted(map(tuple, flat.collect())) == [(1, 0, "a"), (1, 1, "b")]
    pairs = columns.zip_results(df, "left", "right")
    assert sorted(map(tuple, pairs.collect())) == [(1, "a", "x"), (1, "b", "y")]
    unequal = spark.createDataFrame([(1, ["a", "b"], ["x", "y", "z"])], df.schema)
    with pytest.raises(Exception):
        columns.zip_results(unequal, "left", "right").collect()


def test_month_pages(spark):
    from datetime import datetime

    df = spark.createDataFrame([(datetime(2024, 2, 29),)], "t TIMESTAMP_NTZ")
    assert archive.month_pages(df, F.col("t"), "b?").first().url == "b?catid=0&year=2024&month=2"


def test_details_of_either_json(spark, tmp_path):
    lines, array, both = (tmp_path / n for n in ("a.json", "b.jsonl", "c"))
    rows = [{"url": f"u{i}", "title": "T", "description": None, "article_text": "x\ny", "top_comment_text": "t"} for i in range(5)]
    lines.write_text("\n".join(json.dumps(r) for r in rows))
    array.write_text(" \n" + json.dumps(rows, indent=1) + "\n")
    for path in (lines, array):
        found = tables.read_details(spark, str(path)).collect()
        assert sorted(r.url for r in found) == [f"u{i}" for i in range(5)] and found[0].article_text == "x\ny"
    both.write_text(json.dumps(rows) + "\n" + json.dumps(rows[0]))
    broken = tmp_path / "d"
    broken.write_text('{"url": "u1"}\n{"url": "u2", "ti')
    for path, array in ((both, True), (lines, True), (broken, False)):
        with pytest.raises(Exception):
            tables.read_details_json(spark, str(path), array=array).collect()


def test_csv_headers_by_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('comment_id,url,comment_text,pcu_value,pcd_value,username\n1,u,"x,\ny",5,2,ann\n')
    (tmp_path / "b.csv").write_text("pcd_value,PCU Value,comment_id,url,comment_text,more\n2,5,2,u,z,m\n")
    found = sorted(tables.read_comments_csv(spark, str(tmp_path)).collect())
    assert [(r.comment_id, r.comment_text, r.pcu_value, r.pcd_value, r.username) for r in found] == [
        ("1", "x,\ny", 5, 2, "ann"), ("2", "z", 5, 2, None)
    ]


def test_votes_with_a_point(spark, tmp_path):
    path = tmp_path / "d.jsonl"
    path.write_text('{"prompt": "p", "chosen_pcu": 12.0, "rejected_pcu": 3, "chosen_pcd": null, "rejected_pcd": "x"}\n')
    [row] = tables.read_dataset(spark, str(path), DPO_DATASET).collect()
    assert (row.chosen_pcu, row.rejected_pcu, row.chosen_pcd, row.rejected_pcd) == (12, 3, None, None)


def test_log_records_without_an_id(spark, table, tmp_path):
    path = str(tmp_path / "log")
    moment = datetime.datetime(2024, 1, 1)
    kind = "comment_id STRING, url STRING, comment STRING, datetime TIMESTAMP"
    tables.append_comment_log(table(kind, *[(f"c{i}", "u", "x", moment) for i in range(300)]), path)
    records = table(kind, ("c5", "u", "other", moment), ("new", "u", "x", moment), (None, "u", "x", moment), (None, "u", "x", moment))
    for _ in range(2):
        tables.append_comment_log(records, path)
    assert tables.read_comment_log(spark, path).count() == 301
    assert tables.read_comment_log(spark, path).where("comment = 'other'").count() == 0
    assert tables.read_log_without_id(spark, path, COMMENT_LOG).count() == 1
