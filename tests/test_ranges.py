"""One file read in many byte ranges, against readers of whole files."""

import csv
import io
import json
import random

import pyarrow as pa
import pytest

from quipyard.schemas import DETAILS, RAW_COMMENTS
from quipyard.sources import ranges, tables

NAMES = RAW_COMMENTS.names
CELLS = ["", "plain", 'a "quoted" word', "two\nlines", 'ends with "', '"', '""', ",", 'x",\n"y', "\n", "é😀", " blanks ", "\r\n", 'a\n"b"\nc,d']


@pytest.fixture
def small_ranges(spark):
    """Ranges of a hundred bytes."""
    settings = {
        "spark.sql.files.maxPartitionBytes": "97",
        "spark.sql.files.openCostInBytes": "1",
        "spark.sql.files.minPartitionNum": "40",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def written(rows, ending="\n"):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=ending).writerows([NAMES, *rows])
    return out.getvalue()


def read(spark, path):
    found = tables.read_csv(spark, str(path), RAW_COMMENTS, na_tokens=())
    return sorted(tuple(x or "" for x in r) for r in found.collect())


@pytest.mark.parametrize("seed", range(4))
def test_csv_records_across_ranges(spark, small_ranges, tmp_path, seed):
    rng = random.Random(seed)
    rows = [[f"{i}", *[rng.choice(CELLS) * rng.choice([1, 1, 1, 1, 20]) for _ in NAMES[1:]]] for i in range(15)]
    path = tmp_path / "c.csv"
    path.write_text(written(rows, rng.choice(["\n", "\r\n"])), newline="")
    assert read(spark, path) == sorted(map(tuple, rows))


def test_csv_file_is_dealt_out(spark, small_ranges, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text(written([[f"{i}", "u", "a\nb" * 3, "1", "2", "ann"] for i in range(50)]), newline="")
    kind = ranges.CsvLines()
    pieces = ranges.read_pieces(spark, str(path), kind)
    found = ranges.find_ranges(pieces, kind)
    assert pieces.rdd.getNumPartitions() > 8 and found.count() > 8
    assert found.where("state = 1").count() > 1  # some begin inside a cell


def test_more_ranges_than_are_broadcast(spark, small_ranges, tmp_path, monkeypatch):
    monkeypatch.setattr(ranges, "BROADCAST_RANGES", 0)
    rows = [[f"{i}", "u", f"a\n,{i}\n" * 5, "1", "2", "ann"] for i in range(30)]
    path = tmp_path / "c.csv"
    path.write_text(written(rows), newline="")
    assert read(spark, path) == sorted(map(tuple, rows))


def test_quotes_that_open_no_cell(spark, small_ranges, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text(",".join(NAMES) + '\n1,u,5" pipe,1,2,ann\n2,u,say "hi",1,2,bob\n\n3,u,"in\n""side""",1,2,5"\n')
    assert [r[2] for r in read(spark, path)] == ['5" pipe', 'say "hi"', 'in\n"side"']


def test_many_files_blank_lines_and_no_end_of_line(spark, small_ranges, tmp_path):
    (tmp_path / "a.csv").write_text("\n\n" + ",".join(NAMES) + '\n1,u,"x\n\ny",1,2,ann')
    (tmp_path / "b.csv").write_text(",".join(reversed(NAMES)) + "\nbob,2,1,t,u,2\n")
    (tmp_path / "c.csv").write_text(",".join(NAMES))
    (tmp_path / "d.csv").write_text("")
    assert read(spark, tmp_path) == [("1", "u", "x\n\ny", "1", "2", "ann"), ("2", "u", "t", "1", "2", "bob")]


def test_foreign_headers_are_errors(spark, tmp_path):
    good, other = tmp_path / "a.csv", tmp_path / "b.csv"
    good.write_text("comment_id,url,comment_text\n1,u,t\n")
    other.write_text("Comment-ID;link\n1;u\n")
    with pytest.raises(ValueError, match="Comment-ID;link"):
        tables.read_comments_csv(spark, str(tmp_path))
    other.write_text("comment_id,comment_text\n1,t\n")
    with pytest.raises(ValueError):
        tables.read_comments_csv(spark, str(tmp_path))
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "a.csv").write_text("url,title\nu,t\n")
    (tmp_path / "m" / "b.jsonl").write_text('{"url": "u", "title": "t"}\n')
    with pytest.raises(Exception):
        tables.read_details(spark, str(tmp_path / "m")).collect()


TEXTS = ["", "plain", 'a "quoted" }', "{[", "back\\slash\\", "}\n]", "é😀", '\\"}', "x" * 300, None]


def objects(seed, n=12):
    rng = random.Random(seed)
    extra = [{"deep": [{"a": [1, "}]"]}, {}]}, [], "}", 3]
    return [{"url": f"u{i}", **{k: rng.choice(TEXTS) for k in DETAILS.names[1:]}, "more": rng.choice(extra)} for i in range(n)]


def details(rows):
    return sorted((tuple(r[k] for k in DETAILS.names) for r in rows), key=str)


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("seed", [0, 1])
def test_json_array_across_ranges(spark, small_ranges, tmp_path, indent, seed):
    rows = objects(seed)
    path = tmp_path / "d.json"
    path.write_text(json.dumps(rows, indent=indent, ensure_ascii=bool(seed)) + ("\n" if indent else ""))
    found = tables.read_details(spark, str(path))
    assert details(found.collect()) == details(rows)


def test_json_arrays_of_a_folder(spark, small_ranges, tmp_path):
    rows = objects(3, 6)
    (tmp_path / "a.json").write_text(json.dumps(rows[:4]))
    (tmp_path / "b.json").write_text(" [ ] ")
    (tmp_path / "c.json").write_text("﻿" + json.dumps(rows[4:], indent=2))
    assert details(tables.read_details_json(spark, str(tmp_path), array=True).collect()) == details(rows)


def test_truncated_and_foreign_arrays_are_errors(spark, small_ranges, tmp_path):
    whole = json.dumps([{"url": "u", "title": 'a "b" }'}, {"url": "v", "title": None}])
    cases = [whole[:n] for n in (0, 1, 8, 26, 31, 36, 38, len(whole) - 2, len(whole) - 1)]
    cases += [whole + whole, "[1, 2]", '{"url": "u"}', whole.replace("}, {", "} {"), "[" + whole + "]", whole + "x"]
    for i, text in enumerate(cases):
        path = tmp_path / f"{i}.json"
        path.write_text(text)
        with pytest.raises(Exception):
            tables.read_details_json(spark, str(path), array=True).collect()


def test_python_works_on_parts_of_bounded_size():
    from quipyard.sources.batches import in_parts

    texts = ["x" * 10, None, "é" * 30, "y" * 500, "", "z" * 90] * 3
    batch = pa.RecordBatch.from_pydict({"value": texts, "n": list(range(18))})
    parts = list(in_parts(iter([batch, batch.slice(0, 0)]), "value", 100))
    assert [n for p in parts for n in p.column("n").to_pylist()] == list(range(18))
    assert all(p.num_rows == 1 or sum(len((t or "").encode()) for t in p.column("value").to_pylist()) <= 100 for p in parts)


@pytest.mark.parametrize("kind", [ranges.CsvLines, ranges.JsonPieces])
def test_large_batches_are_cut_in_parts(kind, monkeypatch):
    """Ten megabytes in one batch never meet the patterns at once."""
    most, steps = [], kind.steps
    monkeypatch.setattr(kind, "steps", lambda self, values: most.append(values.nbytes) or steps(self, values))
    end = "\n" if kind is ranges.CsvLines else "}"
    lines = ["a,b"] + ["x" * 2000 + ",1"] * 5000 if end == "\n" else ['[{"a": 1'] + [',{"a": "' + "x" * 2000 + '"'] * 5000
    batch = pa.RecordBatch.from_pydict({"file": [1] * 5001, "block": [0] * 5001, "tag": [1] * 5001, "state": pa.array([0] * 5001, pa.int32()), "depth": [0] * 5001, "value": lines})

    class Pieces:
        def mapInArrow(self, work, schema):  # noqa: N802
            return list(work(iter([batch])))

    found = ranges._cut(Pieces(), kind())
    assert "".join(t for b in found for t in b.column("text").to_pylist()) == "".join(line + end for line in lines)
    assert max(most) < 2 << 20
