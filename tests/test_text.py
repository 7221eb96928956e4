import base64
from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quipyard.functions import prompts, text, votes
from quipyard.functions.text import SPACES

TEXTS = [
    "",
    " ",
    "one",
    "  two  words ",
    "a\tb c d　e",
    "x\n\n  y \r\n z\x1c\x1f w",
    "no​break ᠎ here﻿",
    " \n lead\x85\x85 tail  ",
    " inner   blanks\tstay \n next line  ",
    "é😀 " * 400,
]


def test_spaces_are_those_of_python():
    assert sorted(SPACES) == [c for c in map(chr, range(0x110000)) if c.isspace()]


def test_every_character_splits_as_in_python(column):
    chars = [c for c in map(chr, [*range(1, 0x3100), 0xFEFF, 0xFFFD, 0x1F600]) if not 0xD800 <= ord(c) < 0xE000]
    assert column(text.word_count, [f"a{c}b" for c in chars]) == [len(f"a{c}b".split()) for c in chars]
    lines = column(text.normalize_lines, [f"a{c}b" for c in chars])
    assert lines == ["\n".join(p.strip() for p in f"a{c}b".splitlines() if p.strip()) for c in chars]


def test_words(column):
    assert column(text.word_count, TEXTS) == [len(t.split()) for t in TEXTS]
    for n in (1, 2, 300):
        assert column(lambda c: text.word_prefix(c, n), TEXTS) == [" ".join(t.split()[:n]) for t in TEXTS]
        by_space = [" ".join(t.split(" ")[:n]) for t in TEXTS]
        assert column(lambda c: text.word_prefix_by_space(c, n), TEXTS) == by_space
        stripped = [" ".join(t.strip().split(" ")[:n]) for t in TEXTS]
        assert column(lambda c: text.word_prefix_by_space_stripped(c, n), TEXTS) == stripped


def test_lines_and_paragraphs(column):
    expected = ["\n".join(line.strip() for line in t.splitlines() if line.strip()) for t in TEXTS]
    assert column(text.normalize_lines, TEXTS) == expected
    assert column(text.paragraphs, TEXTS) == [[p for p in t.split("\n") if p] for t in TEXTS]
    assert column(text.strip, TEXTS) == [t.strip() for t in TEXTS]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=SPACES + "ab#é😀", max_size=30), min_size=1, max_size=40))
def test_random_texts(column, values):
    assert column(lambda c: text.word_prefix(c, 3), values) == [" ".join(v.split()[:3]) for v in values]
    expected = ["\n".join(line.strip() for line in v.splitlines() if line.strip()) for v in values]
    assert column(text.normalize_lines, values) == expected


def test_nulls_stay_null(column):
    for function in (text.word_count, text.word_prefix, text.normalize_lines, text.char_prefix, text.strip):
        assert column(function, [None, "a"])[0] is None
    assert column(lambda c: text.title_and_text(c, F.lit("t")), [None, "a"]) == [None, "a t"]
    assert column(lambda c: text.title_and_text(F.lit("t"), c, ": "), [None, "a"]) == [None, "t: a"]


def test_char_prefix_counts_code_points(column):
    long = "x" * 599 + "😀é"
    assert column(text.char_prefix, [long]) == [long[:600]]


def test_base64(column):
    assert column(text.decode_base64, [base64.b64encode("é😀\n###".encode()).decode()]) == ["é😀\n###"]


def test_iso_timestamp(spark):
    moments = [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 60), datetime(2024, 1, 2, 3, 4, 5, 500000)]
    rows = spark.createDataFrame([(m,) for m in moments], "t TIMESTAMP_NTZ")
    found = {r[0] for r in rows.select(text.iso_timestamp(F.col("t"))).collect()}
    assert found == {m.isoformat() for m in moments}


def test_votes(column):
    cells = ["12", " 7 ", " 3\n", "4.0", "4.5", "-2", "", "N/A", "1,234", None, "99999999999999999999"]
    assert column(votes.parse_votes, cells) == [12, 7, 3, 4, None, -2, None, None, None, None, None]


def test_ratio_at_zero(spark):
    row = spark.range(1).select(
        votes.vote_ratio(F.lit(0), F.lit(3)).alias("zero"), votes.vote_ratio(F.lit(4), F.lit(1)).alias("quarter")
    ).first()
    assert row.zero is None and row.quarter == 0.25


def test_percent(spark):
    row = spark.range(1).select(votes.percent_text(votes.token_probability(F.lit(-0.5)))).first()
    assert row[0] == "60.65%"


def test_prompt_layouts(column):
    head = f"### Instruction:\n{prompts.INSTRUCTION}\n\n### Input:\n"
    assert column(prompts.instruction_prompt, ["T x"]) == [head + "T x\n\n### Response:\n"]
    long = "w " * 3000
    assert column(prompts.preference_prompt, [long]) == [head + long[:600] + "\n\n### Response:\n"]
    trained = column(lambda c: prompts.training_text(c, F.lit("ha")), [long])
    assert trained == [head + " ".join(long.split(" ")[:2000]) + "\n\n### Response:\nha\n"]
    assert column(prompts.chat_user_prompt, ["x"]) == ["### Article Summary:\n\nx\n\n### Comment:\n\n"]
    assert column(lambda c: prompts.chat_system_prompt(c, "P"), ["few"]) == ["P\n\nfew"]
    assert column(lambda c: prompts.audit_text(F.lit("s"), c), ["u"]) == ["System Prompt:\ns\n\nUser Prompt:\nu"]
    own = column(lambda c: prompts.instruction_prompt(c, "Say it."), ["x"])
    assert own == ["### Instruction:\nSay it.\n\n### Input:\nx\n\n### Response:\n"]
