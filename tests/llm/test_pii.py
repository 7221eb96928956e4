import re

import brute
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quipyard.llm import pii


def spans(table, texts):
    docs = table("doc_id BIGINT, text STRING, base_spans STRING", *[(i, t, "clash") for i, t in enumerate(texts)])
    rows = (
        pii.find_personal_data(docs)
        .select("doc_id", pii.spans_text(F.col("base_spans")).alias("b"), pii.spans_text(F.col("all_spans")).alias("a"))
        .collect()
    )
    return [(r.b, r.a) for r in sorted(rows)]


def expected(text):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in brute.base_spans(text))


CASES = [
    None,
    "",
    "a@b.c+d@e.f x@y",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 0000000000000000000000000000000000000000000000.1.1.1",
    "99999999999999999999999999999999999999999999999.1.1.1",
    "4417 7442-8035 1547 4417744280351547é 4417744280351548",
    "+1 (017) 555-7713 ++1 23 +49-30-1234567890123456",
    "é\U0001f600 q.r@s.t.u- +12 345 678 90",
    "@" * 50 + "a" * 50 + "@b",
]


def test_base_spans_equal_brute_force(table):
    assert [b for b, _ in spans(table, CASES)] == [expected(t) for t in CASES]


def test_very_long_runs_end_soon(table):
    """Texts on which a backtracking search would take a quadratic time or a deep stack."""
    texts = ["a" * 200_000, "1" * 200_000, "a@b" + ".c" * 50_000, "1-" * 50_000, "+1" + "(" * 100_000, "1.2." * 40_000]
    want = ["", "", "email:0:100003", "", "", ",".join(f"ip:{i}:{i + 7}" for i in range(0, 160_000, 8))]
    assert [b for b, _ in spans(table, texts)] == want


@given(st.lists(st.text("a@.+-1 4(é)5", max_size=30), min_size=20, max_size=40))
@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_any_text(table, texts):
    assert [b for b, _ in spans(table, texts)] == [expected(t) for t in texts]


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("pay to DE89 3704 0044 0532 0130 00 now", ["iban"]),
        ("pay to DE89 3704 0044 0532 0130 01 now", []),
        ("call me on 030 1234567 please", []),
        ("my phone is 555-123-4567 ok", ["local_phone"]),
        ("part no 555-123-4567 ok", []),
        ("ssn 123-45-6789", ["id_number"]),
        ("order 123-45-6789", []),
        ("ssn 666-45-6789", []),
    ],
)
def test_checks_and_context(table, text, kinds):
    [(base, every)] = spans(table, [text])
    assert re.findall("[a-z_]+", every) == kinds and base == ""


def test_empty_table(table):
    assert spans(table, []) == []


@pytest.mark.parametrize(
    "text, scores",
    [
        ("x a@b.c y", "0.9"),
        ("my E-Mail is a@b.c, also d@e.f", "1.0,0.9"),
        ("mail " + "x" * 40 + " a@b.c", "0.9"),
        ("1.2.3.4 then server 5.6.7.8", "0.6,0.95"),
        ("card: 4417 7442 8035 1547", "1.0"),
        ("4417 7442 8035 1547", "0.8"),
        ("call +49 30 123456789 or +49 30 123456780", "0.95,0.7"),
        ("DE89 3704 0044 0532 0130 00", "0.8"),
        ("iban DE89 3704 0044 0532 0130 00", "1.0"),
        ("ssn 123-45-6789", "0.9"),
        (None, ""),
    ],
)
def test_words_nearby_adjust_scores(table, text, scores):
    docs = table("doc_id BIGINT, text STRING", (1, text))
    [row] = pii.find_personal_data(docs).select(pii.scores_text(F.col("all_spans")).alias("s")).collect()
    assert row.s == scores


def test_repeated_rows_have_equal_spans(table):
    assert spans(table, ["ip 1.2.3.4 a@b.c"] * 3) == [("ip:3:10,email:11:16",) * 2] * 3
