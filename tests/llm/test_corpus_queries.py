import os

import pytest
from compare import differences, sql_connection

import corpus_pipeline

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_operator_has_a_query():
    names = list(corpus_pipeline.QUERIES)
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in names} - {"pipeline"}
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", list(corpus_pipeline.ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(corpus_pipeline.QUERIES[name](spark, FOLDER), sql_connection(FOLDER), name) == []
