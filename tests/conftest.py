import sys
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from quipyard.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
    }
    session = build_session("tests", "local[4]", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session


def _frame(spark, schema: str, rows):
    """Rows to a DataFrame by way of Arrow, which needs no Python workers."""
    kind = T.StructType.fromDDL(schema)
    records = [dict(zip(kind.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(kind)), kind)


@pytest.fixture
def table(spark):
    """Rows and a DDL schema to a DataFrame."""

    def make(schema: str, *rows: tuple, partitions: int = 3):
        return _frame(spark, schema, rows).repartition(partitions)

    return make


@pytest.fixture
def column(spark):
    """Results of a column function on a list of texts, in order."""

    def run(function, values):
        rows = _frame(spark, "i INT, x STRING", enumerate(values))
        return [r.y for r in sorted(rows.select("i", function(F.col("x")).alias("y")).collect())]

    return run
