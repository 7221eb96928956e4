"""Readers and writers of the tables on disk."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipyard.functions.votes import parse_votes
from quipyard.operators.columns import na_tokens_to_null
from quipyard.schemas import ARTICLE_URLS, CLEAN_DETAILS, COMMENT_LOG, COMMENTS, DETAILS, NA_TOKENS, RAW_COMMENTS
from quipyard.sources import log
from quipyard.sources.batches import in_parts
from quipyard.sources.ranges import CsvLines, JsonPieces, cut_records, find_ranges, last_ranges, read_pieces

#: What is appended to the path of a log for its rows without an id.
NO_KEY = ".without-id"

# Cells may hold line breaks and doubled quotes; texts keep their outer blanks.
_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# One record as text: line breaks inside are part of a cell.
_CELLS = {**_CSV, "header": False, "multiLine": True}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    na_tokens: Sequence[str] = NA_TOKENS,
    required: Sequence[str] = (),
) -> DataFrame:
    """Text cells, columns found by header name, null tokens as null.

    Each file's own header decides the order of its columns; columns the schema
    lacks are left out, missing ones are null. A header with none of the columns, or
    without a `required` one, is an error. A file of any size is read by many tasks
    (see `quipyard.sources.ranges`), for which all lines are looked at once before.
    """
    kind = CsvLines()
    pieces = read_pieces(spark, path, kind)
    ranges = find_ranges(pieces, kind)
    # one row for each wording of the header
    heads = [r.head for r in ranges.where("head IS NOT NULL").select("head").distinct().orderBy("head").collect()]
    if not heads:
        return spark.createDataFrame([], schema)
    wordings = F.array(*[F.lit(head) for head in heads])
    tag = F.array_position(wordings, F.max("head").over(Window.partitionBy("file")))
    records = cut_records(pieces, ranges, kind, tag).where(~F.col("first"))
    lines = records.select("tag", F.rtrim("record", F.lit("\r\n")).alias("record")).where("record <> ''")
    rows = [F.when(F.col("tag") == i, _by_header(head, schema, required)) for i, head in enumerate(heads, 1)]
    return na_tokens_to_null(lines.select(F.coalesce(*rows).alias("row")).select("row.*"), na_tokens)


def _by_header(head: str, schema: T.StructType, required: Sequence[str]) -> Column:
    """The columns of the schema out of a record below this header."""
    line = head.removeprefix("\ufeff").rstrip("\r\n")
    header = [c.lower().replace(" ", "_") for c in next(csv.reader(io.StringIO(line, newline="")))]
    if "\r" in line or not set(schema.names) & set(header) or not set(required) <= set(header):
        raise ValueError(f"a CSV file begins with {line[:200]!r}, which is no header for {', '.join(schema.names)}")
    places = {name: f"c{i}" for i, name in enumerate(header)}
    cells = F.from_csv("record", ", ".join(f"{c} STRING" for c in places.values()), {k: str(v).lower() for k, v in _CELLS.items()})
    return F.struct(
        *[(cells[places[n]] if n in places else F.lit(None).cast("string")).alias(n) for n in schema.names]
    )


def read_comments_csv(spark: SparkSession, path: str, na_tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Comments with whole-number votes; cells that are no number become null votes."""
    raw = read_csv(spark, path, RAW_COMMENTS, na_tokens, required=["url"])
    votes = {c: parse_votes(F.col(c)) for c in ("pcu_value", "pcd_value")}
    return raw.withColumns(votes).select(*COMMENTS.names)


def read_details_json(spark: SparkSession, path: str, array: bool = False) -> DataFrame:
    """Article details from JSON lines under any name, or with `array` from files of one array each.

    A line or file that is no such JSON is an error. A file is read by many tasks in either form.
    """
    if not array:
        return spark.read.schema(DETAILS).json(path, mode="FAILFAST")
    kind = JsonPieces()
    pieces = read_pieces(spark, path, kind)
    ranges = find_ranges(pieces, kind)
    # the closing bracket leads to depth 0, and the brace taken for granted behind it to -1
    broken = F.count_if((F.col("end_state") != 0) | (F.col("end_depth") != -1))
    files, bad = last_ranges(ranges).agg(F.count("*"), broken).first()
    if bad or files < len(pieces.inputFiles()):
        raise ValueError(f"a file of {path} is not one JSON array")
    records = cut_records(pieces, ranges, kind, F.lit(0).cast("bigint"))
    at = F.instr("record", "{")
    lead = F.regexp_replace(F.when(at > 0, F.substr("record", F.lit(1), at - 1)).otherwise(F.col("record")), r"[\s\x{FEFF}]+", "")
    parted = records.select("first", "record", at.alias("at"), lead.alias("lead")).where("at > 0 OR lead NOT IN (']}', '[]}')")
    right = (F.col("at") > 0) & (F.col("lead") == F.when(F.col("first"), "[").otherwise(","))
    wrong = F.raise_error(F.lit("a file is not one JSON array of objects"))
    body = F.when(right, F.substr("record", F.col("at"))).otherwise(wrong)
    return parted.select(F.from_json(body, DETAILS, {"mode": "FAILFAST"}).alias("row")).select("row.*")


def read_details_csv(spark: SparkSession, path: str, na_tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Article details as written by the ingest step."""
    return read_csv(spark, path, CLEAN_DETAILS, na_tokens, required=["url"])


def read_details(spark: SparkSession, path: str) -> DataFrame:
    """Details in any of the three formats, told apart by how the first file begins."""
    first = spark.read.text(path).where("length(trim(value)) > 0").first()
    start = first.value.strip()[:1] if first else "{"
    if start in "[{":
        return read_details_json(spark, path, array=start == "[")
    return read_details_csv(spark, path).select(*DETAILS.names)


def read_urls(spark: SparkSession, path: str) -> DataFrame:
    """One column `url`; the header line is skipped whatever it says."""
    return spark.read.options(**_CSV).schema(ARTICLE_URLS).csv(path)


def read_dataset(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """JSON lines if the name says so, else a table of that name.

    Whole numbers may be written as `12` or `12.0`. A broken line is an error.
    """
    if "jsonl" not in name:
        return spark.table(name).select(*schema.names)
    whole = {f.name for f in schema.fields if isinstance(f.dataType, T.LongType)}
    as_text = T.StructType([T.StructField(f.name, T.StringType() if f.name in whole else f.dataType) for f in schema])
    rows = spark.read.schema(as_text).json(name, mode="FAILFAST")
    return rows.withColumns({c: parse_votes(F.col(c)) for c in whole}).select(*schema.names)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line, null fields written out."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int = 500_000) -> None:
    """CSV in files of bounded size: cells with line breaks keep a file from being split on reading."""
    df.write.mode(mode).options(**_CSV, maxRecordsPerFile=rows_per_file).csv(path)


def write_json_arrays(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Files of one JSON array each, a record per line, null fields written out."""

    def enclosed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = "["
        for batch in in_parts(batches, "value"):
            lines = []
            for record in batch.column("value"):
                lines.append(mark + record.as_py())
                mark = ","
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["]" if mark == "," else "[]"])], ["value"])

    records = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    records.mapInArrow(enclosed, "value STRING").write.mode(mode).text(path)


def append_new(
    df: DataFrame,
    path: str,
    schema: T.StructType,
    key: str = "comment_id",
    source: str | None = None,
    batch: int | None = None,
    stored: bool = False,
) -> None:
    """Append rows to a log (see `quipyard.sources.log`); rows whose key it holds already do not count.

    Of several new rows with one key the smallest (by all columns) is kept, so a
    repeated run writes the same row. Rows without a key go to the log at
    `path` + NO_KEY, told apart by a hash of all their columns. Rows of a `stored` table
    may be read several times; then only those with repeated keys are shuffled.
    """
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    digest = F.sha2(F.to_json(F.struct(*schema.names), {"ignoreNullFields": "false"}), 256)
    wide = T.StructType([*schema.fields, T.StructField("row_hash", T.StringType())])
    unnamed = rows.where(F.col(key).isNull()).withColumn("row_hash", digest)
    log.append(unnamed, path.rstrip("/") + NO_KEY, wide, "row_hash", source, batch, stored)
    log.append(rows.where(F.col(key).isNotNull()), path, schema, key, source, batch, stored)


def append_comment_log(df: DataFrame, path: str) -> None:
    """Insert-only log of posted comments, one record per comment id."""
    append_new(df, path, COMMENT_LOG)


def read_log(spark: SparkSession, path: str, schema: T.StructType, key: str = "comment_id") -> DataFrame:
    """The rows of a log, one for each key."""
    return log.read(spark, path, schema, key)


def read_log_without_id(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Its rows without a key, each of them once."""
    wide = T.StructType([*schema.fields, T.StructField("row_hash", T.StringType())])
    return log.read(spark, path.rstrip("/") + NO_KEY, wide, "row_hash").select(*schema.names)


def read_comment_log(spark: SparkSession, path: str) -> DataFrame:
    return read_log(spark, path, COMMENT_LOG)
