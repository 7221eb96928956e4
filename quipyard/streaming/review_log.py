"""Review a stream of generated comments and keep an idempotent log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from quipyard.plans.review import with_problems
from quipyard.schemas import COMMENT_LOG, REVIEW_INPUT
from quipyard.session import discard, store
from quipyard.sources.tables import append_new

#: How long an id is kept in the state store after its arrival.
REMEMBER = "1 day"
REJECTED_LOG = T.StructType(COMMENT_LOG.fields + [T.StructField("reasons", T.ArrayType(T.StringType()))])


def read_generated_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """JSON files of (comment_id, url, comment, datetime) as they arrive."""
    reader = spark.readStream.schema(REVIEW_INPUT)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def review_batch(
    batch: DataFrame, log_path: str, rejected_path: str, source: str | None = None, number: int | None = None
) -> None:
    """Append one batch to both logs. Ids that a log already holds do not count, so the same
    input under a new checkpoint adds nothing; a batch of a source that runs again is not even written."""
    marked = store(batch if "reasons" in batch.columns else with_problems(batch), "reviewed")
    good = F.size("reasons") == 0
    accepted, rejected = marked.where(good), marked.where(~good)
    append_new(accepted, log_path, COMMENT_LOG, source=source, batch=number, stored=True)
    append_new(rejected, rejected_path, REJECTED_LOG, source=source, batch=number, stored=True)
    discard(marked)


def without_repeats(generated: DataFrame, remember: str = REMEMBER) -> DataFrame:
    """Reviewed rows (with `reasons`) of a stream whose id, with the same verdict, has not arrived lately.

    Ids are kept in the state store from arrival on for the time `remember`, whatever `datetime` says,
    so nothing is too late. Rows without an id are told apart by all their columns.
    """
    marked = with_problems(generated)
    whole = F.sha2(F.to_json(F.struct(*generated.columns)), 256)
    key = F.coalesce(F.concat(F.lit("id "), "comment_id"), F.concat(F.lit("row "), whole))
    keyed = marked.withColumns({"_key": key, "_good": F.size("reasons") == 0, "_arrived": F.current_timestamp()})
    fresh = keyed.withWatermark("_arrived", remember).dropDuplicatesWithinWatermark(["_key", "_good"])
    return fresh.drop("_key", "_good", "_arrived")


def start_review_log(
    generated: DataFrame,
    log_path: str,
    rejected_path: str,
    checkpoint: str,
    available_now: bool = False,
    interval: str = "1 minute",
    remember: str = REMEMBER,
) -> StreamingQuery:
    """Run the review on a stream; no record is dropped for being late.

    Recent repeats end in the state store, older ones do not count in the log, and neither needs
    the log to be read. Batches are numbered by the checkpoint, so none is logged twice.
    """
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (
        without_repeats(generated, remember)
        .writeStream.foreachBatch(lambda batch, n: review_batch(batch, log_path, rejected_path, checkpoint, n))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
