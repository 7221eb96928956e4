"""Generation that goes on where it was stopped.

Every request has a key, a hash of its prompt and settings. Requests are worked on in slices; after each one
the answers go into a log of results by key, and requests that failed in every attempt into a log of dead
letters with the last error. A run looks up both logs first, so one that follows a stopped run calls the
generator only for what is left, and equal requests are asked once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipyard.plans.generation import TEMPERATURE, TOP_P, Generator
from quipyard.session import discard, store
from quipyard.sources import log

KEY = "request_key"
#: Attempts for a request that fails, and requests in a slice.
ATTEMPTS = 3
SLICE = 1_000_000

_KEYED = [T.StructField(name, T.StringType()) for name in (KEY, "prompt", "comment", "error")]
_ATTEMPTS = T.StructField("attempts", T.IntegerType())
_ANSWERS = T.StructType([*_KEYED, _ATTEMPTS])
RESULTS = T.StructType([_ANSWERS[c] for c in (KEY, "comment", "attempts")])
DEAD = T.StructType([_ANSWERS[c] for c in (KEY, "prompt", "error", "attempts")])


@dataclass(frozen=True)
class Generated:
    """All requests that were answered, with `comment` and `attempts`, and the dead letters."""

    answered: DataFrame
    dead: DataFrame


def request_key(prompt: str = "prompt", temperature: float = TEMPERATURE, top_p: float = TOP_P):
    """Key of a request as a column; requests with the same key are the same."""
    return F.sha2(F.to_json(F.struct(F.lit(temperature).alias("t"), F.lit(top_p).alias("p"), F.col(prompt).alias("prompt"))), 256)


def _tried(requests: DataFrame, make_generator: Callable[[], Generator], temperature: float, top_p: float, attempts: int, batch_size: int) -> DataFrame:
    """(key, prompt, comment, error, attempts): `error` where no attempt had a result."""

    def one(generator: Generator, prompt: str) -> tuple[str | None, str | None, int]:
        error = None
        for n in range(1, attempts + 1):
            try:
                [comment] = generator([prompt], temperature, top_p)
                return comment, None, n
            except Exception as e:  # noqa: BLE001  whatever a model or its client raises
                error = f"{type(e).__name__}: {e}"
        return None, error, attempts

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generator = make_generator()
        for batch in batches:
            for at in range(0, len(batch), batch_size):
                part = batch.iloc[at : at + batch_size]
                prompts = part["prompt"].tolist()
                try:
                    comments = generator(prompts, temperature, top_p)
                    if len(comments) != len(prompts):
                        raise ValueError(f"{len(prompts)} prompts but {len(comments)} comments")
                    answers = [(c, None, 1) for c in comments]
                except Exception:  # noqa: BLE001  one of them spoils the batch: each by itself
                    answers = [one(generator, p) for p in prompts]
                done = pd.DataFrame(answers, columns=["comment", "error", "attempts"], dtype=object)
                yield pd.concat([part[[KEY, "prompt"]].reset_index(drop=True), done], axis=1)

    return requests.select(KEY, "prompt").mapInPandas(run, _ANSWERS)


def generate_resumable(
    requests: DataFrame,
    make_generator: Callable[[], Generator],
    path: str,
    temperature: float = TEMPERATURE,
    top_p: float = TOP_P,
    attempts: int = ATTEMPTS,
    rows_per_slice: int = SLICE,
    batch_size: int = 64,
    retry_dead: bool = False,
) -> Generated:
    """Answer all requests (with a column `prompt`) that the logs below `path` do not know yet.

    `requests` must be the same rows each time they are read. Dead letters are tried again with
    `retry_dead` only. A request that is answered in the end is no dead letter any more.
    """
    spark = requests.sparkSession
    results, dead = f"{path.rstrip('/')}/results", f"{path.rstrip('/')}/dead"
    keyed = requests.withColumn(KEY, request_key("prompt", temperature, top_p))
    known = log.read(spark, results, RESULTS, KEY).select(KEY)
    if not retry_dead:
        known = known.union(log.read(spark, dead, DEAD, KEY).select(KEY))
    open_ = store(keyed.select(KEY, "prompt").distinct().join(known, KEY, "left_anti"), "open-requests")
    slices = -(-open_.count() // rows_per_slice)
    for i in range(slices):
        part = open_.where(F.pmod(F.xxhash64(KEY), F.lit(slices)) == i)
        tried = store(_tried(part, make_generator, temperature, top_p, attempts, batch_size), "answers")
        log.append(tried.where("error IS NULL").select(*RESULTS.names), results, RESULTS, KEY)
        log.append(tried.where("error IS NOT NULL").select(*DEAD.names), dead, DEAD, KEY)
        discard(tried)
    discard(open_)
    found = log.read(spark, results, RESULTS, KEY)
    return Generated(
        keyed.join(found, KEY), log.read(spark, dead, DEAD, KEY).join(found.select(KEY), KEY, "left_anti")
    )
