"""One run of the bot: candidates, requests, generations, review and log under one run id.

Each stage is written once below the run's folder and then entered in the run's manifest, a file that only
one writer can create. A rerun with the same id reads the stages that are entered and starts at the first
missing one; a stage that was stopped half-way is not entered, so what it left is never read. Generation
resumes inside its stage, and the log takes a run's comments once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quipyard.functions.prompts import INSTRUCTION, instruction_prompt
from quipyard.functions.text import word_prefix
from quipyard.plans.candidates import select_candidates
from quipyard.plans.generation import Generator
from quipyard.plans.resumable import generate_resumable
from quipyard.plans.review import with_problems
from quipyard.sources import log
from quipyard.streaming.review_log import review_batch


@dataclass(frozen=True)
class Run:
    """The stages of one run id, below `path`/`run_id`."""

    spark: SparkSession
    path: str
    run_id: str

    @property
    def folder(self) -> str:
        return f"{self.path.rstrip('/')}/{self.run_id}"

    def done(self) -> dict[str, dict]:
        """Stage -> its entry (folder, rows) in the manifest."""
        files = log._Files(self.spark, self.folder)
        names = [n for n in files.names("stages") if n.endswith(".json") and not n.startswith(".")]
        return {n.removesuffix(".json"): json.loads(files.read(f"stages/{n}")) for n in names}

    def stage(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """What `make` gave the first time this stage was finished."""
        entry = self.done().get(name)
        if entry is None:
            folder = f"{self.folder}/{name}-{uuid.uuid4().hex}"
            made = make()
            made.write.parquet(folder)
            rows = self.spark.read.parquet(folder).count()
            log._Files(self.spark, self.folder).publish(f"stages/{name}.json", json.dumps({"folder": folder, "rows": rows}))
            entry = self.done()[name]  # another runner may have been first
        return self.spark.read.parquet(entry["folder"])


def run_bot(
    articles: DataFrame,
    comments: DataFrame,
    username: str,
    make_generator: Callable[[], Generator],
    path: str,
    run_id: str,
    log_path: str,
    rejected_path: str | None = None,
    n: int = 3,
    position: str = "position",
    num_words: int = 300,
    instruction: str = INSTRUCTION,
    moment: Column | None = None,
    **filters,
) -> DataFrame:
    """Choose articles, ask for comments, check them and log them: (url, prompt, comment, reasons, comment_id).

    A comment's id is a hash of run and url. Requests that found no answer stay in the dead letters
    below the run's folder. Call again with the same `run_id` to go on with a stopped run.
    """
    run = Run(articles.sparkSession, path, run_id)
    chosen = run.stage("candidates", lambda: select_candidates(articles, comments, username, n, position, **filters))
    prompt = instruction_prompt(word_prefix(F.col("title_article_text"), num_words), instruction)
    requests = run.stage("requests", lambda: chosen.select("url", prompt.alias("prompt")))
    answered = run.stage(
        "generations", lambda: generate_resumable(requests, make_generator, f"{run.folder}/answers").answered
    )
    comment_id = F.sha2(F.concat_ws("|", F.lit(run_id), "url"), 256)
    when = F.current_timestamp() if moment is None else moment
    reviewed = run.stage(
        "reviewed",
        lambda: with_problems(answered.select("url", "prompt", "comment", comment_id.alias("comment_id"), when.alias("datetime"))),
    )
    run.stage("logged", lambda: _logged(reviewed, log_path, rejected_path or log_path.rstrip("/") + ".rejected", run_id))
    return reviewed


def _logged(reviewed: DataFrame, log_path: str, rejected_path: str, run_id: str) -> DataFrame:
    """Append to the logs; the stage keeps the ids."""
    review_batch(reviewed, log_path, rejected_path, f"run {run_id}", 0)
    return reviewed.select("comment_id", (F.size("reasons") == 0).alias("accepted"))
