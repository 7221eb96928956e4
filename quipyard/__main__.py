"""Command line: python -m quipyard COMMAND [options]; see COMMAND --help."""

from __future__ import annotations

import argparse
import importlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipyard.operators.batching import few_shot_block
from quipyard.operators.sampling import SEED, TEST_SHARE, with_split
from quipyard.plans import bot_run, candidates, datasets, generation, ingest
from quipyard.schemas import DPO_DATASET, REVIEW_INPUT, SFT_DATASET
from quipyard.session import build_session
from quipyard.sources import few_shot, tables
from quipyard.sources.pages import extract_links, read_pages
from quipyard.streaming.review_log import read_generated_stream, review_batch, start_review_log


def build_sft_dataset(spark: SparkSession, args: argparse.Namespace) -> None:
    """Articles with their top comment, as JSON lines."""
    comments = tables.read_comments_csv(spark, args.df_comments_path)
    details = tables.read_details(spark, args.df_article_details_path)
    tables.write_jsonl(datasets.build_sft_dataset(comments, details), args.output_path)


def build_dpo_dataset(spark: SparkSession, args: argparse.Namespace) -> None:
    """Pairs of top and worst comment, as JSON lines."""
    comments = tables.read_comments_csv(spark, args.df_comments_path)
    details = tables.read_details(spark, args.df_article_details_path)
    tables.write_jsonl(datasets.build_dpo_dataset(comments, details), args.output_path)


def ingest_pages(spark: SparkSession, args: argparse.Namespace) -> None:
    """Details, comments and errors of captured pages, as CSV; prints what was counted."""
    ingested = ingest.ingest_pages(read_pages(spark, args.pages_path))
    ingest.write_ingested(ingested, args.output_path)
    print(json.dumps(ingested.counts))


def list_urls(spark: SparkSession, args: argparse.Namespace) -> None:
    """Article links of captured archive pages, as CSV."""
    links = extract_links(read_pages(spark, args.pages_path), pattern=args.pattern)
    tables.write_csv(links.select("url"), args.output_path)


def prepare_sft(spark: SparkSession, args: argparse.Namespace) -> None:
    """Filtered and formatted examples; packed into blocks if a length is given."""
    dataset = tables.read_dataset(spark, args.dataset_name, SFT_DATASET)
    prepared, counts = datasets.prepare_sft(
        dataset, args.pcu_value_threshold, args.pcd_pcu_ratio_threshold, args.article_word_threshold
    )
    tables.write_jsonl(prepared, args.output_path)
    print(json.dumps(counts.get))
    if args.seq_length:
        stored = spark.read.schema(prepared.schema).json(args.output_path)
        packed = datasets.pack_sft(stored, args.seq_length)
        packed.write.mode("overwrite").parquet(args.output_path.rstrip("/") + ".packed")


def prepare_dpo(spark: SparkSession, args: argparse.Namespace) -> None:
    """Filtered pairs below `split=train` and `split=test`."""
    dataset = tables.read_dataset(spark, args.dataset_name, DPO_DATASET)
    kept, counts = datasets.filter_dpo(dataset, args.chosen_pcu_threshold, args.rejected_pcd_threshold)
    split = with_split(kept, "url", args.test_size, args.seed, args.exact)
    split.write.mode("overwrite").partitionBy("split").option("ignoreNullFields", "false").json(args.output_path)
    print(json.dumps(counts.get))


def select_candidates(spark: SparkSession, args: argparse.Namespace) -> None:
    """Articles to comment on next, as JSON lines."""
    comments = tables.read_comments_csv(spark, args.df_comments_path)
    chosen = candidates.select_candidates(_listed(spark, args), comments, args.username, args.num_comments_desired)
    tables.write_jsonl(chosen, args.output_path)


def _listed(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Article details in the order of the list pages: by address, then by place on the page."""
    urls = extract_links(read_pages(spark, args.archive_pages_path), pattern=args.pattern)
    details = tables.read_details(spark, args.df_article_details_path)
    place = F.min(F.struct("page_url", "position")).alias("position")
    return details.join(urls.groupBy("url").agg(place), "url")


def _generator(name: str):
    """The function MODULE:NAME, which makes a generator in each task."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def bot(spark: SparkSession, args: argparse.Namespace) -> None:
    """Choose articles, generate, review and log, under a run id; the same id again resumes."""
    comments = tables.read_comments_csv(spark, args.df_comments_path)
    reviewed = bot_run.run_bot(
        _listed(spark, args),
        comments,
        args.username,
        _generator(args.generator),
        args.output_path,
        args.run_id,
        args.log_path,
        n=args.num_comments_desired,
    )
    good = F.size("reasons") == 0
    print(json.dumps(reviewed.agg(F.count_if(good).alias("accepted"), F.count_if(~good).alias("rejected")).first().asDict()))


def chat_requests(spark: SparkSession, args: argparse.Namespace) -> None:
    """One chat request per article, with the examples of a few-shot file, as JSON lines."""
    details = tables.read_details(spark, args.df_article_details_path)
    examples = few_shot.few_shot_examples(few_shot.read_few_shot_text(spark, args.few_shot_path))
    tables.write_jsonl(generation.chat_requests(details, examples, args.num_shots, args.model), args.output_path)


def compare_generations(spark: SparkSession, args: argparse.Namespace) -> None:
    """Answers of a chat generator and of a tuned one side by side, as JSON lines."""
    details = tables.read_details(spark, args.df_article_details_path)
    text = few_shot.read_few_shot_text(spark, args.few_shot_path)
    block = few_shot_block(few_shot.few_shot_examples(text), args.num_shots).scalar()
    requests = generation.comparison_requests(details, block)
    answered = generation.compare_generations(requests, _generator(args.first_generator), _generator(args.second_generator))
    tables.write_jsonl(answered, args.output_path)


def review(spark: SparkSession, args: argparse.Namespace) -> None:
    """Log generated comments: the good ones, and the others with reasons."""
    generated = spark.read.schema(REVIEW_INPUT).json(args.generated_path, mode="FAILFAST")
    dated = generated.withColumn("datetime", F.coalesce("datetime", F.current_timestamp()))
    review_batch(dated, args.log_path, args.rejected_path or args.log_path.rstrip("/") + ".rejected")


def review_stream(spark: SparkSession, args: argparse.Namespace) -> None:
    """The same for files as they arrive."""
    stream = read_generated_stream(spark, args.generated_path)
    start_review_log(
        stream, args.log_path, args.rejected_path, args.checkpoint, available_now=args.available_now
    ).awaitTermination()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quipyard")
    commands = top.add_subparsers(required=True)

    def command(function, *paths: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(function.__name__, help=function.__doc__)
        sub.set_defaults(run=function)
        for path in paths:
            sub.add_argument(f"--{path}", required=True)
        return sub

    inputs = ("df_comments_path", "df_article_details_path", "output_path")
    command(build_sft_dataset, *inputs)
    command(build_dpo_dataset, *inputs)
    command(ingest_pages, "pages_path", "output_path")
    command(list_urls, "pages_path", "output_path").add_argument("--pattern")

    sft = command(prepare_sft, "dataset_name", "output_path")
    sft.add_argument("--pcu_value_threshold", type=int, default=0)
    sft.add_argument("--pcd_pcu_ratio_threshold", type=float, default=0.5)
    sft.add_argument("--article_word_threshold", type=int, default=2000)
    sft.add_argument("--seq_length", type=int, help="also pack into blocks of so many words")

    dpo = command(prepare_dpo, "dataset_name", "output_path")
    dpo.add_argument("--chosen_pcu_threshold", type=int, default=0)
    dpo.add_argument("--rejected_pcd_threshold", type=int, default=0)
    dpo.add_argument("--test_size", type=float, default=TEST_SHARE)
    dpo.add_argument("--seed", type=int, default=SEED)
    dpo.add_argument("--exact", action="store_true", help="exact size of the test part")

    choose = command(select_candidates, "archive_pages_path", *inputs, "username")
    choose.add_argument("--num_comments_desired", type=int, default=3)
    choose.add_argument("--pattern")

    run = command(bot, "archive_pages_path", *inputs, "username", "run_id", "log_path", "generator")
    run.add_argument("--num_comments_desired", type=int, default=3)
    run.add_argument("--pattern")

    chat = command(chat_requests, "df_article_details_path", "few_shot_path", "output_path")
    chat.add_argument("--model", default="chat-model")
    both = command(compare_generations, "df_article_details_path", "few_shot_path", "output_path", "first_generator", "second_generator")
    for sub in (chat, both):
        sub.add_argument("--num_shots", type=int, default=generation.CHAT_SHOTS)

    command(review, "generated_path", "log_path").add_argument("--rejected_path", help="default: LOG_PATH.rejected")
    live = command(review_stream, "generated_path", "log_path", "rejected_path", "checkpoint")
    live.add_argument("--available_now", action="store_true")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(build_session(), args)


if __name__ == "__main__":
    main()
