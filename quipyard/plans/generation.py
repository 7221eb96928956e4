"""Requests for text generation, and running a generator over partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipyard.functions.prompts import (
    CHAT_PREFIX,
    INSTRUCTION,
    audit_text,
    chat_messages,
    chat_system_prompt,
    chat_user_prompt,
    instruction_prompt,
)
from quipyard.functions.text import title_and_text, word_prefix
from quipyard.operators.batching import few_shot_block

Generator = Callable[[list[str], float, float], list[str]]

# Sampling settings of the tuned model and of the chat model.
TEMPERATURE, TOP_P = 0.5, 0.7
CHAT_TEMPERATURE, CHAT_TOP_P = 0.7, 0.9
CHAT_SHOTS = 3


def dry_run() -> Generator:
    """Stands in for a model: the last ten words of each prompt."""
    return lambda prompts, temperature, top_p: [" ".join(p.split()[-10:]) for p in prompts]


def generation_requests(articles: DataFrame, num_words: int = 300, instruction: str = INSTRUCTION) -> DataFrame:
    """(url, prompt) from the first words of title and text."""
    text = word_prefix(title_and_text(F.col("title"), F.col("article_text")), num_words)
    return articles.select("url", instruction_prompt(text, instruction).alias("prompt"))


def generate(
    requests: DataFrame,
    make_generator: Callable[[], Generator],
    temperature: float = TEMPERATURE,
    top_p: float = TOP_P,
    batch_size: int = 64,
    prompt: str = "prompt",
    comment: str = "comment",
) -> DataFrame:
    """Add a generated `comment` to every row; all other columns stay.

    `make_generator` runs once per task and returns a function
    `(prompts, temperature, top_p) -> comments`. Store the result before using it
    more than once (`quipyard.session.store`): a model may answer differently when
    a lost task runs again.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generator = make_generator()
        for batch in batches:
            for at in range(0, len(batch), batch_size):
                part = batch.iloc[at : at + batch_size]
                comments = generator(part[prompt].tolist(), temperature, top_p)
                if len(comments) != len(part):
                    raise ValueError(f"{len(part)} prompts but {len(comments)} comments")
                yield part.assign(**{comment: comments})

    schema = T.StructType([*requests.schema.fields, T.StructField(comment, T.StringType())])
    return requests.mapInPandas(run, schema)


def chat_requests(
    articles: DataFrame,
    examples: DataFrame,
    k: int = CHAT_SHOTS,
    model: str = "chat-model",
    temperature: float = CHAT_TEMPERATURE,
    top_p: float = CHAT_TOP_P,
    prefix: str = CHAT_PREFIX,
    num_words: int = 300,
) -> DataFrame:
    """One chat request per article.

    The few-shot block is a scalar subquery: one value, computed once.
    """
    few_shot = few_shot_block(examples, k).scalar()
    return with_chat_request(articles, few_shot, model, temperature, top_p, prefix, num_words)


def with_chat_request(
    articles: DataFrame,
    few_shot: Column,
    model: str = "chat-model",
    temperature: float = CHAT_TEMPERATURE,
    top_p: float = CHAT_TOP_P,
    prefix: str = CHAT_PREFIX,
    num_words: int = 300,
) -> DataFrame:
    """The same with a given few-shot text, such as the one of `read_few_shot_text`."""
    text = word_prefix(title_and_text(F.col("title"), F.col("article_text")), num_words)
    prompts = articles.select(
        "url",
        chat_system_prompt(few_shot, prefix).alias("system"),
        chat_user_prompt(text).alias("user"),
    )
    return prompts.select(
        "url",
        F.lit(model).alias("model"),
        F.lit(temperature).alias("temperature"),
        F.lit(top_p).alias("top_p"),
        chat_messages(F.col("system"), F.col("user")).alias("messages"),
        audit_text(F.col("system"), F.col("user")).alias("prompt"),
    )


def compare_generations(
    requests: DataFrame, make_first: Callable[[], Generator], make_second: Callable[[], Generator], **settings
) -> DataFrame:
    """Answers of two generators side by side, for rows with `first_prompt` and `second_prompt`.

    One generator after the other works on the same rows, so nothing has to be joined.
    """
    once = generate(requests, make_first, prompt="first_prompt", comment="first_comment", **settings)
    return generate(once, make_second, prompt="second_prompt", comment="second_comment", **settings)


def comparison_requests(articles: DataFrame, few_shot: Column, num_words: int = 300, **chat) -> DataFrame:
    """What a reader compares by: title, text, top comment, and the prompts of chat and tuned model."""
    text = word_prefix(title_and_text(F.col("title"), F.col("article_text")), num_words)
    shown = articles.select("url", "title", text.alias("title_article_text"), "top_comment_text")
    return shown.withColumns(
        {
            "first_prompt": audit_text(
                chat_system_prompt(few_shot, **chat), chat_user_prompt(F.col("title_article_text"))
            ),
            "second_prompt": instruction_prompt(F.col("title_article_text")),
        }
    )
