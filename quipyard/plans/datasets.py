"""The two training sets, and their preparation for a trainer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quipyard.functions.prompts import INSTRUCTION, preference_prompt, training_text
from quipyard.functions.text import title_and_text
from quipyard.operators.columns import drop_null_in, select_renamed
from quipyard.operators.filters import (
    EXCLUDED_WORDS,
    dpo_votes_ok,
    filter_articles,
    observed_filter,
    sft_votes_ok,
)
from quipyard.operators.joins import spread_join, top_comment_matches
from quipyard.operators.packing import pack_sequences
from quipyard.operators.ranking import top_worst_pairs
from quipyard.operators.sampling import SEED, TEST_SHARE, train_test_split


def build_sft_dataset(
    comments: DataFrame,
    details: DataFrame,
    separator: str = " ",
    excluded: Sequence[str] = EXCLUDED_WORDS,
    salting: dict | None = None,
) -> DataFrame:
    """Articles with the comment that the article page shows as its top comment.

    Unsuitable articles go before the join, so their comments find no partner.
    """
    matched = top_comment_matches(comments, filter_articles(details, excluded), **(salting or {}))
    return matched.withColumn("title_article_text", title_and_text(F.col("title"), F.col("article_text"), separator))


def article_prompts(
    articles: DataFrame,
    separator: str = " ",
    excluded: Sequence[str] = EXCLUDED_WORDS,
    instruction: str = INSTRUCTION,
    num_chars: int = 600,
) -> DataFrame:
    """The articles that suit, with `prompt` in place of title and text."""
    text = title_and_text(F.col("title"), F.col("article_text"), separator)
    prompt = preference_prompt(text, instruction, num_chars)
    return filter_articles(articles, excluded).withColumn("prompt", prompt).drop("title", "article_text")


def build_dpo_dataset(
    comments: DataFrame,
    details: DataFrame,
    top_comments: DataFrame | None = None,
    salting: dict | None = None,
    **prompt_options,
) -> DataFrame:
    """Preference pairs, one per article.

    `chosen` is the top comment shown on the article page, while `chosen_pcu` and
    `chosen_pcd` belong to the comment with most up votes; the two may differ.
    Pairs with equal texts stay in. The shown comments may be a table of their own
    (url, top_comment_text) with one row per url.
    """
    pairs = top_worst_pairs(comments, ["comment_text", "pcu_value", "pcd_value"])
    articles = article_prompts(details, **prompt_options)
    if top_comments is None:
        articles = drop_null_in(articles.select("url", "prompt", "top_comment_text"), ["prompt", "top_comment_text"])
    else:
        articles = articles.select("url", "prompt")
        pairs = pairs.join(top_comments, "url")
    dataset = select_renamed(
        # One pair per url, but an article may have been captured many times.
        spread_join(articles, pairs, "url", counted=details, **(salting or {})),
        {
            "prompt": "prompt",
            "chosen": "top_comment_text",
            "rejected": "comment_text_worst",
            "url": "url",
            "chosen_pcu": "pcu_value_top",
            "rejected_pcu": "pcu_value_worst",
            "chosen_pcd": "pcd_value_top",
            "rejected_pcd": "pcd_value_worst",
        },
    )
    return drop_null_in(dataset, ["prompt", "chosen", "rejected"])


def prepare_sft(
    dataset: DataFrame,
    min_up: int = 0,
    max_ratio: float = 0.5,
    num_words: int = 2000,
    instruction: str = INSTRUCTION,
) -> tuple[DataFrame, Observation]:
    """Filter by votes and add the training text; also the counts before and after."""
    keep = sft_votes_ok(F.col("pcu_value"), F.col("pcd_value"), min_up, max_ratio)
    kept, counts = observed_filter(dataset, keep, "sft_vote_filter")
    text = training_text(F.col("title_article_text"), F.col("top_comment_text"), instruction, num_words)
    return kept.withColumn("text", text), counts


def pack_sft(prepared: DataFrame, length: int = 4096, key: str = "comment_id", **options) -> DataFrame:
    """Training texts packed into blocks of equal length."""
    return pack_sequences(prepared, key, "text", length, **options)


def filter_dpo(dataset: DataFrame, min_up: int = 0, min_down: int = 0) -> tuple[DataFrame, Observation]:
    """Filter by votes; also the counts before and after."""
    keep = dpo_votes_ok(F.col("chosen_pcu"), F.col("rejected_pcd"), min_up, min_down)
    return observed_filter(dataset, keep, "dpo_vote_filter")


def prepare_dpo(
    dataset: DataFrame,
    min_up: int = 0,
    min_down: int = 0,
    share: float = TEST_SHARE,
    seed: int = SEED,
    exact: bool = False,
    keep_votes: bool = True,
) -> tuple[DataFrame, DataFrame, Observation]:
    """Filter by votes and split: (train, test, counts before and after)."""
    kept, counts = filter_dpo(dataset, min_up, min_down)
    train, test = train_test_split(kept, "url", share, seed, exact)
    if not keep_votes:
        train, test = (part.select("prompt", "chosen", "rejected") for part in (train, test))
    return train, test, counts
