"""Row filters and predicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quipyard.functions.text import words
from quipyard.functions.votes import vote_ratio

# Words that mark articles without enough text.
EXCLUDED_WORDS = ("video", "photo")
# Traces of a bad generation, and the accepted word range.
ARTIFACTS = ("###", "funniest", "```")
MIN_WORDS = 5
MAX_WORDS = 300


def _contains_none(text: Column, excluded: Sequence[str]) -> Column:
    """Null for a null text, also without words."""
    return reduce(lambda a, b: a & b, [~text.contains(w) for w in excluded], F.when(text.isNotNull(), True))


def suitable_article(url: Column, title: Column, excluded: Sequence[str] = EXCLUDED_WORDS) -> Column:
    """Neither the url (case-sensitive) nor the title (any case) holds an excluded word.

    Null for a null url or title, so `where` drops such rows.
    """
    return _contains_none(url, excluded) & _contains_none(F.lower(title), excluded)


def filter_articles(df: DataFrame, excluded: Sequence[str] = EXCLUDED_WORDS) -> DataFrame:
    return df.where(suitable_article(F.col("url"), F.col("title"), excluded))


def filter_candidates(df: DataFrame, excluded: Sequence[str] = EXCLUDED_WORDS) -> DataFrame:
    """By url alone, case-sensitive."""
    return df.where(_contains_none(F.col("url"), excluded))


def sft_votes_ok(
    up: Column, down: Column, min_up: int = 0, max_ratio: float = 0.5
) -> Column:
    """More than `min_up` up votes and a down/up ratio below `max_ratio`, both strict."""
    return (up > min_up) & (vote_ratio(up, down) < max_ratio)


def dpo_votes_ok(chosen_up: Column, rejected_down: Column, min_up: int = 0, min_down: int = 0) -> Column:
    """Both thresholds inclusive."""
    return (chosen_up >= min_up) & (rejected_down >= min_down)


def sft_vote_filter(df: DataFrame, min_up: int = 0, max_ratio: float = 0.5) -> DataFrame:
    return df.where(sft_votes_ok(F.col("pcu_value"), F.col("pcd_value"), min_up, max_ratio))


def dpo_vote_filter(df: DataFrame, min_up: int = 0, min_down: int = 0) -> DataFrame:
    return df.where(dpo_votes_ok(F.col("chosen_pcu"), F.col("rejected_pcd"), min_up, min_down))


def by_user(comments: DataFrame, username: str) -> DataFrame:
    return comments.where(F.col("username") == username)


def comment_id_contains(comments: DataFrame, pattern: str, regex: bool = True) -> DataFrame:
    """Comments whose id holds a pattern (regular expression unless `regex` is off)."""
    comment_id = F.col("comment_id").cast("string")
    return comments.where(comment_id.rlike(pattern) if regex else comment_id.contains(pattern))


def article_url_pattern(prefix: str, suffix: str = ".html") -> str:
    """Anchored pattern: prefix, anything on one line, suffix."""
    return rf"(?d)^\Q{prefix}\E.*\Q{suffix}\E$"


def matches_url(url: Column, pattern: str) -> Column:
    return url.rlike(pattern)


def _words_seen(comment: Column) -> Column:
    """Number of words, counted no further than one beyond the most."""
    return F.size(words(comment, MAX_WORDS + 1))


def generation_problems(comment: Column) -> Column:
    """Names of all problems of a generated comment; an empty array if it is fine."""
    n = _words_seen(comment)
    found = [F.when(comment.contains(a), F.lit(f"contains {a}")) for a in ARTIFACTS]
    found += [
        F.when(n < MIN_WORDS, F.lit("too short")),
        F.when(n > MAX_WORDS, F.lit("too long")),
        F.when(comment.isNull(), F.lit("missing")),
    ]
    return F.array_compact(F.array(*found))


def is_problem_comment(comment: Column) -> Column:
    """True for a comment that must not be used; a missing one counts as such."""
    n = _words_seen(comment)
    bad = reduce(lambda a, b: a | b, [comment.contains(a) for a in ARTIFACTS])
    return F.coalesce(bad | (n < MIN_WORDS) | (n > MAX_WORDS), F.lit(True))


def observed_filter(df: DataFrame, keep: Column, name: str) -> tuple[DataFrame, Observation]:
    """Filter and count rows before and after in the same pass.

    The counts are in the observation once an action has run on the result.
    """
    seen = Observation(name)
    counted = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(keep).alias("rows_after"),
    )
    return counted.where(keep), seen


def filter_counts(df: DataFrame, keep: Column) -> DataFrame:
    """The same counts as a one-row table."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(keep).alias("rows_after"),
    )
