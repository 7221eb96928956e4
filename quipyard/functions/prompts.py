"""Prompt layouts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quipyard.functions.text import char_prefix, word_prefix, word_prefix_by_space

# Layout and wording that trained models expect.
INSTRUCTION_HEAD = "### Instruction:\n"
INPUT_HEAD = "\n\n### Input:\n"
RESPONSE_HEAD = "\n\n### Response:\n"
INSTRUCTION = "Use the article title and text below, to write the funniest possible comment about this article."
SUMMARY_HEAD = "### Article Summary:\n\n"
EXAMPLE_SUMMARY_HEAD = "### Article Summary: \n\n"
COMMENT_HEAD = "\n\n### Comment:\n\n"

# Our own wording; any other text can be passed as an argument.
CHAT_PREFIX = (
    "You take part in the comment section of an online magazine. "
    "Write the one reader comment on the given article that would earn the most upvotes.\n\n### Examples:\n\n"
)


def instruction_prompt(text: Column, instruction: str = INSTRUCTION) -> Column:
    """Prompt with an open response, the text taken as given."""
    return F.concat(F.lit(INSTRUCTION_HEAD + instruction + INPUT_HEAD), text, F.lit(RESPONSE_HEAD))


def preference_prompt(text: Column, instruction: str = INSTRUCTION, num_chars: int = 600) -> Column:
    return instruction_prompt(char_prefix(text, num_chars), instruction)


def training_text(
    text: Column, response: Column, instruction: str = INSTRUCTION, num_words: int = 2000
) -> Column:
    """Prompt and response of one supervised example."""
    prompt = instruction_prompt(word_prefix_by_space(text, num_words), instruction)
    return F.concat(prompt, response, F.lit("\n"))


def chat_user_prompt(text: Column) -> Column:
    return F.concat(F.lit(SUMMARY_HEAD), text, F.lit(COMMENT_HEAD))


def chat_system_prompt(few_shot: Column, prefix: str = CHAT_PREFIX) -> Column:
    return F.concat(F.lit(prefix + "\n\n"), few_shot)


def chat_messages(system: Column, user: Column) -> Column:
    """Array of (role, content), system first."""
    return F.array(
        F.struct(F.lit("system").alias("role"), system.alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")),
    )


def audit_text(system: Column, user: Column) -> Column:
    return F.concat(F.lit("System Prompt:\n"), system, F.lit("\n\nUser Prompt:\n"), user)


def example_block(text: Column, comment: Column, num_words: int = 300) -> Column:
    """One worked example of a few-shot prompt."""
    return F.concat(
        F.lit(EXAMPLE_SUMMARY_HEAD), word_prefix(text, num_words), F.lit(COMMENT_HEAD), comment, F.lit("\n\n")
    )
