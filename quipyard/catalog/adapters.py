"""The given tables seen as articles and comments, in Spark and in SQL.

Votes are pure functions of a row. The top comment shown with an article is its
first assistant turn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipyard.catalog.registry import Tables
from quipyard.functions.text import SPACES

# For SQL: character classes in RE2 syntax.
SPACE = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in SPACES) + "]"
BREAK = r"[\n-\r\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"

TITLE = "<title>([^<]*)</title>"
BODY = "(?s)<article>(.*)</article>"


def articles(t: Tables) -> DataFrame:
    body = F.regexp_extract("html", BODY, 1)
    return t["pages"].select(
        "page_id",
        "url",
        F.regexp_extract("html", TITLE, 1).alias("title"),
        F.regexp_replace(body, "<[^>]*>", " ").alias("article_text"),
    )


def comments(t: Tables) -> DataFrame:
    pages = t["pages"].select(F.col("page_id").alias("conv_id"), "url")
    return t["conversations"].join(pages, "conv_id").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("comment_id"),
        "url",
        F.col("role").alias("username"),
        F.col("text").alias("comment_text"),
        (F.length("text") % 101).cast("bigint").alias("pcu_value"),
        ((F.col("conv_id") * 7 + F.col("turn") * 13) % 37).alias("pcd_value"),
    )


def top_comments(t: Tables) -> DataFrame:
    return (
        comments(t)
        .where("username = 'assistant'")
        .groupBy("url")
        .agg(F.min_by("comment_text", "comment_id").alias("top_comment_text"))
    )


def details(t: Tables) -> DataFrame:
    return articles(t).join(top_comments(t), "url", "left")


def pages(t: Tables) -> DataFrame:
    """All captures taken as successful."""
    return t["pages"].withColumn("status_code", F.lit(200))


_CTES = f"""
articles AS (
  SELECT page_id, url, regexp_extract(html, '{TITLE}', 1) AS title,
         regexp_replace(regexp_extract(html, '{BODY}', 1), '<[^>]*>', ' ', 'g') AS article_text
  FROM pages),
comments AS (
  SELECT c.conv_id * 1000 + c.turn AS comment_id, a.url, c.role AS username, c.text AS comment_text,
         CAST(length(c.text) % 101 AS BIGINT) AS pcu_value, (c.conv_id * 7 + c.turn * 13) % 37 AS pcd_value
  FROM conversations c JOIN articles a ON a.page_id = c.conv_id),
details AS (
  SELECT a.*, f.comment_text AS top_comment_text
  FROM articles a LEFT JOIN (
    SELECT url, comment_text FROM comments WHERE username = 'assistant'
    QUALIFY row_number() OVER (PARTITION BY url ORDER BY comment_id) = 1) f USING (url))
"""


def sql(body: str, *ctes: str) -> str:
    """SQL over the views `articles`, `comments`, `details` and further ones."""
    return "WITH " + ",".join([_CTES, *ctes]) + body


def sql_strip(text: str) -> str:
    return f"regexp_replace({text}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def sql_words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{SPACE}+'), lambda w: w <> '')"


def sql_word_prefix(text: str, n: int = 300) -> str:
    return f"array_to_string({sql_words(text)}[1:{n}], ' ')"


def sql_lines(text: str) -> str:
    trimmed = f"list_transform(regexp_split_to_array({text}, '{BREAK}'), lambda l: {sql_strip('l')})"
    return f"array_to_string(list_filter({trimmed}, lambda l: l <> ''), chr(10))"


def sql_hash(key: str, seed: int, digits: int) -> str:
    return f"('0x' || substr(md5('{seed}:' || {key}), 1, {digits}))::BIGINT"


def sql_text(value: str) -> str:
    """Text as a SQL literal."""
    return "'" + value.replace("'", "''") + "'"


def sql_prompt(text: str) -> str:
    from quipyard.functions.prompts import INPUT_HEAD, INSTRUCTION, INSTRUCTION_HEAD, RESPONSE_HEAD

    return f"{sql_text(INSTRUCTION_HEAD + INSTRUCTION + INPUT_HEAD)} || {text} || {sql_text(RESPONSE_HEAD)}"


def sql_suitable(url: str = "url", title: str = "title", words=("video", "photo")) -> str:
    tests = [f"NOT contains({url}, '{w}') AND NOT contains(lower({title}), '{w}')" for w in words]
    return " AND ".join(tests)
