"""Text functions, prompts, requests and generations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipyard.catalog.adapters import (
    articles,
    comments,
    details,
    sql,
    sql_hash,
    sql_lines,
    sql_prompt,
    sql_strip,
    sql_text,
    sql_word_prefix,
    sql_words,
)
from quipyard.catalog.registry import Tables, query
from quipyard.functions import prompts, text
from quipyard.operators import batching, columns, filters, joins, packing, ranks, sampling, scores
from quipyard.plans import bot_run, candidates, generation, resumable, review
from quipyard.session import scratch_path
from quipyard.sources import tables
from quipyard.streaming.review_log import REJECTED_LOG

_TITLE_TEXT = "title || ' ' || article_text"


def _documents(t: Tables, **exprs) -> DataFrame:
    return t["documents"].select("doc_id", *[e.alias(n) for n, e in exprs.items()])


@query(sql(f"SELECT page_id, {_TITLE_TEXT} AS title_article_text FROM articles"))
def title_article_text(t):
    joined = text.title_and_text(F.col("title"), F.col("article_text"))
    return articles(t).select("page_id", joined.alias("title_article_text"))


@query("SELECT doc_id, substr(text, 1, 600) AS prefix FROM documents")
def char_prefix(t):
    return _documents(t, prefix=text.char_prefix(F.col("text")))


@query("SELECT doc_id, array_to_string(string_split(text, ' ')[1:200], ' ') AS prefix FROM documents")
def word_prefix_space(t):
    return _documents(t, prefix=text.word_prefix_by_space(F.col("text"), 200))


@query(f"SELECT doc_id, array_to_string(string_split({sql_strip('text')}, ' ')[1:300], ' ') AS prefix FROM documents")
def word_prefix_space_trim(t):
    return _documents(t, prefix=text.word_prefix_by_space_stripped(F.col("text")))


@query(f"SELECT doc_id, {sql_word_prefix('text')} AS prefix FROM documents")
def word_prefix_ws(t):
    return _documents(t, prefix=text.word_prefix(F.col("text")))


@query(f"SELECT doc_id, len({sql_words('text')}) AS n_words FROM documents")
def word_count(t):
    return _documents(t, n_words=text.word_count(F.col("text")))


@query(f"SELECT doc_id, {sql_lines('text')} AS text FROM documents")
def normalize_lines(t):
    return _documents(t, text=text.normalize_lines(F.col("text")))


@query("""
SELECT doc_id, unnest(list_filter(string_split(text, chr(10)), lambda p: p <> '')) AS paragraph FROM documents""")
def paragraphs(t):
    return _documents(t, paragraph=F.explode(text.paragraphs(F.col("text"))))


@query("SELECT doc_id, decode(from_base64(to_base64(encode(text)))) AS text FROM documents")
def base64_decode(t):
    return _documents(t, text=text.decode_base64(F.base64(F.encode("text", "UTF-8"))))


@query(sql("SELECT page_id, nullif(coalesce(top_comment_text, 'N/A'), 'N/A') AS top_comment_text, url FROM details"))
def sentinel_to_null(t):
    filled = details(t).select("page_id", "url", F.coalesce("top_comment_text", F.lit("N/A")).alias("top_comment_text"))
    return columns.sentinel_to_null(filled)


@query(sql("SELECT * FROM details WHERE top_comment_text IS NOT NULL"))
def drop_any_null(t):
    return columns.drop_any_null(details(t))


@query(sql("SELECT page_id, top_comment_text FROM details WHERE top_comment_text IS NOT NULL"))
def drop_subset_null(t):
    return columns.drop_null_in(details(t), ["top_comment_text"]).select("page_id", "top_comment_text")


@query("SELECT doc_id, lang AS text_language, n_chars AS number_of_chars FROM documents")
def normalize_columns(t):
    named = t["documents"].select(
        F.col("doc_id").alias("Doc ID"),
        F.col("lang").alias("Text Language"),
        F.col("n_chars").alias("Number of Chars"),
    )
    return columns.normalize_columns(named)


_PROMPT = sql_prompt(sql_word_prefix(_TITLE_TEXT))


@query(sql(f"""
SELECT page_id, {sql_prompt("array_to_string(string_split(" + _TITLE_TEXT + ", ' ')[1:2000], ' ')")}
  || top_comment_text || chr(10) AS text FROM details WHERE top_comment_text IS NOT NULL"""))
def format_sft(t):
    joined = text.title_and_text(F.col("title"), F.col("article_text"))
    formatted = prompts.training_text(joined, F.col("top_comment_text"))
    return details(t).select("page_id", formatted.alias("text")).where("text IS NOT NULL")


@query(sql(f"SELECT page_id, {sql_prompt(f'substr({_TITLE_TEXT}, 1, 600)')} AS prompt FROM articles"))
def format_dpo_prompt(t):
    joined = text.title_and_text(F.col("title"), F.col("article_text"))
    return articles(t).select("page_id", prompts.preference_prompt(joined).alias("prompt"))


@query(sql(f"SELECT page_id, {sql_prompt(_TITLE_TEXT)} AS prompt FROM articles"))
def format_inference_prompt(t):
    joined = text.title_and_text(F.col("title"), F.col("article_text"))
    return articles(t).select("page_id", prompts.instruction_prompt(joined).alias("prompt"))


def examples(t: Tables) -> DataFrame:
    """Articles with a top comment, in page order."""
    joined = text.title_and_text(F.col("title"), F.col("article_text"), ": ")
    return (
        details(t)
        .where("top_comment_text IS NOT NULL")
        .select(
            F.col("page_id").alias("position"),
            joined.alias("title_article_text"),
            F.col("top_comment_text").alias("comment"),
        )
    )


def _few_shot_cte(k: int) -> str:
    block = (
        f"{sql_text(prompts.EXAMPLE_SUMMARY_HEAD)} || {sql_word_prefix('x')} || {sql_text(prompts.COMMENT_HEAD)}"
        " || top_comment_text || chr(10) || chr(10)"
    )
    return f"""
few_shot AS (
  SELECT string_agg({block}, '' ORDER BY page_id) AS few_shot
  FROM (SELECT page_id, title || ': ' || article_text AS x, top_comment_text FROM details
        WHERE top_comment_text IS NOT NULL ORDER BY page_id LIMIT {k}))"""


@query(sql("SELECT few_shot FROM few_shot", _few_shot_cte(5)))
def few_shot_block(t):
    return batching.few_shot_block(examples(t), 5)


_SYSTEM = f"{sql_text(prompts.CHAT_PREFIX)} || chr(10) || chr(10) || few_shot"
_USER = f"{sql_text(prompts.SUMMARY_HEAD)} || {sql_word_prefix(_TITLE_TEXT)} || {sql_text(prompts.COMMENT_HEAD)}"


@query(sql(f"SELECT {_SYSTEM} AS system_prompt FROM few_shot", _few_shot_cte(3)))
def chat_system_prompt(t):
    few_shot = batching.few_shot_block(examples(t), 3)
    return few_shot.select(prompts.chat_system_prompt(F.col("few_shot")).alias("system_prompt"))


@query(sql(f"SELECT page_id, {_USER} AS user_prompt FROM articles"))
def chat_user_prompt(t):
    shortened = text.word_prefix(text.title_and_text(F.col("title"), F.col("article_text")))
    return articles(t).select("page_id", prompts.chat_user_prompt(shortened).alias("user_prompt"))


@query("""
SELECT doc_id,
       CAST(to_json([{'role': 'system', 'content': lang}, {'role': 'user', 'content': text}]) AS VARCHAR) AS messages,
       'System Prompt:' || chr(10) || lang || chr(10) || chr(10) || 'User Prompt:' || chr(10) || text AS audit
FROM documents""")
def chat_messages(t):
    system, user = F.col("lang"), F.col("text")
    messages = F.to_json(prompts.chat_messages(system, user))
    return _documents(t, messages=messages, audit=prompts.audit_text(system, user))


@query(sql(f"""
SELECT url, 'chat-model' AS model, CAST(0.7 AS DOUBLE) AS temperature, CAST(0.9 AS DOUBLE) AS top_p,
       {_SYSTEM} AS system, {_USER} AS user FROM articles, few_shot""", _few_shot_cte(3)))
def chat_requests(t):
    requests = generation.chat_requests(articles(t), examples(t))
    return requests.select(
        "url",
        "model",
        "temperature",
        "top_p",
        F.col("messages")[0]["content"].alias("system"),
        F.col("messages")[1]["content"].alias("user"),
    )


@query(sql(f"""
SELECT page_id // 16 AS batch_id,
       CAST(to_json({{'list_of_title_article_text': list({sql_word_prefix(_TITLE_TEXT)} ORDER BY page_id)}})
            AS VARCHAR) AS body,
       CAST(0.5 AS DOUBLE) AS temperature, CAST(0.7 AS DOUBLE) AS top_p
FROM articles GROUP BY 1"""))
def request_batches(t):
    shortened = text.word_prefix(text.title_and_text(F.col("title"), F.col("article_text")))
    batches = batching.request_batches(articles(t), shortened, "page_id", 16)
    body = F.to_json(F.struct("list_of_title_article_text"))
    return batches.select("batch_id", body.alias("body"), "temperature", "top_p")


@query(sql("""
SELECT url, p / 10 AS top_p, c / 10 AS temperature
FROM articles, (SELECT unnest([9, 10, 11]) AS p), (SELECT unnest([10, 11]) AS c)"""))
def sampling_grid(t):
    return batching.with_settings_grid(t["pages"].select("url"))


@query("""
SELECT page_id, generate_subscripts(l, 1) - 1 AS position, unnest(l) AS link
FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages)""")
def flatten_results(t):
    lists = t["pages"].select("page_id", F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1).alias("link"))
    return columns.flatten_results(lists, "link", "position").withColumn("position", F.col("position").cast("bigint"))


@query(sql("SELECT page_id // 16 AS batch_id, url, title AS comment FROM articles"))
def zip_generations(t):
    answers = batching.request_batches(articles(t), F.struct("url", "title"), "page_id", 16).select(
        "batch_id",
        F.col("list_of_title_article_text.url").alias("url"),
        F.col("list_of_title_article_text.title").alias("comment"),
    )
    return columns.zip_results(answers, "url", "comment")


_UNCOMMENTED = "url NOT IN (SELECT url FROM comments WHERE username = 'assistant')"


@query(sql("SELECT page_id, url FROM articles WHERE url NOT IN (SELECT url FROM comments WHERE username = 'system')"))
def uncommented_articles(t):
    return joins.uncommented_articles(t["pages"].select("page_id", "url"), comments(t), "system")


@query(sql("""
SELECT (SELECT count(*) FROM comments WHERE username = 'assistant') AS commented,
       (SELECT count(*) FROM articles) AS total"""))
def candidate_counts(t):
    return joins.candidate_counts(t["pages"].select("url"), comments(t), "assistant")


@query("SELECT page_id, url FROM pages WHERE NOT contains(url, 'ref=') AND NOT contains(url, '/en/')")
def filter_candidates(t):
    return filters.filter_candidates(t["pages"].select("page_id", "url"), ("ref=", "/en/"))


@query("SELECT page_id, url FROM pages ORDER BY page_id LIMIT 3")
def first_n_candidates(t):
    return sampling.first_n(t["pages"].select("page_id", "url"), "page_id")


@query(sql(f"""
SELECT page_id, url, {_TITLE_TEXT} AS title_article_text FROM articles
WHERE {_UNCOMMENTED} AND NOT contains(url, 'ref=') ORDER BY page_id LIMIT 25"""))
def select_candidates(t):
    return candidates.select_candidates(articles(t), comments(t), "assistant", 25, "page_id", excluded=("ref=",))


@query("SELECT page_id, url, CAST(ntile(8) OVER (ORDER BY page_id) AS INTEGER) AS chunk FROM pages")
def chunk_assign(t):
    return ranks.assign_chunks(t["pages"].select("page_id", "url"), "page_id")


_N_WORDS = f"len({sql_words('text')})"
SQL_BAD = f"""(contains(text, '###') OR contains(text, 'funniest') OR contains(text, '```')
  OR {_N_WORDS} < 5 OR {_N_WORDS} > 300)"""
_REASONS = f"""array_to_string(list_filter([
  CASE WHEN contains(text, '###') THEN 'contains ###' END,
  CASE WHEN contains(text, 'funniest') THEN 'contains funniest' END,
  CASE WHEN contains(text, '```') THEN 'contains ```' END,
  CASE WHEN {_N_WORDS} < 5 THEN 'too short' END,
  CASE WHEN {_N_WORDS} > 300 THEN 'too long' END], lambda r: r IS NOT NULL), '; ')"""


@query(f"SELECT doc_id, {SQL_BAD} AS is_problem FROM documents")
def generation_check(t):
    return _documents(t, is_problem=filters.is_problem_comment(F.col("text")))


@query(f"SELECT doc_id, NOT {SQL_BAD} AS accepted, {_REASONS} AS reasons FROM documents")
def review_generations(t):
    generated = t["documents"].select("doc_id", F.col("text").alias("comment"))
    accepted, rejected = review.review_generations(generated)
    return accepted.select("doc_id", F.lit(True).alias("accepted"), F.lit("").alias("reasons")).union(
        rejected.select("doc_id", F.lit(False), F.array_join("reasons", "; "))
    )


_ISO = "regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '\\.000000$', '')"


@query(f"""
SELECT event_id AS comment_id, CAST(to_json({{'comment_id': event_id, 'url': event_type, 'comment': props,
  'datetime': {_ISO}}}) AS VARCHAR) AS json FROM events""")
def log_json(t):
    posted = t["events"].select(
        F.col("event_id").alias("comment_id"),
        F.col("event_type").alias("url"),
        F.col("props").alias("comment"),
        "ts",
    )
    return review.log_json(review.log_records(posted, F.col("ts")))


def _token_scores(t: Tables) -> DataFrame:
    return t["events"].select(
        F.col("user_id").alias("generation_id"),
        F.col("event_id").alias("pos"),
        (-F.col("value") / 100).alias("logprob"),
    )


@query("""
SELECT user_id AS generation_id, event_id AS pos, round(exp(-value / 100), 9) AS probability,
       printf('%.2f%%', exp(-value / 100) * 100) AS percent FROM events""")
def token_probability(t):
    scored = scores.with_token_probability(_token_scores(t))
    return scored.select("generation_id", "pos", F.round("probability", 9).alias("probability"), "percent")


@query("""
SELECT user_id AS generation_id, round(avg(exp(-value / 100)), 9) AS mean_probability, count(*) AS tokens
FROM events GROUP BY 1""")
def mean_token_probability(t):
    means = scores.mean_token_probability(_token_scores(t))
    return means.withColumn("mean_probability", F.round("mean_probability", 9))


def _answer_with_length() -> Callable:
    return lambda batch, temperature, top_p: [f"{len(p)} characters at {temperature}/{top_p}" for p in batch]


def _answer_with_end() -> Callable:
    return lambda batch, temperature, top_p: [p[-60:] for p in batch]


_LENGTH_ANSWER = "length(prompt) || ' characters at 0.5/0.7'"
_GENERATED = f"generated AS (SELECT url, {_PROMPT} AS prompt FROM articles)"


@query(sql(f"SELECT url, prompt, {_LENGTH_ANSWER} AS comment FROM generated", _GENERATED))
def generate_batch(t):
    return generation.generate(generation.generation_requests(articles(t)), _answer_with_length)


@query(sql(f"SELECT url, prompt, {_LENGTH_ANSWER} AS comment FROM generated", _GENERATED))
def generate_resumed(t):
    """A first run answers the requests for some articles, a second one goes on with all."""
    requests, path = generation.generation_requests(articles(t)), scratch_path(t.spark, "answers")
    some = requests.where(F.xxhash64("url") % 2 == 0)
    for part in (some, requests):
        found = resumable.generate_resumable(part, _answer_with_length, path)
    return found.answered.select("url", "prompt", "comment")


def _answer_of_six_words() -> Callable:
    def answer(batch, temperature, top_p):
        return ["too short" if len(p) % 3 == 0 else f"{len(p)} characters are in this prompt" for p in batch]

    return answer


@query(sql(f"""
SELECT url, CASE WHEN length(prompt) % 3 = 0 THEN 'too short' ELSE length(prompt) || ' characters are in this prompt' END AS comment,
       length(prompt) % 3 <> 0 AS accepted
FROM (SELECT url, {sql_prompt(sql_word_prefix('title_article_text'))} AS prompt
      FROM (SELECT page_id, url, {_TITLE_TEXT} AS title_article_text FROM articles
            WHERE {_UNCOMMENTED} AND NOT contains(url, 'ref=') ORDER BY page_id LIMIT 25))"""))
def bot_flow(t):
    """A whole run, called twice: the second call finds everything done."""
    path = scratch_path(t.spark, "run")
    for _ in range(2):
        bot_run.run_bot(
            articles(t), comments(t), "assistant", _answer_of_six_words, path, "run-1", path + ".log",
            n=25, position="page_id", excluded=("ref=",),
        )
    kept = tables.read_comment_log(t.spark, path + ".log").withColumn("accepted", F.lit(True))
    rejected = tables.read_log(t.spark, path + ".log.rejected", REJECTED_LOG).withColumn("accepted", F.lit(False))
    return kept.unionByName(rejected.drop("reasons")).select("url", "comment", "accepted")


_SHORT = sql_word_prefix(_TITLE_TEXT)


@query(sql(f"""
SELECT url, title, {_SHORT} AS title_article_text, top_comment_text,
       length(first_prompt) || ' characters at 0.5/0.7' AS first_comment, first_prompt,
       right(second_prompt, 60) AS second_comment, second_prompt
FROM (SELECT *, 'System Prompt:' || chr(10) || {_SYSTEM} || chr(10) || chr(10) || 'User Prompt:' || chr(10) || {_USER}
        AS first_prompt, {_PROMPT} AS second_prompt FROM details, few_shot)""", _few_shot_cte(3)))
def compare_generations(t):
    few_shot = batching.few_shot_block(examples(t), 3).scalar()
    requests = generation.comparison_requests(details(t), few_shot)
    return generation.compare_generations(requests, _answer_with_length, _answer_with_end)


@query(f"""
WITH texts AS (SELECT doc_id, {sql_hash('doc_id', 42, 8)} AS h, list_append({sql_words('text')}, '</s>') AS tokens
               FROM documents),
placed AS (SELECT tokens, sum(len(tokens)) OVER (ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) - len(tokens) AS start
           FROM texts),
stream AS (SELECT start + generate_subscripts(tokens, 1) - 1 AS pos, unnest(tokens) AS token FROM placed)
SELECT CAST(pos // 256 AS BIGINT) AS block_id, count(*) AS n_tokens, string_agg(token, ' ' ORDER BY pos) AS text
FROM stream GROUP BY 1 HAVING count(*) = 256""")
def pack_sequences(t):
    blocks = packing.pack_sequences(t["documents"], "doc_id", "text", 256)
    n_tokens = F.size("tokens").cast("bigint")
    return blocks.select("block_id", n_tokens.alias("n_tokens"), F.array_join("tokens", " ").alias("text"))
