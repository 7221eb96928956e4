"""Picks per article, vote filters and the training sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipyard.catalog.adapters import (
    articles,
    comments,
    details,
    sql,
    sql_hash,
    sql_prompt,
    sql_suitable,
    top_comments,
)
from quipyard.catalog.registry import Tables, query
from quipyard.functions import votes
from quipyard.functions.prompts import INPUT_HEAD, INSTRUCTION, INSTRUCTION_HEAD, RESPONSE_HEAD
from quipyard.operators import filters, joins, ranking, sampling
from quipyard.plans import datasets

# The given urls hold neither default word; this one keeps the filter at work.
EXCLUDED = ("video", "photo", "ref=")

_TOP = """
top AS (SELECT * FROM comments WHERE url IS NOT NULL QUALIFY row_number() OVER (
  PARTITION BY url ORDER BY pcu_value DESC NULLS LAST, comment_id) = 1)"""
_WORST = """
worst AS (SELECT *, pcu_value - pcd_value AS delta FROM comments WHERE url IS NOT NULL QUALIFY row_number() OVER (
  PARTITION BY url ORDER BY pcu_value - pcd_value NULLS LAST, pcu_value NULLS LAST, comment_id) = 1)"""
_DPO = f"""
dpo AS (
  SELECT {sql_prompt("substr(d.title || ' ' || d.article_text, 1, 600)")} AS prompt,
         d.top_comment_text AS chosen, w.comment_text AS rejected, d.url AS url,
         t.pcu_value AS chosen_pcu, w.pcu_value AS rejected_pcu,
         t.pcd_value AS chosen_pcd, w.pcd_value AS rejected_pcd
  FROM top t JOIN worst w USING (url) JOIN details d USING (url)
  WHERE {sql_suitable("d.url", "d.title", EXCLUDED)}
    AND d.title || d.article_text IS NOT NULL AND d.top_comment_text IS NOT NULL AND w.comment_text IS NOT NULL)"""
_SFT = f"""
sft AS (
  SELECT c.*, d.title, d.article_text, d.top_comment_text, d.title || ' ' || d.article_text AS title_article_text
  FROM comments c JOIN details d ON c.url = d.url AND c.comment_text = d.top_comment_text
  WHERE {sql_suitable("d.url", "d.title", EXCLUDED)})"""
DPO_CTES = (_TOP, _WORST, _DPO)


def dpo_dataset(t: Tables) -> DataFrame:
    return datasets.build_dpo_dataset(comments(t), articles(t), top_comments(t), excluded=EXCLUDED)


def sft_dataset(t: Tables) -> DataFrame:
    return datasets.build_sft_dataset(comments(t), details(t), excluded=EXCLUDED)


@query(sql("SELECT * FROM dpo", *DPO_CTES))
def build_dpo_dataset(t):
    return dpo_dataset(t)


@query(sql("SELECT * FROM dpo", *DPO_CTES))
def build_dpo_dataset_default(t):
    """With the shown comment inside `details`, as the command line has it."""
    return datasets.build_dpo_dataset(comments(t), details(t), excluded=EXCLUDED)


@query(sql("SELECT * FROM sft", _SFT))
def build_sft_dataset(t):
    return sft_dataset(t)


@query(sql("SELECT * FROM top", _TOP))
def top_comment(t):
    return ranking.top_comment(comments(t))


@query(sql("SELECT * FROM worst", _WORST))
def worst_comment(t):
    return ranking.worst_comment(comments(t))


_PAIR = """
SELECT url, t.comment_id AS comment_id_top, w.comment_id AS comment_id_worst,
       t.comment_text AS comment_text_top, w.comment_text AS comment_text_worst,
       t.pcu_value AS pcu_value_top, w.pcu_value AS pcu_value_worst,
       t.pcd_value AS pcd_value_top, w.pcd_value AS pcd_value_worst
FROM top t JOIN worst w USING (url)"""


@query(sql(_PAIR, _TOP, _WORST))
def top_worst_pair(t):
    return ranking.top_worst_pairs(comments(t))


@query(sql(_PAIR, _TOP, _WORST))
def top_worst_pair_by_window(t):
    return ranking.top_worst_pairs_by_window(comments(t))


_LINE_TIE = "l_linenumber, l_partkey, l_suppkey, l_extendedprice"


@query(f"""
WITH lines AS (
  SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS up, CAST(l_linenumber AS BIGINT) AS down,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, {_LINE_TIE}) AS best,
         row_number() OVER (PARTITION BY l_orderkey
                            ORDER BY l_quantity - l_linenumber, l_quantity, {_LINE_TIE}) AS worst
  FROM lineitem)
SELECT a.l_orderkey AS url, a.up AS pcu_value_top, b.up AS pcu_value_worst,
       a.down AS pcd_value_top, b.down AS pcd_value_worst
FROM lines a JOIN lines b USING (l_orderkey) WHERE a.best = 1 AND b.worst = 1""")
def top_worst_pair_lineitem(t):
    lines = t["lineitem"].select(
        F.col("l_orderkey").alias("url"),
        F.col("l_quantity").cast("bigint").alias("pcu_value"),
        F.col("l_linenumber").cast("bigint").alias("pcd_value"),
        F.struct(*_LINE_TIE.split(", ")).alias("comment_id"),
    )
    return ranking.top_worst_pairs(lines, ["pcu_value", "pcd_value"])


@query(sql("""
SELECT * EXCLUDE (position) FROM (SELECT *, comment_id % 1000 AS position FROM comments)
WHERE username = 'user' QUALIFY row_number() OVER (PARTITION BY url ORDER BY position) = 1"""))
def first_user_comment(t):
    placed = comments(t).withColumn("position", F.col("comment_id") % 1000)
    return ranking.first_user_comment(placed, "user").drop("position")


@query(sql("SELECT comment_id, pcu_value - pcd_value AS delta FROM comments"))
def net_votes(t):
    return comments(t).select("comment_id", votes.net_votes(F.col("pcu_value"), F.col("pcd_value")).alias("delta"))


_VOTE_TEXT = """CASE WHEN pcd_value > 30 THEN 'votes: ' || pcu_value WHEN pcd_value > 20 THEN pcu_value || '.0'
  WHEN pcd_value > 10 THEN ' ' || pcu_value || chr(10) ELSE CAST(pcu_value AS STRING) END"""


@query(sql("SELECT comment_id, CASE WHEN pcd_value <= 30 THEN pcu_value END AS pcu_value FROM comments"))
def parse_votes(t):
    cells = comments(t).select("comment_id", F.expr(_VOTE_TEXT).alias("cell"))
    return cells.select("comment_id", votes.parse_votes(F.col("cell")).alias("pcu_value"))


@query(sql(f"SELECT page_id, url, title FROM articles WHERE {sql_suitable(words=('video', 'photo', 'ref=', 'the'))}"))
def filter_articles(t):
    return filters.filter_articles(articles(t), ("video", "photo", "ref=", "the")).select("page_id", "url", "title")


_SFT_OK = "pcu_value > 10 AND pcu_value <> 0 AND pcd_value / pcu_value < 0.4"
_DPO_OK = "chosen_pcu >= 50 AND rejected_pcd >= 10"


@query(sql(f"SELECT comment_id, pcu_value, pcd_value FROM comments WHERE {_SFT_OK}"))
def sft_vote_filter(t):
    return filters.sft_vote_filter(comments(t), 10, 0.4).select("comment_id", "pcu_value", "pcd_value")


@query(sql(f"SELECT url, chosen_pcu, rejected_pcd FROM dpo WHERE {_DPO_OK}", *DPO_CTES))
def dpo_vote_filter(t):
    return filters.dpo_vote_filter(dpo_dataset(t), 50, 10).select("url", "chosen_pcu", "rejected_pcd")


@query(sql(f"SELECT count(*) AS rows_before, count(*) FILTER ({_SFT_OK}) AS rows_after FROM comments"))
def filter_counts(t):
    keep = filters.sft_votes_ok(F.col("pcu_value"), F.col("pcd_value"), 10, 0.4)
    return filters.filter_counts(comments(t), keep)


@query(sql("SELECT * FROM comments WHERE username = 'assistant'"))
def by_user(t):
    return filters.by_user(comments(t), "assistant")


@query(sql("SELECT comment_id, url FROM comments WHERE regexp_matches(CAST(comment_id AS VARCHAR), '7.*1$')"))
def comment_id_contains(t):
    return filters.comment_id_contains(comments(t), "7.*1$").select("comment_id", "url")


@query(sql("""
SELECT c.*, d.title, d.article_text, d.top_comment_text FROM comments c JOIN details d USING (url)"""))
def comments_articles_join(t):
    return joins.comments_with_articles(comments(t), details(t))


@query(sql("""
SELECT c.*, d.title, d.article_text, d.top_comment_text
FROM comments c JOIN details d ON c.url = d.url AND c.comment_text = d.top_comment_text"""))
def top_comment_match(t):
    return joins.top_comment_matches(comments(t), details(t))


_SFT_TEXT = (
    f"'{INSTRUCTION_HEAD + INSTRUCTION + INPUT_HEAD}' || "
    "array_to_string(string_split(title_article_text, ' ')[1:800], ' ')"
    f" || '{RESPONSE_HEAD}' || top_comment_text || chr(10)"
)


@query(sql(f"SELECT comment_id, url, pcu_value, pcd_value, {_SFT_TEXT} AS text FROM sft WHERE {_SFT_OK}", _SFT))
def prepare_sft(t):
    prepared, _ = datasets.prepare_sft(sft_dataset(t), 10, 0.4, 800)
    return prepared.select("comment_id", "url", "pcu_value", "pcd_value", "text")


@query(sql(f"""
SELECT prompt, chosen, rejected, CASE WHEN {sql_hash('url', 42, 8)} % 1000 < 100 THEN 'test' ELSE 'train' END AS split
FROM dpo WHERE {_DPO_OK}""", *DPO_CTES))
def prepare_dpo(t):
    kept = filters.dpo_vote_filter(dpo_dataset(t), 50, 10)
    return sampling.with_split(kept).select("prompt", "chosen", "rejected", "split")


@query(sql(f"""
SELECT prompt, chosen, rejected, CASE WHEN row_number() OVER (ORDER BY {sql_hash('url', 42, 15)})
  <= ceil(0.1 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
FROM dpo WHERE {_DPO_OK}""", *DPO_CTES))
def prepare_dpo_exact(t):
    """The plan itself, with an exact test share."""
    train, test, _ = datasets.prepare_dpo(dpo_dataset(t), 50, 10, exact=True, keep_votes=False)
    return train.withColumn("split", F.lit("train")).union(test.withColumn("split", F.lit("test")))


@query(f"""
SELECT doc_id, CASE WHEN {sql_hash('doc_id', 42, 8)} % 1000 < 100 THEN 'test' ELSE 'train' END AS split
FROM documents""")
def train_test_split(t):
    return sampling.with_split(t["documents"].select("doc_id"), "doc_id")


@query(f"""
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {sql_hash('doc_id', 42, 15)})
  <= ceil(0.1 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
FROM documents""")
def train_test_split_exact(t):
    return sampling.with_split(t["documents"].select("doc_id"), "doc_id", exact=True)


@query(f"SELECT doc_id, text, lang FROM documents ORDER BY {sql_hash('doc_id', 42, 15)}, doc_id LIMIT 1")
def sample_one(t):
    return sampling.sample_one(t["documents"].select("doc_id", "text", "lang"), F.col("doc_id"))
