"""Fixed schemas; no reader infers types."""

from __future__ import annotations

from pyspark.sql import types as T


TEXT, WHOLE, LONG, REAL, TIME = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


PAGES = _struct(url=TEXT, status_code=WHOLE, html=TEXT)
ARTICLE_URLS = _struct(url=TEXT)
DETAILS = _struct(url=TEXT, title=TEXT, description=TEXT, article_text=TEXT, top_comment_text=TEXT)
CLEAN_DETAILS = _struct(**{f.name: f.dataType for f in DETAILS}, title_article_text=TEXT)
COMMENTS = _struct(comment_id=TEXT, url=TEXT, comment_text=TEXT, pcu_value=LONG, pcd_value=LONG, username=TEXT)
RAW_COMMENTS = _struct(comment_id=TEXT, url=TEXT, comment_text=TEXT, pcu_value=TEXT, pcd_value=TEXT, username=TEXT)
SFT_DATASET = _struct(
    comment_id=TEXT,
    url=TEXT,
    comment_text=TEXT,
    pcu_value=LONG,
    pcd_value=LONG,
    username=TEXT,
    title=TEXT,
    article_text=TEXT,
    top_comment_text=TEXT,
    title_article_text=TEXT,
)
DPO_DATASET = _struct(
    prompt=TEXT,
    chosen=TEXT,
    rejected=TEXT,
    url=TEXT,
    chosen_pcu=LONG,
    rejected_pcu=LONG,
    chosen_pcd=LONG,
    rejected_pcd=LONG,
)
FEW_SHOT_EXAMPLES = _struct(position=WHOLE, title_article_text=TEXT, comment=TEXT)
GENERATED = _struct(url=TEXT, prompt=TEXT, comment=TEXT)
TOKEN_SCORES = _struct(generation_id=TEXT, pos=WHOLE, token=TEXT, logprob=REAL)
COMMENT_LOG = _struct(comment_id=TEXT, url=TEXT, comment=TEXT, datetime=TIME)
REVIEW_INPUT = _struct(comment_id=TEXT, url=TEXT, comment=TEXT, datetime=TIME)

# Cell texts that the data-frame CSV reader takes for null.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Fixed value: what extraction writes for a missing part, turned into null by cleaning.
MISSING = "N/A"
# Fixed value: what extraction writes for a missing description; it stays in the data.
NO_DESCRIPTION = "NA"
