"""Sources, sinks, page extraction and the streaming log."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from quipyard.catalog.adapters import comments, details, pages, sql, sql_lines
from quipyard.catalog.pairs import DPO_CTES, dpo_dataset
from quipyard.catalog.registry import query
from quipyard.catalog.texts import SQL_BAD
from quipyard.operators import filters
from quipyard.plans import ingest
from quipyard.schemas import COMMENT_LOG, DETAILS, DPO_DATASET
from quipyard.session import scratch_path
from quipyard.sources import archive, tables
from quipyard.sources import pages as page_source
from quipyard.sources.pages import PageLayout, Selector
from quipyard.streaming.review_log import REJECTED_LOG, start_review_log

# The given pages use other markup: links and "comments" are the list items of the navigation.
LAYOUT = PageLayout(
    link_block=Selector("nav"),
    body=Selector("body"),
    body_media=Selector(cls="ad"),
    comment_section=Selector("nav"),
    top_comment=Selector("li"),
    comment=Selector("li"),
    comment_text=Selector("a"),
    votes=Selector("a"),
    user_link="/",
)


def _decoded(text: str) -> str:
    """SQL for the entities that occur; the closing semicolon may be missing in these."""
    for entity, char in (("&quot", '"'), ("&copy", "©"), ("&middot", "·"), ("&amp", "&")):
        text = f"regexp_replace({text}, '{entity};?', '{char}', 'g')"
    return text


@query("SELECT url, 200 AS status_code, html FROM pages")
def pages_scan(t):
    return page_source.pages_scan(page_source.read_pages(t.spark, t.path("pages")))


_NAV = "regexp_extract(html, '(?s)<nav>(.*)</nav>', 1)"


@query(f"""
SELECT url AS page_url, generate_subscripts(l, 1) - 1 AS position, unnest(l) AS url
FROM (SELECT url, regexp_extract_all({_NAV}, '<a href="([^"]*)"', 1) AS l FROM pages)""")
def extract_links(t):
    links = page_source.extract_links(pages(t), LAYOUT)
    return links.withColumn("position", F.col("position").cast("bigint"))


_BODY = """regexp_replace(regexp_replace(regexp_extract(html, '(?s)<body>(.*)', 1),
  '(?s)<div class="ad">.*?</div>', '', 'g'), '<[^>]*>', chr(10), 'g')"""
_DETAILS = f"""
extracted AS (
  SELECT url, {_decoded("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS title, 'NA' AS description,
         {sql_lines(_decoded(_BODY))} AS article_text,
         {_decoded(f"trim(regexp_extract({_NAV}, '<a [^>]*>([^<]*)<', 1))")} AS top_comment_text
  FROM pages)"""


@query(f"WITH {_DETAILS} SELECT * FROM extracted")
def extract_details(t):
    return page_source.extract_details(pages(t), LAYOUT)


@query(f"""
WITH {_DETAILS} SELECT *, title || ': ' || article_text AS title_article_text FROM extracted
WHERE title <> 'N/A' AND article_text <> 'N/A' AND top_comment_text <> 'N/A'""")
def ingest_details(t):
    return ingest.ingest_pages(pages(t), LAYOUT).details


_COMMENTS = f"""
SELECT NULL::VARCHAR AS comment_id, url, NULL::VARCHAR AS pcu_value, NULL::VARCHAR AS pcd_value,
       {_decoded("trim(unnest(l))")} AS comment_text, {_decoded("trim(unnest(l))")} AS username,
       generate_subscripts(l, 1) - 1 AS position
FROM (SELECT url, regexp_extract_all({_NAV}, '<li><a [^>]*>([^<]*)<', 1) AS l FROM pages)"""


@query(_COMMENTS)
def extract_comments(t):
    found = page_source.extract_comments(pages(t), LAYOUT)
    return found.withColumn("position", F.col("position").cast("bigint"))


@query(f"SELECT * EXCLUDE (position) FROM ({_COMMENTS})")
def ingest_comments(t):
    return ingest.ingest_pages(pages(t), LAYOUT).comments


@query(f"""
WITH found AS ({_COMMENTS}), broken AS (SELECT url FROM pages WHERE contains(html, 'lang="fr"'))
SELECT (SELECT count(*) FROM pages) AS pages, (SELECT count(*) FROM broken) AS failed_pages,
       (SELECT count(*) FROM found WHERE url NOT IN (SELECT url FROM broken)) AS comments,
       0::BIGINT AS comments_without_text, 0::BIGINT AS comments_without_user""")
def ingest_counts(t):
    """What the parsing pass counts; pages in one language have lost their content."""
    broken = pages(t).withColumn("html", F.expr("""CASE WHEN NOT contains(html, 'lang="fr"') THEN html END"""))
    return t.spark.createDataFrame([ingest.ingest_pages(broken, LAYOUT).counts], ", ".join(f"{n} BIGINT" for n in ingest.COUNTS))


@query("""SELECT url, 'TypeError' AS error FROM pages WHERE contains(html, 'lang="fr"')""")
def extract_errors(t):
    """Pages in one language have lost their content."""
    broken = pages(t).withColumn("html", F.expr("""CASE WHEN NOT contains(html, 'lang="fr"') THEN html END"""))
    errors = page_source.errors_of(page_source.parse_pages(broken, LAYOUT, ["details"]))
    return errors.select("url", F.substring_index("error", ":", 1).alias("error"))


@query(r"SELECT page_id, url FROM pages WHERE regexp_matches(url, '^https://.*\.html$')")
def url_pattern(t):
    pattern = filters.article_url_pattern("https://")
    return t["pages"].select("page_id", "url").where(filters.matches_url(F.col("url"), pattern))


@query(sql("SELECT * FROM dpo", *DPO_CTES))
def jsonl_roundtrip(t):
    path = scratch_path(t.spark, "pairs") + ".jsonl"
    tables.write_jsonl(dpo_dataset(t), path)
    return tables.read_dataset(t.spark, path, DPO_DATASET)


@query(sql("""
SELECT CAST(comment_id AS VARCHAR) AS comment_id, url, nullif(comment_text, '') AS comment_text, pcu_value, pcd_value,
       username FROM comments"""))
def csv_roundtrip(t):
    path = scratch_path(t.spark, "comments") + ".csv"
    tables.write_csv(comments(t), path)
    return tables.read_comments_csv(t.spark, path, na_tokens=("",))


@query(sql("""
SELECT url, nullif(title, '') AS title, CAST(NULL AS VARCHAR) AS description,
       nullif(article_text, '') AS article_text, nullif(top_comment_text, '') AS top_comment_text FROM details"""))
def details_csv_roundtrip(t):
    path = scratch_path(t.spark, "details") + ".csv"
    tables.write_csv(details(t), path)
    return tables.read_csv(t.spark, path, DETAILS, na_tokens=("",))


@query(sql("""
SELECT url, title, CAST(NULL AS VARCHAR) AS description, article_text, top_comment_text FROM details"""))
def details_json_roundtrip(t):
    path = scratch_path(t.spark, "details") + ".jsonl"
    tables.write_jsonl(details(t), path)
    return tables.read_details_json(t.spark, path)


@query(sql("""
SELECT url, title, CAST(NULL AS VARCHAR) AS description, article_text, top_comment_text FROM details"""))
def details_json_any_name(t):
    """Lines under a name that says nothing, found out by `read_details`."""
    path = scratch_path(t.spark, "details") + ".json"
    tables.write_jsonl(details(t), path)
    return tables.read_details(t.spark, path)


@query(sql("SELECT * FROM dpo", *DPO_CTES))
def jsonl_float_votes(t):
    """Votes written as 12.0."""
    path = scratch_path(t.spark, "pairs") + ".jsonl"
    votes = [f.name for f in DPO_DATASET if f.dataType.typeName() == "long"]
    tables.write_jsonl(dpo_dataset(t).withColumns({c: F.col(c).cast("double") for c in votes}), path)
    return tables.read_dataset(t.spark, path, DPO_DATASET)


@query(sql("""
SELECT CAST(comment_id AS VARCHAR) AS comment_id, url, nullif(comment_text, '') AS comment_text, pcu_value, pcd_value,
       username FROM comments"""))
def csv_mixed_headers(t):
    """Files of one folder whose columns stand in different orders."""
    path = scratch_path(t.spark, "comments") + ".csv"
    first = F.col("username") == "user"
    tables.write_csv(comments(t).where(first), path)
    rest = comments(t).where(~first | F.col("username").isNull())
    tables.write_csv(rest.select(*reversed(rest.columns)), path, mode="append")
    return tables.read_comments_csv(t.spark, path, na_tokens=("",))


@query(sql("""
SELECT CAST(comment_id AS VARCHAR) AS comment_id, url, nullif(comment_text, '') AS comment_text, pcu_value, pcd_value,
       username FROM comments"""))
def csv_split_file(t):
    """One file with line breaks in its cells, read in as many byte ranges as Spark deals it out in."""
    path = scratch_path(t.spark, "comments") + ".csv"
    broken = F.concat("comment_text", F.lit('\n"'), "comment_text", F.lit('",\r\n'))
    tables.write_csv(comments(t).withColumn("comment_text", broken).repartition(1), path, rows_per_file=0)
    back = tables.read_comments_csv(t.spark, path, na_tokens=())
    whole = F.expr("substring(comment_text, 1, (length(comment_text) - 6) div 2)")
    kept = F.when(F.col("comment_text") == F.concat(whole, F.lit('\n"'), whole, F.lit('",\r\n')), whole)
    return back.withColumn("comment_text", F.nullif(kept, F.lit("")))


@query(sql("""
SELECT url, title, CAST(NULL AS VARCHAR) AS description, article_text, top_comment_text FROM details"""))
def details_json_array(t):
    """Files of one array each."""
    path = scratch_path(t.spark, "details") + ".json"
    tables.write_json_arrays(details(t), path)
    return tables.read_details(t.spark, path)


@query("SELECT url FROM pages")
def urls_roundtrip(t):
    path = scratch_path(t.spark, "urls") + ".csv"
    tables.write_csv(t["pages"].select("url"), path)
    return tables.read_urls(t.spark, path)


_ARCHIVE = "https://archive.example.org/list?"


@query(f"""
SELECT year, month, catid, '{_ARCHIVE}catid=' || catid || '&year=' || year || '&month=' || month AS url
FROM (SELECT CAST(unnest(generate_series(min(year(l_shipdate)), max(year(l_shipdate)))) AS INTEGER) AS year
      FROM lineitem),
     (SELECT CAST(unnest(generate_series(1, 12)) AS INTEGER) AS month), (SELECT unnest([0, 2]) AS catid)""")
def archive_grid(t):
    year = F.year("l_shipdate")
    years = t["lineitem"].agg(F.min(year).alias("first_year"), F.max(year).alias("last_year"))
    return archive.archive_pages_between(years, _ARCHIVE, (0, 2))


@query(f"""
SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       '{_ARCHIVE}catid=0&year=' || year(ts) || '&month=' || month(ts) AS url FROM events""")
def as_of_month(t):
    return archive.month_pages(t["events"].select("event_id", "ts"), F.col("ts"), _ARCHIVE).drop("ts")


@query(sql("SELECT CAST(comment_id AS VARCHAR) AS comment_id, url, comment_text AS comment FROM comments"))
def comment_log_append(t):
    """One user's comments, then everybody's: no id is logged twice."""
    path = scratch_path(t.spark, "comment-log")
    records = comments(t).select("comment_id", "url", F.col("comment_text").alias("comment"), "username").withColumn(
        "datetime", F.current_timestamp()
    )
    tables.append_comment_log(records.where("username = 'user'"), path)
    tables.append_comment_log(records, path)
    return tables.read_comment_log(t.spark, path).select("comment_id", "url", "comment")


@query(sql("SELECT CAST(comment_id AS VARCHAR) AS comment_id, url, comment_text AS comment FROM comments"))
def log_two_writers(t):
    """Two writers at once, each with all comments in overlapping parts: every id is there once."""
    path = scratch_path(t.spark, "comment-log")
    records = comments(t).select("comment_id", "url", F.col("comment_text").alias("comment")).withColumn(
        "datetime", F.lit("2024-01-01").cast("timestamp")
    )
    parts = [F.col("comment_id") % 3 != i for i in range(3)]

    def write(order):
        for i in order:
            tables.append_comment_log(records.where(parts[i]), path)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(write, ([0, 1, 2], [2, 0, 1])))
    return tables.read_comment_log(t.spark, path).select("comment_id", "url", "comment")


@query(sql("SELECT DISTINCT url, comment_text AS comment FROM comments"))
def comment_log_null_ids(t):
    """Records without an id, logged twice: each of them once, in a table of their own."""
    path = scratch_path(t.spark, "comment-log")
    records = comments(t).select(
        F.lit(None).cast("string").alias("comment_id"), "url", F.col("comment_text").alias("comment")
    )
    dated = records.withColumn("datetime", F.lit("2024-01-01").cast("timestamp"))
    for _ in range(2):
        tables.append_comment_log(dated, path)
    return tables.read_log_without_id(t.spark, path, COMMENT_LOG).select("url", "comment")


@query(f"""
SELECT CAST(doc_id AS VARCHAR) AS comment_id, lang AS url, text AS comment, NOT {SQL_BAD} AS accepted FROM documents""")
def stream_review_log(t):
    """The documents as a stream of generations, run twice from the start."""
    # A pattern, as a streaming source takes no single file.
    stream = t.spark.readStream.schema(t["documents"].schema).parquet(t.path("documents") + "*")
    generated = stream.select(
        F.col("doc_id").cast("string").alias("comment_id"),
        F.col("lang").alias("url"),
        F.col("text").alias("comment"),
        F.current_timestamp().alias("datetime"),
    )
    log, rejected = scratch_path(t.spark, "log"), scratch_path(t.spark, "rejected")
    for _ in range(2):
        start_review_log(
            generated, log, rejected, scratch_path(t.spark, "stream"), available_now=True
        ).awaitTermination()
    kept = tables.read_comment_log(t.spark, log).withColumn("accepted", F.lit(True))
    dropped = tables.read_log(t.spark, rejected, REJECTED_LOG).withColumn("accepted", F.lit(False))
    return kept.unionByName(dropped.drop("reasons")).drop("datetime")
