"""Links, article details and comments out of captured pages.

Spark has no HTML functions, so one `mapInArrow` pass parses each page once and
returns raw texts; Spark splits it over partitions, and all clean-up of the texts
is done by column expressions. The html column does not leave the pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quipyard.functions.text import normalize_lines, title_and_text
from quipyard.operators.columns import drop_any_null, normalize_columns, sentinel_to_null
from quipyard.operators.filters import matches_url
from quipyard.operators.ranks import spread
from quipyard.schemas import MISSING, NO_DESCRIPTION, PAGES, RAW_COMMENTS
from quipyard.sources.batches import in_parts
from quipyard.sources.html_tree import Element, parse


@dataclass(frozen=True)
class Selector:
    """Element by tag, class token and id; an empty part matches anything."""

    tag: str = ""
    cls: str = ""
    id: str = ""

    def __call__(self, element: Element) -> bool:
        return (
            (not self.tag or element.tag == self.tag)
            and (not self.cls or self.cls in element.classes)
            and (not self.id or element.attrs.get("id") == self.id)
        )


# The page parts of the archive this was made for.
@dataclass(frozen=True)
class PageLayout:
    link_block: Selector = field(default=Selector(cls="news-style1"))
    body: Selector = field(default=Selector(cls="blog-section-inside"))
    body_media: Selector = field(default=Selector(cls="media-media-width"))
    comment_section: Selector = field(default=Selector("div", id="comment_wrap"))
    top_comment: Selector = field(default=Selector(cls="ppcont"))
    comment: Selector = field(default=Selector("div", cls="cmcont"))
    comment_text: Selector = field(default=Selector(cls="comtext"))
    votes: Selector = field(default=Selector("div", cls="pcp"))
    up_votes: Selector = field(default=Selector("span", cls="pcu"))
    down_votes: Selector = field(default=Selector("span", cls="pcd"))
    user_link: str = "/u/"


DEFAULT_LAYOUT = PageLayout()

_PART_TYPES = {
    "links": "ARRAY<STRING>",
    "details": "STRUCT<title STRING, description STRING, article_text STRING, top_comment_text STRING>",
    "comments": "ARRAY<STRUCT<comment_id STRING, comment_text STRING, pcu_value STRING, pcd_value STRING, "
    "username STRING>>",
}


def _links(page: Element, at: PageLayout) -> list[str]:
    blocks = page.find_all(at.link_block)
    anchors = (a for block in blocks for a in block.find_all(Selector("a")))
    return [href for a in anchors if (href := a.attrs.get("href"))]


def _details(page: Element, at: PageLayout) -> dict[str, str | None]:
    title = page.find(Selector("title"))
    meta = page.find(lambda e: e.tag == "meta" and e.attrs.get("name") == "description")
    scope = page.find(at.comment_section)
    for step in (at.top_comment, at.comment_text):
        scope = scope.find(step) if scope else None
    body = page.find(at.body)
    if body:
        body.remove_all(at.body_media)
    return {
        # A title without a single string comes out as the word None.
        "title": MISSING if title is None else str(title.only_string()),
        "description": NO_DESCRIPTION if meta is None else meta.attrs.get("content"),
        "article_text": None if body is None else "\n".join(body.texts()),
        "top_comment_text": MISSING if scope is None else scope.stripped_text(),
    }


def _text_of(element: Element | None) -> str | None:
    return None if element is None else element.stripped_text()


def _comment(block: Element, at: PageLayout) -> dict[str, str | None]:
    votes = block.find(at.votes)
    user = votes and block.find(lambda e: e.tag == "a" and at.user_link in e.attrs.get("href", ""))
    return {
        "comment_id": block.attrs.get("id"),
        "comment_text": _text_of(block.find(at.comment_text)),
        "pcu_value": _text_of(votes and votes.find(at.up_votes)),
        "pcd_value": _text_of(votes and votes.find(at.down_votes)),
        "username": _text_of(user),
    }


def _comments(page: Element, at: PageLayout) -> list[dict[str, str | None]]:
    return [_comment(block, at) for block in page.find_all(at.comment)]


# Details come last: they cut media out of the tree.
_PARTS = {"links": _links, "comments": _comments, "details": _details}


def parse_pages(
    pages: DataFrame,
    layout: PageLayout = DEFAULT_LAYOUT,
    parts: Sequence[str] = ("links", "details", "comments"),
) -> DataFrame:
    """Each page with status 200 parsed once: url, the wanted parts, error.

    A page that cannot be parsed has null parts and the reason in `error`.
    Body texts are still raw.
    """
    wanted = [p for p in _PARTS if p in parts]

    def parse_one(url: str, html: str) -> dict:
        row = dict.fromkeys([*wanted, "error"])
        try:
            page = parse(html)
            row.update({part: _PARTS[part](page, layout) for part in wanted})
        except Exception as error:  # one bad page must not stop the job
            row.update(dict.fromkeys(wanted), error=f"{type(error).__name__}: {error}")
        return {"url": url, **row}

    schema = T.StructType.fromDDL(
        ", ".join(["url STRING", *[f"{p} {_PART_TYPES[p]}" for p in wanted], "error STRING"])
    )
    arrow_schema = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, "html"):
            rows = [parse_one(row["url"].as_py(), row["html"].as_py()) for row in _rows(batch)]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow_schema)

    # Parsing costs far more than moving a page: a few large inputs are spread over all cores.
    return spread(pages.where("status_code = 200").select("url", "html")).mapInArrow(run, schema)


def _rows(batch: pa.RecordBatch) -> Iterator[dict[str, pa.Scalar]]:
    """Rows one by one: only one page at a time becomes a Python string."""
    for values in zip(*batch.columns):
        yield dict(zip(batch.schema.names, values))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured pages; a table without status holds successful captures only."""
    pages = spark.read.parquet(path)
    if "status_code" not in pages.columns:
        pages = pages.withColumn("status_code", F.lit(200))
    return pages.select(*[F.col(f.name).cast(f.dataType) for f in PAGES.fields])


def pages_scan(pages: DataFrame) -> DataFrame:
    """Pages whose capture succeeded."""
    return pages.where("status_code = 200")


def links_of(parsed: DataFrame, pattern: str | None = None) -> DataFrame:
    """(page_url, position, url) in page order, duplicates kept."""
    links = parsed.select(F.col("url").alias("page_url"), F.posexplode("links").alias("position", "url"))
    return links if pattern is None else links.where(matches_url(F.col("url"), pattern))


def details_of(parsed: DataFrame) -> DataFrame:
    """Article details; failed pages have none."""
    text = normalize_lines(F.col("details.article_text"))
    return parsed.where("details IS NOT NULL").select(
        "url",
        "details.title",
        "details.description",
        F.coalesce(text, F.lit(MISSING)).alias("article_text"),
        "details.top_comment_text",
    )


def comments_of(parsed: DataFrame) -> DataFrame:
    """Comments in page order with their position; votes are still text."""
    exploded = parsed.select("url", F.posexplode("comments").alias("position", "c"))
    return exploded.select(*[("url" if n == "url" else f"c.{n}") for n in RAW_COMMENTS.names], "position")


def errors_of(parsed: DataFrame) -> DataFrame:
    """Pages that could not be parsed, and why."""
    return parsed.where("error IS NOT NULL").select("url", "error")


def incomplete_comments(comments: DataFrame) -> DataFrame:
    """One row: comments without text and comments without a user."""
    return comments.agg(
        F.count_if(F.col("comment_text").isNull()).alias("without_text"),
        F.count_if(F.col("username").isNull()).alias("without_user"),
    )


def extract_links(pages: DataFrame, layout: PageLayout = DEFAULT_LAYOUT, pattern: str | None = None) -> DataFrame:
    return links_of(parse_pages(pages, layout, ["links"]), pattern)


def extract_details(pages: DataFrame, layout: PageLayout = DEFAULT_LAYOUT) -> DataFrame:
    return details_of(parse_pages(pages, layout, ["details"]))


def extract_comments(pages: DataFrame, layout: PageLayout = DEFAULT_LAYOUT) -> DataFrame:
    return comments_of(parse_pages(pages, layout, ["comments"]))


def clean_details(details: DataFrame, separator: str = ": ") -> DataFrame:
    """Drop articles with a missing part and add title and text in one column."""
    whole = drop_any_null(sentinel_to_null(normalize_columns(details)))
    return whole.withColumn("title_article_text", title_and_text(F.col("title"), F.col("article_text"), separator))
