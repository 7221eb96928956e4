import pytest
from pyspark.sql import functions as F

from quipyard.plans.ingest import ingest_pages, write_ingested
from quipyard.sources import pages as P
from quipyard.sources.html_tree import parse
from quipyard.sources.tables import read_comments_csv, read_details

FULL = """<!DOCTYPE html><html><head><title>Fast &amp; loose</title>
<meta name="keywords" content="k"><meta name="description" content="A &quot;short&quot; text"></head><body>
<div class="a blog-section-inside b">
  <h2>  Head  </h2>

  <p>One <b>two
  <div class="media-media-width"><p>media text</p></div>
  <script>var hidden = "<p>";</script><style>p {}</style><!-- hidden --><template><p>hidden</p></template>
  <p>three<br>four
</div>
<div id="comment_wrap">
 <div class="ppcont"><div class="comtext"> Top <b> joke </b> </div></div>
 <div class="cmcont other" id="c1"><a href="/about">x</a><a href="/u/ann/"> ann </a>
   <div class="comtext"> First <i>one</i> </div>
   <div class="pcp"><span class="pcu"> 12 </span><span class="pcd">3</span></div></div>
 <div class="cmcont" id="c2"><div class="comtext">Second</div></div>
 <div class="cmcont" id="c3"><div class="comtext">Third</div><div class="pcp"><span class="pcu">5</span></div></div>
 <div class="cmcontainer" id="no"><div class="comtext">not a comment</div></div>
</div></body></html>"""


@pytest.fixture
def captured(table):
    def make(**pages):
        rows = [(url, *(page if isinstance(page, tuple) else (200, page))) for url, page in pages.items()]
        return table("url STRING, status_code INT, html STRING", *rows)

    return make


def details(df):
    return {r.url: r.asDict() for r in P.extract_details(df).collect()}


def test_full_details(captured):
    row = details(captured(u=FULL))["u"]
    assert row == {
        "url": "u",
        "title": "Fast & loose",
        "description": 'A "short" text',
        "article_text": "Head\nOne\ntwo\nthree\nfour",
        "top_comment_text": "Topjoke",
    }


def test_missing_parts(captured):
    found = details(
        captured(
            bare="<p>nothing here",
            empty_title="<title></title>",
            blank_title="<title>\n </title>",
            no_content='<meta name="description"><title>x</title>',
            no_text='<div id="comment_wrap"><div class="ppcont"></div></div>',
            outside='<div class="ppcont"><div class="comtext">x</div></div>',
            empty="",
        )
    )
    assert found["bare"] == {
        "url": "bare",
        "title": "N/A",
        "description": "NA",
        "article_text": "N/A",
        "top_comment_text": "N/A",
    }
    assert found["empty_title"]["title"] == "None"
    assert found["blank_title"]["title"] == "\n"
    assert found["no_content"]["description"] is None
    assert found["no_text"]["top_comment_text"] == found["outside"]["top_comment_text"] == "N/A"
    assert found["empty"]["title"] == "N/A"


def test_failed_captures_give_nothing(captured):
    df = captured(gone=(404, FULL), unknown=(None, FULL), ok=FULL)
    assert set(details(df)) == {"ok"}
    assert {r.url for r in P.extract_comments(df).collect()} == {"ok"}


def test_comments_in_page_order(captured):
    found = P.extract_comments(captured(u=FULL)).orderBy("position").collect()
    assert [(r.comment_id, r.comment_text, r.pcu_value, r.pcd_value, r.username) for r in found] == [
        ("c1", "Firstone", "12", "3", "ann"),
        ("c2", "Second", None, None, None),
        ("c3", "Third", "5", None, None),
    ]
    counts = P.incomplete_comments(P.extract_comments(captured(u=FULL))).first()
    assert (counts.without_text, counts.without_user) == (0, 2)


def test_links_keep_duplicates_and_follow_the_pattern(captured):
    html = """<div class="news-style1"><a href="https://n.example/news/a.html">a</a><a>none</a><a href="">empty</a>
      <p class="news-style1 x"><a href="https://n.example/news/b.html?x=1">b</a></p></div>
      <div class="news-style1"><a href="https://n.example/news/a.html">again</a>
      <a href="http://n.example/news/c.html">c</a></div><a href="https://n.example/news/out.html">outside</a>"""
    df = captured(u=html)
    urls = [r.url for r in P.extract_links(df).orderBy("position").collect()]
    a, b, c = "https://n.example/news/a.html", "https://n.example/news/b.html?x=1", "http://n.example/news/c.html"
    assert urls == [a, b, b, a, c]
    from quipyard.operators.filters import article_url_pattern

    pattern = article_url_pattern("https://n.example/news/")
    assert [r.url for r in P.extract_links(df, pattern=pattern).orderBy("position").collect()] == [a, a]


def test_url_pattern_is_anchored(column):
    from quipyard.operators.filters import article_url_pattern, matches_url

    pattern = article_url_pattern("https://n.example/news/")
    urls = ["https://n.example/news/x.html", "https://nXexample/news/x.html", "see https://n.example/news/x.html"]
    urls += ["https://n.example/news/x.html?", "https://n.example/news/x\ny.html", "https://n.example/news/.html"]
    assert column(lambda c: matches_url(c, pattern), urls) == [True, False, False, False, False, True]


def test_errors_go_to_their_own_table(captured):
    df = captured(bad=(200, None), good=FULL)
    parsed = P.parse_pages(df)
    errors = P.errors_of(parsed).collect()
    assert [e.url for e in errors] == ["bad"] and errors[0].error.startswith("TypeError")
    assert {r.url for r in P.details_of(parsed).collect()} == {"good"}


def test_tree_rules():
    page = parse("<div><p>a<p>b</div>c</b><br/>d<img>e</img><B CLASS='X  y' id>f</B>")
    assert page.stripped_text() == "abcdef"
    bold = page.find(lambda e: e.tag == "b")
    assert bold.classes == ["X", "y"] and bold.attrs["id"] == ""
    assert parse("x &lt;b&gt; &eacute; &#233;").stripped_text() == "x <b> é é"
    assert parse("<p>" * 5000 + "deep").stripped_text() == "deep"


def test_cleaning_drops_incomplete_articles(table):
    rows = [
        ("a", "T", "d", "text", "top"),
        ("b", "N/A", "d", "text", "top"),
        ("c", "T", "NA", "text with N/A inside", "NA"),
        ("d", "T", None, "text", "top"),
    ]
    df = table("url STRING, title STRING, description STRING, article_text STRING, top_comment_text STRING", *rows)
    found = {r.url: r.title_article_text for r in P.clean_details(df).collect()}
    assert found == {"a": "T: text", "c": "T: text with N/A inside"}


def test_ingest_and_write(spark, captured, tmp_path):
    df = captured(u=FULL, bad=(200, None), bare="<p>no parts")
    ingested = ingest_pages(df)
    write_ingested(ingested, str(tmp_path))
    kept = read_details(spark, f"{tmp_path}/article_details.csv").collect()
    assert [(r.url, r.article_text) for r in kept] == [("u", "Head\nOne\ntwo\nthree\nfour")]
    comments = read_comments_csv(spark, f"{tmp_path}/article_comments.csv").orderBy("comment_id").collect()
    votes = [(r.comment_id, r.pcu_value, r.pcd_value) for r in comments]
    assert votes == [("c1", 12, 3), ("c2", None, None), ("c3", 5, None)]
    assert spark.read.csv(f"{tmp_path}/page_errors.csv", header=True).count() == 1
    assert ingested.counts["pages"] == 3 and ingested.counts["failed_pages"] == 1
    one = P.incomplete_comments(ingested.comments).first()
    assert (ingested.counts["comments_without_text"], ingested.counts["comments_without_user"]) == tuple(one)
    assert ingested.counts["comments"] == ingested.comments.count()
    assert set(ingest_pages(df.limit(0)).counts.values()) == {0}


def test_html_is_read_once_and_goes_no_further(captured):
    df = captured(u=FULL)
    parsed = P.parse_pages(df)
    assert "html" not in parsed.columns
    assert P.parse_pages(df, parts=["links"]).columns == ["url", "links", "error"]
    assert parsed.where(F.size("comments") == 3).count() == 1
