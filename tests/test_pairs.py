"""Picks, joins, filters and training sets against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from quipyard.operators import filters, joins, ranking
from quipyard.plans import candidates, datasets

COMMENTS = "comment_id STRING, url STRING, comment_text STRING, pcu_value BIGINT, pcd_value BIGINT, username STRING"
DETAILS = "url STRING, title STRING, description STRING, article_text STRING, top_comment_text STRING"


def _last(value):
    return (value is None, 0 if value is None else value)


def expected_pairs(rows):
    """(top, worst) rows per url by sorting in Python."""
    by_url = {}
    for row in rows:
        if row[1] is not None:
            by_url.setdefault(row[1], []).append(row)

    def delta(row):
        return None if row[3] is None or row[4] is None else row[3] - row[4]

    return {
        url: (
            min(group, key=lambda r: (_last(None if r[3] is None else -r[3]), r[0])),
            min(group, key=lambda r: (_last(delta(r)), _last(r[3]), r[0])),
        )
        for url, group in by_url.items()
    }


def random_comments(n=600, hot="hot"):
    rng = random.Random(5)
    maybe = [None, 0, 0, 1, 2, 3, 50]
    return [
        (
            f"c{i:04d}",
            hot if i % 3 == 0 else rng.choice([None, *"abcdefghij"]),
            rng.choice(["same", f"text {i}", None]),
            rng.choice(maybe),
            rng.choice(maybe),
            rng.choice(["ann", "bob", None]),
        )
        for i in range(n)
    ]


def test_top_and_worst_match_sorting(table):
    rows = random_comments()
    want = expected_pairs(rows)
    df = table(COMMENTS, *rows, partitions=5)
    tops = {r.url: r.comment_id for r in ranking.top_comment(df).collect()}
    worsts = {r.url: (r.comment_id, r.delta) for r in ranking.worst_comment(df).collect()}
    assert tops == {url: top[0] for url, (top, _) in want.items()}
    assert {url: c for url, (c, _) in worsts.items()} == {url: worst[0] for url, (_, worst) in want.items()}
    columns = ["comment_id", "comment_text", "pcu_value", "pcd_value"]
    found = {tuple(r) for r in ranking.top_worst_pairs(df, columns).collect()}
    assert found == {
        (url, *[v for i in (0, 2, 3, 4) for v in (top[i], worst[i])]) for url, (top, worst) in want.items()
    }
    assert found == {tuple(r) for r in ranking.top_worst_pairs_by_window(df, columns).collect()}


def test_pairs_need_one_shuffle(table):
    plan = ranking.top_worst_pairs(table(COMMENTS, *random_comments(20), partitions=2))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(url") == 1


def test_first_user_comment(table):
    rows = [("u", "ann", 3), ("u", "ann", 1), ("u", "bob", 0), ("v", "bob", 2)]
    df = table("url STRING, username STRING, position INT", *rows)
    assert [tuple(r) for r in ranking.first_user_comment(df, "ann").collect()] == [("u", "ann", 1)]


ARTICLES = [
    ("u/plain", "Title", None, "Text", "top"),
    ("u/video", "Title", None, "Text", "top"),
    ("u/Video", "Title", None, "Text", "top"),
    ("u/photo", "Title", None, "Text", "top"),
    ("u/t1", "My VIDEO", None, "Text", "top"),
    ("u/t2", "Photos", None, "Text", "top"),
    ("u/notitle", None, None, "Text", "top"),
    ("u/notext", "Title", None, None, "top"),
    ("u/notop", "Title", None, "Text", None),
    ("u/long", "T", None, "x" * 597 + "é😀zz", "top"),
    ("u/alone", "Title", None, "Text", "top"),
]
SUITABLE = {"u/plain", "u/Video", "u/notext", "u/notop", "u/long", "u/alone"}


@pytest.fixture
def small(table):
    rows = [(f"{url}-{i}", url, text, up, down, "ann") for url, *_ in ARTICLES[:-1]
            for i, (text, up, down) in enumerate([("top", 1, 0), ("best", 9, 1), ("worst", 2, 7), ("top", 0, 0)])]
    rows += [("x", "u/alone", "only", 3, 1, "bob"), ("y", "u/unknown", "top", 1, 1, "bob")]
    rows += [("z", None, "top", 1, 1, "bob")]
    return table(COMMENTS, *rows), table(DETAILS, *ARTICLES)


def test_article_filter(small):
    assert {r.url for r in filters.filter_articles(small[1]).collect()} == SUITABLE
    urls = {r.url for r in filters.filter_candidates(small[1].select("url")).collect()}
    assert urls == {a[0] for a in ARTICLES} - {"u/video", "u/photo"}


def test_sft_dataset(small):
    rows = datasets.build_sft_dataset(*small).collect()
    assert sorted(r.comment_id for r in rows) == sorted(
        f"{url}-{i}" for url in SUITABLE - {"u/notop", "u/alone"} for i in (0, 3)
    )
    texts = {r.url: r.title_article_text for r in rows}
    assert texts["u/plain"] == "Title Text" and texts["u/notext"] is None
    assert set(rows[0].asDict()) == {
        *("comment_id url comment_text pcu_value pcd_value username title article_text".split()),
        "top_comment_text",
        "title_article_text",
    }


def test_dpo_dataset(small):
    rows = {r.url: r for r in datasets.build_dpo_dataset(*small).collect()}
    assert set(rows) == {"u/plain", "u/Video", "u/long", "u/alone"}
    row = rows["u/plain"]
    assert (row.chosen, row.rejected) == ("top", "worst")
    assert (row.chosen_pcu, row.chosen_pcd, row.rejected_pcu, row.rejected_pcd) == (9, 1, 2, 7)
    assert rows["u/alone"].rejected == "only" and rows["u/alone"].chosen_pcu == rows["u/alone"].rejected_pcu == 3
    assert ("\n" + "T " + "x" * 597 + "é" + "\n\n### Response:\n") in rows["u/long"].prompt
    comments, details = small
    shown = details.select("url", "top_comment_text")
    apart = datasets.build_dpo_dataset(comments, details.drop("top_comment_text"), shown)
    assert {r.url: r for r in apart.collect()} == rows


def test_vote_thresholds(table):
    rows = [(1, 10, 1), (2, 11, 1), (3, 20, 2), (4, 0, 0), (5, None, 1), (6, 30, None), (7, 12, 0)]
    df = table("k INT, pcu_value BIGINT, pcd_value BIGINT", *rows)
    assert sorted(r.k for r in filters.sft_vote_filter(df, 10, 0.1).collect()) == [2, 7]
    assert sorted(r.k for r in filters.sft_vote_filter(df).collect()) == [1, 2, 3, 7]
    df = table("k INT, chosen_pcu BIGINT, rejected_pcd BIGINT", (1, 90, 50), (2, 89, 50), (3, 90, 49), (4, None, 99))
    assert [r.k for r in filters.dpo_vote_filter(df, 90, 50).collect()] == [1]


def test_prepare_counts_and_splits(small):
    prepared, counts = datasets.prepare_sft(datasets.build_sft_dataset(*small), 0, 0.5)
    kept = prepared.collect()
    assert counts.get == {"rows_before": 8, "rows_after": 4}
    assert len(kept) == 4 and all("\n\n### Response:\ntop\n" in r.text for r in kept if r.text)
    pairs = datasets.build_dpo_dataset(*small)
    train, test, _ = datasets.prepare_dpo(pairs, 1, 1, keep_votes=False)
    assert train.columns == ["prompt", "chosen", "rejected"]
    assert train.count() + test.count() == pairs.count()


def test_candidates(table):
    articles = table(
        "url STRING, position INT, title STRING, article_text STRING",
        *[(f"u{i}", i, "T", f"text {i}") for i in range(6)],
        ("u-video", -1, "T", "x"),
    )
    comments = table("url STRING, username STRING", ("u0", "me"), ("u0", "me"), ("u1", "you"), ("u3", "me"))
    left = {r.url for r in joins.uncommented_articles(articles, comments, "me").collect()}
    assert left == {"u1", "u2", "u4", "u5", "u-video"}
    assert tuple(joins.candidate_counts(articles, comments, "me").first()) == (3, 7)
    assert tuple(joins.candidate_counts(articles, comments, "nobody").first()) == (0, 7)
    chosen = candidates.select_candidates(articles, comments, "me", 3).orderBy("position").collect()
    assert [(r.url, r.title_article_text) for r in chosen] == [(f"u{i}", f"T text {i}") for i in (1, 2, 4)]


def test_candidates_are_n_rows_in_a_fixed_order(table):
    articles = table(
        "url STRING, position INT, title STRING, article_text STRING",
        ("a", 1, "T", "x"), ("a", 1, "T", "y"), ("a", 0, "T", "x"), ("b", 1, "T", "z"), ("c", 1, "T", "w"), (None, 0, "T", "v"),
    )
    comments = table("url STRING, username STRING", (None, "me"))
    for n in (1, 2, 3):
        chosen = candidates.select_candidates(articles, comments, "me", n).orderBy("position", "url").collect()
        assert [r.url for r in chosen] == ["a", "b", "c"][:n]
    assert chosen[0].title_article_text == "T x" and chosen[0].position == 0


def test_more_hot_keys_than_one_broadcast(table, monkeypatch):
    rows = [(f"k{i % 1500}", i) for i in range(4500)] + [(None, i) for i in range(200)] + [("k1", 7)] * 20
    left = table("url STRING, n INT", *rows)
    right = table("url STRING, m INT", *[(f"k{i}", i) for i in range(0, 1500, 2)], (None, 1))
    for most in (100_000, 10):
        monkeypatch.setattr(joins, "BROADCAST_KEYS", most)
        assert joins.hot_keys(left, "url", 2).count() == 1500
        for how in ("inner", "left", "left_semi", "left_anti"):
            plain = sorted(map(str, left.join(right, "url", how).collect()))
            assert sorted(map(str, joins.salted_join(left, right, "url", how, rows_per_task=2).collect())) == plain


def test_no_excluded_words_keep_all(table):
    articles = table(DETAILS, ("u-video", "Photo", None, "x", None), ("u", None, None, "x", None))
    assert [r.url for r in filters.filter_articles(articles, []).collect()] == ["u-video"]
    assert filters.filter_candidates(articles, []).count() == 2


def test_comment_lookup(table):
    df = table("comment_id STRING, username STRING", ("x3726y", "ann"), ("37-26", "bob"), ("372", None))
    assert [r.comment_id for r in filters.comment_id_contains(df, "3726").collect()] == ["x3726y"]
    assert filters.comment_id_contains(df, "37.26").count() == 1
    assert filters.comment_id_contains(df, "37.26", regex=False).count() == 0
    assert [r.comment_id for r in filters.by_user(df, "bob").collect()] == ["37-26"]


def test_hot_keys_are_salted_and_results_stay_whole(table):
    """A third of all comments on one article."""
    rows = random_comments(900)
    comments = table(COMMENTS, *rows)
    details = table(DETAILS, *[(u, "T", None, f"text of {u}", "same") for u in ["hot", "hot", *"abcdef"]])
    found = joins.hot_keys(comments, "url", 100)
    assert [(r.url, r._salts) for r in found.collect()] == [("hot", 3)]
    assert joins.hot_keys(comments, "url") is None

    for join in (joins.comments_with_articles, joins.top_comment_matches):
        plain, salted = join(comments, details), join(comments, details, rows_per_task=7)
        assert salted.columns == plain.columns
        assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))
        assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    joined = joins.comments_with_articles(comments, details, rows_per_task=7)
    assert joined.where("url = 'hot'").count() == 2 * 300

    mine = comments.where("url in ('a', 'hot')").withColumn("username", F.lit("me"))
    for how in ("left", "left_semi", "left_anti"):
        right = mine.select("url", F.lit(1).alias("done")).distinct()
        plain = sorted(map(str, comments.join(right, "url", how).collect()))
        assert sorted(map(str, joins.salted_join(comments, right, "url", how, rows_per_task=7).collect())) == plain


def test_salts_split_a_hot_key(table):
    comments = table(COMMENTS, *random_comments(900))
    details = table(DETAILS, ("hot", "T", None, "x", "same"))
    joined = joins.salted_join(comments, details, "url", spread_by=["comment_id"], rows_per_task=30)
    salt = F.pmod(F.xxhash64("comment_id"), F.lit(10))
    sizes = [r["count"] for r in joined.groupBy(salt).count().collect()]
    assert sum(sizes) == 300 and len(sizes) == 10 and max(sizes) < 60


def test_copies_of_one_article_are_spread_and_kept(table):
    comments = table(COMMENTS, *[(f"c{i}", u, f"t{i}", i, 1, "ann") for i, u in enumerate("hhhabc")])
    rows = [("h", "T", None, "same", "top")] * 57 + [("h", "T", None, None, "top")] * 3
    rows += [("a", "T", None, "x", "top"), ("a", "T", None, "x", "top"), ("b", "T", None, "x", None)]
    details = table(DETAILS, *rows)
    plain = datasets.build_dpo_dataset(comments, details)
    spread = datasets.build_dpo_dataset(comments, details, salting={"rows_per_task": 10})
    assert spread.columns == plain.columns
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))
    assert spread.where("url = 'h'").count() == 57

    portions = joins._as_portions(details.select("url", "article_text"), 10).where("article_text = 'same'").collect()
    assert sorted(r._copies for r in portions) == [9, 9, 9, 10, 10, 10]
    two = joins._as_portions(details.select("url", "article_text"), 30)
    assert sorted(r._copies for r in two.where("article_text = 'same'").collect()) == [28, 29]
    assert joins._repeated(two, step=4).count() == len(rows)


def test_spread_join_builds_its_plan_without_a_job(spark, table):
    rows = [("hot", "same")] * 300 + [(f"k{i % 40}", f"t{i}") for i in range(200)] + [(None, "x")] * 50
    left = table("url STRING, text STRING", *rows, partitions=6)
    right = table("url STRING, m INT", ("hot", 1), *[(f"k{i}", i) for i in range(0, 40, 2)], (None, 1))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "no job may run")
    joined = {size: joins.spread_join(left, right, "url", rows_per_task=size) for size in (3, 50, 1_000_000)}
    datasets.build_dpo_dataset(table(COMMENTS), table(DETAILS))
    assert list(tracker.getJobIdsForGroup("plan-only")) == []
    spark.sparkContext.setJobGroup("others", "")
    plain = sorted(map(str, left.join(right, "url").collect()))
    for found in joined.values():
        assert sorted(map(str, found.collect())) == plain
    tasks = joined[50].withColumn("task", F.spark_partition_id()).where("url = 'hot'")
    plan = joined[50]._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and tasks.count() == 300
    empty = left.where("false")
    assert joins.spread_join(empty, right, "url").count() == joins.spread_join(left, right.where("false"), "url").count() == 0
