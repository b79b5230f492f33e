"""Joins, selections and numbering with a third of all rows on one key."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import holdings, select, skew

ROWS = 900


@pytest.fixture(scope="module")
def articles(spark):
    """One issue has a third of the rows, another third is copies of one row, one file name is hot."""
    rows = []
    for i in range(ROWS):
        issue = "big" if i % 3 == 0 else "copied" if i % 3 == 1 else f"i{i % 50}"
        if issue == "copied":
            url = "https://x/same"
        elif i % 5 == 0:
            url = f"https://x/{i}/"
        elif i % 50 == 2:
            url = None
        else:
            url = f"https://x/{i}"
        rows.append((None if i % 101 == 0 else issue, url, 1990 + i % 7))
    return spark.createDataFrame(rows, "issue_url string, url string, year int").repartition(7).cache()


@pytest.fixture(scope="module")
def rows(articles):
    return [tuple(r) for r in articles.collect()]


def name(url):
    return None if url is None else url.split("/")[-1] + ".pdf"


HELD = {".pdf", "same.pdf", "2.pdf", "8.pdf", "9.pdf", "nowhere.pdf"}


@pytest.fixture(scope="module")
def held(spark):
    return spark.createDataFrame([(n,) for n in sorted(HELD)] * 3, "name string")


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(params=["hot", "plain"], autouse=True)
def threshold(spark, request):
    spark.conf.set(skew.HOT_ROWS_SETTING, "20" if request.param == "hot" else "1000000")
    yield request.param
    spark.conf.unset(skew.HOT_ROWS_SETTING)


def test_hot_keys_are_found(articles, threshold):
    found = {r.issue_url: r._salts for r in skew.hot_keys(articles, "issue_url").collect()}
    if threshold == "plain":
        assert found == {}
    else:
        assert {"big", "copied"} <= found.keys()
        assert found["big"] >= 12


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti", "inner"])
def test_lookup(spark, articles, rows, how):
    right = {"big": 1, "i2": 2, "none": 3}
    table = spark.createDataFrame(list(right.items()), "issue_url string, value int")
    expected = Counter()
    for issue, url, year in rows:
        if how == "left":
            expected[(issue, url, year, right.get(issue))] += 1
        elif how == "inner" and issue in right:
            expected[(issue, url, year, right[issue])] += 1
        elif how == "left_semi" and issue in right:
            expected[(issue, url, year)] += 1
        elif how == "left_anti" and issue not in right:
            expected[(issue, url, year)] += 1
    assert bag(skew.lookup(articles, table, "issue_url", how)) == expected


def test_copies_of_one_row_spread(spark, articles, threshold):
    """No task gets the whole of a hot key, be its rows all alike."""
    table = spark.createDataFrame([("copied", 1)], "issue_url string, value int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew.lookup(articles, table, "issue_url", "inner")
        sizes = [r[0] for r in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == ROWS / 3 - 3  # three of them have no issue
    assert (len(sizes) > 1) == (threshold == "hot")


def test_hot_keys_are_computed_once(spark, articles, threshold, tmp_path):
    if threshold == "plain":
        return
    articles.write.parquet(str(tmp_path / "articles"))
    stored = spark.read.parquet(str(tmp_path / "articles"))
    table = spark.createDataFrame([("copied", 1)], "issue_url string, value int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew.lookup(stored, table, "issue_url", "inner")
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ReusedExchange" in plan.split("Initial Plan")[0]


def test_holdings(articles, rows, held):
    expected = Counter(r for r in rows if name(r[1]) in HELD)
    assert bag(holdings.holdings_semi(articles, held)) == expected
    assert bag(holdings.pending_anti(articles, held)) == Counter(rows) - expected


def test_semi_and_inner(articles, rows):
    years = {}
    for issue, _, year in rows:
        if issue is not None and 1991 <= year <= 1993:
            years.setdefault(issue, set()).add(year)
    semi = Counter(r for r in rows if r[0] in years)
    assert bag(select.issue_articles_semi(articles, 1991, 1993)) == semi
    inner = Counter((*r, y) for r in rows for y in years.get(r[0], ()))
    assert bag(select.issue_articles_inner(articles, 1991, 1993)) == inner
    counts = Counter(r[0] for r in rows)
    expected = Counter((i, y, counts[i]) for i, ys in years.items() for y in ys)
    assert bag(select.articles_per_issue(articles, 1991, 1993)) == expected


def test_held_per_issue(spark, articles, rows, held):
    listed = [("big", 1995), ("copied", 1930), ("i2", None), ("empty", 2000), ("big", 1995), (None, 1990)]
    issues = spark.createDataFrame(listed, "issue_url string, year int").withColumn(
        "no_docs", F.lit(None).cast("int")
    )
    expected = Counter()
    for issue, year in listed:
        own = [r for r in rows if r[0] == issue and issue is not None]
        expected[(year, None, issue, len(own), sum(name(r[1]) in HELD for r in own))] += 1
    assert bag(holdings.held_per_issue(issues, articles, held)) == expected


def test_numbered_queue(articles, rows):
    queue = select.collect_queue(articles.select("issue_url", "url"))
    expected = Counter()
    groups = {}
    for issue, url, _ in rows:
        groups.setdefault(issue, []).append(url)
    for issue, found in groups.items():
        ordered = sorted(found, key=lambda u: (u is None, u))
        for url, n in Counter(found).items():
            expected[(issue, url, n, ordered.index(url) + 1)] += 1
    assert bag(queue) == expected


def test_equal_rows_are_sorted_in_several_tasks(spark, articles):
    ordered = select.sort_issue_url(articles)
    found = [(r.issue_url, r.url) for r in ordered.collect()]
    key = lambda r: (r[0] is None, r[0] or "", r[1] is None, r[1] or "")
    assert found == sorted(found, key=key)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        placed = ordered.withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len({r.task for r in placed if r.issue_url == "copied"}) > 1


def test_first_per_issue_passes_one_row_per_partition(spark, articles):
    first = select.first_per_issue(articles, ("url", "year"))
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan
    got = {r.issue_url: r.url for r in first.collect()}
    assert got["copied"] == "https://x/same"
    assert got["big"] == min(
        r.url for r in articles.where("issue_url = 'big' and url is not null").collect()
    )
    assert None not in got
