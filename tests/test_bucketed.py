"""Articles and listings bucketed by file name: what audits give, and how they run."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfmark import __main__ as cli
from shelfmark.operators import holdings, skew
from shelfmark.sources import bucketed
from shelfmark.sources.marks import Marks

ISSUES = [("big", 1990, 1), ("i1", 1995, 2), ("i2", 1930, 3), ("empty", 1999, None)]


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def articles(spark):
    """A third of the rows has one file name, another part has none; one row is there many times."""
    rows = []
    for i in range(600):
        url = "https://x/same" if i % 3 == 0 else None if i % 7 == 0 else f"https://x/{i}"
        rows.append(("big" if i % 2 else f"i{i % 3}", url, 1990 + i % 5))
    rows += [("big", "https://x/copied", 1991)] * 100
    return spark.createDataFrame(rows, "issue_url string, url string, year int").repartition(5).cache()


@pytest.fixture(scope="module")
def held(spark):
    names = ["same.pdf", "1.pdf", "2.pdf", "copied.pdf", "nowhere.pdf", None]
    return spark.createDataFrame([(n,) for n in names * 2], "name string")


@pytest.fixture(scope="module")
def remote(spark):
    return spark.createDataFrame([("2.pdf",), ("4.pdf",), ("copied.pdf",)], "name string")


@pytest.fixture(scope="module")
def issues(spark):
    return spark.createDataFrame(ISSUES, "issue_url string, year int, no_docs int")


@pytest.fixture(params=["20", "1000000"], ids=["hot", "plain"])
def store(spark, tmp_path, articles, held, remote, request):
    spark.conf.set(skew.HOT_ROWS_SETTING, request.param)
    path = str(tmp_path / "store")
    bucketed.bucket_articles(articles, path, 6)
    bucketed.bucket_listings(held, remote, path)
    yield path
    spark.conf.unset(skew.HOT_ROWS_SETTING)


def test_flags_are_those_of_the_join(spark, store, articles, held, remote):
    assert bag(bucketed.with_holdings(spark, store)) == bag(holdings.with_holdings(articles, held, remote))
    assert bag(bucketed.holdings_semi(spark, store)) == bag(holdings.holdings_semi(articles, held))
    assert bag(bucketed.pending_anti(spark, store)) == bag(holdings.pending_anti(articles, held))


@pytest.mark.parametrize("operator", [bucketed.with_holdings, bucketed.holdings_semi, bucketed.pending_anti])
def test_the_join_shuffles_neither_side(spark, store, operator):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = operator(spark, store)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        sizes = joined.groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert 1 < sizes <= 6


def test_a_hot_name_lies_in_several_buckets(spark, store):
    articles, _ = bucketed._pair(spark, store)
    files = articles.where("_name = 'same.pdf'").select(F.input_file_name()).distinct().count()
    assert (files > 1) == (spark.conf.get(skew.HOT_ROWS_SETTING) == "20")


def test_listings_are_replaced_as_a_pair(spark, store, articles, held):
    """A new listing keeps the articles; new articles do not count before their listing."""
    before = bag(bucketed.with_holdings(spark, store))
    some = articles.where("url is null")
    bucketed.bucket_articles(some, store, 3)
    assert bag(bucketed.with_holdings(spark, store)) == before
    bucketed.bucket_listings(held, None, store)
    assert bag(bucketed.with_holdings(spark, store)) == bag(holdings.with_holdings(some, held))
    for _ in range(2):
        bucketed.bucket_listings(held.where("false"), None, store)
    assert not bucketed.with_holdings(spark, store).where("held or remote").head(1)
    # Two listings of the new articles, those articles, and their hot names.
    assert len(Marks(spark, store).names("data")) == 4


def test_another_session_reads_the_store(spark, store):
    """The catalog of a new session does not know the tables."""
    expected = bag(bucketed.pending_anti(spark, store))
    for folder in Marks(spark, store).names("data"):
        spark.sql(f"DROP TABLE IF EXISTS shelfmark_{folder}")
    assert bag(bucketed.pending_anti(spark, store)) == expected
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = bucketed.pending_anti(spark, store)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan


def test_empty_tables(spark, tmp_path, articles, held):
    path = str(tmp_path / "store")
    with pytest.raises(ValueError):
        bucketed.bucket_listings(held, None, path)
    bucketed.bucket_articles(articles.where("false"), path, 2)
    bucketed.bucket_listings(held, None, path)
    assert bucketed.with_holdings(spark, path).columns == [*articles.columns, "held", "remote"]
    assert bag(bucketed.with_holdings(spark, path)) == Counter()


def test_commands(spark, tmp_path, articles, held, remote, issues, monkeypatch):
    monkeypatch.chdir(tmp_path)
    for table, name in ((articles, "articles"), (held.where("name is not null"), "held"), (remote, "remote"), (issues, "issues")):
        table.write.parquet(str(tmp_path / name))
    listings = ["--holdings", str(tmp_path / "held"), "--manifest", "parquet", "--remote", str(tmp_path / "remote")]
    store = str(tmp_path / "store")
    cli.main(["bucket-holdings", "--articles", str(tmp_path / "articles"), *listings, "--store", store, "--buckets", "4"])
    cli.main(["bucket-listings", *listings, "--store", store])
    cli.main(["bucketed-audit", "--issues", str(tmp_path / "issues"), "--store", store, "--out", str(tmp_path / "new")])
    cli.main(["remote-audit", "--issues", str(tmp_path / "issues"), "--articles", str(tmp_path / "articles"), *listings, "--out", str(tmp_path / "old")])
    uploads = [spark.read.parquet(str(tmp_path / x / "upload")) for x in ("new", "old")]
    assert bag(uploads[0]) == bag(uploads[1]) and bag(uploads[0])
    assert len(Marks(spark, store).numbers("listings")) == 2
