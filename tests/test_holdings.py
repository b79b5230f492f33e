"""Reconciliation on small tables."""

from pyspark.sql import functions as F

from shelfmark.operators import holdings as ops
from shelfmark.plans.jobs import job_doi_list, job_remote_audit, job_work_queue, ordered_queue


def tables(spark):
    issues = spark.createDataFrame(
        [("old", 1930, 2), ("new", 1950, None), ("empty", 1960, 3), ("unknown", None, None)],
        "issue_url string, year int, no_docs int",
    )
    articles = spark.createDataFrame(
        [
            ("old", "https://x/1", 1930),
            ("new", "https://x/2", 1950),
            ("new", "https://x/3", 1951),
            ("new", "https://x/A", 1952),
            ("new", None, 1953),
            ("unknown", "https://x/2", 1950),
            (None, "https://x/3", 1950),
        ],
        "issue_url string, url string, year int",
    )
    held = spark.createDataFrame([("1.pdf",), ("2.pdf",), ("2.pdf",), ("a.pdf",)], "name string")
    remote = spark.createDataFrame([("2.pdf", "x"), ("3.pdf", "y"), ("3.pdf", "z")], "name string, id string")
    return issues, articles, held, remote


def by_issue(df, *names):
    return {r.issue_url: tuple(r[n] for n in names) for r in df.collect()}


def test_held_per_issue_counts_all_years(spark):
    issues, articles, held, _ = tables(spark)
    per_issue = ops.held_per_issue(issues, articles, held)
    assert by_issue(per_issue, "expected", "downloaded", "no_docs") == {
        "old": (1, 1, 2),
        "new": (4, 1, None),
        "empty": (0, 0, 3),
        "unknown": (1, 1, None),
    }
    assert tuple(ops.held_totals(per_issue).first()) == (3, 4)


def test_case_of_file_names(spark):
    _, articles, held, _ = tables(spark)
    exact = {r.url for r in ops.holdings_semi(articles, held).collect()}
    assert exact == {"https://x/1", "https://x/2"}
    folded = {r.url for r in ops.holdings_semi(articles, held, ignore_case=True).collect()}
    assert folded == exact | {"https://x/A"}


def test_remote_audit_leaves_old_issues_out(spark):
    audit = job_remote_audit(*tables(spark))
    assert by_issue(audit.per_issue, "expected", "downloaded", "uploaded", "upload_candidates") == {
        "old": (0, 0, 0, 0),
        "new": (4, 1, 2, 0),
        "empty": (0, 0, 0, 0),
        "unknown": (0, 0, 0, 0),
    }
    assert audit.upload.collect() == []
    floored = job_remote_audit(*tables(spark), floor=1900)
    assert [tuple(r) for r in floored.upload.collect()] == [("old", "https://x/1", "1.pdf")]


def test_remote_names_are_counted_once(spark):
    issues, articles, held, remote = tables(spark)
    again = articles.unionAll(articles)
    counted = ops.remote_per_issue(issues, again, held, remote, floor=1900)
    assert by_issue(counted, "downloaded", "uploaded") == {
        "old": (1, 0),
        "new": (1, 2),
        "empty": (0, 0),
    }


def test_held_and_pending_are_all(spark):
    _, articles, held, _ = tables(spark)
    flagged = ops.with_holdings(articles, held)
    assert flagged.count() == 7
    kept = ops.holdings_semi(articles, held).count()
    assert kept + ops.pending_anti(articles, held).count() == 7


def test_gate(spark):
    issues, articles, _, _ = tables(spark)
    row = ops.completeness_gate(issues, articles).first()
    assert row.asDict() == {
        "issue_rows": 4,
        "issues": 4,
        "issues_with_articles": 4,  # the null issue of one article counts as one
        "missing": 1,
        "complete": False,
        "complete_by_count": True,
    }
    nothing = articles.limit(0)
    assert ops.completeness_gate(issues.limit(0), nothing).first().complete


def test_work_queue(spark):
    _, articles, held, _ = tables(spark)
    named = articles.where(F.col("url").isNotNull())
    work = job_work_queue(named, held, 1950, 1950, F.lit("proxy.org"))
    assert {(r.issue_url, r.url) for r in work.starts.collect()} == {
        ("new", "https://x/2"),
        ("unknown", "https://x/2"),
    }
    assert {(r.issue_url, r.url) for r in work.queue.collect()} == {
        ("new", "https://x/3"),
        ("new", "https://x/A"),
    }
    assert by_issue(work.progress, "downloaded", "total", "next_url") == {
        "new": (1, 3, "https://proxy.org/3")
    }


def test_doi_list(spark):
    base = "https://www.jstor.org/stable/"
    articles = spark.createDataFrame(
        [
            ("i", base + "1", 2016),
            ("i", base + "10.1086/2", 2017),
            ("i", base + "3", None),
            ("j", base + "4", 2000),
        ],
        "issue_url string, url string, year int",
    )
    held = spark.createDataFrame([("3.pdf",)], "name string")
    dois = [r.doi for r in job_doi_list(articles, held, 2016, 2017).collect()]
    assert sorted(dois) == ["10.1086/2", "10.1086/2", "10.2307/1", "10.2307/1"]
    once = [r.doi for r in job_doi_list(articles, held, 2016, 2017, distinct=True).collect()]
    assert sorted(once) == ["10.1086/2", "10.2307/1"]


def test_queue_in_table_order(spark):
    schema = "issue_url string, url string, year int, file_name string, record_ordinal int"
    base = "https://x/"
    rows = [("i", base + n, 1950, "i.txt", k) for k, n in enumerate(("8", "9", "10", "11"))]
    rows.append(("i", None, 1950, "i.txt", 0))
    held = spark.createDataFrame([("8.pdf",)], "name string")
    work = job_work_queue(spark.createDataFrame(rows, schema), held, 1950, 1950)
    assert [r.url for r in work.starts.collect()] == [base + "8"]
    assert by_issue(work.progress, "downloaded", "total", "next_url") == {"i": (1, 5, base + "9")}
    queue = ordered_queue(work).where("url is not null").orderBy("position").collect()
    assert [r.url for r in queue] == [base + "9", base + "10", base + "11"]
