"""Selection of work on small tables."""

from shelfmark.operators import select


def articles(spark, *rows):
    return spark.createDataFrame(list(rows), "issue_url string, url string, year int")


def test_first_per_issue(spark):
    table = articles(
        spark,
        ("b", "2", 1),
        (None, "1", 1),
        ("a", None, 1),
        ("a", "9", 1),
        (None, "0", 1),
        ("c", None, 1),
    )
    first = {(r.issue_url, r.url) for r in select.first_per_issue(table).collect()}
    assert first == {("a", "9"), ("b", "2"), ("c", None)}


def test_year_range_is_inclusive_and_drops_null(spark):
    table = articles(spark, ("a", "1", 1945), ("a", "2", 1946), ("a", "3", 1950), ("a", "4", None))
    kept = [r.url for r in select.filter_year_range(table, 1946, 1950).collect()]
    assert sorted(kept) == ["2", "3"]


def test_sorted_by_issue_and_url(spark):
    table = articles(spark, ("b", "2", 1), (None, "1", 1), ("a", None, 1), ("a", "9", 1))
    ordered = [(r.issue_url, r.url) for r in select.sort_issue_url(table).collect()]
    assert ordered == [("a", "9"), ("a", None), ("b", "2"), (None, "1")]


def test_union_fills_missing_columns(spark):
    left = spark.createDataFrame([("a", 1)], "issue_url string, year int")
    right = spark.createDataFrame([("u", "b")], "url string, issue_url string")
    rows = {tuple(r) for r in select.union_by_name(left, right).collect()}
    assert rows == {("a", 1, None), ("b", None, "u")}


def test_order_of_export(spark):
    rows = [("i", "f2", 0, "u1"), ("i", "f1", 10, "u2"), ("i", "f1", 9, "u3")]
    table = spark.createDataFrame(
        rows, "issue_url string, file_name string, record_ordinal int, url string"
    )
    assert select.next_pending(table, select.EXPORT_ORDER).first().url == "u3"
    queue = select.collect_queue(table, select.EXPORT_ORDER).orderBy("position").collect()
    assert [(r.position, r.url) for r in queue] == [(1, "u3"), (2, "u2"), (3, "u1")]


def test_missing_issues(spark):
    issues = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "issue_url string")
    missing = select.missing_issues(issues, articles(spark, ("a", "1", 1), (None, "2", 1)))
    assert sorted(r.issue_url or "-" for r in missing.collect()) == ["-", "b", "b"]
