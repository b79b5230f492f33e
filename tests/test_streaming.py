"""Exports arriving in several drops give the table a batch load gives."""

import os

import pytest
from pyspark.sql import functions as F

from shelfmark.functions.urls import issue_file_id_b
from shelfmark.operators.citations import BAD_EXPORT, parse_or_reject
from shelfmark.plans.jobs import job_archive_queue, job_load_citations
from shelfmark.sources.files import named_issue, scan_exports
from shelfmark.streaming import arrivals
from shelfmark.streaming import exports as streaming
from shelfmark.streaming.store import RunStore
from tests.test_sources import PREFIX, issue_table


def export(*titles):
    entries = [f"@article{{k{t},\n title = {{{t}}},\n year = {{1950}}\n}}\n" for t in titles]
    return "@comment{{x}}\n" + "".join(entries)


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()
    clock = [1_700_000_000]

    def drop(name, text):
        path = folder / name
        path.write_text(text, encoding="utf-8")
        clock[0] += 10
        os.utime(path, (clock[0], clock[0]))

    return str(folder), drop


def test_drops_equal_one_batch(spark, tmp_path, inbox):
    folder, drop = inbox
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    issues = issue_table(spark, "i1", "i2", "i3")

    def run():
        stream = streaming.read_exports(spark, folder)
        streaming.stream_exports(stream, table, state).awaitTermination()

    drop("i1.txt", export("a", "b"))
    drop("i2.txt", f"{BAD_EXPORT}\n")
    run()
    assert streaming.current_articles(spark, table).count() == 2
    assert [r.issue_url for r in streaming.rejected_exports(spark, table).collect()] == [PREFIX + "i2"]
    missing = streaming.stream_resume(spark, issues, table)
    assert {r.issue_url for r in missing.collect()} == {PREFIX + "i2", PREFIX + "i3"}

    drop("i3.txt", export("c"))
    run()
    run()  # nothing new
    batch = job_load_citations(scan_exports(spark, folder), issues).articles
    columns = ["issue_url", "file_name", "record_ordinal", "title", "year"]
    streamed = streaming.current_articles(spark, table)
    assert sorted(streamed.select(columns).collect()) == sorted(batch.select(columns).collect())

    # An export fetched again replaces the issue's rows; one that failed again does not.
    drop("i1~2.txt", export("d"))
    drop("i3~2.txt", f"{BAD_EXPORT}\n")
    drop("i2~2.txt", export("e"))
    run()
    titles = {(r.issue_url, r.title) for r in streaming.current_articles(spark, table).collect()}
    assert titles == {(PREFIX + "i1", "d"), (PREFIX + "i2", "e"), (PREFIX + "i3", "c")}
    assert streaming.stream_resume(spark, issues, table).count() == 0


def test_newest_of_two_files_in_one_drop(spark, tmp_path, inbox):
    folder, drop = inbox
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    drop("i1~z.txt", export("old"))
    drop("i1~a.txt", export("new"))
    stream = streaming.read_exports(spark, folder)
    streaming.stream_exports(stream, table, state).awaitTermination()
    assert [r.title for r in streaming.current_articles(spark, table).collect()] == ["new"]


def test_the_other_feed_and_a_first_run(spark, tmp_path, inbox):
    folder, drop = inbox
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    base = "https://www.sciencedirect.com/journal/"
    issues = spark.createDataFrame([(base + "j/vol/1", 1950), (base + "j/vol/2", 1950)], "issue_url string, year int")
    assert streaming.stream_resume(spark, issues, table).count() == 2
    assert streaming.rejected_exports(spark, table).count() == 0
    drop("j_vol_1.bib", export("a"))
    drop("j_vol_1~2.bib", export("b"))
    drop("unknown.bib", export("c"))
    stream = streaming.read_exports(spark, folder, "*.bib", files_per_batch=1)
    streaming.stream_exports(stream, table, state, "b", issues, issue_file_id_b(F.col("issue_url"))).awaitTermination()
    assert [(r.issue_url, r.title) for r in streaming.current_articles(spark, table).collect()] == [
        (base + "j/vol/1", "b")
    ]
    assert [r.file_name for r in streaming.rejected_exports(spark, table).collect()] == ["unknown.bib"]
    assert [r.issue_url for r in streaming.stream_resume(spark, issues, table).collect()] == [base + "j/vol/2"]


STORED = "k string, v int, ok boolean, at int"


def _rows(spark, *rows):
    return spark.createDataFrame(rows, STORED)


def _live(store):
    return sorted((r.k or "", r.v) for r in store.current().collect())


def test_store_of_many_runs(spark, tmp_path):
    """What many runs give equals a dictionary that they update, folded or not, and read in between."""
    import random

    rng = random.Random(4)
    schema = spark.createDataFrame([], STORED).schema
    store = RunStore(spark, str(tmp_path / "store"), schema, "k", ("at",), "ok")
    expected: dict = {}
    assert _live(store) == []
    for run in range(14):
        rows = []
        for key in rng.sample([None, "a", "b", "c", "d", "e", "f"], rng.randint(0, 4)):
            groups = rng.sample(range(100), rng.randint(1, 2))
            for at in groups:
                rows += [(key, rng.randint(0, 9), True, at) for _ in range(rng.randint(1, 2))]
            if rng.random() < 0.3:
                rows.append((key, -1, False, 1000))
            expected[key] = [r[1] for r in rows if r[0] == key and r[2] and r[3] == max(groups)]
        if rng.random() < 0.5:
            rows.append(("only dead", -1, False, 5))
        batch = _rows(spark, *rows)
        held = store.write(batch, run)
        assert held.where("not ok").count() == sum(not r[2] for r in rows)
        store.write(_rows(spark, ("a", 99, True, 1)), run)  # a run written again changes nothing
        wanted = sorted((k or "", v) for k, vs in expected.items() for v in vs)
        assert _live(store) == wanted
        if run in (2, 3, 8, 11):
            begun = store.current()
            assert store.fold(1)
            assert _live(store) == wanted and sorted((r.k or "", r.v) for r in begun.collect()) == wanted
            plan = store.current()._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "Join" not in plan
    assert not store.fold(5)
    data = [p.name for p in (tmp_path / "store" / "data").iterdir()]
    assert len(data) == 2 + 5  # two bases, and the runs since the older one
    store.write(_rows(spark, ("a", 99, True, 1)), 1)
    assert _live(store) == wanted


def test_a_run_that_failed_is_not_seen(spark, tmp_path):
    schema = spark.createDataFrame([], STORED).schema
    store = RunStore(spark, str(tmp_path / "store"), schema, "k")
    store.write(_rows(spark, ("a", 1, True, 0)), 0)
    _rows(spark, ("a", 2, True, 0)).write.parquet(f"{store.path}/data/run-1-unfinished")
    assert _live(store) == [("a", 1)]
    store.write(_rows(spark, ("b", 3, True, 0)), 1)
    store.fold(1)
    assert _live(store) == [("a", 1), ("b", 3)]
    assert "run-1-unfinished" not in [p.name for p in (tmp_path / "store" / "data").iterdir()]


def test_stream_folds_its_batches(spark, tmp_path, inbox):
    folder, drop = inbox
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    for i in range(7):
        drop(f"i{i % 3}~{i}.txt", export(f"t{i}") if i != 5 else BAD_EXPORT)
    stream = streaming.read_exports(spark, folder, files_per_batch=1)
    streaming.stream_exports(stream, table, state, fold_after=2).awaitTermination()
    titles = {(r.issue_url, r.title) for r in streaming.current_articles(spark, table).collect()}
    assert titles == {(PREFIX + "i0", "t6"), (PREFIX + "i1", "t4"), (PREFIX + "i2", "t2")}
    assert [(r.issue_url, r.problem) for r in streaming.rejected_exports(spark, table).collect()] == [
        (PREFIX + "i2", "failed export")
    ]


def test_arrivals_in_drops(spark, tmp_path, inbox):
    folder, drop = inbox
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    issues = issue_table(spark, "i1", "i2", "i3")

    def run():
        names = arrivals.read_arrivals(spark, folder, files_per_batch=2)
        arrivals.stream_arrivals(names, table, state, fold_after=2).awaitTermination()
        known = arrivals.issue_arrivals(issues, arrivals.arrived(spark, table), F.substring_index("issue_url", "/", -1))
        return {r.issue_url[-2:]: (r.n_exports, r.n_archives, r.export_at is not None) for r in known.collect()}

    drop("i1.txt", "x")
    drop("i1.zip.part", "x")
    drop("other.pdf", "x")
    assert run() == {"i1": (1, 0, True), "i2": (0, 0, False), "i3": (0, 0, False)}
    drop("i1~2.txt", "x")
    drop("i1.zip", "x")
    drop("i2.zip", "x")
    assert run() == {"i1": (2, 1, True), "i2": (0, 1, False), "i3": (0, 0, False)}
    assert run()["i1"] == (2, 1, True)
    names = spark.createDataFrame([(n,) for n in os.listdir(folder)], "name string")
    archive = F.concat(F.substring_index("issue_url", "/", -1), F.lit(".zip"))
    queue = job_archive_queue(issues, names, archive, 0, 9999)
    assert [r.issue_url[-2:] for r in queue.collect()] == ["i3"]
    batch = arrivals.arrivals_of(names.withColumn("arrived", F.lit(0).cast("timestamp")))
    streamed = arrivals.arrived(spark, table)
    counts = ("stem", "n_exports", "n_archives")
    assert sorted(batch.select(*counts).collect()) == sorted(streamed.select(*counts).collect())


def test_texts_of_the_other_feed_are_not_shuffled(spark):
    exports = spark.createDataFrame([("j_1.bib", "@article{k, title = {t}}")], "file_name string, value string")
    issues = spark.createDataFrame([("https://www.sciencedirect.com/journal/j/1", 1)], "issue_url string, year int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        named = named_issue(exports, issues, issue_file_id_b(F.col("issue_url")))
        plan = parse_or_reject(named, "b")._jdf.queryExecution().executedPlan().toString()
        far = named_issue(exports, issues, issue_file_id_b(F.col("issue_url")), most_sent=0)
        rows = [parse_or_reject(n, "b").select("issue_url", "title").collect() for n in (named, far)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan
    for line in plan.splitlines():
        assert "Exchange hashpartitioning" not in line or "value" not in line
    assert rows[0] == rows[1] == [("https://www.sciencedirect.com/journal/j/1", "t")]
