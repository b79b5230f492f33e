"""The jobs on paths, one after the other."""

from shelfmark.__main__ import main
from shelfmark import schemas
from shelfmark.plans import jobs
from shelfmark.sources.files import scan_articles
from shelfmark.streaming import arrivals
from shelfmark.streaming.exports import current_articles
from tests.test_citations import SAMPLE_A
from tests.test_records import FULL
from tests.test_toc import PAGE_A

EXPORT = "@comment{{x}}\n" + "".join(
    f"@article{{10.2307/{i},\n URL = {{http://www.jstor.org/stable/{i}}},\n year = {{1946}}\n}}\n"
    for i in (7, 8)
)


def test_jobs_on_paths(spark, tmp_path):
    def path(name):
        return str(tmp_path / name)

    for folder in ("toc", "exports", "pages", "pdf"):
        (tmp_path / folder).mkdir()
    (tmp_path / "toc" / "j.html").write_text(PAGE_A, encoding="utf-8")
    main(["issue-index", "--pages", path("toc"), "--journal", "J", "--out", path("issues")])
    assert spark.read.parquet(path("issues")).count() == 2

    (tmp_path / "exports" / "i1.txt").write_text(SAMPLE_A, encoding="utf-8")
    load = ["load-citations", "--exports", path("exports"), "--issues", path("issues")]
    main([*load, "--out", path("load")])
    assert not (tmp_path / "load" / "articles").exists()  # an issue is missing
    (tmp_path / "exports" / "i2?a=1&b.txt").write_text(EXPORT, encoding="utf-8")
    main([*load, "--out", path("load")])
    articles = path("load") + "/articles"
    assert spark.read.parquet(articles).count() == 4

    (tmp_path / "pdf" / "7.pdf").write_text("x")
    held = ["--holdings", path("pdf")]
    main(["holdings-audit", "--issues", path("issues"), "--articles", articles, *held, "--out", path("audit")])
    totals = spark.read.parquet(path("audit") + "/totals").first()
    assert (totals.held_total, totals.expected_since) == (1, 4)

    years = ["--start", "1946", "--end", "1946"]
    main(["work-queue", "--articles", articles, *held, *years, "--host", "p.org", "--out", path("work")])
    progress = {
        r.issue_url[-1]: r for r in spark.read.parquet(path("work") + "/progress").collect()
    }
    assert progress["b"].next_url == "https://p.org/stable/8"
    assert (progress["b"].downloaded, progress["b"].total) == (1, 2)
    assert spark.read.parquet(path("work") + "/queue").count() == 3

    main(["doi-list", "--articles", articles, *held, *years, "--distinct", "--out", path("dois")])
    assert "10.2307/8" in {r.doi for r in spark.read.parquet(path("dois")).collect()}

    spark.createDataFrame(
        [("8.pdf", "x", "application/pdf")], "name string, id string, mime_type string"
    ).write.parquet(path("remote"))
    main(
        ["remote-audit", "--issues", path("issues"), "--articles", articles, *held]
        + ["--remote", path("remote"), "--out", path("remote-audit")]
    )
    upload = spark.read.parquet(path("remote-audit") + "/upload").collect()
    assert [r.name for r in upload] == ["7.pdf"]

    (tmp_path / "pages" / "p.html").write_text(FULL, encoding="utf-8")
    main(["load-records", "--pages", path("pages"), "--out", path("records")])
    stored = spark.read.parquet(path("records"))
    assert stored.where("not quarantined").count() == 1
    assert jobs.job_load_records(spark.createDataFrame([("p", FULL)], "file_name string, html string")).quarantined.count() == 0

    main(["stream-exports", "--exports", path("exports"), "--out", path("table"), "--state", path("state")])
    assert current_articles(spark, path("table")).count() == 4


def test_archives_versions_and_parameters(spark, tmp_path):
    base = "https://www.sciencedirect.com/journal/j/vol/"
    issues = [(base + str(i), 1980 + i, "t", "j", None) for i in (1, 2, 3)]
    spark.createDataFrame(issues, schemas.ISSUES).write.parquet(str(tmp_path / "issues"))
    files = tmp_path / "files"
    files.mkdir()
    for name in ("j_vol_1.bib", "j_vol_2.bib", "j_vol_3.bib"):
        (files / name).write_text(f"@article{{k,\n title = {{{name}}},\n year = {{1980}}\n}}\n")
    for name in ("j_vol_1.zip", "j_vol_3.zip.part"):
        (files / name).write_bytes(b"x")
    parameters = tmp_path / "inputs.json"
    parameters.write_text('{"start_year": 1981, "end_year": 1982, "journal_name": "j"}')
    common = ["--issues", str(tmp_path / "issues")]
    main(["archive-queue", *common, "--archives", str(files), "--params", str(parameters), "--out", str(tmp_path / "queue")])
    assert [(r.issue_url, r.archive) for r in spark.read.parquet(str(tmp_path / "queue")).collect()] == [
        (base + "2", "j_vol_2.zip")
    ]
    main(["archive-queue", *common, "--archives", str(files), "--params", str(parameters), "--end", "1983", "--out", str(tmp_path / "queue")])
    assert spark.read.parquet(str(tmp_path / "queue")).count() == 2

    main(["stream-arrivals", "--files", str(files), "--out", str(tmp_path / "state"), "--state", str(tmp_path / "check")])
    known = {r.stem: (r.n_exports, r.n_archives) for r in arrivals.arrived(spark, str(tmp_path / "state")).collect()}
    assert known == {"j_vol_1": (1, 1), "j_vol_2": (1, 0), "j_vol_3": (1, 0)}

    load = ["load-citations", "--exports", str(files), *common, "--variant", "b", "--versioned", "--out", str(tmp_path / "load")]
    main(load)
    articles = str(tmp_path / "load" / "articles")
    assert scan_articles(spark, articles).count() == 3
    before = scan_articles(spark, articles)
    (files / "unknown.bib").write_text("@article{k, title = {u}}")
    (files / "j_vol_3.bib").write_text("@article{k, title = {v}}\n@article{l, title = {w}}")
    main(load)
    assert before.count() == 3 and scan_articles(spark, articles).count() == 4
    rejected = spark.read.parquet(str(tmp_path / "load" / "rejected")).collect()
    assert [(r.file_name, r.problem) for r in rejected] == [("unknown.bib", "no issue")]
    (files / "j_vol_2.bib").write_text("nothing")
    main(load)
    assert scan_articles(spark, articles).count() == 4
    (files / "j_vol_2.bib").write_text("@article{k, title = {x}}")
    main(load)
    assert len(list((tmp_path / "load" / "articles" / "data").iterdir())) == 2
    compact = ["compact-exports", "--exports", str(files), "--variant", "b", "--out", str(tmp_path / "table"), "--state", str(tmp_path / "seen")]
    main(compact)
    main(compact)
    main([*load[:1], "--exports", str(tmp_path / "table"), *load[3:-1], str(tmp_path / "again"), "--compacted"])
    assert scan_articles(spark, str(tmp_path / "again" / "articles")).count() == 4
