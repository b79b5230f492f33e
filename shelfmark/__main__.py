"""Run a job on paths: `python -m shelfmark <job> …`, or through spark-submit."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.urls import issue_file_id_b
from shelfmark.operators.citations import parse_or_reject
from shelfmark.operators.holdings import YEAR_FLOOR
from shelfmark.operators.records import scopus_records
from shelfmark.operators.toc import toc_rejected
from shelfmark.plans import jobs
from shelfmark.schemas import HOLDINGS
from shelfmark.sources import bucketed, files, large, sinks
from shelfmark.streaming import arrivals
from shelfmark.streaming import exports as streaming


PATTERNS = {"a": "*.txt", "b": "*.bib"}


def _held(spark, args):
    """A folder of files, or with --manifest a table with their names."""
    if args.manifest:
        return files.scan_table(spark, args.holdings, HOLDINGS, args.manifest)
    return files.scan_holdings(spark, args.holdings)


def issue_index(spark, args):
    pages = files.scan_html_exports(spark, args.pages).select(
        F.lit(args.journal).alias("journal"), "html"
    )
    sinks.sink_issues(jobs.job_issue_index(pages, args.variant), args.out)
    sinks.write_table(toc_rejected(pages, args.variant), f"{args.out.rstrip('/')}-rejected")


def load_citations(spark, args):
    issues = files.scan_issues(spark, args.issues, args.format)
    if args.compacted:
        exports = large.compacted_exports(spark, args.exports)
    else:
        exports = files.scan_exports(spark, args.exports, PATTERNS[args.variant])
    if args.variant == "b":
        exports = files.named_issue(exports, issues, issue_file_id_b(F.col("issue_url")))
    loaded = parse_or_reject(exports, args.variant, args.compat)
    print(sinks.sink_citation_load(loaded, issues, args.out, args.compat, args.versioned))


def load_records(spark, args):
    records = scopus_records(files.scan_html_exports(spark, args.pages), args.compat)
    sinks.sink_record_load(records, args.out)


def work_queue(spark, args):
    host = F.lit(args.host) if args.host else None
    work = jobs.job_work_queue(
        files.scan_articles(spark, args.articles, args.format), _held(spark, args), args.start, args.end, host
    )
    sinks.write_table(work.progress, f"{args.out}/progress")
    sinks.write_table(jobs.ordered_queue(work), f"{args.out}/queue")


def doi_list(spark, args):
    articles = files.scan_articles(spark, args.articles, args.format)
    dois = jobs.job_doi_list(
        articles, _held(spark, args), args.start, args.end, args.distinct, args.compat
    )
    sinks.write_table(dois, args.out)


def holdings_audit(spark, args):
    issues = files.scan_issues(spark, args.issues, args.format)
    articles = files.scan_articles(spark, args.articles, args.format)
    audit = jobs.job_holdings_audit(issues, articles, _held(spark, args), args.floor)
    sinks.sink_report(audit.per_issue, args.out, args.floor)


def remote_audit(spark, args):
    issues = files.scan_issues(spark, args.issues, args.format)
    articles = files.scan_articles(spark, args.articles, args.format)
    remote = files.scan_remote_holdings(spark, args.remote)
    audit = jobs.job_remote_audit(issues, articles, _held(spark, args), remote, args.floor)
    sinks.sink_report(audit.per_issue, args.out, args.floor)
    sinks.write_table(audit.upload, f"{args.out}/upload")


def bucket_holdings(spark, args):
    articles = files.scan_articles(spark, args.articles, args.format)
    bucketed.bucket_articles(articles, args.store, args.buckets)
    bucket_listings(spark, args)


def bucket_listings(spark, args):
    remote = files.scan_remote_holdings(spark, args.remote)
    bucketed.bucket_listings(_held(spark, args), remote, args.store)


def bucketed_audit(spark, args):
    issues = files.scan_issues(spark, args.issues, args.format)
    audit = jobs.job_bucketed_audit(issues, bucketed.with_holdings(spark, args.store), args.floor)
    sinks.sink_report(audit.per_issue, args.out, args.floor)
    sinks.write_table(audit.upload, f"{args.out}/upload")


def stream_exports(spark, args):
    stream = streaming.read_exports(spark, args.exports, PATTERNS[args.variant])
    if args.variant == "a":
        query = streaming.stream_exports(stream, args.out, args.state)
    else:
        if not args.issues:
            raise SystemExit("variant b needs --issues to tell the issue of a file")
        issues = files.scan_issues(spark, args.issues, args.format)
        query = streaming.stream_exports(stream, args.out, args.state, "b", issues, issue_file_id_b(F.col("issue_url")))
    query.awaitTermination()


def compact_exports(spark, args):
    large.compact_exports(spark, args.exports, args.out, args.state, PATTERNS[args.variant])


def archive_queue(spark, args):
    issues = files.scan_issues(spark, args.issues, args.format)
    archive = issue_file_id_b(F.col("issue_url"), extension=".zip")
    names = files.scan_holdings(spark, args.archives, "*.zip")
    queue = jobs.job_archive_queue(issues, names, archive, args.start, args.end)
    sinks.write_table(queue, args.out)


def stream_arrivals(spark, args):
    names = arrivals.read_arrivals(spark, args.files)
    arrivals.stream_arrivals(names, args.out, args.state).awaitTermination()


JOBS = {
    "issue-index": (issue_index, ["pages", "journal", "out"]),
    "load-citations": (load_citations, ["exports", "issues", "out"]),
    "load-records": (load_records, ["pages", "out"]),
    "work-queue": (work_queue, ["articles", "holdings", "start", "end", "out"]),
    "compact-exports": (compact_exports, ["exports", "out", "state"]),
    "archive-queue": (archive_queue, ["issues", "archives", "start", "end", "out"]),
    "stream-arrivals": (stream_arrivals, ["files", "out", "state"]),
    "doi-list": (doi_list, ["articles", "holdings", "start", "end", "out"]),
    "holdings-audit": (holdings_audit, ["issues", "articles", "holdings", "out"]),
    "remote-audit": (remote_audit, ["issues", "articles", "holdings", "remote", "out"]),
    "bucket-holdings": (bucket_holdings, ["articles", "holdings", "remote", "store"]),
    "bucket-listings": (bucket_listings, ["holdings", "remote", "store"]),
    "bucketed-audit": (bucketed_audit, ["issues", "store", "out"]),
    "stream-exports": (stream_exports, ["exports", "out", "state"]),
}


#: Options that a file of parameters may give, by their names there.
FROM_PARAMETERS = {"start": "start_year", "end": "end_year", "journal": "journal_name"}


def _with_parameters(argv: list[str]) -> list[str]:
    """`--params file.json` as the options it stands for; options given beside it count more."""
    if "--params" not in argv:
        return argv
    at = argv.index("--params")
    given = jobs.JobParameters.read(argv[at + 1])
    rest = argv[:at] + argv[at + 2 :]
    needed = JOBS[rest[0]][1] if rest and rest[0] in JOBS else []
    for option, name in FROM_PARAMETERS.items():
        if option in needed and f"--{option}" not in rest:
            rest += [f"--{option}", str(getattr(given, name))]
    return rest


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="shelfmark", epilog="--params FILE reads years and journal from JSON")
    commands = parser.add_subparsers(dest="job", required=True)
    for name, (_, needed) in JOBS.items():
        command = commands.add_parser(name)
        for option in needed:
            kind = int if option in ("start", "end") else str
            command.add_argument(f"--{option}", type=kind, required=True)
        command.add_argument("--variant", choices=("a", "b"), default="a")
        command.add_argument("--compat", action="store_true")
        command.add_argument("--format", default="parquet", help="of the issue and article tables")
        command.add_argument("--manifest", default="", help="format of --holdings, if a table of names")
        if "issues" not in needed:
            command.add_argument("--issues", default="")
        command.add_argument("--distinct", action="store_true")
        command.add_argument("--compacted", action="store_true", help="--exports is a table of compact-exports")
        command.add_argument("--versioned", action="store_true", help="publish articles as versions")
        command.add_argument("--buckets", type=int, help="of bucket-holdings; shuffle partitions if not given")
        command.add_argument("--host", default="")
        command.add_argument("--floor", type=int, default=YEAR_FLOOR)
    args = parser.parse_args(_with_parameters(list(sys.argv[1:] if argv is None else argv)))
    JOBS[args.job][0](SparkSession.builder.appName(f"shelfmark {args.job}").getOrCreate(), args)


if __name__ == "__main__":
    main()
