"""The jobs a user calls: compositions of the operators."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.urls import url_rehost
from shelfmark.operators.citations import bibtex_parse, filter_bad_export
from shelfmark.operators.dois import doi_list, pending_dois
from shelfmark.operators.holdings import (
    YEAR_FLOOR,
    completeness_gate,
    held_per_issue,
    held_totals,
    progress_per_issue,
    reconcile,
    remote_reconcile,
    to_upload,
    upload_candidates,
    with_holdings,
)
from shelfmark.operators.records import scopus_records, split_quarantine
from shelfmark.operators.select import (
    URL_ORDER,
    collect_queue,
    first_per_issue,
    in_years,
    issue_articles_semi,
    issues_without_archive,
    missing_issues,
    table_order,
)
from shelfmark.operators.skew import lookup
from shelfmark.operators.toc import toc_issues_a, toc_issues_b


@dataclass(frozen=True)
class JobParameters:
    """Parameters of a run, as a flat JSON object holds them; keys it does not know are ignored."""

    journal_name: str = ""
    start_year: int = 0
    end_year: int = 9999
    directory: str = ""
    pivots: str = ""
    master: str = ""
    journal_URL: str = ""
    pivot_scrape_indicator: bool = False

    @classmethod
    def read(cls, path: str) -> JobParameters:
        with open(path, encoding="utf-8-sig") as file:
            given = json.load(file)
        known = {k: v for k, v in given.items() if k in cls.__dataclass_fields__}
        if "year" in given and "start_year" not in given:
            known["start_year"] = known["end_year"] = given["year"]
        known["pivot_scrape_indicator"] = bool(known.get("pivot_scrape_indicator", False))
        return cls(**known)


def job_issue_index(pages: DataFrame, variant: str = "a", **options) -> DataFrame:
    """Table-of-contents pages `(journal, html)` to issues."""
    return {"a": toc_issues_a, "b": toc_issues_b}[variant](pages, **options)


@dataclass(frozen=True)
class CitationLoad:
    articles: DataFrame
    rejected: DataFrame
    missing: DataFrame
    gate: DataFrame


def job_load_citations(
    exports: DataFrame, issues: DataFrame, dialect: str = "a", compat: bool = False
) -> CitationLoad:
    """Exports to articles, with the exports that failed and the issues left without articles.

    `sink_articles` publishes the articles. To count and publish without parsing twice, let it write
    its staging table first.
    """
    good, rejected = filter_bad_export(exports)
    articles = bibtex_parse(good, dialect, compat)
    return CitationLoad(
        articles, rejected, missing_issues(issues, articles), completeness_gate(issues, articles)
    )


@dataclass(frozen=True)
class RecordLoad:
    records: DataFrame
    quarantined: DataFrame


def job_load_records(pages: DataFrame, compat: bool = False) -> RecordLoad:
    return RecordLoad(*split_quarantine(scopus_records(pages, compat)))


@dataclass(frozen=True)
class WorkQueue:
    starts: DataFrame
    queue: DataFrame
    progress: DataFrame
    order: tuple[str, ...] = URL_ORDER


def job_work_queue(
    articles: DataFrame, held: DataFrame, start: int, end: int, host: Column | None = None
) -> WorkQueue:
    """What to fetch of the issues with an article in the years.

    `starts` is each issue's first article in range, `queue` its pending articles, `progress` one
    row per incomplete issue with the URL to begin at, on `host` if one is given. First is what
    comes first in the article table (`file_name`, `record_ordinal`); a table without these columns
    has no order of its own and goes by URL.
    """
    order = table_order(articles)
    placed = [c for c in order if c != "url"]
    narrow = articles.select("issue_url", "url", "year", *placed)
    starts = first_per_issue(narrow.where(in_years(start, end)), order)
    chosen = issue_articles_semi(narrow, start, end)
    flagged = with_holdings(chosen, held, base=narrow)
    queue = flagged.where(~F.col("held")).select("issue_url", "url", *placed)
    progress = progress_per_issue(flagged, order).where(F.col("downloaded") < F.col("total"))
    if host is not None:
        progress = progress.withColumn("next_url", url_rehost(F.col("next_url"), host))
    return WorkQueue(starts, queue, progress, order)


def ordered_queue(work: WorkQueue) -> DataFrame:
    """The queue with positions; writes a checkpoint."""
    return collect_queue(work.queue, work.order)


def job_doi_list(
    articles: DataFrame,
    held: DataFrame,
    start: int,
    end: int,
    distinct: bool = False,
    compat: bool = False,
) -> DataFrame:
    """DOIs of chosen issues whose file is not held."""
    return pending_dois(doi_list(articles, start, end, distinct), held, articles, compat)


def job_archive_queue(issues: DataFrame, names: DataFrame, archive: Column, start: int, end: int) -> DataFrame:
    """Issues of the years whose archive has not come, to be fetched; `archive` names it.

    `names` lists the files that have come; `shelfmark.streaming.arrivals` keeps the same per issue
    while they come in.
    """
    return issues_without_archive(issues, names, archive, start, end)


@dataclass(frozen=True)
class HoldingsAudit:
    per_issue: DataFrame
    totals: DataFrame


def job_holdings_audit(
    issues: DataFrame, articles: DataFrame, held: DataFrame, floor: int = YEAR_FLOOR
) -> HoldingsAudit:
    per_issue = held_per_issue(issues, articles, held)
    return HoldingsAudit(per_issue, held_totals(per_issue, floor))


@dataclass(frozen=True)
class RemoteAudit:
    per_issue: DataFrame
    upload: DataFrame
    totals: DataFrame


def job_remote_audit(
    issues: DataFrame,
    articles: DataFrame,
    held: DataFrame,
    remote: DataFrame,
    floor: int = YEAR_FLOOR,
) -> RemoteAudit:
    per_issue = remote_reconcile(issues, articles, held, remote, floor)
    return RemoteAudit(
        per_issue,
        upload_candidates(issues, articles, held, remote, floor),
        held_totals(per_issue, floor),
    )


def job_bucketed_audit(issues: DataFrame, flagged: DataFrame, floor: int = YEAR_FLOOR) -> RemoteAudit:
    """`job_remote_audit` of articles flagged by `sources.bucketed`, whose join shuffles nothing."""
    per_issue = reconcile(issues, flagged, floor)
    examined = issues.where(F.col("year") >= floor).select("issue_url").distinct()
    wanted = lookup(flagged, examined, "issue_url", "left_semi")
    return RemoteAudit(per_issue, to_upload(wanted), held_totals(per_issue, floor))
