"""All registered queries, each with the SQL that gives the same rows.

A module per kind of operator; every query reads whole tables.
"""

from shelfmark.plans.queries import audits, citations, jobs, records, scalars, selection, toc
from shelfmark.plans.queries.registry import REGISTRY

__all__ = ["REGISTRY", "audits", "citations", "jobs", "records", "scalars", "selection", "toc"]
