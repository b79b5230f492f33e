"""Queries by name, and the SQL views their oracles share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.text import WHITESPACE

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(run, sql)
        return run

    return register


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Integers that may be null, as text: readers of results differ in how they show them."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


START, END, FLOOR = 1996, 1997, 1998

SPACE = "||".join(f"chr({ord(c)})" for c in WHITESPACE)

_KEY = "l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber"

_VIEWS = {
    "issues": """
        SELECT 'https://ex.org/stable/' || o_orderkey AS issue_url,
               CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS issue_text,
               'J' || o_custkey AS journal, CAST(NULL AS VARCHAR) AS no_docs
        FROM orders""",
    "articles": f"""
        SELECT 'https://ex.org/stable/' || l_orderkey AS issue_url,
               'https://ex.org/a/' || {_KEY} AS url, CAST(year(l_shipdate) AS INTEGER) AS year
        FROM lineitem""",
    "placed": f"""
        SELECT 'https://ex.org/stable/' || l_orderkey AS issue_url,
               'https://ex.org/a/' || {_KEY} AS url, CAST(year(l_shipdate) AS INTEGER) AS year,
               l_orderkey || '.txt' AS file_name, CAST(100 - l_linenumber AS INTEGER) AS record_ordinal
        FROM lineitem""",
    "flagged_places": """
        SELECT *, list_last(string_split(url, '/')) || '.pdf' IN (SELECT name FROM holdings) AS held
        FROM placed""",
    "named": """
        SELECT *, list_last(string_split(url, '/')) || '.pdf' AS name FROM articles""",
    "holdings": f"""
        SELECT DISTINCT {_KEY} || '.pdf' AS name FROM lineitem WHERE l_returnflag = 'R'""",
    "remote": f"""
        SELECT DISTINCT {_KEY} || '.pdf' AS name FROM lineitem WHERE l_linestatus = 'F'""",
    "flagged": """
        SELECT *, name IN (SELECT name FROM holdings) AS held,
               name IN (SELECT name FROM remote) AS remote
        FROM named""",
    "dois": """
        SELECT 'https://ex.org/stable/' || l_orderkey AS issue_url,
               CASE WHEN l_linenumber % 2 = 0 THEN '10.1086/' ELSE '10.2307/' END || l_orderkey AS doi,
               CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag
        FROM lineitem""",
    "lines": """
        SELECT doc_id, lang, source, n_chars, text, string_split(text, chr(10)) AS parts
        FROM documents""",
    "line": """
        SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, parts[i] AS line
        FROM lines, unnest(generate_series(1, len(parts))) AS g(i)""",
}

_NEEDS = {"flagged_places": ["placed", "holdings"], "named": ["articles"], "flagged": ["named", "holdings", "remote"], "line": ["lines"]}


def views(*names: str) -> str:
    """`WITH` clause of the named views and those they read."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        add(name)
    return "WITH " + ", ".join(f"{name} AS ({_VIEWS[name]})" for name in wanted)
