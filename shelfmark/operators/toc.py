"""Table-of-contents pages to issue rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.markup import (
    attribute,
    bare_text,
    elements,
    elements_with_tag,
    first_element,
    normal_tags,
    opening_tag,
)
from shelfmark.functions.entities import unescape
from shelfmark.functions.text import (
    issue_label,
    pinned,
    whitespace_strip,
    year_cast,
    year_from_status,
)
from shelfmark.functions.urls import ISSUE_BASE_A, url_absolutise

# Element and class names of the two feeds.
LINK_A = "collection-view-pharos-link"
ITEM_B = "issue-item u-margin-s-bottom"
ANCHOR_B = "anchor js-issue-item-link text-m anchor-default"
STATUS_B = "js-issue-status text-s"


def links_extract(pages: DataFrame, tag: str = "a", html: str = "html") -> DataFrame:
    """One row per link, `(…, position, href, text)`; keeps the columns of `pages` but its HTML."""
    kept = [c for c in pages.columns if c != html]
    found = elements_with_tag(normal_tags(F.col(html), tag), tag, attribute="href")
    raw = pages.select(*kept, F.posexplode(found).alias("position", "_link")).select(
        *kept,
        "position",
        attribute(F.col("_link.tag"), "href").alias("_href"),
        bare_text(F.col("_link.inner")).alias("_text"),
    )
    return raw.select(
        *kept,
        "position",
        unescape(F.col("_href")).alias("href"),
        whitespace_strip(unescape(F.col("_text"))).alias("text"),
    )


def _within(html: Column, tag: str) -> Column:
    """What follows the first opening tag; null without one."""
    return F.get(F.split(html, opening_tag(tag), 2), F.lit(1))


def year_blocks(pages: DataFrame, html: str = "html") -> DataFrame:
    """The list items that carry a year, one row each; items without one hold no issues of their own.

    An item counts in a list of a definition (`dd`, `ul`), and of it the items of its own list.
    """
    kept = [c for c in pages.columns if c != html]
    lists = pages.select(*kept, F.explode(elements(normal_tags(F.col(html), LINK_A), "dd")).alias("_dd"))
    items = elements_with_tag(_within(F.col("_dd"), "ul"), "li", attribute="data-year")
    return lists.select(*kept, F.explode(items).alias("_item")).select(
        *kept,
        attribute(F.col("_item.tag"), "data-year").alias("data_year"),
        F.coalesce(_within(_within(F.col("_item.inner"), "ul"), "li"), F.lit("")).alias(html),
    )


def toc_issues_a(pages: DataFrame, base: str = ISSUE_BASE_A) -> DataFrame:
    """`(journal, html)` to issues: year list items, and the issue links inside them."""
    links = links_extract(year_blocks(pages), LINK_A)
    return links.select(
        url_absolutise(F.col("href"), base).alias("issue_url"),
        year_cast(F.col("data_year")).alias("year"),
        F.col("text").alias("issue_text"),
        "journal",
        F.lit(None).cast("int").alias("no_docs"),
    )


def _blocks_b(pages: DataFrame) -> DataFrame:
    items = elements(normal_tags(F.col("html")), "div", cls=ITEM_B, exact=True)
    return pages.select("journal", F.posexplode(items).alias("position", "_item"))


def toc_rejected(pages: DataFrame, variant: str = "a") -> DataFrame:
    """`(journal, position, problem, block)` of links and issue blocks that give no issue."""
    if variant == "a":
        found = elements_with_tag(F.col("html"), LINK_A)
        links = year_blocks(pages).select("journal", F.posexplode(found).alias("position", "_item"))
        address = attribute(F.col("_item.tag"), "href")
        rows = links.withColumn("block", F.concat("_item.tag", "_item.inner"))
    else:
        anchor = F.get(elements_with_tag(F.col("_item"), "a", cls=ANCHOR_B, exact=True), F.lit(0))
        rows = _blocks_b(pages).withColumn("_anchor", anchor).withColumn("block", F.col("_item"))
        address = attribute(F.col("_anchor.tag"), "href")
    return rows.where(address.isNull()).select("journal", "position", F.lit("no link").alias("problem"), "block")


def toc_issues_b(pages: DataFrame) -> DataFrame:
    """`(journal, html)` to issues: one block per issue, its year the last word of its status."""
    item = F.col("_item")
    blocks = _blocks_b(pages)
    anchor = F.get(elements_with_tag(item, "a", cls=ANCHOR_B, exact=True), F.lit(0))
    parts = blocks.select("journal", "_item", anchor.alias("_anchor")).select(
        "journal",
        attribute(F.col("_anchor.tag"), "href").alias("_href"),
        bare_text(F.col("_anchor.inner")).alias("_link"),
        bare_text(first_element(item, "h3", cls=STATUS_B, exact=True)).alias("_status"),
    )
    texts = parts.select(
        "journal",
        pinned(unescape(F.col("_href"))).alias("issue_url"),
        whitespace_strip(unescape(F.col("_link"))).alias("_link"),
        whitespace_strip(unescape(F.col("_status"))).alias("_status"),
    )
    return texts.select(
        "issue_url",
        year_cast(year_from_status(F.col("_status"))).alias("year"),
        issue_label(F.col("_status"), F.col("_link")).alias("issue_text"),
        "journal",
        F.lit(None).cast("int").alias("no_docs"),
    ).where(F.col("issue_url").isNotNull())
