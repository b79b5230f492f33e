"""Column functions on HTML: elements of a kind, their text, their attributes.

All are built-in expressions over plain splits. An element's end is found by counting the tags of
its own name, so elements of that name may nest inside it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import hard_spaces, pieces_after

# The element names the feeds use.
TAGS = ("a", "br", "dd", "div", "h3", "li", "span", "sup", "table", "td", "ul")


def normal_tags(html: Column, *more: str) -> Column:
    """Tag names in lower case and closing tags without space, which `elements` relies on."""
    cleaned = html
    for tag in (*TAGS, *more):
        cleaned = F.regexp_replace(cleaned, rf"(?i)<{re.escape(tag)}(?=[\s>/])", f"<{tag}")
        cleaned = F.regexp_replace(cleaned, rf"(?i)</{re.escape(tag)}\s*>", f"</{tag}>")
    odd = html.rlike(r"<(?:[a-z0-9-]*[A-Z]|/[a-z0-9-]*[A-Z\s])")
    return F.when(odd, cleaned).otherwise(html)


def opening_tag(
    tag: str, cls: str | None = None, exact: bool = False, attribute: str | None = None
) -> str:
    """Regex for an opening tag, with a class token, the exact class text, or an attribute."""
    tests = r"(?=[\s>/])"
    if cls is not None:
        quoted = []
        for q in "\"'":
            value = re.escape(cls) if exact else rf"(?:[^{q}]*\s)?{re.escape(cls)}(?:\s[^{q}]*)?"
            quoted.append(f"{q}{value}{q}")
        tests += rf"(?=[^>]*\sclass\s*=\s*(?:{'|'.join(quoted)}))"
    if attribute is not None:
        tests += rf"(?=[^>]*\s{re.escape(attribute)}\s*=)"
    return rf"<{re.escape(tag)}{tests}[^>]*>"


def _closed(piece: Column, tag: str) -> Column:
    """The part of `piece` before the closing tag of an opening tag just left of it; null without one."""
    close = f"</{tag}>"
    before = F.substring_index(piece, close, 1)
    spans = F.split(piece, rf"\Q{close}\E")

    def step(state: Column, span: Column) -> Column:
        # The closing tag after span i is the one sought if i others were opened before it.
        opened = state["opened"] + F.regexp_count(span, F.lit(rf"<{re.escape(tag)}[\s>/]"))
        seen = state["seen"] + 1
        found = F.when(
            (state["found"] == 0) & (opened < seen), seen
        ).otherwise(state["found"])
        return F.struct(opened.alias("opened"), seen.alias("seen"), found.alias("found"))

    start = F.struct(F.lit(0).alias("opened"), F.lit(0).alias("seen"), F.lit(0).alias("found"))
    # What follows the last closing tag has none of its own.
    found = F.aggregate(
        spans, start, step, lambda s: F.when((s["found"] > 0) & (s["found"] < s["seen"]), s["found"])
    )
    balanced = F.array_join(F.slice(spans, F.lit(1), found), close)
    return (
        F.when(~F.contains(piece, F.lit(close)), F.lit(None).cast("string"))
        .when(~F.contains(before, F.lit(f"<{tag}")), before)
        .otherwise(balanced)
    )


def _up_to_close(piece: Column, tag: str) -> Column:
    """As `_closed`; an element that is never closed reaches to the end of the piece."""
    return F.coalesce(_closed(piece, tag), piece)


def _after_openings(html: Column, opening: str) -> Column:
    return pieces_after(F.split(html, opening))


def elements(html: Column, tag: str, nested: bool = False, **which) -> Column:
    """Inner HTML of every matching element, in document order.

    An element ends at the next matching one at the latest; with `nested` it goes on beyond those
    that stand inside it, which also count by themselves.
    """
    opening = opening_tag(tag, **which)
    if not nested:
        return F.transform(_after_openings(html, opening), lambda piece: _up_to_close(piece, tag))

    def whole(piece: Column, i: Column) -> Column:
        rest = F.get(F.split(html, opening, i + 2), i + 1)
        return F.coalesce(_closed(piece, tag), _closed(rest, tag), piece)

    return F.transform(_after_openings(html, opening), whole)


def first_element(html: Column, tag: str, nested: bool = False, **which) -> Column:
    """Inner HTML of the first matching element, or null; `nested` as for `elements`."""
    opening = opening_tag(tag, **which)
    piece = F.get(F.split(html, opening), F.lit(1))
    if not nested:
        return _up_to_close(piece, tag)
    rest = F.get(F.split(html, opening, 2), F.lit(1))
    return F.coalesce(_closed(piece, tag), _closed(rest, tag), piece)


def elements_with_tag(html: Column, tag: str, **which) -> Column:
    """As `elements`, as structs of the opening tag and the inner HTML."""
    opening = opening_tag(tag, **which)
    return F.zip_with(
        F.regexp_extract_all(html, F.lit(opening), F.lit(0)),
        _after_openings(html, opening),
        lambda head, piece: F.struct(
            head.alias("tag"), _up_to_close(piece, tag).alias("inner")
        ),
    )


def attribute(tag_text: Column, name: str) -> Column:
    """Value of an attribute in the text of an opening tag, entities still encoded; or null."""
    pattern = rf"(?i)\s{re.escape(name)}\s*=\s*[\"']([^\"']*)[\"']"
    return F.get(F.regexp_extract_all(tag_text, F.lit(pattern), F.lit(1)), F.lit(0))


def without_tags(html: Column) -> Column:
    """Text of a fragment; entities still encoded."""
    return F.regexp_replace(html, r"(?s)<(?:!--.*?--|[^>]*)>", "")


def bare_text(html: Column) -> Column:
    """Text of a fragment with hard spaces decoded; `entity_decode` does the other entities."""
    return hard_spaces(without_tags(html))


def text_after(html: Column, mark: str) -> Column:
    """Text from the first `mark` on, without stripping what stands before it; empty without one."""
    at = F.locate(mark, html)
    head = F.substring(html, F.lit(1), at - 1)
    inside_tag = F.contains(head, F.lit("<")) & ~F.contains(
        F.substring_index(head, "<", -1), F.lit(">")
    )
    return (
        F.when(at == 0, F.lit(""))
        .when(inside_tag, without_tags(html))
        .otherwise(without_tags(F.substring(html, at, F.length(html))))
    )
