"""Column functions on URLs, DOIs and file names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# URL prefixes and the DOI registrant of the first feed.
ISSUE_PREFIX_A = "https://www.jstor.org/stable/10.2307/"
ISSUE_PREFIX_B = "https://www.sciencedirect.com/journal/"
ISSUE_BASE_A = "https://www.jstor.org"
STABLE_MARK = "jstor.org/stable/"
DOI_REGISTRANT = "10.2307/"


def _literal_replacement(text: Column) -> Column:
    """Quote what a regex replacement would read as a group reference."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))


def issue_file_id_a(issue_url: Column, prefix: str = ISSUE_PREFIX_A) -> Column:
    return F.concat(F.substring_index(issue_url, prefix, -1), F.lit(".txt"))


def issue_file_id_b(
    issue_url: Column, prefix: str = ISSUE_PREFIX_B, extension: str = ".bib"
) -> Column:
    stem = F.replace(F.substring_index(issue_url, prefix, -1), F.lit("/"), F.lit("_"))
    return F.concat(stem, F.lit(extension))


def issue_url_of_file_a(file_name: Column, prefix: str = ISSUE_PREFIX_A) -> Column:
    """Inverse of `issue_file_id_a` for URLs that carry the prefix; spares a join on the file name."""
    return F.concat(F.lit(prefix), F.regexp_replace(file_name, re.escape(".txt") + "$", ""))


def pdf_name(url: Column) -> Column:
    return F.concat(F.substring_index(url, "/", -1), F.lit(".pdf"))


def doi_normalise(url: Column) -> Column:
    """The identifier after the stable mark; a bare one gets the default registrant."""
    ident = F.substring_index(url, STABLE_MARK, -1)
    return F.when(F.contains(ident, F.lit("/")), ident).otherwise(
        F.concat(F.lit(DOI_REGISTRANT), ident)
    )


def doi_suffix(doi: Column, compat: bool = False) -> Column:
    """File stem of a DOI: its last segment, or with `compat` all after the eighth character."""
    return F.substring(doi, 9, 2**31 - 1) if compat else F.substring_index(doi, "/", -1)


def url_host(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"https://([^\n]+?)/", 1), F.lit(""))


def url_rehost(url: Column, host: Column) -> Column:
    """Put `host` in place of every host in the URL, those inside its query too."""
    return F.regexp_replace(
        url,
        F.lit(r"https?://([^\n]+?)/"),
        F.concat(F.lit("https://"), _literal_replacement(host), F.lit("/")),
    )


def url_absolutise(href: Column, base: str = ISSUE_BASE_A) -> Column:
    return F.concat(F.lit(base), href)


def download_filename(url: Column) -> Column:
    pattern = r"([^\n]*)/([^\n]*)\?download=true"
    return F.when(url.rlike(pattern), F.regexp_extract(url, pattern, 2))


def attr_slice(attribute: Column) -> Column:
    """Drop the first fifteen characters and the last one, which wrap a URL in a click handler."""
    return F.substring(attribute, F.lit(16), F.greatest(F.length(attribute) - 16, F.lit(0)))
