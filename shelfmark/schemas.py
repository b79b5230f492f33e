"""Table schemas."""

from pyspark.sql import types as T

_S = T.StringType()


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, _S) for name in names]


ISSUES = T.StructType(
    [
        T.StructField("issue_url", _S),
        T.StructField("year", T.IntegerType()),
        *_strings("issue_text", "journal"),
        T.StructField("no_docs", T.IntegerType()),
    ]
)

# BibTeX keys that get a column of their own; all others stay in `extra`.
CITATION_FIELDS = (
    "author",
    "title",
    "journal",
    "volume",
    "number",
    "pages",
    "url",
    "doi",
    "issn",
    "publisher",
    "abstract",
)

ARTICLES = T.StructType(
    [
        *_strings("issue_url", "file_name"),
        T.StructField("record_ordinal", T.IntegerType()),
        *_strings("type", "cite_key", *CITATION_FIELDS),
        T.StructField("year", T.IntegerType()),
        T.StructField("extra", T.MapType(_S, _S)),
    ]
)

EXPORTS = T.StructType(_strings("file_name", "issue_url", "value"))

RECORD_COLUMNS = (
    "authors",
    "title",
    "journal",
    "volume",
    "issue",
    "year",
    "pages",
    "doi",
    "affiliations",
    "abstract",
    "citations",
    "document_type",
    "index_keywords",
    "author_keywords",
)

HOLDINGS = T.StructType(
    [
        T.StructField("name", _S),
        T.StructField("path", _S),
        T.StructField("length", T.LongType()),
        T.StructField("modification_time", T.TimestampType()),
    ]
)

REMOTE_HOLDINGS = T.StructType(_strings("name", "id", "mime_type"))

# The key of the list files ends in a space.
JOURNAL_KEY = "Journal Name "
JOURNAL_LIST = T.StructType(
    [
        T.StructField(
            "masterlist",
            T.ArrayType(T.StructType([T.StructField(JOURNAL_KEY, _S)])),
        )
    ]
)
