"""The given tables seen as the tables of the corpus.

`orders` are issues, `lineitem` rows are articles, and lists of held files are those articles with a
given flag. Citation exports, table-of-contents pages and result pages are rendered from table rows,
a document or an order each, with their whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.urls import ISSUE_PREFIX_B, STABLE_MARK, issue_file_id_a, pdf_name
from shelfmark.operators.citations import BAD_EXPORT
from shelfmark.operators.toc import ANCHOR_B, ITEM_B, LINK_A, STATUS_B
from shelfmark.operators.records import CONTAINER, SECTION

ISSUE_PREFIX = "https://ex.org/stable/"
ARTICLE_PREFIX = "https://ex.org/a/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """For queries that render and parse a text per row: the given tables are one row group each.

    Only this view of the given tables deals rows out; readers of the library do not.
    """
    rows = table(spark, sf_dir, name)
    return rows.repartition(spark.sparkContext.defaultParallelism)


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        _text(ISSUE_PREFIX, F.col("o_orderkey")).alias("issue_url"),
        F.year("o_orderdate").alias("year"),
        F.col("o_orderpriority").alias("issue_text"),
        _text("J", F.col("o_custkey")).alias("journal"),
        F.lit(None).cast("int").alias("no_docs"),
    )


def _article_key() -> Column:
    keys = [F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]
    return F.concat_ws("-", *keys)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        _text(ISSUE_PREFIX, F.col("l_orderkey")).alias("issue_url"),
        _text(ARTICLE_PREFIX, _article_key()).alias("url"),
        F.year("l_shipdate").alias("year"),
    )


def placed_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with their place in the exports, which runs against that of the line numbers."""
    return table(spark, sf_dir, "lineitem").select(
        _text(ISSUE_PREFIX, F.col("l_orderkey")).alias("issue_url"),
        _text(ARTICLE_PREFIX, _article_key()).alias("url"),
        F.year("l_shipdate").alias("year"),
        _text(F.col("l_orderkey"), ".txt").alias("file_name"),
        (100 - F.col("l_linenumber")).cast("int").alias("record_ordinal"),
    )


def doi_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles under stable URLs, some with a full DOI and some with a bare identifier."""
    key = F.col("l_orderkey").cast("string")
    ident = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("10.1086/"), key)).otherwise(key)
    return table(spark, sf_dir, "lineitem").select(
        _text(ISSUE_PREFIX, F.col("l_orderkey")).alias("issue_url"),
        _text("https://www." + STABLE_MARK, ident).alias("url"),
        F.year("l_shipdate").alias("year"),
        F.col("l_returnflag"),
    )


def doi_holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = doi_articles(spark, sf_dir).where(F.col("l_returnflag") == "R")
    return held.select(pdf_name(F.col("url")).alias("name"))


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    return held.select(pdf_name(_article_key()).alias("name"))


def remote_holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = table(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == "F")
    return held.select(
        pdf_name(_article_key()).alias("name"),
        _article_key().alias("id"),
        F.when(F.col("l_returnflag") == "N", "text/html").otherwise("application/pdf").alias("mime_type"),
    )


BANNER = "@comment{{Provided}}\n"


def _entry(key: Column, *fields: tuple[str, Column]) -> Column:
    body = []
    for name, value in fields:
        body += [",\n " if not body else "},\n ", name, " = {", value]
    return _text("@article{", key, *body, "}\n}\n")


def order_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports_of_orders(spread_table(spark, sf_dir, "orders"))


def arriving_order_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same exports as a stream over the files of the table, dealt out like `spread_table`."""
    schema = table(spark, sf_dir, "orders").schema
    # A glob serves a table that is one file as well as one that is a folder.
    orders = spark.readStream.schema(schema).parquet(f"{sf_dir}/orders.parque[t]")
    orders = orders.repartition(spark.sparkContext.defaultParallelism)
    return exports_of_orders(orders, F.col("o_orderdate").cast("timestamp").alias("arrived"))


def _path_b() -> Column:
    return _text("j", F.col("o_custkey"), "/vol/", F.col("o_orderkey"))


def issues_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues under URLs of the other feed."""
    return table(spark, sf_dir, "orders").select(
        _text(ISSUE_PREFIX_B, _path_b()).alias("issue_url"), F.year("o_orderdate").alias("year")
    )


def order_exports_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export of the other feed per order, and for one order in ten one of no known issue."""
    key = F.col("o_orderkey")
    entry = _text("@article{K", key, ",\ntitle = {", F.col("o_orderpriority"), "},\nyear = {", F.year("o_orderdate"), "}\n}\n")
    failed = F.when(F.col("o_orderstatus") == "P", F.lit(f"{BAD_EXPORT}\n")).otherwise("")
    own = F.replace(_text(_path_b(), ".bib"), F.lit("/"), F.lit("_"))
    names = F.array_compact(F.array(own, F.when(key % 10 == 0, _text("x", key, ".bib"))))
    rows = spread_table(spark, sf_dir, "orders").withColumn("value", _text(entry, failed))
    return rows.select(F.explode(names).alias("file_name"), "value")


def _file_names(orders: DataFrame, *more: Column) -> DataFrame:
    """Names of the files that came for an order: exports, one of them fetched twice, archives, others."""
    key = F.col("o_orderkey")
    names = F.array_compact(
        F.array(
            F.when(F.col("o_orderstatus") != "P", _text(key, ".txt")),
            F.when(F.col("o_custkey") % 7 == 0, _text(key, "~2.txt")),
            F.when(F.col("o_custkey") % 3 == 0, _text(key, ".zip")),
            _text(key, ".zip.part"),
        )
    )
    return orders.select(F.explode(names).alias("name"), *more)


def order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _file_names(table(spark, sf_dir, "orders"))


def arriving_order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "orders").schema
    orders = spark.readStream.schema(schema).parquet(f"{sf_dir}/orders.parque[t]")
    return _file_names(orders, F.col("o_orderdate").cast("timestamp").alias("arrived"))


def issue_stem() -> Column:
    return F.substring_index(F.col("issue_url"), "/", -1)


def exports_of_orders(orders: DataFrame, *more: Column) -> DataFrame:
    """An export of two articles per order; that of a pending order failed."""
    order, year = F.col("o_orderkey"), F.year("o_orderdate")
    first = _entry(
        _text("10.2307/", order),
        ("URL", _text(ARTICLE_PREFIX, order, "?customer=", F.col("o_custkey"))),
        ("author", _text("Customer {", F.col("o_custkey"), "}")),
        ("title", _text("The {", F.col("o_orderpriority"), "}, and more")),
        ("year", year),
    )
    second = _entry(
        _text("10.2307/", order, "b"),
        ("stable_url", _text(ARTICLE_PREFIX, order, "b")),
        ("title", F.col("o_orderpriority")),
        ("mail", _text(F.col("o_orderstatus"), "@ex.org")),
        ("year", _text("in press")),
    )
    issue_url = _text(ISSUE_PREFIX, order)
    failed = F.when(F.col("o_orderstatus") == "P", F.lit(f"{BAD_EXPORT}\n")).otherwise("")
    return orders.select(
        issue_file_id_a(issue_url, ISSUE_PREFIX).alias("file_name"),
        issue_url.alias("issue_url"),
        _text(BANNER, first, failed, second).alias("value"),
        *more,
    )


def lineitem_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export of one article per line item."""
    url = _text(ARTICLE_PREFIX, _article_key())
    entry = _entry(
        _text("10.2307/", _article_key()),
        ("ISSN", F.col("l_suppkey").cast("string")),
        ("URL", url),
        ("number", F.col("l_linenumber").cast("string")),
        ("pages", _text("1-", F.col("l_partkey"))),
        ("year", F.year("l_shipdate").cast("string")),
    )
    return spread_table(spark, sf_dir, "lineitem").select(
        _text(_article_key(), ".txt").alias("file_name"),
        _text(ISSUE_PREFIX, F.col("l_orderkey")).alias("issue_url"),
        _text(BANNER, entry).alias("value"),
    )


def uneven_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export per line item: after its year, as many parts as its line number, every other one a field."""
    more = F.transform(
        F.sequence(F.lit(1), F.col("l_linenumber").cast("int")),
        lambda i: F.when(i % 2 == 0, _text("}, f", i, " = {", i)).otherwise(_text("}, {part ", i)),
    )
    text = _text(BANNER, "@article{K, year = {1990", F.array_join(more, ""), "}}\n")
    return spread_table(spark, sf_dir, "lineitem").select(
        _text(F.col("l_orderkey"), "-", F.col("l_linenumber"), ".txt").alias("file_name"),
        _text(ISSUE_PREFIX, F.col("l_orderkey")).alias("issue_url"),
        text.alias("value"),
    )


def nested_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order, entries whose values hold delimiters, macros, asides, and one in parentheses."""
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    text = _text(
        '@preamble{"\\newcommand{\\no}{@article{none, title = {none}}}"}\n@string{press = "Press {of} " # {J',
        customer,
        "}}\n@string(kind = {",
        F.col("o_orderpriority"),
        "})\n@comment{@article{hidden, title = {none}}}\n@article{A",
        order,
        ",\n title = {Mail @home {x}, {see}, key = ",
        order,
        ", {b}, more},\n note = \"Said {\", key = } and {\"}, year = {1}\",\n no field, publisher = press,\n",
        " journal = press # {: } # kind # \" \" # 7,\n month = jan # kind,\n year = ",
        F.year("o_orderdate"),
        "\n}\nBetween a@b.c and @article\n@Article(P",
        order,
        ', title = "In (parentheses), year = none", author = {A) and (B}, journal = PRESS, year = {',
        F.year("o_orderdate"),
        "},)\n@book{B",
        order,
        ",\n title = {Never closed, @home {x},\n year = {1900},\n@misc{C",
        order,
        ",\n title = {Closed} twice}, year = {1901}}\n",
    )
    return spread_table(spark, sf_dir, "orders").select(
        _text(order, ".txt").alias("file_name"), _text(ISSUE_PREFIX, order).alias("issue_url"), text.alias("value")
    )


def document_exports(spark: SparkSession, sf_dir: str, dialect: str = "a") -> DataFrame:
    """An export per document: one article with the whole text as abstract, and one per line."""
    doc = F.col("doc_id")
    whole = _entry(
        _text("W", doc),
        ("title", _text("Whole {", F.col("lang"), "} text")),
        ("abstract", F.col("text")),
        ("year", _text("1990")),
    )
    by_line = F.transform(
        F.split("text", "\n"),
        lambda line, i: _entry(
            _text("L", doc, "-", i),
            ("URL", _text("https://ex.org/d?doc=", doc, "&line=", i)),
            ("title", line),
            ("year", _text("1991")),
        ),
    )
    records = F.array_join(F.concat(F.array(whole), by_line), "")
    banner = BANNER if dialect == "a" else ""
    return spread_table(spark, sf_dir, "documents").select(
        _text(doc, ".txt").alias("file_name"),
        _text(ISSUE_PREFIX, doc).alias("issue_url"),
        _text(banner, records).alias("value"),
    )


def toc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given pages with their navigation turned into a list of issues of one year."""
    year = F.length("url") + 1900
    linked = F.regexp_replace(
        "html", r"<a href=\"([^\"]*)\">([^<]*)</a>", rf'<{LINK_A} class="x" href="$1">$2</{LINK_A}>'
    )
    opened = F.replace(
        linked,
        F.lit("<nav><ul>"),
        _text("<nav><dd><ul><li>none</li><li data-year=\"", year, "\"><b>Year</b><ul>"),
    )
    closed = F.replace(opened, F.lit("</ul></nav>"), F.lit("</ul></li></ul></dd></nav>"))
    return spread_table(spark, sf_dir, "pages").select(
        "page_id", F.col("url").alias("journal"), closed.alias("html")
    )


def order_toc_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of one issue per order."""
    html = _text(
        '<dd><ul><li data-year="',
        F.year("o_orderdate"),
        f'"><ul><li><{LINK_A} href="/stable/',
        F.col("o_orderkey"),
        '">',
        F.col("o_orderpriority"),
        f"</{LINK_A}></li></ul></li></ul></dd>",
    )
    return spread_table(spark, sf_dir, "orders").select(
        _text("J", F.col("o_custkey")).alias("journal"), html.alias("html")
    )


def order_toc_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A block of one issue per order, in the other feed's shape."""
    html = _text(
        f'<div><div class="{ITEM_B}"><div><a class="{ANCHOR_B}"\n href="https://ex.org/j/',
        F.col("o_custkey"),
        "/",
        F.col("o_orderkey"),
        '">Volume ',
        F.col("o_custkey"),
        f'</a></div><span><h3 class="{STATUS_B}">Pages 1-99 (',
        F.date_format("o_orderdate", "MMMM yyyy"),
        ")</h3></span></div></div>",
    )
    return spread_table(spark, sf_dir, "orders").select(
        _text("J", F.col("o_custkey")).alias("journal"), html.alias("html")
    )


def _escaped(text: Column) -> Column:
    for plain, encoded in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(encoded))
    return text


def reference_line() -> Column:
    return _text(
        "(",
        F.col("n_chars") % 100 + 1920,
        ") Journal of ",
        F.col("source"),
        ", ",
        F.col("n_chars"),
        " (",
        F.col("doc_id"),
        "), pp. 1-",
        F.col("n_chars"),
        ". Cited 3 times. ",
    )


def record_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result page of two records per document: a full one, and one with little more than a title."""
    text = F.col("text")

    def field(inner: Column, cls: str = "txt") -> Column:
        return _text(f'<span class="{cls}">', inner, "</span>")

    def section(*inner: Column | str) -> Column:
        return _text(f'<div class="{SECTION}">', *inner, "</div>")

    lines = F.split(text, "\n")
    title = field(_escaped(F.get(lines, F.lit(0))), "txtBold")
    cells = F.transform(
        lines,
        lambda line, i: F.when(line == "", "<td></td>").otherwise(
            _text("<td><span>", i, "</span><span>", _escaped(line), "&nbsp;</span></td>")
        ),
    )
    authors = _text("A, ", F.col("lang"), ".<sup>a</sup> , B, ", F.col("source"), ".<sup>b</sup><sup>c</sup>")
    full = _text(
        section(
            field(authors),
            title,
            field(reference_line()),
            "DOI: ",
            field(_text("10.5555/", F.col("doc_id"))),
        ),
        section(
            "Affiliations:<br/><sup>a</sup>&nbsp;University of ",
            F.col("source"),
            " &amp; Sons<br/><sup>b</sup>&nbsp;",
            F.col("lang"),
            "<br/>",
        ),
        section("<div><b>Abstract</b></div>", field(_escaped(text))),
        section(field(F.col("lang"))),
        section(field(F.col("source"))),
        section("<table><tr>", F.array_join(cells, ""), "</tr></table>"),
    )
    brief = _text(section(title, field(reference_line())), section(), section(), section(field(F.col("lang"))))
    tail = "<div>Document Type: Article Publication Stage: Final</div></div>"
    html = _text(
        "<html><body>",
        *[p for part in (full, brief) for p in (f'<div class="{CONTAINER}">', part, tail)],
        "</body></html>",
    )
    return spread_table(spark, sf_dir, "documents").select(
        _text(F.col("doc_id"), ".html").alias("file_name"), html.alias("html")
    )


def other_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given pages, none of which is a result page."""
    return spread_table(spark, sf_dir, "pages").select(_text(F.col("page_id"), ".htm").alias("file_name"), "html")
