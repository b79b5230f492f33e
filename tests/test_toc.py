"""Table-of-contents pages of both feeds."""

from shelfmark.operators.toc import links_extract, toc_issues_a, toc_issues_b, toc_rejected, year_blocks

PAGE_A = """<dd><ul><li data-year="1946"><ul>
 <li><collection-view-pharos-link href="/stable/10.2307/i1">Vol. 1, No. 1</collection-view-pharos-link></li>
 <li><collection-view-pharos-link class="c" href="/stable/10.2307/i2?a=1&amp;b"> Q&amp;A <b>2</b> </collection-view-pharos-link></li>
</ul></li><li data-year="1947"><ul></ul></li><li>no year<ul>
 <li><collection-view-pharos-link href="/stable/10.2307/i3">Index</collection-view-pharos-link></li>
</ul></li></ul></dd>"""

PAGE_B = """<div class="issue-item u-margin-s-bottom"><a class="anchor js-issue-item-link text-m anchor-default"
 href="https://ex.org/journal/j/vol/1/issue/2">Volume 1, Issue 2</a><span><h3 class="js-issue-status text-s">Pages 1-99 (April 2020)</h3></span></div>
<div class="issue-item u-margin-s-bottom"><a class="other" href="https://ex.org/none">No issue</a></div>
<div class="issue-item u-margin-s-bottom"><a href="https://ex.org/3" class="anchor js-issue-item-link text-m anchor-default">V3</a><span><h3 class="js-issue-status text-s">In progress</h3></span></div>"""


def pages(spark, html):
    return spark.createDataFrame([("J", html)], "journal string, html string")


def rows(df):
    return [(r.year, r.issue_url, r.issue_text, r.journal) for r in df.collect()]


def test_feed_a(spark):
    assert rows(toc_issues_a(pages(spark, PAGE_A))) == [
        (1946, "https://www.jstor.org/stable/10.2307/i1", "Vol. 1, No. 1", "J"),
        (1946, "https://www.jstor.org/stable/10.2307/i2?a=1&b", "Q&A 2", "J"),
    ]


def test_items_without_a_year_are_no_blocks(spark):
    years = [r.data_year for r in year_blocks(pages(spark, PAGE_A)).collect()]
    assert years == ["1946", "1947"]


def test_items_and_links_out_of_place(spark):
    link = '<collection-view-pharos-link href="/x">X</collection-view-pharos-link>'
    outside = f'<ul><li data-year="1946"><ul><li>{link}</li></ul></li></ul>'
    loose = f'<dd><ul><li data-year="1946">{link}</li></ul></dd>'
    assert rows(toc_issues_a(pages(spark, outside + loose))) == []


def test_links_and_blocks_without_an_address_are_rejected(spark):
    broken = PAGE_A.replace(' href="/stable/10.2307/i1"', "")
    for variant, html, text in (("a", broken, "Vol. 1, No. 1"), ("b", PAGE_B, "No issue")):
        [bad] = toc_rejected(pages(spark, html), variant).collect()
        assert (bad.journal, bad.problem) == ("J", "no link") and text in bad.block


def test_feed_b(spark):
    assert rows(toc_issues_b(pages(spark, PAGE_B))) == [
        (
            2020,
            "https://ex.org/journal/j/vol/1/issue/2",
            "Pages 1-99 (April 2020)__Volume 1, Issue 2",
            "J",
        ),
        (None, "https://ex.org/3", "In progress__V3", "J"),
    ]


def test_links(spark):
    html = '<A HREF="/x">one</A><a name="n">no</a><a id="2" href="/y&amp;z">t&lt;w</a>'
    found = links_extract(pages(spark, html)).collect()
    assert [(r.position, r.href, r.text) for r in found] == [(0, "/y&z", "t<w")]
