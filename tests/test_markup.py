"""Elements of a page, by their opening tag and the closing tag that matches."""

from shelfmark.functions import markup


def test_nested_elements_of_the_same_name(evaluate):
    html = '<div class="x">a<div>b</div>c<div><div>d</div></div></div>e<div class="y x">f</div>'
    assert evaluate(lambda c: markup.elements(c, "div", cls="x"), html) == [
        "a<div>b</div>c<div><div>d</div></div>",
        "f",
    ]


def test_class_tokens_and_exact_classes(evaluate):
    html = '<span class="txtBold">1</span><span id="i" class="a txt">2</span><span class="txt">3</span>'
    assert evaluate(lambda c: markup.elements(c, "span", cls="txt"), html) == ["2", "3"]
    assert evaluate(lambda c: markup.elements(c, "span", cls="txt", exact=True), html) == ["3"]


def test_names_that_start_alike(evaluate):
    html = "<a href='1'>x<article>y</article>z</a><abbr>n</abbr>"
    assert evaluate(lambda c: markup.elements(c, "a"), html) == ["x<article>y</article>z"]


def test_unclosed_and_empty_elements(evaluate):
    assert evaluate(lambda c: markup.elements(c, "td"), "<td></td><td>a<td>b") == ["", "a", "b"]
    assert evaluate(lambda c: markup.elements(c, "div"), "<div>a<p>b") == ["a<p>b"]
    assert evaluate(lambda c: markup.elements(c, "td"), "none") == []
    assert evaluate(lambda c: markup.elements(c, "td"), None) is None


def test_odd_tags_are_normalised(evaluate):
    html = '<DIV class="X">a<Span>b</SPAN ></Div\n>'
    assert evaluate(markup.normal_tags, html) == '<div class="X">a<span>b</span></div>'
    assert evaluate(markup.normal_tags, "<div>A</div>") == "<div>A</div>"


def test_links_and_attributes(evaluate):
    html = '<a  class="q" href="/x?a=1&amp;b=2">T</a>'
    found = evaluate(lambda c: markup.elements_with_tag(c, "a", attribute="href"), html)
    assert [(f.tag, f.inner) for f in found] == [('<a  class="q" href="/x?a=1&amp;b=2">', "T")]
    assert evaluate(lambda c: markup.attribute(c, "href"), found[0].tag) == "/x?a=1&amp;b=2"
    assert evaluate(lambda c: markup.attribute(c, "id"), found[0].tag) is None


def test_text(evaluate):
    assert evaluate(markup.bare_text, "a<b>c</b><!-- <i>no</i> -->&amp;\n<br\n/>d&nbsp;") == (
        "ac&amp;\nd\u00a0"
    )
    assert evaluate(lambda c: markup.text_after(c, "Type:"), "<b>x</b>Type: <i>y</i>") == "Type: y"
    assert evaluate(lambda c: markup.text_after(c, "Type:"), '<b a="Type:">x</b>Type: y') == "xType: y"
    assert evaluate(lambda c: markup.text_after(c, "Type:"), "<b>x</b>") == ""
