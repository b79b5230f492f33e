"""Citation exports: both feeds, the literal splitting, and a round trip."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfmark.operators.citations import (
    BAD_EXPORT,
    bibtex_parse,
    citation_records,
    filter_bad_export,
)
from shelfmark.schemas import ARTICLES

SAMPLE_A = (
    "@comment{{Provided}}\r\n@article{10.2307/1,\n ISSN = {1},\r\n"
    " URL = {http://www.jstor.org/stable/1?a=b},\n author = {A B and {C} D},\n"
    " title = {The {GDP}, and more},\n year = {1946}\n}\n"
    "@article{10.2307/2,\n title = {T},\n mail = {x@y.z},\n year = {1947}\n}\n"
)
SAMPLE_B = (
    "@article{K1,\ntitle = {T {X}},\njournal = {J},\nyear = {1983},\nurl = {https://e/x?p=1}\n}\n"
    "@article{K2,\ntitle = {U},\nyear = {1984}\n}\n"
)


def exports(spark, *texts):
    rows = [(f"f{i}.txt", f"issue{i}", text) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "file_name string, issue_url string, value string")


def records(spark, text, **options):
    rows = citation_records(exports(spark, text), **options).orderBy("record_ordinal").collect()
    return [(r.record_ordinal, r.type, r.cite_key, r.fields) for r in rows]


def test_feed_a(spark):
    assert records(spark, SAMPLE_A) == [
        (
            0,
            "article",
            "10.2307/1",
            {
                "issn": "1",
                "url": "http://www.jstor.org/stable/1?a=b",
                "author": "A B and C D",
                "title": "The GDP, and more",
                "year": "1946",
            },
        ),
        (1, "article", "10.2307/2", {"title": "T", "mail": "x@y.z", "year": "1947"}),
    ]


def test_feed_a_literally(spark):
    assert records(spark, SAMPLE_A, compat=True) == [
        (
            0,
            "article",
            None,
            {
                "ISSN": "1",
                "URL": "http://www.jstor.org/stable/1?a",
                "author": "A B and C D",
                "title": "The GDP",
                "year": "1946",
            },
        ),
        (1, "article", None, {"title": "T", "mail": "x"}),
        (2, "y.z}, year = ", None, {"year": "1947"}),
    ]


def test_feed_b(spark):
    assert records(spark, SAMPLE_B, dialect="b") == [
        (
            0,
            "article",
            "K1",
            {"title": "T X", "journal": "J", "year": "1983", "url": "https://e/x?p=1"},
        ),
        (1, "article", "K2", {"title": "U", "year": "1984"}),
    ]


def test_feed_b_literally(spark):
    found = records(spark, SAMPLE_B + "@book{K3,\ntitle = {V}\n}\n", dialect="b", compat=True)
    assert [(r[1], r[3]["title"]) for r in found] == [("", "T X"), ("", "U")]
    assert found[0][3]["url"] == "https://e/x?p"
    assert found[1][3]["year"] == "1984@bookK3,title"  # an entry of another kind is glued on


def test_other_entries_stay_apart_by_default(spark):
    found = records(spark, SAMPLE_B + "@book{K3,\ntitle = {V}\n}\n", dialect="b")
    assert [(r[1], r[3]["title"]) for r in found][1:] == [("article", "U"), ("book", "V")]


def test_no_banner_loses_nothing(spark):
    plain = SAMPLE_A.split("\r\n", 1)[1]
    assert len(records(spark, plain)) == 2
    assert len(records(spark, plain, compat=True)) == 2  # the first record goes, a bogus one comes


def test_last_of_repeated_keys_counts(spark):
    text = "@article{k,\n a = {1},\n type = {x},\n A = {2},\n b = {3},\n a = {4}\n}"
    [(_, kind, _, fields)] = records(spark, text)
    assert (kind, fields) == ("article", {"a": "4", "b": "3", "type": "x"})


@pytest.mark.parametrize("text", ["", "no entries", "@article{only a key}", "@comment{{x}}"])
def test_exports_without_fields(spark, text):
    assert [r[3] for r in records(spark, text) if r[3]] == []


def test_articles(spark):
    [first, second] = bibtex_parse(exports(spark, SAMPLE_A)).orderBy("record_ordinal").collect()
    assert (first.year, first.url, first.issn) == (1946, "http://www.jstor.org/stable/1?a=b", "1")
    assert (second.year, second.url, second.extra) == (1947, None, {"mail": "x@y.z"})
    assert bibtex_parse(exports(spark, SAMPLE_A)).columns == ARTICLES.names


def test_articles_of_literal_records_know_upper_case_keys(spark):
    first = bibtex_parse(exports(spark, SAMPLE_A), compat=True).orderBy("record_ordinal").first()
    assert (first.url, first.issn, first.extra) == ("http://www.jstor.org/stable/1?a", "1", {})


def test_older_url_key(spark):
    text = "@article{k,\n stable_url = {u},\n year = {1950.0}\n}"
    [row] = bibtex_parse(exports(spark, text)).collect()
    assert (row.url, row.year, row.extra) == ("u", 1950, {})


def test_rejected_exports(spark):
    good, rejected = filter_bad_export(exports(spark, SAMPLE_A, f"x {BAD_EXPORT}. {SAMPLE_A}"))
    assert [r.file_name for r in good.collect()] == ["f0.txt"]
    assert [(r.file_name, r.issue_url) for r in rejected.collect()] == [("f1.txt", "issue1")]


VALUES = st.text(
    st.characters(blacklist_characters="{}@=\r\n", blacklist_categories=("Cs", "Cc")), max_size=20
).filter(lambda s: "}," not in s)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(VALUES, VALUES, st.integers(1000, 2999)), min_size=1, max_size=30))
def test_round_trip(spark, articles):
    entries = [
        f"@article{{k{i},\n author = {{{author}}},\n title = {{{title}}},\n year = {{{year}}}\n}}\n"
        for i, (author, title, year) in enumerate(articles)
    ]
    parsed = bibtex_parse(exports(spark, "@comment{{x}}\n" + "".join(entries)))
    rows = parsed.orderBy("record_ordinal").collect()
    assert [(r.author, r.title, r.year) for r in rows] == [
        (author.strip(), title.strip(), year) for author, title, year in articles
    ]


def test_export_without_text_is_rejected(spark):
    exports = spark.createDataFrame([("a", None), ("b", "@article{k, year = {1946}}")], "file_name string, value string")
    good, rejected = filter_bad_export(exports)
    assert [r["file_name"] for r in good.collect()] == ["b"]
    assert [r["file_name"] for r in rejected.collect()] == ["a"]


def test_spaces_quotes_and_bare_values(spark):
    text = (
        '@article {k1,\n year = 1946,\n volume = {2},\n title = "A {B}, and c",\n journal = {Let x = 1, y = 2},\n'
        ' url = {u}\n}\n@Book{ k2 ,\n title = {"Q" said},\n number = 3,\n month = jan,\n year = "1947",\n}\n'
    )
    first, second = records(spark, text)
    assert first[1:3] == ("article", "k1")
    assert first[3] == {
        "year": "1946", "volume": "2", "title": "A B, and c", "journal": "Let x = 1, y = 2", "url": "u",
    }
    assert second[1:3] == ("book", "k2")
    assert second[3] == {"title": '"Q" said', "number": "3", "month": "jan", "year": "1947"}


def test_an_export_without_records_is_rejected(spark):
    good, rejected = filter_bad_export(exports(spark, "", "@comment{x}", "mail a@b.c", SAMPLE_A, "@article {k,\n}"))
    assert sorted(r.file_name for r in rejected.collect()) == ["f0.txt", "f1.txt", "f2.txt"]
    assert good.count() == 2


def test_bare_values_of_any_form_and_distance(spark):
    long = "word " * 20 + "end"
    text = (
        "@article{k,\n         year         = 2001,\n          pages = {1-2},\n month = jan # feb,\n"
        f" note = {long},\n {'k' * 40} = 7, day = jan # \" 1, a = 2\",\n title = {{In a, x = 1, y = 2}},\n url = {{u}}, number = 5\n}}\n"
    )
    [(_, _, _, fields)] = records(spark, text)
    assert {k: v for k, v in fields.items() if k != "day"} == {
        "year": "2001", "pages": "1-2", "month": "jan # feb", "note": long, "k" * 40: "7",
        "title": "In a, x = 1, y = 2", "url": "u", "number": "5",
    }
    assert "a = 2" in fields["day"]


def test_at_signs_and_ends_of_fields_inside_values(spark):
    text = (
        "@article{k1,\n title = {See @home {x}, y = {z}, and}, note = \"a {\", b = } c\",\n"
        " abstract = {line one\n@home {x} line two},\n year = {1946}\n}\n@article{k2, year = 1947}"
    )
    first, second = records(spark, text)
    assert first[3] == {
        "title": "See @home x, y = z, and", "note": 'a ", b =  c', "abstract": "line one@home x line two", "year": "1946",
    }
    assert second[2:] == ("k2", {"year": "1947"})


def test_macros_of_each_file(spark):
    texts = (
        '@STRING{a = "A {x}"}\n@string{b = a # { and } # 2, c = nothing}\n@article{k, x = b, y = A # "!", z = c # q, w = "a"}',
        "@string(a = {other})\n@string{a = {another}}\n@preamble{a}\n@misc{k, x = a, y = a # b, z = 12}",
        "@article{k, x = a}",
    )
    rows = citation_records(exports(spark, *texts)).orderBy("file_name").collect()
    assert [r.fields for r in rows] == [
        {"x": "A x and 2", "y": "A x!", "z": "c # q", "w": "a"},
        {"x": "another", "y": "a # b", "z": "12"},
        {"x": "a"},
    ]
    assert {r.type for r in rows} == {"article", "misc"} and {r.record_ordinal for r in rows} == {0}


def test_entries_in_parentheses(spark):
    text = '@article(k(1), title = "a ) b", note = {c ) d}, year = 1946)\n@article(l, title = {x (y) z},)\ntext @ home'
    assert [r[2:] for r in records(spark, text)] == [
        ("k(1)", {"title": "a ) b", "note": "c ) d", "year": "1946"}),
        ("l", {"title": "x (y) z"}),
    ]


def test_braces_that_do_not_match(spark):
    never = "@article{k1,\n title = {open, @home {x},\n year = {1}\n"
    early = "@article{k2,\n title = {a} b}, note = {c}\n}\n"
    deep = "@article{k3, title = " + "{" * 40 + "t" + "}" * 40 + ", year = {3}}\n"
    found = records(spark, never + early + deep + "@article{k4, year = {4}}")
    assert [r[2:] for r in found] == [
        ("k1", {"title": "open, @home x", "year": "1"}),
        ("k2", {"title": "a b", "note": "c"}),
        ("k3", {"title": "t", "year": "3"}),
        ("k4", {"year": "4"}),
    ]


def test_long_values_and_files_are_read_once(spark):
    """Many groups of braces in one value, many records never closed: no stack, no going back."""
    value = "{x} y " * 50_000
    open_ = "".join(f"@article{{k{i},\n title = {{never closed,\n" for i in range(20_000))
    [row] = records(spark, f"@article{{k, title = {{{value}}}, year = 1}}")
    assert row[3] == {"title": value.replace("{", "").replace("}", "").strip(), "year": "1"}
    assert citation_records(exports(spark, open_)).count() == 20_000


def test_an_export_of_asides_alone_is_rejected(spark):
    good, rejected = filter_bad_export(exports(spark, "@string{a = {b}}\n@preamble{x}", "@misc(k, a = 1)"))
    assert [r.file_name for r in rejected.collect()] == ["f0.txt"] and good.count() == 1


def test_macros_are_resolved_once_per_file_not_per_record(spark):
    text = "@string{a = {x}}\n@article{k, title = a}\n@article{l, title = a # { y}}"
    records = citation_records(exports(spark, text))
    titles = {r["cite_key"]: r["fields"]["title"] for r in records.collect()}
    assert titles == {"k": "x", "l": "x y"}
    above = records._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    assert "aggregate(" not in above
