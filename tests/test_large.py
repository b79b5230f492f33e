"""Exports read in pieces, and gathered into a table, give what whole files give."""

import random

from pyspark.sql import functions as F

from shelfmark.operators.citations import articles_of, bibtex_parse, citation_records, parsed_records
from shelfmark.operators.skew import number_rows
from shelfmark.sources.files import scan_exports
from shelfmark.sources.large import compact_exports, compacted_exports, scan_export_stretches, split_records


def export(rng, n):
    parts = [rng.choice(["", "@comment{{Provided}}\n", "Some {words}\n", "\n", "Some\n@home {of mine}\nwords\n"])]
    for i in range(n):
        parts.append(
            rng.choice(
                [
                    f"@article{{k{i},\n title = {{T{i}}},\n year = {{{1900 + i}}}\n}}\n",
                    f"@article{{k{i},\n abstract = {{mail\n@home {{x}} and\n@work}},\n year = 19\n}}\n",
                    f"@misc(m{i}, title = m{i % 3} # \"!\", note = {{a }}, b = {{c}}}}) @book{{inline{i}, title = {{I}}}}\n",
                    f"@string{{m{i % 3} = {{macro {i % 3}}}}}\n",
                    f"@article{{open{i},\n title = {{never closed {i},\n",
                    f"@article{{only{i}}}\n",
                ]
            )
        )
    return "".join(parts)


def test_stretches_give_what_whole_files_give(spark, tmp_path):
    rng = random.Random(3)
    for i, n in enumerate((0, 1, 5, 40, 400)):
        (tmp_path / f"i{i}.txt").write_text(export(rng, n), encoding="utf-8")
    whole = citation_records(scan_exports(spark, str(tmp_path)))
    kinds = ("file_name", "issue_url", "record_ordinal", "type", "cite_key")
    expected = sorted([(*r[:5], sorted(r[5].items())) for r in whole.select(*kinds, "fields").collect()], key=str)
    # Parts of a few hundred bytes: the larger files are dealt to many tasks.
    for size in ("300", "1500", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            stretches = scan_export_stretches(spark, str(tmp_path))
            records = parsed_records(split_records(stretches).withColumn("one", F.lit(1)))
            numbered = number_rows(records.drop("fields"), "file_name", [F.col("place")], "one", "number")
            rows = numbered.join(records.select("file_name", "place", "fields"), ["file_name", "place"])
            rows = rows.withColumn("record_ordinal", (F.col("number") - 1).cast("int")).select(*kinds, "fields").collect()
            assert size == "128m" or stretches.select("path", "block").distinct().count() > 15
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert sorted([(*r[:5], sorted(r[5].items())) for r in rows], key=str) == expected


def test_articles_of_stretches(spark, tmp_path):
    (tmp_path / "i1.txt").write_text("@article{a,\n title = {T},\n year = {1950}\n}\n@article{b, title = {U}}\n")
    records = split_records(scan_export_stretches(spark, str(tmp_path)))
    articles = articles_of(parsed_records(records.withColumn("record_ordinal", F.lit(0))))
    assert sorted((r.issue_url[-2:], r.cite_key, r.title, r.year) for r in articles.collect()) == [
        ("i1", "a", "T", 1950), ("i1", "b", "U", None),
    ]


def test_gathered_exports(spark, tmp_path):
    inbox, table, state = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "state")
    inbox.mkdir()
    rng = random.Random(4)
    for drop in range(3):
        for i in range(4):
            (inbox / f"d{drop}i{i}.txt").write_text(export(rng, 3), encoding="utf-8")
        compact_exports(spark, str(inbox), table, state, files_per_batch=3)
        compact_exports(spark, str(inbox), table, state)
        got = bibtex_parse(compacted_exports(spark, table)).drop("extra").collect()
        assert sorted(got, key=str) == sorted(bibtex_parse(scan_exports(spark, str(inbox))).drop("extra").collect(), key=str)
    assert compacted_exports(spark, table).count() == 12
