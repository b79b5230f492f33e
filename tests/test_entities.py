"""Entities decoded by an expression, against the standard library."""

import html
import random
from html.entities import html5

from shelfmark.functions.entities import unescape


def decoded(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    found = rows.select("i", unescape(rows["t"]).alias("t")).collect()
    return [r["t"] for r in sorted(found)]


def test_every_name_and_number(spark):
    texts = [f"a&{name} b&{name}" for name in html5]
    texts += [f"&#{n};&#x{n:x};" for n in (*range(0, 0x180), 0x2028, 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFDEF, 0xFDF0,
                                           0xFFFD, 0xFFFE, 0xFFFF, 0x1F600, 0x1FFFE, 0x10FFFD, 0x10FFFF, 0x110000)]
    texts += [f"&#{'9' * 40};", f"&#x{'F' * 40};", "&#0000065;", "&#x00000000000041;", "&#;", "&#x;", "&#65", "&#x41g", "&#X41;"]
    assert decoded(spark, texts) == [html.unescape(t) for t in texts]


def test_random_texts(spark):
    rng = random.Random(2)
    pool = ["&", "&&", "amp", "amp;", "AMP", "notit;", "&notin;", "&copy", "&copycat", "é", " ", ";", "#", "&#", "x41", "65;",
            "&lt", "&lt;", "&LT&gt", "&nbsp;", "\n", "&hellip;", "&x", "&thisnameislongerthanthirtytwocharacters;", "<", "\f"]
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 9))) for _ in range(3000)] + ["", "plain", None]
    assert decoded(spark, texts) == [None if t is None else html.unescape(t) for t in texts]
