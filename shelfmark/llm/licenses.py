"""Licence scan: a positional index of licence texts, looked up by a file's rarest licence words."""

from __future__ import annotations

import json
from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import kept

#: Words: runs of ASCII letters and digits and of anything beyond ASCII.
LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: A phrase of licence notices and the label it gives.
BASE_PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)


@dataclass(frozen=True)
class Template:
    """A licence text, the label it gives and the phrases without which it is not that licence."""

    label: str
    text: str
    phrases: tuple[str, ...]


#: Wording of public licences, in lower case words.
TEXTS = (
    Template(
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this"
        " software and associated documentation files the software to deal in the software"
        " without restriction",
        ("hereby granted free", "associated documentation files", "without restriction"),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met",
        ("redistribution", "binary forms", "following conditions are met"),
    ),
    Template(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license v 2 0",),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or"
        " without fee is hereby granted",
        ("copy modify and or distribute this software", "without fee", "hereby granted"),
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software",),
    ),
    Template(
        "zlib",
        "this software is provided as is without any express or implied warranty in no event"
        " will the authors be held liable for any damages",
        ("express or implied warranty", "authors be held liable"),
    ),
)

#: Labels and the names that notices give their licences.
NAMES = (
    ("mit-notice", "mit license"),
    ("isc", "isc license"),
    ("zlib", "zlib license"),
    ("bsd", "bsd license"),
    ("bsd-2-clause", "bsd 2 clause license"),
    ("bsd-3-clause", "bsd 3 clause license"),
    ("apache-2.0", "apache license version 2 0"),
    ("apache-2.0", "apache license 2 0"),
    ("apache-1.1", "apache software license version 1 1"),
    ("mpl-2.0", "mozilla public license version 2 0"),
    ("mpl-2.0", "mozilla public license 2 0"),
    ("mpl-1.1", "mozilla public license version 1 1"),
    ("epl-2.0", "eclipse public license version 2 0"),
    ("epl-2.0", "eclipse public license 2 0"),
    ("epl-1.0", "eclipse public license v 1 0"),
    ("bsl-1.0", "boost software license version 1 0"),
    ("artistic-2.0", "artistic license version 2 0"),
    ("artistic-2.0", "artistic license 2 0"),
    ("ofl-1.1", "sil open font license version 1 1"),
    ("odbl-1.0", "open database license version 1 0"),
    ("cc0-1.0", "cc0 1 0 universal"),
    ("cc-by-4.0", "cc by 4 0"),
    ("cc-by-sa-4.0", "cc by sa 4 0"),
    ("cc-by-nc-4.0", "cc by nc 4 0"),
    ("cc-by-nd-4.0", "cc by nd 4 0"),
    ("cc-by-nc-sa-4.0", "cc by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", "cc by nc nd 4 0"),
    ("cc-by-4.0", "creative commons attribution 4 0"),
    ("cc-by-sa-4.0", "creative commons attribution sharealike 4 0"),
    ("cc-by-nc-4.0", "creative commons attribution noncommercial 4 0"),
    ("cc-by-nd-4.0", "creative commons attribution noderivatives 4 0"),
)
#: The GNU licences by family, with their versions and labels.
GNU = (
    ("gnu general public license", (("1", "gpl-1"), ("2", "gpl-2"), ("3", "gpl-3"))),
    ("gnu lesser general public license", (("2 1", "lgpl-2.1"), ("3", "lgpl-3"))),
    ("gnu library general public license", (("2", "lgpl-2"),)),
    ("gnu affero general public license", (("3", "agpl-3"),)),
)
#: How a GNU licence's version is named, and words before any licence's name.
VERSIONS = (
    "{} version {}",
    "{} v {}",
    "{} as published by the free software foundation either version {}",
)
LEADS = (
    "available under the",
    "distributed under the",
    "released under the",
    "under the terms of the",
    "licensed under the",
    "licensed under",
)
#: Machine-readable licence identifiers, as words, and their labels.
IDENTIFIERS = (
    ("mit", "mit-notice"),
    ("isc", "isc"),
    ("zlib", "zlib"),
    ("unlicense", "unlicense"),
    ("apache 2 0", "apache-2.0"),
    ("bsd 2 clause", "bsd-2-clause"),
    ("bsd 3 clause", "bsd-3-clause"),
    ("mpl 2 0", "mpl-2.0"),
    ("epl 2 0", "epl-2.0"),
    ("bsl 1 0", "bsl-1.0"),
    ("artistic 2 0", "artistic-2.0"),
    ("ofl 1 1", "ofl-1.1"),
    ("gpl 2 0", "gpl-2"),
    ("gpl 3 0", "gpl-3"),
    ("lgpl 2 1", "lgpl-2.1"),
    ("lgpl 3 0", "lgpl-3"),
    ("agpl 3 0", "agpl-3"),
    ("cc0 1 0", "cc0-1.0"),
    ("cc by 4 0", "cc-by-4.0"),
    ("cc by sa 4 0", "cc-by-sa-4.0"),
    ("cc by nc 4 0", "cc-by-nc-4.0"),
)

#: Words too common to look up; in a phrase any word but a licence word may stand in their place.
COMMON = frozenset(
    "a an and any are as be by for in into is it no of or that the this to under use will with you".split()
)
#: Words of which only the ones beside another licence word count, as prose is full of them.
LINKED = frozenset("mit nc nd sa v 0 1 2 3 4".split())


def _content(text: str) -> list[tuple[int, str]]:
    return [(i, w) for i, w in enumerate(text.split()) if w not in COMMON]


def _notices() -> list[Template]:
    """Every name after every lead; a name of two words is mandatory with its lead."""
    names = [*NAMES] + [
        (label, form.format(family, version))
        for family, versions in GNU
        for version, label in versions
        for form in VERSIONS
    ]
    found = []
    for label, name in names:
        for lead in LEADS:
            whole = f"{lead} {name}"
            found.append(Template(label, whole, (name if len(_content(name)) > 2 else whole,)))
    return found


def default_templates() -> list[Template]:
    marked = [(label, f"spdx license identifier {words}") for words, label in IDENTIFIERS]
    return [*_notices(), *(Template(label, text, (text,)) for label, text in marked), *TEXTS]


#: Bytes of the index as JSON; it travels with every task.
INDEX_BYTES = 4 << 20
#: A window's rarest words whose postings are intersected.
RAREST = 2
_ORIGIN_BITS = 33


class TemplateIndex:
    """Positional postings of the words of `templates`, as literals of bounded size.

    `window`: every template has a mandatory phrase of as many licence words, or more. `reach`: the
    most places apart that the first and last of so many in a phrase stand.
    """

    def __init__(self, templates: list[Template]):
        self.templates = list(templates)
        texts = [_content(t.text) for t in self.templates]
        base = {w for phrase, _ in BASE_PHRASES for w in phrase.split()}
        self.vocabulary = sorted({w for words in texts for _, w in words} | base)
        self.ids = {w: i for i, w in enumerate(self.vocabulary)}
        phrases = [[self._phrase(t, p) for p in t.phrases] for t in self.templates]
        self.window = min(max(map(len, own)) for own in phrases)
        if self.window < RAREST:
            raise ValueError(f"a template needs a phrase of {RAREST} licence words")
        self.span = max(len(t.text.split()) for t in self.templates)
        self.reach = max(
            places[k + self.window - 1] - places[k]
            for own in phrases
            for places in own
            for k in range(len(places) - self.window + 1)
        )
        postings: list[list[dict]] = [[] for _ in self.vocabulary]
        for t, own in enumerate(phrases):
            words = dict(texts[t])
            for p in sorted({p for places in own for p in places}):
                postings[self.ids[words[p]]].append({"t": t, "p": p})
        rows = [
            {
                "label": t.label,
                "expected": [self.ids.get(w, -1) if w not in COMMON else -1 for w in t.text.split()],
                "size": len(texts[i]),
                "phrases": [
                    [{"p": p, "w": self.ids[dict(texts[i])[p]]} for p in places] for places in phrases[i]
                ],
            }
            for i, t in enumerate(self.templates)
        ]
        self.postings = self._literal(postings, "array<array<struct<t:bigint,p:bigint>>>")
        self.rows = self._literal(
            rows,
            "array<struct<label:string,expected:array<int>,size:int,"
            "phrases:array<array<struct<p:bigint,w:int>>>>>",
        )

    def _phrase(self, template: Template, phrase: str) -> list[int]:
        """Places in the template of the phrase's licence words."""
        words, parts = template.text.split(), phrase.split()
        start = next(i for i in range(len(words)) if words[i : i + len(parts)] == parts)
        places = [i for i in range(start, start + len(parts)) if words[i] not in COMMON]
        for i in places:
            beside = {i - 1, i + 1} & {*places}
            if words[i] in LINKED and not beside:
                raise ValueError(f"{words[i]!r} stands alone in {phrase!r}")
        return places

    @staticmethod
    def _literal(value: list, schema: str) -> Column:
        text = json.dumps(value, separators=(",", ":"))
        if len(text) > INDEX_BYTES:
            raise ValueError(f"index of {len(text)} bytes, at most {INDEX_BYTES}")
        return F.from_json(F.lit(text), schema)


TEMPLATES = default_templates()


def license_hits(docs: DataFrame, index: TemplateIndex, text: str = "text") -> DataFrame:
    """`docs` without the text: `n_words`, and `hits`, the licence words with their places."""
    vocabulary = index.vocabulary
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(LICENSE_WORD), F.lit(0))
    free = [w for w in vocabulary if w not in LINKED]
    linked = sorted(LINKED & set(vocabulary))

    def hit(all_words: Column):
        def one(w: Column, i: Column) -> Column:
            beside = F.get(all_words, i + 1).isin(vocabulary) | F.get(all_words, i - 1).isin(vocabulary)
            return F.when(w.isin(free) | (w.isin(linked) & beside), F.struct(i.alias("i"), w.alias("w")))

        return one

    listed = F.array(*[F.lit(w) for w in vocabulary])
    counted = docs.withColumn("_words", words)
    found = F.filter(F.transform("_words", hit(F.col("_words"))), lambda h: h.isNotNull())
    hits = F.transform(
        found,
        lambda h: F.struct(
            h["i"].cast("long").alias("i"), (F.array_position(listed, h["w"]) - 1).cast("int").alias("w")
        ),
    )
    return counted.select(
        *[c for c in docs.columns if c != text],
        F.size("_words").cast("long").alias("n_words"),
        hits.alias("hits"),
    )


def word_weights(hits: DataFrame, index: TemplateIndex) -> list[float]:
    """Inverse document frequency of each vocabulary word over all documents (one row a word)."""
    n = hits.count()
    seen = (
        hits.select(F.explode(F.array_distinct(F.col("hits.w"))).alias("w"))
        .groupBy("w")
        .agg(F.count("*").alias("n"))
    )
    df = {r["w"]: r["n"] for r in seen.collect()}
    return [log((n + 1) / (df.get(i, 0) + 1)) for i in range(len(index.vocabulary))]


def _phrase_places(hits: Column, index: TemplateIndex, phrase: str) -> Column:
    ids = [index.ids[w] for w in phrase.split()]

    def stands(h: Column, j: Column) -> Column:
        ok = h["w"] == ids[0]
        for k, word in enumerate(ids[1:], 1):
            other = F.get(hits, j + k)
            ok = ok & (other["w"] == word) & (other["i"] == h["i"] + k)
        return F.coalesce(ok, F.lit(False))

    return F.transform(F.filter(hits, stands), lambda h: h["i"])


def match_templates(hits: Column, index: TemplateIndex, weights: list[float]) -> Column:
    """`array<struct<label, score>>` of the templates found in one file's hits.

    A window is `index.window` hits in a row that lie within `index.reach` words. The postings of its
    two rarest words (highest IDF; ties to the lesser word) are moved to where their templates would
    begin, and intersected; what both propose is verified. A template is found if the words of each of its
    mandatory phrases stand in place with no licence word between them, and scores the share of its
    words that do. None is missed, whatever else the file holds: the hits on a mandatory phrase follow
    one another, so some window lies on its words alone, and any two of these propose the template.
    Windows and proposals take bounded steps each, so all is linear in the hits.
    """
    order = sorted(range(len(weights)), key=lambda i: (-weights[i], i))
    rank = F.array(*[F.lit(r) for r in sorted(range(len(order)), key=lambda r: order[r])])
    size = index.window

    def together(w: Column) -> Column:
        apart = F.get(w, F.lit(size - 1))["i"] - F.get(w, F.lit(0))["i"]
        return (F.size(w) == size) & (apart <= index.reach)

    def rarest(w: Column) -> Column:
        ranked = F.transform(w["hits"], lambda h: F.struct(F.get(rank, h["w"]).alias("r"), h["i"], h["w"]))
        return F.struct(w["j"].alias("j"), F.slice(F.array_sort(ranked), 1, RAREST).alias("two"))

    def origins(h: Column) -> Column:
        """Template and beginning, in one number, which an intersection hashes."""
        return F.transform(
            F.get(index.postings, h["w"]),
            lambda a: F.shiftleft(a["t"], _ORIGIN_BITS) + (h["i"] - a["p"] + index.span),
        )

    def proposals(w: Column) -> Column:
        both = F.array_intersect(origins(F.get(w["two"], F.lit(0))), origins(F.get(w["two"], F.lit(1))))
        return F.transform(
            both,
            lambda x: F.struct(
                F.shiftright(x, _ORIGIN_BITS).cast("int").alias("t"),
                (x.bitwiseAND(F.lit((1 << _ORIGIN_BITS) - 1)) - index.span).alias("o"),
                w["j"].alias("j"),
            ),
        )

    def held(x: Column) -> Column:
        """The template, and the licence words on its places."""
        # Hits lie on different words, so a template's are among as many on either side.
        near = F.slice(hits, F.greatest(x["j"] + 2 - index.span, F.lit(1)), F.lit(2 * index.span))
        moved = F.transform(near, lambda h: F.struct((h["i"] - x["o"]).alias("p"), h["w"].alias("w")))
        return F.struct(F.get(index.rows, x["t"]).alias("t"), moved.alias("on"))

    def stands(x: Column):
        def one(phrase: Column) -> Column:
            first, last = F.get(phrase, F.lit(0))["p"], F.element_at(phrase, -1)["p"]
            return F.filter(x["on"], lambda h: h["p"].between(first, last)) == phrase

        return one

    def share(x: Column) -> Column:
        right = F.filter(x["on"], lambda h: (h["p"] >= 0) & (F.get(x["t"]["expected"], h["p"].cast("int")) == h["w"]))
        return F.size(right) / x["t"]["size"]

    cut = F.transform(hits, lambda h, j: F.struct(j.alias("j"), F.slice(hits, j + 1, F.lit(size)).alias("hits")))
    windows = F.transform(F.filter(cut, lambda w: together(w["hits"])), rarest)
    proposed = F.transform(F.flatten(F.transform(windows, proposals)), held)
    verified = F.filter(proposed, lambda x: F.forall(x["t"]["phrases"], stands(x)))
    return F.transform(verified, lambda x: F.struct(x["t"]["label"].alias("label"), share(x).alias("score")))


def scan_licenses(
    docs: DataFrame, text: str = "text", templates: list[Template] | None = None
) -> DataFrame:
    """Each row of `docs` without the text, with the licences its whole text names.

    One pass over the text leaves the places of licence words; document frequencies are counted from
    those, and everything else happens within the row: no text is shuffled, and no key can be hot.
    The index of `templates` (TEMPLATES, if None) is a literal of at most INDEX_BYTES.
    Words are compared in lower case. `n_base`, `first_word`, `last_word`, `base_labels`: the places
    of BASE_PHRASES. `labels`: those and the templates' (see `match_templates`). `score`: the best
    share of a template found, 0.5 at least where a base phrase stands.

    Null or empty text: no words, null first and last word, empty labels, score 0. Repeated rows
    are scanned one by one; other columns, nulls in them included, pass through, but those that
    have the name of a result column are replaced. An empty table gives an empty one.
    """
    result = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    docs = docs.drop(*[c for c in (*result, "hits", "_words") if c != text])
    index = TemplateIndex(TEMPLATES if templates is None else templates)
    hits = kept(license_hits(docs, index, text), "license-hits")
    weights = word_weights(hits, index)
    places = [_phrase_places(F.col("hits"), index, phrase) for phrase, _ in BASE_PHRASES]
    all_places = F.concat(*places)
    base = F.filter(
        F.array(*[F.when(F.size(p) > 0, F.lit(x)) for p, (_, x) in zip(places, BASE_PHRASES)]),
        lambda x: x.isNotNull(),
    )
    matched = hits.withColumns(
        {"_at": all_places, "_base": base, "_found": match_templates(F.col("hits"), index, weights)}
    )
    own = F.transform("_found", lambda x: x["label"])
    best = F.array_max(F.transform("_found", lambda x: F.least(x["score"], F.lit(1.0))))
    floor = F.when(F.size("_at") > 0, 0.5).otherwise(0.0)
    return matched.select(
        *[c for c in docs.columns if c != text],
        "n_words",
        F.size("_at").cast("long").alias("n_base"),
        F.array_min("_at").alias("first_word"),
        F.array_max("_at").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("_base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("_base", own))), ",").alias("labels"),
        F.greatest(F.coalesce(best, F.lit(0.0)), floor).alias("score"),
    )
