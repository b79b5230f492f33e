"""Personal data replaced by keyed surrogates of the same type, format, script and gender."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import kept, let, lookup

#: Titles that mark a name, and the gender they tell.
TITLES = {
    "m": ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Господин"),
    "f": ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Señora", "Госпожа"),
    "n": ("Dr", "Prof"),
}
#: Given names by gender and script.
GIVEN = {
    ("m", "latin"): "James Paul Martin Oscar Hugo Felix Bruno Leon Adam Victor Simon Lucas".split(),
    ("f", "latin"): "Alice Emma Clara Laura Marta Sofia Irene Julia Nina Elena Anna Helen".split(),
    ("n", "latin"): "Robin Alex Kim Sascha Dominique Jean Noel Sam Chris Andrea Jo Lee".split(),
    ("m", "cyrillic"): "Иван Олег Павел Антон Борис Максим".split(),
    ("f", "cyrillic"): "Анна Ольга Мария Елена Ирина Вера".split(),
    ("n", "cyrillic"): "Саша Женя Валя Слава Шура Миша".split(),
}

#: Parts of which further names are made, and their ends by gender; of as many parts as
#: it takes, so no corpus uses them up.
SYLLABLES = {
    "latin": "ba be bi da de di ka ke ki la le li ma me mi na ne ni ra re ri sa se si ta te ti va ve vi".split(),
    "cyrillic": "ба бе би да де ди ка ке ки ла ле ли ма ме ми на не ни ра ре ри са се си та те ти ва ве ви".split(),
}
ENDINGS = {
    ("m", "latin"): "bert dan lek mir ron tor".split(),
    ("f", "latin"): "dela lia nna ria tta vina".split(),
    ("n", "latin"): "ey il ley lin ren wyn".split(),
    ("m", "cyrillic"): "дан лав мир рон слав тор".split(),
    ("f", "cyrillic"): "веста дана лина нна рия тта".split(),
    ("n", "cyrillic"): "ля ня ря ся тя ша".split(),
}

_TITLE = "(?:" + "|".join(t for ts in TITLES.values() for t in ts) + ")"
_NAME = r"\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?"

#: A key and what stands between it and its value: `password=`, `API_KEY = "`, `"token": "`.
SECRET_KEY = (
    r"(?=[PpSsTtAa])(?i:password|passwd|pwd|secret|token|api[_\-]?key)[\"']?[ \t]*+"
    r"(?:[=:]=?>?[ \t]*+(?=[^\s\"',;]|\"[^\"\s]|'[^'\s])|[=:])[\"']?"
)
#: Length of the account numbers of each country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ DZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_GROUPED = "|".join(
    f"(?:{'|'.join(countries.split())})[0-9]{{2}}(?: [A-Z0-9]{{4}}){{{n // 4 - 1}}}"
    + (f" [A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    for n, countries in IBAN_LENGTHS.items()
)
_H16 = "[0-9A-Fa-f]{1,4}"

#: What is looked for, in this order where two could begin at one place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+",
    "aws": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "secret": r"(?<=\")[^\"\s][^\"\r\n]*+(?=\")|(?<=')[^'\s][^'\r\n]*+(?=')|[^\s\"',;]+",
    "hex": r"(?<![A-Za-z0-9])[0-9A-Fa-f]{32,64}(?![A-Za-z0-9])",
    "iban": rf"(?<![A-Za-z0-9])(?:[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}|(?=[A-Z]{{2}}[0-9]{{2}} )(?:{_GROUPED}))(?![A-Za-z0-9])",
    "card": r"(?<![\d.])(?:[0-9]{4}(?<sep>[ \-]?)[0-9]{4}\k<sep>[0-9]{4}\k<sep>[0-9]{4}|3[47][0-9]{2}(?<gap>[ \-]?)[0-9]{6}\k<gap>[0-9]{5})(?!\d)",
    "ipv6": rf"(?<![A-Za-z0-9:.])(?:(?:{_H16}:){{7}}{_H16}|[23Ff][0-9A-Fa-f]{{3}}(?::{_H16}){{0,6}}::(?:{_H16}(?::{_H16}){{0,5}})?)(?![A-Za-z0-9:])",
    "ipv4": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)",
    "ssn": r"(?<![\d\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\d\-])",
    "phone": r"(?<![\w+])(?:\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .\-][0-9]{3,4}[ .\-][0-9]{4}(?![\d\-])",
    "intl": r"(?<![\w+])\+[0-9]{1,3}(?:[ .\-]?[0-9]{2,4}){2,5}(?![\d\-])",
    "person": rf"(?<!\p{{L}}){_TITLE}\.? {_NAME}(?: {_NAME})?",
}

#: Pieces to replace; a secret's begins with its key, which stays, unless the key ends another piece.
ANY = "|".join(
    f"{SECRET_KEY}(?:{'|'.join(PATTERNS[k] for k in ('email', 'aws', 'secret'))})"
    r"|(?<=(?i:password|passwd|pwd|secret|token|api_key)[=:])[^\s\"',;]+"
    if k == "secret"
    else p
    for k, p in PATTERNS.items()
)
#: Texts without any of these hold nothing that ANY finds.
HINT = rf"[@0-9]|{_TITLE}\.? \p{{Lu}}|{SECRET_KEY}|AKIA|[A-Fa-f]{{32}}|[A-Fa-f]:[:A-Fa-f]"

#: Attempts that keep a token's shape; later ones lengthen it, so that no shape can be used up.
SHAPED_ATTEMPTS = 4

_TOKENS = "array<struct<kind:string,value:string>>"


def kind_of(e: Column) -> Column:
    """Type of a found piece; a value after `password=` may look like another type and is that."""
    whole = {k: "^(?:" + p + ")$" for k, p in PATTERNS.items() if k != "secret"}
    kind = F.when(F.lit(False), "")
    for name, pattern in whole.items():
        kind = kind.when(e.rlike(pattern), "phone" if name == "intl" else name)
    return kind.otherwise("secret")


def _script(name: Column) -> Column:
    return F.when(name.rlike(r"^\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def _person_tokens(e: Column) -> Column:
    """A person's given name, if there is one, and surname, each with what its surrogate must match."""
    words = F.split(e, " ")
    title = F.regexp_replace(words[0], r"\.$", "")
    gender = F.when(title.isin(*TITLES["m"]), "m").when(title.isin(*TITLES["f"]), "f").otherwise("n")
    given, last = F.get(words, F.lit(1)), F.element_at(words, -1)
    surname = F.struct(F.concat(F.lit("surname-"), _script(last)).alias("kind"), F.lower(last).alias("value"))
    first = F.struct(
        F.concat_ws("-", F.lit("given"), gender, _script(given)).alias("kind"), F.lower(given).alias("value")
    )
    return F.when(F.size(words) > 2, F.array(first, surname)).otherwise(F.array(surname))


def _whole_ipv6(e: Column) -> Column:
    """The address with its eight groups of four digits, however it is shortened."""
    sides = F.transform(F.split(e, "::"), lambda side: F.filter(F.split(side, ":"), lambda g: g != ""))
    after = F.coalesce(F.get(sides, F.lit(1)), F.array().cast("array<string>"))
    zeros = F.array_repeat(F.lit("0"), F.lit(8) - F.size(sides[0]) - F.size(after))
    return F.array_join(F.transform(F.concat(sides[0], zeros, after), lambda g: F.lpad(g, 4, "0")), ":")


def tokens_of(e: Column, kind: Column) -> Column:
    """What a found piece refers to, whatever its case or separators: `array<struct<kind, value>>`."""
    digits = F.regexp_replace(e, "[^0-9]", "")
    value = (
        F.when(kind.isin("card", "phone", "ssn"), digits)
        .when(kind.isin("email", "hex"), F.lower(e))
        .when(kind == "iban", F.replace(e, F.lit(" "), F.lit("")))
        .when(kind == "ipv6", _whole_ipv6(F.lower(e)))
        .otherwise(e)
    )
    one = F.array(F.struct(kind.alias("kind"), value.alias("value")))
    return F.when(kind == "person", _person_tokens(e)).otherwise(one).cast(_TOKENS)


def _chars(text: Column) -> Column:
    at = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.substr(text, i, F.lit(1)))


def _pick(letters: str, draw: Column) -> Column:
    return F.substr(F.lit(letters), (F.pmod(draw, F.lit(len(letters))) + 1).cast("int"), F.lit(1))


_VOWELS, _CONSONANTS = "aeiou", "bdfghklmnprstvz"
_CYR_VOWELS, _CYR_CONSONANTS = "аеиоу", "бвгдзклмнпрст"


def _mask(text: Column, digest: Column, names: bool = False) -> Column:
    """Each letter or digit drawn anew within its class; everything else stays."""

    def one(c: Column, i: Column) -> Column:
        draw = F.xxhash64(digest, i)
        if names:
            return (
                F.when(c.rlike("^[aeiouyáàâäåæèéêëíìîïóòôöøœúùûü]$"), _pick(_VOWELS, draw))
                .when(c.rlike(r"^[аеёиоуыэюя]$"), _pick(_CYR_VOWELS, draw))
                .when(c.rlike(r"^\p{IsCyrillic}$"), _pick(_CYR_CONSONANTS, draw))
                .when(c.rlike(r"^\p{L}$"), _pick(_CONSONANTS, draw))
                .otherwise(c)
            )
        return (
            F.when(c.rlike("^[0-9]$"), _pick("0123456789", draw))
            .when(c.rlike("^[a-z]$"), _pick("abcdefghijklmnopqrstuvwxyz", draw))
            .when(c.rlike("^[A-Z]$"), _pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", draw))
            .when(c.rlike(r"^\p{IsCyrillic}$"), _pick(_CYR_VOWELS + _CYR_CONSONANTS, draw))
            .when(c.rlike(r"^[\p{L}\p{N}]$"), _pick("abcdefghijklmnopqrstuvwxyz", draw))
            .otherwise(c)
        )

    return F.array_join(F.transform(_chars(text), one), "")


def _with_check_digit(digits: Column) -> Column:
    """The last digit set so that a card number passes the checksum of card numbers."""

    def weighed(i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int") * F.when((F.length(digits) - i) % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits) - 1), F.lit(0), lambda a, i: a + weighed(i))
    return F.concat(F.substr(digits, F.lit(1), F.length(digits) - 1), ((10 - total % 10) % 10).cast("string"))


def _made_name(digest: Column, attempt: Column, gender: str, script: str) -> Column:
    """A given name of a gender, of one part more with each attempt."""

    def part(parts: list[str], i: Column) -> Column:
        return F.element_at(F.array(*[F.lit(x) for x in parts]), (F.pmod(F.xxhash64(digest, i), F.lit(len(parts))) + 1).cast("int"))

    parts = F.transform(F.sequence(F.lit(0), attempt), lambda i: part(SYLLABLES[script], i))
    return F.initcap(F.concat(F.array_join(parts, ""), part(ENDINGS[gender, script], F.lit(-1))))


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """Replacement of a token: a function of key, type, value and attempt, and nothing else.

    From attempt SHAPED_ATTEMPTS on it is longer than the value, by more with each attempt, as all of
    its shape may be taken. A value without a letter or digit has no shape and gives a digest.
    """
    digest = F.sha2(F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), value), 256)
    masked = _mask(value, digest)
    over = attempt - (SHAPED_ATTEMPTS - 1)
    drawn = lambda unit, names=False: _mask(F.repeat(F.lit(unit), over), F.concat(digest, F.lit("~")), names)
    rest = lambda n: F.concat(F.substr(value, F.lit(1), F.lit(n)), F.substr(masked, F.lit(n + 1)))
    octet = lambda i: (F.pmod(F.xxhash64(digest, F.lit(i)), F.lit(254)) + 1).cast("string")
    hexed = F.substr(F.concat(digest, digest), F.lit(1), F.length(value))
    local = F.regexp_extract(value, "^(.*)@", 1)
    host = F.concat(
        F.lit("@"),
        _mask(F.lit("aaaa00"), F.concat(digest, F.lit("@"))),
        F.lit(".example."),
        F.element_at(F.array(F.lit("com"), F.lit("org"), F.lit("net")), (F.pmod(F.xxhash64(digest), F.lit(3)) + 1).cast("int")),
    )
    name = F.initcap(_mask(value, digest, names=True))
    out = (
        F.when(kind == "email", F.concat(_mask(local, digest), F.when(over < 1, F.lit("")).otherwise(drawn("a0")), host))
        .when(kind == "aws", rest(4))
        .when(kind == "iban", rest(2))
        .when(kind == "hex", hexed)
        .when(kind == "card", let(F.when(F.length(value) == 15, rest(2)).otherwise(rest(1)), _with_check_digit))
        .when(kind == "ipv6", F.concat_ws(":", F.substr(value, F.lit(1), F.lit(4)), *[F.substr(digest, F.lit(4 * i), F.lit(4)) for i in range(1, 8)]))
        .when(kind == "ipv4", F.concat_ws(".", *[octet(i) for i in range(4)]))
        .when(kind == "phone", rest(1))
    )
    for (gender, script), given in GIVEN.items():
        place = (F.pmod(F.xxhash64(digest), F.lit(len(given))) + 1).cast("int")
        listed = F.element_at(F.array(*[F.lit(g) for g in given]), place)
        # The list is short: a name that meets another one there is made of parts next time.
        out = out.when(
            kind == f"given-{gender}-{script}", F.when(attempt == 0, listed).otherwise(_made_name(digest, attempt, gender, script))
        )
    shapeless = ~value.rlike(r"[\p{L}\p{N}]")
    out = out.when(kind.startswith("surname-"), name).when(shapeless, F.substr(digest, F.lit(1), F.lit(16))).otherwise(masked)
    tail = (
        F.when((over < 1) | (kind == "email") | kind.startswith("given-"), F.lit(""))
        .when(kind.isin("card", "phone", "ssn"), drawn("0000"))
        .when(kind == "ipv4", F.concat(F.lit(":"), drawn("0000")))
        .when(kind.endswith("-cyrillic"), drawn("ба", names=True))
        .when(kind.startswith("surname-"), drawn("ba", names=True))
        .otherwise(drawn("a0a0"))
    )
    return F.concat(out, tail)


def _formatted(e: Column, kind: Column, made: Column) -> Column:
    """The surrogate `made` (one per token) in the format of the piece `e`."""
    # What an IBAN's surrogate fills are letters too.
    other = F.when(kind == "iban", "[^0-9A-Z]").otherwise("[^0-9]")
    own = F.when(kind == "iban", "^[0-9A-Z]$").otherwise("^[0-9]$")
    digits = F.regexp_replace(e, other, "")

    def put(c: Column, i: Column) -> Column:
        before = F.length(F.regexp_replace(F.substr(e, F.lit(1), i), other, "")) + 1
        return F.when(F.regexp_like(c, own), F.substr(made[0], before.cast("int"), F.lit(1))).otherwise(c)

    # A lengthened surrogate has more digits than the piece; they follow.
    shaped = F.concat(F.array_join(F.transform(_chars(e), put), ""), F.substr(made[0], F.length(digits) + 1))
    title = F.regexp_extract(e, "^([^ ]+) ", 1)
    return (
        F.when(kind == "person", F.concat_ws(" ", title, F.array_join(made, " ")))
        .when(kind.isin("card", "phone", "ssn", "iban"), shaped)
        .when(kind.isin("hex", "ipv6") & e.rlike("[A-F]"), F.upper(made[0]))
        .otherwise(made[0])
    )


def resolved(tokens: DataFrame, key: str) -> DataFrame:
    """`kind, value, attempt, made` of distinct tokens, no two of a kind with one surrogate.

    Surrogates that meet another one, or a value that occurs, are drawn again with the next
    attempt; of those that meet, the earlier attempt stays, then the lesser value. Rounds go on until
    nothing meets; they end, as surrogates grow longer than any value that occurs.
    """
    first = tokens.select("kind", "value").distinct().withColumn("attempt", F.lit(0))
    made = surrogate(F.col("kind"), F.col("value"), F.col("attempt"), key)
    now = kept(first.withColumn("made", made), "surrogates")
    while True:
        owner = now.groupBy("kind", "made").agg(
            F.count("*").alias("n"), F.min(F.struct("attempt", "value")).alias("first")
        )
        clash = now.join(owner.where("n > 1"), ["kind", "made"]).where(F.col("value") != F.col("first.value"))
        real = now.select("kind", F.lower("value").alias("made")).distinct()
        known = now.withColumn("made", F.lower("made")).join(real, ["kind", "made"], "left_semi")
        again = kept(clash.select("kind", "value").unionByName(known.select("kind", "value")).distinct(), "clashes")
        if again.isEmpty():
            return now
        moved = now.join(again.withColumn("_again", F.lit(1)), ["kind", "value"], "left")
        now = kept(
            moved.withColumn("attempt", F.col("attempt") + F.coalesce("_again", F.lit(0)))
            .select("kind", "value", "attempt")
            .withColumn("made", made),
            "surrogates",
        )


#: Stands about the pieces found, while a text is cut at them.
_MARK = "\x01"


def _found(docs: DataFrame) -> DataFrame:
    """`docs` cut at what stands there, in one search of each text.

    `_pieces` and their `_kinds` in order; `_keys`, the key before a secret; `_between`, what stands
    before, between and after them. `text` stays where there are none.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    none = F.array().cast("array<string>")
    marked = F.split(F.regexp_replace(text, ANY, f"{_MARK}$0{_MARK}"), _MARK, -1)
    cut = let(
        marked,
        lambda parts: F.struct(
            F.filter(parts, lambda _, i: i % 2 == 1).alias("pieces"), F.filter(parts, lambda _, i: i % 2 == 0).alias("between")
        ),
    )
    # A text that has the mark itself is searched twice instead.
    twice = F.struct(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)).alias("pieces"), F.split(text, ANY, -1).alias("between"))
    nothing = F.struct(none.alias("pieces"), none.alias("between"))
    parts = F.when(~text.rlike(HINT), nothing).when(F.contains(text, F.lit(_MARK)), twice).otherwise(cut)
    found = docs.withColumn("_rid", _row_key()).withColumn("_cut", parts)
    found = found.withColumns({"_pieces": F.col("_cut.pieces"), "_between": F.col("_cut.between")}).drop("_cut")
    keys = F.transform("_pieces", lambda e: F.regexp_extract(e, f"^(?:{SECRET_KEY})(?=.)", 0))
    values = F.zip_with("_pieces", "_keys", lambda e, k: F.substr(e, F.length(k) + 1))
    found = found.withColumn("_keys", keys).withColumn("_pieces", values)
    left = F.when(F.size("_pieces") == 0, F.col("text").cast("string"))
    return found.withColumns({"_kinds": F.transform("_pieces", kind_of), "text": left})


def _row_key() -> Column:
    t = F.hex(F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), t)


def replace_private(docs: DataFrame, key: str) -> DataFrame:
    """`docs` with personal data in `text` replaced, `n_entities` and `kinds` (sorted, distinct).

    The same mail address, number or name gets the same surrogate throughout the corpus, written
    the way it stood; different ones of a type get different ones. Names found with a title are also
    replaced where they stand alone in the same text. Each text is searched once and written cut at
    what was found. A surrogate depends on the key and the value alone, so only documents with a
    value that had to be drawn again are joined with a list.

    Null text stays null and has no entities. Repeated rows are replaced alike. Other columns pass
    through, but those named `n_entities` or `kinds` are replaced. An empty table gives an empty one.
    """
    docs = docs.drop("n_entities", "kinds")
    found = kept(_found(docs), "cut-texts")
    per_piece = F.flatten(F.zip_with("_pieces", "_kinds", tokens_of))
    held = found.where(F.size("_pieces") > 0).select(F.col("_rid").alias("rid"), per_piece.alias("tokens"))
    held = kept(held, "private")
    tokens = held.select("rid", F.inline("tokens"))
    settled = resolved(tokens, key)
    redrawn = kept(
        settled.where("attempt > 0").select(
            F.concat_ws("|", "kind", "value").alias("token"), "attempt"
        ),
        "redrawn",
    )
    if not redrawn.isEmpty():
        named = kept(tokens.select("rid", F.concat_ws("|", "kind", "value").alias("token")).distinct(), "named")
        lists = (
            lookup(named, redrawn, "token", "inner")
            .groupBy("rid")
            .agg(F.map_from_entries(F.collect_list(F.struct("token", "attempt"))).alias("_attempts"))
        )
        found = found.join(kept(lists, "attempts").withColumnRenamed("rid", "_rid"), "_rid", "left")
    else:
        found = found.withColumn("_attempts", F.lit(None).cast("map<string,int>"))

    def one(t: Column) -> Column:
        token = F.concat_ws("|", t["kind"], t["value"])
        attempt = F.coalesce(F.try_element_at(F.col("_attempts"), token), F.lit(0))
        return surrogate(t["kind"], t["value"], attempt, key)

    made = F.zip_with("_pieces", "_kinds", lambda e, kind: F.transform(tokens_of(e, kind), one))
    out = found.withColumn("_made", made)
    new = F.zip_with(
        F.arrays_zip("_pieces", "_kinds"), "_made", lambda x, m: _formatted(x["_pieces"], x["_kinds"], m)
    )
    replaced = F.zip_with("_keys", new, lambda k, m: F.concat(k, m))
    out = out.withColumns({"_new": replaced, "_between": _without_names()})
    rebuilt = F.array_join(F.flatten(F.zip_with("_between", "_new", lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    text = F.when(F.size("_pieces") > 0, rebuilt).otherwise(F.col("text"))
    return out.select(
        *[text.alias("text") if c == "text" else F.col(c) for c in docs.columns],
        F.size("_pieces").cast("long").alias("n_entities"),
        F.array_join(F.array_sort(F.array_distinct("_kinds")), ",").alias("kinds"),
    )


def _without_names() -> Column:
    """`_between` with the names of persons found in the text, where they stand alone, replaced too."""

    def of(x: Column, made: Column) -> Column:
        words = F.slice(F.split(x["_pieces"], " "), 2, 2)
        pairs = F.zip_with(words, made, lambda w, m: F.struct(w.alias("old"), m.alias("new")))
        return F.when(x["_kinds"] == "person", pairs).otherwise(F.array().cast("array<struct<old:string,new:string>>"))

    names = F.array_distinct(F.flatten(F.zip_with(F.arrays_zip("_pieces", "_kinds"), "_made", of)))

    def replaced(parts: Column, name: Column) -> Column:
        alone = F.concat(F.lit(r"(?<![\p{L}\p{N}])\Q"), name["old"], F.lit(r"\E(?![\p{L}\p{N}])"))
        return F.transform(parts, lambda part: F.regexp_replace(part, alone, name["new"]))

    return F.when(
        F.array_contains("_kinds", "person"), F.aggregate(names, F.col("_between"), replaced)
    ).otherwise(F.col("_between"))
