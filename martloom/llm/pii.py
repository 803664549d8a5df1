"""Personal data replaced by keyed surrogates of the same type.

DataFrame functions only; no row leaves the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.shared import stored
from martloom.llm.spans import match_spans

# Forms of address by gender, and cues that a name follows.
TITLES = {
    "m": ["Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "господин", "г-н", "κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña", "госпожа", "г-жа", "κυρία"],
    "": ["Dr", "Prof", "my name is", "My name is", "je m'appelle", "Je m'appelle", "ich heiße", "Ich heiße", "me llamo", "Me llamo", "меня зовут", "Меня зовут"],
}
# Given names whose gender is taken as known where no title says it. Such
# a name before another capitalised word needs no cue.
GIVEN = {
    "m": [
        "james", "john", "robert", "michael", "william", "david", "richard", "joseph", "thomas", "charles",
        "christopher", "daniel", "matthew", "anthony", "steven", "andrew", "kenneth", "george", "edward", "paul",
        "peter", "hans", "jürgen", "wolfgang", "klaus", "stefan", "andreas", "matthias", "günther", "dieter",
        "pierre", "jean", "michel", "philippe", "françois", "jacques", "luis", "carlos", "josé", "juan",
        "miguel", "javier", "fernando", "alejandro", "иван", "сергей", "николай", "дмитрий", "александр", "γιώργος",
    ],
    "f": [
        "mary", "patricia", "jennifer", "linda", "elizabeth", "susan", "jessica", "sarah", "karen", "margaret",
        "nancy", "barbara", "dorothy", "helen", "sandra", "laura", "emily", "rebecca", "anna", "maria",
        "sophie", "ursula", "monika", "petra", "sabine", "renate", "brigitte", "heike", "claudia", "ingrid",
        "claire", "isabelle", "nathalie", "catherine", "françoise", "monique", "isabel", "carmen", "lucía", "ana",
        "pilar", "teresa", "dolores", "cristina", "анна", "мария", "ольга", "елена", "наталья", "μαρία",
    ],
}
_CUE = "(?:" + "|".join(sorted((t for ts in TITLES.values() for t in ts), key=len, reverse=True)) + r")\.? "
_NAME = r"\p{Lu}(?:['’]\p{Lu})?[\p{L}\p{M}]+(?:['’-]\p{L}+)*+"
_KNOWN = "(?:" + "|".join(n.capitalize() for ns in GIVEN.values() for n in ns) + ")"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# In order: where two begin at one place, the first is meant. A host has up to 127 labels,
# the bound of such names; repeated groups are bounded or possessive, so that the matcher's
# stack does not grow with the text.
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,125}\.[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![A-Za-z0-9.])[3-6][0-9]{3}(?<gap>[ -]?)[0-9]{4}\k<gap>[0-9]{4}\k<gap>[0-9]{1,7}(?![A-Za-z0-9])",
    "ssn": r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])",
    "ip": rf"(?<![A-Za-z0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![A-Za-z0-9])(?!\.[0-9])",
    "phone": r"(?<![A-Za-z0-9+])(?:\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\)|[ .-]?[0-9]{2,4}){2,5}"
    r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![A-Za-z0-9])",
    "person": rf"(?<![\p{{L}}\p{{M}}\p{{N}}])(?:{_CUE}{_NAME}(?: {_NAME}){{0,2}}|{_KNOWN}(?: {_NAME}){{1,2}})",
}
PATTERN = "|".join(KINDS.values())
# Around a known name that stands alone; its letters, apostrophes and hyphens mean themselves.
_ALONE = (r"(?<![\p{L}\p{M}\p{N}])(?:", r")(?![\p{L}\p{M}\p{N}])")
KNOWN = "map<string,array<struct<kind:string,value:string>>>"
SURROGATE = "array<struct<kind:string,start:int,end:int,surrogate:string>>"
# Country codes of telephone numbers, one to three digits.
_COUNTRY = "^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
# Rounds in which surrogates that clash are drawn anew.
ROUNDS = 64

_LETTERS, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
# Per script: its letters in a pattern, consonants, vowels, and how names of each gender end.
_SCRIPTS = {
    "[Ѐ-ӿ]": ("бвгдзклмнпрст", "аеиоу", {"m": "н", "f": "на", "": "м", "family": "ров"}),
    "[Ͱ-Ͽ]": ("βγδζκλμνπρστ", "αειοη", {"m": "ς", "f": "να", "": "ν", "family": "δης"}),
    ".": ("bdfgklmnprstvz", "aeiou", {"m": "n", "f": "na", "": "l", "family": "ker"}),
}


def _octet(hashed: Column, i: Column | int) -> Column:
    """A number from 0 to 255 out of a hash in hexadecimal digits; places repeat after 63."""
    at = i if isinstance(i, Column) else F.lit(i)
    return F.conv(F.substring(hashed, (at % 63) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(letters: str, number: Column) -> Column:
    return F.substring(F.lit(letters), number % len(letters) + 1, F.lit(1))


def keyed_hash(key: str, *parts: Column) -> Column:
    """SHA-512 under a key, nested so that a text cannot be continued."""
    inner = F.sha2(F.concat_ws("\u001f", F.lit(f"in {key}"), *parts), 512)
    return F.sha2(F.concat(F.lit(f"out {key}"), inner), 512)


def _shaped(value: Column, hashed: Column) -> Column:
    """Every digit and ASCII letter exchanged for another of its class, all else as it was."""

    def other(c: Column, i: Column) -> Column:
        n = _octet(hashed, i)
        return (
            F.when(c.rlike("[0-9]"), _pick(_DIGITS, n))
            .when(c.rlike("[a-z]"), _pick(_LETTERS, n))
            .when(c.rlike("[A-Z]"), _pick(_LETTERS.upper(), n))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, ""), other), "")


def _padding(value: Column, hashed: Column, attempt: Column) -> Column:
    """Letters that bring a short value to 8 letters and digits, and one more with each further attempt."""
    missing = F.greatest(F.lit(0), 8 - F.length(F.regexp_replace(value, "[^a-z0-9]", ""))) + attempt
    letters = F.transform(F.sequence(F.lit(1), missing), lambda i: _pick(_LETTERS, _octet(hashed, i * 5 + 7)))
    return F.when(missing > 0, F.array_join(letters, "")).otherwise("")


def _card(digits: Column, hashed: Column) -> Column:
    """The first digit stays; the last makes the check sum right if it was right."""
    drawn = F.concat(F.substring(digits, 1, 1), F.substring(_shaped(digits, hashed), F.lit(2), F.length(digits) - 1))
    body = F.substring(drawn, F.lit(1), F.length(drawn) - 1)
    right = F.filter(F.split(F.lit(_DIGITS), ""), lambda d: F.call_function("luhn_check", F.concat(body, d)))
    return F.when(F.call_function("luhn_check", digits), F.concat(body, F.element_at(right, 1))).otherwise(drawn)


def _mod97(signs: Column) -> Column:
    """The remainder by 97 of digits and upper-case letters, A as 10 up to Z as 35."""

    def next_(rest: Column, c: Column) -> Column:
        digit = c.rlike("[0-9]")
        return F.when(digit, rest * 10 + F.ascii(c) - 48).otherwise(rest * 100 + F.ascii(c) - 55) % 97

    return F.aggregate(F.split(signs, ""), F.lit(0), next_)


def _iban(signs: Column, hashed: Column) -> Column:
    """The country stays; the check digits are right if they were right."""
    rest = lambda text, at: F.substring(text, F.lit(at), F.length(signs))
    country, body = F.substring(signs, 1, 2), rest(_shaped(signs, hashed), 5)
    check = F.lpad((98 - _mod97(F.concat(body, country, F.lit("00")))).cast("string"), 2, "0")
    was_right = _mod97(F.concat(rest(signs, 5), F.substring(signs, 1, 4))) == 1
    return F.concat(country, F.when(was_right, check).otherwise(F.substring(_shaped(signs, hashed), 3, 2)), body)


def _ssn(hashed: Column) -> Column:
    """A number that can be issued: area 001 to 899 but 666, group from 01, serial from 0001."""
    n = F.conv(F.substring(hashed, 1, 12), 16, 10).cast("long")
    area = 1 + n % 898
    shown = lambda value, width: F.lpad(value.cast("string"), width, "0")
    return F.concat(
        shown(area + (area >= 666).cast("int"), 3),
        shown(1 + F.floor(n / 898) % 99, 2),
        shown(1 + F.floor(n / (898 * 99)) % 9999, 4),
    )


def _phone(digits: Column, hashed: Column) -> Column:
    """The country code stays; behind a 1, area and exchange begin with 2 to 9."""
    country = F.regexp_extract(digits, _COUNTRY, 0)
    own = F.substring(digits, F.length(country) + 1, F.length(digits))
    new = _shaped(own, hashed)
    first = lambda at, i: F.when(F.length(own) >= at, _pick("23456789", _octet(hashed, i))).otherwise("")
    american = F.concat(first(1, 40), F.substring(new, 2, 2), first(4, 41), F.substring(new, F.lit(5), F.length(own)))
    return F.concat(country, F.when(country == "1", american).otherwise(new))


def _name(kind: Column, token: Column, hashed: Column, attempt: Column) -> Column:
    """A made-up name in the token's script, with the ending of its gender."""

    def of(consonants: str, vowels: str, endings: dict[str, str]) -> Column:
        count = 3 + F.floor(attempt / 3).cast("int")
        syllables = F.transform(
            F.sequence(F.lit(1), count),
            lambda i: F.concat(_pick(consonants, _octet(hashed, i * 2)), _pick(vowels, _octet(hashed, i * 2 + 1))),
        )
        ending = reduce(
            lambda rest, g: F.when(kind == f"given:{g}", endings[g]).otherwise(rest), ("m", "f", ""), F.lit(endings["family"])
        )
        return F.initcap(F.concat(F.array_join(syllables, ""), ending))

    scripts = list(_SCRIPTS.items())
    last = of(*scripts[-1][1])
    return reduce(lambda rest, s: F.when(token.rlike(s[0]), of(*s[1])).otherwise(rest), reversed(scripts[:-1]), last)


def drawn(kind: Column, value: Column, attempt: Column, hashed: Column) -> Column:
    """The surrogate of an entity in an attempt. ``hashed`` is the keyed hash of all three."""
    tail = F.regexp_extract(value, r"\.[^.]*$", 0)
    host = F.substring(value, F.lit(1), F.length(value) - F.length(tail))
    address = F.concat_ws(".", 1 + _octet(hashed, 0) % 223, _octet(hashed, 1), _octet(hashed, 2), 1 + _octet(hashed, 3) % 254)
    return (
        F.when(kind == "user", F.concat(_padding(value, hashed, attempt), _shaped(value, hashed)))
        .when(kind == "host", F.concat(_padding(host, hashed, attempt), _shaped(host, hashed), tail))
        .when(kind == "ip", address)
        .when(kind == "card", _card(value, hashed))
        .when(kind == "phone", _phone(value, hashed))
        .when(kind == "iban", _iban(value, hashed))
        .when(kind == "ssn", _ssn(hashed))
        .otherwise(_name(kind, value, hashed, attempt))
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``kind``, ``value``, ``surrogate`` for distinct ``kind``, ``value``: no two alike, none a value that occurs.

    A surrogate depends on the key and the entity alone unless it clashes with
    another's or equals an entity of the given ones. Those that do are drawn
    again; each round checks all of them, by joins and windows over groups of
    equal surrogates, which are few rows each. The earlier attempt keeps its own.
    Raises ``RuntimeError`` if some still clash after ``ROUNDS`` rounds, which takes
    nearly as many entities of a kind as it has values.
    """
    space = F.when(F.col("kind").startswith("given:") | (F.col("kind") == "family"), "name").otherwise(F.col("kind"))
    own = stored(entities.select("kind", "value").distinct(), "entities")
    taken = own.select(space.alias("space"), F.lower("value").alias("same")).distinct().withColumn("taken", F.lit(True))
    first = Window.partitionBy("space", "same").orderBy("attempt", "kind", "value")
    now = own.withColumn("attempt", F.lit(0))
    for _ in range(ROUNDS):
        hashed = now.withColumn("hashed", keyed_hash(key, F.col("kind"), F.col("value"), F.col("attempt").cast("string")))
        named = hashed.withColumn("surrogate", drawn(*(F.col(c) for c in ("kind", "value", "attempt", "hashed"))))
        checked = named.withColumns({"space": space, "same": F.lower("surrogate")}).join(taken, ["space", "same"], "left")
        clash = (F.row_number().over(first) > 1) | F.coalesce("taken", F.lit(False))
        done = stored(checked.select("kind", "value", "attempt", "surrogate", clash.alias("clash")), "surrogates")
        if done.filter("clash").isEmpty():
            return done.select("kind", "value", "surrogate")
        now = done.select("kind", "value", (F.col("attempt") + F.col("clash").cast("int")).alias("attempt"))
    raise RuntimeError(f"surrogates still clash after {ROUNDS} rounds; some kind has nearly as many values as it can have")


def _kind(value: Column) -> Column:
    return F.coalesce(*[F.when(value.rlike(f"^(?:{p})$"), kind) for kind, p in KINDS.items() if kind != "person"], F.lit("person"))


def _is_any(value: Column, words: list[str]) -> Column:
    return value.isin(*words)


def mentions(found: DataFrame) -> DataFrame:
    """One row per mention: ``row``, ``start``, ``end``, ``kind``, ``mention``, and the ``parts`` (kind, value) it stands for.

    ``known``, if ``found`` has it, maps names to their parts; it settles mentions without a cue.
    """
    if "known" not in found.columns:
        found = found.withColumn("known", F.lit(None).cast(KNOWN))
    cut = lambda s: F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"])
    spans = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), cut(s).alias("whole")))
    each = found.select("row", "known", F.explode(spans).alias("m")).select("row", "known", "m.*").withColumn("kind", _kind(F.col("whole")))
    cue = F.when(F.col("kind") == "person", F.regexp_extract("whole", f"^{_CUE}", 0)).otherwise("")
    each = each.withColumn("cue", cue).select(
        "row",
        "known",
        (F.col("start") + F.length("cue")).alias("start"),
        "end",
        "kind",
        F.substring("whole", F.length("cue") + 1, F.length("whole")).alias("mention"),
        F.rtrim(F.regexp_replace("cue", r"\.? $", "")).alias("title"),
    )
    value, names = F.col("mention"), F.split("mention", " ")
    digits = F.regexp_replace(value, "[^0-9]", "")
    one = lambda kind, v: F.struct(F.lit(kind).alias("kind"), v.alias("value"))
    is_title = _is_any(F.col("title"), [t for ts in TITLES.values() for t in ts if " " not in t])
    gender = (
        F.when(_is_any(F.col("title"), TITLES["m"]), "m")
        .when(_is_any(F.col("title"), TITLES["f"]), "f")
        .when(_is_any(F.lower(F.element_at(names, 1)), GIVEN["m"]), "m")
        .when(_is_any(F.lower(F.element_at(names, 1)), GIVEN["f"]), "f")
        .otherwise("")
    )

    def name(token: Column, i: Column) -> Column:
        family = (i == F.size(names) - 1) & ((F.size(names) > 1) | is_title)
        kind = F.when(family, F.lit("family")).otherwise(F.concat(F.lit("given:"), gender))
        return F.struct(kind.alias("kind"), F.lower(token).alias("value"))

    parts = (
        F.when(
            F.col("kind") == "email",
            F.array(one("user", F.lower(F.substring_index("mention", "@", 1))), one("host", F.lower(F.substring_index("mention", "@", -1)))),
        )
        .when(F.col("kind") == "person", F.transform(names, name))
        .when(F.col("kind") == "iban", F.array(one("iban", F.replace(value, F.lit(" "), F.lit("")))))
        .when(F.col("kind") == "ip", F.array(one("ip", value)))
        .when(F.col("kind") == "card", F.array(one("card", digits)))
        .when(F.col("kind") == "ssn", F.array(one("ssn", digits)))
        .otherwise(F.array(one("phone", F.when(value.startswith("+"), digits).otherwise(F.concat(F.lit("1"), digits)))))
    )
    settled = F.when((F.col("kind") == "person") & (F.col("title") == ""), F.try_element_at("known", F.col("mention")))
    return each.select("row", "start", "end", "kind", "mention", F.coalesce(settled, parts).alias("parts"))


def with_known_names(found: DataFrame) -> DataFrame:
    """``found`` with ``known`` and the spans of all mentions of known names.

    A whole name that a cue or a given name reveals, and its family name alone, are
    known in the same row from then on and wherever else they stand in its text.
    Rows with names are searched once more, for the patterns and those names together.
    """
    persons = mentions(found).filter(F.col("kind") == "person")
    last = F.element_at("parts", -1)
    both = F.array(
        F.struct("mention", "parts"),
        F.struct(F.element_at(F.split("mention", " "), -1).alias("mention"), F.array(last).alias("parts")),
    )
    names = persons.filter(last["kind"] == "family").select("row", F.explode(both).alias("n")).select("row", "n.*")
    once = names.groupBy("row", "mention").agg(F.min("parts").alias("parts"))
    longest = F.array_sort(F.collect_list(F.struct((-F.length("mention")).alias("order"), "mention", "parts")))
    listed = once.groupBy("row").agg(longest.alias("names")).select(
        "row",
        F.map_from_arrays("names.mention", "names.parts").alias("known"),
        F.concat(F.lit(f"{PATTERN}|{_ALONE[0]}"), F.array_join("names.mention", "|"), F.lit(_ALONE[1])).alias("pattern"),
    )
    again = F.when(F.col("pattern").isNull(), F.col("spans")).otherwise(match_spans(F.col("text"), F.coalesce("pattern", F.lit(PATTERN))))
    return found.join(listed, "row", "left").withColumn("spans", again).drop("pattern")


def _filled(layout: Column, signs: Column) -> Column:
    """The layout of a number, with its digits and letters taken from ``signs`` in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("used"))

    def put(s: Column, c: Column) -> Column:
        fits = c.rlike("[0-9A-Za-z]")
        next_ = F.when(fits, F.substring(signs, s["used"] + 1, F.lit(1))).otherwise(c)
        return F.struct(F.concat(s["out"], next_).alias("out"), (s["used"] + fits.cast("int")).alias("used"))

    return F.aggregate(F.split(layout, ""), start, put, lambda s: s["out"])


def _rendered(kind: Column, mention: Column, parts: Column) -> Column:
    """What replaces a mention, written as the mention is."""
    upper = lambda like, new: F.when((F.length(like) > 1) & (like == F.upper(like)), F.upper(new)).otherwise(new)
    names = F.array_join(F.zip_with(F.split(mention, " "), parts, upper), " ")
    number = F.element_at(parts, 1)
    national = F.substring(number, F.lit(2), F.length(number))
    return (
        F.when(kind == "email", upper(mention, F.array_join(parts, "@")))
        .when(kind == "person", names)
        .when(kind == "ip", number)
        .otherwise(_filled(mention, F.when((kind == "phone") & ~mention.startswith("+"), national).otherwise(number)))
    )


def replacements(found: DataFrame, key: str) -> DataFrame:
    """``row`` and ``entities``: the spans of a row and their surrogates, in order.

    ``found`` has ``row``, ``text`` and ``spans``. Parts are joined with the table
    of surrogates; where one entity has very many mentions, its surrogate is one
    row on one side and adaptive execution splits the other.
    """
    own = stored(mentions(with_known_names(found)), "mentions")
    parts = own.select("row", "start", "end", "kind", "mention", F.posexplode("parts").alias("at", "part")).select(
        "row", "start", "end", F.col("kind").alias("of"), "mention", "at", "part.kind", "part.value"
    )
    named = parts.join(surrogates(parts.select("kind", "value"), key), ["kind", "value"])
    whole = named.groupBy("row", "start", "end", F.col("of").alias("kind"), "mention").agg(
        F.array_sort(F.collect_list(F.struct("at", "surrogate")))["surrogate"].alias("parts")
    )
    rendered = whole.withColumn("surrogate", _rendered(F.col("kind"), F.col("mention"), F.col("parts")))
    one = F.struct("start", "end", "kind", "surrogate")
    listed = F.transform(
        F.array_sort(F.collect_list(one)), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["surrogate"].alias("surrogate"))
    )
    return rendered.groupBy("row").agg(listed.alias("entities"))


def _rewritten(text: Column, entities: Column) -> Column:
    before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.element_at(entities, i)["end"])
    kept = F.transform(entities, lambda x, i: F.concat(F.substring(text, before(i) + 1, x["start"] - before(i)), x["surrogate"]))
    return F.concat(F.array_join(kept, ""), F.substring(text, F.element_at(entities, -1)["end"] + 1, F.length(text)))


def pseudonymised(documents: DataFrame, key: str, name: str = "entities") -> DataFrame:
    """``documents`` with personal data in ``text`` replaced, and ``name``: the spans replaced and by what.

    E-mail and IP addresses, phone, card, bank and social security numbers, and
    names are replaced: names behind a title or another cue or that begin with a
    common given name, and where they or their family names stand again in the same
    text. Under one key, an entity has one surrogate in the whole table, and different entities have different ones:
    user and host of an address, the digits of a number, and each word of a name
    count as entities, without regard to case, spaces and signs between digits; a
    phone number without country code is one behind +1.
    Surrogates keep the layout, the case, a name's script and gender, the first
    digit of cards, the country of phones and bank numbers, right check sums, and
    the last label of hosts; social security numbers are ones that can be issued. Gender is what the title says, or a list of given
    names, or unknown; one given name with different genders is different names.

    Spans are code points of the old text, ends exclusive. NULL and empty texts
    have none and stay. Repeated rows are replaced alike; ``n_chars``, if there,
    follows the text; other columns pass through, and ``name`` replaces one of
    that name. Texts are searched once and written with what was found; only those
    with personal data are shuffled. Raises ``RuntimeError`` if nearly all values of
    a kind occur (see :func:`surrogates`).
    """
    columns = [c for c in documents.columns if c != name]
    found = documents.select(F.struct(*columns).alias("doc"), match_spans(F.col("text"), PATTERN).alias("spans"))
    kept = stored(found.withColumn("row", F.monotonically_increasing_id()), "personal-data")
    touched = kept.filter(F.size("spans") > 0).withColumn("text", F.col("doc.text"))
    plain = kept.filter(F.size("spans") == 0).select("doc.*", F.array().cast(SURROGATE).alias(name))
    new = touched.join(replacements(touched, key), "row")
    text = new.select("doc", "entities", _rewritten(F.col("text"), F.col("entities")).alias("new_text"))
    out = [F.col("new_text").alias(c) if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in columns]
    if "n_chars" in columns:
        out[columns.index("n_chars")] = F.length("new_text").cast(documents.schema["n_chars"].dataType).alias("n_chars")
    order = [name if c == name else c for c in documents.columns] + [name] * (name not in documents.columns)
    return text.select(*out, F.col("entities").alias(name)).unionByName(plain).select(*order)
