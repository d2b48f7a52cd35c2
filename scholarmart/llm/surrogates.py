"""Surrogates for personal data, in DataFrame functions only.

Detected entities (``KINDS``) are replaced by others of the same kind and format: digits by digits with the same separators (card
numbers keep their first digit and whether their checksum holds, phone numbers their country code), letters by letters of the
same case, addresses of private networks by private ones, name parts by invented names of the same script and, where a
title or a known given name tells it, gender. A surrogate follows from a keyed SHA-256 hash of kind and canonical form, so an
entity gets the same one in all documents and in all its spellings (coreference).

All but names are replaced by a keyed permutation of the forms of their format (``_permuted``), in which no form stands for itself, so entities of one
format keep distinct surrogates by construction. Where a format has at least ``ROOM`` times as many forms as entities, and for names, surrogates
are moreover compared with each other and with the originals of the whole table, and the later ones of a collision are drawn again by another
permutation (a name: with a syllable more) until none is left. A fuller format, such as private addresses of which most occur, has no
room for that: there a surrogate may be the original of another entity, but never its own. ``key`` must be kept secret.

Null texts stay null, texts without entities stay as they are, repeated rows are replaced alike, and other columns are left
alone except ``n_chars``, which is counted anew, and ``n_entities``, which is added or replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholarmart.llm.common import written

TITLES = {"f": "Mrs|Ms|Miss|Frau|Señora|Madame|Mme|Госпожа", "m": "Mr|Herr|Señor|Monsieur|Господин", "": "Dr|Prof"}
GIVEN = {
    "f": "Alice|Anna|Maria|Mary|Emma|Sophie|Laura|Julia|Sarah|Elena|Carmen|Claire|Olga|Анна|Мария|Елена|Ольга",
    "m": "John|James|Peter|Paul|Thomas|Michael|David|Robert|Hans|Carlos|Pierre|Juan|Ivan|Иван|Пётр|Сергей",
}
_NAME = r"\p{Lu}[\p{L}'’-]+"
#: in this order, the first that matches at a place decides
KINDS = {
    "email": r"(?<![\w.+-])[\w.+-]+@[\w-]+(?:\.[\w-]+)+",
    "secret": r"\b(?i:AKIA[0-9A-Z]{16})\b|(?<=\b(?i:password)=)[^\s\"']{6,}|(?<=\b(?i:token) = \")[0-9A-Za-z]{16,}|\b(?i:gh[pousr])_[0-9A-Za-z]{20,}",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3}[ .-]?\d{3,4}(?!\w)|(?<![\w+])\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\w)|(?<!\w)\(\d{3}\) \d{3}-\d{4}(?!\w)|(?<![\w-])\d{3}-\d{3}-\d{4}(?![\w-])|(?<![\w.-])\d{3}\.\d{3}\.\d{4}(?![\w-])",
    "social": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\w-])",
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d)",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?\b",
    "name": rf"\b(?iu:{'|'.join(TITLES.values())})\.? {_NAME}(?: {_NAME})?|\b(?iu:{'|'.join(GIVEN.values())}) {_NAME}",
}
#: a text without any of these has no entity; looked for first, as most texts have none
HINT = rf"@|\d{{3}}|\d\.\d|\+\d|(?i:AKIA|password=|token = |gh[pousr]_)|\b(?iu:{'|'.join([*TITLES.values(), *GIVEN.values()])})\b"
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
KEY = "change-me"
ROOM, TURNS = 4, 4
#: what may stand in place of a piece of an entity, by a name of one letter; parts of an address are pieces of their own
FORMS = {
    "d": list("0123456789"), "l": list("abcdefghijklmnopqrstuvwxyz"), "u": list("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "h": list("abcdef"), "m": list("!#$%&*?@^~"), "n": list("123456789"),
    "o": range(256), "first": [k for k in range(1, 224) if k not in (10, 127, 172, 192)], "reserved": [0, *range(224, 256)],
    "private-172": range(16, 32), "public-172": [k for k in range(256) if not 16 <= k <= 31], "public-192": [k for k in range(256) if k != 168],
}


def matches(text: Column) -> Column:
    """Entities of a text in order."""
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _kind(value: Column) -> Column:
    out = None
    for kind, pattern in KINDS.items():
        # look-arounds have been checked where the entity stood
        bare = value.rlike({"secret": r"^(?:(?i:AKIA[0-9A-Z]{16})|(?i:gh[pousr])_[0-9A-Za-z]{20,})$"}.get(kind, f"^(?:{pattern})$"))
        out = F.when(bare, kind) if out is None else out.when(bare, kind)
    return out.otherwise("secret")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _parts(value: Column, kind: Column) -> Column:
    """The parts of an entity that get surrogates: a name's words, else the entity itself."""
    words = F.split(value, " ")
    title = words[0].rlike(rf"^(?iu:{'|'.join(TITLES.values())})\.?$")
    gender = F.when(words[0].rlike(rf"^(?iu:{TITLES['f']})\.?$|^(?iu:{GIVEN['f']})$"), "f").when(words[0].rlike(rf"^(?iu:{TITLES['m']})\.?$|^(?iu:{GIVEN['m']})$"), "m").otherwise("")
    given = lambda i: F.when(title, (i == 1) & (F.size(words) == 3)).otherwise(i == 0)
    role = lambda w, i: F.when(title & (i == 0), "title").when(given(i), F.concat(F.lit("given-"), gender)).otherwise("surname")
    as_name = F.transform(words, lambda w, i: F.struct(role(w, i).alias("role"), w.alias("raw")))
    return F.when(kind == "name", as_name).otherwise(F.array(F.struct(kind.alias("role"), value.alias("raw"))))


def _canonical(role: Column, raw: Column) -> Column:
    return F.when(role.isin("phone", "card", "social"), _digits(raw)).when(role == "secret", raw).when(role == "iban", F.lower(F.replace(raw, F.lit(" "), F.lit("")))).otherwise(F.lower(raw))


def _draw(key: str, below: int, at: Column | int = 0) -> Column:
    """A number below ``below`` from the keyed hash of role, canonical form, attempt and place."""
    at = at if isinstance(at, Column) else F.lit(at)
    text = F.concat_ws("|", F.lit(key), "role", "canonical", F.col("attempt").cast("string"), at.cast("string"))
    return F.pmod(F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 12), 16, 10).cast("long"), F.lit(below)).cast("int")


def _pick(letters: str, number: Column) -> Column:
    return F.substring(F.lit(letters), number + 1, F.lit(1))


def _luhn(digits: Column) -> Column:
    """Checksum modulo 10 of a digit string."""
    n = F.length(digits)
    one = lambda i: F.substring(digits, i, F.lit(1)).cast("int")
    twice = lambda i: F.when(one(i) > 4, one(i) * 2 - 9).otherwise(one(i) * 2)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + F.when((n - i) % 2 == 1, twice(i)).otherwise(one(i))) % 10


def _forms() -> Column:
    return F.create_map(*(x for name, own in FORMS.items() for x in (F.lit(name), F.array(*(F.lit(str(v)) for v in own)))))


def _check_digit(digits: Column) -> Column:
    """The last digit that makes the checksum hold."""
    return (10 - _luhn(F.concat(F.substring(digits, F.lit(1), F.length(digits) - 1), F.lit("0")))) % 10


def _pieces(role: Column, canonical: Column) -> Column:
    """Pieces ``(name, value)`` of a canonical form: the name says what may stand there (``FORMS``), ``=`` and the value that it stays."""
    piece = lambda name, value: F.struct((F.lit(name) if isinstance(name, str) else name).alias("name"), value.alias("value"))
    fixed = lambda value: piece(F.concat(F.lit("="), value), value)
    kept = F.when(role == "card", 1).when(role == "phone", F.greatest(F.lit(0), F.length(canonical) - 10)).when(role == "iban", 2).when((role == "secret") & canonical.rlike("^(?i:AKIA|gh[pousr]_)"), 4).otherwise(0)
    end = F.length(canonical) - F.when(role == "email", F.length(F.substring_index(canonical, ".", -1))).otherwise(0)
    hexadecimal = canonical.rlike("^[0-9a-f]{16,}$")
    marks = F.lit("".join(FORMS["m"]))
    name = lambda c: F.when(c.rlike("^[0-9]$"), "d").when(hexadecimal & c.rlike("^[a-f]$"), "h").when(c.rlike("^[a-z]$"), "l").when(c.rlike("^[A-Z]$"), "u").when((role == "secret") & marks.contains(c), "m").otherwise(F.concat(F.lit("="), c))
    chars = F.transform(F.filter(F.split(canonical, ""), lambda c: c != ""), lambda c, i: F.when((i < kept) | (i >= end), fixed(c)).otherwise(piece(name(c), c)))
    # in place of a card's last digit: by how much it misses the one that makes the checksum hold
    miss = F.pmod(F.substring(canonical, -1, 1).cast("int") - _check_digit(canonical), F.lit(10)).cast("string")
    card = F.concat(F.slice(chars, F.lit(1), F.size(chars) - 1), F.array(F.when(miss == "0", fixed(miss)).otherwise(piece("n", miss))))

    octet = F.transform(F.split(canonical, r"\."), lambda o: o.cast("int").cast("string"))
    address = lambda first, second: F.array(first, second, piece("o", octet[2]), piece("o", octet[3]))
    stays, middle, second = fixed(octet[0]), octet[1].cast("int").between(16, 31), piece("o", octet[1])
    ip = (
        F.when(octet[0].isin("10", "127"), address(stays, second))
        .when((octet[0] == "192") & (octet[1] == "168"), address(stays, fixed(octet[1]))).when(octet[0] == "192", address(stays, piece("public-192", octet[1])))
        .when((octet[0] == "172") & middle, address(stays, piece("private-172", octet[1]))).when(octet[0] == "172", address(stays, piece("public-172", octet[1])))
        .when(octet[0].isin(*map(str, FORMS["first"])), address(piece("first", octet[0]), second)).otherwise(address(piece("reserved", octet[0]), second))
    )
    return F.when(role == "ip", ip).when(role == "card", card).otherwise(chars)


def _shaped(parts: DataFrame) -> DataFrame:
    """``parts(role, canonical)`` with the format, its number of forms (null for names), and the pieces as numbers.

    ``ats`` are the places of the pieces among the ``sizes`` forms that may stand there, ``sides`` deal the pieces that change to the two sides of ``_permuted``.
    """
    pieces = F.when(~_named(F.col("role")), _pieces(F.col("role"), F.col("canonical")))
    out = parts.withColumn("pieces", pieces).withColumn("names", F.col("pieces.name"))
    out = out.withColumn("sizes", F.transform("names", lambda n: F.when(n.startswith("="), 1).otherwise(F.size(F.element_at(_forms(), n)))))
    ats = F.transform("pieces", lambda p: F.when(p["name"].startswith("="), 0).otherwise(F.array_position(F.element_at(_forms(), p["name"]), p["value"]).cast("int") - 1))
    before = lambda i: F.size(F.filter(F.slice("sizes", F.lit(1), i), lambda n: n > 1))
    sides = F.transform("sizes", lambda n, i: F.when(n == 1, -1).otherwise(before(i) % 2))
    out = out.withColumn("ats", ats).withColumn("sides", sides).withColumn("format", F.concat(F.col("role"), F.lit("|"), F.array_join("names", "")))
    return out.withColumn("forms", F.aggregate("sizes", F.lit(1.0), lambda n, k: n * k)).drop("pieces")


def _permuted(key: str) -> Column:
    """The places of another form of the format, by a keyed permutation without fixed points.

    A network of ``TURNS`` turns adds to the pieces of either side numbers hashed from the other side, which can be undone, so it
    permutes the forms. Between the network and its undoing the first piece moves on by one, which no form survives unchanged.
    """
    first = F.array_position("sides", 0) - 1

    def turn(ats: Column, t: Column) -> Column:
        k, sign = F.least(t, 2 * TURNS - t), F.when(t < TURNS, 1).otherwise(-1)
        other = F.array_join(F.transform(F.filter(ats, lambda a, i: F.col("sides")[i] == 1 - k % 2), lambda a: a.cast("string")), ",")
        digest = F.sha2(F.concat_ws("|", F.lit(key), "format", F.col("attempt").cast("string"), k.cast("string"), other).cast("binary"), 256)
        size, side = lambda i: F.col("sizes")[i], lambda i: F.col("sides")[i]
        added = lambda h: F.transform(ats, lambda a, i: F.when(side(i) == k % 2, F.pmod(a + sign * F.pmod(F.xxhash64(h, i), size(i)), size(i)).cast("int")).otherwise(a))
        moved = F.transform(ats, lambda a, i: F.when(i == first, (a + 1) % size(i)).otherwise(a))
        return F.when(t == TURNS, moved).otherwise(F.transform(F.array(digest), added)[0])  # hashed once

    return F.aggregate(F.sequence(F.lit(0), F.lit(2 * TURNS)), F.col("ats"), turn)


def _name(key: str, consonants: str, vowels: str, female: str, male: str) -> Column:
    """Syllables of a script with an ending of the gender; every attempt is longer than the one before."""
    syllable = lambda i: F.concat(_pick(consonants, _draw(key, len(consonants), 2 * i)), _pick(vowels, _draw(key, len(vowels), 2 * i + 1)))
    body = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(2) + F.col("attempt")), syllable), "")
    end = F.when(F.col("role") == "given-f", F.lit(female)).when(F.col("role") == "given-m", F.lit(male)).otherwise(_pick(consonants, _draw(key, len(consonants), -1)))
    return F.concat(body, end)


def _surrogate(key: str) -> Column:
    role, canonical = F.col("role"), F.col("canonical")
    letters = F.transform(F.col("moved"), lambda a, i: F.when(F.col("names")[i].startswith("="), F.substring(F.col("names")[i], 2, 9)).otherwise(F.element_at(_forms(), F.col("names")[i])[a]))
    joined = F.when(role == "ip", F.array_join(letters, ".")).otherwise(F.array_join(letters, ""))
    card = F.concat(F.substring(joined, F.lit(1), F.length(joined) - 1), ((_check_digit(joined) + F.substring(joined, -1, 1).cast("int")) % 10).cast("string"))
    # a secret of which nothing can change gets hexadecimal digits, more with every attempt
    fresh = F.substring(F.sha2(F.concat_ws("|", F.lit(key), canonical, F.col("attempt").cast("string")).cast("binary"), 256), F.lit(1), F.length(canonical) + F.col("attempt"))
    cyrillic = _name(key, "бвгдклмнпрст", "аеиоу", "а", "н")
    greek = _name(key, "βγδκλμνπρστ", "αειου", "α", "ος")
    armenian = _name(key, "բգդկլմնպրստ", "աեիու", "ա", "ն")
    name = F.when(canonical.rlike(r"\p{IsCyrillic}"), cyrillic).when(canonical.rlike(r"\p{IsGreek}"), greek).when(canonical.rlike(r"\p{IsArmenian}"), armenian).otherwise(_name(key, "bcdfglmnprst", "aeiou", "na", "ro"))
    return F.when(_named(role), name).when(F.col("forms") == 1, fresh).when(role == "card", card).otherwise(joined)


def _formatted(role: Column, raw: Column, surrogate: Column) -> Column:
    """A surrogate with the separators and the case of the original spelling."""
    chars = F.filter(F.split(raw, ""), lambda c: c != "")
    digit_at = lambda i: F.length(_digits(F.substring(raw, F.lit(1), i + 1)))
    spelled = F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike("^[0-9]$"), F.substring(surrogate, digit_at(i), F.lit(1))).otherwise(c)), "")
    cased = F.array_join(F.transform(chars, lambda c, i: F.when(c != F.lower(c), F.upper(F.substring(surrogate, i + 1, F.lit(1)))).otherwise(F.substring(surrogate, i + 1, F.lit(1)))), "")
    grouped = F.array_join(F.transform(chars, lambda c, i: F.when(c == " ", c).otherwise(F.upper(F.substring(surrogate, F.length(F.replace(F.substring(raw, F.lit(1), i + 1), F.lit(" "), F.lit(""))), F.lit(1))))), "")
    named = F.when((raw == F.upper(raw)) & (F.length(raw) > 1), F.upper(surrogate)).otherwise(F.initcap(surrogate))
    return F.when(role == "title", raw).when(role.isin("phone", "card", "social"), spelled).when(role == "email", cased).when(role == "iban", grouped).when(role.startswith("given") | (role == "surname"), named).otherwise(surrogate)


def _named(role: Column) -> Column:
    return role.startswith("given") | (role == "surname")


def _space(role: Column) -> Column:
    """Roles whose surrogates must not meet each other: all parts of names, else the role itself."""
    return F.when(_named(role), F.lit("name")).otherwise(role)


def _drawn(todo: DataFrame, key: str) -> DataFrame:
    return todo.withColumn("moved", _permuted(key)).withColumn("surrogate", _surrogate(key)).drop("moved")


def surrogate_table(parts: DataFrame, key: str) -> DataFrame:
    """``role, canonical, surrogate`` for ``parts(role, canonical)``, distinct within each kind, and unlike every original
    where a format has room (see above)."""
    tasks = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shaped = _shaped(parts.where("role <> 'title'").distinct().repartition(tasks, F.xxhash64("role", "canonical")))
    shaped = written(shaped.withColumn("space", _space(F.col("role"))), "originals")
    originals = shaped.select("space", F.col("canonical").alias("surrogate")).distinct()
    full = written(shaped.where("forms > 1").groupBy("format").agg(F.count("*").alias("n"), F.first("forms").alias("forms")).where(F.col("n") * ROOM > F.col("forms")).select("format"), "full-formats")
    done = _drawn(shaped.join(full, "format").withColumn("attempt", F.lit(0)), key).select("space", "role", "canonical", "surrogate")
    done = written(done, "permuted")
    todo = shaped.join(full, "format", "left_anti").withColumn("attempt", F.lit(0))
    while not todo.isEmpty():
        taken = originals.union(done.select("space", "surrogate")).distinct()
        free = _drawn(todo, key).join(taken.withColumn("taken", F.lit(True)), ["space", "surrogate"], "left")
        first = F.row_number().over(Window.partitionBy("space", "surrogate").orderBy("role", "canonical")) == 1
        judged = written(free.withColumn("good", F.col("taken").isNull() & first), "drawn")
        done = done.union(judged.where("good").select("space", "role", "canonical", "surrogate"))
        todo = judged.where("not good").drop("surrogate", "taken", "good").withColumn("attempt", F.col("attempt") + 1)
    return done.select("role", "canonical", "surrogate")


def replace_entities(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with surrogates for all entities of ``text``, and ``n_entities``."""
    whole = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("whole"))
    whole = whole.withColumn("u1", F.xxhash64("whole")).withColumn("u2", F.xxhash64(F.lit(7), "whole"))
    held = written(whole.where(F.col("whole").rlike(HINT)).select("u1", "u2", F.array_distinct(matches(F.col("whole"))).alias("own")).where("size(own) > 0").distinct(), "entities")
    values = written(held.select(F.explode("own").alias("value")).distinct(), "values")
    parts = values.select("value", F.posexplode(_parts(F.col("value"), _kind(F.col("value")))).alias("pos", "part")).select("value", "pos", "part.role", "part.raw")
    parts = written(parts.withColumn("canonical", _canonical(F.col("role"), F.col("raw"))), "parts")
    found = surrogate_table(parts.select("role", "canonical"), key)
    spelled = parts.join(found, ["role", "canonical"], "left").select("value", "pos", _formatted(F.col("role"), F.col("raw"), F.col("surrogate")).alias("new"))
    spelled = spelled.groupBy("value").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "new"))), lambda p: p["new"]), " ").alias("new"))
    spelled = written(spelled, "spelled")
    of_text = held.select("u1", "u2", F.explode("own").alias("value")).join(spelled, "value").groupBy("u1", "u2").agg(F.map_from_entries(F.collect_list(F.struct("value", "new"))).alias("put"))
    of_text = written(of_text, "replacements")

    # texts that cannot hold an entity do not move
    hinted = F.coalesce(F.col("whole").rlike(HINT), F.lit(False))
    joined = whole.where(hinted).join(of_text, ["u1", "u2"], "left")
    own = F.when(F.col("put").isNotNull(), matches(F.col("whole"))).otherwise(F.array().cast("array<string>"))
    joined = joined.select("row", "whole", "put", own.alias("own"))
    between = F.split("whole", PATTERN, -1)
    new = F.array_join(F.zip_with(between, F.transform("own", lambda m: F.col("put")[m]), lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))), "")
    joined = joined.select("row", F.size("own").alias("n_entities"), F.when(F.size("own") > 0, new).otherwise(F.col("whole")).alias("whole"))
    joined = joined.union(whole.where(~hinted).select("row", F.lit(0).alias("n_entities"), "whole"))
    put = {"text": F.col("whole")}
    if "n_chars" in docs.columns:
        put["n_chars"] = F.when(F.col("n_entities") > 0, F.char_length("whole").cast("long")).otherwise(F.col("row.n_chars"))
    return joined.select(*(put.get(c, F.col("row")[c]).alias(c) for c in docs.columns if c != "n_entities"), "n_entities")
