"""Personal data replaced by keyed surrogates of the same kind, with column functions only.

Detected entities keep their kind, their format (lengths, separators, letter case, valid check
digits), the gender of a title and the script of a name.  A surrogate is made from a keyed
digest of the entity, so one entity has one surrogate in all texts (coreference).  Surrogates
are compared with each other and with the entities of the texts; those that collide are made
anew until all differ, so different entities stay different (distinctness).

Entities of a kind are compared without what only formats them: telephone and card numbers by
their digits, addresses and secrets without letter case, persons by given name and surname.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.scratch import materialize

# Titles that tell a gender, by script.
TITLES = {
    ("latin", "m"): ["Mr", "Herr", "Monsieur", "Señor"],
    ("latin", "f"): ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mademoiselle", "Señora", "Señorita"],
    ("cyrillic", "m"): ["Господин", "г-н"],
    ("cyrillic", "f"): ["Госпожа", "г-жа"],
}
# Parts that surrogate names are built from.
SYLLABLES = {
    "latin": ["ba", "bel", "cor", "dan", "del", "el", "fal", "gar", "hal", "jor", "kel", "lan", "mar", "nor", "pel", "ras"],
    "cyrillic": ["ба", "бел", "вор", "гал", "дан", "жел", "зор", "кал", "лан", "мар", "нор", "пол", "рас", "сол", "тал", "фар"],
}
ENDINGS = {
    ("latin", "m"): ["o", "us", "in", "er"], ("latin", "f"): ["a", "ine", "elle", "ia"], ("latin", "s"): ["son", "mann", "ez", "ier"],
    ("cyrillic", "m"): ["ий", "ан", "ен", "ор"], ("cyrillic", "f"): ["ия", "ана", "ена", "ора"], ("cyrillic", "s"): ["енко", "ич", "ук", "ко"],
}
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAME = {"latin": r"\p{IsLatin}", "cyrillic": r"\p{IsCyrillic}"}
_UPPER = {"latin": r"[\p{Lu}&&\p{IsLatin}]", "cyrillic": r"[\p{Lu}&&\p{IsCyrillic}]"}
_TITLE = {s: "|".join(t for (x, _), names in TITLES.items() if x == s for t in names) for s in _NAME}
KINDS = {
    "email": r"(?<![\w.%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "ip": rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)",
    "secret": r"(?<![0-9A-Za-z])(?=[0-9A-Fa-f]*[A-Fa-f])(?=[A-Fa-f]*[0-9])[0-9A-Fa-f]{32,128}(?![0-9A-Za-z])",
    "card": r"(?<![\w.+-])\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\w-]|\.\d)",
    "phone": r"(?<![\w.+-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]?\d{4}(?![\w-]|\.\d)",
    "number": r"(?<![\w.+-])\d{3}-\d{2}-\d{4}(?![\w-]|\.\d)",
} | {
    f"person_{s}": rf"(?<!\p{{L}})(?:{_TITLE[s]})\.? {_UPPER[s]}[{_NAME[s]}'’-]+(?: {_UPPER[s]}[{_NAME[s]}'’-]+)?" for s in _NAME
}
PATTERN = "|".join(KINDS.values())
DIGITS, RETRIES = "0123456789", 2


def entities(text: Column) -> Column:
    """All entities of a text, in order."""
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def kind_of(surface: Column) -> Column:
    """The kind of an entity found by ``entities``, by the first pattern that it fits whole."""
    return F.coalesce(*[F.when(surface.rlike(f"^(?:{p})$"), F.lit(k)) for k, p in KINDS.items()])


def _stream(key: str, kind: Column, canon: Column, attempt: Column, size: Column) -> Column:
    """Hexadecimal digits of keyed digests, two for each of ``size`` characters."""
    block = lambda i: F.sha2(
        F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string"), i.cast("string"), F.lit(key)), 256
    )
    return F.array_join(F.transform(F.sequence(F.lit(0), F.floor(size / 32).cast("int")), block), "")


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substring(stream, i * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _letters(stream: Column, canon: Column, first: int = 0) -> Column:
    """Each letter replaced by a letter and each digit by a digit; the rest stays."""
    at = F.sequence(F.lit(0), F.length(canon) - 1)

    def one(i: Column) -> Column:
        c, b = F.substring(canon, i + 1, F.lit(1)), _byte(stream, i + first)
        letter = F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), b % 26 + 1, F.lit(1))
        return F.when(c.between("0", "9"), (b % 10).cast("string")).when(c.between("a", "z"), letter).otherwise(c)

    return F.when(F.length(canon) > 0, F.array_join(F.transform(at, one), "")).otherwise("")


def _luhn(digits: Column) -> Column:
    """The check sum of a card number modulo 10."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        doubled = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda t, i: t + F.lit(0) + add(F.lit(0), i)) % 10


def _built(stream: Column, script: str, part: str, size: Column) -> Column:
    """A name of ``size`` syllables and an ending."""
    syllables, endings = F.array(*map(F.lit, SYLLABLES[script])), F.array(*map(F.lit, ENDINGS[script, part]))
    body = F.transform(F.sequence(F.lit(1), size), lambda i: F.element_at(syllables, _byte(stream, i) % len(SYLLABLES[script]) + 1))
    return F.concat(F.array_join(body, ""), F.element_at(endings, _byte(stream, F.lit(0)) % len(ENDINGS[script, part]) + 1))


def surrogate(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """A candidate for the surrogate of an entity in its compared form."""
    s = _stream(key, kind, canon, attempt, F.length(canon) + 32)
    more = F.greatest(attempt - RETRIES, F.lit(0))  # short forms run out of surrogates: then longer ones
    tail = lambda n: F.substring(F.translate(s, "abcdef", "246802"), F.lit(3), n)
    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    top = F.substring_index(domain, ".", -1)
    inner = F.substring(domain, F.lit(1), F.length(domain) - F.length(top) - 1)
    email = F.concat(_letters(s, local), tail(more), F.lit("@"), _letters(F.reverse(s), inner), F.lit("."), top)
    ip = F.concat_ws(".", (_byte(s, F.lit(0)) % 223 + 1).cast("string"), *[_byte(s, F.lit(i)).cast("string") for i in (1, 2)], (_byte(s, F.lit(3)) % 254 + 1).cast("string"))
    hexed = F.substring(s, F.lit(1), F.length(canon))
    free = F.greatest(F.length(canon) - 10, F.lit(0))  # a country code stays
    phone = F.concat(F.substring(canon, F.lit(1), free), _letters(s, F.substring(canon, free + 1, F.length(canon))))
    digits = _letters(s, canon)
    body = F.substring(digits, F.lit(1), F.length(canon) - 1)
    check = ((10 - _luhn(F.concat(body, F.lit("0")))) % 10).cast("string")
    card = F.when(_luhn(canon) == 0, F.concat(body, check)).otherwise(digits)
    out = F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "secret", hexed).when(kind == "phone", phone)
    out = out.when(kind == "card", card).when(kind == "number", digits)
    for script, part in ENDINGS:
        out = out.when(kind == f"name_{script}_{part}", _built(s, script, part, F.lit(2) + more))
    return out


def _parts(rows: DataFrame) -> DataFrame:
    """(surface, kind, at, entity kind, compared form): one row, or one for each name of a person."""
    surface, kind = F.col("surface"), F.col("kind")
    title = F.substring_index(surface, " ", 1)
    bare = F.regexp_replace(title, r"\.$", "")
    names = F.slice(F.split(surface, " "), 2, 2)
    person = F.lit(None).cast("array<struct<kind:string,canon:string>>")
    pairs = lambda *x: F.array(*[F.struct(k.alias("kind"), c.alias("canon")) for k, c in x])
    for (script, gender), titles in TITLES.items():
        last, first = F.lower(F.element_at(names, -1)), F.lower(F.element_at(names, 1))
        surname, given = F.lit(f"name_{script}_s"), F.lit(f"name_{script}_{gender}")
        both = F.when(F.size(names) == 2, pairs((given, first), (surname, last))).otherwise(pairs((surname, last)))
        person = F.when((kind == f"person_{script}") & bare.isin(titles), both).otherwise(person)
    plain = (
        F.when(kind.isin("email", "secret"), F.lower(surface)).when(kind == "ip", surface)
        .otherwise(F.regexp_replace(surface, r"[^0-9+]", ""))
    )
    parts = F.coalesce(person, pairs((kind, plain)))
    return rows.select("surface", "kind", F.posexplode(parts).alias("at", "p")).select(
        "surface", "kind", "at", F.col("p.kind").alias("part"), F.col("p.canon").alias("canon")
    )


def assign(canons: DataFrame, key: str) -> DataFrame:
    """(part, canon, sur): different surrogates for different entities of a kind, none of them
    an entity of the texts.  ``canons`` is a stored table of distinct (part, canon)."""
    open_rows, done, attempt = canons, None, 0
    while True:
        made = open_rows.withColumn("sur", surrogate(key, F.col("part"), F.col("canon"), F.lit(attempt)))
        taken = canons.select("part", F.col("canon").alias("sur"))
        if done is not None:
            taken = taken.union(done.select("part", "sur"))
        fresh = materialize(made.join(taken, ["part", "sur"], "left_anti"), "surrogates")
        first = fresh.groupBy("part", "sur").agg(F.min("canon").alias("canon"))
        won = materialize(first.select("part", "canon", "sur"), "surrogates")
        done = won if done is None else done.union(won)
        open_rows = materialize(open_rows.join(won, ["part", "canon"], "left_anti"), "surrogates")
        if open_rows.isEmpty():
            return done
        attempt += 1


def _rendered(surface: Column, kind: Column, surs: Column) -> Column:
    """The surrogates in the format of the entity as it was written."""
    sur = surs[0]
    at = F.sequence(F.lit(1), F.length(surface))
    char = lambda i: F.substring(surface, i, F.lit(1))
    digit = lambda i: F.length(F.regexp_replace(F.substring(surface, F.lit(1), i), "[^0-9]", ""))
    plain = F.regexp_replace(sur, "[^0-9]", "")
    numbers = F.array_join(F.transform(at, lambda i: F.when(char(i).between("0", "9"), F.substring(plain, digit(i), F.lit(1))).otherwise(char(i))), "")
    cased = F.array_join(F.transform(at, lambda i: F.when(char(i).between("A", "Z"), F.upper(F.substring(sur, i, F.lit(1)))).otherwise(F.substring(sur, i, F.lit(1)))), "")
    upper = F.upper(surface) == surface
    letters = F.when(F.length(sur) == F.length(surface), F.when(upper, F.upper(sur)).otherwise(cased)).when(upper, F.upper(sur)).otherwise(sur)
    words = F.slice(F.split(surface, " "), 2, 2)
    shaped = F.zip_with(words, surs, lambda w, s: F.when((F.upper(w) == w) & (F.length(w) > 1), F.upper(s)).otherwise(F.initcap(s)))
    person = F.concat_ws(" ", F.substring_index(surface, " ", 1), F.array_join(shaped, " "))
    return (
        F.when(kind.isin("email", "secret"), letters).when(kind == "ip", sur).when(kind.startswith("person"), person).otherwise(numbers)
    )


def replace_entities(docs: DataFrame, key: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text, n_entities, kinds) per row: the text with surrogates, the number of entities
    replaced, and that number by kind.

    A null text stays null and has no entity.  Repeated rows and equal texts are rewritten
    alike.  Entities are found in whole texts; columns besides id and text are not read.  Only
    texts with entities are moved, and an entity that occurs everywhere is one row per text."""
    rows = docs.select(docs[id_column].alias("id"), docs[text].alias("body"))
    found = materialize(
        rows.select(F.xxhash64("body").alias("h"), F.explode(F.array_distinct(entities(F.col("body")))).alias("surface")).distinct(), "entities"
    )
    surfaces = found.select("surface").distinct().withColumn("kind", kind_of(F.col("surface")))
    parts = materialize(_parts(surfaces), "entity-parts")
    canons = materialize(parts.select("part", "canon").distinct(), "entity-forms")
    named = parts.join(assign(canons, key), ["part", "canon"])
    chosen = named.groupBy("surface", "kind").agg(F.sort_array(F.collect_list(F.struct("at", "sur"))).alias("s"))
    replaced = materialize(chosen.select("surface", "kind", _rendered(F.col("surface"), F.col("kind"), F.col("s.sur")).alias("sur")), "replacements")
    maps = found.join(replaced, "surface").groupBy("h").agg(
        F.map_from_entries(F.collect_list(F.struct("surface", F.struct("sur", "kind")))).alias("m")
    )
    touched = F.coalesce(F.col("body").rlike(PATTERN), F.lit(False))
    no_kinds = F.lit(None).cast("map<string,int>")
    clean = rows.where(~touched).select("id", "body", F.lit(0).alias("n"), F.coalesce(no_kinds, F.create_map().cast("map<string,int>")).alias("kinds"))
    busy = rows.where(touched).withColumn("h", F.xxhash64("body")).join(maps, "h", "left")
    busy = busy.select("id", "body", "m", entities(F.col("body")).alias("e"), F.split("body", PATTERN, -1).alias("between"))
    new = F.transform("e", lambda x: F.col("m")[x]["sur"])
    glued = F.array_join(F.flatten(F.zip_with("between", F.concat(new, F.array(F.lit(""))), lambda a, b: F.array(a, b))), "")
    kinds = F.transform("e", lambda x: F.col("m")[x]["kind"])
    by_kind = F.map_from_entries(F.transform(F.array_sort(F.array_distinct(kinds)), lambda k: F.struct(k, F.size(F.filter(kinds, lambda x: x == k)))))
    busy = busy.select("id", glued.alias("body"), F.size("e").alias("n"), by_kind.alias("kinds"))
    return clean.union(busy).select(
        F.col("id").alias(id_column), F.col("body").alias(text), F.col("n").cast("long").alias("n_entities"), "kinds"
    )
