"""Surrogates for personal data and secrets in whole texts.

Entities are found by patterns: e-mail addresses, IPv4 and IPv6 addresses, telephone numbers, card-like
numbers, social security numbers, IBANs, secrets (quoted after a word such as ``token``, and bare
hexadecimal keys) and names after a title.  Every distinct entity gets a surrogate derived from a
key with SHA-256: the same kind of thing in the same format (digits for digits, letters of the
same case and script, octets in range, a valid Luhn digit where there was one, names of the
title's gender and script).  An entity written in several ways (case, separators) gets one
surrogate, written in each of these ways.

Coreference: the people that a text names with a title are found in the rest of it without one, by full name,
surname or first name.  Names get surrogates word by word, first names and surnames apart, so
"Dr. Anna Schmidt", "Frau Schmidt" and "Schmidt" go on being one person, here and in all other texts.

Collision checks: surrogates are proposed for all entities of the corpus at once; one that equals
an entity that occurs, or the surrogate of another entity, is refused and proposed again with the
next attempt.  So distinct entities stay distinct and no surrogate is somebody's real data here.  Later attempts make
surrogates longer than their entities, so a format with few values, such as ``x@y.de``, does not run out.

Texts are shuffled once; occurrences of an entity that is in a
third of all texts are joined by Spark's skew join, the entity table holding each once.  Only
DataFrame functions are used.

Defined results: null texts stay null, empty and clean texts unchanged with no entities; equal rows
get equal results; an empty table gives no rows; all other columns are kept as they are; columns
named ``n_entities`` and ``entity_types`` are replaced.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.decontamination import _as_column
from sessionloom.workspace import materialize

#: Stands for the deployment's own secret.
DEFAULT_KEY = "replace-by-a-secret-of-your-own"

# First names by script and gender, public lists of common names.
NAMES = {
    ("latin", "f"): "Anna Maria Julia Laura Sophie Emma Clara Nina Elena Martha Alice Irene Paula Rosa Sara Eva".split(),
    ("latin", "m"): "Martin Paul Simon Thomas David Felix Oscar Hugo Victor Leon Daniel Robert Adrian Bruno Carlos Emil".split(),
    ("cyrillic", "f"): "Анна Мария Ольга Елена Ирина Вера Нина Софья".split(),
    ("cyrillic", "m"): "Иван Пётр Павел Андрей Олег Борис Антон Максим".split(),
    ("greek", "f"): "Μαρία Ελένη Άννα Σοφία Ειρήνη Δήμητρα".split(),
    ("greek", "m"): "Γιώργος Νίκος Πέτρος Παύλος Ανδρέας Κώστας".split(),
    # Surnames.
    ("latin", "s"): "Keller Moreau Lindner Novak Castillo Fontaine Harper Weston Lambert Romero Berger Holm Duarte Fischer Marchand Bennett".split(),
    ("cyrillic", "s"): "Соколов Лебедев Козлов Новиков Морозов Волков Зайцев Орлов".split(),
    ("greek", "s"): "Παππάς Νικολάου Γεωργίου Δημητρίου Ιωάννου Βασιλείου".split(),
}
# Titles before a name, by gender; "x" is either.
TITLES = {
    "f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Госпожа", "Κυρία"],
    "m": ["Mr", "Herr", "Señor", "Sr", "Monsieur", "Господин", "Κύριος"],
    "x": ["Dr", "Prof"],
}
# Consonants and vowels that names are lengthened with.
SYLLABLES = {"latin": ("bdfgklmnprstv", "aeiou"), "cyrillic": ("бвгдклмнпрст", "аеиоу"), "greek": ("βγδκλμνπρστ", "αεηιο")}
# Letters of each script in their order.
ALPHABETS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLE = "|".join(title for titles in TITLES.values() for title in titles)
#: O'Neil, McDonald, Garcia-Lopez; an apostrophe before a small letter ends the name.
_NAME = r"\p{Lu}\p{Ll}*(?:['’-]\p{Lu}\p{Ll}+|\p{Lu}?\p{Ll}+)+"
_FULL_NAME = rf"{_NAME}(?: {_NAME}){{0,2}}"
_HEX = r"[0-9A-Fa-f]{1,4}"
PATTERNS = {
    "email": r"[\p{L}\d._%+-]+@[\p{L}\d-]+(?:\.[\p{L}\d-]+)*\.\p{L}{2,}",
    "secret": r"(?<=(?i:token|key|secret|passwd|password)\s?[=:]\s?\")[^\"\s]{8,}(?=\")|(?<![\p{L}\d])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![\p{L}\d])",
    "iban": r"(?<![\p{L}\d])[A-Z]{2}\d{2}(?: ?[A-Z\d]{4}){2,7}(?: ?[A-Z\d]{1,3})?(?![\p{L}\d])",
    "card": r"(?<![\p{L}\d.])(?:\d{13,19}|\d{4}(?<gap>[ -])\d{4}\k<gap>\d{4}\k<gap>\d{1,7})(?![\p{L}\d])",
    "phone": r"(?<![\p{L}\d])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\) ?\d{3,4}[ .-]\d{4}(?!\d)|(?<![\p{L}\d])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?![\d])|(?<![\p{L}\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])|(?<![\p{L}\d.,:-])0\d{2,4}[ /-]\d{5,8}(?![\p{L}\d-])|(?<![\p{L}\d.,:-])1[3-9]\d{9}(?![\p{L}\d-]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "ip": rf"(?<![\p{{L}}\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d|\p{{L}})",
    "ip6": rf"(?<![\p{{L}}\d:])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}})(?![\p{{L}}\d:])",
    "name": rf"(?<=(?<!\p{{L}})(?:{_TITLE})\.? ){_FULL_NAME}",
}
_ANY = "|".join(f"(?:{pattern})" for pattern in PATTERNS.values())
_TITLED = rf"(?<!\p{{L}})(?:{_TITLE})\.? {_FULL_NAME}"
_FIRST_NAMES = sorted({name for (_, sex), pool in NAMES.items() if sex != "s" for name in pool})
#: From this attempt on surrogates grow longer than their entity, so no format runs out of values.
WIDER = 4


def _kind(surface: Column) -> Column:
    """Type of a found text; patterns that look around are told apart by what is left."""
    return (
        F.when(surface.contains("@"), "email")
        .when(surface.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"), "ip")
        .when(surface.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(surface.rlike(r"^[A-Z]{2}\d{2}[A-Z\d ]+$") & ~surface.rlike(r"^[0-9A-F]{32,64}$"), "iban")
        .when(surface.rlike(r"^(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7})$"), "card")
        .when(surface.rlike(r"^[+(\d][\d +().-]+$"), "phone")
        .when(surface.rlike(rf"^(?:{PATTERNS['ip6']})$"), "ip6")
        .when(surface.rlike(rf"^{_FULL_NAME}$"), "name")
        .otherwise("secret")
    )


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _identity(kind: Column, surface: Column) -> Column:
    """What all ways of writing one entity have in common."""
    country = F.regexp_extract(surface, r"^\+\d{1,3}(?=[ .(-])", 0)
    return (
        F.when(kind == "email", F.lower(surface))
        .when(kind == "phone", F.concat(_digits(country), F.lit("|"), _digits(F.expr("substring(surface, length(regexp_extract(surface, '^\\\\+[0-9]{1,3}(?=[ .(-])', 0)) + 1)"))))
        .when(kind.isin("card", "ssn"), _digits(surface))
        .when(kind == "iban", F.regexp_replace(surface, " ", ""))
        .when(kind == "ip6", F.lower(surface))
        .otherwise(surface)
    )


def _pick(i: Column, count: int) -> Column:
    """A number below ``count`` for the place ``i``, from the keyed digest."""
    return F.pmod(F.xxhash64("digest", i), F.lit(count)).cast("int")


def _letter(alphabet: str, i: Column) -> Column:
    return F.substring(F.lit(alphabet), _pick(i, len(alphabet)) + 1, F.lit(1))


def _replaced(c: Column, i: Column, hexadecimal: bool) -> Column:
    """Another character of the same class at place ``i``."""
    low = F.lower(c)
    new = F.when(c.rlike(r"\d"), F.substring(F.lit("0123456789abcdef" if hexadecimal else "0123456789"), _pick(i, 16 if hexadecimal else 10) + 1, F.lit(1)))
    if hexadecimal:
        new = new.when(low.rlike("[a-f]"), F.substring(F.lit("0123456789abcdef"), _pick(i, 16) + 1, F.lit(1)))
    for alphabet, script in ((ALPHABETS["cyrillic"], r"\p{IsCyrillic}"), (ALPHABETS["greek"], r"\p{IsGreek}"), (ALPHABETS["latin"], r"\p{L}")):
        new = new.when(low.rlike(script), _letter(alphabet, i))
    new = new.otherwise(c)
    return F.when(c.rlike(r"\p{Lu}"), F.upper(new)).otherwise(new)


def _characters(text: Column, hexadecimal: bool = False, keep: Column | None = None) -> Column:
    """The text with every letter and digit replaced; the first ``keep`` characters stay."""
    keep = F.lit(0) if keep is None else keep

    def at(c: Column, i: Column) -> Column:
        return F.when(i < keep, c).otherwise(_replaced(c, i, hexadecimal))

    return F.array_join(F.transform(F.split(text, ""), at), "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn's sum of a number whose last digit is its check digit."""
    reverse = F.split(F.reverse(digits), "")
    values = F.transform(reverse, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.floor(d.cast("int") * 2 / 10).cast("int") + d.cast("int") * 2 % 10))
    return F.aggregate(values, F.lit(0), lambda a, b: a + b)


def _proposal() -> Column:
    """Surrogate of the row's identity from ``digest``, ``kind``, ``gender`` and ``attempt``."""
    entity = F.col("identity")
    def octet(part: Column, i: Column) -> Column:
        same = F.when(F.length(part) == 1, _pick(i, 10)).when(F.length(part) == 2, 10 + _pick(i, 90)).otherwise(100 + _pick(i, 156))
        return F.when(F.col("attempt") < WIDER, same).otherwise(_pick(i, 256)).cast("string")

    octets = F.transform(F.split(entity, r"\."), octet)
    grown = F.greatest(F.col("attempt") - (WIDER - 1), F.lit(0))

    def longer(more: Column) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(1), grown), lambda i: F.when(grown > 0, more_at(more, i)).otherwise("")), "")

    def more_at(characters: Column, i: Column) -> Column:
        return F.substring(characters, _pick(-100 - i, 10) + 1, F.lit(1))

    digits, letters = longer(F.lit("0123456789")), longer(F.lit("aeilmnorst"))
    top = F.length(F.regexp_extract(entity, r"\.\p{L}+$", 0))
    stem = F.substring(entity, F.lit(1), F.length(entity) - top)
    email = F.concat(_characters(stem), letters, F.regexp_extract(entity, r"\.\p{L}+$", 0))
    card = _characters(entity)
    body = F.substring(card, F.lit(1), F.length(card) - 1)
    check = F.pmod(-_luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)).cast("string")
    card = F.when(F.pmod(_luhn_sum(entity), F.lit(10)) == 0, F.concat(body, check)).otherwise(card)
    script = F.when(entity.rlike(r"\p{IsCyrillic}"), "cyrillic").when(entity.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    gender = F.when(F.col("gender") == "x", F.when(_pick(F.lit(-1), 2) == 0, "f").otherwise("m")).otherwise(F.col("gender"))
    name = F.lit(None).cast("string")
    for (kind, sex), pool in NAMES.items():
        choice = F.element_at(F.array(*map(F.lit, pool)), _pick(F.lit(-2), len(pool)) + 1)
        # The pool runs out; later attempts lengthen the name in its own script, by a syllable each.
        syllable = [
            F.when(F.col("attempt") > k, F.concat(*[_letter(part, F.lit(-10 - 2 * k - j)) for j, part in enumerate(SYLLABLES[kind])])).otherwise("")
            for k in range(8)
        ]
        # Russian surnames agree with the person.
        ending = F.when(entity.endswith("а"), "а").otherwise("") if (kind, sex) == ("cyrillic", "s") else F.lit("")
        name = F.when((script == kind) & (gender == sex), F.concat(choice, *syllable, ending)).otherwise(name)
    hexadecimal = entity.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")
    return (
        F.when(F.col("kind") == "ip", F.array_join(octets, "."))
        .when(F.col("kind") == "email", email)
        .when(F.col("kind") == "card", F.concat(card, digits))
        .when(F.col("kind") == "name", name)
        .when(F.col("kind") == "phone", F.concat(_characters(entity, keep=F.locate("|", entity)), digits))
        .when(F.col("kind") == "iban", F.concat(_characters(entity, keep=F.lit(2)), digits))
        .when((F.col("kind") == "ip6") | (F.col("kind") == "secret") & hexadecimal, F.concat(_characters(entity, hexadecimal=True), digits))
        .otherwise(F.concat(_characters(entity), digits))
    )


def assign_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, identity, surrogate) for distinct (kind, identity, gender); see the module's collision checks."""
    entities = materialize(entities, "entities")
    real = entities.select("kind", F.col("identity").alias("surrogate"))
    left, accepted = entities, None
    for attempt in count():
        proposed = left.withColumn("attempt", F.lit(attempt)).withColumn(
            "digest", F.sha2(F.concat_ws("\u001f", F.lit(key), "kind", "identity", F.col("attempt").cast("string")), 256)
        )
        proposed = materialize(proposed.withColumn("surrogate", _proposal()), "proposed")
        free = proposed.join(real, ["kind", "surrogate"], "left_anti")
        if accepted is not None:
            free = free.join(accepted.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        # Among equal proposals the smallest digest keeps it.
        won = free.groupBy("kind", "surrogate").agg(F.min(F.struct("digest", "identity")).alias("w"))
        won = won.select("kind", F.col("w.identity").alias("identity"), "surrogate")
        accepted = materialize(won if accepted is None else accepted.union(won), "surrogates")
        left = materialize(left.join(accepted, ["kind", "identity"], "left_anti"), "left")
        if left.isEmpty():
            return accepted


def _written() -> Column:
    """The surrogate in the way ``surface`` writes its entity."""
    surface, surrogate = F.col("surface"), F.col("surrogate")
    digits = _digits(surrogate)
    in_place = F.array_join(
        F.transform(
            F.split(surface, ""),
            lambda c, i: F.when(
                c.rlike(r"\d"),
                F.substring(digits, F.length(_digits(F.substring(surface, F.lit(1), i + 1))), F.lit(1)),
            ).otherwise(c),
        ),
        "",
    )
    blocks = F.array_join(
        F.transform(
            F.split(surface, ""),
            lambda c, i: F.when(c == " ", c).otherwise(
                F.substring(surrogate, F.length(F.regexp_replace(F.substring(surface, F.lit(1), i + 1), " ", "")), F.lit(1))
            ),
        ),
        "",
    )
    return (
        F.when(F.col("kind").isin("card", "ssn", "phone"), F.concat(in_place, F.substring(digits, F.length(_digits(surface)) + 1, F.length(digits))))
        .when(F.col("kind") == "iban", F.concat(blocks, F.substring(surrogate, F.length(F.regexp_replace(surface, " ", "")) + 1, F.length(surrogate))))
        .when((F.col("kind") == "ip6") & (surface == F.upper(surface)), F.upper(surrogate))
        .when((F.col("kind") == "email") & (surface == F.upper(surface)), F.upper(surrogate))
        .otherwise(surrogate)
    )


def _others_named() -> Column:
    """Pattern of all ways to write the people that the row's titles name, without a title; null where there are none.

    A person is written by the full name, by one of its words, or by the surname after a common first name.
    """
    people = F.transform(F.col("titled"), lambda t: F.regexp_replace(t, rf"^(?:{_TITLE})\.? ", ""))
    single = F.flatten(F.transform(people, lambda p: F.split(p, " ")))
    last = F.transform(people, lambda p: F.concat(F.lit(f"(?:(?:{'|'.join(_FIRST_NAMES)}) )?"), F.element_at(F.split(p, " "), -1)))
    ways = F.array_distinct(F.concat(people, last, single))
    return F.when(F.size(people) > 0, F.concat(F.lit(r"(?<!\p{L})(?:"), F.array_join(ways, "|"), F.lit(r")(?!\p{L})")))


def _name_words(surfaces: DataFrame, titled: DataFrame) -> DataFrame:
    """(kind, identity, gender) of every word of the names: ``s`` is a surname, the others are first names.

    A word is a first name where it stands before another word of a name or is a common first name; the
    title tells the gender, or else the common name.
    """
    parts = surfaces.where("kind = 'name'").select("surface", F.posexplode(F.split("surface", " ")).alias("i", "word"), F.size(F.split("surface", " ")).alias("n"))
    common = {name: sex for (_, sex), pool in NAMES.items() if sex != "s" for name in pool}
    pools = F.create_map(*[F.lit(x) for pair in common.items() for x in pair])
    words = parts.groupBy(F.col("word").alias("identity")).agg(F.max(F.col("i") < F.col("n") - 1).alias("before"))
    sex = F.when(F.col("title").isin(TITLES["f"]), "f").when(F.col("title").isin(TITLES["m"]), "m")
    genders = titled.select(F.regexp_extract("t", rf"^(?:{_TITLE})\.? (\S+)", 1).alias("identity"), F.regexp_extract("t", r"^(\p{L}+)", 1).alias("title"))
    genders = genders.groupBy("identity").agg(F.min(sex).alias("told"))
    known = F.element_at(pools, F.col("identity"))
    first = F.col("before") | known.isNotNull()
    return words.join(genders, "identity", "left").select(
        F.lit("name").alias("kind"), "identity", F.when(first, F.coalesce("told", known, F.lit("x"))).otherwise("s").alias("gender")
    )


def replace_entities(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """All columns with entities of ``text`` replaced, and n_entities, entity_types (sorted).

    Rows are numbered as they are read, twice, so give a table, not a frame whose partitions can come out differently.
    """
    names = [name for name in docs.columns if name not in ("n_entities", "entity_types")]
    # Columns under names of our own, so that no name of the input can clash with what is added.
    columns = {f"__in{k}": name for k, name in enumerate(names)}
    rows = docs.select(*[F.col(f"`{name}`").alias(own) for own, name in columns.items()])
    rows = rows.withColumn("__row", F.monotonically_increasing_id())
    body = F.col(next(own for own, name in columns.items() if name == text))
    # Every entity has one of these, so only texts with one are searched: @, a digit, a quote, a
    # hexadecimal key without digits, or a title.
    hinted = reduce(Column.__or__, [body.contains(f"{t} ") | body.contains(f"{t}. ") for t in _TITLE.split("|")])
    hinted = body.rlike('[@\\d"]|[a-f]{32}|[A-F]{32}') | hinted
    titles = rows.where(hinted).select("__row", body.alias("body"), F.regexp_extract_all(body, F.lit(_TITLED), F.lit(0)).alias("titled"))
    pattern = F.concat(F.lit(f"({_ANY}"), F.coalesce(F.concat(F.lit("|"), _others_named()), F.lit("")), F.lit(")"))
    # The pattern is a constant for texts without titles and is compiled once there.
    found = titles.select(
        "__row", "titled", F.when(F.size("titled") > 0, pattern).alias("pattern"),
        F.when(F.size("titled") > 0, F.regexp_extract_all("body", pattern, F.lit(0)))
        .otherwise(F.regexp_extract_all("body", F.lit(f"({_ANY})"), F.lit(0))).alias("surfaces"),
    )
    found = materialize(found.where(F.size("surfaces") > 0), "found")

    occurrences = found.select("__row", F.posexplode("surfaces").alias("place", "surface"))
    surfaces = occurrences.select("surface").distinct().withColumn("kind", _kind(F.col("surface")))
    surfaces = materialize(surfaces.withColumn("identity", _identity(F.col("kind"), F.col("surface"))), "surfaces")
    others = surfaces.where("kind <> 'name'")
    people = _name_words(surfaces, found.select(F.explode("titled").alias("t")))
    chosen = assign_surrogates(others.select("kind", "identity", F.lit("x").alias("gender")).distinct().union(people), key)
    spelled = others.join(chosen, ["kind", "identity"]).select("surface", "kind", _written().alias("written"))
    words = surfaces.where("kind = 'name'").select("surface", "kind", F.posexplode(F.split("surface", " ")).alias("i", "identity"))
    by_word = words.join(chosen, ["kind", "identity"]).groupBy("surface", "kind").agg(F.sort_array(F.collect_list(F.struct("i", "surrogate"))).alias("w"))
    spelled = materialize(spelled.union(by_word.select("surface", "kind", F.array_join(F.col("w.surrogate"), " "))), "spelled")
    filled = (
        occurrences.join(spelled, "surface")
        .groupBy("__row")
        .agg(F.sort_array(F.collect_list(F.struct("place", "written", "kind"))).alias("__new"))
        .join(found.select("__row", F.col("pattern").alias("__pattern")), "__row")
    )
    joined = rows.join(filled, "__row", "left")
    gaps = F.when(F.col("__new").isNull(), F.lit(None)).when(F.col("__pattern").isNull(), F.split(body, f"({_ANY})", -1))
    joined = _as_column(joined, gaps.otherwise(F.split(body, F.col("__pattern"), -1)), "__gaps")
    rebuilt = F.concat(
        F.array_join(F.transform("__new", lambda e, i: F.concat(F.get("__gaps", i), e["written"])), ""),
        F.element_at("__gaps", -1),
    )
    return joined.select(
        *[F.coalesce(rebuilt, body).alias(name) if name == text else F.col(own).alias(name) for own, name in columns.items()],
        F.coalesce(F.size("__new").cast("long"), F.lit(0).cast("long")).alias("n_entities"),
        F.coalesce(F.array_sort(F.array_distinct(F.col("__new.kind"))), F.array().cast("array<string>")).alias("entity_types"),
    )
