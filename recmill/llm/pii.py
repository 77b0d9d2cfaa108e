"""Replace personal data by keyed surrogates of the same kind, in built-in functions only.

Entities are found by patterns and, where they have one, by their check digit. Every
distinct entity of the whole table gets one surrogate, made from a keyed hash of it: the
same entity has the same surrogate wherever it occurs, however it is written, and two
entities never share one. Candidates that meet each other, or equal an entity that really
occurs, are drawn again until none do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recmill.llm.text import let
from recmill.sources.scratch import materialise

ROUNDS = 64
BROADCAST_ENTRIES = 500_000  # most entities of all texts together that every executor gets

# Titles by gender, given names by gender and script, syllables of family names by script.
MALE_TITLES = ["Mr", "Herr", "Monsieur", "Señor", "господин"]
FEMALE_TITLES = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "Señorita", "госпожа"]
OPEN_TITLES = ["Dr", "Prof"]
GIVEN = {
    "male latin": ["Alan", "Bruno", "Carl", "David", "Emil", "Felix", "Henry", "Ivan", "Jonas", "Karl", "Louis", "Martin", "Oscar", "Paul", "Robert", "Simon"],
    "female latin": ["Alice", "Bella", "Clara", "Diana", "Emma", "Flora", "Helen", "Irene", "Julia", "Karin", "Laura", "Maria", "Nora", "Olga", "Paula", "Rosa"],
    "open latin": ["Alex", "Andrea", "Chris", "Dominique", "Eden", "Florence", "Jamie", "Kim", "Lou", "Morgan", "Noel", "Quinn", "Robin", "Sam", "Toni", "Valery"],
    "male cyrillic": ["Андрей", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Лев", "Максим", "Никита", "Олег", "Павел", "Роман", "Степан", "Тарас"],
    "female cyrillic": ["Анна", "Белла", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Кира", "Лидия", "Мария", "Нина", "Ольга", "Полина", "Раиса", "Софья", "Тамара"],
    "male greek": ["Αλέξης", "Γιάννης", "Δημήτρης", "Ηλίας", "Θωμάς", "Κώστας", "Μάρκος", "Νίκος", "Πέτρος", "Σπύρος"],
    "female greek": ["Άννα", "Βάσω", "Δάφνη", "Ελένη", "Ζωή", "Ιωάννα", "Κατερίνα", "Μαρία", "Νίκη", "Σοφία"],
    "open greek": ["Αγάπη", "Χαρά", "Φώτη", "Ρένη", "Λία", "Τόνια", "Μένη", "Πόπη", "Ρούλη", "Χρύση"],
    "open cyrillic": ["Саша", "Женя", "Валя", "Слава", "Шура", "Паша", "Миша", "Никита", "Лёша", "Тоня", "Рома", "Стася", "Ася", "Сеня", "Витя", "Мика"],
}
SYLLABLES = {
    "latin": ["bar", "den", "fal", "gor", "han", "kel", "lin", "mar", "nor", "pel", "ros", "san", "tor", "ver", "wil", "zan"],
    "cyrillic": ["бар", "ден", "вал", "гор", "жан", "кел", "лин", "мар", "нор", "пел", "рос", "сан", "тор", "вер", "мил", "зан"],
    "greek": ["βαρ", "δεν", "φαλ", "γορ", "καν", "κελ", "λιν", "μαρ", "νορ", "πελ", "ροσ", "σαν", "τορ", "βερ", "μιλ", "ζαν"],
}
FAMILY_ENDS = {"latin": ["son", "er", "ini", "ez"], "cyrillic": ["ов", "ин", "ский", "енко"], "greek": ["ίδης", "άκης", "όπουλος", "άτος"]}
DIGITS = "0123456789"
LETTERS = "abcdefghijklmnopqrstuvwxyz"

_NAME = r"\p{Lu}[\p{L}'’-]*\p{L}(?<!['’]s)"
_NAMES = rf"(?:\p{{Lu}}\.[ \xA0]?|\p{{Lu}}[ \xA0])*{_NAME}"  # a name word after any initials
_TITLE = r"(?:%s)\.?" % "|".join(MALE_TITLES + FEMALE_TITLES + OPEN_TITLES)
_LABEL = r"(?i:token|secret|password|passwd|api[_ -]?key)[\"']?\s{0,3}[=:]"
_COUNTRY = r"\+\d{1,3}[ .-]?(?:\(0\)[ .-]?)?"
_PHONES = [  # three long groups; long groups and pairs, eight digits or more in all
    rf"{_COUNTRY}\(?\d{{1,4}}\)?[ .-]?\d{{3,4}}[ .-]?\d{{3,4}}(?!\d)",
    rf"(?=\+(?:[ .()-]{{0,3}}\d){{8}}){_COUNTRY}\(?\d{{1,4}}\)?(?:[ .-]?\d{{3,4}}){{0,2}}(?:[ .-]?\d{{2}}){{1,4}}(?!\d)",
]
_NATIONAL = [  # 555-123-4567 and (555) 123-4567; 06 12 34 56 78; 020 7946 0958; 0171 1234567; 612 34 56 78 and 495 123-45-67
    r"(?:\(\d{3}\)[ .-]?\d{3}[ .-]|\d{3}(?<us>[ .-])\d{3}\k<us>)\d{4}",
    r"\(?0\d{1,4}\)?(?:[ .-]\d{2}){4}",
    r"\(?0\d{1,4}\)?[ .-]\d{3,4}[ .-]\d{3,4}",
    r"\(?0\d{1,4}\)?[ /-]\d{6,8}",
    r"\(?\d{3}\)?[ .-]\d{2,3}(?<es>[ .-])\d{2}\k<es>\d{2}",
]
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\d|\.\d)",
    "phone": "|".join(_PHONES),
    "card": r"(?<![\d.])(?:\d{13,19}|\d{4}(?<four>[ -])\d{4}\k<four>\d{4}\k<four>\d{1,7}|\d{4}(?<six>[ -])\d{6}\k<six>\d{4,5})(?![\d])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "secret": rf"(?<![\w+/-])(?=[\w+/-]{{16}})(?<={_LABEL}\s{{0,3}}[\"']?)[\w+/-]{{16,}}",
    "national": rf"(?:(?<![\w+]|\d[ .-])|(?<=(?<![\w+.-])1[ .-]))(?:{'|'.join(_NATIONAL)})(?!\w|-\w|\.\d)",
    "person": rf"(?<!\p{{L}}){_TITLE}[ \xA0]{_NAMES}(?:[ \xA0]{_NAMES})*",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
HINT = rf"[0-9@]|{_LABEL}|(?<!\p{{L}}){_TITLE}[ \xA0]\p{{Lu}}"  # every mention holds one, or follows one


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _dialled(phone: Column) -> Column:
    """An international number without the (0) that is dialled only at home."""
    return F.regexp_replace(phone, r"\(0\)[ .-]?", "")


def _luhn(digits: Column) -> Column:
    """The check sum, modulo 10, of a string of digits whose last is the check digit."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))

    def weigh(value: Column, place: Column) -> Column:
        double = 2 * value
        return F.when(place % 2 == 0, value).otherwise(F.when(double > 9, double - 9).otherwise(double))

    return F.aggregate(F.transform(values, weigh), F.lit(0), lambda a, b: a + b) % 10


def _is_card(text: Column) -> Column:
    """A payment card: an issuer's range and a right check digit. Other long numbers are none."""
    digits = _digits(text)
    issued = digits.rlike(r"^(?:4\d{12}(?:\d{3}){0,2}|5[1-5]\d{14}|2(?:2[2-9]|[3-6]\d|7[01])\d{13}|3[47]\d{13}|3(?:0[0-5]|[68]\d)\d{11}|6(?:011|5\d\d)\d{12,15}|35\d{14})$")
    return issued & (_luhn(digits) == 0)


def _script(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").when(text.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _titled(titles: list[str]) -> str:
    return r"^(?:%s)(?!\p{L})" % "|".join(titles)


def _name_words(mention: Column) -> Column:
    """The name words and initials of a person, without the title."""
    untitled = F.regexp_replace(mention, rf"^{_TITLE}[ \xA0]", "")
    return F.regexp_extract_all(untitled, F.lit(rf"(?:\p{{Lu}}\.)+|{_NAME}|\p{{Lu}}"), F.lit(0))


def _is_initial(word: Column) -> Column:
    return word.rlike(r"^(?:(?:\p{Lu}\.)+|\p{Lu})$")


def _components(mention: Column) -> Column:
    """Array of (kind, entity) that a mention holds; empty when it is none after all.

    The entity is the mention without its format: an address in lower case, the digits of
    a number. A person's given names and family name, the last word, are entities of their
    own, so that a name and its short form agree; initials are none.
    """
    simple = lambda kind, entity: F.array(F.struct(F.lit(kind).alias("kind"), entity.alias("entity")))
    gender = F.when(mention.rlike(_titled(MALE_TITLES)), "male").when(mention.rlike(_titled(FEMALE_TITLES)), "female")
    both = lambda kind, name: F.concat(kind, F.lit(" "), _script(name)).alias("kind")

    def of(names: Column) -> Column:
        given = F.transform(
            F.slice(names, 1, F.size(names) - 1), lambda n: F.struct(both(F.coalesce(gender, F.lit("open")), n), n.alias("entity"))
        )
        family = F.element_at(names, -1)
        return F.concat(given, F.array(F.struct(both(F.lit("family"), family), family.alias("entity"))))

    person = let(F.filter(_name_words(mention), lambda n: ~_is_initial(n)), of)
    none = F.array().cast("array<struct<kind:string,entity:string>>")
    return (
        F.when(mention.contains("@"), simple("email", F.lower(mention)))
        .when(mention.rlike(rf"^{_TITLE}[ \xA0]\p{{Lu}}"), person)
        .when(mention.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"), simple("ip", mention))
        .when(mention.startswith("+"), simple("phone", F.concat(F.lit("+"), _digits(_dialled(mention)))))
        .when(mention.rlike(r"^\d{3}-\d\d-\d{4}$"), simple("ssn", _digits(mention)))
        .when(mention.rlike(r"^[\d -]+$") & (F.length(_digits(mention)) <= 19) & _is_card(mention), simple("card", _digits(mention)))
        .when(mention.rlike(rf"^(?:{'|'.join(_NATIONAL)})$"), simple("phone", _digits(mention)))
        .when(mention.rlike(r"^[\w+/-]{16,}$") & ~mention.rlike(r"^\d{13,19}$"), simple("secret", mention))
        .otherwise(none)
    )


def _pick(hashed: Column, at: Column, values: list[str]) -> Column:
    """One of ``values`` by the byte at place ``at`` (from 0, repeating) of a hash in hex."""
    byte = F.conv(F.substr(hashed, (2 * at) % 64 + 1, F.lit(2)), 16, 10).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), byte % len(values) + 1)


def _reshape(text: Column, hashed: Column) -> Column:
    """Digits for digits, letters for letters of the same case; all else stays."""

    def one(char: Column, place: Column) -> Column:
        letter = _pick(hashed, place, list(LETTERS))
        return (
            F.when(char.rlike(r"^\d$"), _pick(hashed, place, list(DIGITS)))
            .when(char.rlike(r"^\p{Lu}$"), F.upper(letter))
            .when(char.rlike(r"^\p{L}$"), letter)
            .otherwise(char)
        )

    return F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), one), "")


def _repeat(hashed: Column, n: Column | int, values: list[str]) -> Column:
    last = n - 1 if isinstance(n, Column) else F.lit(n - 1)
    return F.array_join(F.transform(F.sequence(F.lit(0), last), lambda i: _pick(hashed, i, values)), "")


def _candidate(key: str) -> Column:
    """The surrogate of (kind, entity) at the given attempt.

    Kinds of a fixed number of digits draw from at least 10^7 values; addresses, names and
    secrets grow by a character or a syllable every few attempts, so draws cannot run out.
    """
    kind, entity, attempt = F.col("kind"), F.col("entity"), F.col("attempt")
    hashed = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, entity, attempt.cast("string")), 256)

    def made(h: Column) -> Column:
        longer = F.repeat(F.lit("x"), F.floor(attempt / 2).cast("int"))
        at = F.instr(entity, "@")
        local = _reshape(F.concat(F.substr(entity, F.lit(1), at - 1), longer), h)
        host = F.concat(F.lit("mail"), _pick(h, F.lit(30), list(DIGITS)), _pick(h, F.lit(31), list(DIGITS)), F.lit(".example.org"))
        octet = lambda i: F.conv(F.substring(h, 1 + 2 * i, 2), 16, 10)
        wide = (F.conv(F.substring(h, 9, 1), 16, 10).cast("int") + 240).cast("string")
        ip = F.concat_ws(".", F.when(attempt < 4, "10").otherwise(wide), octet(0), octet(1), octet(2))
        n = F.length(entity)
        body = F.concat(F.substring(entity, 1, 2), _repeat(h, n - 3, list(DIGITS)))
        check = ((10 - _luhn(F.concat(body, F.lit("0")))) % 10).cast("string")
        lead = F.when(entity.startswith("+"), 2).otherwise(1)
        phone = F.concat(F.substr(entity, F.lit(1), lead), _repeat(h, n - lead, list(DIGITS)))
        choice = F.when(kind == "email", F.concat(local, F.lit("@"), host)).when(kind == "ip", ip)
        choice = choice.when(kind == "card", F.concat(body, check)).when(kind == "phone", phone)
        choice = choice.when(kind == "ssn", F.concat(F.lit("9"), _repeat(h, 8, list(DIGITS))))
        for script, syllables in SYLLABLES.items():
            more = _repeat(h, 2 + F.floor(attempt / 3).cast("int"), syllables)
            family = F.concat(F.initcap(more), _pick(h, F.lit(31), FAMILY_ENDS[script]))
            choice = choice.when(kind == f"family {script}", family)
        for names, values in GIVEN.items():
            script = names.split()[1]
            more = F.when(attempt < 2, "").otherwise(_repeat(h, F.greatest(F.floor(attempt / 2).cast("int"), F.lit(1)), SYLLABLES[script]))
            second = F.when(more == "", "").otherwise(F.concat(F.lit("-"), F.initcap(more)))
            choice = choice.when(kind == names, F.concat(_pick(h, F.lit(29), values), second))
        return choice.otherwise(_reshape(F.concat(entity, longer), h))

    return let(hashed, made)


def surrogates(entities: DataFrame, key: str, candidate: Callable[[str], Column] = _candidate) -> DataFrame:
    """(kind, entity, surrogate) of distinct (kind, entity): a one-to-one mapping within each kind.

    A surrogate is no entity that occurs, and no other entity's. Those who draw a taken one
    draw again; of several that draw the same, the first entity by text keeps it.
    """
    pending = materialise(entities.select("kind", "entity").distinct().withColumn("attempt", F.lit(0)), "entities")
    real = pending.select(F.col("kind").alias("_kind"), F.col("entity").alias("_taken"))
    done = None
    for _ in range(ROUNDS):
        drawn = pending.withColumn("surrogate", candidate(key))
        taken = real if done is None else real.unionByName(done.select(F.col("kind").alias("_kind"), F.col("surrogate").alias("_taken")))
        free = drawn.join(taken, (F.col("kind") == F.col("_kind")) & (F.col("surrogate") == F.col("_taken")), "left_anti")
        won = materialise(free.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity")), "surrogates")
        done = won.select("kind", "entity", "surrogate") if done is None else done.unionByName(won.select("kind", "entity", "surrogate"))
        lost = pending.join(won.select("kind", "entity"), ["kind", "entity"], "left_anti")
        pending = materialise(lost.select("kind", "entity", (F.col("attempt") + 1).alias("attempt")), "entities")
        if not pending.limit(1).count():
            return done
    raise RuntimeError(f"some entities found no free surrogate in {ROUNDS} draws")


def _fill(mention: Column, digits: Column) -> Column:
    """The mention with its digits replaced, one by one, by ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, char: Column) -> Column:
        is_digit = char.rlike(r"^\d$")
        new = F.when(is_digit, F.substr(digits, acc["at"] + 1, F.lit(1))).otherwise(char)
        return F.struct(F.concat(acc["out"], new).alias("out"), (acc["at"] + is_digit.cast("int")).alias("at"))

    return F.aggregate(F.filter(F.split(mention, ""), lambda c: c != ""), start, step, lambda acc: acc["out"])


def _mapped(mapped: Column, kind: str | Column, name: Column) -> Column:
    return F.element_at(mapped, F.concat(kind if isinstance(kind, Column) else F.lit(kind), F.lit("\x1f"), name))


def _named(mention: Column, mapped: Column) -> Column:
    """A person's name with each word replaced, and each initial by the first letter of the new family name.

    The name may stand without its title. Null unless the family name is one of the text's.
    """
    title = F.regexp_extract(mention, rf"^{_TITLE}[ \xA0]", 0)
    gender = F.when(mention.rlike(_titled(MALE_TITLES)), "male").when(mention.rlike(_titled(FEMALE_TITLES)), "female")
    gender = F.when(title != "", F.coalesce(gender, F.lit("open")))

    def of(words: Column) -> Column:
        last = F.try_element_at(words, F.lit(-1))
        family = _mapped(mapped, F.concat(F.lit("family "), _script(last)), last)

        def one(word: Column, place: Column) -> Column:
            given = [_mapped(mapped, F.concat(kind, F.lit(" "), _script(word)), word) for kind in (gender, F.lit("male"), F.lit("female"), F.lit("open"))]
            return (
                F.when(place == F.size(words) - 1, family)
                .when(_is_initial(word), F.regexp_replace(word, F.lit(r"\p{Lu}"), F.substring(family, 1, 1)))
                .otherwise(F.coalesce(*given, word))
            )

        return F.when(family.isNotNull(), F.concat(title, F.array_join(F.transform(words, one), " ")))

    return let(_name_words(mention), of)


def _known(mapped: Column) -> Column:
    """A pattern of the full and family names, without a title, and the secrets, without a label, of a text's map.

    Null if it has none. Names are letters, hyphens and apostrophes; the longer of two that begin alike comes first.
    """
    of = lambda kinds: F.array_join(
        F.sort_array(
            F.array_distinct(
                F.transform(
                    F.filter(F.map_keys(mapped), lambda k: k.rlike(f"^(?:{kinds})\x1f")),
                    lambda k: F.substring_index(k, "\x1f", -1),
                )
            ),
            asc=False,
        ),
        "|",
    )
    scripts = f"(?:{'|'.join(SYLLABLES)})"
    given, family, secret = of(f"(?:male|female|open) {scripts}"), of(f"family {scripts}"), F.replace(of("secret"), F.lit("+"), F.lit(r"\+"))
    before = F.concat(F.when(given != "", F.concat(given, F.lit("|"))).otherwise(""), F.lit(r"(?:\p{Lu}\.)+"))
    full = F.concat(F.lit(r"(?<!\p{L})(?:(?:"), before, F.lit(r")[ \xA0])*(?:"), family, F.lit(r")(?!\p{L})"))
    bare = F.concat(F.lit(r"(?<![\w+/-])(?:"), secret, F.lit(r")(?![\w+/-])"))
    both = F.concat_ws("|", F.when(family != "", full), F.when(secret != "", bare))
    return F.when(both != "", both)


def _written(mention: Column, mapped: Column) -> Column:
    """A mention's replacement, in the mention's own format; null for what is no mention."""

    def of(parts: Column) -> Column:
        part = F.try_element_at(parts, F.lit(1))
        kind, entity = part["kind"], part["entity"]
        first = _mapped(mapped, kind, entity)
        numbers = kind.isin("phone", "card", "ssn")
        return (
            F.when((F.size(parts) == 0) | kind.rlike("^(?:family|male|female|open) "), _named(mention, mapped))
            .when(numbers, _fill(F.when(mention.startswith("+"), _dialled(mention)).otherwise(mention), _digits(first)))
            .when((kind == "email") & (mention == F.upper(mention)), F.upper(first))
            .otherwise(first)
        )

    return let(_components(mention), of)


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with the personal data of ``text_col`` replaced; all other columns and rows stay.

    Kinds: e-mail and IP addresses, phone numbers with a country code or separators, payment cards, social
    security numbers, labelled secrets, and names after a title. ``count_col`` adds the
    number of mentions replaced. The full and family names of a text's titled persons are
    replaced in it where they stand without a title, too, and its secrets where they stand without a label. Null and empty texts, and texts without a mention, stay as
    they are (count 0). Equal texts get equal results. The same key gives the same
    surrogates as long as the set of entities that collide is the same.
    """
    columns = docs.columns
    at = columns.index(text_col)
    names = [f"_c{i}" for i in range(len(columns))]
    rows = docs.toDF(*names)
    text = F.col(names[at])
    hinted = F.coalesce(text.rlike(HINT), F.lit(False))

    texts = rows.filter(hinted).select(text.alias("text"))
    found = texts.select(F.md5("text").alias("key"), F.explode(F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0))).alias("mention"))
    parts = found.select("key", F.explode(_components(F.col("mention"))).alias("_e")).select("key", "_e.kind", "_e.entity")
    parts = materialise(parts.distinct(), "mentions")
    mapping = materialise(surrogates(parts, key), "mapping")
    named = parts.join(mapping.withColumnsRenamed({"kind": "_kind", "entity": "_entity"}), (F.col("kind") == F.col("_kind")) & (F.col("entity") == F.col("_entity")))
    entry = F.struct(F.concat("kind", F.lit("\x1f"), "entity").alias("k"), F.col("surrogate").alias("v"))
    maps = named.groupBy(F.col("key").alias("_key")).agg(F.map_from_entries(F.collect_set(entry)).alias("_map"))
    maps = materialise(maps.withColumn("_known", _known(F.col("_map"))), "maps")

    small = parts.limit(BROADCAST_ENTRIES + 1).count() <= BROADCAST_ENTRIES
    joined = rows.join(F.broadcast(maps) if small else maps, F.md5(text) == F.col("_key"), "left")
    pattern = F.concat(F.lit(ENTITY), F.coalesce(F.concat(F.lit("|"), F.col("_known")), F.lit("")))
    mentions = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.split(text, pattern, -1)

    def put(found: Column) -> Column:
        written = F.transform(found, lambda m: let(_written(m, F.col("_map")), lambda w: F.struct(F.coalesce(w, m).alias("w"), w.isNotNull().cast("int").alias("n"))))
        ends = F.concat(written, F.array(F.struct(F.lit("").alias("w"), F.lit(0).alias("n"))))
        joined = F.array_join(F.flatten(F.transform(F.arrays_zip(pieces.alias("p"), ends.alias("e")), lambda x: F.array(x["p"], x["e"]["w"]))), "")
        return F.struct(joined.alias("text"), F.aggregate(written, F.lit(0), lambda n, w: n + w["n"]).alias("n"))

    done = joined.withColumn("_done", F.when(F.col("_map").isNotNull(), let(mentions, put)))
    out = [F.coalesce("_done.text", text).alias(c) if i == at else F.col(names[i]).alias(c) for i, c in enumerate(columns)]
    if count_col:
        out.append(F.coalesce("_done.n", F.lit(0)).alias(count_col))
    return done.select(*out)
