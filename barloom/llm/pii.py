"""Replacement of personal data by keyed surrogates of the same kind and shape.

Detected are e-mail addresses, telephone numbers, payment cards (with a valid check digit), IPv4 addresses,
social security numbers, access keys, assigned secrets (under names of any letter case and prefix), and names
after a title. A surrogate is a function of
a secret key and the entity alone, so an entity gets the same surrogate in every document, whatever form it
is written in (letter case, spaces and dashes, country code), and needs no table of replacements: digits
become digits, letters letters of the same case, cards keep a valid check digit, addresses keep the length
of each part, names keep gender (by the title), script and letter case. After a title the last capitalised word is the
surname and those before it are given names; initials between them become other letters, not checked for
distinctness.

Distinctness is checked over the whole corpus: the distinct entities, their number alone, are grouped by
surrogate, and joined with the real entities. Where two share one, or a surrogate is itself a real entity,
all but one of them take another attempt, until none is left. Only those exceptions are joined back to the
documents; texts without a match take no part in that join and are not shuffled. All steps are SQL expressions.

Defined results: a null text stays null; empty texts and texts without entities stay as they are; repeated
rows are replaced alike; a null id is an id; other columns come through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.columns import free_names
from barloom.llm.decontaminate import let
from barloom.session import stage

#: titles before a name, by gender
MALE = ["Mr", "Mister", "Herr", "Monsieur", "Señor", "господин", "Господин"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "госпожа", "Госпожа"]
TITLES = "|".join(MALE + FEMALE)

#: Repeated groups are possessive throughout: Java's matcher recurses for each repeat of any other group, and a long
#: run of them in a text would overflow its stack. After the @ labels of any kind, one of them beginning like a domain.
EMAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.(?![A-Za-z]{2})[A-Za-z0-9-]++)*+(?=\.[A-Za-z]{2})(?:\.[A-Za-z0-9-]++)++"
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
IP = rf"(?:{OCTET}\.){{3}}{OCTET}(?!\.?\d)"
CARD = r"(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])"
SSN = r"\d{3}-\d{2}-\d{4}(?![\w-])"
#: in groups of three and four digits, with + and without, then in groups that may have two
PHONE = (r"(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})[ .-]\d{3,4}[ .-]\d{3,4}|(?:[1-9][ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}"
         r"|(?:[1-9][ .-]?)?\(\d{2,4}\)[ .-]\d{3,4}[ .-]\d{3,4}"
         r"|\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]\d{2,4}){3,5}|0[1-9](?:[ .-]\d\d){4})"
         r"(?![\w-]|\.\d)|\+\d{8,15}(?!\w)")
COUNTRY = r"^\+\d{1,3}(?=[ .(-])"
ACCESS_KEY = r"(?:AKIA|ASIA)[0-9A-Z]{16}(?!\w)"
#: names that a secret is assigned to, in any letter case; what stands in front of them (db_, access_) stays
ASSIGNED = r"(?i:token|password|passwd|secret|api[_-]?key)\s{0,3}[=:]"
SECRET = rf"(?=[tpsaTPSA]){ASSIGNED}\s{{0,3}}\"?[^\s\"]{{8,}}\"?"
WORD = r"\p{Lu}[\p{L}'-]++"
INITIALS = r"(?:(?:(?:\p{Lu}\.)++|\p{Lu}) )*+"
NAME = rf"(?:{TITLES})\.? {INITIALS}{WORD}(?: {INITIALS}{WORD})*+"
#: one entity; starts where no word, number or address is being read, and a secret also inside a longer name
ENTITY = (r"(?<![\p{L}\p{N}_@.%+-])(?:" + "|".join([EMAIL, IP, PHONE, CARD, SSN, ACCESS_KEY, NAME]) + rf")|{SECRET}"
          r"|(?<=\s)\(\d{2,4}\)[ .-]\d{3,4}[ .-]\d{3,4}(?![\w-]|\.\d)")
#: a text without these holds no entity; much cheaper than the whole pattern
HINT = rf"[0-9@]|{ASSIGNED}|(?:{TITLES})\.? \p{{Lu}}"
SECRET_PARTS = rf"^({ASSIGNED}\s*\"?)([^\"]+)(\"?)$"

#: syllables and endings of made-up names, by script
LATIN = ["ba", "de", "fi", "go", "ka", "le", "mi", "no", "pa", "re", "si", "to", "va", "we", "lo", "ma", "ni", "ru", "da", "be"]
CYRILLIC = ["ба", "де", "ви", "го", "ка", "ле", "ми", "но", "па", "ре", "си", "то", "ва", "зе", "ло", "ма", "ни", "ру", "да", "бе"]
ALPHABETS = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"]
ENDINGS = {"first_m": ("n", "н"), "first_f": ("na", "на"), "last_m": ("ler", "нов"), "last_f": ("ler", "нова")}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _by_letter(text: Column, each) -> Column:
    """A string of ``each(letter, i)`` for the letters of ``text``, i from 1. The text is split once: taking letters
    out of it by position would read it from the start for each of them."""
    return F.array_join(F.transform(F.split(text, ""), lambda c, i: each(c, i + 1)), "")


def _at(text: Column, i: Column) -> Column:
    return F.substr(text, i, F.lit(1))


def _draw(seed: Column, i: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(seed, i), F.lit(n)).cast("int")


def _pick(chars: str, seed: Column, i: Column) -> Column:
    return F.substr(F.lit(chars), _draw(seed, i, len(chars)) + 1, F.lit(1))


def _alike(char: Column, seed: Column, i: Column, letters: str = "abcdefghijklmnopqrstuvwxyz") -> Column:
    """Another character of the same class."""
    return (F.when(char.between("0", "9"), _pick("0123456789", seed, i)).when(char.between("a", "z"), _pick(letters, seed, i))
            .when(char.between("A", "Z"), F.upper(_pick(letters, seed, i))).otherwise(char))


def _shaped(text: Column, seed: Column, letters: str = "abcdefghijklmnopqrstuvwxyz") -> Column:
    return _by_letter(text, lambda c, i: _alike(c, seed, i, letters))


def luhn_sum(digits: Column) -> Column:
    """The weighted digit sum that is divisible by ten for a valid card number."""
    n = F.length(digits)
    def weigh(total, i):
        digit = _at(digits, i).cast("int")
        twice = digit * 2
        return total + F.when((n - i) % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice)
    return F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), weigh)


def _kind(match: Column) -> Column:
    """What a match is; null for a number that only looks like a card."""
    digits = F.length(_digits(match))
    card = match.rlike(r"^\d[\d -]*$") & (digits >= 13)
    return (F.when(match.contains("@") & match.rlike(rf"^{EMAIL}$"), "email").when(match.rlike("^(?:AKIA|ASIA)[0-9A-Z]{16}$"), "access_key")
            .when(match.rlike(SECRET_PARTS), "secret").when(match.rlike(rf"^(?:{OCTET}\.){{3}}{OCTET}$"), "ip")
            .when(card, F.when(luhn_sum(_digits(match)) % 10 == 0, "card")).when(match.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
            .when(match.rlike(r"^[+(\d]"), "phone").otherwise("name"))


def _male(match: Column) -> Column:
    return match.rlike(rf"^(?:{'|'.join(MALE)})\b")


def _entity(kind: Column, value: Column) -> Column:
    return F.struct(kind.alias("kind"), value.alias("value"))


def _units(match: Column) -> Column:
    """The words of a name, each with the initials in front of it; the title is left out."""
    return F.regexp_extract_all(F.substr(match, F.instr(match, " ")), F.lit(rf" {INITIALS}{WORD}"), 0)


def _word(unit: Column) -> Column:
    return F.substring_index(unit, " ", -1)


def entities_of(match: Column, kind: Column) -> Column:
    """The entities inside a match, in the form that all spellings share."""
    digits = _digits(match)
    gender = F.when(_male(match), "m").otherwise("f")
    names = let(_units(match), lambda units: F.transform(units, lambda u, i: _entity(
        F.concat(F.when(i == F.size(units) - 1, "last_").otherwise("first_"), gender), F.lower(_word(u)))))
    phone = let(F.regexp_replace(_digits(F.regexp_replace(match, COUNTRY, "")), "^0", ""),
                lambda d: F.when(F.length(d) > 10, F.right(d, F.lit(10))).otherwise(d))
    value = (F.when(kind == "email", F.lower(match)).when(kind.isin("card", "ssn"), digits).when(kind == "phone", phone)
             .when(kind == "secret", F.regexp_extract(match, SECRET_PARTS, 2)).otherwise(match))
    return F.when(kind.isNull(), F.array().cast("array<struct<kind:string,value:string>>")).when(
        kind == "name", names).otherwise(F.array(_entity(kind, value)))


def surrogate(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """The stand-in of an entity at its nth attempt."""
    return let(F.sha2(F.concat_ws("|", F.lit(key), kind, value, attempt.cast("string")), 256),
               lambda seed: _made(key, kind, value, attempt, seed))


def _made(key: str, kind: Column, value: Column, attempt: Column, seed: Column) -> Column:
    digits = _shaped(value, seed)
    kept_zero = F.concat(F.when(_at(value, F.lit(1)) == "0", "0").otherwise(_pick("23456789", seed, F.lit(1))), F.substr(digits, F.lit(2)))
    card = let(F.concat(_at(value, F.lit(1)), F.substr(digits, F.lit(2), F.length(value) - 2)),
               lambda p: F.concat(p, F.pmod(-luhn_sum(F.concat(p, F.lit("0"))), F.lit(10)).cast("string")))
    octets = F.array_join(F.transform(F.split(value, r"\."), lambda o, i: F.when(F.length(o) == 1, 1 + _draw(seed, i, 9)).when(
        F.length(o) == 2, 10 + _draw(seed, i, 90)).otherwise(100 + _draw(seed, i, 155)).cast("string")), ".")
    domain = let(F.regexp_extract(value, r"@(.*)\.[^.]*$", 1), lambda d: let(
        F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), d), 256), lambda own: _shaped(d, own)))
    email = F.concat(let(F.substring_index(value, "@", 1), lambda name: _shaped(name, seed)), F.lit("@"), domain,
                     F.lit("."), F.substring_index(value, ".", -1))
    secret = F.when(value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), _shaped(value, seed, "abcdef")).otherwise(_shaped(value, seed))
    russian = value.rlike(r"\p{IsCyrillic}")
    syllables = F.when(russian, F.array(*map(F.lit, CYRILLIC))).otherwise(F.array(*map(F.lit, LATIN)))
    middle = let(syllables, lambda all_: F.array_join(F.transform(
        F.sequence(F.lit(1), 3 + attempt), lambda i: F.get(all_, _draw(seed, i, len(LATIN)))), ""))
    ending = F.lit("")
    for name, (latin, cyrillic) in ENDINGS.items():
        ending = F.when(kind == name, F.when(russian, cyrillic).otherwise(latin)).otherwise(ending)
    access_key = F.concat(F.left(value, F.lit(4)), let(F.substr(value, F.lit(5)), lambda rest: _shaped(rest, seed)))
    return (F.when(kind == "email", email).when(kind == "ip", octets).when(kind == "card", card).when(kind.isin("phone", "ssn"), kept_zero)
            .when(kind == "access_key", access_key).when(kind == "secret", secret).otherwise(F.concat(middle, ending)))


def _written_like(surface: Column, made: Column) -> Column:
    """The surrogate of a name in the letter case of the surface."""
    return F.when(F.upper(surface) == surface, F.upper(made)).otherwise(F.initcap(made))


def _initials(key: str, part: Column, of: Column) -> Column:
    """Other initials, the same ones wherever ``of`` has these."""
    def other(letter: Column, seed: Column, i: Column, letters: str) -> Column:
        return F.substr(F.lit(letters), F.pmod(F.instr(F.lit(letters), letter) + _draw(seed, i, len(letters) - 1), F.lit(len(letters))) + 1, F.lit(1))

    latin, cyrillic = ALPHABETS
    return let(F.sha2(F.concat_ws("|", F.lit(key), F.lit("initial"), of, part), 256), lambda seed: _by_letter(part, lambda c, i: F.when(
        c.isin(".", ""), c).when(c.rlike(r"\p{IsCyrillic}"), other(c, seed, i, cyrillic)).otherwise(other(c, seed, i, latin))))


def _fill_digits(match: Column, made: Column) -> Column:
    """The match with its last digits replaced; what is in front, such as a country code, stays. Numbers are short."""
    def each(char, i):
        after = F.length(_digits(F.substr(match, i + 1)))
        return F.when(char.between("0", "9") & (after < F.length(made)), _at(made, F.length(made) - after)).otherwise(char)
    return _by_letter(match, each)


def render(key: str, match: Column, kind: Column, found: Column, attempts: Column | None) -> Column:
    """What stands in a text instead of a match, given its kind and entities. ``attempts`` maps
    ``kind:value`` to attempts that are not 0."""
    def made(entity: Column) -> Column:
        attempt = F.lit(0)
        if attempts is not None:
            attempt = F.coalesce(F.try_element_at(attempts, F.concat_ws(":", entity.kind, entity.value)), attempt)
        return surrogate(key, entity.kind, entity.value, attempt)

    def named(unit: Column, stand_in: Column) -> Column:
        word = _word(unit)
        front = F.split(F.left(unit, F.length(unit) - F.length(word)), " ")
        initials = F.transform(front, lambda p: F.when(p == "", p).otherwise(_initials(key, p, F.element_at(found, -1).value)))
        return F.concat(F.array_join(initials, " "), _written_like(word, stand_in))

    def written(stand_ins: Column) -> Column:
        only = F.get(stand_ins, F.lit(0))
        email = F.array_join(F.zip_with(F.split(match, ""), F.split(only, ""), lambda c, o: F.when(c.between("A", "Z"), F.upper(o)).otherwise(o)), "")
        secret = F.concat(F.regexp_extract(match, SECRET_PARTS, 1), only, F.regexp_extract(match, SECRET_PARTS, 3))
        name = F.concat(F.substring_index(match, " ", 1), F.array_join(F.zip_with(_units(match), stand_ins, named), ""))
        return (F.when(kind == "email", email).when(kind.isin("phone", "card", "ssn"), _fill_digits(match, only))
                .when(kind == "secret", secret).when(kind == "name", name).otherwise(only))

    return F.when(F.size(found) == 0, match).otherwise(let(F.transform(found, made), written))


def matches(text: Column) -> Column:
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ENTITY), 0)).otherwise(F.array().cast("array<string>"))


def assign(entities: DataFrame, key: str, rounds: int = 50) -> DataFrame:
    """``kind, value, attempt`` of distinct entities such that no two of a kind share a surrogate and none is a real entity."""
    state = stage(entities.withColumn("attempt", F.lit(0)), "entities")
    for _ in range(rounds):
        made = stage(state.withColumn("made", surrogate(key, F.col("kind"), F.col("value"), F.col("attempt"))), "surrogates")
        keepers = made.groupBy("kind", "made").agg(F.min(F.struct("attempt", "value")).alias("keeper"), F.count("*").alias("n"))
        twice = made.join(keepers.where("n > 1"), ["kind", "made"]).where(F.col("value") != F.col("keeper.value")).select("kind", "value")
        real = made.select("kind", F.col("value").alias("made"))
        losers = stage(twice.unionByName(made.join(real, ["kind", "made"], "left_semi").select("kind", "value")).distinct(), "collisions")
        if losers.isEmpty():
            return state
        again = losers.withColumn("again", F.lit(1))
        state = stage(made.join(again, ["kind", "value"], "left").select("kind", "value", (F.col("attempt") + F.coalesce("again", F.lit(0))).alias("attempt")), "entities")
    raise RuntimeError(f"surrogates still collide after {rounds} rounds")


def replace(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with personal data replaced in ``text_col``; ``count_col`` names a column for the number of replacements."""
    text = F.col(text_col)
    of_id, of_key, tries, kinds, matched = free_names(docs, "id", "key", "attempts", "kinds", "matches")
    hits = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), F.explode(matches(text)).alias("match"))
    typed = stage(hits.distinct().withColumn("kind", _kind(F.col("match"))), "matches")
    inside = F.inline(entities_of(F.col("match"), F.col("kind")))
    exceptions = assign(typed.select("match", "kind").distinct().select(inside).distinct(), key).where("attempt > 0")

    def replaced(found: DataFrame, attempts: Column | None) -> DataFrame:
        found = found.withColumn(kinds, F.transform(matches(text), lambda m: F.struct(m.alias("match"), _kind(m).alias("kind"))))
        found = found.withColumn(matched, F.transform(kinds, lambda t: F.struct(
            t.match.alias("match"), t.kind.alias("kind"), entities_of(t.match, t.kind).alias("found"))))
        stand_ins = F.transform(matched, lambda t: render(key, t.match, t.kind, t.found, attempts))
        joined = let(F.split(text, ENTITY, -1), lambda parts: F.concat(F.get(parts, F.lit(0)), F.array_join(F.zip_with(
            stand_ins, F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda s, p: F.concat(s, p)), "")))
        new = F.when(F.size(matched) > 0, joined).otherwise(text)
        count = F.size(F.filter(matched, lambda t: F.size(t.found) > 0))
        columns = [F.col(f"`{c}`") if c != text_col else new.alias(c) for c in docs.columns]
        return found.select(*columns, *([count.alias(count_col)] if count_col else []))

    if exceptions.isEmpty():
        return replaced(docs, None)
    of_doc = typed.select("id", "text_key", inside).join(exceptions, ["kind", "value"])
    of_doc = of_doc.groupBy(F.col("id").alias(of_id), F.col("text_key").alias(of_key)).agg(F.map_from_entries(F.collect_set(
        F.struct(F.concat_ws(":", "kind", "value"), "attempt"))).alias(tries))
    some = F.size(matches(text)) > 0  # the texts that travel to the join; all others stay where they are
    found = docs.where(some).join(of_doc, F.col(id_col).eqNullSafe(F.col(of_id)) & (F.xxhash64(text) == F.col(of_key)), "left")
    rest = docs.where(~some)
    return replaced(found, F.col(tries)).unionByName(rest.withColumn(count_col, F.lit(0)) if count_col else rest)
