"""Surrogates for personal data and secrets.

Entities are found by pattern: e-mail addresses, telephone numbers (international ones after
a +, national ones with separators or brackets), IPv4 and IPv6 addresses, payment card
numbers, account numbers (IBAN), social security numbers in groups of 3, 2 and 4 digits, secret
tokens, and names after a title. Not found are national numbers without any
separator, which look like any other number, and short IPv6 addresses without a digit
(``face::add``), which look like code. Each is replaced by a surrogate of
its own type that depends on a key and on the entity alone, so an entity has one surrogate
wherever it occurs (coreference) and without the key nobody can go back.

* Digits of telephone and card numbers and the bytes of addresses go through a keyed
  permutation (four Feistel rounds), which never maps two entities to one; separators,
  country code or, without one, the first digit, and the validity of a card's check digit
  stay. A number with and one without its country code are two entities. IPv6 addresses are
  written out in full.
* Tokens and the name part of e-mail addresses keep length, case, script and the places of
  digits and marks; the domain is a reserved example domain with a keyed label.
* Names keep their title; the replacement has the title's gender, the name's script (Latin,
  Cyrillic, Greek) and its capitals, with given and family name or family name only, as before.
  Given and family name have each their own surrogate, so that a person is the same with and
  without the given name. A title that tells no gender (Dr) gives a given name of no gender,
  and names without a title are not found.
* Account numbers keep country and length and have valid check digits.

Surrogates that are not permutations could collide, so all distinct entities of the corpus
are checked: an entity whose surrogate another entity has too (or that is an entity itself)
gets another attempt, in all its spellings, until none is left. Each attempt widens the
space of names (a syllable more) and of tokens with a prefix (four letters or digits more),
so that this ends however many there are. (A second attempt adds to the given name, if there is one,
so that the family's name stays.) Up to ``max_late`` entities with a later attempt
are known to every task; more are joined by the texts that hold them, with the same result.

DataFrame functions only. Defined results: null texts stay null with no entities; texts
without an entity stay as they are; equal rows get equal results; other columns are kept,
but for ``entity_count``, which is new; a text of any length is searched whole; an empty table stays empty.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import free_name, stage

#: Titles by gender, and names by gender and script.
TITLES = {"male": ("Mr", "Herr", "Monsieur", "Señor", "Signor", "Господин"), "female": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Signora", "Госпожа"), "any": ("Dr", "Prof")}
GIVEN = {
    ("male", "latin"): "Adam Bruno Carl David Erik Felix Georg Hugo Ivan Jonas Karl Leon Martin Nils Oscar Paul".split(),
    ("female", "latin"): "Anna Berta Clara Diana Elena Flora Gina Helena Irma Julia Karla Laura Maria Nina Olga Paula".split(),
    ("any", "latin"): "Alex Billie Chris Dana Eden Frankie Gray Harper Indigo Jamie Kim Lee Morgan Nico Quinn Robin".split(),
    ("male", "cyrillic"): "Андрей Борис Виктор Глеб Денис Егор Захар Игорь Кирилл Лев Максим Никита Олег Павел Роман Семён".split(),
    ("female", "cyrillic"): "Анна Вера Галина Дарья Елена Жанна Зоя Инна Кира Лидия Мария Нина Ольга Полина Раиса София".split(),
    ("any", "cyrillic"): "Саша Женя Валя Слава Шура Паша Тоня Ника".split(),
    ("male", "greek"): "Αλέξης Γιώργος Δημήτρης Κώστας Λουκάς Μάνος Νίκος Πέτρος Σπύρος Τάσος Φώτης Χρήστος".split(),
    ("female", "greek"): "Άννα Βάσω Γεωργία Δήμητρα Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Νίκη Όλγα Σοφία".split(),
    ("any", "greek"): "Άγγελ Γωγώ Κρις Μαρ Νικ Σταύ Τόνι Φρί".split(),
}
SYLLABLES = {"latin": "bar ber bol dan del dor fal fen gar hal hol kar kel lan lor mar mel nor pal rol sal sen tal tor val ven vol wal wen zan zel zor".split(), "cyrillic": "бар вол гор дан жар зел кар лан мар нор пал рос сав тар фед хол".split(), "greek": "βαλ γαρ δελ ζαν θεο καλ λαμ μαν νικ παπ ρεν σαρ ταν φιλ χαρ ψαλ".split()}

_TITLE = "|".join(t for g in TITLES.values() for t in g)
_NAME = rf"(?!(?:{_TITLE})(?!\p{{L}}))\p{{Lu}}[\p{{L}}'’\-]+"  # a title is no name
_PART = r"[\p{L}\p{N}._%+\-]"
#: Every entity starts where no letter or digit stands before it.
PATTERNS = {
    "email": rf"(?<![._%+\-]){_PART}++@[\p{{L}}\p{{N}}](?:[\p{{L}}\p{{N}}.\-]*[\p{{L}}\p{{N}}])?\.\p{{L}}{{2,}}",
    "token": r"(?:[0-9a-fA-F]{32,128}|(?:AKIA|ASIA)[0-9A-Z]{16}|(?:ghp|gho|sk|pk|xoxb|xoxp)[_\-][0-9A-Za-z_\-]{16,})(?![\p{L}\p{N}])",
    "phone": r"\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}(?!\d)",
    "ip": r"(?<!\.)(?:(?:25[0-5]|2[0-4]\d|[01]?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|[01]?\d?\d)(?!\d|\.\d)",
    "card": r"\d(?:[ \-]?\d){12,18}(?![\p{L}\p{N}])",
    "name": rf"(?:{_TITLE})\.? {_NAME}(?: {_NAME})?",
    "iban": r"[A-Z]{2}\d{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})(?![\p{L}\p{N}])",
}
_HEX = "[0-9A-Fa-f]{1,4}"
#: After the others, so that what they find stays theirs. National numbers: three, three and
#: four digits; five pairs; or an area code with 0, with 8 to 15 digits in all. No dates.
PATTERNS |= {
    "national": r"(?<!\d[./\-])(?:"
    r"(?:1[ .\-])?(?:\(\d{3}\)[ .\-]?|\d{3}[ .\-])\d{3}[ .\-]\d{4}"
    r"|0\d(?:(?: \d\d){4}|(?:\.\d\d){4}|(?:-\d\d){4})"
    r"|(?=\(?(?:\d[ )/\-]{0,2}){7,14}\d(?!\d))(?:\(0\d{1,5}\)[ /\-]?\d{2,8}|0\d{2,5}[ /\-]\d{2,8}|0\d[ /\-]\d{3,8})(?:[ \-]\d{2,5}){0,4}"
    r")(?![\p{L}\p{N}])",
    "ssn": r"(?<![\d.\-]\-)\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}]|-\d)",
    "ip6": rf"(?<![:.])(?:(?:{_HEX}:){{7}}{_HEX}|(?=[A-Fa-f:]{{0,38}}[0-9])(?:(?:{_HEX}:){{1,7}}:|"
    + "|".join(rf"(?:{_HEX}:){{1,{7 - n}}}(?::{_HEX}){{1,{n}}}" for n in range(1, 7))
    + rf"|:(?::{_HEX}){{1,7}}))(?![\p{{L}}\p{{N}}]|:[\p{{L}}\p{{N}}:]|\.\d)",
}
ANY = r"(?<![\p{L}\p{N}])(?:" + "|".join(f"(?:{p})" for p in PATTERNS.values()) + ")"
#: What every entity holds (a title is tried by its initial only); other texts are not searched.
HINT = "[0-9@]|:[0-9A-Fa-f]{1,4}:|(?:ghp|gho|sk|pk|xoxb|xoxp)[_\\-]|[" + "".join(sorted({t[0] for g in TITLES.values() for t in g})) + r"]\p{L}{1,9}+\.? \p{Lu}"

MAX_LATE = 1 << 14

#: Fixed value: the country codes of international numbers, none of which begins another.
COUNTRY = r"^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), 0)


def kind(entity: Column) -> Column:
    """The first pattern that fits the whole entity."""
    out = F.lit("card")
    for name in reversed(list(PATTERNS)):
        out = F.when(entity.rlike(rf"\A(?:{PATTERNS[name]})\z"), name).otherwise(out)
    return out


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, r"[^0-9]", "")


def _number(key: str, label: str, *of: Column, digits: int = 15, base: int = 10) -> Column:
    """A keyed number of sha-256: of 60 bits, or 64 with a sign."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(label), *[x.cast("string") for x in of]), 256), 1, digits), 16, base).cast("long")


def _hash(value: Column, salt: Column, key: str, label: str, below: Column) -> Column:
    return F.pmod(_number(key, label, salt, value), below)


def _permuted(left: Column, right: Column, high: Column, low: Column, key: str, label: str) -> Column:
    """Four Feistel rounds over (left, right) in [0, high) x [0, low): a bijection."""

    def turn(x: Column, r: Column) -> Column:
        a = F.when(r % 2 == 0, F.pmod(x["a"] + _hash(x["b"], r, key, label, x["high"]), x["high"])).otherwise(x["a"])
        b = F.when(r % 2 == 1, F.pmod(x["b"] + _hash(x["a"], r, key, label, x["low"]), x["low"])).otherwise(x["b"])
        return F.struct(a.alias("a"), b.alias("b"), x["high"].alias("high"), x["low"].alias("low"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(3)), F.struct(left.alias("a"), right.alias("b"), high.alias("high"), low.alias("low")), turn)


def _ten(n: Column) -> Column:
    return F.pow(F.lit(10), n).cast("long")


def _permuted_digits(digits: Column, key: str, label: str) -> Column:
    """A digit string of the same length (2 to 18); a bijection for each length."""

    def halves(d: Column) -> Column:
        half = (F.length(d) / 2).cast("int")
        rest = F.length(d) - half
        x = _permuted(F.substring(d, F.lit(1), half).try_cast("long"), F.substring(d, half + 1, rest).try_cast("long"), _ten(half), _ten(rest), key, label)
        return _let(x, lambda y: F.concat(F.lpad(y["a"].cast("string"), half, "0"), F.lpad(y["b"].cast("string"), rest, "0")))

    return _let(digits, halves)


def _refilled(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, one by one: the text between digits, and digits."""
    gaps = F.split(shape, "[0-9]", -1)
    return _let(digits, lambda d: F.array_join(F.zip_with(gaps, F.split(d, ""), lambda g, x: F.concat(F.coalesce(g, F.lit("")), F.coalesce(x, F.lit("")))), ""))


def _luhn(body: Column) -> Column:
    """The check digit that makes ``body`` + digit valid."""
    turned = F.split(F.reverse(body), "")
    total = F.aggregate(
        F.transform(turned, lambda d, i: F.when(i % 2 == 0, (d.try_cast("int") * 2 / 10).cast("int") + d.try_cast("int") * 2 % 10).otherwise(d.try_cast("int"))),
        F.lit(0),
        lambda s, d: s + d,
    )
    return F.pmod(10 - total % 10, F.lit(10))


def _card(e: Column, key: str) -> Column:
    def body_and_last(d: Column) -> Column:
        n = F.length(d)
        return F.struct(F.substring(d, F.lit(1), n - 1).alias("body"), F.substring(d, n, F.lit(1)).try_cast("int").alias("last"))

    def fresh(x: Column) -> Column:
        new = _permuted_digits(x["body"], key, "card")
        return _let(new, lambda y: F.concat(y, F.pmod(_luhn(y) + x["last"] - _luhn(x["body"]), F.lit(10)).cast("string")))

    return _refilled(e, _let(_let(_digits(e), body_and_last), fresh))


def _phone(e: Column, key: str, head: str = COUNTRY) -> Column:
    digits = _digits(e)
    parts = F.struct(F.regexp_extract(digits, head, 1).alias("head"), digits.alias("digits"))
    rest = lambda x: F.substring(x["digits"], F.length(x["head"]) + 1, F.length(x["digits"]))
    return _refilled(e, _let(parts, lambda x: F.concat(x["head"], _permuted_digits(rest(x), key, "phone"))))


def _octets(e: Column) -> Column:
    return F.transform(F.split(e, r"\."), lambda x: x.try_cast("long"))


def _ip(e: Column, key: str) -> Column:
    wide = F.lit(65536).cast("long")

    def turned(b: Column) -> Column:
        x = _permuted(F.get(b, 0) * 256 + F.get(b, 1), F.get(b, 2) * 256 + F.get(b, 3), wide, wide, key, "ip")
        return _let(x, lambda y: F.concat_ws(".", *[v.cast("long").cast("string") for v in (F.floor(y["a"] / 256), y["a"] % 256, F.floor(y["b"] / 256), y["b"] % 256)]))

    return _let(_octets(e), turned)


def _groups(e: Column) -> Column:
    """The eight groups of an IPv6 address as numbers."""
    sides = F.split(e, "::", -1)
    listed = lambda s: F.filter(F.split(F.coalesce(s, F.lit("")), ":"), lambda g: g != "")
    parts = F.struct(listed(F.get(sides, 0)).alias("left"), listed(F.get(sides, 1)).alias("right"))
    full = _let(parts, lambda x: F.concat(x["left"], F.array_repeat(F.lit("0"), 8 - F.size(x["left"]) - F.size(x["right"])), x["right"]))
    return F.transform(full, lambda g: F.conv(g, 16, 10).try_cast("long"))


def _ip6(e: Column, key: str) -> Column:
    """Four Feistel rounds over the two halves: a bijection."""
    half = lambda g, at: F.shiftleft(F.get(g, at), 48).bitwiseOR(F.shiftleft(F.get(g, at + 1), 32)).bitwiseOR(F.shiftleft(F.get(g, at + 2), 16)).bitwiseOR(F.get(g, at + 3))

    def turn(x: Column, r: Column) -> Column:
        return F.struct(x["b"].alias("a"), x["a"].bitwiseXOR(_number(key, "ip6", r, x["b"], digits=16, base=-10)).alias("b"))

    turned = lambda g: F.aggregate(F.sequence(F.lit(0), F.lit(3)), F.struct(half(g, 0).alias("a"), half(g, 4).alias("b")), turn)
    shown = lambda y: F.concat_ws(":", *[F.lower(F.hex(F.shiftrightunsigned(y[h], n).bitwiseAND(F.lit(0xFFFF).cast("long")))) for h in ("a", "b") for n in (48, 32, 16, 0)])
    return _let(_let(_groups(e), turned), shown)


#: Letters that stand for letters of the same script and case.
_ALPHABETS = (
    ("[0-9]", "0123456789"),
    ("[a-z]", "abcdefghijklmnopqrstuvwxyz"),
    ("[A-Z]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    (r"[\p{IsCyrillic}&&\p{Ll}]", "абвгдежзиклмнопрстуфхцчшэюя"),
    (r"[\p{IsCyrillic}&&\p{Lu}]", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"),
    (r"[\p{IsGreek}&&\p{Ll}]", "αβγδεζηθικλμνξοπρστυφχψω"),
    (r"[\p{IsGreek}&&\p{Lu}]", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
    (r"[\p{IsLatin}&&\p{Ll}]", "àáâãäåæçèéêëìíîïñòóôõöøùúûüý"),
    (r"[\p{IsLatin}&&\p{Lu}]", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ"),
)


def _like(s: Column, of: Column, attempt: Column, key: str, hexadecimal: bool = False) -> Column:
    """``s`` with each letter and digit replaced by one of its script and case, by the hash
    of ``of``. Letters of other scripts become digits; marks stay."""

    def one(c: Column, i: Column) -> Column:
        return _let(_number(key, "letters", of, attempt, i), lambda h: swapped(c, h))

    def swapped(c: Column, h: Column) -> Column:
        out = F.when(c.rlike(r"[\p{L}\p{N}]"), F.pmod(h, F.lit(10)).cast("string")).otherwise(c)
        for pattern, letters in reversed(_ALPHABETS):
            letters = letters[:6] if hexadecimal and len(letters) == 26 else letters
            out = F.when(c.rlike(pattern), F.substring(F.lit(letters), (F.pmod(h, F.lit(len(letters))) + 1).cast("int"), F.lit(1))).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(s, ""), one), "")


def _email(e: Column, attempt: Column, key: str) -> Column:
    known = F.lower(e)
    h = F.sha2(F.concat_ws("|", F.lit(key), known, attempt.cast("string")), 256)
    domain = F.concat(F.lit("m"), F.substring(h, 1, 12), F.lit(".example."), F.element_at(F.array(*map(F.lit, ("com", "net", "org"))), (F.pmod(F.xxhash64(h), F.lit(3)) + 1).cast("int")))
    out = F.concat(_like(F.substring_index(e, "@", 1), known, attempt, key), F.lit("@"), domain)
    return F.when((e == F.upper(e)) & (e != known), F.upper(out)).otherwise(F.lower(out))


def _token_head(e: Column) -> Column:
    return F.regexp_extract(e, r"^(AKIA|ASIA|(?:ghp|gho|sk|pk|xoxb|xoxp)[_\-])", 1)


def _token_known(e: Column) -> Column:
    return F.when(_token_head(e) == "", F.lower(e)).otherwise(e)


def _token(e: Column, attempt: Column, key: str) -> Column:
    head = _token_head(e)
    rest = F.substring(e, F.length(head) + 1, F.length(e))
    known = _token_known(e)
    # a token of marks, or nearly so, has few surrogates or none of its length
    more = F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("more"), known, attempt.cast("string")), 256), F.lit(1), attempt * 4)
    more = F.when((attempt > 0) & head.rlike(r"[_\-]\z"), more).otherwise("")
    return F.concat(head, F.when(head == "", _like(rest, known, attempt, key, True)).otherwise(_like(rest, known, attempt, key)), more)


def _name(e: Column, attempt: Column, key: str) -> Column:
    title = F.regexp_extract(e, r"^(\S+) ", 1)
    person = F.substring(e, F.length(title) + 2, F.length(e))
    bare = F.rtrim(F.translate(title, ".", " "))
    gender = F.lit("any")
    for g in ("male", "female"):
        gender = F.when(bare.isin(*TITLES[g]), g).otherwise(gender)
    script = F.when(person.rlike(r"\p{IsCyrillic}"), "cyrillic").when(person.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    full = F.instr(person, " ") > 0
    own = F.lower(F.substring_index(person, " ", 1))
    ends = F.lower(F.substring_index(person, " ", -1))
    pick = lambda values, *of: F.element_at(F.array(*map(F.lit, values)), (F.pmod(_number(key, *of), F.lit(len(values))) + 1).cast("int"))
    given = F.lit("")

    def another(values: list[str]) -> Column:
        """One of the names, but not the person's own."""
        names = F.array(*map(F.lit, values))
        return _let(F.pmod(_number(key, "given", own), F.lit(len(values))).cast("int"), lambda i: F.get(names, F.when(F.lower(F.get(names, i)) == own, (i + 1) % len(values)).otherwise(i)))

    for (g, s), values in GIVEN.items():
        more = lambda i: F.concat(F.lit("-"), pick(values, "more given", own, ends, attempt, i))  # noqa: E731, B023
        added = F.when(attempt > 0, F.array_join(F.transform(F.sequence(F.lit(1), attempt), more), "")).otherwise("")
        given = F.when((gender == g) & (script == s), F.concat(another(values), added)).otherwise(given)
    family = F.lit("")
    for s, values in SYLLABLES.items():
        syllable = lambda i: pick(values, "more", ends, attempt, i)  # noqa: E731, B023
        added = F.when((attempt > 0) & ~full, F.array_join(F.transform(F.sequence(F.lit(1), attempt), syllable), "")).otherwise("")
        family = F.when(script == s, F.initcap(F.concat(*[pick(values, f"family{i}", ends) for i in range(5)], added))).otherwise(family)
    new = F.when(full, F.concat(given, F.lit(" "), family)).otherwise(family)
    return F.concat(title, F.lit(" "), F.when((person == F.upper(person)) & (F.length(person) > 1), F.upper(new)).otherwise(new))


def _iban(e: Column, attempt: Column, key: str) -> Column:
    """Country, length, spaces and the places of letters stay; the check digits are valid."""
    bare = F.translate(e, " ", "")
    country, rest = F.substring(bare, 1, 2), F.substring(bare, F.lit(5), F.length(bare))

    def checked(account: Column) -> Column:
        turned = F.split(F.concat(account, country, F.lit("00")), "")
        code = lambda c: F.when(c.rlike("[0-9]"), c.try_cast("int")).otherwise(F.ascii(c) - 55)
        rest = F.aggregate(turned, F.lit(0), lambda n, c: (n * F.when(c.rlike("[0-9]"), 10).otherwise(100) + code(c)) % 97)
        return F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), account)

    made = _let(_like(rest, bare, attempt, key), checked)
    # the spaces where they were
    gaps = F.split(e, "[A-Z0-9]", -1)
    return _let(made, lambda m: F.array_join(F.zip_with(gaps, F.split(m, ""), lambda g, c: F.concat(F.coalesce(g, F.lit("")), F.coalesce(c, F.lit("")))), ""))


def surrogate(entity: Column, attempt: Column, key: str) -> Column:
    def by_kind(x: Column) -> Column:
        e, a, k = x["e"], x["a"], x["k"]
        return (
            F.when(k == "email", _email(e, a, key))
            .when(k == "token", _token(e, a, key))
            .when(k == "phone", _phone(e, key))
            .when(k == "national", _phone(e, key, r"^(\d)"))
            .when(k == "ip", _ip(e, key))
            .when(k == "ip6", _ip6(e, key))
            .when(k == "name", _name(e, a, key))
            .when(k == "iban", _iban(e, a, key))
            .when(k == "ssn", _refilled(e, _permuted_digits(_digits(e), key, "ssn")))
            .otherwise(_card(e, key))
        )

    return _let(_let(entity, lambda e: F.struct(e.alias("e"), attempt.alias("a"), kind(e).alias("k"))), by_kind)


def _known(entity: Column) -> Column:
    """Equal for spellings of one entity, as its surrogate takes them: kind and entity."""

    def spelt(x: Column) -> Column:
        e, k = x["e"], x["k"]
        return F.concat(
            k,
            F.lit(" "),
            F.when(k == "email", F.lower(e))
            .when(k == "token", _token_known(e))
            .when(k == "name", F.lower(F.regexp_replace(e, r"^\S+ ", "")))
            .when(k == "iban", F.translate(e, " ", ""))
            .when(k == "ip", F.concat_ws(".", F.transform(_octets(e), lambda b: b.cast("string"))))
            .when(k == "ip6", F.concat_ws(":", F.transform(_groups(e), lambda g: g.cast("string"))))
            .otherwise(_digits(e)),
        )

    return _let(_let(entity, lambda e: F.struct(e.alias("e"), kind(e).alias("k"))), spelt)


def _found(text: Column) -> Column:
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def attempts(entities: DataFrame, key: str) -> DataFrame | None:
    """The entities (column entity, distinct) that need a later attempt than the first, and
    which; None if there are none."""
    known = stage(entities.select("entity", _known(F.col("entity")).alias("known")), "entities")
    late = None
    for attempt in itertools.count(1):
        tried = known.withColumn("attempt", F.lit(0)) if late is None else known.join(late, "known", "left").withColumn("attempt", F.coalesce("attempt", F.lit(0)))
        made = stage(tried.select("known", _known(surrogate(F.col("entity"), F.col("attempt"), key)).alias("surrogate")), "surrogates")
        # permutations neither collide nor depend on the attempt
        made = made.where(F.substring_index("known", " ", 1).isin("email", "token", "name", "iban"))
        shared = made.groupBy("surrogate").agg(F.min("known").alias("low"), F.max("known").alias("high")).where("low <> high").select("surrogate", "low")
        clash = made.join(shared, "surrogate").where("known <> low").select("known")
        taken = made.join(known.select(F.col("known").alias("surrogate")).distinct(), "surrogate", "left_semi").select("known")
        again = stage(clash.unionByName(taken).distinct(), "again")
        if again.isEmpty():
            return None if late is None else stage(known.join(late, "known").select("entity", "attempt"), "late")
        now = again.withColumn("attempt", F.lit(attempt))
        late = now if late is None else stage(late.join(again, "known", "left_anti").unionByName(now), "late")


def _attempt(entity: Column, table: Column | None) -> Column:
    return F.lit(0) if table is None else F.coalesce(F.element_at(table, entity), F.lit(0))


def _by_text(found: DataFrame, late: DataFrame) -> DataFrame:
    """For each digest of a text with such entities, their attempts. ``found``: digest, entity."""
    return found.distinct().join(late, "entity").groupBy("digest").agg(F.map_from_entries(F.collect_list(F.struct("entity", "attempt"))).alias("late_attempts"))


def replace(docs: DataFrame, key: str, text: str = "text", max_late: int = MAX_LATE) -> DataFrame:
    """``docs`` with surrogates in the text, and entity_count."""
    n_hits, n_late = free_name(docs.columns, "entities_in_text"), free_name(docs.columns, "late_attempts")
    hits = _found(F.col(text))
    found = docs.select(F.explode(hits).alias("entity")).distinct()
    late = attempts(stage(found, "found"), key)
    out = docs.drop("entity_count")
    table = None
    if late is not None and late.count() <= max_late:
        table = F.create_map(*[F.lit(x) for r in sorted(late.collect()) for x in r])
    elif late is not None:
        n_digest = free_name(docs.columns, "digest")
        digest = F.sha2(F.col(text), 256)
        maps = stage(_by_text(docs.select(digest.alias("digest"), F.explode(hits).alias("entity")), late), "late-by-text")
        maps = maps.select(F.col("digest").alias(n_digest), F.col("late_attempts").alias(n_late))
        columns = out.columns
        out = out.withColumn(n_digest, digest).join(maps, n_digest, "left").select(*columns, n_late)
        table = F.col(n_late)
    out = out.withColumn(n_hits, hits)
    gaps = F.split(F.col(text), ANY, -1)
    fresh = F.transform(n_hits, lambda e: surrogate(e, _attempt(e, table), key))
    joined = F.array_join(F.flatten(F.zip_with(gaps, fresh, lambda g, e: F.array(g, F.coalesce(e, F.lit(""))))), "")
    out = out.withColumn(text, F.when(F.size(n_hits) > 0, joined).otherwise(F.col(text)))
    return out.withColumn("entity_count", F.when(F.col(text).isNotNull(), F.size(n_hits)).otherwise(0).try_cast("long")).drop(n_hits, n_late)
