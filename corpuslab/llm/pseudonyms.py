"""Format-preserving pseudonyms for personal numbers, dates and addresses, in DataFrame functions only.

A value is found by its pattern, validated, and replaced by a keyed permutation of the values of its own format: equal
values get equal pseudonyms in all documents, different ones different pseudonyms, and a pseudonym is valid in
its format (check digits, calendar, number ranges). The permutations are Feistel networks whose rounds add a keyed hash
of one half to the other half:

* digits and letters (card numbers, phone numbers, IBAN accounts, the local part of e-mail addresses): sign by sign within
  digits, capitals and small letters; check digits are computed anew;
* ranges (dates, IPv4 addresses, social security numbers): on the two parts of a mixed-radix number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 8

# The patterns of the kinds, tried in this order at each place of a text.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "ip": r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)",
    "date": r"(?<![\w.-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?!(?!T\d)[\w-]|[./]\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w]|-\d)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){3,4}(?!\d)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "card": r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?!\w|-\d|\.\d)",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())

#: Signs of an IBAN by country; elsewhere any length of the pattern counts.
IBAN_SIGNS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS",
    23: "AE GI IL IQ", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
}
#: A sign of private use; a run of it, longer than any in the text, parts a value from an overrun.
BREAK = "\ue000"

# 400 years of the calendar have 146,097 = 189 x 773 days.
FIRST_DAY, DATE_PARTS = "1800-01-01", (189, 773)


def _keyed(key: Column, kind: str, round_: Column, value: Column) -> Column:
    """Keyed hash of a half as hexadecimal digits."""
    return F.sha2(F.concat_ws("|", key, F.lit(kind), round_.cast("string"), value.cast("string"), key), 256)


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 14), 16, 10).cast("bigint")


def permute_parts(a: Column, b: Column, radix: tuple[int, int], key: Column, kind: str) -> Column:
    """Feistel network on a pair (a, b) with 0 <= a < radix[0], 0 <= b < radix[1]; a struct of the same ranges."""

    def step(now: Column, r: Column) -> Column:
        even = F.struct(((now["a"] + _number(_keyed(key, kind, r, now["b"]))) % radix[0]).alias("a"), now["b"].alias("b"))
        odd = F.struct(now["a"].alias("a"), ((now["b"] + _number(_keyed(key, kind, r, now["a"]))) % radix[1]).alias("b"))
        return F.when(r % 2 == 0, even).otherwise(odd)

    start = F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _shift(text: Column, digest: Column) -> Column:
    """Shift every digit and letter within its class by the digest's bytes; other signs stay."""

    def sign(c: Column, at: Column) -> Column:
        by = F.conv(F.substr(digest, (at % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        turned = lambda first, n: F.chr((F.ascii(c) - first + by) % n + first)
        small = turned(97, 26)
        return F.when(c.rlike("[0-9]"), turned(48, 10)).when(c.rlike("[A-Z]"), turned(65, 26)).when(c.rlike("[a-z]"), small).otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), sign), "")


def permute_signs(text: Column, key: Column, kind: str) -> Column:
    """Feistel network on a string of up to 64 digits and letters; every sign keeps its class."""
    half = F.floor(F.length(text) / 2).cast("int")

    def step(now: Column, r: Column) -> Column:
        even = F.struct(_shift(now["a"], _keyed(key, kind, r, now["b"])).alias("a"), now["b"].alias("b"))
        odd = F.struct(now["a"].alias("a"), _shift(now["b"], _keyed(key, kind, r, now["a"])).alias("b"))
        return F.when(r % 2 == 0, even).otherwise(odd)

    start = F.struct(F.substr(text, F.lit(1), half).alias("a"), F.substr(text, half + 1).alias("b"))
    ended = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)
    return F.concat(ended["a"], ended["b"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _fill(template: Column, signs: Column, wanted: str) -> Column:
    """``template`` with its signs of the class ``wanted`` replaced by those of ``signs``, in order."""

    def step(now: Column, c: Column) -> Column:
        hit = c.rlike(wanted)
        return F.struct(
            F.when(hit, now["i"] + 1).otherwise(now["i"]).alias("i"),
            F.concat(now["out"], F.when(hit, F.substr(signs, now["i"], F.lit(1))).otherwise(c)).alias("out"),
        )

    start = F.struct(F.lit(1).alias("i"), F.lit("").alias("out"))
    return F.aggregate(F.split(template, ""), start, step)["out"]


def luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn sum; from the right, the places with number ``doubled`` modulo 2 (0 is the last digit) count twice."""

    def weight(c: Column, at: Column) -> Column:
        d = c.cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return F.when(at % 2 == doubled, twice).otherwise(d)

    each = F.transform(F.split(F.reverse(digits), ""), weight)
    return F.aggregate(each, F.lit(0), lambda total, x: total + x)


def _mod97(signs: Column) -> Column:
    """Remainder by 97 of capitals and digits read as a number, letters being 10 to 35."""

    def step(now: Column, c: Column) -> Column:
        return F.when(c.rlike("[A-Z]"), (now * 100 + F.ascii(c) - 55) % 97).otherwise((now * 10 + F.ascii(c) - 48) % 97)

    return F.aggregate(F.split(signs, ""), F.lit(0), step)


def _card(m: Column, key: Column) -> Column:
    digits = _digits(m)
    payload = permute_signs(F.substr(digits, F.lit(1), F.length(digits) - 1), key, "card")
    whole = F.concat(payload, ((F.lit(10) - luhn_sum(payload, 0) % 10) % 10).cast("string"))
    return F.when(luhn_sum(digits, 1) % 10 == 0, _fill(m, whole, "[0-9]"))


def _phone(m: Column, key: Column) -> Column:
    digits = _digits(m)
    kept = F.greatest(F.length(digits) - 10, F.when(m.startswith("+"), 1).otherwise(0))
    changed = permute_signs(F.substr(digits, kept + 1), key, "phone")
    return F.when(F.length(digits).between(7, 15), _fill(m, F.concat(F.substr(digits, F.lit(1), kept), changed), "[0-9]"))


def _iban(m: Column, key: Column) -> Column:
    plain = F.regexp_replace(m, " ", "")
    country, check, account = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(3), F.lit(2)), F.substr(plain, F.lit(5))
    changed = permute_signs(account, key, "iban")
    fresh = F.lpad((F.lit(98) - _mod97(F.concat(changed, country, F.lit("00")))).cast("string"), 2, "0")
    return F.when(_mod97(F.concat(account, country, check)) == 1, _fill(m, F.concat(country, fresh, changed), "[A-Z0-9]"))


def _email(m: Column, key: Column) -> Column:
    local = F.substring_index(m, "@", 1)
    return F.concat(permute_signs(local, key, "email"), F.lit("@"), F.substring_index(m, "@", -1))


def _ip(m: Column, key: Column) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    parts = permute_parts(octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], (65536, 65536), key, "ip")
    out = [F.floor(parts["a"] / 256), parts["a"] % 256, F.floor(parts["b"] / 256), parts["b"] % 256]
    return F.when(F.forall(octets, lambda x: x <= 255), F.concat_ws(".", *[x.cast("string") for x in out]))


def _ssn(m: Column, key: Column) -> Column:
    area, group, serial = (F.substr(m, F.lit(s), F.lit(n)).cast("int") for s, n in ((1, 3), (5, 2), (8, 4)))
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    parts = permute_parts(place, (group - 1) * 9999 + serial - 1, (898, 99 * 9999), key, "ssn")
    fresh = parts["a"] + 1 + F.when(parts["a"] + 1 >= 666, 1).otherwise(0)
    padded = lambda x, n: F.lpad(x.cast("string"), n, "0")
    out = F.concat_ws("-", padded(fresh, 3), padded(F.floor(parts["b"] / 9999) + 1, 2), padded(parts["b"] % 9999 + 1, 4))
    return F.when((area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0), out)


#: Steps of a walk that looks for a day after the twelfth; about 39 of 100 steps fail, so no value is known to need more.
WALK = 96


def _date(m: Column, key: Column) -> Column:
    """A day permuted among the days of its form. Slashed values with a first part over 12 are permuted among themselves, by
    steps along the permutation of all days until such a day comes, so that month-first and day-first values never meet."""
    first = F.lit(FIRST_DAY).cast("date")
    n_days = DATE_PARTS[0] * DATE_PARTS[1]

    def permuted(number: Column) -> Column:
        parts = permute_parts(F.floor(number / DATE_PARTS[1]), number % DATE_PARTS[1], DATE_PARTS, key, "date")
        return _let(parts, lambda p: (p["a"] * DATE_PARTS[1] + p["b"]).cast("int"))

    def of(form: str) -> Column:
        number = F.date_diff(F.try_to_timestamp(m, F.lit(form)).cast("date"), first)
        return F.when(number.between(0, n_days - 1), F.date_format(F.date_add(first, permuted(number)), form))

    def late(number: Column) -> Column:
        return F.day(F.date_add(first, number)) > 12

    def walked(form: str) -> Column:
        number = F.date_diff(F.try_to_timestamp(m, F.lit(form)).cast("date"), first)
        step = lambda now, k: F.when((k > 0) & late(now), now).otherwise(permuted(now))
        ended = F.aggregate(F.sequence(F.lit(0), F.lit(WALK)), number, step)
        return F.when(number.between(0, n_days - 1), F.date_format(F.date_add(first, ended), form))

    slashed = F.when(F.substr(m, F.lit(1), F.lit(2)) > "12", walked("dd/MM/yyyy")).otherwise(of("MM/dd/yyyy"))
    return F.when(m.contains("-"), of("yyyy-MM-dd")).when(m.contains("."), of("dd.MM.yyyy")).otherwise(slashed)


_MAKERS = {"email": _email, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "iban": _iban, "card": _card}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def kind_of(m: Column) -> Column:
    """Kind of a match of ``ANY``, by signs that only one of the patterns can have there."""
    dots = F.length(m) - F.length(F.replace(m, F.lit("."), F.lit("")))
    phone = m.startswith("+") | m.contains("(")
    return (
        F.when(m.contains("@"), "email").when(phone, "phone").when(F.substr(m, F.lit(1), F.lit(1)) >= "A", "iban")
        .when(dots == 3, "ip").when(F.length(m) == 10, "date").when(F.length(m) == 11, "ssn").otherwise("card")
    )


def pseudonym(m: Column, key: Column) -> Column:
    """Struct of a match's ``kind`` and pseudonym ``value``; both null if it is not valid in any format."""

    def of(kind: Column) -> Column:
        value = F.lit(None).cast("string")
        for name, maker in _MAKERS.items():
            value = F.when(kind == name, maker(m, key)).otherwise(value)
        return _let(value, lambda v: F.struct(F.when(v.isNotNull(), kind).alias("kind"), v.alias("value")))

    return _let(kind_of(m), of)


#: Texts without such a place have no card or IBAN with a further group.
LONG = r"(?<![\w.-])\d(?:[ -]?\d){12}|(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11}"


#: Digits of a card by its first ones.
CARD_DIGITS = {"4": 16, "5": 16, "2": 16, "6": 16, "34": 15, "37": 15}


def _valid(m: Column, iban: Column) -> Column:
    """Whether a card or IBAN reading passes its check; an IBAN has its country's length."""
    plain = F.regexp_replace(m, "[ -]", "")
    country = F.substr(plain, F.lit(1), F.lit(2))
    wanted = F.lit(0)
    for n, names in IBAN_SIGNS.items():
        wanted = F.when(country.isin(names.split()), n).otherwise(wanted)
    long = F.length(plain).between(15, 34) & wanted.isin(0, F.length(plain))
    account = long & (_mod97(F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))) == 1)
    return F.when(iban, account).otherwise(F.length(plain).between(13, 19) & (luhn_sum(plain, 1) % 10 == 0))


def _usual(m: Column) -> Column:
    """Whether a card number has as many digits as its first ones ask for."""
    digits, wanted = _digits(m), F.lit(0)
    for first, n in CARD_DIGITS.items():
        wanted = F.when(digits.startswith(first), n).otherwise(wanted)
    return F.length(digits) == wanted


def _reading(m: Column, kind: Column) -> Column:
    """Length of the reading of a card or IBAN match up to a group's end that counts instead of the whole match; null if the whole counts.

    The first valid reading of a card with the digits that its issuer uses counts; else, where the whole fails, the longest valid one.
    """
    iban = kind == "iban"
    ends = F.filter(F.sequence(F.length(m) - 1, F.lit(12), F.lit(-1)), lambda n: F.substr(m, n + 1, F.lit(1)).isin(" ", "-"))
    short = F.filter(ends, lambda n: _valid(F.substr(m, F.lit(1), n), iban))

    def of(found: Column) -> Column:
        usual = F.get(F.filter(found, lambda n: ~iban & _usual(F.substr(m, F.lit(1), n))), F.lit(0))
        return F.coalesce(F.when(~_usual(m), usual), F.when(~_valid(m, iban), F.get(found, F.lit(0))))

    long = kind.isin("iban", "card") & (F.length(m) > 13)
    return F.when(long & m.rlike("[ -]"), _let(short, of))


def _parted(text: Column, mark: Column) -> Column:
    """``text`` with ``mark`` behind every shorter reading. What follows one is read anew, until nothing more is found."""

    def joined(now: Column, ends: Column) -> Column:
        parted = F.transform(ends, lambda x: F.when(x["n"].isNull(), x["m"]).otherwise(F.concat(F.substr(x["m"], F.lit(1), x["n"]), mark, F.substr(x["m"], x["n"] + 1))))
        pieces = F.zip_with(F.split(now["text"], ANY, -1), F.concat(parted, F.array(F.lit(""))), lambda a, b: F.concat(a, b))
        more = F.exists(ends, lambda x: x["n"].isNotNull())
        return F.when(more, F.struct(F.array_join(pieces, "").alias("text"), F.lit(False).alias("done"))).otherwise(F.struct(now["text"].alias("text"), F.lit(True).alias("done")))

    def step(now: Column, _: Column) -> Column:
        found = F.regexp_extract_all(now["text"], F.lit(ANY), F.lit(0))
        ends = F.transform(found, lambda m: F.struct(m.alias("m"), _let(kind_of(m), lambda kind: _reading(m, kind)).alias("n")))
        return F.when(now["done"], now).otherwise(_let(ends, lambda x: joined(now, x)))

    rounds = F.sequence(F.lit(0), F.floor(F.length(text) / 13).cast("int"))
    start = F.struct(text.alias("text"), (~F.coalesce(text.rlike(LONG), F.lit(False))).alias("done"))
    return F.aggregate(rounds, start, step)["text"]


def pseudonymise(docs: DataFrame, key: str, text_column: str = "text") -> DataFrame:
    """All columns of ``docs``, the text with pseudonyms, and ``_n_private`` and ``_kinds`` (sorted, distinct).

    A null text stays null with a count of zero; empty texts and texts without a valid value stay as they are. What
    looks like a value but is not valid (a failed check digit, an octet over 255, a day that the calendar lacks) stays. A card that
    is valid at a group's end with the digits of its issuer ends there; where a card or IBAN else fails with the groups that follow it, its longest
    valid reading up to a group's end counts; the rest is read anew. Rows
    don't depend on each other, so repeated rows and further columns pass through; columns of the added names are replaced. No shuffle, no Python on the executors.
    """
    docs = docs.drop("_n_private", "_kinds", "_seen", "_mark", "_parted")
    secret, text = F.lit(key), F.col("_parted")
    runs = F.transform(F.regexp_extract_all(F.col(text_column), F.lit(f"{BREAK}+"), F.lit(0)), F.length)
    docs_marked = docs.withColumn("_mark", F.repeat(F.lit(BREAK), F.coalesce(F.array_max(runs), F.lit(0)) + 1))
    docs_marked = docs_marked.withColumn("_parted", _parted(F.col(text_column), F.col("_mark")))
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    seen = docs_marked.withColumn("_seen", F.transform(found, lambda m: F.struct(m.alias("m"), pseudonym(m, secret).alias("p"))))
    fresh = F.transform("_seen", lambda x: F.coalesce(x["p"]["value"], x["m"]))
    between = F.split(text, ANY, -1)
    pieces = F.zip_with(between, F.concat(fresh, F.array(F.lit(""))), lambda a, b: F.concat(a, b))
    changed = F.when(F.size("_seen") > 0, F.replace(F.array_join(pieces, ""), F.col("_mark"), F.lit(""))).otherwise(F.col(text_column))
    valid = F.filter("_seen", lambda x: x["p"]["kind"].isNotNull())
    return (
        seen.withColumn(text_column, changed)
        .withColumn("_n_private", F.coalesce(F.size(valid), F.lit(0)))
        .withColumn("_kinds", F.coalesce(F.array_sort(F.array_distinct(F.transform(valid, lambda x: x["p"]["kind"]))), F.array().cast("array<string>")))
        .drop("_seen", "_mark", "_parted")
    )
