"""Format-preserving pseudonyms: validated numbers and dates are permuted by a keyed Feistel network.

A value is a number in a domain of a * b values, held as a pair of a left part below a and a right part below b.
Ten rounds add a keyed hash of one part to the other, which is a permutation of the domain whatever the
hash is. A domain that isn't a product is walked: a result outside is permuted again, which is a permutation of
what lies inside. So every format stays valid, different values get different pseudonyms, and equal values get
equal ones in all documents, however they are written.

All steps are built-in expressions. Kinds and what is validated:

* email: the letters a-z and digits of the local part, in lower case, as a number to base 36; the domain and all other
  characters stay, so different addresses stay different.
* iban: the length of its country, and the remainder modulo 97; its digits are permuted, the check digits computed anew.
* card: 13 to 19 digits in one group, or groups of 4-4-4-4, 4-4-4-4-1 to 3, 4-4-4-1 to 3, 4-6-5 or 4-6-4, that pass the Luhn test; the
  check digit is computed anew.
* ssn: area, group and serial number within their ranges.
* phone: ten digits in groups of 3-3-4, ten digits in one group with an area and an exchange from 200, or 7 to 15 digits
  after a +; a country code stays.
* ip: four numbers up to 255.
* date: a day of the calendar from 1900 to 2099, year first with - or /, day first with . or /, or month first with / where it
  can't be read day first.

A text is read three times: for emails and account numbers, then for cards, then for the rest. Cards are looked for at every
group of a run of digit groups, so a number before or after one does not hide it. What fails its test stays as it is.
Patterns take what they repeat possessively or a bounded number of times, so no text makes them recurse or backtrack.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.llm.frames import TEXT, packed, unpacked
from viewloom.operators.columns import computed

#: U+0001 in a text is written with U+0002 behind it, so that these marks stand for nothing else.
ESCAPE, ESCAPED = "\u0001", "\u0001\u0002"
PLACES = {"first": "\u0003", "cards": "\u0004", "rest": "\u0005"}
CUT = "\u0001\u0006"
ROUNDS = 10
WALKS = 12
#: Steps of a walk that leaves a domain two times out of three.
LONG_WALKS = 120
#: Cards of a run that are listed together.
CHUNK = 128

# The length of an account number by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22,
    "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22,
    "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30,
    "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27,
    "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31,
    "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
# The country codes of one and of two digits; all others have three.
COUNTRY_CODE = r"^\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"

_EDGE, _END = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
# The domain stays, so it need not be matched to its end.
_EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.){1,126}?[A-Za-z]{2}"


def _iban_pattern() -> str:
    by_length: dict[int, list[str]] = {}
    for country, length in IBAN_LENGTHS.items():
        by_length.setdefault(length, []).append(country)
    known = [f"(?:{'|'.join(names)})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}+{_END}" for n, names in sorted(by_length.items())]
    other = rf"(?!{'|'.join(IBAN_LENGTHS)})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,4}})?{_END}"
    return f"{_EDGE}(?:{'|'.join([*known, other])})"


_IBAN = _iban_pattern()
_RUN = _EDGE + r"(?=(?:[0-9][ -]?){12}[0-9])[0-9]++(?![A-Za-z])(?:[ -][0-9]++(?![A-Za-z]))*+"
_CARD = r"^(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -](?:[0-9]{1,4}|[0-9]{4}[ -][0-9]{1,3})|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})$"
#: Numbers of groups of a card, the ones looked for first come first.
CARD_GROUPS = (4, 5, 3, 1)
_IP = r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z])(?!\.[0-9])"
_YEAR_FIRST = r"(?<![0-9A-Za-z./-])(?:19|20)[0-9]{2}(?:-[0-9]{2}-[0-9]{2}(?![0-9A-Za-z-])|/[0-9]{2}/[0-9]{2}(?![0-9A-Za-z/]))"
_DAY_FIRST = r"(?<![0-9A-Za-z./])[0-9]{1,2}[./][0-9]{1,2}[./](?:19|20)[0-9]{2}(?![0-9A-Za-z/])"
_SSN = _EDGE + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _END
_PHONE = r"(?:(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|(?<![0-9A-Za-z])[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}" + _END
_PLUS = r"(?<![0-9A-Za-z+])\+[1-9](?:[ .-]?[0-9]){6,14}" + _END
_TEN = _EDGE + r"[2-9][0-9]{2}[2-9][0-9]{6}" + _END
FIRST_PATTERN = f"{_EMAIL}|{_IBAN}"
REST_PATTERN = "|".join((_IP, _YEAR_FIRST, _DAY_FIRST, _SSN, _PHONE, _PLUS, _TEN))
KINDS = ("email", "iban", "ip", "date", "ssn", "phone", "card")
#: The kind of a date that is written month first; it counts as a date.
MONTH_FIRST = "date_month_first"


def _hash(key: str, tweak: Column, i: Column, part: Column) -> Column:
    """60 bits of a keyed hash; the key goes in twice, so that one hash can't be continued from another."""
    inner = F.sha2(F.concat_ws("|", F.lit(key), tweak, i.cast("string"), part.cast("string")), 256)
    return F.conv(F.substring(F.sha2(F.concat(F.lit(key), inner), 256), 1, 15), 16, 10).cast("bigint")


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, tweak: Column, inverse: bool = False) -> Column:
    """struct(l, r): the permuted pair; l stays below ``a`` and r below ``b``. ``inverse`` undoes it."""
    rounds = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))

    def step(x: Column, i: Column) -> Column:
        even = F.pmod(i, F.lit(2)) == 0
        other = F.when(even, x["r"]).otherwise(x["l"])
        size = F.when(even, a).otherwise(b)
        shift = _hash(key, tweak, i, other)
        own = F.when(even, x["l"]).otherwise(x["r"])
        moved = F.pmod(own - shift if inverse else own + shift, size)
        return F.struct(F.when(even, moved).otherwise(x["l"]).alias("l"), F.when(even, x["r"]).otherwise(moved).alias("r"))

    return F.aggregate(F.reverse(rounds) if inverse else rounds, start, step)


def permute_number(value: Column, size: int, a: int, b: int, key: str, tweak: str, inverse: bool = False) -> Column:
    """A permutation of 0 ... size - 1, by walking the domain of a * b numbers, which must not be much larger."""
    sides = F.lit(a).cast("bigint"), F.lit(b).cast("bigint")

    def once(x: Column) -> Column:
        pair = feistel((x - F.pmod(x, sides[1])) / sides[1], F.pmod(x, sides[1]), *sides, key, F.lit(tweak), inverse)
        return F.aggregate(F.array(pair), F.lit(0).cast("bigint"), lambda _, p: p["l"] * sides[1] + p["r"])

    def walk(x: Column, i: Column) -> Column:
        return F.when((i == 0) | (x >= size), once(x)).otherwise(x)

    walked = F.aggregate(F.sequence(F.lit(0), F.lit(WALKS)), value.cast("bigint"), walk)
    return F.when(walked < size, walked).otherwise(F.raise_error(F.lit("the walk did not end")).cast("bigint"))


def _ten_digits(digits: Column, key: str, inverse: bool) -> Column:
    """Ten digits of a phone: those with an area and an exchange from 200 among themselves, and so the others."""
    good = r"^[2-9][0-9]{2}[2-9]"
    area, exchange, line = (F.substring(digits, F.lit(at), F.lit(n)).cast("bigint") for at, n in ((1, 3), (4, 3), (7, 4)))
    index = ((area - 200) * 800 + exchange - 200) * 10000 + line
    moved = permute_number(index, 80000 * 80000, 80000, 80000, key, "phone", inverse)

    def text(n: Column) -> Column:
        office = F.floor(n / 10000)
        return F.concat(
            (F.floor(office / 800) + 200).cast("string"), (F.pmod(office, F.lit(800)) + 200).cast("string"), F.lpad(F.pmod(n, F.lit(10000)).cast("string"), 4, "0")
        )

    def walk(x: Column, i: Column) -> Column:
        return F.when((i == 0) | x.rlike(good), permute_digits(x, 10, key, F.lit("phone"), inverse)).otherwise(x)

    other = F.aggregate(F.sequence(F.lit(0), F.lit(LONG_WALKS)), digits, walk)
    ended = F.when(~other.rlike(good), other).otherwise(F.raise_error(F.lit("the walk did not end")).cast("string"))
    return F.when(digits.rlike(good), F.aggregate(F.array(moved), F.lit(""), lambda _, n: text(n))).otherwise(
        F.aggregate(F.array(ended), F.lit(""), lambda _, x: x)
    )


def permute_digits(digits: Column, base: int, key: str, tweak: Column, inverse: bool = False) -> Column:
    """A permutation of strings of one length over 0-9 (base 10) or 0-9a-z (base 36), of 1 to 18 symbols."""

    def whole(x: Column) -> Column:
        n = F.length(x)
        u = F.floor(n / 2).cast("int")
        v = n - u
        number = [F.coalesce(F.conv(F.substring(x, s, k), base, 10), F.lit("0")).cast("bigint") for s, k in ((F.lit(1), u), (u + 1, v))]
        sides = [F.pow(F.lit(float(base)), k).cast("bigint") for k in (u, v)]
        pair = feistel(*number, *sides, key, F.concat_ws("|", tweak, n.cast("string")), inverse)
        text = F.aggregate(
            F.array(pair),
            F.lit(""),
            lambda _, p: F.concat(
                F.when(u > 0, F.lpad(F.lower(F.conv(p["l"].cast("string"), 10, base)), u, F.lit("0"))).otherwise(F.lit("")),
                F.lpad(F.lower(F.conv(p["r"].cast("string"), 10, base)), v, F.lit("0")),
            ),
        )
        return F.when(n > 0, text).otherwise(F.lit(""))

    return F.aggregate(F.array(digits), F.lit(""), lambda _, x: whole(x))


def _long_digits(symbols: Column, base: int, key: str, tweak: str, inverse: bool) -> Column:
    """Strings of any length, 18 symbols at a time."""
    chunks = F.sequence(F.lit(0), F.greatest(F.ceil(F.length(symbols) / 18).cast("int") - 1, F.lit(0)))
    return F.array_join(
        F.transform(
            chunks,
            lambda k: permute_digits(F.substring(symbols, k * 18 + 1, F.lit(18)), base, key, F.concat(F.lit(tweak), k.cast("string")), inverse),
        ),
        "",
    )


def _only(value: Column, kept: str) -> Column:
    return F.regexp_replace(value, f"[^{kept}]", "")


def _put_back(value: Column, kept: str, symbols: Column) -> Column:
    """``value`` with its symbols of the class ``kept`` replaced, in order."""

    def at(c: Column, i: Column) -> Column:
        nth = F.length(_only(F.substring(value, F.lit(1), i + 1), kept))
        return F.when(c.rlike(f"[{kept}]"), F.substring(symbols, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(value, ""), at), "")


def luhn_sum(digits: Column) -> Column:
    """Sum of the Luhn test; a valid number's is a multiple of ten."""
    reverse = F.split(F.reverse(digits), "")
    doubled = F.transform(
        reverse, lambda c, i: F.when(F.pmod(i, F.lit(2)) == 1, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int"))
    )
    return F.aggregate(doubled, F.lit(0), lambda total, x: total + x)


def remainder_97(symbols: Column) -> Column:
    """Remainder modulo 97 of digits and letters (A is 10), the first four moved to the end."""
    turned = F.concat(F.substring(symbols, F.lit(5), F.length(symbols)), F.substring(symbols, 1, 4))

    def step(left: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(c.rlike("[0-9]"), F.pmod(left * 10 + F.ascii(c) - 48, F.lit(97))).otherwise(F.pmod(left * 100 + letter, F.lit(97)))

    return F.aggregate(F.split(turned, ""), F.lit(0), step)


def _part(value: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(value, pattern, group).cast("bigint")


_FORMS = {
    "year": (r"^([0-9]{4})[-/]([0-9]{2})[-/]([0-9]{2})$", (1, 2, 3)),
    "day": (r"^([0-9]{1,2})[./]([0-9]{1,2})[./]([0-9]{4})$", (3, 2, 1)),
    "month": (r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})$", (3, 1, 2)),
}


def _day(value: Column, form: str) -> Column:
    """Days since 1900-01-01 of a date that is written in a form, null for what is none."""
    pattern, groups = _FORMS[form]
    year, month, day = (F.regexp_extract(value, pattern, g) for g in groups)
    date = F.try_to_date(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")
    return F.when(value.rlike(pattern), F.datediff(date, F.to_date(F.lit("1900-01-01"))))


def _date_like(value: Column, days: Column, form: str) -> Column:
    """The day in the form of ``value``, with its separators, and short numbers where its own is short."""
    date = F.date_add(F.to_date(F.lit("1900-01-01")), days.cast("int"))
    if form == "year":
        return F.when(value.contains("-"), F.date_format(date, "yyyy-MM-dd")).otherwise(F.date_format(date, "yyyy/MM/dd"))
    pieces = F.split(value, "[./]")
    separators = [F.regexp_extract(value, r"^[0-9]+([./])[0-9]+([./])", g) for g in (1, 2)]
    letters = ("d", "M") if form == "day" else ("M", "d")
    short = [F.when(F.element_at(pieces, i).rlike("^[1-9]$"), F.date_format(date, f)).otherwise(F.date_format(date, f * 2)) for i, f in zip((1, 2), letters, strict=True)]
    return F.concat(short[0], separators[0], short[1], separators[1], F.date_format(date, "yyyy"))


def _date(value: Column, form: str, key: str, inverse: bool) -> Column:
    # 73,049 days from 1900 to 2099
    return _date_like(value, permute_number(_day(value, form), 73049, 271, 270, key, "date", inverse), form)


def _email(value: Column, key: str, inverse: bool) -> Column:
    local = F.lower(F.substring_index(value, "@", 1))
    symbols = _long_digits(_only(local, "0-9a-z"), 36, key, "email", inverse)
    return F.concat(_put_back(local, "0-9a-z", symbols), F.lit("@"), F.substring_index(value, "@", -1))


def _iban(value: Column, key: str, inverse: bool) -> Column:
    symbols = _only(value, "0-9A-Z")
    account = F.substring(symbols, F.lit(5), F.length(symbols))
    country = F.substring(symbols, 1, 2)
    new_account = _put_back(account, "0-9", _long_digits(_only(account, "0-9"), 10, key, "iban", inverse))
    blank = F.concat(country, F.lit("00"), new_account)
    new_check = F.lpad((98 - remainder_97(blank)).cast("string"), 2, "0")
    return _put_back(value, "0-9A-Z", F.concat(country, new_check, new_account))


def _card(value: Column, key: str, inverse: bool) -> Column:
    digits = _only(value, "0-9")
    new_body = _long_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), 10, key, "card", inverse)
    check = F.pmod(10 - F.pmod(luhn_sum(F.concat(new_body, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")
    return _put_back(value, "0-9", F.concat(new_body, check))


def _ip(value: Column, key: str, inverse: bool) -> Column:
    four = F.transform(F.split(value, r"\."), lambda x: x.cast("bigint"))
    sides = F.lit(65536).cast("bigint")
    halves = [F.element_at(four, i) * 256 + F.element_at(four, i + 1) for i in (1, 3)]
    pair = feistel(*halves, sides, sides, key, F.lit("ip"), inverse)
    both = F.flatten(F.transform(F.array(pair), lambda p: F.array(p["l"], p["r"])))
    return F.array_join(
        F.flatten(F.transform(both, lambda x: F.array(F.shiftright(x, 8).cast("string"), F.pmod(x, F.lit(256)).cast("string")))), "."
    )


_SSN_FORM = r"^([0-9]{3})-([0-9]{2})-([0-9]{4})$"


def _ssn(value: Column, key: str, inverse: bool) -> Column:
    # 898 areas, 99 groups, 9,999 serial numbers
    area, group, serial = (_part(value, _SSN_FORM, g) for g in (1, 2, 3))
    index = (area - F.when(area > 666, 2).otherwise(1)) * 989901 + (group - 1) * 9999 + serial - 1
    moved = permute_number(index, 898 * 99 * 9999, 29816, 29815, key, "ssn", inverse)

    def text(n: Column) -> Column:
        first = F.floor(n / 989901)
        rest = F.pmod(n, F.lit(989901))
        return F.concat_ws(
            "-",
            F.lpad((first + F.when(first >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
            F.lpad((F.floor(rest / 9999) + 1).cast("string"), 2, "0"),
            F.lpad((F.pmod(rest, F.lit(9999)) + 1).cast("string"), 4, "0"),
        )

    return F.aggregate(F.array(moved), F.lit(""), lambda _, n: text(n))


def _phone(value: Column, key: str, inverse: bool) -> Column:
    """A number without a country code is one of ten digits, and the same number with a code has the same pseudonym."""
    digits = _only(value, "0-9")
    code = F.when(value.startswith("+"), F.regexp_extract(F.concat(F.lit("+"), digits), COUNTRY_CODE, 1)).otherwise(F.lit(""))
    own = F.substring(digits, F.length(code) + 1, F.length(digits))
    new = F.when(F.length(own) == 10, _ten_digits(own, key, inverse)).otherwise(_long_digits(own, 10, key, "phone", inverse))
    return _put_back(value, "0-9", F.concat(code, new))


def _rewritten(kind: str, value: Column, key: str, inverse: bool) -> Column:
    if kind in ("date", MONTH_FIRST):
        first = F.when(value.rlike(_FORMS["year"][0]), _date(value, "year", key, inverse)).otherwise(_date(value, "day", key, inverse))
        return first if kind == "date" else _date(value, "month", key, inverse)
    return {"email": _email, "iban": _iban, "card": _card, "ip": _ip, "ssn": _ssn, "phone": _phone}[kind](value, key, inverse)


def _kind_of(value: Column, first: bool) -> Column:
    """The kind of a match, null where its test fails."""
    if first:
        symbols = _only(value, "0-9A-Z")
        local = F.lower(F.substring_index(value, "@", 1))
        is_iban = ~value.contains("@") & F.length(symbols).between(15, 34) & (remainder_97(symbols) == 1)
        return F.when(value.contains("@") & local.rlike("[0-9a-z]"), "email").when(is_iban, "iban")
    four = F.split(value, r"\.")
    is_ip = value.rlike(f"^{_IP}$") & F.forall(four, lambda x: F.coalesce(x.try_cast("int"), F.lit(999)) <= 255)
    dated = value.rlike(f"^(?:{_YEAR_FIRST}|{_DAY_FIRST})$")
    area, group, serial = (_part(value, _SSN_FORM, g) for g in (1, 2, 3))
    is_ssn = value.rlike(_SSN_FORM) & area.between(1, 899) & (area != 666) & (group >= 1) & (serial >= 1)
    is_phone = value.rlike(f"^(?:{_PHONE}|{_PLUS}|{_TEN})$")
    return (
        F.when(is_ip, "ip")
        .when(dated & F.coalesce(_day(value, "year"), _day(value, "day")).isNotNull(), "date")
        .when(dated & _day(value, "month").isNotNull(), MONTH_FIRST)
        .when(is_ssn, "ssn")
        .when(is_phone, "phone")
    )


def _replaced(kind: Column, value: Column, kinds: tuple[str, ...], key: str, inverse: bool) -> Column:
    """struct(kind, value): the pseudonym of a value of a known kind."""
    new = F.lit(None).cast("string")
    for name in kinds:
        new = F.when(kind == name, _rewritten(name, value, key, inverse)).otherwise(new)
    return F.struct(kind.alias("kind"), F.when(kind.isNull(), value).otherwise(new).alias("value"))


FIRST_KINDS, REST_KINDS = ("email", "iban"), ("ip", "date", MONTH_FIRST, "ssn", "phone")


def _matched(df: DataFrame, name: str, pattern: str, first: bool, key: str, inverse: bool) -> DataFrame:
    """Column ``_text`` with a mark in place of every valid match, and their pseudonyms in the column ``name``."""
    marked = F.regexp_replace("_text", pattern, f"{CUT}$0{CUT}")
    kinds = FIRST_KINDS if first else REST_KINDS

    def piece(x: Column, i: Column) -> Column:
        plain = F.struct(F.lit(None).cast("string").alias("kind"), x.alias("value"))
        told = F.transform(F.array(_kind_of(x, first)), lambda kind: _replaced(kind, x, kinds, key, inverse))
        return F.when(F.pmod(i, F.lit(2)) == 1, F.element_at(told, 1)).otherwise(plain)

    done = computed(computed(df, "_cut", F.split(marked, CUT, -1)), "_done", F.transform("_cut", piece))
    return _kept(done, name)


def _kept(done: DataFrame, name: str) -> DataFrame:
    """The marked text and the pseudonyms of ``_done``, an array of (kind, value)."""
    mark = ESCAPE + PLACES[name]
    text = F.array_join(F.transform("_done", lambda x: F.when(x["kind"].isNull(), x["value"]).otherwise(F.lit(mark))), "")
    values = F.filter("_done", lambda x: x["kind"].isNotNull())
    return done.select(*[c for c in done.columns if c not in ("_text", "_cut", "_done")], text.alias("_text"), values.alias(name))


def _cards_of(run: Column, key: str, inverse: bool) -> Column:
    """Array of (kind, value): the cards of a run of digit groups and what lies between them.

    Cards are looked for from left to right, at every group, and do not overlap.
    """

    def joined(groups: Column, at: Column, n: Column) -> Column:
        return F.regexp_replace(F.array_join(F.slice(groups, at + 1, n), ""), "[ -]$", "")

    def valid(groups: Column, at: Column) -> Column:
        """Groups of the card that begins at a group, 0 for none."""
        found = F.lit(0)
        for n in reversed(CARD_GROUPS):
            text = joined(groups, at, F.lit(n))
            fits = (at + n <= F.size(groups)) & text.rlike(_CARD) & (F.pmod(luhn_sum(_only(text, "0-9")), F.lit(10)) == 0)
            found = F.when(fits, F.lit(n)).otherwise(found)
        return found

    def chosen(groups: Column) -> Column:
        starts = F.filter(
            F.transform(groups, lambda _, i: F.struct(i.alias("at"), valid(groups, i).alias("n"))), lambda x: x["n"] > 0
        )
        kind = "array<struct<at:int,n:int,before:int>>"

        def take(state: Column, x: Column) -> Column:
            card = F.struct(x["at"].alias("at"), x["n"].alias("n"), state["end"].alias("before"))
            more = F.struct((x["at"] + x["n"]).alias("end"), F.concat(state["cards"], F.array(card)).alias("cards"))
            return F.when(x["at"] >= state["end"], more).otherwise(state)

        def chunk(state: Column, some: Column) -> Column:
            own = F.aggregate(some, F.struct(state["end"].alias("end"), F.array().cast(kind).alias("cards")), take)
            joined_ = F.transform(F.array(own), lambda x: F.struct(x["end"].alias("end"), F.concat(state["cards"], F.array(x["cards"])).alias("cards")))
            return F.element_at(joined_, 1)

        # Lists grow within chunks and chunk by chunk, so that a long run is not copied for every card.
        def chunked(every: Column) -> Column:
            last = F.ceil(F.size(every) / CHUNK).cast("int")
            return F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(every, c * CHUNK + 1, F.lit(CHUNK)))

        chunks = F.flatten(F.transform(F.array(starts), chunked))
        none = F.struct(F.lit(0).alias("end"), F.array().cast(f"array<{kind}>").alias("cards"))
        return F.aggregate(chunks, none, chunk, lambda state: F.struct(state["end"].alias("end"), F.flatten(state["cards"]).alias("cards")))

    def pieces(groups: Column, state: Column) -> Column:
        def around(x: Column) -> Column:
            text = F.array_join(F.slice(groups, x["at"] + 1, x["n"]), "")
            value = F.regexp_replace(text, "[ -]$", "")
            before = F.array_join(F.slice(groups, x["before"] + 1, x["at"] - x["before"]), "")
            return F.array(
                F.struct(F.lit(None).cast("string").alias("kind"), before.alias("value")),
                F.struct(F.lit("card").alias("kind"), _card(value, key, inverse).alias("value")),
                F.struct(F.lit(None).cast("string").alias("kind"), F.substring(text, F.length(value) + 1, F.lit(1)).alias("value")),
            )

        after = F.array_join(F.slice(groups, state["end"] + 1, F.size(groups)), "")
        rest = F.array(F.struct(F.lit(None).cast("string").alias("kind"), after.alias("value")))
        return F.concat(F.flatten(F.transform(state["cards"], around)), rest)

    groups = F.regexp_extract_all(run, F.lit("([0-9]+[ -]?)"), 1)
    each = F.transform(F.array(groups), lambda g: F.transform(F.array(chosen(g)), lambda state: pieces(g, state)))
    return F.flatten(F.flatten(each))


def _carded(df: DataFrame, key: str, inverse: bool) -> DataFrame:
    marked = F.regexp_replace("_text", _RUN, f"{CUT}$0{CUT}")

    def piece(x: Column, i: Column) -> Column:
        plain = F.array(F.struct(F.lit(None).cast("string").alias("kind"), x.alias("value")))
        return F.when(F.pmod(i, F.lit(2)) == 1, _cards_of(x, key, inverse)).otherwise(plain)

    cut = computed(df, "_cut", F.split(marked, CUT, -1))
    return _kept(computed(cut, "_done", F.flatten(F.transform("_cut", piece))), "cards")


def pseudonymise(docs: DataFrame, key: str, text: str = "text", inverse: bool = False, spans: str | None = None) -> DataFrame:
    """``docs`` with ``text`` rewritten, and n_email, n_iban, n_ip, n_date, n_ssn, n_phone and n_card.

    A null text stays null and holds nothing; an empty text stays empty; all that is no valid value stays as it is. Rows are
    rewritten one by one, so repeated rows stay equal. ``spans`` names a column for the pseudonyms' (kind, start,
    length) in the new text, from 0, with which ``restored`` undoes the permutation exactly. ``inverse`` undoes it without
    spans, where nothing beside a pseudonym makes another number valid. The letters of an email come back in lower
    case. Columns of ``docs`` with the names of results are replaced.
    """
    if not key:
        raise ValueError("pseudonyms need a key")
    started = packed(docs, text).withColumn("_text", F.replace(F.col(TEXT), F.lit(ESCAPE), F.lit(ESCAPED)))
    done = _matched(started, "first", FIRST_PATTERN, True, key, inverse)
    done = _carded(done, key, inverse)
    done = _matched(done, "rest", REST_PATTERN, False, key, inverse)

    # The pseudonyms of all three readings in the order of their marks.
    marks = "".join(PLACES.values())
    done = computed(done, "_marks", F.regexp_extract_all("_text", F.lit(f"{ESCAPE}([{marks}])"), 1))
    at = F.transform("_marks", lambda c, i: F.struct(c.alias("c"), i.alias("i")))

    def placed(name: str, mark: str) -> Column:
        own = F.filter(at, lambda x: x["c"] == F.lit(mark))
        return F.zip_with(own, F.col(name), lambda x, y: F.struct(x["i"].alias("i"), y.alias("x")))

    ordered = F.array_sort(F.concat(*[placed(name, mark) for name, mark in PLACES.items()]))
    done = computed(done, "_values", F.transform(ordered, lambda y: y["x"]))
    plain = F.transform(F.split("_text", f"{ESCAPE}[{marks}]", -1), lambda x: F.replace(x, F.lit(ESCAPED), F.lit(ESCAPE)))
    done = computed(done, "_plain", plain)
    value = F.transform("_plain", lambda x, i: F.concat(x, F.coalesce(F.try_element_at("_values", i + 1)["value"], F.lit(""))))
    results = {text: F.array_join(value, "")}
    for kind in KINDS:
        results[f"n_{kind}"] = _count(F.col("_values"), kind)
    if spans:
        results[spans] = _spans(F.col("_plain"), F.col("_values"))
    return unpacked(done, docs, text, results)


def _count(values: Column, kind: str) -> Column:
    return F.coalesce(F.size(F.filter(values, lambda x: (x["kind"] == kind) | ((x["kind"] == MONTH_FIRST) & F.lit(kind == "date")))), F.lit(0)).cast("bigint")


def _spans(plain: Column, values: Column) -> Column:
    kind = "array<struct<kind:string,start:int,length:int>>"
    none = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("spans"))
    steps = F.transform(values, lambda x, i: F.struct(F.length(F.element_at(plain, i + 1)).alias("before"), F.length(x["value"]).alias("own"), x["kind"].alias("kind")))

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + x["before"]
        span = F.struct(x["kind"].alias("kind"), start.alias("start"), x["own"].alias("length"))
        return F.struct((start + x["own"]).alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    return F.coalesce(F.aggregate(steps, none, add, lambda state: state["spans"]), F.array().cast(kind))


def restored(docs: DataFrame, key: str, spans: str, text: str = "text") -> DataFrame:
    """``docs`` with the values that ``pseudonymise`` replaced with ``key``; emails are in lower case."""
    kinds = (*FIRST_KINDS, *REST_KINDS, "card")

    def back(x: Column, i: Column) -> Column:
        before = F.when(i == 0, 0).otherwise(F.try_element_at(F.col(spans), i)["start"] + F.try_element_at(F.col(spans), i)["length"])
        value = F.substring(F.col(text), x["start"] + 1, x["length"])
        return F.concat(F.substring(F.col(text), before + 1, x["start"] - before), _replaced(x["kind"], value, kinds, key, True)["value"])

    last = F.try_element_at(F.col(spans), F.lit(-1))
    rest = F.substring(F.col(text), F.coalesce(last["start"] + last["length"], F.lit(0)) + 1, F.length(text))
    whole = F.concat(F.array_join(F.transform(spans, back), ""), rest)
    return docs.withColumn(text, whole)
