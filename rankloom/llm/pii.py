"""Format-preserving pseudonyms for personal data, in column expressions only.

A text is split at everything that looks like personal data. What is found is checked
(card check digits, bank account check digits, address ranges, calendar dates) and, if
valid, permuted within its own format by a keyed Feistel network: equal values get equal
pseudonyms in every document, different values of a kind different ones, and a pseudonym
is again a valid value of its kind. Everything else of the text stays as it is.

A value is turned into a pair of numbers (x, y) with x < a and y < b, where a * b is the
exact number of values that its format allows; the network adds keyed hashes of one to the
other, modulo a or b, in turn. That is a permutation of the format's values, with none to
be walked over. Letters-and-digits values (mail names, account numbers, keys) are halved,
and each character of a half moves within its class (digit, lower case, upper case).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import prepare

ROUNDS = 8
KEY = "change-this-key"

#: The patterns of what is looked for. The first that fits at a place is taken.
EMAIL = r"(?<![\w.%+-])[A-Za-z0-9_%+-](?:[A-Za-z0-9._%+-]{0,63})@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62})(?:\.[A-Za-z0-9-]{1,63})++"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
DATE = r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\d/-]|\.\d)"
ADDRESS = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)"
PHONE = r"(?<![\d+])\+1[ .-]?\(?[2-9]\d{2}\)?[ .-]?[2-9]\d{2}[ .-]?\d{4}(?!\d)"
SOCIAL = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
CARD = r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-])"
ACCESS_KEY = r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])"
SECRET = r"(?<![A-Za-z0-9_])(?:password|passwd|secret|token|api_key)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9]{8,128}(?![A-Za-z0-9])"
KINDS = {
    "email": EMAIL, "date": DATE, "phone": PHONE, "social": SOCIAL, "address": ADDRESS, "card": CARD,
    "access_key": ACCESS_KEY, "secret": SECRET, "iban": IBAN,
}
ANY = "|".join(KINDS.values())
#: Every kind holds one of these; texts without are not looked at closer.
HINT = r"[0-9@]|password|passwd|secret|token|api_key"
#: The Gregorian calendar's 400 years from 1700: 146,097 = 189 * 773 days.
DAYS, FIRST_DAY = (189, 773), "1700-01-01"


# ------------------------------------------------------------------ the networks
def _chars(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def _hash(key: str, kind: str, turn: Column, other: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), other.cast("string")), 256)


def permuted(x: Column, y: Column, a: Column | int, b: Column | int, key: str, kind: str) -> Column:
    """(x, y) -> another pair with x < a and y < b, one to one. Both below 10^17."""
    a, b = (F.lit(m).cast("long") if isinstance(m, int) else m for m in (a, b))

    def turn(pair: Column, n: Column) -> Column:
        def added(value: Column, other: Column, modulus: Column) -> Column:
            drawn = F.conv(F.substring(_hash(key, kind, n, other), 1, 15), 16, 10).cast("long")
            return F.pmod(value + F.pmod(drawn, modulus), modulus)

        even = n % 2 == 0
        return F.struct(
            F.when(even, added(pair["x"], pair["y"], a)).otherwise(pair["x"]).alias("x"),
            F.when(even, pair["y"]).otherwise(added(pair["y"], pair["x"], b)).alias("y"),
        )

    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def shuffled(value: Column, key: str, kind: str) -> Column:
    """Letters and digits moved within their classes; other characters and the length stay."""

    def moved(half: Column, other: Column, n: Column) -> Column:
        drawn = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), n.cast("string"), other), 512)

        def move(char: Column, i: Column) -> Column:
            by = F.conv(F.substr(drawn, (i % 32 * 4 + 1).cast("int"), F.lit(4)), 16, 10).cast("long")

            def of(first: str, size: int) -> Column:
                return F.char((F.lit(ord(first)) + F.pmod(F.ascii(char) - ord(first) + by, F.lit(size))).cast("long"))

            return (
                F.when(char.between("0", "9"), of("0", 10)).when(char.between("a", "z"), of("a", 26))
                .when(char.between("A", "Z"), of("A", 26)).otherwise(char)
            )

        return F.array_join(F.transform(_chars(half), move), "")

    def turn(pair: Column, n: Column) -> Column:
        even = n % 2 == 0
        return F.struct(
            F.when(even, moved(pair["x"], pair["y"], n)).otherwise(pair["x"]).alias("x"),
            F.when(even, pair["y"]).otherwise(moved(pair["y"], pair["x"], n)).alias("y"),
        )

    middle = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substr(value, F.lit(1), middle).alias("x"), F.substr(value, middle + 1).alias("y"))
    pair = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)
    return F.concat(pair["x"], pair["y"])


# ----------------------------------------------------------------------- formats
def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def _refilled(value: Column, new: Column, kept: str) -> Column:
    """``value`` with the characters outside ``kept`` replaced by ``new``'s, one after the other."""
    fixed = F.regexp_replace(value, f"[^{kept}]", "")

    def step(state: Column, char: Column) -> Column:
        own = char.rlike(f"^[{kept}]$")
        taken = F.when(own, char).otherwise(F.substr(new, state["at"], F.lit(1)))
        return F.struct(F.concat(state["out"], taken).alias("out"), (state["at"] + F.when(own, 0).otherwise(1)).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    return F.when(fixed == "", new).otherwise(F.aggregate(_chars(value), start, step)["out"])


def _padded(number: Column, width: int | Column) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def luhn_sum(digits: Column) -> Column:
    """The check sum of a card number's digits; 0 modulo 10 if they are valid."""
    doubled = F.transform(
        F.reverse(_chars(digits)),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)),
    )
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + d)


def _card(value: Column, key: str) -> Column:
    digits = _digits(value)
    free = F.length(digits) - 2  # the first digit tells the kind of card, the last one checks
    left = F.floor(free / 2).cast("int")
    power = [F.pow(F.lit(10.0), n).cast("long") for n in (left, free - left)]
    x, y = F.substr(digits, F.lit(2), left), F.substr(digits, left + 2, free - left)
    pair = permuted(x.cast("long"), y.cast("long"), *power, key, "card")
    body = F.concat(F.substr(digits, F.lit(1), F.lit(1)), _padded(pair["x"], left), _padded(pair["y"], (free - left).cast("int")))
    check = F.pmod(F.lit(10) - luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10))
    return F.when(luhn_sum(digits) % 10 == 0, _refilled(value, F.concat(body, check.cast("string")), " -"))


def _phone(value: Column, key: str) -> Column:
    digits = _digits(value)
    area = F.substr(digits, F.lit(2), F.lit(3)).cast("long") - 200
    rest = F.substr(digits, F.lit(5)).cast("long") - 2_000_000
    pair = permuted(area, rest, 800, 8_000_000, key, "phone")
    return _refilled(value, F.concat(F.lit("1"), (pair["x"] + 200).cast("string"), (pair["y"] + 2_000_000).cast("string")), " .()+-")


def _social(value: Column, key: str) -> Column:
    part = [F.substr(value, F.lit(at), F.lit(n)).cast("long") for at, n in ((1, 3), (5, 2), (8, 4))]
    valid = part[0].between(1, 899) & (part[0] != 666) & (part[1] > 0) & (part[2] > 0)
    area = part[0] - 1 - F.when(part[0] > 666, 1).otherwise(0)
    pair = permuted(area, (part[1] - 1) * 9999 + part[2] - 1, 898, 99 * 9999, key, "social")
    new_area = pair["x"] + 1 + F.when(pair["x"] >= 665, 1).otherwise(0)
    group, serial = F.floor(pair["y"] / 9999) + 1, pair["y"] % 9999 + 1
    return F.when(valid, F.concat_ws("-", _padded(new_area, 3), _padded(group, 2), _padded(serial, 4)))


def _address(value: Column, key: str) -> Column:
    part = [F.split_part(value, F.lit("."), F.lit(i)).cast("long") for i in range(1, 5)]
    # without leading zeros, so that equal addresses are written alike
    valid = ~value.rlike(r"(?:^|\.)0\d") & (F.greatest(*part) <= 255)
    pair = permuted(part[0] * 256 + part[1], part[2] * 256 + part[3], 65_536, 65_536, key, "address")
    new = [F.floor(pair["x"] / 256), pair["x"] % 256, F.floor(pair["y"] / 256), pair["y"] % 256]
    return F.when(valid, F.concat_ws(".", *[n.cast("string") for n in new]))


def _date(value: Column, key: str) -> Column:
    def form(pattern: str) -> Column:
        day = F.try_to_timestamp(value, F.lit(pattern)).cast("date")
        number = F.date_diff(day, F.lit(FIRST_DAY).cast("date")).cast("long")
        pair = permuted(F.floor(number / DAYS[1]), number % DAYS[1], *DAYS, key, "date")
        new = F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (pair["x"] * DAYS[1] + pair["y"]).cast("int")), pattern)
        return F.when(number.between(0, DAYS[0] * DAYS[1] - 1), new)

    return F.when(value.contains("-"), form("yyyy-MM-dd")).when(value.contains("/"), form("MM/dd/yyyy")).otherwise(form("dd.MM.yyyy"))


def _email(value: Column, key: str) -> Column:
    name, host = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    return F.concat(shuffled(name, key, "email"), F.lit("@"), host)


def _iban_rest(account: Column, country: Column) -> Column:
    """97's remainder of an account number followed by its country and two zeros."""
    chars = _chars(F.concat(account, country, F.lit("00")))

    def step(rest: Column, char: Column) -> Column:
        letter = F.ascii(char) - 55
        return F.when(char.between("0", "9"), (rest * 10 + char.try_cast("int")) % 97).otherwise((rest * 100 + letter) % 97)

    return F.aggregate(chars, F.lit(0), step)


def _iban(value: Column, key: str) -> Column:
    plain = F.regexp_replace(value, " ", "")
    country, account = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5))
    valid = 98 - _iban_rest(account, country) == F.substr(plain, F.lit(3), F.lit(2)).cast("int")
    new = shuffled(account, key, "iban")
    check = _padded(98 - _iban_rest(new, country), 2)
    return F.when(valid, _refilled(value, F.concat(country, check, new), " "))


def _access_key(value: Column, key: str) -> Column:
    return F.concat(F.lit("AKIA"), shuffled(F.substr(value, F.lit(5)), key, "access_key"))


def _secret(value: Column, key: str) -> Column:
    own = F.regexp_extract(value, "[A-Za-z0-9]+$", 0)
    return F.concat(F.substr(value, F.lit(1), F.length(value) - F.length(own)), shuffled(own, key, "secret"))


PSEUDONYMS: dict[str, Callable[[Column, str], Column]] = {
    "email": _email, "date": _date, "phone": _phone, "social": _social, "address": _address, "card": _card,
    "access_key": _access_key, "secret": _secret, "iban": _iban,
}


def pseudonym(found: Column, key: str = KEY) -> Column:
    """The pseudonym of a value that was found; null if it is not valid."""
    whole = {kind: found.rlike(rf"\A(?:{pattern})\z") for kind, pattern in KINDS.items()}
    out = None
    for kind, make in PSEUDONYMS.items():
        out = F.when(whole[kind], make(found, key)) if out is None else out.when(whole[kind], make(found, key))
    return out


# ------------------------------------------------------------------------- texts
def _rebuilt(text: Column, key: str) -> Column:
    """(text, n): the text with pseudonyms, and how many values were replaced."""
    gaps, values = F.split(text, ANY, -1), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    new = F.transform(values, lambda v: F.struct(v.alias("old"), pseudonym(v, key).alias("new")))

    def kept(pairs: Column) -> Column:
        said = F.concat(F.array(F.lit("")), F.transform(pairs, lambda p: F.coalesce(p["new"], p["old"])))
        replaced = F.size(F.filter(pairs, lambda p: p["new"].isNotNull()))
        joined = F.array_join(F.zip_with(said, gaps, lambda v, gap: F.concat(v, gap)), "")
        return F.struct(joined.alias("text"), replaced.alias("n"))

    # a transform over one element names the pairs, so they are made once
    return F.element_at(F.transform(F.array(new), kept), 1)


def replaced(text: Column, key: str = KEY) -> Column:
    """Struct (text, n) of a text column: its pseudonymised form and the number of values replaced."""
    text = text.cast("string")
    found = F.when(text.rlike(HINT) & text.rlike(ANY), _rebuilt(text, key))
    return F.coalesce(found, F.struct(text.alias("text"), F.lit(0).alias("n")))


def pseudonymised(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; all columns, in their order.

    No row comes or goes, and rows with equal texts get equal texts. Null texts stay null,
    empty ones empty. ``n_chars``, where there is one, is the new text's length. Dates from
    1700 to 2099 count; numbers that fail their check are not personal data and stay.
    """
    prepare(docs.sparkSession)
    if "text" not in docs.columns:
        raise ValueError("there is no column text")
    new = replaced(docs["text"], key)["text"]
    changed = {"text": new, "n_chars": F.length(new).cast("long")}
    return docs.select(*[changed[c].alias(c) if c in changed else docs[c] for c in docs.columns])


def report(docs: DataFrame, key: str = KEY) -> DataFrame:
    """(doc_id, text, n_replaced), one for each row of ``docs``."""
    prepare(docs.sparkSession)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), replaced(docs["text"], key).alias("r"))
    return rows.select("doc_id", F.col("r.text").alias("text"), F.col("r.n").cast("long").alias("n_replaced"))
