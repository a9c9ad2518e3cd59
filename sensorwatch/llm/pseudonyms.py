"""Format-preserving pseudonyms by a keyed Feistel network.

Numbers and dates that are valid in their format are replaced by others valid in it: card numbers (Luhn), national numbers (area, group and
serial not zero), telephone numbers, IPv4 addresses, ISO and day-first dates, and the local part and host of e-mail addresses. The map is a keyed
permutation of each format's values, so equal values get equal pseudonyms in every document, unequal ones unequal ones, and the holder
of the key can undo it. Separators and lengths stay.

A value's variable digits are split in two halves; each of ROUNDS rounds adds a keyed hash of one half to the other, modulo its range.
Card numbers keep their first digit and get a new check digit; dates are permuted as day numbers of 1900 to 2099, national numbers digit group by
digit group over the valid ranges. Values of a range that is no power of ten are walked along the permutation's cycle into it.

Only DataFrame functions run here. Texts without a candidate are passed through after one search.

Defined cases: a null text stays null, with no values; a candidate that is not valid in its format stays as it is. Repeated rows come back as often
as they are given. The key is a parameter: a production key comes from the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorwatch.llm.common import with_once

ROUNDS = 8
#: Patterns of the formats, tried in this order at each place.
CARD = r"\d(?:[ -]?\d){12,18}"
PHONE = r"(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}"
NATIONAL = r"\d{3}-\d{2}-\d{4}"
IP = r"\d{1,3}(?:\.\d{1,3}){3}"
ISO_DATE = r"\d{4}-\d{2}-\d{2}"
DAY_DATE = r"\d{2}[./]\d{2}[./]\d{4}"
MAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
CANDIDATE = rf"(?<![\w.+-])(?:{MAIL}|{ISO_DATE}|{DAY_DATE}|{NATIONAL}|{PHONE}|{IP}|{CARD})(?![\w-]|\.\d)"
FIRST_DAY, LAST_DAY = "1900-01-01", "2099-12-31"
DAYS = 73_049


def _mark(key: str, tweak: str, turn: Column, half: Column) -> Column:
    """A keyed hash as a number below 16^14."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), turn.cast("string"), half.cast("string"), F.lit(key)), 256)
    return F.conv(F.substring(digest, 1, 14), 16, 10).cast("long")


def feistel(value: Column, low: Column, high: Column, key: str, tweak: str) -> Column:
    """A keyed permutation of 0 <= value < low * high: value = a * low + b, with a < high and b < low in turn changed by the other."""

    def turn(state: Column, k: Column) -> Column:
        a, b = state["a"], state["b"]
        even = k % 2 == 0
        new_a = F.when(even, F.pmod(a + _mark(key, tweak, k, b), high)).otherwise(a)
        new_b = F.when(even, b).otherwise(F.pmod(b + _mark(key, tweak, k, a), low))
        return F.struct(new_a.alias("a"), new_b.alias("b"))

    start = F.struct(F.floor(value / low).cast("long").alias("a"), F.pmod(value, low).cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: s["a"] * low + s["b"])


def digits_permuted(digits: Column, key: str, tweak: str) -> Column:
    """A keyed permutation of the digit strings of each length, up to 18 digits; halves are read apart, so no number outgrows a long."""
    left, right = (F.length(digits) / 2).cast("int"), F.length(digits) - (F.length(digits) / 2).cast("int")
    power = lambda n: F.pow(F.lit(10.0), n).cast("long")

    def turn(state: Column, k: Column) -> Column:
        a, b = state["a"], state["b"]
        even = k % 2 == 0
        length = F.concat_ws(",", F.lit(tweak), F.length(digits).cast("string"), b.cast("string"))
        back = F.concat_ws(",", F.lit(tweak), F.length(digits).cast("string"), a.cast("string"))
        new_a = F.when(even, F.pmod(a + _mark(key, tweak, k, length), power(left))).otherwise(a)
        new_b = F.when(even, b).otherwise(F.pmod(b + _mark(key, tweak, k, back), power(right)))
        return F.struct(new_a.alias("a"), new_b.alias("b"))

    number = lambda start, n: F.coalesce(F.substring(digits, start, n).cast("long"), F.lit(0).cast("long"))
    start = F.struct(number(F.lit(1), left).alias("a"), number(left + 1, right).alias("b"))
    text = lambda s: F.concat(F.when(left > 0, F.lpad(s["a"].cast("string"), left, "0")).otherwise(""), F.lpad(s["b"].cast("string"), right, "0"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, text)


def _walked(value: Column, low: int, high: int, size: int, key: str, tweak: str) -> Column:
    """A permutation of 0 <= value < size by that of low * high >= size: it is applied until the result is below size."""
    apply = lambda v: feistel(v, F.lit(low).cast("long"), F.lit(high).cast("long"), key, tweak)
    step = lambda v, k: F.when((k > 0) & (v < size), v).otherwise(apply(v))
    return F.aggregate(F.sequence(F.lit(0), F.lit(40)), value.cast("long"), step)


def luhn_sum(digits: Column) -> Column:
    """Luhn's sum, the last digit counted once."""
    n = F.length(digits)
    each = F.transform(F.sequence(F.lit(1), n), lambda k: _luhn_value(F.substring(digits, k, F.lit(1)).cast("int"), (n - k) % 2 == 1))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b)


def _luhn_value(digit: Column, doubled: Column) -> Column:
    return F.when(doubled, F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)).otherwise(digit)


def _fill(shape: Column, digits: Column) -> Column:
    """shape with its digits replaced, in order."""
    places = F.split(shape, "")
    start = F.struct(F.lit("").alias("text"), F.lit(1).alias("at"))
    is_digit = lambda c: c.rlike("^[0-9]$")
    put = lambda s, c: F.struct(F.concat(s["text"], F.when(is_digit(c), F.substring(digits, s["at"], F.lit(1))).otherwise(c)).alias("text"), (s["at"] + is_digit(c).cast("int")).alias("at"))
    return F.aggregate(places, start, put, lambda s: s["text"])


def _card(value: Column, key: str) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    body = F.concat(F.substring(digits, 1, 1), digits_permuted(F.substring(digits, F.lit(2), n - 2), key, "card"))
    check = F.pmod(10 - luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10)).cast("string")
    return F.when((luhn_sum(digits) % 10 == 0) & (F.regexp_replace(digits, "0", "") != ""), _fill(value, F.concat(body, check)))


def _phone(value: Column, key: str) -> Column:
    """The subscriber's seven digits are permuted; country and area stay valid as they are."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    kept = F.length(digits) - 7
    return _fill(value, F.concat(F.substring(digits, F.lit(1), kept), digits_permuted(F.substring(digits, kept + 1, F.lit(7)), key, "phone")))


def _national(value: Column, key: str) -> Column:
    """Area 001-899 without 666, group 01-99, serial 0001-9999: 898 * 99 * 9999 values."""
    part = lambda start, n: F.substring(value, start, n).cast("long")
    area, group, serial = part(1, 3), part(5, 2), part(8, 4)
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    number = ((area - 1 - (area > 666).cast("long")) * 99 + group - 1) * 9999 + serial - 1
    new = _walked(number, 29_820, 29_820, 898 * 99 * 9999, key, "national")
    new_area = F.floor(new / (99 * 9999)) + 1
    new_area = new_area + (new_area >= 666).cast("long")
    pad = lambda x, n: F.lpad(x.cast("long").cast("string"), n, "0")
    return F.when(valid, F.concat_ws("-", pad(new_area, 3), pad(F.floor(new / 9999) % 99 + 1, 2), pad(new % 9999 + 1, 4)))


def _ip(value: Column, key: str) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda x: x.cast("long"))
    valid = F.forall(parts, lambda x: x < 256)
    number = F.aggregate(parts, F.lit(0).cast("long"), lambda a, b: a * 256 + b)
    new = feistel(number, F.lit(65536).cast("long"), F.lit(65536).cast("long"), key, "ip")
    octet = lambda n: (F.floor(new / n).cast("long") % 256).cast("string")
    return F.when(valid, F.concat_ws(".", octet(1 << 24), octet(1 << 16), octet(1 << 8), octet(1)))


def _date(value: Column, pattern: str, key: str) -> Column:
    day = F.try_to_date(value, pattern)
    valid = day.between(F.to_date(F.lit(FIRST_DAY)), F.to_date(F.lit(LAST_DAY)))
    new = _walked(F.date_diff(day, F.to_date(F.lit(FIRST_DAY))), 271, 271, DAYS, key, "date")
    return F.when(valid, F.date_format(F.date_add(F.to_date(F.lit(FIRST_DAY)), new.cast("int")), pattern))


def _mail(value: Column, key: str) -> Column:
    """Letters become letters and digits digits, chunk by chunk, each chunk of up to eight characters permuted under a tweak of its place.

    The chunks' ranges are 26^4 * 26^4 and so on: as letters and digits are counted apart, a pseudonym has the format of its value.
    """
    lower = F.lower(value)
    local, host = F.substring_index(lower, "@", 1), F.substring_index(lower, "@", -1)
    return F.concat(_letters(local, key, "local"), F.lit("@"), _letters(F.regexp_replace(host, r"\.[a-z]+$", ""), key, "host"), F.regexp_extract(host, r"\.[a-z]+$", 0))


def _letters(text: Column, key: str, tweak: str) -> Column:
    """Every letter and digit shifted within its kind by a keyed hash of all others: a Feistel network over even and odd places."""
    size = lambda c: F.when(c.rlike("^[a-z]$"), 26).when(c.rlike("^[0-9]$"), 10)
    base = lambda c: F.when(c.rlike("^[a-z]$"), 97).otherwise(48)

    def turn(state: Column, k: Column) -> Column:
        other = F.array_join(F.filter(state, lambda c, i: i % 2 != k % 2), "")
        whole = F.concat_ws(",", F.size(state).cast("string"), other)
        shift = lambda i: _mark(key, tweak, k, F.concat_ws(",", whole, i.cast("string")))
        moved = lambda c, i: F.chr((F.pmod(F.ascii(c) - base(c) + shift(i), size(c)) + base(c)).cast("long"))
        return F.transform(state, lambda c, i: F.when((i % 2 == k % 2) & size(c).isNotNull(), moved(c, i)).otherwise(c))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.split(text, ""), turn, lambda s: F.array_join(s, ""))


def pseudonym(value: Column, key: str) -> Column:
    """(kind, text) of a candidate's pseudonym; null for one that is not valid."""
    formats = [
        ("mail", MAIL, _mail), ("date", ISO_DATE, lambda v, k: _date(v, "yyyy-MM-dd", k)),
        ("date", r"\d{2}/\d{2}/\d{4}", lambda v, k: _date(v, "dd/MM/yyyy", k)), ("date", r"\d{2}\.\d{2}\.\d{4}", lambda v, k: _date(v, "dd.MM.yyyy", k)),
        ("national", NATIONAL, _national), ("phone", PHONE, _phone), ("ip", IP, _ip), ("card", CARD, _card),
    ]
    kind, text = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, pattern, make in reversed(formats):
        fits = value.rlike(f"^(?:{pattern})$")
        kind, text = F.when(fits, F.lit(name)).otherwise(kind), F.when(fits, make(value, key)).otherwise(text)
    return F.struct(kind.alias("kind"), text.alias("text"))


def pseudonymised(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """docs with the text rewritten, `n_replaced`, and `replaced`: kind and pseudonym of each value, in order of place."""
    text = F.col(text_col)
    rows = with_once(docs, _found=F.when(text.rlike(CANDIDATE), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))))
    rows = with_once(rows, _new=F.transform("_found", lambda v: pseudonym(v, key)))
    around = F.split(text, CANDIDATE, -1)
    shown = F.zip_with("_new", "_found", lambda n, v: F.coalesce(n["text"], v))
    built = F.concat(F.array_join(F.zip_with(F.slice(around, F.lit(1), F.size("_found")), shown, lambda a, b: F.concat(a, b)), ""), F.element_at(around, -1))
    none = F.array().cast("array<struct<kind:string,text:string>>")
    rows = rows.withColumn("replaced", F.coalesce(F.filter("_new", lambda n: n["text"].isNotNull()), none))
    rows = rows.withColumn("n_replaced", F.size("replaced").cast("long"))
    return rows.withColumn(text_col, F.when(F.col("_found").isNotNull(), built).otherwise(text)).drop("_found", "_new")
