"""Format-preserving Feistel pseudonyms for personal numbers, dates, addresses and secrets.

Each text is cut at what looks like a value; each candidate is validated (Luhn, octets, calendar, lengths)
and, if valid, replaced by its image under a keyed permutation of its own format: a card stays a card with
a right check digit, a date a date. The permutation depends on the key and the digits only, so equal values
stay linked across documents, however they are spaced, and two values never share a pseudonym of one format.

Feistel networks add a keyed hash of one half to the other, modulo the half's own size, so no cycle walking
is needed: pairs of numbers for cards, telephones, IPv4, SSN and dates, vectors of characters for the local
parts of e-mail addresses and for hexadecimal secrets.

The key is the caller's secret: who has it can undo the pseudonyms. Repetitions in the patterns are bounded or of
single characters, so that no text exhausts the stack: a domain has at most 127 labels before its last.

Defined results: null text stays null with 0 values; invalid candidates, dates outside the years 102 to
9893, and hexadecimal runs of more than 128 digits or of mixed case, stay as they are; dates of the form 99/99/9999 are read day first, month first only if that is no
date; whole texts are scanned; rows that repeat each give a row; all columns of docs are kept and
n_pseudonyms is added (an own column of that name is replaced). Only built-in functions are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

# The formats, in the order in which they are tried.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){0,126}\.[A-Za-z]{2,}"
HEX = r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}+|[0-9A-F]{32,128}+)(?![0-9A-Za-z])"
IPV4 = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
ISO_DATE = r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])"
LOCAL_DATE = r"(?<![0-9/.])[0-9]{2}(?:/[0-9]{2}/|\.[0-9]{2}\.)[0-9]{4}(?![0-9/]|\.[0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = r"(?<![0-9A-Za-z])\+[0-9](?:[ .()-]{0,2}[0-9]){7,14}+(?![0-9])|(?<![0-9A-Za-z])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
CARD = r"(?<![0-9A-Za-z])(?:[0-9]{13,19}+|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9A-Za-z])"
ANY = "|".join((EMAIL, HEX, IPV4, ISO_DATE, LOCAL_DATE, SSN, PHONE, CARD))

#: A block of days that is a product, for a permutation without cycle walking: 250 * 292 days.
DAYS_A, DAYS_B, FIRST_BLOCK, END_BLOCK = 250, 292, -9, 40


def _hash(key: str, tweak: str, k: Column, value: Column, bits: int = 256) -> Column:
    return F.sha2(F.concat(F.lit(f"{key}|{tweak}|"), k.cast("string"), F.lit("|"), value).cast("binary"), bits)


def feistel_pair(key: str, tweak: str, left: Column, right: Column, a: Column, b: Column) -> Column:
    """struct(l, r): a permutation of the pairs with 0 <= left < a and 0 <= right < b."""

    def number(k: Column, value: Column) -> Column:
        return F.conv(F.substring(_hash(key, tweak, k, value.cast("string")), 1, 15), 16, 10).cast("long")

    def turn(at: Column, k: Column) -> Column:
        even = k % 2 == 0
        new_l = F.when(even, (at["l"] + number(k, at["r"]) % a) % a).otherwise(at["l"])
        new_r = F.when(even, at["r"]).otherwise((at["r"] + number(k, at["l"]) % b) % b)
        return F.struct(new_l.alias("l"), new_r.alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), turn)


def feistel_chars(key: str, tweak: str, values: Column, sizes: Column) -> Column:
    """array<int>: a permutation of the vectors with 0 <= values[i] < sizes[i]."""
    n = F.size(values)
    half = F.floor(n / 2).cast("int")
    cut = lambda x: (F.slice(x, F.lit(1), half), F.slice(x, half + 1, n - half))

    def stream(k: Column, other: Column, length: Column) -> Column:
        text = F.array_join(other, ",")
        digits = F.concat(_hash(key, tweak, k, text, 512), _hash(key, tweak + "+", k, text, 512))
        return F.transform(F.slice(F.sequence(F.lit(0), F.lit(63)), F.lit(1), length), lambda j: F.conv(F.substring(digits, 1 + 4 * j, F.lit(4)), 16, 10).cast("int"))

    def turn(at: Column, k: Column) -> Column:
        moved = F.zip_with(at["l"], stream(k, at["r"], F.size(at["l"])), lambda x, y: x + y)
        moved = F.zip_with(moved, at["ls"], lambda x, y: x % y)
        return F.struct(at["r"].alias("l"), at["rs"].alias("ls"), moved.alias("r"), at["ls"].alias("rs"))

    (l, r), (ls, rs) = cut(values), cut(sizes)
    done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(l.alias("l"), ls.alias("ls"), r.alias("r"), rs.alias("rs")), turn)
    return F.concat(done["l"], done["r"])


def _chars(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(text, i, F.lit(1)))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _refill(form: Column, digits: Column) -> Column:
    """form with its digits replaced, in order."""
    place = lambda i: F.length(_digits(F.substring(form, F.lit(1), i)))
    filled = F.transform(F.sequence(F.lit(1), F.length(form)), lambda i: F.when(F.substring(form, i, F.lit(1)).rlike("[0-9]"), F.substring(digits, place(i), F.lit(1))).otherwise(F.substring(form, i, F.lit(1))))
    return F.array_join(filled, "")


def _permuted_digits(key: str, tweak: str, digits: Column) -> Column:
    n = F.length(digits)
    a = F.floor(n / 2).cast("int")
    power = lambda k: F.pow(F.lit(10.0), k).cast("long")
    pair = feistel_pair(key, tweak, F.substring(digits, F.lit(1), a).cast("long"), F.substring(digits, a + 1, n - a).cast("long"), power(a), power(n - a))
    return F.concat(F.lpad(pair["l"].cast("string"), a, F.lit("0")), F.lpad(pair["r"].cast("string"), n - a, F.lit("0")))


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn's sum; doubled: 1 if the last digit counts once, 0 if it counts twice."""
    n = F.length(digits)

    def worth(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return F.when(i % 2 == doubled, twice).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), worth), F.lit(0), lambda s, x: s + x)


def _card(m: Column, key: str) -> Column:
    digits = _digits(m)
    body = _permuted_digits(key, "card", F.substring(digits, F.lit(1), F.length(digits) - 1))
    check = (10 - _luhn_sum(body, 0) % 10) % 10
    return F.when(_luhn_sum(digits, 1) % 10 == 0, _refill(m, F.concat(body, check.cast("string"))))


def _phone(m: Column, key: str) -> Column:
    digits = _digits(m)
    country = F.when(~m.startswith("+"), 0).when(digits.rlike("^[17]"), 1).otherwise(2)
    body = F.substring(digits, country + 1, F.length(digits))
    return F.when(F.length(digits).between(8, 15), _refill(m, F.concat(F.substring(digits, F.lit(1), country), _permuted_digits(key, "phone", body))))


def _ipv4(m: Column, key: str) -> Column:
    parts = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    pair = feistel_pair(key, "ipv4", parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], F.lit(65536), F.lit(65536))
    out = F.concat_ws(".", *[x.cast("string") for half in ("l", "r") for x in (F.floor(pair[half] / 256), pair[half] % 256)])
    return F.when(F.array_max(parts) <= 255, out)


def _moved_day(year: Column, month: Column, day: Column, key: str) -> Column:
    """The date's image, null if it is no date or out of range."""
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    last = F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
    valid = (year >= 1) & month.between(1, 12) & (day >= 1) & (day <= last)
    number = F.when(valid, F.datediff(F.make_date(year, month, day), F.lit("1900-01-01").cast("date")))
    block = F.floor(number / (DAYS_A * DAYS_B)).cast("int")
    within = number - block * (DAYS_A * DAYS_B)
    pair = feistel_pair(key, "date", F.floor(within / DAYS_B), within % DAYS_B, F.lit(DAYS_A), F.lit(DAYS_B))
    moved = (block * (DAYS_A * DAYS_B) + pair["l"] * DAYS_B + pair["r"]).cast("int")
    return F.when((block >= FIRST_BLOCK) & (block < END_BLOCK), F.date_add(F.lit("1900-01-01").cast("date"), moved))


def _number(m: Column, start: int, length: int) -> Column:
    return F.substring(m, start, length).cast("int")


def _iso_date(m: Column, key: str) -> Column:
    return F.date_format(_moved_day(_number(m, 1, 4), _number(m, 6, 2), _number(m, 9, 2), key), "yyyy-MM-dd")


def _local_date(m: Column, key: str) -> Column:
    day_first = _moved_day(_number(m, 7, 4), _number(m, 4, 2), _number(m, 1, 2), key)
    month_first = _moved_day(_number(m, 7, 4), _number(m, 1, 2), _number(m, 4, 2), key)
    as_digits = F.coalesce(F.date_format(day_first, "ddMMyyyy"), F.date_format(month_first, "MMddyyyy"))
    return _refill(m, as_digits)


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = _number(m, 1, 3), _number(m, 5, 2), _number(m, 8, 4)
    valid = (area >= 1) & (area != 666) & (area <= 899) & (group >= 1) & (serial >= 1)
    pair = feistel_pair(key, "ssn", area - F.when(area > 666, 2).otherwise(1), (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999))
    new_area = pair["l"] + F.when(pair["l"] >= 665, 2).otherwise(1)
    return F.when(valid, F.format_string("%03d-%02d-%04d", new_area, (F.floor(pair["r"] / 9999) + 1).cast("long"), pair["r"] % 9999 + 1))


def _email(m: Column, key: str) -> Column:
    local, rest = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    chars = _chars(local)
    kind = lambda c: F.when(c.rlike("[0-9]"), 48).when(c.rlike("[a-z]"), 97).when(c.rlike("[A-Z]"), 65).otherwise(F.ascii(c))
    size = lambda c: F.when(c.rlike("[0-9]"), 10).when(c.rlike("[A-Za-z]"), 26).otherwise(1)
    moved = feistel_chars(key, "email", F.transform(chars, lambda c: F.ascii(c) - kind(c)), F.transform(chars, size))
    return F.concat(F.array_join(F.zip_with(moved, chars, lambda v, c: F.char(v + kind(c))), ""), F.lit("@"), rest)


def _hex(m: Column, key: str) -> Column:
    values = F.transform(_chars(m), lambda c: F.conv(c, 16, 10).cast("int"))
    moved = F.array_join(F.transform(feistel_chars(key, "hex", values, F.transform(values, lambda _: F.lit(16))), lambda v: F.lower(F.hex(v))), "")
    return F.when(m.rlike("[A-F]"), F.upper(moved)).otherwise(moved)


_KINDS: tuple[tuple[str, Callable[[Column, str], Column]], ...] = ((EMAIL, _email), (HEX, _hex), (IPV4, _ipv4), (ISO_DATE, _iso_date), (LOCAL_DATE, _local_date), (SSN, _ssn), (PHONE, _phone), (CARD, _card))


def pseudonym(m: Column, key: str) -> Column:
    """The image of one candidate; null if it is not valid."""
    out = None
    for pattern, f in _KINDS:
        whole = m.rlike(f"^(?:{pattern})$")
        out = F.when(whole, f(m, key)) if out is None else out.when(whole, f(m, key))
    return out


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """docs with text_col rewritten and n_pseudonyms added."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    words = names[docs.columns.index(text_col)]
    text = F.col(words)
    # most texts have no candidate: a cheap look keeps them off the long pattern
    found = F.when(text.rlike("[0-9@]|[a-f]{32}|[A-F]{32}"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    marked = docs.toDF(*names).select("*", found.alias("found"))
    images = F.transform("found", lambda m: F.struct(m.alias("old"), pseudonym(m, key).alias("new")))
    marked = marked.withColumn("images", F.when(F.size("found") > 0, images))
    between = F.split(text, ANY, -1)
    parts = F.zip_with(between, F.transform("images", lambda v: F.coalesce(v["new"], v["old"])), lambda x, y: F.concat(x, F.coalesce(y, F.lit(""))))
    new = F.when(F.col("images").isNotNull(), F.array_join(parts, "")).otherwise(text)
    count = F.coalesce(F.size(F.filter("images", lambda v: v["new"].isNotNull())), F.lit(0))
    kept = [(new if x == words else F.col(x)).alias(c) for x, c in zip(names, docs.columns, strict=True) if c != "n_pseudonyms"]
    return marked.select(*kept, F.when(F.col("images").isNull(), 0).otherwise(count).cast("long").alias("n_pseudonyms"))
