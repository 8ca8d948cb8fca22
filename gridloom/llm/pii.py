"""Format-preserving pseudonyms for personal numbers, dates and addresses, in DataFrame functions only.

Found and validated: e-mail addresses, IPv4 addresses, IBANs (mod 97), US
social security numbers, dates (ISO, slashes, dots; real calendar days 1800 to
2199), telephone numbers (North American with valid area and exchange codes, or
international with 8 to 15 digits) and payment cards (known first digits, Luhn).
What fails its validation is left as it is.

Each value is permuted within its own format by a Feistel network keyed by
``key``: addresses, day numbers and social security numbers as mixed-radix
integers over exactly the valid values, the others symbol by symbol (a digit
stays a digit, a letter a letter of its case, separators stay), and check digits
are made anew. A permutation keeps equal values equal in every document and
different ones different; dates are linked across formats, as the day is
permuted. A day and month in slashes are read month first if that is valid.

Mail addresses are linked whatever the case of their letters, North American
numbers whatever separates their digits, and cards whatever separates theirs.

A null text stays null and has no findings. Other columns of a row are kept,
whatever their names; n_private and private are added and replace columns of
these names. There is no shuffle: long texts and repeated rows need nothing
special. What is found and what it becomes are made in Generate steps of one row
each, through which no later expression is copied into them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "pseudonym-key-1"
ROUNDS = 6

# The formats that are found.
_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])"
_IP = r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])"
_IBAN = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"
_SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
_DATE = r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9]|[./-][0-9])"
_NANP = r"(?<![0-9A-Za-z+])(?:\+1[ .-]?|1[ .-])?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9A-Za-z])"
_PHONE = r"(?<![0-9A-Za-z+])\+[1-9][0-9]{0,2}(?:[ .-]?\(?[0-9]\)?){5,12}(?![0-9A-Za-z])"
_CARD = r"(?<![0-9A-Za-z-])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z-])"
PATTERNS = {"email": _EMAIL, "ip": _IP, "iban": _IBAN, "ssn": _SSN, "date": _DATE, "nanp": _NANP, "card": _CARD, "phone": _PHONE}
ANY = "|".join(PATTERNS.values())
#: Days from 1800-01-01 to 2199-12-31: 400 years, 189 * 773 days.
_DAYS, _DAY_RADICES = 146_097, (189, 773)


def _prf(key: str, tag: str, i: Column, value: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(tag), i.cast("string"), value.cast("string")), 256)


def permuted_int(x: Column, a: int, b: int, key: str, tag: str) -> Column:
    """A keyed permutation of 0 .. a * b - 1: alternating Feistel rounds on x = left * b + right."""

    def turn(acc: Column, i: Column) -> Column:
        left = i % 2 == 0
        by = F.conv(F.substring(_prf(key, tag, i, F.when(left, acc["r"]).otherwise(acc["l"])), 1, 13), 16, 10).cast("long")
        return F.struct(
            F.when(left, F.pmod(acc["l"] + by, F.lit(a))).otherwise(acc["l"]).cast("long").alias("l"),
            F.when(left, acc["r"]).otherwise(F.pmod(acc["r"] + by, F.lit(b))).cast("long").alias("r"),
        )

    start = F.struct(F.floor(x / F.lit(b)).cast("long").alias("l"), F.pmod(x, F.lit(b)).cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda acc: acc["l"] * b + acc["r"])


def _positions(s: Column) -> Column:
    return F.when(F.length(s) > 0, F.sequence(F.lit(1), F.length(s))).otherwise(F.array().cast("array<int>"))


def mask_of(s: Column) -> Column:
    """What each symbol may become: d digit, l small letter, u capital letter, x itself."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(s, "[^0-9A-Za-z]", "."), "[A-Z]", "U"), "[a-z]", "l"), "[0-9]", "d")


def _shifted(s: Column, mask: Column, by: Column) -> Column:
    """Each symbol moved within its kind; by: hexadecimal digits, four for each symbol in turn."""

    def one(j: Column) -> Column:
        c, kind = F.ascii(F.substring(s, j, F.lit(1))), F.substring(mask, j, F.lit(1))
        n = F.conv(F.substring(by, F.pmod((j - 1) * 4, F.lit(64)) + 1, F.lit(4)), 16, 10).cast("int")
        moved = lambda low, size: F.chr(F.lit(low) + F.pmod(c - low + n, F.lit(size)))
        return F.when(kind == "d", moved(48, 10)).when(kind == "n", moved(50, 8)).when(kind == "l", moved(97, 26)).when(kind == "U", moved(65, 26)).otherwise(F.substring(s, j, F.lit(1)))

    return F.array_join(F.transform(_positions(s), one), "")


def permuted_text(s: Column, mask: Column, key: str, tag: str) -> Column:
    """A keyed permutation of the strings with this mask: Feistel rounds on the two halves."""
    half = F.floor(F.length(s) / 2).cast("int")
    start = F.struct(F.substring(s, F.lit(1), half).alias("l"), F.substring(s, half + 1, F.length(s)).alias("r"))
    left_mask, right_mask = F.substring(mask, F.lit(1), half), F.substring(mask, half + 1, F.length(s))

    def turn(acc: Column, i: Column) -> Column:
        left = i % 2 == 0
        by = _prf(key, tag, i, F.concat(left_mask, right_mask, F.lit("|"), F.when(left, acc["r"]).otherwise(acc["l"])))
        moved = _shifted(F.when(left, acc["l"]).otherwise(acc["r"]), F.when(left, left_mask).otherwise(right_mask), by)
        return F.struct(F.when(left, moved).otherwise(acc["l"]).alias("l"), F.when(left, acc["r"]).otherwise(moved).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda acc: F.concat(acc["l"], acc["r"]))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _refilled(form: Column, symbols: Column) -> Column:
    """form with its letters and digits replaced by those of symbols, in order."""

    def step(acc: Column, j: Column) -> Column:
        c = F.substring(form, j, F.lit(1))
        own = c.rlike("[0-9A-Za-z]")
        return F.struct(
            F.concat(acc["out"], F.when(own, F.substring(symbols, acc["at"], F.lit(1))).otherwise(c)).alias("out"),
            (acc["at"] + own.cast("int")).alias("at"),
        )

    return F.aggregate(_positions(form), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), step, lambda acc: acc["out"])


def luhn_sum(digits: Column) -> Column:
    def step(acc: Column, j: Column) -> Column:
        d = F.substring(digits, -j, F.lit(1)).cast("int") * F.when(j % 2 == 0, 2).otherwise(1)
        return acc + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(_positions(digits), F.lit(0), step)


def mod97(s: Column) -> Column:
    """An IBAN's remainder: letters count as 10 to 35, the first four symbols come last."""
    turned = F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, 1, 4))

    def step(acc: Column, j: Column) -> Column:
        c = F.ascii(F.substring(turned, j, F.lit(1)))
        return F.when(c < 65, (acc * 10 + c - 48) % 97).otherwise((acc * 100 + c - 55) % 97)

    return F.aggregate(_positions(s), F.lit(0), step)


def _whole(m: Column, name: str) -> Column:
    return m.rlike(f"^(?:{PATTERNS[name]})$")


def _email(m: Column, key: str) -> Column:
    dot = F.length(m) - F.length(F.substring_index(m, ".", -1))
    body = F.substring(m, F.lit(1), dot)
    low = F.lower(body)

    def cased(new: Column) -> Column:
        letter = lambda s, j: F.substring(s, j, F.lit(1))
        return F.array_join(F.transform(_positions(body), lambda j: F.when(letter(body, j).rlike("[A-Z]"), F.upper(letter(new, j))).otherwise(letter(new, j))), "")

    return F.concat(F.transform(F.array(permuted_text(low, mask_of(low), key, "email")), cased)[0], F.substring_index(m, ".", -1))


def _ip(m: Column, key: str) -> Column:
    n = reduce(lambda acc, i: acc * 256 + F.split_part(m, F.lit("."), F.lit(i)).cast("long"), range(1, 5), F.lit(0).cast("long"))
    p = F.transform(F.array(permuted_int(n, 65_536, 65_536, key, "ip")), lambda x: F.concat_ws(".", *[(F.shiftright(x, s) % 256).cast("string") for s in (24, 16, 8, 0)]))
    return p[0]


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.split_part(m, F.lit("-"), F.lit(i)).cast("long") for i in (1, 2, 3))
    # Areas 1 to 899 without 666, groups 1 to 99, serials 1 to 9999.
    n = ((area - 1 - (area > 666).cast("long")) * 99 + group - 1) * 9999 + serial - 1

    def shown(x: Column) -> Column:
        a = F.floor(x / (99 * 9999)) + 1
        a = a + (a >= 666).cast("long")
        part = lambda v, w: F.lpad(v.cast("string"), w, "0")
        return F.concat_ws("-", part(a, 3), part(F.floor(x / 9999) % 99 + 1, 2), part(x % 9999 + 1, 4))

    return F.transform(F.array(permuted_int(n, 898 * 99, 9999, key, "ssn")), shown)[0]


def _day(m: Column) -> Column:
    read = lambda f: F.try_to_timestamp(m, F.lit(f)).cast("date")
    day = F.when(m.contains("-"), read("yyyy-MM-dd")).when(m.contains("."), read("dd.MM.yyyy")).otherwise(F.coalesce(read("MM/dd/yyyy"), read("dd/MM/yyyy")))
    n = F.date_diff(day, F.lit("1800-01-01").cast("date"))
    return F.when(n.between(0, _DAYS - 1), n)


def _date(m: Column, key: str) -> Column:
    def shown(x: Column) -> Column:
        d = F.date_add(F.lit("1800-01-01").cast("date"), x.cast("int"))
        month_first = F.try_to_timestamp(m, F.lit("MM/dd/yyyy")).isNotNull()
        return F.when(m.contains("-"), F.date_format(d, "yyyy-MM-dd")).when(m.contains("."), F.date_format(d, "dd.MM.yyyy")).when(month_first, F.date_format(d, "MM/dd/yyyy")).otherwise(F.date_format(d, "dd/MM/yyyy"))

    return F.transform(F.array(permuted_int(_day(m).cast("long"), *_DAY_RADICES, key, "date")), shown)[0]


def _nanp(m: Column, key: str) -> Column:
    head = F.regexp_extract(m, r"^(\+?1[ .-]?(?=[(2-9]))?", 1)
    d = F.substring(_digits(F.substring(m, F.length(head) + 1, F.length(m))), 1, 10)
    body = F.substring(m, F.length(head) + 1, F.length(m))
    return F.concat(head, _refilled(body, permuted_text(d, F.lit("nddndddddd"), key, "nanp")))


def _phone(m: Column, key: str) -> Column:
    d = _digits(m)
    return _refilled(m, permuted_text(d, F.concat(F.lit("xx"), F.repeat(F.lit("d"), F.length(d) - 2)), key, "phone"))


def _card(m: Column, key: str) -> Column:
    d = _digits(m)
    body = F.substring(d, F.lit(1), F.length(d) - 1)
    # Of cards that start with 2 the second digit tells whether they are cards too.
    fixed = F.when(d.startswith("2"), "xx").otherwise("x")
    new = permuted_text(body, F.concat(fixed, F.repeat(F.lit("d"), F.length(body) - F.length(fixed))), key, "card")
    return F.transform(F.array(new), lambda n: _refilled(m, F.concat(n, F.pmod(-luhn_sum(F.concat(n, F.lit("0"))), F.lit(10)).cast("string"))))[0]


def _iban(m: Column, key: str) -> Column:
    s = F.replace(m, F.lit(" "), F.lit(""))
    body = F.substring(s, F.lit(5), F.length(s))
    new = permuted_text(body, mask_of(body), key, "iban")

    def checked(n: Column) -> Column:
        land = F.substring(s, 1, 2)
        return _refilled(m, F.concat(land, F.lpad((98 - mod97(F.concat(land, F.lit("00"), n))).cast("string"), 2, "0"), n))

    return F.transform(F.array(new), checked)[0]


def kind_of(m: Column) -> Column:
    """The kind of a candidate, null if its validation fails."""
    d = _digits(m)
    ip_ok = F.forall(F.split(m, r"\."), lambda x: (F.length(x) <= 3) & (x.cast("int") <= 255) & ((F.length(x) == 1) | ~x.startswith("0")))
    iban = F.replace(m, F.lit(" "), F.lit(""))
    return (
        F.when(m.contains("@"), F.when(_whole(m, "email"), "email"))
        .when(_whole(m, "ip"), F.when(ip_ok, "ip"))
        .when(_whole(m, "iban"), F.when(mod97(iban) == 1, "iban"))
        .when(_whole(m, "ssn"), F.when(~m.rlike("^(?:000|666|9..)|-00-|0000$"), "ssn"))
        .when(_whole(m, "date"), F.when(_day(m).isNotNull(), "date"))
        .when(_whole(m, "nanp"), F.lit("nanp"))
        .when(_whole(m, "card"), F.when(d.rlike("^(?:[3-6]|2[2-7])") & (luhn_sum(d) % 10 == 0), "card"))
        .when(_whole(m, "phone"), F.when(d.rlike("^1[2-9][0-9]{2}[2-9][0-9]{6}$"), "nanp").when(F.length(d).between(8, 15), "phone"))
    )


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    made = {"email": _email, "ip": _ip, "iban": _iban, "ssn": _ssn, "date": _date, "nanp": _nanp, "card": _card, "phone": _phone}
    out = F.when(kind.isNull(), m)
    for name, f in made.items():
        out = out.when(kind == name, f(m, key))
    return out.otherwise(m)


def pseudonymised(docs: DataFrame, column: str = "text", key: str = KEY) -> DataFrame:
    """docs with its text's private values replaced; + n_private long, private array of (kind, pseudonym) in text order."""
    once = lambda x: F.explode(F.array(x))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.col(f"row.`{column}`")
    # Most texts hold no digit and no @, and pass unread by the long pattern.
    some = text.rlike("[0-9@]")
    found = F.when(some, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    rows = rows.select("row", once(F.transform(found, lambda m: F.struct(m.alias("value"), kind_of(m).alias("kind")))).alias("found"))
    rows = rows.select("row", once(F.transform("found", lambda x: F.struct(x["kind"].alias("kind"), pseudonym(x["value"], x["kind"], key).alias("pseudonym")))).alias("found"))
    between = F.split(text, ANY, -1)
    whole = F.array_join(F.transform(between, lambda x, i: F.concat(F.when(i > 0, F.get(F.col("found"), i - 1)["pseudonym"]).otherwise(F.lit("")), x)), "")
    rows = rows.select("row", "found", once(F.when(F.size("found") > 0, whole).otherwise(text)).alias("new"))
    kept = F.filter("found", lambda x: x["kind"].isNotNull())
    columns = [F.col("new").alias(c) if c == column else F.col(f"row.`{c}`") for c in docs.columns if c not in ("n_private", "private")]
    return rows.select(*columns, F.size(kept).cast("long").alias("n_private"), kept.alias("private"))


def op3(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pseudonymised(docs)
