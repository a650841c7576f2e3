"""Format-preserving Feistel pseudonyms for personal numbers, dates and mail names.

Each value is found by its pattern, validated, and permuted within its format by a keyed Feistel network whose rounds add a SHA-2 digest
of key, kind, round and the other half. The network is a permutation, so different values stay different, and equal values get
the same pseudonym in every document:

* card and account numbers (13 to 19 digits, also in groups of four): all digits; where the check digit is right, the
  other digits are permuted and a right check digit is set, and where it is wrong it stays wrong;
* phone numbers (+ country code, 8 to 12 digits in any grouping; after +1 exactly ten): all digits but the country code, which is what
  a separator ends, and 1 in +1 with ten digits, so the groupings of one such number have one pseudonym;
* social security numbers (valid area, group and serial): to another valid number;
* IPv4 addresses (each part up to 255): to another address;
* dates (year-month-day or day/month/year, real dates from 1600 to 2399): to another real date; what is only a date as
  month/day/year: to another that is only one so;
* mail addresses: letters (Latin, of ISO 8859-1) and digits of the name, letters of other scripts and the domain stay;
* hexadecimal secrets of 32 digits and more: all digits.

Everything is built-in functions, row by row, without a shuffle.

Defined cases: a null text stays null with count 0; a value that fails its validation stays as it is and isn't counted. Letters keep their
case, separators their places. Repeated rows are handled each on its own; other columns pass through, and n_values replaces one of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeloom.llm.common import load, query

#: Demonstration key of the registered query; callers pass their own.
DEMO_KEY = "demonstration key"
ROUNDS = 8

_MAIL = r"[\p{L}\p{N}_.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_HEX = r"(?<![0-9A-Za-z])[0-9a-f]{32,}(?![0-9A-Za-z])"
_IP = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)"
_ISO = r"(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-])"
_DMY = r"(?<![\d/])\d{2}/\d{2}/\d{4}(?![\d/])"
_SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
_PHONE = r"\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)|\+\d{1,3}(?: ?\(\d{1,4}\))?(?:[ .-]?\d{2,4}){2,4}(?!\d)"
_CARD = r"(?<![\d.-])\d{4}(?:[ -]\d{4}){2,3}(?:[ -]\d{1,3})?(?![\d-])|(?<!\d)\d{13,19}(?!\d)"
#: In this order at each place; none of them can match without a digit or an at sign.
PATTERN = "|".join(f"(?:{p})" for p in (_MAIL, _HEX, _IP, _ISO, _DMY, _PHONE, _SSN, _CARD))


def once(value: Column, f) -> Column:
    """f(value), with the value worked out a single time."""
    return F.transform(F.array(value), lambda x: f(x))[0]


def _round(key: str, kind: Column | str, i: int, value: Column) -> Column:
    """A number of 48 bits from key, kind, round and a half."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), kind, F.lit(str(i)), value.cast("string"), F.lit(key)), 256), 1, 12), 16, 10).cast("bigint")


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, kind: Column | str) -> Column:
    """Struct (l, r): the permuted pair of numbers, l below a and r below b. Each round adds to one half a digest of the other."""
    pair = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    for i in range(0, ROUNDS, 2):
        pair = once(pair, lambda p: F.struct(F.pmod(p["l"] + F.pmod(_round(key, kind, i, p["r"]), a), a).alias("l"), p["r"].alias("r")))
        pair = once(pair, lambda p: F.struct(p["l"].alias("l"), F.pmod(p["r"] + F.pmod(_round(key, kind, i + 1, p["l"]), b), b).alias("r")))
    return pair


def permute_digits(digits: Column, key: str, kind: Column | str) -> Column:
    """Another number of as many digits, up to 36; one digit is shifted by the key alone."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    left, right = F.substr(digits, F.lit(1), half), F.substr(digits, half + 1)
    power = lambda k: F.pow(F.lit(10), k).cast("bigint")
    number = lambda s: F.when(F.length(s) > 0, s).otherwise(F.lit("0")).cast("bigint")
    name = F.concat_ws("/", F.lit(kind) if isinstance(kind, str) else kind, n.cast("string"))
    return F.transform(F.array(feistel(number(left), number(right), power(half), power(n - half), key, name)), lambda p: F.concat(
        F.when(half > 0, F.lpad(p["l"].cast("string"), half, "0")).otherwise(F.lit("")), F.lpad(p["r"].cast("string"), n - half, "0")))[0]


def _check_digit(body: Column) -> Column:
    """The Luhn check digit of the digits before it."""
    total = F.aggregate(F.sequence(F.lit(1), F.length(body)), F.lit(0), lambda s, i: s + F.transform(
        F.array(F.substr(body, F.length(body) - i + 1, F.lit(1)).cast("int") * (1 + i % 2)), lambda d: F.when(d > 9, d - 9).otherwise(d))[0])
    return F.pmod(F.lit(10) - F.pmod(total, F.lit(10)), F.lit(10))


def _refill(value: Column, digits: Column) -> Column:
    """The value with its digits replaced in order; separators stay."""
    places = F.split(value, "")
    start = F.struct(F.lit(0).alias("n"), F.lit("").alias("s"))
    return F.aggregate(places, start, lambda acc, c: F.when(c.rlike("^[0-9]$"), F.struct((acc["n"] + 1).alias("n"), F.concat(acc["s"], F.substr(digits, acc["n"] + 1, F.lit(1))).alias("s")))
                       .otherwise(F.struct(acc["n"].alias("n"), F.concat(acc["s"], c).alias("s"))), lambda acc: acc["s"])


def _card(v: Column, key: str) -> Column:
    digits = F.regexp_replace(v, "[ -]", "")

    def made(d: Column) -> Column:
        body, last = F.substr(d, F.lit(1), F.length(d) - 1), F.substr(d, F.length(d), F.lit(1)).cast("int")
        off = F.pmod(last - _check_digit(body), F.lit(10))  # 0 for a right check digit
        return F.transform(F.array(permute_digits(body, key, "card")), lambda b: F.concat(b, F.pmod(_check_digit(b) + off, F.lit(10)).cast("string")))[0]

    return F.when(F.length(digits).between(13, 19), _refill(v, F.transform(F.array(digits), made)[0]))


def _phone(v: Column, key: str) -> Column:
    code = F.regexp_extract(v, r"^(?:\+1(?=(?:[ .()-]*\d){10}$)|\+\d{1,3}(?=[ .(-]))", 0)
    rest = F.substr(v, F.length(code) + 1)
    digits = F.regexp_replace(rest, "[^0-9]", "")
    return F.when(F.length(digits).between(7, 15), F.concat(code, _refill(rest, permute_digits(digits, key, F.concat(F.lit("phone"), code)))))


def _ip(v: Column, key: str) -> Column:
    p = F.transform(F.split(v, r"\."), lambda x: x.cast("int"))
    fine = F.forall(p, lambda x: x <= 255)
    made = F.transform(F.array(feistel(p[0] * 256 + p[1], p[2] * 256 + p[3], F.lit(65536), F.lit(65536), key, "ip")), lambda x: F.concat_ws(
        ".", F.floor(x["l"] / 256).cast("string"), (x["l"] % 256).cast("string"), F.floor(x["r"] / 256).cast("string"), (x["r"] % 256).cast("string")))[0]
    return F.when(fine, made)


#: Days from 1600-01-01 to 2399-12-31: two Gregorian cycles, 292,194 = 378 * 773.
_DAY0, _DAYS_A, _DAYS_B = "1600-01-01", 378, 773


def _date(day: Column, key: str) -> Column:
    n = F.datediff(day, F.lit(_DAY0).cast("date"))
    made = F.transform(F.array(feistel(F.floor(n / _DAYS_B), n % _DAYS_B, F.lit(_DAYS_A), F.lit(_DAYS_B), key, "date")), lambda x: F.date_add(
        F.lit(_DAY0).cast("date"), (x["l"] * _DAYS_B + x["r"]).cast("int")))[0]
    return F.when((n >= 0) & (n < _DAYS_A * _DAYS_B), made)


def _month_first(v: Column, key: str) -> Column:
    """Another date that is one with the month first only: the permutation is applied until its day is beyond 12."""
    day = F.try_to_date(v, "MM/dd/yyyy")

    def step(d: Column, i: Column) -> Column:
        return F.when((i > 1) & (F.dayofmonth(d) > 12), d).otherwise(_date(d, key))

    made = F.aggregate(F.sequence(F.lit(1), F.lit(64)), day, step)
    return F.when(F.dayofmonth(made) > 12, F.date_format(made, "MM/dd/yyyy"))


def _ssn(v: Column, key: str) -> Column:
    area, group, serial = (F.substr(v, F.lit(i), F.lit(n)).cast("int") for i, n in ((1, 3), (5, 2), (8, 4)))
    fine = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = F.when(area > 666, area - 2).otherwise(area - 1)  # 898 areas
    made = F.transform(F.array(feistel(index, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key, "ssn")), lambda x: F.concat_ws(
        "-", F.lpad(F.when(x["l"] >= 665, x["l"] + 2).otherwise(x["l"] + 1).cast("string"), 3, "0"),
        F.lpad((F.floor(x["r"] / 9999) + 1).cast("string"), 2, "0"), F.lpad((x["r"] % 9999 + 1).cast("string"), 4, "0")))[0]
    return F.when(fine, made)


def _shifted(text: Column, digest: Column, alphabet: str) -> Column:
    """Each character moved within its class by a byte of the digest (128 hexadecimal digits, used again after 64 characters)."""
    def move(c: Column, i: Column, digits: Column) -> Column:
        k = F.conv(F.substr(digits, (i % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        code = F.ascii(c)
        turn = lambda low, size: F.char(F.pmod(code - low + k, F.lit(size)) + low)
        if alphabet == "hex":
            value = F.when(code < 58, code - 48).otherwise(code - 87)
            return F.substr(F.lit("0123456789abcdef"), F.pmod(value + k, F.lit(16)) + 1, F.lit(1))
        return (F.when(code.between(97, 122), turn(97, 26)).when(code.between(65, 90), turn(65, 26)).when(code.between(48, 57), turn(48, 10))
                .when(code.between(224, 246), turn(224, 23)).when(code.between(248, 254), turn(248, 7))
                .when(code.between(192, 214), turn(192, 23)).when(code.between(216, 222), turn(216, 7)).otherwise(c))

    signs = F.filter(F.split(text, ""), lambda c: c != "")
    return once(digest, lambda digits: F.concat_ws("", F.transform(signs, lambda c, i: move(c, i, digits))))


def permute_text(text: Column, key: str, kind: str, alphabet: str = "letters") -> Column:
    """A text of the same length and character classes: a Feistel network whose halves are the two halves of the text."""
    half = F.floor(F.length(text) / 2).cast("int")
    name = F.concat_ws("/", F.lit(kind), F.length(text).cast("string"))
    pair = F.struct(F.substr(text, F.lit(1), half).alias("l"), F.substr(text, half + 1).alias("r"))
    digest = lambda i, other: F.sha2(F.concat_ws("|", F.lit(key), name, F.lit(str(i)), other, F.lit(key)), 512)
    for i in range(0, 4, 2):
        pair = once(pair, lambda p: F.struct(p["l"].alias("l"), _shifted(p["r"], digest(i, p["l"]), alphabet).alias("r")))
        pair = once(pair, lambda p: F.struct(_shifted(p["l"], digest(i + 1, p["r"]), alphabet).alias("l"), p["r"].alias("r")))
    return F.concat(pair["l"], pair["r"])


def pseudonym(v: Column, key: str) -> Column:
    """Pseudonym of a found value; null if it doesn't validate."""
    at = F.instr(v, "@")
    whole = lambda p: v.rlike(f"^(?:{p})$")
    return (F.when(at > 0, F.concat(permute_text(F.substr(v, F.lit(1), at - 1), key, "mail"), F.substr(v, at)))
            .when(v.rlike("^[0-9a-f]{32,}$"), permute_text(v, key, "hex", "hex"))
            .when(v.rlike(r"^\d+\.\d+\.\d+\.\d+$"), _ip(v, key))
            .when(v.rlike(r"^\d{4}-\d\d-\d\d$"), F.date_format(_date(F.try_to_date(v, "yyyy-MM-dd"), key), "yyyy-MM-dd"))
            .when(v.rlike(r"^\d\d/(?:0\d|1[0-2])/"), F.date_format(_date(F.try_to_date(v, "dd/MM/yyyy"), key), "dd/MM/yyyy"))
            .when(v.rlike(r"^\d\d/"), _month_first(v, key))
            .when(v.startswith("+"), _phone(v, key))
            .when(whole(r"\d{3}-\d{2}-\d{4}"), _ssn(v, key))
            .otherwise(_card(v, key)))


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with personal values in the text replaced, and n_values."""
    values = F.when(F.col("text").rlike("[0-9@]"), F.regexp_extract_all("text", F.lit(PATTERN), 0))
    found = docs.withColumn("__fp_values", values)
    made = F.transform("__fp_values", lambda v: F.struct(v.alias("v"), pseudonym(v, key).alias("p")))
    ready = found.withColumn("__fp_made", F.when(F.size("__fp_values") > 0, made))
    parts = F.split("text", PATTERN, -1)
    joined = F.concat_ws("", F.zip_with(parts, "__fp_made", lambda part, m: F.concat(part, F.coalesce(m["p"], m["v"], F.lit("")))))
    text = F.when(F.col("__fp_made").isNull(), F.col("text")).otherwise(joined)
    n = F.coalesce(F.size(F.filter("__fp_made", lambda m: m["p"].isNotNull())), F.lit(0)).cast("bigint")
    n = F.when(F.col("__fp_made").isNull(), F.lit(0).cast("bigint")).otherwise(n)
    return ready.withColumns({"text": text, "n_values": n}).select(*[c for c in docs.columns if c.lower() != "n_values"], "n_values")


@query("op1_feistel_pseudonyms")
def pseudonymous_documents(spark, sf_dir):
    """Every document with its personal values replaced."""
    return pseudonymise(load(spark, sf_dir, "documents").select("doc_id", "text"), DEMO_KEY)
