"""Format-preserving pseudonyms for personal data.

Validated numbers and dates are permuted within their format by a keyed Feistel
network, so equal values get equal pseudonyms in every document, different values
different ones, and no table of values is kept.  Everything is a native expression
on one text; no rows move.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: A number is a whole run of digits, not a piece of one.
_BEFORE, _AFTER = r"(?<![0-9])", r"(?![0-9])"
#: Kinds, first match wins.  Runs are bounded or start at a rare character.
PATTERNS: dict[str, str] = {
    "email": r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(\.[A-Za-z0-9-]{1,63}){1,8}",
    "ip": r"(?<![0-9])(?<![0-9]\.)[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?!\.?[0-9])",
    "date": _BEFORE + r"[0-9]{4}-[0-9]{2}-[0-9]{2}" + _AFTER,
    "phone": r"(\+[0-9]{1,3}[\x20.-]?|" + _BEFORE + r")(\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[\x20.-][0-9]{4}" + _AFTER,
    "ssn": _BEFORE + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _AFTER,
    "card": _BEFORE + r"([0-9]{4}([\x20-][0-9]{4}){3}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}|[0-9]{13,}+)" + _AFTER,
}
ANY = "|".join(PATTERNS.values())
KINDS = tuple(PATTERNS)
#: First day and square root of the number of days that dates are permuted among.
EPOCH, DATE_SIDE = "1900-01-01", 270


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.transform(F.array(value), body)[0]


def _round(key: Column, i: Column, value: Column, modulus: Column) -> Column:
    """Keyed round function below ``modulus``."""
    digest = F.sha2(F.concat_ws(":", key, i.cast("string"), value.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % modulus


def feistel(key: Column, left: Column, right: Column, a: Column, b: Column) -> Column:
    """Keyed permutation of the pairs (left < a, right < b), as a struct ``l, r``."""
    def step(acc: Column, i: Column) -> Column:
        even = i % 2 == 0
        l = F.when(even, (acc["l"] + _round(key, i, acc["r"], a)) % a).otherwise(acc["l"])
        r = F.when(even, acc["r"]).otherwise((acc["r"] + _round(key, i, acc["l"], b)) % b)
        return F.struct(l.alias("l"), r.alias("r"))

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _power(n: Column) -> Column:
    return F.concat(F.lit("1"), F.repeat(F.lit("0"), n)).cast("long")


def permuted_digits(key: Column, digits: Column) -> Column:
    """A string of digits permuted among all strings of its length."""
    def halves(d: Column) -> Column:
        n = F.length(d)
        h = F.floor(n / 2).cast("int")
        a, b = _power(h), _power(n - h)
        k = F.concat_ws("/", key, n.cast("string"))
        left, right = F.substring(d, F.lit(1), h).cast("long"), F.substring(d, h + 1, n).cast("long")
        return _let(feistel(k, left, right, a, b), lambda x: F.concat(
            F.lpad(x["l"].cast("string"), h, F.lit("0")), F.lpad(x["r"].cast("string"), n - h, F.lit("0"))))

    return F.when(F.length(digits) >= 2, _let(digits, halves)).otherwise(digits)


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of digits whose last one counts once."""
    def weigh(d: Column, i: Column) -> Column:
        v = d.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(v > 9, v - 9).otherwise(v)

    each = F.transform(F.reverse(F.split(digits, "")), weigh)
    return F.aggregate(each, F.lit(0), lambda acc, x: acc + x)


def refilled(template: Column, digits: Column) -> Column:
    """The template with its digits replaced, in order."""
    hole = "\u0001"
    return F.aggregate(
        F.split(digits, ""), F.regexp_replace(template, "[0-9]", hole),
        lambda acc, d: F.concat(F.substring_index(acc, hole, 1), d, F.substring(acc, F.instr(acc, hole) + 1, F.length(acc))),
    )


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _card(key: Column, x: Column) -> Column:
    d = _digits(x)
    body = permuted_digits(F.concat(key, F.lit("card")), F.substring(d, F.lit(1), F.length(d) - 1))
    return refilled(x, _let(body, lambda b: F.concat(b, ((10 - luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string"))))


def _phone(key: Column, x: Column) -> Column:
    d = _digits(x)
    return refilled(x, F.concat(F.substring(d, F.lit(1), F.length(d) - 10), permuted_digits(F.concat(key, F.lit("phone")), F.substring(d, F.length(d) - 9, F.lit(10)))))


def _ip(key: Column, x: Column) -> Column:
    def of(p: Column) -> Column:
        o = [F.get(p, F.lit(i)).cast("long") for i in range(4)]
        side = F.lit(65536).cast("long")
        return _let(feistel(F.concat(key, F.lit("ip")), o[0] * 256 + o[1], o[2] * 256 + o[3], side, side), lambda v: F.concat_ws(
            ".", *[F.floor(v[h] / 256).cast("string") if hi else (v[h] % 256).cast("string") for h in ("l", "r") for hi in (True, False)]))

    return _let(F.split(x, r"\."), of)


def _date(key: Column, x: Column) -> Column:
    def of(day: Column) -> Column:
        n = F.datediff(day, F.lit(EPOCH).cast("date"))
        side = F.lit(DATE_SIDE).cast("long")
        within = _let(feistel(F.concat(key, F.lit("date")), F.floor(n / DATE_SIDE), n % DATE_SIDE, side, side),
                      lambda v: F.date_add(F.lit(EPOCH).cast("date"), (v["l"] * DATE_SIDE + v["r"]).cast("int")))
        first = F.trunc(day, "year")
        days = F.datediff(F.add_months(first, 12), first)
        turn = _round(F.concat(key, F.lit("year")), F.lit(0), F.year(day), days.cast("long"))
        rotated = F.date_add(first, ((F.dayofyear(day) - 1 + turn) % days).cast("int"))
        return F.date_format(F.when((n >= 0) & (n < DATE_SIDE * DATE_SIDE), within).otherwise(rotated), "yyyy-MM-dd")

    return _let(F.to_date(x, "yyyy-MM-dd"), of)


def _email(key: Column, x: Column) -> Column:
    # 96 bits, so that two names do not meet
    name = F.sha2(F.concat(key, F.lit("email:"), F.lower(x)), 256)
    return F.concat(F.lit("u"), F.substring(name, 1, 24), F.lit("@"), F.substring_index(x, "@", -1))


def kind_of(x: Column) -> Column:
    """Kind of a match if it is valid, else null."""
    octets = F.transform(F.split(x, r"\."), lambda o: o.cast("int") <= 255)
    digits = _digits(x)
    valid = {
        "email": F.lit(True),
        "ip": F.forall(octets, lambda o: o),
        "date": F.try_to_date(x, "yyyy-MM-dd").isNotNull() & (F.substring(x, 1, 4) >= "0001"),
        "phone": F.lit(True),
        "ssn": ~x.rlike("^(000|666|9)") & ~x.rlike("-00-|-0000$"),
        "card": (F.length(digits) <= 19) & (luhn_sum(digits) % 10 == 0),
    }
    out = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        out = F.when(x.rlike(f"^({PATTERNS[kind]})$"), F.when(valid[kind], F.lit(kind))).otherwise(out)
    return out


def pseudonym(key: Column, kind: Column, x: Column) -> Column:
    make = {"email": _email, "ip": _ip, "date": _date, "phone": _phone, "card": _card,
            "ssn": lambda k, v: refilled(v, permuted_digits(F.concat(k, F.lit("ssn")), _digits(v)))}
    out = x
    for name in reversed(KINDS):
        out = F.when(kind == name, make[name](key, x)).otherwise(out)
    return out


def pseudonymised(docs: DataFrame, secret: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, the whole ``text`` with every valid value
    replaced by its pseudonym, ``n_<kind>`` for each kind, and ``found``: the
    replaced values' pseudonyms in order.

    Invalid look-alikes stay.  A null text stays null and counts as empty; ids may
    be null or repeated, each row is answered; an empty table gives no rows; other
    columns are not read.
    """
    key = F.lit(secret)
    t = F.coalesce(F.col("text"), F.lit(""))
    hit = t.rlike("[0-9@]") & t.rlike(ANY)
    none = F.array().cast("array<string>")
    cut = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).select(
        "doc_id", "text",
        F.when(hit, F.regexp_extract_all(t, F.lit(ANY), F.lit(0))).otherwise(none).alias("hits"),
        F.when(hit, F.split(t, ANY, -1)).otherwise(none).alias("gaps"),
    )
    named = cut.select("doc_id", "text", "gaps", F.transform("hits", lambda x: F.struct(x.alias("x"), kind_of(x).alias("kind"))).alias("hits"))
    made = named.select("doc_id", "text", "gaps", F.transform(
        "hits", lambda h: F.struct(h["kind"].alias("kind"), pseudonym(key, h["kind"], h["x"]).alias("y"))).alias("hits"))
    pieces = F.zip_with("gaps", "hits", lambda g, h: F.concat(g, F.coalesce(h["y"], F.lit(""))))

    def count(kind: str) -> Column:
        return F.size(F.filter("hits", lambda h: h["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return made.select(
        "doc_id", F.when(F.size("hits") == 0, F.col("text")).otherwise(F.array_join(pieces, "")).alias("text"),
        *[count(k) for k in KINDS],
        F.array_join(F.transform(F.filter("hits", lambda h: h["kind"].isNotNull()), lambda h: h["y"]), "|").alias("found"),
    )
