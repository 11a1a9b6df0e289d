"""PII: keyed pseudonyms that keep the format, in DataFrame functions only.

Numbers and dates that pass their validation are permuted within the values of their format by a Feistel network over
two residues: ROUNDS times one half is moved by a keyed hash of the other. The permutation depends on the key and the kind only, so equal
values stay linked across documents, different ones stay different, and the holder of the key can undo it.

card   13 to 19 digits, also in groups, that pass the Luhn test: first digit kept, the test holds for the pseudonym
phone  North American numbers (area and exchange begin with 2-9): stay such numbers; other numbers with +: the digits behind the first group
ip     four octets: all four
ssn    area, group and serial in their ranges: stay in them
date   days of DAYS from 1900-01-01, as yyyy-mm-dd, dd/mm/yyyy or dd.mm.yyyy: stay such days
email  no number: a keyed digest stands for the part before the @, and the domain is example.invalid

Defined cases: a null text stays null; an empty one stays empty; what looks like a number but fails its validation
stays; repeated rows each give a row; columns other than the two named are kept out; a null id stays null, an empty table empty. A text may be of any length: no
expression here steps back over a repeated group.

Not taken for personal data: telephone numbers in one run of digits (8855559639, +491701234567), days with the month first
(12/31/2020) and days outside 1900-01-01 to 2099-08-04. The key is a literal of the plan: whoever can read plans can undo the pseudonyms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
#: 270 * 270 days: up to 2099-08-04.
DAYS = 72_900
KINDS = ("email", "phone", "card", "ip", "ssn", "date")
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
NORTH = r"(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\)[ ]?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}"
ABROAD = r"\+[0-9]{1,3}(?:[ .-]\(?[0-9]{2,8}\)?){1,5}"
CARD = r"[0-9](?:[ -]?[0-9]){12,18}"
IP = r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[/.][0-9]{2}[/.][0-9]{4}"
FORMS = f"{EMAIL}|(?<![0-9A-Za-z+.-])(?:{SSN}|{DATE}|{IP}|{NORTH}|{ABROAD}|{CARD})(?![0-9A-Za-z]|[.-][0-9])"


def feistel(kind: str, key: str, a: Column, b: Column, size_a: Column, size_b: Column, undo: bool = False) -> Column:
    """struct(a, b): a in 0 .. size_a - 1 and b in 0 .. size_b - 1, permuted among all such pairs."""

    def moved(half: Column, k: Column) -> Column:
        said = F.concat_ws("|", F.lit(key), F.lit(kind), size_a.cast("string"), size_b.cast("string"), k.cast("string"), half.cast("string"))
        return F.conv(F.substring(F.sha2(said, 256), 1, 15), 16, 10).cast("long")

    def step(s: Column, k: Column) -> Column:
        sign = -1 if undo else 1
        even = F.struct(F.pmod(s["a"] + sign * F.pmod(moved(s["b"], k), size_a), size_a).alias("a"), s["b"].alias("b"))
        odd = F.struct(s["a"].alias("a"), F.pmod(s["b"] + sign * F.pmod(moved(s["a"], k), size_b), size_b).alias("b"))
        return F.when(k % 2 == 0, even).otherwise(odd)

    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0), F.lit(-1)) if undo else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(rounds, F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")), step)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _into(form: Column, digits: Column) -> Column:
    """form with its digits replaced, one by one, by those of digits."""
    chars = F.split(form, "")
    done = F.aggregate(
        chars,
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, ch: F.when(ch.rlike("[0-9]"), F.struct(F.concat(s["out"], F.substr(digits, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))).otherwise(F.struct(F.concat(s["out"], ch).alias("out"), s["at"].alias("at"))),
        lambda s: s["out"],
    )
    return done


def _pad(n: Column, width: Column | int) -> Column:
    return F.lpad(n.cast("string"), width if isinstance(width, int) else width.cast("int"), "0")


def _let(value: Column, body) -> Column:
    """body of value, which is made once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _luhn(digits: Column) -> Column:
    """Sum of the Luhn test; the last digit counts once."""
    at = F.sequence(F.lit(1), F.length(digits))
    one = lambda i: F.substr(digits, i, F.lit(1)).cast("int")
    return F.aggregate(at, F.lit(0), lambda s, i: s + F.when((F.length(digits) - i) % 2 == 0, one(i)).otherwise(one(i) * 2 - F.when(one(i) > 4, 9).otherwise(0)))


def _permuted_digits(kind: str, key: str, digits: Column, undo: bool) -> Column:
    """A digit string permuted among those of its length (two digits or more)."""
    n = F.length(digits)
    left = (n / 2).cast("int")
    a, b = F.substr(digits, F.lit(1), left).cast("long"), F.substr(digits, left + 1, n - left).cast("long")
    size = lambda k: F.rpad(F.lit("1"), (k + 1).cast("int"), "0").cast("long")
    return _let(feistel(kind, key, a, b, size(left), size(n - left), undo), lambda s: F.concat(_pad(s["a"], left), _pad(s["b"], n - left)))


def _card(m: Column, key: str, undo: bool) -> Column:
    def of(d: Column) -> Column:
        inner = F.substr(d, F.lit(2), F.length(d) - 2)
        body = F.concat(F.substr(d, F.lit(1), F.lit(1)), _permuted_digits("card", key, inner, undo))
        return _let(body, lambda x: F.concat(x, F.pmod(-_luhn(F.concat(x, F.lit("0"))), F.lit(10)).cast("string")))

    return _into(m, _let(_digits(m), of))


def _north(m: Column, key: str, undo: bool) -> Column:
    def of(d: Column) -> Column:
        ten = F.right(d, F.lit(10))
        n = lambda at, k: F.substring(ten, at, k).cast("long")
        s = feistel("phone", key, (n(1, 3) - 200) * 800 + n(4, 3) - 200, n(7, 4), F.lit(640_000), F.lit(10_000), undo)
        return _let(s, lambda s: F.concat(F.substr(d, F.lit(1), F.length(d) - 10), _pad(F.floor(s["a"] / 800) + 200, 3), _pad(s["a"] % 800 + 200, 3), _pad(s["b"], 4)))

    return _into(m, _let(_digits(m), of))


def _abroad(m: Column, key: str, undo: bool) -> Column:
    first = F.regexp_extract(m, "^[+][0-9]+", 0)
    rest = F.substr(m, F.length(first) + 1)
    return F.concat(first, _into(rest, _let(_digits(rest), lambda d: _permuted_digits("abroad", key, d, undo))))


def _octet(m: Column, k: int) -> Column:
    return F.get(F.split(m, r"\."), F.lit(k)).cast("int")


def _ip(m: Column, key: str, undo: bool) -> Column:
    s = feistel("ip", key, _octet(m, 0) * 256 + _octet(m, 1), _octet(m, 2) * 256 + _octet(m, 3), F.lit(65_536), F.lit(65_536), undo)
    return _let(s, lambda s: F.concat_ws(".", *(x.cast("long").cast("string") for x in (F.floor(s["a"] / 256), s["a"] % 256, F.floor(s["b"] / 256), s["b"] % 256))))


def _ssn(m: Column, key: str, undo: bool) -> Column:
    n = lambda at, k: F.substring(m, at, k).cast("long")
    area = n(1, 3) - F.when(n(1, 3) > 666, 2).otherwise(1)
    s = feistel("ssn", key, area, (n(5, 2) - 1) * 9999 + n(8, 4) - 1, F.lit(898), F.lit(99 * 9999), undo)
    return _let(s, lambda s: F.concat(_pad(s["a"] + F.when(s["a"] >= 665, 2).otherwise(1), 3), F.lit("-"), _pad(F.floor(s["b"] / 9999) + 1, 2), F.lit("-"), _pad(s["b"] % 9999 + 1, 4)))


def _day(m: Column) -> Column:
    """Days since 1900-01-01; null where it is no date."""
    iso = m.rlike("^[0-9]{4}-")
    text = F.when(iso, m).otherwise(F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2), F.substring(m, 1, 2)))
    return F.datediff(F.try_to_date(text, "yyyy-MM-dd"), F.lit("1900-01-01").cast("date"))


def _date(m: Column, key: str, undo: bool) -> Column:
    s = feistel("date", key, F.floor(_day(m) / 270), _day(m) % 270, F.lit(270), F.lit(270), undo)
    day = lambda s: F.date_add(F.lit("1900-01-01").cast("date"), (s["a"] * 270 + s["b"]).cast("int"))
    mark = F.substring(m, 3, 1)
    return _let(s, lambda s: F.when(m.rlike("^[0-9]{4}-"), F.date_format(day(s), "yyyy-MM-dd")).otherwise(F.concat(F.date_format(day(s), "dd"), mark, F.date_format(day(s), "MM"), mark, F.date_format(day(s), "yyyy"))))


def kind_of(m: Column) -> Column:
    """The kind of a match, by its form and validation; null if it fails."""
    whole = lambda p: m.rlike(f"^(?:{p})$")
    part = lambda at, k: F.substring(m, at, k).cast("int")
    ssn = (part(1, 3).between(1, 899)) & (part(1, 3) != 666) & (part(5, 2) > 0) & (part(8, 4) > 0)
    ip = F.forall(F.split(m, r"\."), lambda x: x.cast("int") <= 255)
    return (
        F.when(F.contains(m, F.lit("@")), "email")
        .when(whole(SSN), F.when(ssn, "ssn"))
        .when(whole(DATE), F.when(_day(m).between(0, DAYS - 1), "date"))
        .when(whole(IP), F.when(ip, "ip"))
        .when(whole(NORTH), "phone")
        .when(whole(ABROAD), F.when(F.length(_digits(F.regexp_replace(m, "^[+][0-9]+", ""))).between(4, 16), "abroad"))
        .when(whole(CARD), F.when((_luhn(_digits(m)) % 10 == 0) & (F.length(_digits(m)) >= 13), "card"))
    )


def pseudonym(m: Column, kind: Column, key: str, undo: bool = False) -> Column:
    email = F.concat(F.lit("user-"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(m)), 256), 1, 16), F.lit("@example.invalid"))
    return (
        F.when(kind == "card", _card(m, key, undo)).when(kind == "phone", _north(m, key, undo)).when(kind == "abroad", _abroad(m, key, undo)).when(kind == "ip", _ip(m, key, undo))
        .when(kind == "ssn", _ssn(m, key, undo)).when(kind == "date", _date(m, key, undo)).when((kind == "email") & F.lit(not undo), email).otherwise(m)
    )


def pseudonymised(docs: DataFrame, key: str, undo: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, text with pseudonyms, and the number of each kind, for each row of docs. undo: back again (e-mail addresses stay)."""
    t = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    found = F.when(F.col("text").rlike("[0-9@]"), F.regexp_extract_all("text", F.lit(FORMS), F.lit(0)))
    t = t.withColumn("found", F.coalesce(found, F.array().cast("array<string>")))
    t = t.withColumn("kinds", F.transform("found", kind_of))
    said = F.zip_with("found", "kinds", lambda m, k: pseudonym(m, k, key, undo))
    t = t.withColumn("said", F.when(F.size("found") > 0, said))
    new = F.array_join(F.zip_with(F.split("text", FORMS), "said", lambda p, m: F.concat(p, F.coalesce(m, F.lit("")))), "")
    of = lambda kinds: F.size(F.filter("kinds", lambda k: k.isin(*kinds))).cast("long")
    counts = [of([kind, "abroad"] if kind == "phone" else [kind]).alias(f"n_{kind}") for kind in KINDS]
    return t.select("doc_id", F.when(F.size("found") > 0, new).otherwise(F.col("text")).alias("text"), *counts)
