"""Format-preserving pseudonyms for personal data, DataFrame operations only.

Validated numbers and dates are permuted within their format by a keyed Feistel
network, so a value always gets the same pseudonym, in every document, and two
values never get one:

* payment card numbers (13 to 19 digits that pass the Luhn check): all digits
  but the last are permuted, the last is the check digit again;
* national numbers ddd-dd-dddd with a valid area, group and serial: the valid
  triples are permuted;
* phone numbers: the ten digits after the country code; with or without
  separators behind a ``+`` and a country code or around an area code in
  brackets; bare ten digits (or eleven from 1) if area and exchange are valid
  in the North American plan (2-9, 0-8, any digit; 2-9, two digits);
* IPv4 addresses: all four octets together;
* calendar dates of 1800 to 2199 (yyyy-mm-dd, yyyy/mm/dd, dd.mm.yyyy,
  mm/dd/yyyy, dd/mm/yyyy; day and month with one digit or two; a ``T`` and a
  time may follow): the 146,097 days of that cycle;
* mail addresses are no numbers: the local part becomes a keyed digest.

What does not validate is left as it is.  The key is the caller's secret.

Defined results: null text stays null; empty and clean texts come back unchanged;
separators inside a value stay where they are; other columns are untouched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpath.llm.common import boxed
from touchpath.llm.native import let

ROUNDS = 10

# --- fixed values of the formats ---------------------------------------------
MAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+"
IP = r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])"
DATE = (r"(?<![0-9A-Za-z])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})"
        r"(?![0-9A-SU-Za-su-z]|[Tt](?![0-9]{2}))")
NATIONAL = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
CARD = r"(?<![0-9A-Za-z.-])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z]|[.-][0-9])"
PHONE = (r"(?<![0-9A-Za-z+(.])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
         r"|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}|(?<![-_$])1?[2-9][0-8][0-9][2-9][0-9]{6})(?![0-9A-Za-z]|[.-][0-9])")
ANY = "|".join((MAIL, IP, DATE, NATIONAL, CARD, PHONE))
#: A text without this has none of them.
HINT = r"@|[0-9][./-][0-9]|[0-9]{13}|[0-9]{3}[)]?[ .-]?[0-9]{3}|[0-9]{4}[ -][0-9]"
KINDS = ["card", "national", "phone", "ip", "date", "mail"]
#: 400 Gregorian years: 146,097 = 189 * 773 days from this date.
FIRST_DAY, DAYS = "1800-01-01", (189, 773)
#: Areas 001-665 and 667-899 of national numbers.
AREAS = 898


def _word(key: str, tweak: str, r: Column, half: Column) -> Column:
    """48 keyed pseudo-random bits for a round."""
    text = F.concat(F.lit(f"{key}|{tweak}|"), r.cast("string"), F.lit("|"), half.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long")


def feistel(value: Column, left: Column, right: Column, key: str, tweak: str) -> Column:
    """Keyed permutation of 0 .. left * right - 1: the two halves of the value
    are shifted in turn by a keyed function of the other one."""
    halves = F.struct(value.cast("long").alias("v"), right.cast("long").alias("m"))
    start = let(halves, lambda h: F.struct(F.call_function("div", h["v"], h["m"]).alias("a"), (h["v"] % h["m"]).alias("b")))

    def turn(s: Column, r: Column) -> Column:
        even = F.struct(((s["a"] + _word(key, tweak, r, s["b"])) % left).alias("a"), s["b"].alias("b"))
        odd = F.struct(s["a"].alias("a"), ((s["b"] + _word(key, tweak, r, s["a"])) % right).alias("b"))
        return F.when(r % 2 == 0, even).otherwise(odd)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: s["a"] * right + s["b"])


def luhn(digits: Column, shift: int = 0) -> Column:
    """The Luhn sum; with ``shift`` 1, as if one more digit 0 followed."""

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return acc + F.when((i + shift) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)


def digits_of(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced by ``digits``, in order."""
    chars = F.split(shape, "")

    def put(acc: Column, c: Column) -> Column:
        is_digit = c.rlike("^[0-9]$")
        new = F.when(is_digit, F.substring(digits, acc["n"] + 1, F.lit(1))).otherwise(c)
        return F.struct(F.concat(acc["s"], new).alias("s"), (acc["n"] + is_digit.cast("int")).alias("n"))

    return F.aggregate(chars, F.struct(F.lit("").alias("s"), F.lit(0).alias("n")), put, lambda a: a["s"])


def _long(s: Column) -> Column:
    return s.cast("long")


def _power(n: Column) -> Column:
    return F.pow(F.lit(10.0), n).cast("long")


def _card(m: Column, key: str) -> Column:
    def build(d: Column) -> Column:
        n = F.length(d) - 1
        high = F.floor(n / 2).cast("int")
        body = F.lpad(feistel(_long(F.substring(d, F.lit(1), n)), _power(high), _power(n - high), key, "card").cast("string"), n, F.lit("0"))
        return let(body, lambda b: refill(m, F.concat(b, ((10 - luhn(b, 1) % 10) % 10).cast("string"))))

    return let(digits_of(m), build)


def _national(m: Column, key: str) -> Column:
    area, group, serial = (_long(F.substring(m, *p)) for p in ((1, 3), (5, 2), (8, 4)))
    index = (area - 1 - (area > 666).cast("long")) * (99 * 9999) + (group - 1) * 9999 + serial - 1

    def build(v: Column) -> Column:
        a = F.floor(v / (99 * 9999)).cast("long")
        a = a + 1 + (a >= 665).cast("long")
        rest = v % (99 * 9999)
        return F.concat_ws("-", F.lpad(a.cast("string"), 3, "0"), F.lpad((F.floor(rest / 9999).cast("long") + 1).cast("string"), 2, "0"),
                           F.lpad((rest % 9999 + 1).cast("string"), 4, "0"))

    return let(feistel(index, F.lit(AREAS * 9).cast("long"), F.lit(11 * 9999).cast("long"), key, "national"), build)


def _national_ok(m: Column) -> Column:
    return m.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")


def _phone(m: Column, key: str) -> Column:
    def build(d: Column) -> Column:
        body = feistel(_long(F.substring(d, F.length(d) - 9, F.lit(10))), F.lit(100_000).cast("long"), F.lit(100_000).cast("long"), key, "phone")
        return refill(m, F.concat(F.substring(d, F.lit(1), F.length(d) - 10), F.lpad(body.cast("string"), 10, "0")))

    return let(digits_of(m), build)


def _ip(m: Column, key: str) -> Column:
    value = F.aggregate(F.split(m, "\\."), F.lit(0).cast("long"), lambda a, x: a * 256 + x.cast("long"))
    half = F.lit(65536).cast("long")

    def build(v: Column) -> Column:
        return F.concat_ws(".", *[F.shiftright(v, 24 - 8 * i).bitwiseAND(F.lit(255).cast("long")).cast("string") for i in range(4)])

    return let(feistel(value, half, half, key, "ip"), build)


def _ip_ok(m: Column) -> Column:
    return m.rlike("^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\\.|$)){4}$")


def _iso(part: Column, *order: int) -> Column:
    """yyyy-mm-dd of a date's parts, in the given order."""
    year, month, day = (part[i] for i in order)
    return F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))


def _day(m: Column) -> Column:
    """The date that a match stands for (mm/dd before dd/mm), or null."""
    part = F.split(m, "[-/.]")
    iso = F.when(m.rlike("^[0-9]{4}"), _iso(part, 0, 1, 2))
    dot = F.when(m.contains("."), _iso(part, 2, 1, 0))
    us, eu = _iso(part, 2, 0, 1), _iso(part, 2, 1, 0)
    parsed = F.coalesce(F.coalesce(iso, dot).try_cast("date"), F.when(iso.isNull() & dot.isNull(), F.coalesce(us.try_cast("date"), eu.try_cast("date"))))
    return F.when(parsed.between(F.lit("1800-01-01").cast("date"), F.lit("2199-12-31").cast("date")), parsed)


def _date(m: Column, key: str) -> Column:
    first = F.lit(FIRST_DAY).cast("date")

    def build(day: Column) -> Column:
        index = F.datediff(day, first).cast("long")
        new = F.date_add(first, feistel(index, *[F.lit(x).cast("long") for x in DAYS], key, "date").cast("int"))

        def show(d: Column) -> Column:
            american = _iso(F.split(m, "[-/.]"), 2, 0, 1).try_cast("date").isNotNull()

            def form(wide: str, narrow: str) -> Column:
                return F.when(m.rlike("(?<![0-9])[0-9](?![0-9])"), F.date_format(d, narrow)).otherwise(F.date_format(d, wide))

            return (F.when(m.rlike("^[0-9]{4}-"), form("yyyy-MM-dd", "yyyy-M-d")).when(m.rlike("^[0-9]{4}/"), form("yyyy/MM/dd", "yyyy/M/d"))
                    .when(m.contains("."), form("dd.MM.yyyy", "d.M.yyyy")).when(american, form("MM/dd/yyyy", "M/d/yyyy")).otherwise(form("dd/MM/yyyy", "d/M/yyyy")))

        return let(new, show)

    return let(_day(m), build)


def _mail(m: Column, key: str) -> Column:
    at = F.locate("@", m)
    return F.concat(F.lit("p"), F.substring(F.sha2(F.concat(F.lit(f"{key}|mail|"), F.lower(m)), 256), 1, 16), F.substring(m, at, F.length(m)))


def pseudonym(m: Column, key: str) -> Column:
    """struct(kind, value): the pseudonym of a match, or the match itself with
    a null kind if it is no valid number or date."""

    def of(kind: str, value: Callable[[Column, str], Column]) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value(m, key).alias("value"))

    bare = digits_of(m)
    return (F.when(m.contains("@"), of("mail", _mail))
            .when(m.rlike("^[0-9]{1,3}(?:\\.[0-9]{1,3}){3}$"), F.when(_ip_ok(m), of("ip", _ip)).otherwise(_same(m)))
            .when(m.rlike(f"^{DATE}$"), F.when(_day(m).isNotNull(), of("date", _date)).otherwise(_same(m)))
            .when(m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), F.when(_national_ok(m), of("national", _national)).otherwise(_same(m)))
            .when(m.rlike(f"^(?:{CARD})$"), F.when(F.length(bare).between(13, 19) & (luhn(bare) % 10 == 0), of("card", _card)).otherwise(_same(m)))
            .otherwise(of("phone", _phone)))


def _same(m: Column) -> Column:
    return F.struct(F.lit(None).cast("string").alias("kind"), m.alias("value"))


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced, and a count per
    kind (n_card, n_national, ..: columns of these names are replaced)."""
    docs = docs.drop(*[f"n_{k}" for k in KINDS])
    text = F.col(f"row.`{text_col}`").cast("string")
    pair = F.struct(F.split(text, ANY, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)).alias("whole"))

    def joined(p: Column) -> Column:
        def fill(new: Column) -> Column:
            heads = F.zip_with(F.slice(p["gaps"], F.lit(1), F.size(new)), new, lambda g, x: F.concat(g, x["value"]))
            return F.struct(F.concat(F.array_join(heads, ""), F.element_at(p["gaps"], -1)).alias("text"), F.transform(new, lambda x: x["kind"]).alias("kinds"))

        return let(F.transform(p["whole"], lambda m: pseudonym(m, key)), fill)

    clean = F.struct(text.alias("text"), F.array().cast("array<string>").alias("kinds"))
    done = boxed(docs).withColumn("new", F.when(text.rlike(HINT), let(pair, joined)).otherwise(clean))
    cols = [F.col("new.text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return done.select(*cols, *[_count(F.col("new.kinds"), k).alias(f"n_{k}") for k in KINDS])


def _count(kinds: Column, kind: str) -> Column:
    return F.size(F.filter(kinds, lambda x: x == kind)).cast("long")
