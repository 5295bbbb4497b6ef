"""Format-preserving Feistel pseudonyms for personal data, in DataFrame
functions only.

Found in whole texts: e-mail addresses, payment card numbers (13 to 19 digits
that pass the Luhn test), IBANs (that pass mod 97), telephone numbers, social
security numbers, IPv4 addresses, dates that exist (year-month-day with
hyphens, day.month.year, month/day/year or else day/month/year) and access
keys. Each is replaced within its format, equal values by equal pseudonyms in
every document and different values by different ones:

* the digits, small and capital letters of a value, each kind as one string,
  are permuted by a keyed Feistel network and put back where they stood;
* card numbers keep their first digit and pass the Luhn test, IBANs keep the
  country and pass mod 97, telephone numbers keep a country code's first
  digit, e-mail addresses the last label of the domain;
* the four parts of an IPv4 address are permuted together, as bytes;
* dates are permuted within their span of ``SPAN`` days, whose two factors are
  the sizes of the network's halves, so no result has to be drawn again.

Card numbers and IBANs are looked for first: from every place where one may
start, each part that ends at a token border is tested, and the longest that
passes (for IBANs one of the country's length first) becomes a literal of the
search, so digits or capitals that follow a number stay outside it and are
searched themselves. Telephone numbers end at their country's digit count
where that is fixed; elsewhere the digits after the first ``HEAD`` depend only
on those before them, so a phone's pseudonym does not change with a number
that follows it.

A half becomes itself plus a hash of key, kind, round and the other half,
symbol by symbol, which is a permutation for any length. Values that fail
their test stay as they are.

Defined results: null and empty texts stay as they are, with no finds;
repeated rows are treated alike; an empty table gives an empty result; other
columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import documents, packed, unpacked

KEY = "pseudonym-key-1"
ROUNDS = 8
DIGITS, SMALL, CAPITAL = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Days in a span and its factors; spans begin at ``EPOCH``, and three of them
#: hold the years accepted.
HALVES = (184, 397)
SPAN = HALVES[0] * HALVES[1]
EPOCH, YEARS = "1700-01-01", (1700, 2298)

#: National digits by country code, where their count is fixed.
NATIONAL = {10: "1|7|30|44|52|90|91", 9: "27|31|33|34|41|48|61|351|420|421", 8: "45|47|65"}
FIXED_PHONE = "|".join(rf"(?<![0-9])\+(?:{c})(?:[ .-]?[0-9]){{{n}}}(?![0-9])" for n, c in NATIONAL.items())
#: Digits of other international numbers that are permuted as one.
HEAD = 8
#: Characters of an IBAN, by country.
IBAN_LENGTH = {15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
               22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
               25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
               29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}

PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "key": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})(?![0-9]|[./-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": (r"(?<![0-9.])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"
              r"|" + FIXED_PHONE +
              r"|(?<![0-9])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9])"
              r"|(?<![0-9.-])(?:[0-9]-)?[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9]|-[0-9])"
              r"|(?<![0-9.+-])[0-9]{1,3} \([0-9]{2,4}\) [0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])"),
    "card": r"(?<![0-9A-Za-z.-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z]|[.-][0-9])",
}
#: Where a tested value may start and what may stand around it; the rest of the
#: pattern is then one of the values that passed.
TESTED = {"iban": (r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"), "card": (r"(?<![0-9A-Za-z.-])", r"(?![0-9A-Za-z]|\.[0-9])")}
#: Longest candidates at each place, overlapping.
CANDIDATES = {
    "iban": r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9]))",
    "card": r"(?<![0-9A-Za-z.-])(?=([0-9](?:[ -]?[0-9]){12,18})(?![0-9A-Za-z]|\.[0-9]))",
}
#: A part of a candidate that can be a value by its form. A card number goes on
#: over a hyphen unless its own groups are joined by hyphens.
FORMS = {"iban": r"^[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?$", "card": "^[0-9](?:[ -]?[0-9]){12,18}$"}
#: Every pattern needs one of these; texts without any are not searched.
SIGN = "[0-9@]|AKIA"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once (lambda bodies are not
    searched for common parts)."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _mixed(kind: str, key: str, i: Column, half: Column) -> Column:
    text = F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), F.array_join(half.cast("array<string>"), ","))
    return F.sha2(text.cast("binary"), 256)


def _byte(h: Column, j: Column) -> Column:
    return F.conv(F.substring(h, j % 32 * 2 + 1, F.lit(2)), 16, 10).cast("int")


def feistel(symbols: Column, radix: int, kind: str, key: str = KEY) -> Column:
    """Permutes arrays of integers below ``radix``, of any length."""
    n = F.size(symbols)
    cut = F.floor(n / 2).cast("int")

    def step(s: Column, i: Column) -> Column:
        return let(_mixed(f"{kind}/{radix}", key, i, s["b"]), lambda h: F.struct(
            s["b"].alias("a"),
            F.transform(s["a"], lambda x, j: F.pmod(x + _byte(h, j), F.lit(radix))).alias("b")))

    start = F.struct(F.slice(symbols, F.lit(1), cut).alias("a"), F.slice(symbols, cut + 1, n - cut).alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.concat(s["a"], s["b"]))


def _chars(value: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.substring(value, i, F.lit(1)))


def _symbols(chars: Column, alphabet: str) -> Column:
    held = F.filter(chars, lambda c: F.instr(F.lit(alphabet), c) > 0)
    return F.transform(held, lambda c: F.instr(F.lit(alphabet), c) - 1)


def _digits(value: Column) -> Column:
    return _symbols(_chars(value), DIGITS)


def _refill(value: Column, digits: Column, small: Column, capital: Column) -> Column:
    """``value`` with its digits and letters replaced in order."""
    def step(s: Column, c: Column) -> Column:
        def put(alphabet: str, symbols: Column, name: str) -> Column:
            new = F.substring(F.lit(alphabet), F.get(symbols, s[name]) + 1, F.lit(1))
            return F.struct(F.concat(s["out"], new).alias("out"),
                            *[(s[k] + (1 if k == name else 0)).alias(k) for k in "dlu"])
        return (F.when(F.instr(F.lit(DIGITS), c) > 0, put(DIGITS, digits, "d"))
                .when(F.instr(F.lit(SMALL), c) > 0, put(SMALL, small, "l"))
                .when(F.instr(F.lit(CAPITAL), c) > 0, put(CAPITAL, capital, "u"))
                .otherwise(F.struct(F.concat(s["out"], c).alias("out"), *[(s[k] + 0).alias(k) for k in "dlu"])))

    start = F.struct(F.lit("").alias("out"), *[F.lit(0).alias(k) for k in "dlu"])
    return F.aggregate(_chars(value), start, step, lambda s: s["out"])


def _with_digits(value: Column, digits: Column) -> Column:
    none = F.array().cast("array<int>")
    return let(digits, lambda d: _refill(value, d, none, none))


def permute_shape(value: Column, kind: str, key: str = KEY) -> Column:
    """Digits, small and capital letters permuted, all else in place."""
    sets = F.struct(*[feistel(_symbols(_chars(value), a), len(a), kind, key).alias(k)
                      for k, a in (("d", DIGITS), ("l", SMALL), ("u", CAPITAL))])
    return let(sets, lambda p: _refill(value, p["d"], p["l"], p["u"]))


def luhn_sum(digits: Column) -> Column:
    n = F.size(digits)
    worth = lambda x, j: F.when((n - 1 - j) % 2 == 1, x * 2 - F.when(x > 4, 9).otherwise(0)).otherwise(x)
    return F.aggregate(F.transform(digits, worth), F.lit(0), lambda a, x: a + x)


def _luhn(value: Column) -> Column:
    return luhn_sum(_digits(value)) % 10 == 0


def _card(value: Column, key: str) -> Column:
    def new(d: Column) -> Column:
        n = F.size(d)
        inner = F.concat(F.slice(d, 1, 1), feistel(F.slice(d, F.lit(2), n - 2), 10, "card", key))
        return let(inner, lambda p: F.concat(
            p, F.array(((10 - luhn_sum(F.concat(p, F.array(F.lit(0)))) % 10) % 10).cast("int"))))
    return let(_digits(value), lambda d: F.when(luhn_sum(d) % 10 == 0, _with_digits(value, new(d))).otherwise(value))


def _mod97(text: Column) -> Column:
    """The IBAN remainder of digits and capital letters (A is 10)."""
    at = lambda c: F.instr(F.lit(DIGITS + CAPITAL), c) - 1
    return F.aggregate(_chars(text), F.lit(0), lambda a, c: F.when(at(c) > 9, a * 100 + at(c)).otherwise(a * 10 + at(c)) % 97)


def _iban_fine(value: Column) -> Column:
    plain = F.replace(value, F.lit(" "), F.lit(""))
    return _mod97(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))) == 1


def _iban_whole(value: Column) -> Column:
    """Has it the length of its country?"""
    n, land = F.length(F.replace(value, F.lit(" "), F.lit(""))), F.substring(value, 1, 2)
    out = F.lit(False)
    for length, lands in IBAN_LENGTH.items():
        out = out | ((n == length) & land.isin(lands.split()))
    return out


def _iban(value: Column, key: str) -> Column:
    rest = lambda v: F.substring(v, F.lit(5), F.length(v))

    def new(p: Column) -> Column:  # the permuted value, still with its old check digits
        flat = F.replace(p, F.lit(" "), F.lit(""))
        check = 98 - _mod97(F.concat(rest(flat), F.substring(flat, 1, 2), F.lit("00")))
        return F.concat(F.substring(p, 1, 2), F.lpad(check.cast("string"), 2, "0"), rest(p))

    moved = F.concat(F.substring(value, 1, 4), permute_shape(rest(value), "iban", key))
    return F.when(_iban_fine(value), let(moved, new)).otherwise(value)


def _ip(value: Column, key: str) -> Column:
    parts = F.split(value, r"\.").cast("array<int>")
    fine = F.forall(parts, lambda x: x < 256)
    return F.when(fine, F.array_join(feistel(parts, 256, "ip", key).cast("array<string>"), ".")).otherwise(value)


def _moved_date(day: Column, key: str) -> Column:
    """Another day of the same span."""
    since = F.datediff(day, F.lit(EPOCH).cast("date"))

    def step(s: Column, i: Column) -> Column:
        mixed = lambda half: F.conv(F.substring(_mixed("date", key, i, F.array(half)), 1, 8), 16, 10).cast("long")
        return (F.when(i % 2 == 0, F.struct(((s["a"] + mixed(s["b"])) % HALVES[0]).cast("long").alias("a"), s["b"].alias("b")))
                .otherwise(F.struct(s["a"].alias("a"), ((s["b"] + mixed(s["a"])) % HALVES[1]).cast("long").alias("b"))))

    def moved(n: Column) -> Column:
        pos = n % SPAN
        start = F.struct(F.floor(pos / HALVES[1]).cast("long").alias("a"), (pos % HALVES[1]).cast("long").alias("b"))
        to = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: s["a"] * HALVES[1] + s["b"])
        return F.date_add(F.lit(EPOCH).cast("date"), (n - pos + to).cast("int"))

    return let(since, moved)


def _date(value: Column, key: str) -> Column:
    part = F.split(value, "[./-]").cast("array<int>")
    at = lambda i: F.get(part, F.lit(i))

    def day(y: Column, m: Column, d: Column) -> Column:
        text = F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0"))
        return F.when(y.between(*YEARS), F.try_to_date(text, "yyyy-MM-dd"))

    padded = F.length(value) == 10

    def written(parsed: Column, wide: str, short: str) -> Column:
        return let(_moved_date(parsed, key), lambda d: F.when(padded, F.date_format(d, wide)).otherwise(F.date_format(d, short)))

    iso, dots = day(at(0), at(1), at(2)), day(at(2), at(1), at(0))
    us = day(at(2), at(0), at(1))
    new = (F.when(F.contains(value, F.lit("-")), written(iso, "yyyy-MM-dd", "yyyy-MM-dd"))
           .when(F.contains(value, F.lit(".")), written(dots, "dd.MM.yyyy", "d.M.yyyy"))
           .when(us.isNotNull(), written(us, "MM/dd/yyyy", "M/d/yyyy"))
           .otherwise(written(dots, "dd/MM/yyyy", "d/M/yyyy")))
    return F.coalesce(new, value)


def _phone(value: Column, key: str) -> Column:
    kept = F.when(F.startswith(value, F.lit("+")), 2).otherwise(0)
    whole = F.concat(F.substring(value, F.lit(1), kept),
                     permute_shape(F.substring(value, kept + 1, F.length(value)), "phone", key))
    open_end = F.regexp_like(value, F.lit(r"^\+[0-9 .-]*$")) & ~F.regexp_like(value, F.lit(f"^(?:{FIXED_PHONE})$"))

    def new(d: Column) -> Column:  # the first digit is kept
        head = F.slice(d, F.lit(2), F.lit(HEAD))
        tail = F.transform(F.slice(d, F.lit(HEAD + 2), F.size(d)), lambda x, j: F.pmod(
            x + _byte(_mixed("phone-tail", key, j, F.slice(d, F.lit(1), j + HEAD + 1)), F.lit(0)), F.lit(10)))
        return F.concat(F.slice(d, 1, 1), feistel(head, 10, "phone", key), tail)

    return F.when(open_end, let(_digits(value), lambda d: _with_digits(value, new(d)))).otherwise(whole)


def _email(value: Column, key: str) -> Column:
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    last = F.substring_index(domain, ".", -1)
    labels = F.substring(domain, F.lit(1), F.length(domain) - F.length(last) - 1)
    return F.concat(permute_shape(local, "email", key), F.lit("@"), permute_shape(labels, "domain", key), F.lit("."), last)


def _key(value: Column, key: str) -> Column:
    alphabet = DIGITS + CAPITAL
    new = feistel(_symbols(_chars(F.substring(value, 5, 16)), alphabet), 36, "key", key)
    return F.concat(F.lit("AKIA"), F.array_join(F.transform(new, lambda x: F.substring(F.lit(alphabet), x + 1, F.lit(1))), ""))


MAKERS = {"email": _email, "key": _key, "iban": _iban, "ip": _ip, "date": _date,
          "ssn": lambda v, k: permute_shape(v, "ssn", k), "phone": _phone, "card": _card}


def pseudonym(value: Column, key: str = KEY) -> Column:
    """The pseudonym of one found value; itself if it fails its test."""
    whole = lambda kind: F.regexp_like(value, F.lit(f"^(?:{PATTERNS[kind]})$"))
    out = None
    for kind in PATTERNS:
        out = F.when(whole(kind), MAKERS[kind](value, key)) if out is None else out.when(whole(kind), MAKERS[kind](value, key))
    return out.otherwise(value)


def _values(text: Column, kind: str) -> Column:
    """The distinct values of a tested kind in ``text``, the best at each
    place where one may start."""
    fine = {"iban": _iban_fine, "card": _luhn}[kind]

    def best(c: Column) -> Column:
        ends = F.filter(F.sequence(F.length(c), F.lit(1), F.lit(-1)),
                        lambda i: F.substring(c, i + 1, F.lit(1)).isin("", " ", "-"))
        parts = F.filter(F.transform(ends, lambda i: F.struct(
            F.substring(c, F.lit(1), i).alias("v"), F.substring(c, i + 1, F.lit(1)).alias("next"))),
            lambda p: F.regexp_like(p["v"], F.lit(FORMS[kind])) & ((p["next"] != "-") | F.contains(p["v"], F.lit("-"))))
        good = F.filter(F.transform(parts, lambda p: p["v"]), fine)
        if kind == "iban":
            good = let(good, lambda g: F.concat(F.filter(g, _iban_whole), g))
        return F.get(good, F.lit(0))

    tried = F.array_distinct(F.regexp_extract_all(text, F.lit(CANDIDATES[kind]), F.lit(1)))
    return F.array_distinct(F.filter(F.transform(tried, best), lambda v: v.isNotNull()))


def _any(values: dict[str, Column]) -> Column:
    """The pattern of all that is to be replaced, where ``values`` holds what
    passed its test."""
    parts = []
    for kind, p in PATTERNS.items():
        if kind in values:
            longest_first = F.transform(F.sort_array(F.transform(values[kind], lambda v: F.struct(
                F.length(v).alias("n"), v.alias("v"))), asc=False), lambda x: x["v"])
            before, after = TESTED[kind]
            parts.append(F.when(F.size(values[kind]) > 0, F.concat(
                F.lit(f"(?:{before}(?:"), F.array_join(longest_first, "|"), F.lit(f"){after})"))))
        else:
            parts.append(F.lit(f"(?:{p})"))
    return F.concat_ws("|", *parts)  # without the missing ones


def pseudonymise(docs: DataFrame, text_col: str = "text", key: str = KEY, count_col: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col``, and the number of values
    replaced in ``count_col`` if asked for."""
    text = F.col("text")
    maybe = F.coalesce(F.regexp_like(text, F.lit(SIGN)), F.lit(False))
    none = F.array().cast("array<string>")
    found = (docs.select(packed(docs), F.col(f"`{text_col}`").cast("string").alias("text"))
             .withColumn("values", F.when(maybe, F.struct(*[
                 F.when(F.regexp_like(text, F.lit(CANDIDATES[k])), _values(text, k)).otherwise(none).alias(k) for k in TESTED])))
             .withColumn("any", F.when(maybe, _any({k: F.col("values")[k] for k in TESTED})))
             .withColumn("found", F.when(maybe, F.regexp_extract_all(text, F.col("any"), F.lit(0)))))
    made = found.withColumn("new", F.when(F.size("found") > 0, F.transform("found", lambda m: pseudonym(m, key))))
    # the texts between the finds are one more than the finds
    between = F.split(text, F.col("any"), -1)
    joined = F.array_join(F.flatten(F.zip_with(
        between, F.concat("new", F.array(F.lit(""))), lambda a, b: F.array(a, b))), "")
    out = unpacked(docs, **{text_col: F.when(F.col("new").isNotNull(), joined).otherwise(text)})
    if count_col:
        changed = F.filter(F.zip_with("found", "new", lambda a, b: a != b), lambda x: x)
        out.append(F.when(F.col("new").isNotNull(), F.size(changed)).otherwise(0).alias(count_col))
    return made.select(*out)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return pseudonymise(docs, count_col="n_replaced")
