"""Personal data: format-preserving pseudonyms by keyed Feistel permutations,
in DataFrame functions only.

Found values are validated (check digits, ranges, calendars), taken apart
into numbers with a radix each (a digit has radix 10, a lower-case letter 26,
an octet 256, a day its calendar block), permuted by a Feistel network whose
round function is SHA-512 of key, kind, round and the other half, and put
back into the format they had. The permutation depends on the key and the
value alone, so equal values stay equal in all documents, however they are
spaced, different values stay different, and the holder of the key can undo
it (`inverse=True`). What must be valid stays valid: card and account numbers
get new check digits, dates stay dates, addresses keep octets under 256.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callscope.llm.common import unused

ROUNDS = 5  # pairs of half rounds

# Patterns are linear on long texts: each starts only where no character of
# its own may stand before it, and repeats are bounded, or possessive behind a
# keyword. A first character is tested before anything else, so most positions
# cost one comparison.
PATTERNS: dict[str, str] = {
    "email": r"(?<![\w.%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "ipv4": r"(?=\d)(?<![\w.-])(?:\d{1,3}\.){3}\d{1,3}(?![\w-]|\.\d)",
    # fields of a line and the date of a timestamp, too
    "date": r"(?=\d)(?<![\w./-])(?:\d{4}-\d{2}-\d{2}(?:(?=[Tt]\d{2}|[Zz](?!\w))|(?![\w/-]|\.\d))"
            r"|(?:\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\w/-]|\.\d))",
    "ssn": r"(?=\d)(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-]|\.\d)",
    "phone": r"(?=[+(\d])(?:(?<![\w.+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?![\w])"
             r"|(?<![\w.])\(\d{3}\) ?\d{3}-\d{4}(?![\w-])|(?<![\w.-])\d{3}[-.]\d{3}[-.]\d{4}(?![\w-]|\.\d))",
    "card": r"(?=\d)(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-]|\.\d)",
    "iban": r"(?=[A-Z]{2}\d{2})(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "credential": r"(?=[AaPpTtSs])(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}(?![A-Za-z0-9])"
                  r"|(?i:password|passwd|token|secret|api_?key)\s{0,3}[=:]\s{0,3}[\"']?"
                  r"(?=[A-Za-z+/_.=-]{0,127}\d)(?=[A-Za-z0-9+/_-]{8})[A-Za-z0-9+/_-]++(?:[.=]++[A-Za-z0-9+/_-]++)*+)",
}
# Card and account numbers run into the words beside them, so a text is searched
# for the valid ones among all that start and end where a number may, not for
# its longest matches. A hyphen inside a match is such a place, too.
CARD_START = r"(?=\d)(?:(?<![\w.-])|(?<=\d-)(?<=(?<![\w.-])\d{1,9}-(?:\d{1,9}-(?:\d{1,9}-)?)?))"
CARD_END = r"(?:(?=-\d)|(?![\w-]|\.\d))"
CARD_LONGEST = rf"{CARD_START}(?=(\d(?:[ -]?\d){{12,18}}{CARD_END}))"
IBAN_START = r"(?=[A-Z]{2}\d{2})(?<![A-Za-z0-9])"
IBAN_END = r"(?![A-Za-z0-9])"
IBAN_LONGEST = rf"{IBAN_START}(?=([A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?{IBAN_END}))"
#: Account numbers as long as their country has them.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
IBAN_WHOLE = "^(?:" + "|".join(f"(?:{c.replace(' ', '|')}).{{{n - 2}}}" for n, c in IBAN_LENGTHS.items()) + ")$"


def let(value: Column, fn) -> Column:
    """`fn(value)` with `value` evaluated once."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def feistel(x: Column, radix: Column, tweak: Column, key: str, inverse: bool = False) -> Column:
    """Permute array<int> `x`, where 0 <= x[i] < radix[i], keyed and tweaked.
    Each of the 2 * ROUNDS steps moves one half by a stream made of the other."""
    sign = F.lit(-1 if inverse else 1)

    def run(s: Column) -> Column:
        cut = F.floor(F.size(s["x"]) / F.lit(2)).cast("int")

        def step(state: Column, j: Column) -> Column:
            a, b = state["a"], state["b"]
            left = j % 2 == 0
            moved, other = F.when(left, a).otherwise(b), F.when(left, b).otherwise(a)
            radices = F.when(left, s["ra"]).otherwise(s["rb"])
            seed = F.sha2(F.concat_ws("|", F.lit(key), s["tweak"], j.cast("string"),
                                      F.array_join(other.cast("array<string>"), ",")), 512)
            # a hash moves 32 numbers; each later block of a long half has a hash of its own
            blocks = lambda h, m: F.transform(F.sequence(F.lit(0), F.floor((F.size(m) - 1) / F.lit(32)).cast(
                "int")), lambda n: F.when(n == 0, h).otherwise(F.sha2(F.concat_ws("|", h, n.cast("string")), 512)))
            seeded = let(F.struct(seed.alias("h"), moved.alias("m"), radices.alias("r")), lambda z: F.struct(
                blocks(z["h"], z["m"]).alias("h"), z["m"].alias("m"), z["r"].alias("r")))
            new = let(seeded, lambda z: F.transform(
                z["m"], lambda e, i: F.pmod(e + sign * F.pmod(F.conv(F.substring(
                    F.get(z["h"], F.floor(i / F.lit(32)).cast("int")), (i % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int"),
                    F.get(z["r"], i)), F.get(z["r"], i))))
            return let(new, lambda m: F.struct(F.when(left, m).otherwise(a).alias("a"),
                                               F.when(left, b).otherwise(m).alias("b")))

        last = 2 * ROUNDS - 1
        steps = F.sequence(F.lit(last), F.lit(0)) if inverse else F.sequence(F.lit(0), F.lit(last))
        size = F.size(s["x"])
        halves = F.struct(F.slice(s["x"], F.lit(1), cut).alias("a"), F.slice(s["x"], cut + 1, size - cut).alias("b"))
        return F.aggregate(steps, halves, step, lambda z: F.concat(z["a"], z["b"]))

    def split(s: Column) -> Column:
        cut = F.floor(F.size(s["x"]) / F.lit(2)).cast("int")
        return F.struct(s["x"].alias("x"), s["tweak"].alias("tweak"), F.slice(s["r"], F.lit(1), cut).alias("ra"),
                        F.slice(s["r"], cut + 1, F.size(s["x"]) - cut).alias("rb"))

    return let(let(F.struct(x.alias("x"), radix.alias("r"), tweak.alias("tweak")), split), run)


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _base(c: Column) -> Column:
    """First code of the character's class (digit, upper, lower)."""
    return F.when(c.between("0", "9"), 48).when(c.between("A", "Z"), 65).when(c.between("a", "z"), 97).otherwise(
        F.ascii(c))


def _radix(c: Column, hexadecimal: Column) -> Column:
    letters = F.when(hexadecimal, 6).otherwise(26)
    return F.when(c.between("0", "9"), 10).when(c.between("A", "Z") | c.between("a", "z"), letters).otherwise(1)


def _like(v: Column, plain: Column) -> Column:
    """The letters and digits of `plain` in place of those of `v`."""
    return F.array_join(F.zip_with(F.split(v, "[0-9A-Za-z]", -1), _chars(plain), lambda other, c: F.concat(
        other, F.coalesce(c, F.lit("")))), "")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string whose last digit is the check digit."""
    rev = F.reverse(_chars(digits))
    doubled = F.transform(rev, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, e: a + e)


def mod97(alnum: Column) -> Column:
    """An account number's remainder: letters count 10 to 35."""
    turned = F.concat(F.substring(alnum, F.lit(5), F.length(alnum)), F.substring(alnum, 1, 4))
    return F.aggregate(_chars(turned), F.lit(0), lambda a, c: F.when(
        c.between("0", "9"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))


BLOCK_DAYS = 146_097  # 400 years, 27 * 5411 days
EPOCH = "1600-01-01"


def _day(v: Column, day_first: bool) -> Column:
    """Days since EPOCH of a date in one of the three formats, else null."""
    y = F.regexp_extract(v, r"(\d{4})", 1)
    a, b = F.substring(v, 1, 2), F.substring(v, 4, 2)
    iso = F.when(v.rlike("^\\d{4}"), v).when(v.contains("/") & F.lit(not day_first), F.concat_ws("-", y, a, b)).otherwise(
        F.concat_ws("-", y, b, a))
    return F.datediff(F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).cast("date"), F.to_date(F.lit(EPOCH)))


def _date_text(v: Column, day: Column, day_first: bool) -> Column:
    slash = "dd/MM/yyyy" if day_first else "MM/dd/yyyy"
    return let(F.date_add(F.to_date(F.lit(EPOCH)), day), lambda t: F.when(
        v.rlike("^\\d{4}"), F.date_format(t, "yyyy-MM-dd")).when(v.contains("/"), F.date_format(t, slash)).otherwise(
        F.date_format(t, "dd.MM.yyyy")))


def card_valid(bare: Column) -> Column:
    return F.length(bare).between(13, 19) & (luhn_sum(bare) % 10 == 0) & ~bare.rlike("^(\\d)\\1*$")


def iban_valid(bare: Column) -> Column:
    return F.length(bare).between(15, 34) & (mod97(bare) == 1)


def _numbers(t: Column, longest: str, valid, whole: str, start: str, end: str) -> Column:
    """A pattern (with a bar behind it) of the valid numbers in t and nothing
    else, empty if there are none. Of those with one start that one counts
    which fits `whole`, else the longest."""
    def best(match: Column) -> Column:
        def of(parts: Column) -> Column:
            made = F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda j: F.array_join(
                F.slice(parts, F.lit(1), j), ""))
            good = F.filter(F.transform(made, lambda m: F.struct(m.alias("text"), F.regexp_replace(
                m, "[ -]", "").alias("bare"))), lambda c: valid(c["bare"]))
            return let(good, lambda g: F.coalesce(F.get(F.filter(g, lambda c: c["bare"].rlike(whole)), F.lit(0)),
                                                  F.get(g, F.lit(0)))["text"])

        return let(F.split(match, "(?=[ -])"), of)

    found = F.array_distinct(F.regexp_extract_all(t, F.lit(longest), F.lit(1)))
    numbers = F.array_distinct(F.filter(F.transform(found, best), lambda m: m.isNotNull()))
    # the longest first, for those that begin with another
    return let(F.array_sort(numbers, lambda a, b: F.length(b) - F.length(a)), lambda m: F.when(
        F.size(m) > 0, F.concat(F.lit(f"{start}(?:"), F.array_join(m, "|"), F.lit(f"){end}|"))).otherwise(""))


def pattern_of(t: Column) -> Column:
    """The pattern that finds all values in t, for texts with a digit or an at
    sign: e-mails only where there is one, valid card and account numbers."""
    plain = "|".join(PATTERNS[k] for k in ("ipv4", "date", "ssn", "phone"))
    return F.concat(F.when(t.contains("@"), PATTERNS["email"] + "|").otherwise(""), F.lit(plain + "|"),
                    _numbers(t, CARD_LONGEST, card_valid, "^", CARD_START, CARD_END),
                    _numbers(t, IBAN_LONGEST, iban_valid, IBAN_WHOLE, IBAN_START, IBAN_END), F.lit(PATTERNS["credential"]))


def kind_of(v: Column) -> Column:
    """The kind of a found value: the first pattern that fits it whole."""
    out = None
    for kind, pattern in PATTERNS.items():
        fits = v.rlike(f"^(?:{pattern})$")
        out = F.when(fits, kind) if out is None else out.when(fits, kind)
    return out


def _parts(v: Column, k: Column, day_first: bool) -> Column:
    """How a value of kind k is taken apart: `src` (card and account numbers
    without spaces), lengths h and t of a head and a tail that stay, the
    tweak, numbers of those kinds that have any, and whether it is valid."""
    bare = F.regexp_replace(v, "[ -]", "")
    src = F.when(k.isin("card", "iban"), bare).otherwise(v)
    at = F.instr(v, "@")
    code = F.regexp_extract(v, r"^\+(?:1(?=\D)|\d{1,3}(?=[ .(-])|\d{1,2})", 0)
    head = F.regexp_extract(v, r"^(?:AKIA|(?i:password|passwd|token|secret|api_?key)\s*[=:]\s*[\"']?)", 0)
    h = (F.when(k == "phone", F.length(code)).when(k == "credential", F.length(head)).when(k == "card", 1)
         .when(k == "iban", 4).otherwise(0))
    t = F.when(k == "email", F.length(v) - at + 1).when(k == "card", 1).otherwise(0)
    day = F.when(k == "date", _day(v, day_first))
    n = F.when(k == "ipv4", F.split(v, r"\.").cast("array<int>")).when(k == "ssn", F.split(v, "-").cast("array<int>")).when(
        k == "date", F.array(day))
    valid = (F.when(k == "card", card_valid(bare)).when(k == "iban", iban_valid(bare))
             .when(k == "ipv4", F.forall(F.split(v, r"\."), lambda o: o.rlike("^(?:0|[1-9][0-9]?|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")))
             .when(k == "ssn", v.rlike("^(?!000|666|9)\\d{3}-(?!00)\\d{2}-(?!0000)\\d{4}$"))
             # years 1600 to 9599 are whole blocks
             .when(k == "date", F.coalesce((day >= 0) & (day < 20 * BLOCK_DAYS), F.lit(False))).otherwise(True))
    tweak = (F.when(k == "email", F.concat(k, F.lower(F.substring(v, at, F.length(v))))).when(k == "phone", F.concat(k, code))
             .when(k == "iban", F.concat(k, F.substring(bare, 1, 2)))
             .when(k == "date", F.concat(k, F.floor(day / BLOCK_DAYS).cast("string"))).otherwise(k))
    return F.struct(src.alias("src"), h.cast("int").alias("h"), t.cast("int").alias("t"), tweak.alias("tweak"),
                    n.alias("n"), valid.alias("valid"))


def pseudonym(v: Column, key: str, inverse: bool = False, day_first: bool = False) -> Column:
    """The pseudonym of one found value; a value that is not valid stays.

    What stays: an e-mail's domain, a phone number's country code, an
    account number's country, a card number's first digit, the class of
    every letter and digit (a to f, if all letters are hexadecimal)."""
    def on(k: Column, p: Column) -> Column:
        n = p["n"]
        within = F.pmod(F.get(n, 0), F.lit(BLOCK_DAYS))
        ssn = F.array(F.get(n, 0) - F.when(F.get(n, 0) > 666, 2).otherwise(1), F.get(n, 1) - 1, F.get(n, 2) - 1)
        body = F.substring(p["src"], p["h"] + 1, F.length(p["src"]) - p["h"] - p["t"])
        plain = F.regexp_replace(body, "[^0-9A-Za-z]", "")
        text = let(F.struct(body.alias("body"), plain.alias("plain")), lambda b: F.struct(
            b["body"].alias("body"), _chars(b["plain"]).alias("cs"),
            (b["plain"].rlike("^(?:[0-9a-f]{8,}|[0-9A-F]{8,})$") & b["plain"].rlike("[A-Fa-f]")).alias("hex")))

        def coded(b: Column) -> Column:
            x = (F.when(k == "ipv4", n).when(k == "ssn", ssn)
                 .when(k == "date", F.array(F.floor(within / 5411).cast("int"), within % 5411))
                 .otherwise(F.transform(b["cs"], lambda c: F.ascii(c) - _base(c))))
            radix = (F.when(k == "ipv4", F.array_repeat(F.lit(256), 4))
                     .when(k == "ssn", F.array(F.lit(898), F.lit(99), F.lit(9999)))
                     .when(k == "date", F.array(F.lit(27), F.lit(5411)))
                     .otherwise(F.transform(b["cs"], lambda c: _radix(c, b["hex"]))))
            return let(feistel(x, radix, p["tweak"], key, inverse), lambda y: decode(b, y))

        def decode(b: Column, y: Column) -> Column:
            moved = F.array_join(F.transform(b["cs"], lambda c, i: F.char(_base(c) + F.get(y, i))), "")
            first = F.substring(p["src"], F.lit(1), p["h"])
            last = F.substring(p["src"], F.length(p["src"]) - p["t"] + 1, p["t"])
            country = F.substring(p["src"], 1, 2)
            block = F.floor(F.get(n, 0) / BLOCK_DAYS).cast("int")

            def text_of(m: Column) -> Column:
                check = F.when(k == "card", F.pmod(-luhn_sum(F.concat(first, m, F.lit("0"))), F.lit(10))).when(
                    k == "iban", 98 - mod97(F.concat(country, F.lit("00"), m)))
                whole = F.when(k == "card", F.concat(first, m, check.cast("string"))).otherwise(
                    F.concat(country, F.lpad(check.cast("string"), 2, "0"), m))
                numbered = k.isin("card", "iban")
                inner = let(F.when(numbered, whole).otherwise(m), lambda q: _like(
                    F.when(numbered, v).otherwise(b["body"]), q))
                return F.when(numbered, inner).otherwise(F.concat(first, inner, last))

            return (F.when(k == "ipv4", F.array_join(y.cast("array<string>"), "."))
                    .when(k == "ssn", F.concat_ws("-", F.lpad((F.get(y, 0) + F.when(F.get(y, 0) > 664, 2).otherwise(1)).cast(
                        "string"), 3, "0"), F.lpad((F.get(y, 1) + 1).cast("string"), 2, "0"),
                        F.lpad((F.get(y, 2) + 1).cast("string"), 4, "0")))
                    .when(k == "date", _date_text(v, block * BLOCK_DAYS + F.get(y, 0) * 5411 + F.get(y, 1), day_first))
                    .otherwise(let(moved, text_of)))

        return F.when(p["valid"], let(text, coded)).otherwise(v)

    return let(kind_of(v), lambda k: let(_parts(v, k, day_first), lambda p: on(k, p)))


def pseudonymise(docs: DataFrame, key: str, text: str = "text", inverse: bool = False,
                 day_first: bool = False) -> DataFrame:
    """`docs` with personal data in `text` replaced by pseudonyms, and
    pii_values, the array of struct(kind, pseudonym) in text order (columns
    of that name are replaced); `inverse` restores the values.

    Null text stays null (with a null array), text without findings stays as
    it is (empty array). Values that fail validation (a card number with a
    wrong check digit, the 31st of February) stay. A card or account number
    is found beside other numbers and words ("4111 1111 1111 1111 12/27"): of
    the valid numbers from the first start an account number of its country's
    length, else the longest. `inverse` reads by the same rule, so where the
    digits beside a pseudonym make it a longer valid number by chance (one in
    ten at most), that number cannot be undone. `a/b/yyyy` is month first
    unless `day_first`. Rows are treated one by one; whatever other columns
    there are pass through; an empty table stays empty.
    """
    t = F.col(text)
    # every kind but e-mail holds a digit, e-mail an at sign
    pattern, old, new = unused(docs, "pattern", "found", "new")
    searched = docs.withColumn(pattern, F.when(t.contains("@") | t.rlike("[0-9]"), pattern_of(t)))
    found = searched.withColumn(old, F.when(t.isNull(), F.lit(None)).when(
        F.col(pattern).isNotNull(), F.regexp_extract_all(t, F.col(pattern), F.lit(0))).otherwise(
        F.array().cast("array<string>")))
    made = found.withColumn(new, F.transform(old, lambda v: pseudonym(v, key, inverse, day_first)))
    between = F.split(t, F.col(pattern), -1)
    rebuilt = F.when(F.size(old) > 0, F.array_join(F.flatten(F.zip_with(
        between, new, lambda p, n: F.array(p, F.coalesce(n, F.lit(""))))), "")).otherwise(t)
    changed = F.filter(F.arrays_zip(old, new), lambda z: z[old] != z[new])
    values = F.transform(changed, lambda z: F.struct(kind_of(z[old]).alias("kind"), z[new].alias("pseudonym")))
    return made.withColumns({"pii_values": values, text: rebuilt}).drop(pattern, old, new)
