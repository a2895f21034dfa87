"""Personal-data redaction (R1, R2) as native regex expressions.

R1 is an ordered chain of `regexp_replace` calls; R2 walks a column's
*schema* while the plan is built, so nested data is redacted with
`transform` / `transform_values` / `struct` and never leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The class tokens and patterns, applied in this order.
# Patterns use no lookaround and `[0-9]` rather than `\d`, so the same text
# runs on Java regex and RE2. Rule 9 keeps the greeting ($1).
RULES: list[tuple[str, str, str]] = [
    ("URL", r"(?i)\bhttps?://[^\s<>\"]*[^\s<>\".,;:!?)]", "URL"),
    ("EMAIL_ADDRESS", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", "EMAIL_ADDRESS"),
    ("IP_ADDRESS", r"\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}\b|\b(?:[0-9A-Fa-f]{1,4}:){5,8}[0-9A-Fa-f]{1,4}\b", "IP_ADDRESS"),
    ("CREDIT_CARD_NUMBER", r"\b(?:[0-9]{4}[ -]?){3}[0-9]{4}\b|\b[0-9]{4}[ -]?[0-9]{6}[ -]?[0-9]{5}\b", "CREDIT_CARD_NUMBER"),
    ("US_SOCIAL_SECURITY_NUMBER", r"\b[0-9]{3}[ .-][0-9]{2}[ .-][0-9]{4}\b", "US_SOCIAL_SECURITY_NUMBER"),
    ("PHONE_NUMBER", r"(?:\(?\+[0-9]{1,3}\)?[ .-]?|\b[0-9][ .-])?(?:\([0-9]{3}\)|\b[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}\b", "PHONE_NUMBER"),
    ("STREET_ADDRESS", r"(?i)\b[0-9]{1,5}(?: [A-Za-z]+){1,3} (?:st|street|ave|avenue|rd|road|blvd|ln|lane|dr|drive)\b\.?(?: (?:apt|suite|unit) [0-9A-Za-z]+)?", "STREET_ADDRESS"),
    ("ZIPCODE", r"\b[0-9]{5}(?:-[0-9]{4})?\b", "ZIPCODE"),
    ("PERSON_NAME", r"\b(Hi|Hello|Hey|Dear) [A-Z][a-z]+\b", "$1 PERSON_NAME"),
]


# Fixed value: the greetings rule 9 anchors a name on (as in its pattern).
GREETINGS = ("Hi", "Hello", "Hey", "Dear")

# Characters a rule cannot match without. Tokens put in by earlier rules
# hold none of them, so testing the original text is exact: a rule whose
# characters are absent is skipped without scanning the text with it.
_NEEDS_URL = ("URL",)
_NEEDS_AT = ("EMAIL_ADDRESS",)
_NEEDS_DIGIT_OR_COLON = ("IP_ADDRESS", "CREDIT_CARD_NUMBER", "US_SOCIAL_SECURITY_NUMBER", "PHONE_NUMBER",
                         "STREET_ADDRESS", "ZIPCODE")


def _chain(out: Column, names: tuple[str, ...]) -> Column:
    for name, pattern, replacement in RULES:
        if name in names:
            out = F.regexp_replace(out, pattern, replacement)
    return out


def redact_text(text) -> Column:
    """Replace personal data in a string column by class tokens.

    The rules run in their fixed order; groups of rules that need `://`,
    `@`, a digit / colon, or a greeting word are skipped for texts without
    them (a cheap substring test instead of a regex scan). Tokens never
    bring these in, so testing the original text is exact.
    """
    t = F.col(text) if isinstance(text, str) else text
    names = [n for n, _, _ in RULES]
    assert names[:2] == ["URL", "EMAIL_ADDRESS"] and tuple(names[2:8]) == _NEEDS_DIGIT_OR_COLON
    out = F.when(F.instr(t, "://") > 0, _chain(t, _NEEDS_URL)).otherwise(t)
    out = F.when(F.instr(t, "@") > 0, _chain(out, _NEEDS_AT)).otherwise(out)
    out = F.when(t.rlike("[0-9]") | (F.instr(t, ":") > 0), _chain(out, _NEEDS_DIGIT_OR_COLON)).otherwise(out)
    greeting = F.lit(False)
    for word in GREETINGS:
        greeting = greeting | (F.instr(t, word + " ") > 0)
    return F.when(greeting, _chain(out, ("PERSON_NAME",))).otherwise(out)


def redacted_type(dt: T.DataType) -> T.DataType:
    """Type of `redact_value` output: scalar leaves become STRING."""
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(redacted_type(dt.elementType), dt.containsNull)
    if isinstance(dt, T.MapType):
        return T.MapType(dt.keyType, redacted_type(dt.valueType), dt.valueContainsNull)
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, redacted_type(f.dataType), f.nullable)
                             for f in dt.fields])
    return T.StringType()


def redact_value(c: Column, dt: T.DataType) -> Column:
    """R2: redact every leaf of a nested value; keys and nulls stay.

    Numbers and booleans are rendered as text first and come back as STRING.
    """
    if isinstance(dt, T.StringType):
        return redact_text(c)
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda x: redact_value(x, dt.elementType))
    if isinstance(dt, T.MapType):
        return F.transform_values(c, lambda k, v: redact_value(v, dt.valueType))
    if isinstance(dt, T.StructType):
        inner = F.struct(*[redact_value(c[f.name], f.dataType).alias(f.name) for f in dt.fields])
        return F.when(c.isNull(), F.lit(None).cast(redacted_type(dt))).otherwise(inner)
    if isinstance(dt, T.BooleanType):
        return redact_text(F.when(c, F.lit("true")).when(~c, F.lit("false")))
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        # whole numbers print without a fraction, as JSON numbers do
        return redact_text(F.when(c == F.floor(c), c.cast("bigint").cast("string"))
                           .otherwise(c.cast("string")))
    return redact_text(c.cast("string"))
