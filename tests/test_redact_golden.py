"""Redaction classes: two or more values each, and near misses."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from callscope.functions.redact import redact_text, redact_value

GOLDEN = [
    # addresses on the net
    ("Docs are under https://docs.example.org/a/b?page=2 now", "Docs are under URL now"),
    ("mirror http://files.example.net:8080/x", "mirror URL"),
    ("write to team.desk@example.org today", "write to EMAIL_ADDRESS today"),
    ("cc: a+b_c@mail.example.co", "cc: EMAIL_ADDRESS"),
    ("no address: a at example", "no address: a at example"),
    ("host 192.168.7.31 is down", "host IP_ADDRESS is down"),
    ("gateway 8.8.4.4, again", "gateway IP_ADDRESS, again"),
    # numbers
    ("paid by 4242424242424242 today", "paid by CREDIT_CARD_NUMBER today"),
    ("charge 5555555555554444 twice", "charge CREDIT_CARD_NUMBER twice"),
    ("id 219-09-9999 on file", "id US_SOCIAL_SECURITY_NUMBER on file"),
    ("id 078 05 1120 on file", "id US_SOCIAL_SECURITY_NUMBER on file"),
    ("ring 212-555-0147 after six", "ring PHONE_NUMBER after six"),
    ("fax 303.555.0199 works", "fax PHONE_NUMBER works"),
    ("room 12 of 40", "room 12 of 40"),
    ("node fe80:0:0:0:21b:77ff:fe0a:1 answers", "node IP_ADDRESS answers"),
    ("card 3782 822463 10005 expired", "card CREDIT_CARD_NUMBER expired"),
    ("card 4000-0566-5566-5556 expired", "card CREDIT_CARD_NUMBER expired"),
    ("id 457.55.5462 on file", "id US_SOCIAL_SECURITY_NUMBER on file"),
    ("call +44 212 555 0147 now", "call PHONE_NUMBER now"),
    ("call (415) 555-0132 now", "call PHONE_NUMBER now"),
    ("call 4155550132 now", "call PHONE_NUMBER now"),
    ("both 10.0.0.7 and ops@example.net", "both IP_ADDRESS and EMAIL_ADDRESS"),
    # places and names
    ("at 9 Old Mill Road apt 4b, rear", "at STREET_ADDRESS, rear"),
    ("zip 60614-1234 too", "zip ZIPCODE too"),
    ("ship to 77 Maple St please", "ship to STREET_ADDRESS please"),
    ("code 60614 is Chicago", "code ZIPCODE is Chicago"),
    ("Hello Maria", "Hello PERSON_NAME"),
    ("Hey Oskar", "Hey PERSON_NAME"),
    ("the weather is mild", "the weather is mild"),
]


def test_redact_text_golden(spark):
    df = spark.createDataFrame(GOLDEN, "input string, expected string")
    got = df.select("input", "expected", redact_text("input").alias("got")).collect()
    bad = [(r.input, r.expected, r.got) for r in got if r.got != r.expected]
    assert not bad, bad


def test_redact_by_type(spark):
    schema = T.StructType([
        T.StructField("s", T.StringType()),
        T.StructField("a", T.ArrayType(T.StringType())),
        T.StructField("o", T.MapType(T.StringType(), T.StringType())),
        T.StructField("n", T.LongType()),
        T.StructField("st", T.StructType([T.StructField("left", T.StringType()),
                                          T.StructField("right", T.StringType())])),
        T.StructField("z", T.StringType()),
    ])
    df = spark.createDataFrame(
        [("Hello Maria", ["Hey Oskar", "fine"], {"k1": "Hello Maria", "k2": "room 12"},
          60614, {"left": "Hey Oskar", "right": "Hello Maria"}, None)], schema)
    row = df.select(*[redact_value(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields]).first()
    assert row.s == "Hello PERSON_NAME"
    assert row.a == ["Hey PERSON_NAME", "fine"]
    assert row.o == {"k1": "Hello PERSON_NAME", "k2": "room 12"}
    assert row.n == "ZIPCODE"
    assert row.st.asDict() == {"left": "Hey PERSON_NAME", "right": "Hello PERSON_NAME"}
    assert row.z is None
