from decimal import Decimal

from pyspark.sql import functions as F

from walletscope import functions as fn


def one(spark, column, **values):
    names = list(values)
    schema = ", ".join(f"{n} {'bigint' if isinstance(values[n], int) else 'string'}" for n in names)
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


def test_event_id_known_value(spark):
    got = one(spark, fn.event_id("c", "a", "l", "h"), c="ton", a="EQTest", l=123, h="hash123")
    assert got == "72d9adb7ce4f9ddf"


def test_event_id_parts_matter_and_null_spreads(spark):
    rows = spark.createDataFrame(
        [("ton", "a", 1, "h"), ("ton", "a", 2, "h"), ("ton", "b", 1, "h"), ("ton", "a", 1, "g"),
         ("ton", None, 1, "h")], "c string, a string, l bigint, h string")
    ids = [r[0] for r in rows.select(fn.event_id("c", "a", "l", "h")).collect()]
    assert len(set(ids[:4])) == 4 and ids[4] is None and all(len(i) == 16 for i in ids[:4])


def test_short_event_id_has_empty_address(spark):
    a = one(spark, fn.event_id_short("c", "l", "h"), c="ton", l=5, h="x")
    b = one(spark, fn.event_id("c", F.lit(""), "l", "h"), c="ton", l=5, h="x")
    assert a == b


BAD_CURSORS = ["", "   ", "12345", "12345:", "12345:   ", "not-a-number:abc123",
               "1:2:3", "99999999999999999999:x", "1.5:x", None]


def test_cursor_rejects(spark):
    df = spark.createDataFrame([(text,) for text in BAD_CURSORS], "v string")
    assert all(r.p is None for r in df.select(fn.parse_cursor("v").alias("p")).collect())


def test_cursor_round_trip(spark):
    df = spark.createDataFrame([("12345:abc123",), ("-7:x",)], "v string")
    back = df.select("v", fn.parse_cursor("v").alias("p")).select(
        "v", "p.*", fn.cursor_text("p.primary", "p.secondary").alias("again")).collect()
    assert [(r.primary, r.secondary) for r in back] == [(12345, "abc123"), (-7, "x")]
    assert all(r.v == r.again for r in back)


INTEGERS = [
    ("999999999999999999999999999999999", "999999999999999999999999999999999"), ("invalid", "0"),
    ("", "0"), (None, "0"), (" 42 ", "42"), ("+007", "7"), ("-05", "-5"), ("-0", "0"), ("1e12", "0"),
    ("12.5", "0"), ("9" * 60, "9" * 60), ("0", "0")]


def test_canonical_integer(spark):
    df = spark.createDataFrame([(text,) for text, _ in INTEGERS], "v string").coalesce(1)
    assert [r[0] for r in df.select(fn.canonical_integer(F.col("v"))).collect()] == [e for _, e in INTEGERS]


AMOUNTS = [
    ("150000000000", Decimal("150")), ("1", Decimal("0.000000001")), ("-5000000000", Decimal("-5")),
    ("79228162514264337593543950335", Decimal("79228162514264337593.543950335")),
    ("79228162514264337593543950336", None), ("9" * 35, None)]


def test_units_exact(spark):
    df = spark.createDataFrame([(text,) for text, _ in AMOUNTS], "v string").coalesce(1)
    got = df.select(fn.units(F.col("v"))).collect()
    assert [r[0] for r in got] == [e for _, e in AMOUNTS]


def test_sanitize_removes_both_forms(spark):
    dirty = 'text\\u0000null\x00 and \\u0001\x01 but \\u0002'
    assert one(spark, fn.sanitize_json(F.col("v")), v=dirty) == "textnull and  but \\u0002"


def test_short_address_edges(spark):
    df = spark.createDataFrame([("1234567890",), ("12345678901",)], "v string")
    assert [r[0] for r in df.select(fn.short_address(F.col("v"))).collect()] == [
        "1234567890", "1234567890..."]


def test_lease_key_round_trip(spark):
    df = spark.createDataFrame([("ton", "tonapi", "0:ab:cd")], "c string, p string, a string")
    row = df.select(fn.lease_key("c", "p", "a").alias("k")).select(
        "k", fn.lease_parts("k").alias("q")).select("k", "q.*").first()
    assert tuple(row) == ("ton:tonapi:0:ab:cd", "ton", "tonapi", "0:ab:cd")


def test_correlation_id_order_and_shape(spark):
    df = spark.createDataFrame([("h", "b"), (None, "b"), (None, None)], "h string, b string")
    got = [r[0] for r in df.select(fn.correlation_id("h", "b")).collect()]
    assert got[:2] == ["h", "b"] and len(got[2]) == 32 and "-" not in got[2]


def test_plain_amount(spark):
    df = spark.createDataFrame([(Decimal("150"),), (Decimal("123.45"),), (Decimal("0.000000001"),)],
                               "v decimal(38,9)")
    assert [r[0] for r in df.select(fn.plain_amount(F.col("v"))).collect()] == ["150", "123.45", "0.000000001"]
