"""Column functions: decimal parsing, timestamps, predicates, fingerprint, percent."""

from datetime import datetime
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratum.functions import columns as C

CASES = [
    ("1.234,56", Decimal("1234.56")),
    ("1234,56", Decimal("1234.56")),
    ("1.234.567,891", Decimal("1234567.89")),
    ("1.234", Decimal("1.23")),
    ("1,234.56", None),
    ("1.234.567", None),
    ("-500.00", Decimal("-500.00")),
    (" 12 ", Decimal("12.00")),
    ("0,005", Decimal("0.01")),
    ("1234.565", Decimal("1234.57")),
    ("1e3", Decimal("1000.00")),
    ("abc", None),
    ("", None),
    ("99999999999999999.99", None),
    (None, None),
]


def test_parse_decimal_cases(spark):
    df = spark.createDataFrame([(t,) for t, _ in CASES], "t string")
    got = [r["d"] for r in df.select(C.parse_decimal("t").alias("d")).collect()]
    assert got == [e for _, e in CASES]


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(-10**12, 10**12))
def test_parse_decimal_brazilian_roundtrip(spark, cents):
    value = Decimal(cents).scaleb(-2)
    us = f"{value:,.2f}"
    br = us.replace(",", "X").replace(".", ",").replace("X", ".")
    row = spark.createDataFrame([(br, us.replace(",", ""))], "br string, plain string").select(
        C.parse_decimal("br").alias("a"), C.parse_decimal("plain").alias("b")
    ).first()
    assert row["a"] == value and row["b"] == value


def test_comma_decimal_is_weaker(spark):
    r = spark.createDataFrame([("1.234,56",), ("10,5",)], "t string").select(C.comma_decimal("t").alias("d")).collect()
    assert [x["d"] for x in r] == [None, Decimal("10.50")]


def test_timestamps(spark):
    run = datetime(2026, 1, 1)
    df = spark.createDataFrame([("2026-01-05 08:00:00", None), ("lixo", "2026-01-02"), ("lixo", None)], "a string, b string")
    got = [r["t"] for r in df.select(C.timestamp_fallback("a", "b", run, "timestamp_ntz").alias("t")).collect()]
    assert got == [datetime(2026, 1, 5, 8), datetime(2026, 1, 2), run]
    assert df.select(C.safe_timestamp("a").alias("t")).filter(F.col("t").isNull()).count() == 2


def test_predicates(spark):
    df = spark.createDataFrame([(None, None, None), ("  ", "X", 0.0), ("a", "ALTA", 5.0)], "s string, sev string, v double")
    rows = df.select(C.is_blank("s").alias("b"), C.not_in_domain("sev", ["ALTA"]).alias("d"), C.not_positive("v").alias("p")).collect()
    assert [tuple(r) for r in rows] == [(True, True, True), (True, True, True), (False, False, False)]


def test_optional_column(spark):
    df = spark.createDataFrame([("1",)], "a string")
    out = df.select(C.optional_column(df, "a", "bigint"), C.optional_column(df, "missing", "date"))
    assert out.columns == ["a", "missing"] and out.first()["a"] == 1 and out.first()["missing"] is None


def test_normalize_path(spark):
    df = spark.createDataFrame([(" dbfs:/Volumes/x/a.csv ",), (None,), ("/x/b.csv",)], "p string")
    assert [r[0] for r in df.select(C.normalize_path("p")).collect()] == ["/Volumes/x/a.csv", "", "/x/b.csv"]


def test_fingerprint_ignores_column_order_and_marks_null(spark):
    import hashlib

    a = spark.createDataFrame([("1", None)], "x string, y string")
    b = a.select("y", "x")
    fa = a.select(C.row_fingerprint(a)).first()[0]
    fb = b.select(C.row_fingerprint(b)).first()[0]
    assert fa == fb == hashlib.sha256("1||∅".encode()).hexdigest()


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10**6), st.integers(1, 10**6))
def test_half_up_percent(spark, n, d):
    got = spark.createDataFrame([(n, d)], "n bigint, d bigint").select(C.half_up_percent("n", "d").alias("p")).first()["p"]
    exact = (Decimal(n) * 100 / Decimal(d)).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")
    assert got == float(exact)
