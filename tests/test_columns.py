"""Column functions on boundary, malformed and missing values."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerstrata.functions import bands, lineage, text, values


def apply(spark, kind, inputs, *columns):
    """Outputs of column builders for each input, in order."""
    df = spark.createDataFrame(list(enumerate(inputs)), f"i int, x {kind}")
    built = [c(F.col("x")) for c in columns]
    rows = df.select("i", *(b.alias(f"c{n}") for n, b in enumerate(built))).orderBy("i").collect()
    return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in rows]


MONEY = "decimal(20,2)"


def money(*texts):
    return [None if t is None else Decimal(t) for t in texts]


@pytest.mark.parametrize(("builder", "kind", "inputs", "wanted"), [
    (bands.transaction_value, MONEY, money("-1", "0", "100", "100.01", "1000", "1000.01", None),
     ["Low Value"] * 3 + ["Medium Value"] * 2 + ["High Value", "Low Value"]),
    (bands.income_segment, MONEY, money("25000", "25000.01", "50000", "50000.01", None),
     ["Low Income", "Medium Income", "Medium Income", "High Income", "Low Income"]),
    (bands.customer_tier, MONEY, money("25000", "25000.01", "50000.01", "80000", "80000.01", None),
     ["Standard", "Silver", "Gold", "Gold", "Premium", "Standard"]),
    (bands.age_group, "int", [24, 25, 44, 45, 64, 65, None],
     ["Young", "Middle-aged", "Middle-aged", "Mature", "Mature", "Senior", "Senior"]),
    (bands.time_period, "int", [0, 8, 9, 17, 18, 23, None],
     ["Night", "Night", "Business Hours", "Business Hours", "Evening", "Evening", "Night"]),
    (bands.day_type, "int", [1, 2, 3, 4, 5, 6, 7, None],
     ["Weekend"] + ["Weekday"] * 5 + ["Weekend", "Weekday"]),
])
def test_bands(spark, builder, kind, inputs, wanted):
    assert apply(spark, kind, inputs, builder) == wanted


ADDRESSES = ["Hlavní 123, Praha, 11000", "Václavské náměstí 1, Praha, 11000", "28. října, Brno, 60200",
             "Hlavní 12a / 3B, Praha, 11000", "jen ulice", "", None]


def test_address_parts(spark):
    got = apply(spark, "string", ADDRESSES, *(lambda x, i=i: text.address_parts(x, True)[i] for i in range(3)))
    assert got[0] == ("Hlavní 123", "Praha", "11000")
    assert got[4] == ("jen ulice", None, None)
    assert got[5] == ("", None, None) and got[6] == (None, None, None)
    assert apply(spark, "string", ADDRESSES[:1], lambda x: text.address_parts(x, False)[1]) == [" Praha"]


def test_first_word_street(spark):
    assert apply(spark, "string", ADDRESSES[:3], lambda x: text.first_word_street(
        text.address_parts(x, True)[0], True)[0]) == ["Hlavní", "Václavské", "28."]
    assert apply(spark, "string", ADDRESSES[:3], lambda x: text.first_word_street(
        text.address_parts(x, True)[0], True)[1]) == ["123", "náměstí", "října"]
    assert apply(spark, "string", ADDRESSES[:3], lambda x: text.first_word_street(
        text.address_parts(x, False)[0], False)[1]) == [None, None, None]


def test_trailing_number_street(spark):
    lines = ["Václavské náměstí 1", "28. října", "Hlavní 12a / 3B", "Hlavní 123 ", None]
    got = apply(spark, "string", lines, *(lambda x, i=i: text.trailing_number_street(x)[i] for i in (0, 1)))
    assert got == [("Václavské náměstí", "1"), ("28. října", ""), ("Hlavní", "12a / 3B"), ("Hlavní", "123"),
                   (None, None)]


def test_phone_parts(spark):
    phones = ["+420 123 456 789", "123 456 789", "+420123456789", "12345", None]
    got = apply(spark, "string", phones, *(lambda x, i=i: text.phone_parts(x)[i] for i in (0, 1)))
    assert got == [("+420", "123456789"), (None, "123456789"), ("+420123456789", "123456789"),
                   (None, "12345"), (None, None)]


def test_casts(spark):
    assert apply(spark, "string", ["12.345", "12,5", "", "1e3", None], values.money) == [
        Decimal("12.35"), None, None, Decimal("1000.00"), None]
    assert apply(spark, "string", ["4.0", "4.999", "4", "-2.5", "x", "", None], values.whole) == [
        4, 4, 4, -2, None, None, None]
    assert apply(spark, "string", ["31.12.2024", "2024-01-15 14:30:00", "2024-02-30", None], values.day) == [
        None, dt.date(2024, 1, 15), None, None]
    assert apply(spark, "string", ["2024-01-15 14:30:00", "2024-01-15", "x"], values.moment) == [
        dt.datetime(2024, 1, 15, 14, 30), dt.datetime(2024, 1, 15), None]


def test_age_and_tenure(spark):
    as_of = F.lit("2024-06-30").cast("date")
    born = [dt.date(1980, 12, 1), dt.date(2024, 1, 1), None]
    assert apply(spark, "date", born, lambda x: values.years_between(x, as_of)) == [44, 0, None]
    assert apply(spark, "date", [dt.date(2024, 6, 1), dt.date(2024, 7, 1), None],
                 lambda x: values.days_since(x, as_of)) == [29, -1, None]


def test_snapshot_date(spark):
    paths = ["file:/v/landing_data/customers/2024.01.31/a.csv", "file:/v/landing_data/customers/a.csv",
             "file:/v/landing_data/customers/2024.13.40/a.csv", "file:/v/other/2024.01.31/a.csv", None]
    assert apply(spark, "string", paths, lineage.snapshot_date) == [
        dt.date(2024, 1, 31), None, None, None, None]
