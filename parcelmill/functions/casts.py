"""Casts that never fail: bad or missing numbers become a default."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelmill.functions.text import strip

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def plain_number_text(c: Column) -> Column:
    """Text without commas and outer blanks where it is a number, else null."""
    cleaned = strip(F.replace(c, F.lit(","), F.lit("")))
    return F.when(cleaned.rlike(_NUMBER), cleaned)


def safe_double(c: Column) -> Column:
    return F.coalesce(plain_number_text(c).try_cast("double"), F.lit(0.0))


def _without_commas(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(""))


def safe_long(c: Column) -> Column:
    """Whole part of the number, toward zero; 0 where it is missing, bad or too large."""
    number = _without_commas(c).try_cast("decimal(38,10)")
    return F.coalesce(number.try_cast("bigint"), F.lit(0))


def safe_int(c: Column) -> Column:
    return F.coalesce(safe_long(c).try_cast("int"), F.lit(0))


def money(c: Column) -> Column:
    """Decimal amount or null; commas and blanks are allowed."""
    return _without_commas(c).try_cast("decimal(18,2)")


def number_or_null(c: Column, sql_type: str) -> Column:
    """The number in `sql_type`, or null."""
    if sql_type == "double":  # a plain cast would accept `1d` and `NaN`
        return plain_number_text(c).try_cast(sql_type)
    return _without_commas(c).try_cast(sql_type)
