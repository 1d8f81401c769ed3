"""Date and tax-year texts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_TAX_YEAR = 2025


def date_text(c: Column) -> Column:
    """Normalised text of an 8- or 10-character date; other texts stay as they are."""
    size = F.length(c)
    month_first = F.concat_ws("-", c.substr(5, 4), c.substr(1, 2), c.substr(3, 2))
    year_first = F.concat_ws("-", c.substr(1, 4), c.substr(5, 2), c.substr(7, 2))
    return (
        F.when((size == 8) & c.rlike(r"^(0[1-9]|1[0-2])"), month_first)
        .when(size == 8, year_first)
        .when(size == 10, F.replace(c, F.lit("-"), F.lit("/")))
        .otherwise(c)
    )


def date_value(c: Column) -> Column:
    """The same date as a DATE, or null."""
    text = date_text(c)
    return F.coalesce(
        F.try_to_date(text, "yyyy-MM-dd"), F.try_to_date(text, "MM/dd/yyyy")
    )


def tax_year(c: Column) -> Column:
    """`02025` means 2025; anything else takes the default year."""
    return F.when(c.rlike(r"^0\d{4}$"), c.substr(2, 4).try_cast("int")).otherwise(
        F.lit(DEFAULT_TAX_YEAR)
    )
