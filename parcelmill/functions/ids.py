"""Account identifiers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits in a county's account id.
ID_WIDTH = {"harris": 13, "travis": 12, "dallas": 17}


def digits_padded(c: Column, width: int) -> Column:
    """Digits of `c`, zero-filled on the left; longer ids are kept whole."""
    digits = F.regexp_replace(F.coalesce(c, F.lit("")), r"\D", "")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def has_account_id(c: Column) -> Column:
    """False for null, blank and digitless ids: rows that no account can claim."""
    return F.coalesce(c, F.lit("")).rlike(r"\d")


def account_id(c: Column, county: str) -> Column:
    filled = digits_padded(c, ID_WIDTH[county])
    if county == "travis":
        return F.when(F.coalesce(c, F.lit("")) == "", F.lit("")).otherwise(filled)
    return filled
