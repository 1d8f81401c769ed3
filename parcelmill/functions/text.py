"""String clean-up expressions (Column in, Column out)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts read as missing by the delimited reader.
NULL_TOKENS = ["", "NULL", "null", "N/A", "n/a"]


WHITE_SPACE = " \t\r\n\f\x0b"


def strip(c: Column) -> Column:
    """Remove all kinds of white space at both ends (`trim` alone removes only spaces).

    The spaces, of which there may be many, go first: a set of characters is looked up character by character.
    """
    return F.btrim(F.trim(c), F.lit(WHITE_SPACE))


def squeeze(c: Column) -> Column:
    return F.regexp_replace(c, r"\s+", " ")


def strip_quotes(c: Column) -> Column:
    return F.btrim(c, F.lit('"'))


def empty_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def blank_to_null(c: Column) -> Column:
    stripped = strip(c)
    return F.when(stripped != "", stripped)


def tokens_to_null(c: Column) -> Column:
    return F.when(~c.isin(NULL_TOKENS), c)


def text_or_empty(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit(""))


def join_present(separator: str, *parts: Column) -> Column:
    """Join the parts that are neither null nor blank."""
    return F.concat_ws(separator, *[blank_to_null(p) for p in parts])


def is_yes(c: Column) -> Column:
    return c.eqNullSafe(F.lit("Y"))
