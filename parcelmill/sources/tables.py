"""Clean-up of raw county tables (strings in, cleaned strings and flags out)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from parcelmill.functions import address, casts, names, text

# Numeric columns whose empty cells become null.
NUMERIC_COLUMNS = [
    "yr_impr", "bld_ar", "land_ar", "acreage", "land_val", "bld_val", "x_features_val", "ag_val",
    "assessed_val", "tot_appr_val", "tot_mkt_val", "prior_land_val", "prior_bld_val",
    "prior_x_features_val", "prior_ag_val", "prior_tot_appr_val", "prior_tot_mkt_val", "pct_own",
]
FLAG_COLUMNS = ["noticed", "protested"]

# The columns that make up the searchable full texts.
FULL_TEXTS = {
    "full_mail_address": (", ", ["mail_addr_1", "mail_addr_2"]),
    "full_property_address": (
        " ",
        ["str_pfx", "str_num", "str_num_sfx", "str", "str_sfx", "str_sfx_dir", "str_unit"],
    ),
    "full_legal_description": (" ", ["lgl_1", "lgl_2", "lgl_3", "lgl_4"]),
}


def _with_each(df: DataFrame, names_in: list[str], change) -> DataFrame:
    """Apply `change` to the listed columns that exist, in one projection."""
    return df.withColumns({c: change(F.col(c)) for c in names_in if c in df.columns})


def strip_quoted_strings(df: DataFrame) -> DataFrame:
    strings = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    return _with_each(df, strings, text.strip_quotes)


def empty_numbers_to_null(df: DataFrame) -> DataFrame:
    return _with_each(df, NUMERIC_COLUMNS, text.empty_to_null)


def upper_flags(df: DataFrame) -> DataFrame:
    return _with_each(df, FLAG_COLUMNS, F.upper)


def with_full_addresses(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            name: F.concat_ws(sep, *[c for c in parts if c in df.columns])
            for name, (sep, parts) in FULL_TEXTS.items()
        }
    )


def clean_accounts(df: DataFrame) -> DataFrame:
    """All account steps: quotes, empty numbers, flags, mail zip and full texts."""
    cleaned = upper_flags(empty_numbers_to_null(strip_quoted_strings(df)))
    return with_full_addresses(_with_each(cleaned, ["mail_zip"], address.zip_characters))


def clean_owners(df: DataFrame) -> DataFrame:
    """Trimmed names, numeric ownership share and the derived flags and match name."""
    return df.withColumns(
        {
            "name": text.strip(F.col("name")),
            "aka": text.strip(F.col("aka")),
            "pct_own": casts.number_or_null(F.col("pct_own"), "double"),
        }
    ).withColumns(
        {
            "is_primary_owner": F.col("ln_num") == 1,
            "is_full_owner": F.col("pct_own") >= 1.0,
            "name_normalized": names.match_name(F.col("name")),
        }
    )
