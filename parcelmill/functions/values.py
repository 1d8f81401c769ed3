"""Value rules: change against the prior year, effective and repaired market value."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelmill.functions.casts import money
from parcelmill.functions.text import strip

VALUE_LIMIT = 100_000_000
SUSPECT_VALUE = 10_000_000_000
SQ_FT_PER_ACRE = 43_560

# Division code and the property type it stands for.
DIVISION_TYPES = {
    "RES": "Residential",
    "COM": "Commercial",
    "IND": "Industrial",
    "AG": "Agricultural",
    "VAC": "Vacant Land",
    "MIX": "Mixed Use",
    "MULT": "Multi-Family",
    "CONDO": "Condominium",
    "MOBILE": "Mobile Home",
    "RENTAL": "Rental Property",
    "EXEMPT": "Exempt Property",
    "GOV": "Government",
    "CHURCH": "Religious",
    "SCHOOL": "Educational",
    "UTIL": "Utility",
    "MINERAL": "Mineral Rights",
    "TIMBER": "Timber",
    "REC": "Recreational",
    "HIST": "Historical",
    "CONS": "Conservation",
}


def value_change(current: Column, prior: Column) -> Column:
    """Dollar and percent change of two amount texts; blank counts as 0, other text as unknown."""

    def amount(c: Column) -> Column:
        blank = F.coalesce(strip(c), F.lit("")) == ""
        return F.when(blank, F.lit(0)).otherwise(money(c))

    now, before = amount(current).cast("decimal(18,2)"), amount(prior).cast("decimal(18,2)")
    known = now.isNotNull() & before.isNotNull()
    change = now - before
    percent = F.try_divide(change * 100, F.when(before != 0, before))
    return F.struct(
        F.when(known, change).cast("decimal(18,2)").alias("dollar_change"),
        F.when(known, F.bround(percent, 2)).try_cast("decimal(18,2)").alias("percent_change"),
    )


def _in_range(v: Column) -> Column:
    return (v > 0) & (v < VALUE_LIMIT)


def has_usable_value(market: Column, total_market: Column, assessed: Column) -> Column:
    """True where any of the three values lies in (0, 1e8)."""
    hits = [F.coalesce(_in_range(v), F.lit(False)) for v in (market, total_market, assessed)]
    return hits[0] | hits[1] | hits[2]


def effective_value(market: Column, total_market: Column, assessed: Column) -> Column:
    return (
        F.when(_in_range(market), market)
        .when(_in_range(total_market), total_market)
        .otherwise(assessed)
    )


def repaired_value(*candidates: Column) -> Column:
    """First non-zero candidate, scaled down when it is absurdly large; 0 when out of range."""
    raw = F.coalesce(*[F.when(c != 0, c) for c in candidates])
    scaled = raw / VALUE_LIMIT
    return (
        F.when((raw > SUSPECT_VALUE) & _in_range(scaled), scaled.cast("decimal(18,2)"))
        .when(_in_range(raw), raw.cast("decimal(18,2)"))
        .otherwise(F.lit(0).cast("decimal(18,2)"))
    )


def division_type(code: Column) -> Column:
    """Property type of a division code; the empty code is unknown."""
    known = F.create_map(*[F.lit(x) for kv in DIVISION_TYPES.items() for x in kv])
    return (
        F.when(F.coalesce(code, F.lit("")) == "", F.lit("Unknown"))
        .otherwise(
            F.coalesce(
                F.try_element_at(known, F.upper(code)),
                F.concat(F.lit("Other ("), code, F.lit(")")),
            )
        )
    )


def acres_to_sq_ft(acres: Column) -> Column:
    return acres * F.lit(SQ_FT_PER_ACRE)


def owner_label(mail_name: Column, first_owner: Column) -> Column:
    return F.coalesce(
        F.nullif(mail_name, F.lit("")), F.nullif(first_owner, F.lit("")), F.lit("Unknown Owner")
    )


def address_label(street: Column, city: Column, full: Column) -> Column:
    street, city = F.nullif(street, F.lit("")), F.nullif(city, F.lit(""))
    return F.coalesce(
        F.concat(street, F.lit(", "), city), street, F.nullif(full, F.lit("")), F.lit("No Address")
    )


def county_property_type(county: Column, travis: Column, dallas: Column, harris: Column) -> Column:
    """Each county keeps its type in another column."""
    chosen = F.when(county == "travis", travis).when(county == "dallas", dallas).when(
        county == "harris", harris
    )
    return F.coalesce(chosen, F.lit("Unknown"))
