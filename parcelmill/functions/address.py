"""Street and zip standardisation."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelmill.functions.text import join_present, squeeze, strip

# Written-out street types and directions with their short forms. Dotted forms
# (`ST.`, `N.E.`) need no entry because the dot is dropped at the end.
STREET_TYPES = {
    "AVENUE": "AVE",
    "BOULEVARD": "BLVD",
    "CIRCLE": "CIR",
    "COURT": "CT",
    "DRIVE": "DR",
    "LANE": "LN",
    "PLACE": "PL",
    "ROAD": "RD",
    "STREET": "ST",
    "TRAIL": "TRL",
    "WAY": "WAY",
}
DIRECTIONS = {
    "NORTH": "N",
    "SOUTH": "S",
    "EAST": "E",
    "WEST": "W",
    "NORTHEAST": "NE",
    "NORTHWEST": "NW",
    "SOUTHEAST": "SE",
    "SOUTHWEST": "SW",
}

_WORD_EDGE = r"(?<=[\p{L}\p{N}_])(?=[^\p{L}\p{N}_])|(?<=[^\p{L}\p{N}_])(?=[\p{L}\p{N}_])"


def standard_address(c: Column) -> Column:
    """Upper case, short street types and directions, single spaces, no punctuation but `-`."""
    pairs = [F.lit(x) for kv in (STREET_TYPES | DIRECTIONS).items() for x in kv]
    short = F.create_map(*pairs)
    words = F.split(F.upper(strip(c)), _WORD_EDGE)
    text = F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(short, w), w)), "")
    return strip(F.regexp_replace(squeeze(text), r"[^\p{L}\p{M}\p{N}_\s-]", ""))


def _first_match(c: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def zip_full(c: Column) -> Column:
    return _first_match(c, r"(\d{5}(?:-\d{4})?)")


def zip5(c: Column) -> Column:
    return _first_match(c, r"(\d{5})")


def zip_characters(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9-]", "")


def numbered_street(number: Column, half: Column, street: Column, building: Column, unit: Column) -> Column:
    """Number, half number, street, `Bldg x`, `Unit y`, skipping what is blank."""
    return join_present(
        " ",
        number,
        half,
        street,
        F.concat(F.lit("Bldg "), F.nullif(strip(building), F.lit(""))),
        F.concat(F.lit("Unit "), F.nullif(strip(unit), F.lit(""))),
    )


def street_with_type(name: Column, street_type: Column) -> Column:
    return F.nullif(join_present(" ", name, street_type), F.lit(""))
