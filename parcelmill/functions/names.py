"""Owner-name standardisation and classification."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelmill.functions.text import squeeze, strip

# Legal-entity words.
ENTITY_WORDS = [
    "INCORPORATED", "INC", "CORPORATION", "CORP", "COMPANY", "CO",
    "LIMITED LIABILITY COMPANY", "LLC", "LIMITED PARTNERSHIP", "LP", "L.P.", "LIMITED", "LTD",
    "PARTNERSHIP", "PARTNERS", "TRUST", "ESTATE", "FOUNDATION",
]

# Words that hint at a business.
BUSINESS_WORDS = [
    "PROPERTIES", "INVESTMENTS", "HOLDINGS", "VENTURES", "DEVELOPMENT",
    "REAL ESTATE", "MANAGEMENT", "ASSOCIATES", "PARTNERS", "GROUP",
]

# Trust and estate spellings, applied one after the other.
TRUST_FORMS = [
    (r"(.+)\s+TRUST\b", "$1 TRUST"),
    (r"(.+)\s+ESTATE\s+OF\b", "ESTATE OF $1"),
    (r"ESTATE\s+OF\s+(.+)", "ESTATE OF $1"),
    (r"(.+)\s+FAMILY\s+TRUST", "$1 FAMILY TRUST"),
    (r"(.+)\s+REVOCABLE\s+TRUST", "$1 REVOCABLE TRUST"),
]

# Fixed value: name parts that mark the common owner types.
COMMON_OWNER_TYPES = "LLC|INC|CORP|TRUST|ESTATE"

_LAST_FIRST = r"^([A-Z\s]+),\s*([A-Z\s]+)"


def _any_word(words: list[str]) -> str:
    longest_first = sorted(words, key=len, reverse=True)
    return r"(?<!\w)(" + "|".join(w.replace(".", r"\.") for w in longest_first) + r")(?!\w)"


def standard_name(c: Column) -> Column:
    return squeeze(F.upper(strip(c)))


def match_name(c: Column) -> Column:
    return F.regexp_replace(F.upper(c), r"[^A-Z0-9\s]", "")


def is_entity(name: Column) -> Column:
    return name.rlike(_any_word(ENTITY_WORDS))


def entity_word(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, _any_word(ENTITY_WORDS), 1), F.lit(""))


def is_likely_business(name: Column) -> Column:
    return is_entity(name) | name.rlike(_any_word(BUSINESS_WORDS))


def last_name(name: Column) -> Column:
    return F.when(name.rlike(_LAST_FIRST), F.regexp_extract(name, _LAST_FIRST, 1))


def first_name(name: Column) -> Column:
    return F.when(name.rlike(_LAST_FIRST), F.regexp_extract(name, _LAST_FIRST, 2))


def related_owner_key(name: Column) -> Column:
    first_word = F.nullif(F.regexp_extract(name, r"^(\w+)", 1), F.lit(""))
    return F.coalesce(last_name(name), first_word)


def standard_trust_name(name: Column) -> Column:
    for pattern, form in TRUST_FORMS:
        name = F.regexp_replace(name, pattern, form)
    return name
