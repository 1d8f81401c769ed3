"""Specifications of a plan: first match per rule list, and all distinct matches."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.takeoff.measures import found
from parcelmill.takeoff.rules import (
    ALL_MATCHES,
    FIRST_MATCH,
    LAST_MATCH_FIELDS,
    NUMBER_RANGES,
    PIPE_SIZE_RANGE,
)


def _groups(pattern: str) -> int:
    return re.compile(pattern).groups


def _match(pattern: str, last: bool) -> Column:
    """First (or last) match on the page: the group if there is one, else the upper-cased text."""
    group = 1 if _groups(pattern) else 0
    if last:
        value = F.try_element_at(found(pattern, group), F.lit(-1))
    else:
        value = F.nullif(F.regexp_extract("text", "(?i)" + pattern, group), F.lit(""))
    return value if group else F.upper(value)


def _numbered(n: int, value: Column) -> Column:
    return F.concat(F.lit(f"{n:02d}|"), value)


def first_match_specs(pages: DataFrame, families: list[str] | None = None) -> DataFrame:
    """(plan_id, family, field, value): per field the earliest rule, then the earliest page."""
    cells = []
    for family in families or list(FIRST_MATCH):
        for field, patterns in FIRST_MATCH[family].items():
            last = field in LAST_MATCH_FIELDS
            hits = [_numbered(n, _match(p, last)) for n, p in enumerate(patterns)]
            # a rejected number must leave later rules a chance, so all rules of the field are kept
            kept = hits if field in NUMBER_RANGES else [F.coalesce(*hits)]
            for hit in kept:
                cells.append(
                    F.struct(
                        F.lit(family).alias("family"),
                        F.lit(field).alias("field"),
                        F.lit(last).alias("last"),
                        hit.alias("coded"),
                    )
                )
    rows = pages.select("plan_id", "page_no", F.inline(F.array(*cells))).filter("coded IS NOT NULL")
    rule = F.col("coded").substr(1, 2)
    value = F.expr("substring(coded, 4)")
    page = F.when(F.col("last"), -F.col("page_no")).otherwise(F.col("page_no"))
    per_rule = rows.groupBy("plan_id", "family", "field", rule.alias("rule")).agg(
        F.min_by(value, page).alias("value")
    )
    accepted = per_rule.filter(_in_range())
    return accepted.groupBy("plan_id", "family", "field").agg(
        F.min_by("value", "rule").alias("value")
    )


def _in_range() -> Column:
    ok = F.lit(True)
    number = F.col("value").try_cast("double")
    for field, (low, high) in NUMBER_RANGES.items():
        ok = ok & ((F.col("field") != field) | F.coalesce(number.between(low, high), F.lit(False)))
    return ok


def all_match_specs(pages: DataFrame, families: list[str] | None = None) -> DataFrame:
    """(plan_id, family, field, value): every distinct match."""
    cells = []
    for family in families or list(ALL_MATCHES):
        for field, patterns in ALL_MATCHES[family].items():
            lists = [
                found(p, 1) if _groups(p) else F.transform(found(p, 0), F.upper) for p in patterns
            ]
            cells.append(_labelled(family, field, F.array_distinct(F.concat(*lists))))
    rows = pages.select("plan_id", F.inline(F.concat(*cells)))
    spaced = F.regexp_replace("value", r"\s*[Xx]\s*", " x ")
    rows = rows.withColumn(
        "value", F.when(F.col("field") == "duct_size", spaced).otherwise(F.col("value"))
    )
    return rows.filter((F.col("field") != "pipe_size") | _pipe_size_ok()).distinct()


def _labelled(family: str, field: str, values: Column) -> Column:
    return F.transform(
        values,
        lambda v: F.struct(
            F.lit(family).alias("family"), F.lit(field).alias("field"), v.alias("value")
        ),
    )


def _pipe_size_ok() -> Column:
    top = F.regexp_extract("value", r"^(\d+)", 1).try_cast("double")
    bottom = F.nullif(F.regexp_extract("value", r"/(\d+)$", 1), F.lit("")).try_cast("double")
    inches = F.try_divide(top, F.coalesce(bottom, F.lit(1.0)))
    return F.coalesce(inches.between(*PIPE_SIZE_RANGE), F.lit(False))


def plan_facts(pages: DataFrame) -> DataFrame:
    """All specifications in long form: one row per first-match field, one per distinct other match."""
    return first_match_specs(pages).unionByName(all_match_specs(pages))
