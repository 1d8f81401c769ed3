"""Areas, lengths, heights and fixture counts of plan texts.

Each page is searched on its own and the findings are combined per plan with aggregates that combine
before the shuffle, so a plan of any size is never gathered in one place.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.takeoff.rules import (
    CEILING_HEIGHT,
    DIMENSION_FALLBACK,
    DIMENSION_PAIRS,
    FIXTURES,
    FLOOR_AREA,
    LENGTH,
    TOTAL_AREA,
    WINDOW_LIMIT,
)


def found(pattern: str, group: int = 1, any_case: bool = True) -> Column:
    """All matches of a group in `text`."""
    return F.regexp_extract_all("text", F.lit(("(?i)" if any_case else "") + pattern), F.lit(group))


def numbered_matches(rule: int, pattern: str) -> Column:
    """All matches with the number of their rule and their order: (rule_no, pos, written)."""
    return F.transform(
        found(pattern),
        lambda x, i: F.struct(
            F.lit(rule).alias("rule_no"), i.alias("pos"), x.alias("written")
        ),
    )


def feet(c: Column) -> Column:
    """Feet of a written length: `F'-I"`, `F'`, `I"`, or a bare number; 0 when there is none."""
    text = F.regexp_replace(F.trim(c), r"\s+", " ")
    pair = r"^(\d+)['\"]?\s*-\s*(\d+)['\"]?"

    def number(pattern: str, group: int = 1) -> Column:
        return F.regexp_extract(text, pattern, group).try_cast("double")

    return (
        F.when(text.rlike(pair), number(pair) + number(pair, 2) / 12)
        .when(text.rlike(r"^\d+'"), number(r"^(\d+)'"))
        .when(text.rlike(r'^\d+"'), number(r'^(\d+)"') / 12)
        .otherwise(F.coalesce(number(r"(\d+)"), F.lit(0.0)))
    )


def total_area(pages: DataFrame) -> DataFrame:
    """Largest area of the plan in 800-5,000, else its largest in 500-10,000; null for none."""
    numbers = F.concat(*[found(p) for p in TOTAL_AREA])
    areas = F.filter(
        F.transform(numbers, lambda x: x.try_cast("int")), lambda x: x.between(500, 10_000)
    )
    per_page = pages.select(
        "plan_id",
        F.array_max(F.filter(areas, lambda x: x.between(800, 5_000))).alias("likely"),
        F.array_max(areas).alias("any"),
    )
    return per_page.groupBy("plan_id").agg(
        F.coalesce(F.max("likely"), F.max("any")).alias("total_sqft")
    )


def floor_areas(pages: DataFrame) -> DataFrame:
    """Largest area of at least 50 per plan and floor."""
    pairs = pages.select(
        "plan_id", found(FLOOR_AREA).alias("name"), found(FLOOR_AREA, 2).alias("area")
    ).select("plan_id", F.inline(F.arrays_zip("name", "area")))
    sized = pairs.select(
        "plan_id",
        F.concat(F.lower("name"), F.lit("_floor")).alias("floor"),
        F.col("area").try_cast("int").alias("area"),
    )
    return sized.filter("area >= 50").groupBy("plan_id", "floor").agg(F.max("area").alias("area"))


def _pairs(pattern: str) -> Column:
    whole = found(f"({pattern})", 1)
    return F.transform(
        whole,
        lambda x: F.struct(
            F.regexp_extract(x, "(?i)" + pattern, 1).alias("width"),
            F.regexp_extract(x, "(?i)" + pattern, 2).alias("length"),
        ),
    )


def dimensions(pages: DataFrame) -> DataFrame:
    """Width and length pairs per plan with their area, in the order of rule, page and place.

    Full spellings are kept within 5-50 ft, bare numbers within 3-60 ft; a pair of which both sides are
    closer than 0.1 ft to an earlier kept pair is left out. Equal pairs are combined before they meet.
    """
    rules = [(p, 5, 50) for p in DIMENSION_PAIRS] + [(DIMENSION_FALLBACK, 3, 60)]

    def spot(n: int, low: int, high: int):
        fixed = [F.lit(v).alias(k) for k, v in (("rule_no", n), ("low", low), ("high", high))]
        return lambda x, i: F.struct(*fixed, i.alias("pos"), x.alias("pair"))

    spots = F.concat(*[F.transform(_pairs(p), spot(n, low, high)) for n, (p, low, high) in enumerate(rules)])
    rows = pages.select("plan_id", "page_no", F.inline(spots)).withColumns(
        {"w": feet(F.col("pair.width")), "l": feet(F.col("pair.length"))}
    )
    sized = rows.filter(F.col("w").between(F.col("low"), F.col("high")) & F.col("l").between(F.col("low"), F.col("high")))
    distinct = sized.groupBy("plan_id", "w", "l").agg(F.min(F.struct("rule_no", "page_no", "pos")).alias("place"))
    found_pairs = distinct.groupBy("plan_id").agg(F.array_sort(F.collect_list(F.struct("place", "w", "l"))).alias("found"))
    kept = F.aggregate(
        "found",
        F.slice("found", 1, 0),
        lambda kept, x: F.when(
            F.exists(kept, lambda k: (F.abs(k["w"] - x["w"]) < 0.1) & (F.abs(k["l"] - x["l"]) < 0.1)), kept
        ).otherwise(F.concat(kept, F.array(x))),
    )
    return found_pairs.select("plan_id", F.inline(kept)).select(
        "plan_id",
        F.round("w", 1).alias("width_ft"),
        F.round("l", 1).alias("length_ft"),
        (F.col("w") * F.col("l")).alias("area_sqft"),
    )


def wall_lengths(pages: DataFrame) -> DataFrame:
    """Wall lengths of 5-100 ft per plan, each as often as it is written."""
    rows = pages.select("plan_id", F.explode(found(f"({LENGTH})")).alias("written"))
    sized = rows.select("plan_id", feet(F.col("written")).alias("length_ft"))
    return sized.filter(F.col("length_ft").between(5, 100))


def _height_feet(c: Column) -> Column:
    """Height in feet, null for what looks like a phone number or lies outside 8-12 ft."""
    plain = F.regexp_replace(c, "['\"]", "")
    phone = (F.length(F.regexp_replace(plain, r"\D", "")) >= 7) | plain.rlike(r"\d{3}-?\d{4}")
    first = F.regexp_extract(plain, r"(\d+)", 1).try_cast("double")
    second = F.regexp_extract(plain, r"\d+\D+(\d+)", 1).try_cast("double")
    height = first + F.coalesce(second, F.lit(0.0)) / 12
    return F.when(~phone & height.between(8, 12), height)


def ceiling_heights(pages: DataFrame) -> DataFrame:
    """Ceiling heights with their place in the plan (rule, page, order)."""
    items = [numbered_matches(n, p) for n, p in enumerate(CEILING_HEIGHT)]
    rows = pages.select("plan_id", "page_no", F.inline(F.concat(*items)))
    return rows.withColumn("height_ft", _height_feet(F.col("written"))).filter("height_ft IS NOT NULL")


def wall_area(pages: DataFrame) -> DataFrame:
    """Sum of the wall lengths times the first ceiling height, for plans that have both."""
    walls = wall_lengths(pages).groupBy("plan_id").agg(F.sum("length_ft").alias("wall_length"))
    first = ceiling_heights(pages).groupBy("plan_id").agg(
        F.min_by("height_ft", F.struct("rule_no", "page_no", "pos")).alias("height_ft")
    )
    return walls.join(first, "plan_id").select(
        "plan_id",
        F.floor(F.round(F.col("wall_length") * F.col("height_ft"), 6)).alias("wall_sqft"),
    )


def fixture_counts(pages: DataFrame) -> DataFrame:
    """Fixtures per plan, each page counted once; an absurd window count becomes 0."""
    per_page = []
    for name, (how, *patterns) in FIXTURES.items():
        counts = [F.regexp_count("text", F.lit(p)) for p in patterns]
        combined = F.greatest(*counts) if how == "max" else sum(counts[1:], counts[0])
        per_page.append(combined.alias(name))
    sums = pages.select("plan_id", *per_page).groupBy("plan_id").agg(
        *[F.sum(n).alias(n) for n in FIXTURES]
    )
    clamped = F.when(F.col("windows") > WINDOW_LIMIT, 0).otherwise(F.col("windows"))
    return sums.withColumn("windows", clamped.cast("bigint"))
