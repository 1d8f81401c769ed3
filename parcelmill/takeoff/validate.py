"""Validation of extracted plan facts: range checks, structural issues, score and batch summaries."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.takeoff.rules import CHECK_RANGES, TOLERANCE

# Facts whose absence is a warning.
EXPECTED_SPECS = [
    "foundation_type", "roof_type", "ceiling_height", "hvac_type", "water_heater_type",
    "panel_amperage", "insulation_type", "siding_type", "flooring_type",
]
FIXTURE_COLUMNS = {
    "doors": "doors",
    "windows": "windows",
    "electrical_outlets": "outlets",
    "plumbing_fixtures": "plumbing_fixtures",
}


def _fact(df: DataFrame, name: str, kind: str = "double") -> Column:
    return (F.col(name) if name in df.columns else F.lit(None)).cast(kind)


def _check(name: str, value: Column, counted: Column | None = None) -> Column:
    low, high = CHECK_RANGES[name]
    passed = F.coalesce(value.between(low, high), F.lit(False))
    item = F.struct(F.lit(name).alias("check"), value.alias("value"), passed.alias("passed"))
    return item if counted is None else F.when(counted, item)


def _range_rows(df: DataFrame, rule: str, value: str) -> DataFrame:
    return df.select("plan_id", F.inline(F.array(_check(rule, F.col(value).cast("double")))))


def check_results(
    facts: DataFrame, rooms: DataFrame | None = None, ceilings: DataFrame | None = None
) -> DataFrame:
    """(plan_id, check, value, passed): range checks of facts, rooms and ceilings, and the tolerance
    check of total area against floor areas, which neither passes nor fails with a zero side."""
    sqft = F.coalesce(_fact(facts, "total_sqft"), F.lit(0.0))
    floors = _fact(facts, "floor_area_sum")
    checks = [_check("total_sqft", sqft)]
    for rule, column in FIXTURE_COLUMNS.items():
        checks.append(_check(rule, F.coalesce(_fact(facts, column), F.lit(0.0))))
    gap = F.try_divide(F.abs(sqft - floors), F.greatest(sqft, floors))
    agrees = F.when((sqft != 0) & (floors != 0), gap <= TOLERANCE)
    tolerance = F.struct(
        F.lit("floor_area_tolerance").alias("check"), gap.alias("value"), agrees.alias("passed")
    )
    checks.append(F.when(floors > 0, tolerance))
    rows = facts.select("plan_id", F.inline(F.array_compact(F.array(*checks))))
    if rooms is not None:
        rows = rows.unionByName(_range_rows(rooms, "room_area", "area"))
    if ceilings is not None:
        rows = rows.unionByName(_range_rows(ceilings, "ceiling_height", "height_ft"))
    return rows


def expected_rooms(sqft: Column) -> Column:
    return F.when(sqft < 1000, 4).when(sqft < 2000, 6).when(sqft < 3000, 8).otherwise(10)


def structural_issues(facts: DataFrame) -> DataFrame:
    """Critical issues and warnings per plan, as arrays of rule names."""
    sqft = F.coalesce(_fact(facts, "total_sqft"), F.lit(0.0))
    n_rooms = F.coalesce(_fact(facts, "room_count"), F.lit(0.0))
    room_area = F.coalesce(_fact(facts, "room_area"), F.lit(0.0))
    doors = F.coalesce(_fact(facts, "doors"), F.lit(0.0))
    windows = F.coalesce(_fact(facts, "windows"), F.lit(0.0))
    share = F.try_divide(room_area, sqft)
    sized = (sqft > 0) & (room_area > 0) & (n_rooms > 0)
    per_thousand = sqft / 1000
    critical = {
        "no_total_area": sqft == 0,
        "no_rooms": n_rooms == 0,
        "too_few_rooms": (n_rooms > 0) & (n_rooms < expected_rooms(sqft) * 0.5),
        "room_area_above_total": sized & (share > 1.2),
        "door_count": doors > 50,
        "window_count": windows > 50,
        "door_density": (sqft > 0) & (doors > per_thousand * 15),
        "window_density": (sqft > 0) & (windows > per_thousand * 20),
    }
    warnings = {
        "no_floor_areas": _fact(facts, "floor_area_sum").isNull(),
        "many_rooms": (n_rooms > 0) & (n_rooms > expected_rooms(sqft) * 2),
        "room_area_below_third": sized & (share < 0.3),
        **{f"no_{s}": _fact(facts, s, "string").isNull() for s in EXPECTED_SPECS},
        "dimension_area": (sqft > 0) & (_fact(facts, "dimension_area") > sqft * 2),
        "wall_length": (sqft > 0) & (_fact(facts, "wall_length") > F.sqrt(sqft) * 12),
    }

    def listed(rules: dict[str, Column]) -> Column:
        return F.array_compact(F.array(*[F.when(hit, F.lit(n)) for n, hit in rules.items()]))

    return facts.select(
        "plan_id", listed(critical).alias("critical"), listed(warnings).alias("warnings")
    )


def plan_scores(checks: DataFrame, issues: DataFrame) -> DataFrame:
    """Passed share less 0.2 per critical issue (0.8 at most), never below 0; failed checks warn."""
    sums = checks.groupBy("plan_id").agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if("passed").alias("passed_checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
    )
    joined = issues.join(sums, "plan_id", "left")
    base = F.try_divide(F.col("passed_checks").cast("double"), F.col("total_checks"))
    penalty = F.least(F.size("critical") * 0.2, F.lit(0.8))
    score = F.when(F.col("total_checks") > 0, F.greatest(F.lit(0.0), base - penalty))
    zero = F.lit(0).cast("bigint")
    return joined.select(
        "plan_id",
        F.coalesce("total_checks", zero).alias("total_checks"),
        F.coalesce("passed_checks", zero).alias("passed_checks"),
        F.coalesce("failed_checks", zero).alias("failed_checks"),
        F.size("critical").alias("critical_count"),
        (F.size("warnings") + F.coalesce("failed_checks", zero)).alias("warning_count"),
        F.coalesce(score, F.lit(0.0)).alias("score"),
    )


def batch_summary(scores: DataFrame) -> DataFrame:
    return scores.agg(
        F.count(F.lit(1)).alias("plans"),
        F.avg("score").alias("average_score"),
        F.max("score").alias("best_score"),
        F.min("score").alias("worst_score"),
        F.sum("critical_count").alias("total_critical_issues"),
        F.sum("warning_count").alias("total_warnings"),
        F.count_if(F.col("critical_count") > 0).alias("plans_with_critical_issues"),
    )


def run_summary(status: DataFrame) -> DataFrame:
    """Successful and failed plans and their time, from (plan_id, success, seconds)."""
    return status.agg(
        F.count(F.lit(1)).alias("total_plans"),
        F.count_if("success").alias("successful"),
        F.count_if(~F.col("success")).alias("failed"),
        F.sum("seconds").alias("total_seconds"),
        F.avg("seconds").alias("average_seconds"),
    )
