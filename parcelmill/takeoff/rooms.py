"""Rooms of a plan: extraction, classification, half baths, back-fill and reconciliation."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.operators.keyed import top_per_key
from parcelmill.takeoff.measures import found, numbered_matches
from parcelmill.takeoff.rules import (
    EXCLUDES_FLOOR_AREAS,
    FLOOR_NUMBER,
    HALF_BATH_MARK,
    KEYWORD_RANGE,
    MASTER_BATHROOM,
    ROOM_KEYWORDS,
    ROOM_RULES,
    ROOM_TYPES,
    ROOM_TYPES_SHORT,
)

ROOM_ITEM = (
    "array<struct<rule_no int, pos int, name string, room_key string, area int, low int, high int, "
    "skip_floor boolean>>"
)


def room_type(c: Column) -> Column:
    """Standard type of a room name; null when no rule fits."""
    upper = F.upper(c)
    out = F.when(upper.rlike(ROOM_TYPES[0][1]), ROOM_TYPES[0][0])
    for kind, words in ROOM_TYPES[1:]:
        out = out.when(upper.rlike(words), kind)
    return out


def room_type_short(c: Column) -> Column:
    """The coarser classification; every other name is `other`."""
    words = dict(ROOM_TYPES)
    upper = F.upper(c)
    out = F.when(upper.rlike(words[ROOM_TYPES_SHORT[0]]), ROOM_TYPES_SHORT[0])
    for kind in ROOM_TYPES_SHORT[1:]:
        out = out.when(upper.rlike(words[kind]), kind)
    return out.otherwise("other")


def _keyword_items() -> Column:
    """Keyword and number pairs; the rule number is the keyword's place in the list."""
    pattern = r"(?<!FLOOR\s)(" + "|".join(ROOM_KEYWORDS) + r")\s+(\d+)(?:\s|$)"
    place = F.create_map(*[x for i, k in enumerate(ROOM_KEYWORDS) for x in (F.lit(k), F.lit(i))])
    low, high = KEYWORD_RANGE
    zipped = F.arrays_zip(found(pattern, 1), found(pattern, 2))

    def item(x: Column, i: Column) -> Column:
        keyword = F.upper(x["0"])
        return F.struct(
            F.try_element_at(place, keyword), i, keyword, F.lower(keyword),
            x["1"].try_cast("int"), F.lit(low), F.lit(high), F.lit(True),
        )

    return F.transform(zipped, item).cast(ROOM_ITEM)


def _rule_items(n: int, rule: tuple) -> Column:
    name, key, group, low, high, pattern = rule

    def item(x: Column, i: Column) -> Column:
        return F.struct(
            F.lit(n), i, F.lit(name), F.lit(key), x.try_cast("int"), F.lit(low), F.lit(high),
            F.lit(key in EXCLUDES_FLOOR_AREAS),
        )

    return F.transform(found(pattern, group), item).cast(ROOM_ITEM)


def _floor_total_items() -> Column:
    """Areas of whole floors: they are no rooms, and rule out rooms of the same area."""

    def item(x: Column, i: Column) -> Column:
        area = x.try_cast("int")
        none = F.lit(None).cast("string")
        return F.struct(F.lit(-1), i, none, none, area, area, area, F.lit(False))

    return F.transform(found(FLOOR_NUMBER, 2), item).cast(ROOM_ITEM)


def rooms(pages: DataFrame) -> DataFrame:
    """One room per plan and distinct area: the first rule that finds the area names it."""
    items = [_keyword_items(), _floor_total_items()] + [
        _rule_items(len(ROOM_KEYWORDS) + i, rule) for i, rule in enumerate(ROOM_RULES)
    ]
    # rooms and floor areas are findings of one pass over the texts, and meet in one aggregate
    hits = pages.select("plan_id", "page_no", F.inline(F.concat(*items))).filter(
        F.col("area").between(F.col("low"), F.col("high"))
    )
    is_room = F.col("rule_no") >= 0
    named = F.struct("name", "room_key", "rule_no", "page_no")
    order = F.struct("rule_no", "page_no", "pos")
    # the group is (plan, area): few rows leave each map task even for a very large plan
    found_by = hits.groupBy("plan_id", "area").agg(
        F.bool_or(~is_room).alias("is_floor"),
        F.min_by(named, F.when(is_room, order)).alias("any"),
        F.min_by(named, F.when(is_room & ~F.col("skip_floor"), order)).alias("sure"),
    )
    chosen = F.when(F.col("is_floor"), F.col("sure")).otherwise(F.col("any")).alias("r")
    return found_by.select("plan_id", "area", chosen).filter("r IS NOT NULL").select("plan_id", "area", "r.*")


def master_bathroom(pages: DataFrame) -> DataFrame:
    """First master-bathroom area of 80-200 per plan, by pattern, page and order."""
    items = [numbered_matches(n, p) for n, p in enumerate(MASTER_BATHROOM)]
    hits = pages.select("plan_id", "page_no", F.inline(F.concat(*items))).withColumn(
        "area", F.col("written").try_cast("int")
    )
    return hits.filter(F.col("area").between(80, 200)).groupBy("plan_id").agg(
        F.min_by("area", F.struct("rule_no", "page_no", "pos")).alias("area")
    )


def resolve_half_baths(found_rooms: DataFrame, pages: DataFrame) -> DataFrame:
    """Plans without a half bath turn their smallest bathroom of 15-50 into one, and a second one of
    15-45 when the text has more than five half-bath marks."""
    explicit = found_rooms.filter("room_key = 'half_bath'").select("plan_id").distinct()
    small = found_rooms.filter((F.col("room_key") == "bathroom") & F.col("area").between(15, 50))
    open_plans = small.join(explicit, "plan_id", "left_anti")
    two = top_per_key(open_plans, ["plan_id"], [F.col("area").asc()], 2)
    lowest = two.groupBy("plan_id").agg(
        F.min("area").alias("first"),
        F.max(F.when(F.col("area") <= 45, F.col("area"))).alias("second"),
    )
    marks = pages.select(
        "plan_id", F.regexp_count("text", F.lit("(?i)" + HALF_BATH_MARK)).alias("m")
    ).groupBy("plan_id").agg(F.sum("m").alias("marks"))
    change = lowest.join(marks, "plan_id").select(
        "plan_id", "first", F.when(F.col("marks") > 5, F.col("second")).alias("second")
    )
    joined = found_rooms.join(change, "plan_id", "left")
    turns = (F.col("room_key") == "bathroom") & (
        (F.col("area") == F.col("first")) | (F.col("area") == F.col("second"))
    )
    turns = F.coalesce(turns, F.lit(False))
    return joined.withColumns(
        {
            "name": F.when(turns, "HALF BATH").otherwise(F.col("name")),
            "room_key": F.when(turns, "half_bath").otherwise(F.col("room_key")),
        }
    ).drop("first", "second")


def back_fill(typed_rooms: DataFrame, plans: DataFrame, floors: DataFrame) -> DataFrame:
    """Estimated rooms of plans with fewer than five room types; found types are not estimated.

    `typed_rooms` has plan_id and room_type, `plans` plan_id and total_sqft, `floors` the floor areas.
    """
    types = typed_rooms.select("plan_id", "room_type").distinct()
    type_counts = types.groupBy("plan_id").agg(F.count("room_type").alias("n_types"))

    def area_of(floor: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("floor") == floor, F.col("area"))), F.lit(0))

    by_floor = floors.groupBy("plan_id").agg(
        area_of("first_floor").alias("first"), area_of("second_floor").alias("second")
    )
    base = (
        plans.select("plan_id", "total_sqft")
        .join(type_counts, "plan_id", "left")
        .join(by_floor, "plan_id", "left")
        .filter(F.coalesce("n_types", F.lit(0)) < 5)
        .select(
            "plan_id",
            F.coalesce("total_sqft", F.lit(0)).alias("sqft"),
            F.coalesce("first", F.lit(0)).alias("first"),
            F.coalesce("second", F.lit(0)).alias("second"),
        )
    )

    def clamp(c: Column, low: int, high: int) -> Column:
        return F.least(F.lit(high), F.greatest(F.lit(low), F.floor(c).cast("int")))

    def rows(kind: str, name: Column, area: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("room_type"), name.alias("name"), area.cast("int").alias("area")
        )

    def numbered(kind: str, label: str, count: Column, area) -> Column:
        return F.transform(
            F.sequence(F.lit(1), count),
            lambda i: rows(kind, F.concat(F.lit(label + " "), i), area(i)),
        )

    def one(kind: str, name: str, area: Column, wanted: Column | None = None) -> Column:
        item = rows(kind, F.lit(name), area)
        return F.array(item if wanted is None else F.when(wanted, item))

    estimates = F.concat(
        numbered("bedroom", "BEDROOM", clamp(F.col("sqft") / 600, 2, 4), lambda i: 100 + i * 20),
        numbered("bathroom", "BATHROOM", clamp(F.col("sqft") / 800, 2, 3),
                 lambda i: F.when(i == 1, 60).otherwise(40)),
        one("kitchen", "KITCHEN", clamp(F.col("first") / 4, 120, 200)),
        one("dining", "DINING", clamp(F.col("first") / 6, 80, 150)),
        one("living", "LIVING ROOM", clamp(F.col("first") / 3, 200, 300)),
        one("family", "FAMILY ROOM", clamp(F.col("second") / 4, 150, 250), F.col("second") > 0),
    )
    proposed = base.select("plan_id", F.inline(F.array_compact(estimates)))
    return proposed.join(types, ["plan_id", "room_type"], "left_anti").withColumn(
        "estimated", F.lit(True)
    )


def reconcile(found_rooms: DataFrame, floors: DataFrame, plans: DataFrame) -> DataFrame:
    """Floor and room totals, the room count, and a flag when rooms exceed 1.2 times the area."""
    room_sums = found_rooms.groupBy("plan_id").agg(
        F.sum("area").alias("total_room_area"), F.count(F.lit(1)).alias("room_count")
    )
    floor_sums = floors.groupBy("plan_id").agg(F.sum("area").alias("total_floor_area"))
    zero = F.lit(0).cast("bigint")
    joined = plans.join(floor_sums, "plan_id", "left").join(room_sums, "plan_id", "left")
    filled = joined.withColumns(
        {n: F.coalesce(n, zero) for n in ("total_floor_area", "total_room_area", "room_count")}
    )
    double = F.col("total_room_area") > F.coalesce("total_sqft", F.lit(0)) * 1.2
    return filled.withColumn("double_count", double)
