"""Material quantities and cost of a plan."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.takeoff.rules import CONTINGENCY, PRICES

DEFAULT_BATHS = 3
DEFAULT_CEILING = 9.0
#: Tasks that plans are dealt out to before they become rows; what a task holds is a share of this size.
PLAN_PARTITIONS = 256

# Measures that the items are computed from.
MEASURES = (
    "base", "basement", "baths", "cabinets", "countertop", "doors", "driveway", "flashing",
    "has_kitchen", "large", "laundry", "lights", "outlets", "perimeter", "plumbing", "rooms",
    "sidewalk", "sqft", "switches", "vents", "wall_area", "windows",
)


def items() -> list[tuple[str, str, Column, str | None]]:
    """Category, item, quantity, and the price it takes (None: not priced)."""
    m = {name: F.col(name) for name in MEASURES}
    one = F.lit(1)
    return [
        ("site_work", "excavation_cubic_yards", m["sqft"] * 0.2 / 27, "excavation"),
        ("site_work", "grading_sqft", m["sqft"] * 1.5, "grading"),
        ("site_work", "backfill_cubic_yards", m["sqft"] * 0.1 / 27, "backfill"),
        ("site_work", "site_preparation", one, "site_preparation"),
        ("concrete", "foundation", m["sqft"] * 0.15, None),
        ("concrete", "footings", m["sqft"] * 0.05, None),
        ("concrete", "driveway", m["driveway"], None),
        ("concrete", "sidewalk", m["sidewalk"], None),
        ("concrete", "total_cubic_yards", (m["sqft"] * 0.2 + m["driveway"] + m["sidewalk"]) / 27, "concrete"),
        ("foundation", "rebar_tons", m["sqft"] * 0.0004, "rebar"),
        ("foundation", "foundation_bolts_count", F.floor(m["base"] / 8), "foundation_bolt"),
        ("foundation", "vapor_barrier_sqft", m["sqft"], "vapor_barrier"),
        ("foundation", "waterproofing_sqft", m["base"] * 6, "waterproofing"),
        ("foundation", "gravel_cubic_yards", m["sqft"] * 0.03 / 27, "gravel"),
        ("foundation", "form_boards_bf", m["base"] * 8, "form_boards"),
        ("lumber", "framing", m["sqft"] * 1.5, None),
        ("lumber", "sheathing", m["sqft"] * 1.1, None),
        ("lumber", "total_board_feet", m["sqft"] * 1.5, "lumber"),
        ("structural", "engineered_lumber_lf", m["sqft"] * 0.3, "engineered_lumber"),
        ("structural", "metal_connectors_count", F.floor(m["sqft"] / 50), "metal_connector"),
        ("structural", "structural_screws_lbs", m["sqft"] * 0.02, "structural_screws"),
        ("structural", "hurricane_ties_count", F.floor(m["sqft"] / 100), "hurricane_tie"),
        ("structural", "post_anchors_count", F.floor(m["perimeter"] / 20), "post_anchor"),
        ("structural", "beam_pockets_count", F.floor(m["sqft"] / 400), "beam_pocket"),
        ("roofing", "shingles_sqft", m["sqft"] * 1.2, "roofing_shingles"),
        ("roofing", "underlayment_sqft", m["sqft"] * 1.2, "roofing_underlayment"),
        ("roofing", "flashing_linear_ft", m["flashing"], "roofing_flashing"),
        ("insulation", "wall_sqft", m["wall_area"], None),
        ("insulation", "ceiling_sqft", m["sqft"], None),
        ("insulation", "total_sqft", m["wall_area"] + m["sqft"], "insulation"),
        ("insulation", "house_wrap_sqft", m["wall_area"] * 1.05, "house_wrap"),
        ("insulation", "foam_board_sqft", m["wall_area"] * 0.1, "foam_board"),
        ("insulation", "caulk_tubes", F.floor(m["perimeter"] / 15), "caulk_tube"),
        ("insulation", "weatherstripping_lf", m["doors"] * 16 + m["windows"] * 12, "weatherstripping"),
        ("drywall", "wall_sqft", m["wall_area"], "drywall"),
        ("drywall", "ceiling_sqft", m["sqft"], "drywall"),
        ("drywall", "total_sheets", (m["wall_area"] + m["sqft"]) / 32, None),
        ("flooring", "total_sqft", m["sqft"], None),
        ("flooring", "tile_sqft", m["sqft"] * 0.3, "tile"),
        ("flooring", "carpet_sqft", m["sqft"] * 0.4, "carpet"),
        ("flooring", "hardwood_sqft", m["sqft"] * 0.3, "hardwood"),
        ("flooring", "underlayment_sqft", m["sqft"] * 0.5, "underlayment"),
        ("flooring", "transition_strips_lf", m["rooms"] * 6, "transition_strip"),
        ("flooring", "floor_adhesive_gallons", F.floor(m["sqft"] * 0.3 / 250), "floor_adhesive"),
        ("flooring", "carpet_padding_sqft", m["sqft"] * 0.4, "carpet_padding"),
        ("doors_windows", "doors", m["doors"], "door"),
        ("doors_windows", "windows", m["windows"], "window"),
        ("doors_windows", "door_frames", m["doors"], "door_frame"),
        ("doors_windows", "window_frames", m["windows"], "window_frame"),
        ("paint", "wall_sqft", m["wall_area"], None),
        ("paint", "ceiling_sqft", m["sqft"], None),
        ("paint", "primer_gallons", (m["wall_area"] + m["sqft"]) / 400, "paint_primer"),
        ("paint", "paint_gallons", (m["wall_area"] + m["sqft"]) / 350, "paint"),
        ("trim_molding", "baseboard_linear_ft", m["perimeter"] * 0.8, "baseboard"),
        ("trim_molding", "crown_molding_linear_ft", m["perimeter"] * 0.6, "crown_molding"),
        ("trim_molding", "door_casing_linear_ft", m["doors"] * 8, "door_casing"),
        ("trim_molding", "window_casing_linear_ft", m["windows"] * 12, "window_casing"),
        ("electrical", "outlets", m["outlets"], "outlet"),
        ("electrical", "light_fixtures", m["lights"], "light_fixture"),
        ("electrical", "switches", F.greatest(m["switches"], m["lights"]), "switch"),
        ("electrical", "wire_feet", m["outlets"] * 40 + m["lights"] * 25, "wire"),
        ("electrical", "electrical_panel", one, "electrical_panel"),
        ("electrical", "service_entrance", one, "service_entrance"),
        ("electrical", "conduit_feet", m["outlets"] * 15 + m["lights"] * 10, "conduit"),
        ("electrical", "junction_boxes_count", F.floor((m["outlets"] + m["lights"]) / 3), "junction_box"),
        ("electrical", "breakers_count", F.floor(m["sqft"] / 200), "breaker"),
        ("electrical", "gfci_outlets_count", m["baths"] + 1, "gfci_outlet"),
        ("electrical", "smoke_detectors_count", m["rooms"], "smoke_detector"),
        ("electrical", "electrical_meter", one, "electrical_meter"),
        ("electrical", "grounding_rods_count", F.lit(2), "grounding_rod"),
        ("electrical", "wire_nuts_count", m["outlets"] * 4, "wire_nut"),
        ("plumbing", "fixtures", m["plumbing"], "plumbing_fixture"),
        ("plumbing", "pipe_feet", m["plumbing"] * 60, "pipe"),
        ("plumbing", "fittings", m["plumbing"] * 4, "fitting"),
        ("plumbing", "water_main_connection", one, "water_main_connection"),
        ("plumbing", "sewer_connection", one, "sewer_connection"),
        ("plumbing", "shut_off_valves_count", m["plumbing"] + 2, "shut_off_valve"),
        ("plumbing", "vent_pipes_lf", m["plumbing"] * 15, "vent_pipe"),
        ("plumbing", "cleanouts_count", m["baths"] + 2, "cleanout"),
        ("plumbing", "water_meter", one, "water_meter"),
        ("plumbing", "pressure_tank", m["large"], "pressure_tank"),
        ("plumbing", "sump_pump", m["basement"], "sump_pump"),
        ("plumbing", "floor_drains_count", m["basement"], "floor_drain"),
        ("plumbing", "pipe_insulation_lf", m["plumbing"] * 20, "pipe_insulation"),
        ("hvac", "ductwork_linear_ft", m["rooms"] * 25 + m["perimeter"] * 0.5, "ductwork"),
        ("hvac", "vents", m["vents"], "vent"),
        ("hvac", "thermostat", F.greatest(F.lit(1), F.floor(m["sqft"] / 2000)), "thermostat"),
        ("hvac", "air_handler", F.greatest(F.lit(1), F.floor(m["sqft"] / 2500)), "air_handler"),
        ("hvac", "hvac_installation", one, "hvac_installation"),
        ("hardware", "nails_lbs", m["sqft"] * 0.1, "nails"),
        ("hardware", "screws_lbs", m["sqft"] * 0.05, "screws"),
        ("hardware", "bolts_count", m["doors"] * 4, "bolts"),
        ("hardware", "hinges_count", m["doors"] * 3, "hinges"),
        ("hardware", "locks_count", m["doors"], "locks"),
        ("cabinets", "kitchen_cabinets_linear_ft", m["cabinets"], "kitchen_cabinet"),
        ("cabinets", "bathroom_cabinets_count", m["baths"], "bathroom_cabinet"),
        ("cabinets", "countertop_sqft", m["countertop"], "countertop"),
        ("cabinets", "sink_count", m["baths"] + 1, "sink"),
        ("exterior", "siding_sqft", m["sqft"] * 0.8, "siding"),
        ("exterior", "gutters_linear_ft", m["perimeter"] * 0.8, "gutter"),
        ("exterior", "downspouts_count", F.greatest(F.lit(4), F.floor(m["perimeter"] / 50)), "downspout"),
        ("exterior", "exterior_paint_gallons", m["sqft"] * 0.8 / 300, "exterior_paint"),
        ("appliances", "refrigerator", m["has_kitchen"], "refrigerator"),
        ("appliances", "stove", m["has_kitchen"], "stove"),
        ("appliances", "dishwasher", m["has_kitchen"], "dishwasher"),
        ("appliances", "washer", m["laundry"], "washer"),
        ("appliances", "dryer", m["laundry"], "dryer"),
        ("appliances", "water_heater", one, "water_heater"),
        ("landscaping", "sod_sqft", m["sqft"] * 0.4, "sod"),
        ("landscaping", "mulch_cubic_yards", F.greatest(F.lit(3), F.floor(m["perimeter"] / 50)), "mulch"),
        ("landscaping", "plants_count", F.greatest(F.lit(8), F.floor(m["perimeter"] / 20)), "plant"),
        ("landscaping", "irrigation_system", m["large"], "irrigation_system"),
    ]


def _number(df: DataFrame, name: str, default: float | None = 0) -> Column:
    """A fact as double; absent columns and nulls take the default."""
    c = F.col(name).cast("double") if name in df.columns else F.lit(None).cast("double")
    return c if default is None else F.coalesce(c, F.lit(float(default)))


def measures(plans: DataFrame) -> DataFrame:
    """Quantities that the item table refers to, with the plausibility rules applied.

    Reads total_sqft and, where present, room_count, bathroom_count, kitchen_area, laundry_rooms,
    basement_rooms, wall_length, ceiling_height, doors, windows, outlets, light_fixtures, switches,
    plumbing_fixtures and hvac_vents.
    """
    basic = plans.select(
        "plan_id",
        _number(plans, "total_sqft").alias("sqft"),
        _number(plans, "room_count").alias("rooms"),
        _number(plans, "bathroom_count", DEFAULT_BATHS).alias("baths"),
        _number(plans, "kitchen_area", None).alias("kitchen"),
        _number(plans, "laundry_rooms").alias("laundry_rooms"),
        F.least(F.lit(1.0), _number(plans, "basement_rooms")).alias("basement"),
        F.nullif(_number(plans, "wall_length", None), F.lit(0.0)).alias("measured_walls"),
        _number(plans, "ceiling_height", DEFAULT_CEILING).alias("ceiling"),
        _number(plans, "doors").alias("doors"),
        _number(plans, "windows").alias("windows"),
        _number(plans, "outlets").alias("n_outlets"),
        _number(plans, "light_fixtures").alias("n_lights"),
        _number(plans, "switches").alias("switches"),
        _number(plans, "plumbing_fixtures").alias("n_plumbing"),
        _number(plans, "hvac_vents").alias("n_vents"),
    ).withColumn("perimeter", F.sqrt("sqft") * 4)
    expected = F.col("baths") * 3 + 2
    vents = F.col("rooms") * 2
    kitchen = F.col("kitchen")
    flag = {True: F.lit(1.0), False: F.lit(0.0)}
    return basic.withColumns(
        {
            "base": F.col("perimeter") * 0.8,
            "driveway": F.greatest(F.lit(300.0), F.col("sqft") * 0.15),
            "sidewalk": F.greatest(F.lit(50.0), F.col("perimeter") * 3),
            "flashing": F.coalesce(F.col("measured_walls") * 0.3, F.col("sqft") * 0.5),
            "wall_area": F.coalesce("measured_walls", F.col("sqft") * 0.4) * F.col("ceiling"),
            "outlets": F.when(
                F.col("n_outlets").between(F.floor(F.col("sqft") / 200), F.floor(F.col("sqft") / 100)),
                F.col("n_outlets"),
            ).otherwise(F.floor(F.col("sqft") / 150)),
            "lights": F.when(F.col("n_lights") > 0, F.col("n_lights")).otherwise(
                F.greatest(F.lit(8), F.floor(F.col("sqft") / 300))
            ),
            "plumbing": F.when(
                F.col("n_plumbing").between(expected * 0.5, expected * 2), F.col("n_plumbing")
            ).otherwise(expected),
            "vents": F.when(
                (F.col("n_vents") > 0) & (F.col("n_vents") < vents * 3), F.col("n_vents")
            ).otherwise(vents),
            "cabinets": F.when(
                kitchen > 0, F.greatest(F.lit(12), F.floor(kitchen / 8))
            ).otherwise(18),
            "countertop": F.when(
                kitchen > 0, F.greatest(F.lit(25), F.floor(kitchen * 0.2))
            ).otherwise(35),
            "has_kitchen": F.when(kitchen.isNotNull(), flag[True]).otherwise(flag[False]),
            "laundry": F.when(
                (F.col("laundry_rooms") > 0) | (F.col("sqft") > 1500), flag[True]
            ).otherwise(flag[False]),
            "large": F.when(F.col("sqft") > 2000, flag[True]).otherwise(flag[False]),
        }
    )


def quantities(plans: DataFrame) -> DataFrame:
    """(plan_id, category, item, price_key, qty).

    A plan becomes a hundred rows, so the plans are dealt out by id while they are one narrow row each: sums per plan
    then need no other exchange, and no task has more than its share of them.
    """
    rows = [
        F.struct(
            F.lit(category).alias("category"),
            F.lit(item).alias("item"),
            F.lit(price).cast("string").alias("price_key"),
            quantity.cast("double").alias("qty"),
        )
        for category, item, quantity, price in items()
    ]
    dealt = plans.repartition(PLAN_PARTITIONS, "plan_id")
    return measures(dealt).select("plan_id", F.inline(F.array(*rows)))


def price_table(df: DataFrame, overrides: dict[str, float] | None = None) -> DataFrame:
    """Unit prices as a frame; the list is a fixed constant of about a hundred rows."""
    prices = {k: float(v) for k, v in (PRICES | (overrides or {})).items()}
    return df.sparkSession.createDataFrame(list(prices.items()), "price_key string, unit_cost double")


def category_costs(plan_quantity: DataFrame, overrides: dict[str, float] | None = None) -> DataFrame:
    """Cost per plan and category."""
    prices = F.broadcast(price_table(plan_quantity, overrides))
    priced = plan_quantity.filter("price_key IS NOT NULL").join(prices, "price_key")
    return priced.groupBy("plan_id", "category").agg(
        F.sum(F.col("qty") * F.col("unit_cost")).alias("cost")
    )


def plan_costs(costs: DataFrame) -> DataFrame:
    """Material total, contingency and the total with contingency per plan."""
    totals = costs.groupBy("plan_id").agg(F.sum("cost").alias("total_materials"))
    return totals.select(
        "plan_id",
        "total_materials",
        (F.col("total_materials") * CONTINGENCY).alias("contingency_amount"),
        (F.col("total_materials") * (1 + CONTINGENCY)).alias("total_with_contingency"),
    )
