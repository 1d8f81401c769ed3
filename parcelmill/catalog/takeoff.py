"""Plan takeoff queries (T*, W3)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmill.catalog.registry import Inputs, query
from parcelmill.takeoff import measures, pages, quantities, rooms, specs, validate

PAGES = "fx_plan_pages"
FACTS = "fx_plan_facts"


def best(src: Inputs) -> DataFrame:
    return pages.best_pages(src.view(PAGES))


def _score_sql(terms: str, points: int, low: int, high: int, worst: float, penalty: int) -> str:
    hits = " + ".join(
        f"CASE WHEN contains(upper(text), '{t}') THEN {points} ELSE 0 END" for t in terms.split()
    )
    return f"""length(regexp_replace(text, '[^A-Za-z0-9]', '', 'g')) / length(text) * 30
        + CASE WHEN length(trim(text)) BETWEEN {low} AND {high} THEN 20 WHEN length(trim(text)) > {high} THEN 10
            ELSE 0 END + {hits}
        - CASE WHEN length(regexp_replace(text, '[A-Za-z0-9 ]', '', 'g')) / length(text) > {worst} THEN {penalty}
            ELSE 0 END"""


_TERMS = "FLOOR ROOM BEDROOM BATHROOM KITCHEN LIVING GARAGE SQ FT DIMENSION"


@query(
    "t1_best_page_text",
    PAGES,
    f"""WITH s AS (SELECT 'short' AS version, plan_id, page_no, method,
            {_score_sql(_TERMS, 5, 50, 5000, 0.3, 20)} AS score FROM fx_plan_pages
        UNION ALL SELECT 'long', plan_id, page_no, method,
            {_score_sql(_TERMS + " WALL DOOR WINDOW CEILING HEIGHT", 10, 100, 3000, 0.4, 15)} FROM fx_plan_pages)
    SELECT version, plan_id, page_no, method, round(score, 6) AS score FROM s
    QUALIFY row_number() OVER (PARTITION BY version, plan_id, page_no ORDER BY score DESC, method) = 1""",
)
def t1(src: Inputs):
    def chosen(label, detailed):
        return pages.best_pages(src.view(PAGES), detailed).select(
            F.lit(label).alias("version"),
            "plan_id",
            "page_no",
            "method",
            F.round("score", 6).alias("score"),
        )

    return chosen("short", False).unionByName(chosen("long", True))


@query(
    "w3_running_floor",
    "",
    """SELECT p_partkey AS plan_id, 1 AS page_no, 'unknown' AS floor FROM part
    UNION ALL SELECT p_partkey, 2, CASE WHEN p_partkey % 4 <> 0 THEN 'second_floor' ELSE 'unknown' END FROM part
    WHERE p_partkey % 3 <> 0""",
)
def w3(src: Inputs):
    return pages.with_running_floor(best(src)).drop("text")


@query(
    "t2_total_area",
    "",
    """SELECT p_partkey AS plan_id, CASE WHEN p_partkey % 4 <> 0 THEN 1100 + p_size * 15 END AS total_sqft FROM part""",
)
def t2(src: Inputs):
    return measures.total_area(best(src))


_FLOORS_SQL = """SELECT p_partkey AS plan_id, 'first_floor' AS floor, 600 + p_size * 10 AS area FROM part
    WHERE p_partkey % 4 <> 0 UNION ALL SELECT p_partkey, 'second_floor', 500 + p_size * 5 FROM part
    WHERE p_partkey % 4 <> 0"""


@query("t3_floor_areas", "", _FLOORS_SQL)
def t3(src: Inputs):
    return measures.floor_areas(best(src))


_ROOMS_SQL = """SELECT p_partkey AS plan_id, 120 + p_size AS area, 'KITCHEN' AS name, 'kitchen' AS room_key FROM part
        WHERE p_partkey % 4 <> 0
    UNION ALL SELECT p_partkey, 200 + p_size, 'BEDROOM', 'bedroom' FROM part WHERE p_partkey % 4 <> 0
    UNION ALL SELECT p_partkey, 200 + p_size, 'LIVING ROOM', 'living' FROM part
        WHERE p_partkey % 4 = 0 AND p_partkey % 3 <> 0
    UNION ALL SELECT p_partkey, 40 + p_size, 'BATHROOM', 'bathroom' FROM part WHERE p_partkey % 3 <> 0
    UNION ALL SELECT p_partkey, 30, 'POWDER', 'powder' FROM part WHERE p_partkey % 3 <> 0"""


@query("t4_rooms", "", _ROOMS_SQL)
def t4(src: Inputs):
    return rooms.rooms(best(src)).select("plan_id", "area", "name", "room_key")


@query(
    "t4_master_bathroom",
    "",
    """SELECT p_partkey AS plan_id, 80 + p_size AS area FROM part WHERE p_partkey % 5 <> 0""",
)
def t4_master(src: Inputs):
    # sample texts that name the master bath in two ways, one of them out of range
    part = src.table("part")
    text = F.when(
        F.col("p_partkey") % 5 != 0,
        F.concat(F.lit("MASTER BATH 20 MASTER BATHROOM "), 80 + F.col("p_size"), F.lit(" HALL")),
    ).otherwise(F.lit("MASTER BATH 20"))
    texts = part.select(F.col("p_partkey").alias("plan_id"), F.lit(1).alias("page_no"), text.alias("text"))
    return rooms.master_bathroom(texts)


@query(
    "t5_room_types",
    "",
    f"""WITH r AS ({_ROOMS_SQL}) SELECT plan_id, name, CASE name WHEN 'KITCHEN' THEN 'kitchen'
        WHEN 'BEDROOM' THEN 'bedroom' WHEN 'LIVING ROOM' THEN 'living' ELSE 'bathroom' END AS room_type,
        CASE name WHEN 'KITCHEN' THEN 'kitchen' WHEN 'BEDROOM' THEN 'bedroom' WHEN 'LIVING ROOM' THEN 'living'
        ELSE 'bathroom' END AS short_type FROM r
    UNION ALL SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'Back Patio' WHEN 1 THEN 'Walk-in Robe'
        WHEN 2 THEN 'Media' ELSE 'Garage' END, CASE p_size % 4 WHEN 0 THEN 'patio' WHEN 1 THEN 'closet'
        WHEN 3 THEN 'garage' END, CASE p_size % 4 WHEN 3 THEN 'garage' ELSE 'other' END FROM part""",
)
def t5(src: Inputs):
    extra = src.table("part").select(
        F.col("p_partkey").alias("plan_id"),
        F.element_at(
            F.array(*[F.lit(n) for n in ("Back Patio", "Walk-in Robe", "Media", "Garage")]),
            F.col("p_size") % 4 + 1,
        ).alias("name"),
    )
    names = rooms.rooms(best(src)).select("plan_id", "name").unionByName(extra)
    return names.select(
        "plan_id",
        "name",
        rooms.room_type(F.col("name")).alias("room_type"),
        rooms.room_type_short(F.col("name")).alias("short_type"),
    )


@query(
    "t6_feet_inches",
    "",
    """SELECT p_partkey AS plan_id, round(p_size + (p_partkey % 12) / 12.0, 6) AS pair_ft,
        cast(p_size AS double) AS feet_ft, round(p_size / 12.0, 6) AS inches_ft, cast(p_size AS double) AS bare_ft,
        cast(0 AS double) AS none_ft FROM part""",
)
def t6(src: Inputs):
    size, inch = F.col("p_size"), F.col("p_partkey") % 12
    forms = {
        "pair_ft": F.concat(size, F.lit("' - "), inch, F.lit('"')),
        "feet_ft": F.concat(size, F.lit("'")),
        "inches_ft": F.concat(size, F.lit('"')),
        "bare_ft": F.concat(F.lit("about "), size),
        "none_ft": F.col("p_name"),
    }
    return src.table("part").select(
        F.col("p_partkey").alias("plan_id"),
        *[F.round(measures.feet(c), 6).alias(n) for n, c in forms.items()],
    )


@query(
    "t7_dimensions",
    "",
    """SELECT p_partkey AS plan_id, d.width_ft, d.length_ft, d.area_sqft FROM part,
    (VALUES (12.5::double, 14::double, 175::double), (6, 14, 84)) d(width_ft, length_ft, area_sqft)
    WHERE p_partkey % 4 <> 0""",
)
def t7(src: Inputs):
    return measures.dimensions(best(src)).withColumn("area_sqft", F.round("area_sqft", 6))


@query(
    "t8_walls_ceilings",
    "",
    """SELECT p_partkey AS plan_id, d.kind, d.ft FROM part, (VALUES ('wall', 9::double), ('wall', 12.5), ('wall', 14),
    ('ceiling', 9)) d(kind, ft) WHERE p_partkey % 4 <> 0""",
)
def t8(src: Inputs):
    texts = best(src)
    walls = measures.wall_lengths(texts).distinct().select(
        "plan_id", F.lit("wall").alias("kind"), F.round("length_ft", 6).alias("ft")
    )
    ceilings = measures.ceiling_heights(texts).select(
        "plan_id", F.lit("ceiling").alias("kind"), F.round("height_ft", 6).alias("ft")
    )
    return walls.unionByName(ceilings)


@query(
    "t9_fixtures",
    "",
    """SELECT p_partkey AS plan_id, CASE WHEN p_partkey % 4 <> 0 THEN 2 ELSE 0 END AS doors,
        CASE WHEN p_partkey % 4 <> 0 THEN 1 ELSE 0 END AS windows,
        CASE WHEN p_partkey % 4 <> 0 THEN 2 ELSE 0 END AS electrical_outlets, 0 AS light_fixtures,
        CASE WHEN p_partkey % 3 <> 0 THEN 3 ELSE 0 END AS plumbing_fixtures, 0 AS switches, 0 AS hvac_vents
    FROM part""",
)
def t9(src: Inputs):
    return measures.fixture_counts(best(src))


# A text for each specification, by family, and what it says. Plan -p has the text at place p % (number of texts).
SPEC_SAMPLES = [
    ("structural", "CRAWL SPACE", "foundation_type", "CRAWL SPACE"),
    ("structural", "SLAB THICKNESS: 0-6", "foundation_thickness", "0-6"),
    ("structural", "HIP ROOF", "roof_type", "HIP ROOF"),
    ("structural", "ROOF PITCH: 6-12", "roof_pitch", "6-12"),
    ("structural", "METAL ROOFING", "roof_material", "METAL ROOFING"),
    ("structural", "2x6 STUD", "stud_size", "2x6"),
    ("structural", "16 ON CENTER", "stud_spacing", "16"),
    ("structural", "2x10 JOIST", "joist_size", "2x10"),
    ("structural", "JOIST 24 OC", "joist_spacing", "24"),
    ("structural", "4x12 BEAM", "beam_size", "4x12"),
    ("structural", "GLULAM 6x10", "beam_size", "6x10"),
    ("system", "PACKAGE UNIT", "hvac_type", "PACKAGE UNIT"),
    ("system", "3.5 TON", "hvac_capacity", "3.5"),
    ("system", "SEER 14", "hvac_efficiency", "14"),
    ("system", "FLEXIBLE DUCT", "duct_material", "FLEXIBLE DUCT"),
    ("system", "2 EXHAUST FAN", "exhaust_fans", "2"),
    ("system", "TANKLESS", "water_heater_type", "TANKLESS"),
    ("system", "40 GAL WH", "water_heater_capacity", "40"),
    ("system", "PROPANE", "water_heater_fuel", "PROPANE"),
    ("system", "PEX PIPE", "pipe_supply", "PEX PIPE"),
    ("system", "CAST IRON PIPE", "pipe_drain", "CAST IRON PIPE"),
    ("system", "3 TOILET", "toilets", "3"),
    ("system", "2 LAVATORY", "sinks", "2"),
    ("system", "1 BATHTUB", "tubs", "1"),
    ("system", "2 SHOWER", "showers", "2"),
    ("system", "200 AMP SERVICE", "panel_amperage", "200"),
    ("system", "40 SPACE PANEL", "panel_spaces", "40"),
    ("system", "12 AWG CABLE", "wire_gauge", "12"),
    ("system", "ROMEX", "wire_type", "ROMEX"),
    ("system", "4 GFCI", "gfci_outlets", "4"),
    ("system", "2 DEDICATED", "dedicated_outlets", "2"),
    ("system", "9 RECEPTACLES", "standard_outlets", "9"),
    ("system", "8 X 10 DUCT", "duct_size", "8 x 10"),
    ("system", "3/4 INCH PIPE", "pipe_size", "3/4"),
    ("material", "R-19 WALL", "wall_r_value", "19"),
    ("material", "R-38 ATTIC", "ceiling_r_value", "38"),
    ("material", "SPRAY FOAM", "insulation_type", "SPRAY FOAM"),
    ("material", "BRICK VENEER", "siding_type", "BRICK VENEER"),
    ("material", "5/8 INCH DRYWALL", "drywall_thickness", "5/8"),
    ("material", "LATEX PAINT", "paint_finish", "LATEX PAINT"),
    ("material", "SATIN FINISH", "paint_primer", "SATIN FINISH"),
    ("material", "4 INCH BASEBOARD", "trim_baseboard", "4"),
    ("material", "5 INCH CROWN", "trim_crown", "5"),
    ("material", "3 INCH CASING", "trim_casing", "3"),
    ("material", "CARPET", "flooring_type", "CARPET"),
]


def _sample_sql(family: str) -> str:
    rows = [f"({k}, '{field}', '{value}')" for k, (f, _, field, value) in enumerate(SPEC_SAMPLES) if f == family]
    return f"""SELECT -p_partkey AS plan_id, field, value FROM part JOIN (VALUES {", ".join(rows)}) d(k, field, value)
    ON p_partkey % {len(SPEC_SAMPLES)} = d.k"""


def _specs_of(src: Inputs, family: str) -> DataFrame:
    texts = F.array(*[F.lit(f"NOTE {text} END") for _, text, _, _ in SPEC_SAMPLES])
    samples = src.table("part").select(
        (-F.col("p_partkey")).alias("plan_id"), F.lit(1).alias("page_no"), F.get(texts, (F.col("p_partkey") % len(SPEC_SAMPLES)).cast("int")).alias("text")
    )
    pages_of = best(src).select("plan_id", "page_no", "text").unionByName(samples)
    first = specs.first_match_specs(pages_of, [family])
    return first.unionByName(specs.all_match_specs(pages_of, [family])).drop("family")


@query(
    "t10_structural_specs",
    "",
    f"""SELECT p_partkey AS plan_id, d.field, d.value FROM part, (VALUES ('foundation_type', 'SLAB ON GRADE'),
    ('roof_type', 'GABLE ROOF')) d(field, value) WHERE p_partkey % 4 <> 0 UNION ALL {_sample_sql('structural')}""",
)
def t10(src: Inputs):
    return _specs_of(src, "structural")


@query(
    "t11_system_specs",
    "",
    f"""SELECT p_partkey AS plan_id, 'hvac_capacity' AS field, '4' AS value FROM part WHERE p_partkey % 4 <> 0
    UNION ALL SELECT p_partkey, d.field, d.value FROM part, (VALUES ('toilets', '30'), ('panel_amperage', '200'),
    ('water_heater_capacity', '50')) d(field, value) WHERE p_partkey % 3 <> 0 UNION ALL {_sample_sql('system')}""",
)
def t11(src: Inputs):
    return _specs_of(src, "system")


@query(
    "t12_material_specs",
    "",
    f"""SELECT p_partkey AS plan_id, 'wall_r_value' AS field, '13' AS value FROM part WHERE p_partkey % 3 <> 0
    UNION ALL {_sample_sql('material')}""",
)
def t12(src: Inputs):
    return _specs_of(src, "material")


@query(
    "t13_wall_area",
    "",
    "SELECT p_partkey AS plan_id, 319 AS wall_sqft FROM part WHERE p_partkey % 4 <> 0",
)
def t13(src: Inputs):
    return measures.wall_area(best(src))


# Measures and category sums of the sample facts, worked out by hand.
_MEASURES_SQL = """m AS (SELECT plan_id, cast(total_sqft AS double) AS a, 4 * sqrt(total_sqft) AS p,
    cast(doors AS double) AS d, cast(windows AS double) AS w, cast(room_count AS double) AS r,
    CASE WHEN outlets BETWEEN floor(total_sqft / 200) AND floor(total_sqft / 100) THEN outlets
        ELSE floor(total_sqft / 150) END AS o, greatest(8, floor(total_sqft / 300)) AS l,
    CASE WHEN plumbing_fixtures BETWEEN 5.5 AND 22 THEN plumbing_fixtures ELSE 11 END AS f,
    CASE WHEN total_sqft > 2000 THEN 1 ELSE 0 END AS big, CASE WHEN total_sqft > 1500 THEN 2 ELSE 0 END AS wash
    FROM fx_plan_facts)"""


def _by_category(rows: dict[str, str], name: str) -> str:
    return " UNION ALL ".join(
        f"SELECT plan_id, '{c}' AS category, round({e}, 4) AS {name} FROM m" for c, e in rows.items()
    )


_QTY_SUMS = {
    "site_work": "a * 0.3e0 / 27 + a * 1.5e0 + 1",
    "concrete": "a * 0.2e0 + greatest(300, a * 0.15e0) + greatest(50, 3 * p) + (a * 0.2e0 + greatest(300, a * 0.15e0)"
    " + greatest(50, 3 * p)) / 27",
    "foundation": "a * 1.0004e0 + floor(p * 0.8e0 / 8) + p * 0.8e0 * 14 + a * 0.03e0 / 27",
    "lumber": "a * 4.1e0",
    "structural": "a * 0.32e0 + floor(a / 50) + floor(a / 100) + floor(p / 20) + floor(a / 400)",
    "roofing": "a * 2.9e0",
    "insulation": "a * (3.6e0 + 1 + 4.6e0 + 3.78e0 + 0.36e0) + floor(p / 15) + d * 16 + w * 12",
    "drywall": "a * 4.6e0 + a * 4.6e0 / 32",
    "flooring": "a * 2.9e0 + r * 6 + floor(a * 0.3e0 / 250)",
    "doors_windows": "2 * d + 2 * w",
    "paint": "a * 4.6e0 + a * 4.6e0 / 400 + a * 4.6e0 / 350",
    "trim_molding": "p * 1.4e0 + d * 8 + w * 12",
    "electrical": "o + 2 * l + o * 40 + l * 25 + o * 15 + l * 10 + floor((o + l) / 3) + floor(a / 200) + 4 + r + o * 4"
    " + 5",
    "plumbing": "f * (1 + 60 + 4 + 1 + 15 + 20) + 1 + 1 + 2 + 5 + 1 + big",
    "hvac": "r * 25 + p * 0.5e0 + 2 * r + greatest(1, floor(a / 2000)) + greatest(1, floor(a / 2500)) + 1",
    "hardware": "a * 0.15e0 + d * 8",
    "cabinets": "18 + 3 + 35 + 4",
    "exterior": "a * 0.8e0 + p * 0.8e0 + greatest(4, floor(p / 50)) + a * 0.8e0 / 300",
    "appliances": "wash + 1",
    "landscaping": "a * 0.4e0 + greatest(3, floor(p / 50)) + greatest(8, floor(p / 20)) + big",
}
_COST_SUMS = {
    "site_work": "0",
    "concrete": "(a * 0.2e0 + greatest(300, a * 0.15e0) + greatest(50, 3 * p)) / 27 * 85",
    "foundation": "a * 0.32e0 + floor(p * 0.8e0 / 8) * 8 + a * 0.45e0 + p * 0.8e0 * 7.2e0 + a * 0.03e0 / 27 * 35"
    " + p * 0.8e0 * 6.8e0",
    "lumber": "a * 0.975e0",
    "structural": "a * 1.44e0 + floor(a / 50) * 12 + floor(a / 100) * 8 + floor(p / 20) * 15 + floor(a / 400) * 25",
    "roofing": "a * (2.16e0 + 0.54e0 + 1.75e0)",
    "insulation": "a * (5.52e0 + 2.457e0 + 0.666e0) + floor(p / 15) * 4.5e0 + (d * 16 + w * 12) * 2.2e0",
    "drywall": "a * 3.91e0",
    "flooring": "a * (1.35e0 + 1.12e0 + 1.95e0 + 0.6e0 + 0.72e0) + r * 48 + floor(a * 0.3e0 / 250) * 45",
    "doors_windows": "d * 215 + w * 365",
    "paint": "a * 4.6e0 / 400 * 35 + a * 4.6e0 / 350 * 45",
    "trim_molding": "p * 2 + p * 2.4e0 + d * 17.6e0 + w * 33.6e0",
    "electrical": "o * (12 + 26 + 42 + 0.6e0) + l * (85 + 8 + 16.25e0 + 28) + floor((o + l) / 3) * 8"
    " + floor(a / 200) * 25 + 850 + 650 + 72 + r * 35 + 180 + 50",
    "plumbing": "f * (220 + 192 + 34 + 18 + 52.5e0 + 36) + 36 + 450 + 680 + 225 + 220 + big * 350",
    "hvac": "(r * 25 + p * 0.5e0) * 5.5e0 + r * 56 + greatest(1, floor(a / 2000)) * 120"
    " + greatest(1, floor(a / 2500)) * 2800",
    "hardware": "a * 0.35e0 + d * (4 + 10.5e0 + 18)",
    "cabinets": "2160 + 540 + 980 + 380",
    "exterior": "a * 3.36e0 + p * 3.6e0 + greatest(4, floor(p / 50)) * 22 + a * 0.8e0 / 300 * 40",
    "appliances": "wash * 700 + 800",
    "landscaping": "a * 0.34e0 + greatest(3, floor(p / 50)) * 25 + greatest(8, floor(p / 20)) * 18 + big * 1200",
}


@query(
    "t14_material_quantities",
    FACTS,
    f"WITH {_MEASURES_SQL} " + _by_category(_QTY_SUMS, "qty"),
)
def t14(src: Inputs):
    items = quantities.quantities(src.view(FACTS))
    return items.groupBy("plan_id", "category").agg(F.round(F.sum("qty"), 4).alias("qty"))


@query(
    "t15_category_costs",
    FACTS,
    f"WITH {_MEASURES_SQL} " + _by_category(_COST_SUMS, "cost"),
)
def t15(src: Inputs):
    costs = quantities.category_costs(quantities.quantities(src.view(FACTS)))
    return costs.withColumn("cost", F.round("cost", 4))


@query(
    "t15_plan_costs",
    FACTS,
    f"""WITH {_MEASURES_SQL}, t AS (SELECT plan_id, {' + '.join(f'({e})' for e in _COST_SUMS.values())} AS total FROM m)
    SELECT plan_id, round(total, 3) AS total_materials, round(total * 0.1e0, 3) AS contingency_amount,
    round(total * 1.1e0, 3) AS total_with_contingency FROM t""",
)
def t15_plan(src: Inputs):
    costs = quantities.category_costs(quantities.quantities(src.view(FACTS)))
    totals = quantities.plan_costs(costs)
    return totals.select(
        "plan_id", *[F.round(c, 3).alias(c) for c in totals.columns if c != "plan_id"]
    )


_CHECKS_SQL = """c AS (SELECT plan_id, 'total_sqft' AS "check", total_sqft AS value, total_sqft BETWEEN 500 AND 10000
        AS passed FROM fx_plan_facts
    UNION ALL SELECT plan_id, 'doors', doors, doors BETWEEN 3 AND 25 FROM fx_plan_facts
    UNION ALL SELECT plan_id, 'windows', windows, windows BETWEEN 4 AND 40 FROM fx_plan_facts
    UNION ALL SELECT plan_id, 'electrical_outlets', outlets, outlets BETWEEN 10 AND 100 FROM fx_plan_facts
    UNION ALL SELECT plan_id, 'plumbing_fixtures', plumbing_fixtures, plumbing_fixtures BETWEEN 2 AND 20
        FROM fx_plan_facts
    UNION ALL SELECT plan_id, 'floor_area_tolerance', round(abs(total_sqft - windows * 100) / greatest(total_sqft,
        windows * 100), 6), CASE WHEN total_sqft <> 0 THEN abs(total_sqft - windows * 100) / greatest(total_sqft,
        windows * 100) <= 0.3 END FROM fx_plan_facts WHERE windows > 0)"""


def _facts(src: Inputs) -> DataFrame:
    return src.view(FACTS).withColumn("floor_area_sum", F.col("windows") * 100)


@query(
    "t16_range_checks",
    FACTS,
    f"""WITH {_CHECKS_SQL} SELECT * FROM c
    UNION ALL SELECT plan_id, 'room_area', room_area, room_area BETWEEN 50 AND 500 FROM fx_plan_facts
    UNION ALL SELECT plan_id, 'ceiling_height', windows / 4, windows / 4 BETWEEN 8 AND 12 FROM fx_plan_facts""",
)
def t16(src: Inputs):
    facts = _facts(src)
    ceilings = facts.select("plan_id", (F.col("windows") / 4).alias("height_ft"))
    checks = validate.check_results(facts, facts.select("plan_id", F.col("room_area").alias("area")), ceilings)
    return checks.withColumn("value", F.round("value", 6))


_ISSUES_SQL = """i AS (SELECT plan_id, concat_ws(',', CASE WHEN total_sqft = 0 THEN 'no_total_area' END,
        CASE WHEN room_count = 0 THEN 'no_rooms' END,
        CASE WHEN room_count > 0 AND room_count < (CASE WHEN total_sqft < 1000 THEN 4 WHEN total_sqft < 2000 THEN 6
            WHEN total_sqft < 3000 THEN 8 ELSE 10 END) / 2 THEN 'too_few_rooms' END,
        CASE WHEN total_sqft > 0 AND room_count > 0 AND room_area > 1.2 * total_sqft
            THEN 'room_area_above_total' END,
        CASE WHEN doors > 50 THEN 'door_count' END, CASE WHEN windows > 50 THEN 'window_count' END,
        CASE WHEN total_sqft > 0 AND doors * 1000 > 15 * total_sqft THEN 'door_density' END,
        CASE WHEN total_sqft > 0 AND windows * 1000 > 20 * total_sqft THEN 'window_density' END) AS critical,
    concat_ws(',', CASE WHEN room_count > 0 AND room_count > 2 * (CASE WHEN total_sqft < 1000 THEN 4
            WHEN total_sqft < 2000 THEN 6 WHEN total_sqft < 3000 THEN 8 ELSE 10 END) THEN 'many_rooms' END,
        CASE WHEN total_sqft > 0 AND room_count > 0 AND room_area > 0 AND room_area < 0.3 * total_sqft
            THEN 'room_area_below_third' END,
        CASE WHEN foundation_type IS NULL THEN 'no_foundation_type' END, 'no_roof_type', 'no_ceiling_height',
        'no_hvac_type', 'no_water_heater_type', 'no_panel_amperage', 'no_insulation_type', 'no_siding_type',
        'no_flooring_type') AS warnings FROM fx_plan_facts)"""


@query(
    "t17_structural_issues",
    FACTS,
    f"""WITH {_ISSUES_SQL} SELECT i.plan_id, critical, concat_ws(',', CASE WHEN windows % 3 = 0 THEN 'no_floor_areas' END,
        warnings, CASE WHEN total_sqft > 0 AND windows * 300 > total_sqft * 2 THEN 'dimension_area' END,
        CASE WHEN total_sqft > 0 AND doors * 60 > sqrt(total_sqft) * 12 THEN 'wall_length' END) AS warnings
    FROM i JOIN fx_plan_facts f ON i.plan_id = f.plan_id""",
)
def t17(src: Inputs):
    facts = _facts(src).withColumns(
        {
            "floor_area_sum": F.when(F.col("windows") % 3 != 0, F.col("floor_area_sum")),
            "dimension_area": F.col("windows") * 300,
            "wall_length": F.col("doors") * 60,
        }
    )
    issues = validate.structural_issues(facts)
    return issues.select(
        "plan_id",
        F.array_join("critical", ",").alias("critical"),
        F.array_join("warnings", ",").alias("warnings"),
    )


_SCORES_SQL = f"""{_CHECKS_SQL}, {_ISSUES_SQL}, n AS (SELECT plan_id, count(*) AS total_checks,
        count(*) FILTER (passed) AS passed_checks, count(*) FILTER (NOT passed) AS failed_checks FROM c GROUP BY 1),
    s AS (SELECT n.*, CASE WHEN critical = '' THEN 0 ELSE length(critical) - length(replace(critical, ',', '')) + 1 END
        AS critical_count, length(warnings) - length(replace(warnings, ',', '')) + 1 + failed_checks
        AS warning_count FROM n JOIN i ON n.plan_id = i.plan_id),
    r AS (SELECT *, greatest(0, passed_checks / total_checks - least(critical_count * 0.2, 0.8)) AS score FROM s)"""


def _scores(src: Inputs) -> DataFrame:
    facts = _facts(src)
    return validate.plan_scores(validate.check_results(facts), validate.structural_issues(facts))


@query(
    "t18_plan_scores",
    FACTS,
    f"""WITH {_SCORES_SQL} SELECT plan_id, total_checks, passed_checks, failed_checks, critical_count, warning_count,
    round(score, 6) AS score FROM r""",
)
def t18(src: Inputs):
    return _scores(src).withColumn("score", F.round("score", 6))


@query(
    "t19_batch_summary",
    FACTS,
    f"""WITH {_SCORES_SQL} SELECT count(*) AS plans, round(avg(score), 6) AS average_score,
    round(max(score), 6) AS best_score, round(min(score), 6) AS worst_score,
    sum(critical_count) AS total_critical_issues, sum(warning_count) AS total_warnings,
    count(*) FILTER (critical_count > 0) AS plans_with_critical_issues FROM r""",
)
def t19(src: Inputs):
    summary = validate.batch_summary(_scores(src))
    return summary.withColumns(
        {n: F.round(n, 6) for n in ("average_score", "best_score", "worst_score")}
    )


@query(
    "t20_run_summary",
    FACTS,
    """SELECT count(*) AS total_plans, count(*) FILTER (total_sqft > 0) AS successful,
    count(*) FILTER (total_sqft = 0) AS failed, round(sum(outlets * 0.25e0), 6) AS total_seconds,
    round(avg(outlets * 0.25e0), 6) AS average_seconds FROM fx_plan_facts""",
)
def t20(src: Inputs):
    status = src.view(FACTS).select(
        "plan_id",
        (F.col("total_sqft") > 0).alias("success"),
        (F.col("outlets") * 0.25).cast("double").alias("seconds"),
    )
    summary = validate.run_summary(status)
    return summary.withColumns({n: F.round(n, 6) for n in ("total_seconds", "average_seconds")})


@query(
    "t21_half_baths",
    "",
    f"""WITH r AS ({_ROOMS_SQL}) SELECT plan_id, area, CASE WHEN room_key = 'bathroom' AND area <= 50
    THEN 'HALF BATH' ELSE name END AS name, CASE WHEN room_key = 'bathroom' AND area <= 50 THEN 'half_bath'
    ELSE room_key END AS room_key FROM r""",
)
def t21(src: Inputs):
    texts = best(src)
    resolved = rooms.resolve_half_baths(rooms.rooms(texts), texts)
    return resolved.select("plan_id", "area", "name", "room_key")


@query(
    "t22_room_back_fill",
    "",
    """WITH p AS (SELECT p_partkey AS plan_id, p_partkey % 4 <> 0 AS one, p_partkey % 3 <> 0 AS two,
        CASE WHEN p_partkey % 4 <> 0 THEN 1100 + p_size * 15 ELSE 0 END AS sqft,
        CASE WHEN p_partkey % 4 <> 0 THEN 600 + p_size * 10 ELSE 0 END AS f1,
        CASE WHEN p_partkey % 4 <> 0 THEN 500 + p_size * 5 ELSE 0 END AS f2 FROM part)
    SELECT plan_id, 'bedroom' AS room_type, 'BEDROOM ' || i AS name, 100 + 20 * i AS area
        FROM p, (SELECT unnest([1, 2, 3, 4]) AS i) WHERE NOT one AND i <= least(4, greatest(2, sqft // 600))
    UNION ALL SELECT plan_id, 'bathroom', 'BATHROOM ' || i, CASE WHEN i = 1 THEN 60 ELSE 40 END
        FROM p, (SELECT unnest([1, 2, 3]) AS i) WHERE NOT two AND i <= least(3, greatest(2, sqft // 800))
    UNION ALL SELECT plan_id, 'kitchen', 'KITCHEN', least(200, greatest(120, f1 // 4)) FROM p WHERE NOT one
    UNION ALL SELECT plan_id, 'dining', 'DINING', least(150, greatest(80, f1 // 6)) FROM p
    UNION ALL SELECT plan_id, 'living', 'LIVING ROOM', least(300, greatest(200, f1 // 3)) FROM p
        WHERE one OR NOT two
    UNION ALL SELECT plan_id, 'family', 'FAMILY ROOM', least(250, greatest(150, f2 // 4)) FROM p WHERE f2 > 0""",
)
def t22(src: Inputs):
    texts = best(src)
    typed = rooms.rooms(texts).withColumn("room_type", rooms.room_type(F.col("name")))
    filled = rooms.back_fill(typed, measures.total_area(texts), measures.floor_areas(texts))
    return filled.select("plan_id", "room_type", "name", "area")


@query(
    "t23_area_reconciliation",
    "",
    f"""WITH r AS ({_ROOMS_SQL}), f AS ({_FLOORS_SQL}),
    p AS (SELECT p_partkey AS plan_id, CASE WHEN p_partkey % 4 <> 0 THEN 1100 + p_size * 15 END AS total_sqft FROM part),
    rs AS (SELECT plan_id, sum(area) AS a, count(*) AS n FROM r GROUP BY 1),
    fs AS (SELECT plan_id, sum(area) AS a FROM f GROUP BY 1)
    SELECT p.plan_id, total_sqft, coalesce(fs.a, 0) AS total_floor_area, coalesce(rs.a, 0) AS total_room_area,
        coalesce(rs.n, 0) AS room_count, coalesce(rs.a, 0) > 1.2 * coalesce(total_sqft, 0) AS double_count
    FROM p LEFT JOIN rs ON p.plan_id = rs.plan_id LEFT JOIN fs ON p.plan_id = fs.plan_id""",
)
def t23(src: Inputs):
    texts = best(src)
    return rooms.reconcile(
        rooms.rooms(texts), measures.floor_areas(texts), measures.total_area(texts)
    )
