"""Fixed values of the plan takeoff: terms, patterns, ranges and prices."""

# Terms that speak for a usable page text, per scoring version.
PAGE_TERMS = ["FLOOR", "ROOM", "BEDROOM", "BATHROOM", "KITCHEN", "LIVING", "GARAGE", "SQ", "FT", "DIMENSION"]
PAGE_TERMS_LONG = [
    "FLOOR", "ROOM", "BEDROOM", "BATHROOM", "KITCHEN", "LIVING", "GARAGE", "SQ", "FT", "DIMENSION",
    "WALL", "DOOR", "WINDOW", "CEILING", "HEIGHT",
]

# Total-area patterns. Patterns that only narrow `AREA n` find nothing new and are left out.
TOTAL_AREA = [
    r"TOTAL\s+COVERED\s+(\d+)",
    r"TOTAL\s+LIVING\s+(\d+)",
    r"TOTAL\s+SQ\.?\s*FT\.?\s*(\d+)",
    r"TOTAL\s+(\d+)\s*SQ\.?\s*FT\.?",
    r"(\d+)\s+SQUARE\s+FEET",
    r"(\d+)\s+SQFT",
    r"(\d+)\s+SQ\s+FT",
    r"AREA\s*:?\s*(\d+)",
    r"(\d+)\s*SF",
    r"(\d+)\s*S\.F\.",
    r"\b(\d{3,4})\b(?=\s*(?:SQ|SF|SQUARE|TOTAL|AREA|LIVING|COVERED))",
    r"(?:TOTAL|AREA|LIVING|COVERED|GROSS|NET)\s*:?\s*(\d{3,4})\b",
]

# Floor-area spellings as one pattern, and the spelling that excludes room areas.
FLOOR_AREA = r"(FIRST|SECOND|THIRD|FOURTH)\s+FLOOR(?:\s+(?:LIVING|AREA))?\s*:?\s*(\d+)"
FLOOR_NUMBER = r"(FIRST|SECOND|THIRD|FOURTH)\s+FLOOR\s+(?:LIVING|AREA)?\s*(\d+)"
FLOOR_NAME = r"(FIRST|SECOND|THIRD|FOURTH)\s+FLOOR"

# Room keywords in rule order.
ROOM_KEYWORDS = [
    "DINING", "KITCHEN", "BEDROOM", "BATH", "GARAGE", "PATIO", "PORCH", "OFFICE", "STUDY", "FAMILY", "DEN",
    "MASTER", "CLOSET", "LAUNDRY", "POWDER", "HALF", "BREAKFAST", "GREAT", "LOFT", "BONUS", "FOYER",
    "ENTRY", "HALL", "UTILITY", "PANTRY", "MUDROOM", "SUNROOM", "LIBRARY", "MEDIA", "GAME", "RECREATION",
    "EXERCISE", "WORKSHOP",
]
KEYWORD_RANGE = (20, 2000)

# Room name, kind, area group, lowest and highest area, pattern; in rule order.
ROOM_RULES = [
    ("LIVING ROOM", "living", 1, 100, 800, r"(?<!FLOOR\s)(?:LIVING\s+(?:ROOM\s+)?|LIVING\s+)(\d+)(?:\s|$)"),
    ("BEDROOM", "bedroom", 2, 50, 500, r"(?:BEDROOM|BED|BR)\s*(\d+)\s+(\d+)"),
    ("BATHROOM", "bathroom", 2, 20, 200, r"(?:BATHROOM|BATH|POWDER)\s*(\d+)?\s+(\d+)"),
    ("HALF BATH", "half_bath", 1, 15, 60, r"(?:HALF\s+BATH|POWDER\s+ROOM|POWDER|1/2\s+BATH)\s+(\d+)"),
    ("HALF BATH", "half_bath", 1, 15, 60, r"(?:HALF\s+BATH|POWDER\s+ROOM|POWDER|1/2\s+BATH)\s*(\d+)"),
    ("HALF BATH", "half_bath", 1, 15, 60, r"(\d+)\s*(?:HALF\s+BATH|POWDER\s+ROOM|POWDER|1/2\s+BATH)"),
    ("HALF BATH", "half_bath", 1, 15, 60, r"(?:HALF|POWDER)\s*(\d+)"),
    ("HALF BATH", "half_bath", 1, 15, 60, r"(\d+)\s*(?:HALF|POWDER)"),
    ("HALF BATH", "half_bath", 1, 15, 60, r"(?:WC|W\.C\.)\s*(\d+)"),
    ("HALF BATH", "half_bath", 1, 15, 60, r"(\d+)\s*(?:WC|W\.C\.)"),
    ("KITCHEN", "kitchen", 1, 50, 300, r"KITCHEN\s+(\d+)"),
    ("FAMILY ROOM", "family", 1, 100, 600, r"(?:FAMILY\s+ROOM|FAMILY)\s+(\d+)"),
    ("GREAT ROOM", "great", 1, 200, 800, r"(?:GREAT\s+ROOM|GREAT)\s+(\d+)"),
    ("BONUS ROOM", "bonus", 1, 80, 400, r"(?:BONUS\s+ROOM|BONUS)\s+(\d+)"),
    ("DINING ROOM", "dining", 1, 80, 300, r"(?:DINING\s+ROOM|DINING)\s+(\d+)"),
    ("MASTER BEDROOM", "master", 1, 120, 400, r"(?:MASTER\s+BEDROOM|MASTER\s+BR|MASTER)\s+(\d+)"),
    ("MASTER BATH", "master_bath", 1, 40, 150, r"(?:MASTER\s+BATH|MASTER\s+BATHROOM)\s+(\d+)"),
    ("UTILITY ROOM", "utility", 1, 30, 120, r"(?:LAUNDRY\s+ROOM|LAUNDRY|UTILITY\s+ROOM|UTILITY)\s+(\d+)"),
    ("OFFICE", "office", 1, 80, 250, r"(?:OFFICE|STUDY|DEN)\s+(\d+)"),
    ("FOYER", "foyer", 1, 20, 100, r"(?:FOYER|ENTRY|ENTRYWAY)\s+(\d+)"),
    ("WALK-IN CLOSET", "closet", 1, 15, 80, r"(?:WALK.IN\s+CLOSET|WIC|W\.I\.C\.)\s+(\d+)"),
    ("PANTRY", "pantry", 1, 15, 60, r"(?:PANTRY)\s+(\d+)"),
    ("HALL", "hall", 1, 20, 150, r"(?:HALL|HALLWAY)\s+(\d+)"),
]
EXCLUDES_FLOOR_AREAS = {"living"}
HALF_BATH_MARK = r"(?:HALF|POWDER|1/2|WC|W\.C\.)"

# Master-bathroom patterns, first hit in 80-200.
MASTER_BATHROOM = [
    r"MASTER\s+BATH(?:ROOM)?\s*(\d+)",
    r"MASTER\s+(\d+)\s*SQ\.?\s*FT\.?",
    r"MB\s*(\d+)",
    r"MASTER\s+(\d+)",
    r"BATH\s*(\d+)\s*MASTER",
    r"BATHROOM\s*(\d+)\s*MASTER",
]

# Words of each room type, tried in order; the short list ends in `other`.
ROOM_TYPES = [
    ("bedroom", "BEDROOM|BED|BR"),
    ("bathroom", "BATH|BATHROOM|POWDER"),
    ("kitchen", "KITCHEN|KIT"),
    ("dining", "DINING|DIN"),
    ("living", "LIVING|LIV"),
    ("family", "FAMILY|FAM"),
    ("garage", "GARAGE|GAR"),
    ("patio", "PATIO|DECK|PORCH"),
    ("office", "OFFICE|STUDY|DEN"),
    ("laundry", "LAUNDRY|UTILITY"),
    ("closet", "CLOSET|WALK-IN"),
    ("foyer", "FOYER|ENTRY|HALL"),
    ("pantry", "PANTRY"),
    ("master", "MASTER"),
]
ROOM_TYPES_SHORT = ["bedroom", "bathroom", "kitchen", "living", "dining", "garage", "family"]

# Feet-inches spellings of one length, of a pair of lengths, and of ceiling heights.
LENGTH = r"\d+['\"]?\s*-\s*\d+['\"]?"
DIMENSION_PAIRS = [
    rf"({LENGTH})\s*=?\s*[xX×]\s*({LENGTH})",
    r"(\d+['\"]?\s*[-–]\s*\d+['\"]?)\s*[xX×]\s*(\d+['\"]?\s*[-–]\s*\d+['\"]?)",
    r"(\d+)\s*[xX×]\s*(\d+)",
    r"(\d+['\"])\s*[xX×]\s*(\d+['\"]?)",
    rf"({LENGTH})\s*[xX×]\s*(\d+)",
    rf"(\d+)\s*[xX×]\s*({LENGTH})",
]
DIMENSION_FALLBACK = r"(\d+['\"]?)\s*[xX×]\s*(\d+['\"]?)"
CEILING_HEIGHT = [
    rf"CEILING\s+HEIGHT\s+({LENGTH})",
    rf"CLG\.?\s+HT\.?\s+({LENGTH})",
    rf"({LENGTH})\s*CEILING",
]

# Fixture patterns; the count is the larger of the two for `max`, their sum for `sum`.
FIXTURES = {
    "doors": (
        "max",
        r"(?:DOOR|door)(?!\s*(?:way|bell|knob|handle))",
        r"(?m)(?:^|\s)(?:D\d+|DOOR\s*\d+)",
    ),
    "windows": (
        "max",
        r"(?:WINDOW|window|WIN)(?!\s*(?:sill|frame|trim))",
        r"(?m)(?:^|\s)(?:W\d+|WINDOW\s*\d+|WIN\s*\d+)",
    ),
    "electrical_outlets": (
        "sum",
        r"(?:OUTLET|outlet|RECEP|recep|\bGFI\b|\bGFCI\b)",
        r"(?:\bOUTLET\s+\d+\b|\bRECEP\s+\d+\b)",
    ),
    "light_fixtures": (
        "sum",
        r"(?:LIGHT\s+FIXTURE|light\s+fixture|CEILING\s+FAN|ceiling\s+fan|PENDANT|pendant|CHANDELIER|chandelier|LIGHT\s+\d+)",
        r"(?:\bLT\d+\b|\bLIGHT\s+\d+\b)",
    ),
    "plumbing_fixtures": (
        "sum",
        r"(?:TOILET|toilet|WC|w\.c\.|WATER\s+CLOSET)",
        r"(?:SINK|sink|LAVATORY|lavatory|LAV|lav|BASIN)",
        r"(?:SHOWER|shower|TUB|tub|BATHTUB|bathtub|BATH\s+TUB)",
        r"(?:\bPLUMBING\s+\d+\b|\bFIXTURE\s+\d+\b)",
    ),
    "switches": ("sum", r"(?:SWITCH|switch|TOGGLE|toggle)", r"(?:\bSW\d+\b|\bSWITCH\s+\d+\b)"),
    "hvac_vents": (
        "sum",
        r"(?:SUPPLY\s+VENT|RETURN\s+VENT|AIR\s+VENT|HVAC\s+VENT)",
        r"(?:\bVENT\s+\d+\b|\bHVAC\s+\d+\b)",
    ),
}
WINDOW_LIMIT = 100

# Specification rules (family, field, patterns). The first pattern found in a plan gives the
# value; a pattern with a group gives the group, one without gives the upper-cased match.
FIRST_MATCH = {
    "structural": {
        "foundation_type": [
            r"SLAB\s+FOUNDATION|CONCRETE\s+SLAB|SLAB\s+ON\s+GRADE",
            r"CRAWL\s+SPACE|CRAWLSPACE",
            r"BASEMENT|FULL\s+BASEMENT",
            r"PIER\s+AND\s+BEAM|PIER\s+BEAM",
            r"STEM\s+WALL|FOUNDATION\s+WALL",
        ],
        "foundation_thickness": [
            rf"FOUNDATION\s+THICKNESS[:\s]*({LENGTH})",
            rf"SLAB\s+THICKNESS[:\s]*({LENGTH})",
            rf"({LENGTH})\s*THICK\s+(?:FOUNDATION|SLAB)",
            r"(\d+['\"]?)\s*THICK\s+(?:FOUNDATION|SLAB)",
        ],
        "roof_type": [
            r"GABLE\s+ROOF|GABLE",
            r"HIP\s+ROOF|HIP",
            r"SHED\s+ROOF|SHED",
            r"MANSARD\s+ROOF|MANSARD",
            r"GAMBREL\s+ROOF|GAMBREL",
            r"FLAT\s+ROOF|FLAT",
        ],
        "roof_pitch": [
            rf"ROOF\s+PITCH[:\s]*({LENGTH})",
            rf"PITCH[:\s]*({LENGTH})",
            rf"({LENGTH})\s*PITCH",
            r"(\d+:\d+)\s*PITCH",
            r"(\d+/\d+)\s*PITCH",
        ],
        "roof_material": [
            r"COMPOSITION\s+SHINGLES|COMP\s+SHINGLES|ASPHALT\s+SHINGLES",
            r"METAL\s+ROOFING|METAL\s+ROOF",
            r"TILE\s+ROOF|CLAY\s+TILE|CONCRETE\s+TILE",
            r"WOOD\s+SHINGLES|CEDAR\s+SHINGLES",
            r"SLATE\s+ROOF|SLATE",
            r"EPDM\s+ROOFING|RUBBER\s+ROOF",
        ],
        "stud_size": [
            r"(\d+x\d+)\s*(?:STUD|WALL\s+STUD)",
            r"(?:STUD|WALL\s+STUD)\s*(\d+x\d+)",
            r"(\d+x\d+)\s*(?:FRAMING|WALL\s+FRAMING)",
        ],
        "stud_spacing": [
            r"(\d+['\"]?)\s*O\.?C\.?\s*(?:STUD|SPACING)",
            r"(?:STUD|SPACING)\s*(\d+['\"]?)\s*O\.?C\.?",
            r"(\d+['\"]?)\s*ON\s+CENTER",
        ],
        # the last joist size or spacing of the text wins, so the later patterns come first
        "joist_size": [
            r"(?:JOIST|FLOOR\s+JOIST)\s*(\d+x\d+)",
            r"(\d+x\d+)\s*(?:JOIST|FLOOR\s+JOIST)",
        ],
        "joist_spacing": [
            r"(?:JOIST|SPACING)\s*(\d+['\"]?)\s*O\.?C\.?",
            r"(\d+['\"]?)\s*O\.?C\.?\s*(?:JOIST|SPACING)",
        ],
    },
    "system": {
        "hvac_type": [
            r"HEAT\s+PUMP|HEAT\s+PUMP\s+SYSTEM",
            r"FURNACE|GAS\s+FURNACE|ELECTRIC\s+FURNACE",
            r"AIR\s+CONDITIONER|A/C|AC\s+UNIT",
            r"PACKAGE\s+UNIT|PACKAGED\s+UNIT",
            r"SPLIT\s+SYSTEM|SPLIT\s+UNIT",
            r"MINI\s+SPLIT|DUCTLESS",
        ],
        "hvac_capacity": [r"(\d+(?:\.\d+)?)\s*TON", r"(\d+)\s*BTU", r"(\d+)\s*MBH"],
        "hvac_efficiency": [
            r"SEER\s*(\d+(?:\.\d+)?)",
            r"AFUE\s*(\d+(?:\.\d+)?)",
            r"HSPF\s*(\d+(?:\.\d+)?)",
            r"(\d+(?:\.\d+)?)\s*SEER",
            r"(\d+(?:\.\d+)?)\s*AFUE",
        ],
        "duct_material": [
            r"GALVANIZED\s+STEEL|GALV\s+STEEL",
            r"FLEXIBLE\s+DUCT|FLEX\s+DUCT",
            r"FIBERGLASS\s+DUCT|FIBERGLASS",
            r"SHEET\s+METAL|METAL\s+DUCT",
            r"RIGID\s+DUCT|RIGID",
        ],
        "exhaust_fans": [
            r"(\d+)\s*(?:EXHAUST\s+FAN|BATH\s+FAN|VENT\s+FAN)",
            r"(?:EXHAUST\s+FAN|BATH\s+FAN|VENT\s+FAN).*?(\d+)",
            r"(\d+)\s*CFM\s*(?:EXHAUST|FAN)",
        ],
        "water_heater_type": [
            r"ELECTRIC\s+WATER\s+HEATER|ELECTRIC\s+WH",
            r"GAS\s+WATER\s+HEATER|GAS\s+WH",
            r"TANKLESS\s+WATER\s+HEATER|TANKLESS",
            r"HEAT\s+PUMP\s+WATER\s+HEATER|HPWH",
            r"SOLAR\s+WATER\s+HEATER|SOLAR\s+WH",
        ],
        "water_heater_capacity": [
            r"(\d+)\s*GAL\s*(?:WATER\s+HEATER|WH)",
            r"(\d+)\s*GALLON\s*(?:WATER\s+HEATER|WH)",
            r"(\d+)\s*GAL",
            r"(\d+)\s*GALLON",
        ],
        "water_heater_fuel": [
            r"NATURAL\s+GAS|GAS",
            r"ELECTRIC|ELECTRICAL",
            r"PROPANE|LP\s+GAS",
            r"SOLAR|SOLAR\s+ASSISTED",
        ],
        # the last material named wins, so the later patterns come first
        "pipe_supply": [r"CPVC\s+PIPE|CPVC", r"PEX\s+PIPE|PEX", r"COPPER\s+PIPE|COPPER"],
        "pipe_drain": [r"CAST\s+IRON\s+PIPE|CAST\s+IRON", r"(?<!C)PVC\s+PIPE|(?<!C)PVC"],
        "toilets": [r"(\d+)\s*(?:TOILET|WC|W\.C\.)"],
        "sinks": [r"(\d+)\s*(?:SINK|LAVATORY|LAV)"],
        "tubs": [r"(\d+)\s*(?:TUB|BATHTUB)"],
        "showers": [r"(\d+)\s*(?:SHOWER|SHOWER\s+STALL)"],
        "panel_amperage": [
            r"(\d+)\s*AMP\s*(?:MAIN\s+)?(?:PANEL|SERVICE)",
            r"(\d+)\s*A\s*(?:MAIN\s+)?(?:PANEL|SERVICE)",
            r"(\d+)\s*AMP\s*ELECTRICAL",
            r"(\d+)\s*A\s*ELECTRICAL",
        ],
        "panel_spaces": [
            r"(\d+)\s*(?:SPACE|CIRCUIT)\s*(?:PANEL|BOX)",
            r"(\d+)\s*(?:SPACE|CIRCUIT)",
            r"(\d+)\s*SLOT\s*(?:PANEL|BOX)",
        ],
        "wire_gauge": [
            r"(\d+)\s*AWG\s*(?:WIRE|CABLE)",
            r"(\d+)\s*GAUGE\s*(?:WIRE|CABLE)",
            r"(\d+)\s*GA\s*(?:WIRE|CABLE)",
            r"#(\d+)\s*(?:WIRE|CABLE)",
        ],
        "wire_type": [
            r"THWN\s+WIRE|THWN",
            r"THHN\s+WIRE|THHN",
            r"NM\s+CABLE|ROMEX",
            r"UF\s+CABLE|UF",
            r"COPPER\s+WIRE|COPPER",
            r"ALUMINUM\s+WIRE|ALUMINUM",
        ],
        "gfci_outlets": [r"(\d+)\s*(?:GFCI\s+OUTLET|GFCI)"],
        "dedicated_outlets": [r"(\d+)\s*(?:DEDICATED\s+OUTLET|DEDICATED)"],
        "standard_outlets": [
            r"(\d+)\s*(?:RECEPTACLE|RECEPTACLES)",
            r"(\d+)\s*(?:STANDARD\s+OUTLET|STANDARD)",
        ],
    },
    "material": {
        "wall_r_value": [
            r"R-(\d+(?:\.\d+)?)\s*(?:WALL|WALLS)",
            r"R(\d+(?:\.\d+)?)\s*(?:WALL|WALLS)",
            r"(\d+(?:\.\d+)?)\s*R-VALUE\s*(?:WALL|WALLS)",
            r"WALL\s*R-(\d+(?:\.\d+)?)",
            r"WALL\s*R(\d+(?:\.\d+)?)",
        ],
        "ceiling_r_value": [
            r"R-(\d+(?:\.\d+)?)\s*(?:CEILING|CEILINGS|ATTIC)",
            r"R(\d+(?:\.\d+)?)\s*(?:CEILING|CEILINGS|ATTIC)",
            r"(\d+(?:\.\d+)?)\s*R-VALUE\s*(?:CEILING|CEILINGS|ATTIC)",
            r"CEILING\s*R-(\d+(?:\.\d+)?)",
            r"ATTIC\s*R-(\d+(?:\.\d+)?)",
        ],
        "insulation_type": [
            r"FIBERGLASS\s+BATT|FIBERGLASS",
            r"CELLULOSE\s+INSULATION|CELLULOSE",
            r"SPRAY\s+FOAM|SPRAY\s+INSULATION",
            r"BLOWN\s+IN\s+INSULATION|BLOWN\s+IN",
            r"RIGID\s+FOAM|RIGID\s+INSULATION",
            r"MINERAL\s+WOOL|ROCK\s+WOOL",
        ],
        "siding_type": [
            r"HARDIE\s+PLANK|HARDIE\s+SIDING",
            r"VINYL\s+SIDING|VINYL",
            r"WOOD\s+SIDING|WOOD",
            r"FIBER\s+CEMENT|FIBER\s+CEMENT\s+SIDING",
            r"BRICK\s+VENEER|BRICK",
            r"STONE\s+VENEER|STONE",
            r"STUCCO|STUCCO\s+FINISH",
            r"BOARD\s+AND\s+BATTEN|BOARD\s+BATTEN",
        ],
        "drywall_thickness": [
            r"(\d+(?:/\d+)?)\s*(?:INCH|IN|['\"])\s*(?:DRYWALL|GYPSUM|SHEETROCK)",
            r"(\d+(?:/\d+)?)\s*(?:INCH|IN|['\"])\s*(?:GYP|GYP\s+BOARD)",
            r"(\d+(?:/\d+)?)\s*(?:INCH|IN|['\"])\s*(?:WALL\s+BOARD|WALLBOARD)",
        ],
        # the last paint named wins, so the later patterns come first
        "paint_finish": [r"OIL\s+BASED\s+PAINT|OIL\s+BASED", r"LATEX\s+PAINT|LATEX"],
        "paint_primer": [
            r"SATIN\s+FINISH|SATIN",
            r"FLAT\s+FINISH|FLAT",
            r"SEMI\s+GLOSS|SEMI\s+GLOSS\s+FINISH",
            r"EGG\s+SHELL\s+FINISH|EGG\s+SHELL",
        ],
        "trim_baseboard": [r"(\d+(?:\.\d+)?)\s*(?:INCH|IN|['\"])\s*(?:BASEBOARD|BASE)"],
        "trim_crown": [r"(\d+(?:\.\d+)?)\s*(?:INCH|IN|['\"])\s*(?:CROWN\s+MOLDING|CROWN)"],
        "trim_casing": [r"(\d+(?:\.\d+)?)\s*(?:INCH|IN|['\"])\s*(?:CASING|DOOR\s+CASING)"],
    },
}
LAST_MATCH_FIELDS = {"joist_size", "joist_spacing"}

# Highest and lowest accepted number of a field; a rejected match tries the next pattern.
NUMBER_RANGES = {
    "water_heater_capacity": (20, 200),
    "toilets": (0, 50),
    "sinks": (0, 50),
    "tubs": (0, 50),
    "showers": (0, 50),
}

# Specifications of which every distinct match is kept.
ALL_MATCHES = {
    "structural": {
        "beam_size": [
            r"(\d+x\d+)\s*(?:BEAM|GLULAM|LVL)",
            r"(?:BEAM|GLULAM|LVL)\s*(\d+x\d+)",
            r"(\d+x\d+)\s*(?:HEADER|GIRDER)",
            r"(?:HEADER|GIRDER)\s*(\d+x\d+)",
            r"(\d+x\d+)\s*(?:LUMBER|WOOD)",
        ],
    },
    "system": {
        "duct_size": [r"(\d+['\"]?\s*[Xx]\s*\d+['\"]?)\s*(?:DUCT|DIA)"],
        "pipe_size": [r"(\d+(?:/\d+)?)\s*(?:INCH|IN|['\"])\s*(?:PIPE|DIA)"],
    },
    "material": {
        "flooring_type": [
            r"HARDWOOD\s+FLOORING|HARDWOOD",
            r"LAMINATE\s+FLOORING|LAMINATE",
            r"TILE\s+FLOORING|CERAMIC\s+TILE",
            r"CARPET|CARPETING",
            r"VINYL\s+FLOORING|VINYL",
            r"LUXURY\s+VINYL\s+PLANK|LVP",
            r"ENGINEERED\s+HARDWOOD|ENGINEERED",
            r"BAMBOO\s+FLOORING|BAMBOO",
        ],
    },
}
PIPE_SIZE_RANGE = (0.5, 4.0)

# Unit price of each material (dollars, material only).
PRICES = {
    "concrete": 85, "lumber": 0.65, "roofing_shingles": 1.8, "roofing_underlayment": 0.45,
    "roofing_flashing": 3.5, "insulation": 1.2, "drywall": 0.85, "tile": 4.5, "carpet": 2.8,
    "hardwood": 6.5, "door": 180, "window": 320, "door_frame": 35, "window_frame": 45,
    "paint_primer": 35, "paint": 45, "baseboard": 2.5, "crown_molding": 4.0, "door_casing": 2.2,
    "window_casing": 2.8, "outlet": 12, "light_fixture": 85, "switch": 8, "wire": 0.65,
    "electrical_panel": 850, "service_entrance": 650, "plumbing_fixture": 220, "pipe": 3.2,
    "fitting": 8.5, "water_main_connection": 450, "sewer_connection": 680, "ductwork": 5.5,
    "vent": 28, "thermostat": 120, "air_handler": 2800, "hvac_installation": 0, "excavation": 0,
    "grading": 0, "backfill": 0, "site_preparation": 0, "nails": 2.0, "screws": 3.0, "bolts": 1.0,
    "hinges": 3.5, "locks": 18, "kitchen_cabinet": 120, "bathroom_cabinet": 180, "countertop": 28,
    "sink": 95, "siding": 4.2, "gutter": 4.5, "downspout": 22, "exterior_paint": 40,
    "refrigerator": 1200, "stove": 800, "dishwasher": 600, "washer": 700, "dryer": 700,
    "water_heater": 800, "sod": 0.85, "mulch": 25, "plant": 18, "irrigation_system": 1200,
    "rebar": 800, "foundation_bolt": 8, "vapor_barrier": 0.45, "waterproofing": 1.2, "gravel": 35,
    "form_boards": 0.85, "engineered_lumber": 4.5, "metal_connector": 12, "structural_screws": 4.5,
    "hurricane_tie": 8, "post_anchor": 15, "beam_pocket": 25, "conduit": 2.8, "junction_box": 8,
    "breaker": 25, "gfci_outlet": 18, "smoke_detector": 35, "electrical_meter": 180,
    "grounding_rod": 25, "wire_nut": 0.15, "shut_off_valve": 18, "vent_pipe": 3.5, "cleanout": 45,
    "water_meter": 220, "pressure_tank": 350, "sump_pump": 280, "floor_drain": 65,
    "pipe_insulation": 1.8, "house_wrap": 0.65, "foam_board": 1.85, "caulk_tube": 4.5,
    "weatherstripping": 2.2, "subfloor": 2.8, "underlayment": 1.2, "transition_strip": 8,
    "floor_adhesive": 45, "carpet_padding": 1.8,
}
CONTINGENCY = 0.10

# Accepted range of each checked fact.
CHECK_RANGES = {
    "total_sqft": (500, 10000),
    "doors": (3, 25),
    "windows": (4, 40),
    "electrical_outlets": (10, 100),
    "plumbing_fixtures": (2, 20),
    "ceiling_height": (8.0, 12.0),
    "room_area": (50, 500),
}
TOLERANCE = 0.3
