"""Domain presets of the property-listing pipeline.

Operators in ``gable.operators`` are generic and take these lists, maps and
ranges as parameters; the composed stages in ``gable.plans.property`` pass
the values below.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: these must equal the source pipeline's constants for equal
# results (labels, maps, column lists, ranges, benchmark tables, patterns).
# ---------------------------------------------------------------------------

# Stage 1
HOUSE_SUBTYPES = [
    "residence", "villa", "mixed building", "master house",
    "cottage", "bungalow", "chalet", "mansion",
]
APARTMENT_SUBTYPES = [
    "apartment", "ground floor", "penthouse", "duplex",
    "studio", "loft", "triplex", "student flat", "student housing",
]
YES_NO_COLS = [
    "leased", "running_water", "access_disabled", "preemption_right",
    "has_swimming_pool", "sewer_connection", "attic", "cellar",
    "entry_phone", "solar_panels", "planning_permission_granted",
    "alarm", "heat_pump", "surroundings_protected", "air_conditioning",
    "rain_water_tank", "security_door", "low_energy", "water_softener",
    "opportunity_for_professional",
]
NUMERIC_STR_COLS = ["frontage_width", "terrain_width_roadside"]
CORE_DTYPES = {"property_id": "string", "url": "string"}
EXPECTED_MIN_COLUMNS = ["url", "property_id", "price"]
URL_PATTERNS = {
    "property_subtype": r"detail/([^/]+)/",
    "postal_code": r"/(\d{4})/",
    "locality": r"/\d{4}/([^/]+)/",
}

# Stage 2
COLS_TO_DROP = [
    "parking_places_outdoor", "wash_room", "front_facade_orientation", "diningrooms",
    "parking_places_indoor", "certification_gasoil_tank", "opportunity_for_professional",
    "water_softener", "garden_orientation", "low_energy", "maintenance_cost",
    "terrace_orientation", "security_door", "rain_water_tank", "p_score", "g_score",
    "air_conditioning", "surroundings_protected", "heat_pump", "alarm",
    "terrain_width_roadside", "planning_permission_granted", "frontage_width",
    "solar_panels", "kitchen_type", "garden_surface", "vat", "demarcated_flooding_area",
    "availability",
]
RENAME_HOUSE = {
    "kitchen_surface": "kitchen_surface_house",
    "land_surface": "land_surface_house",
    "garage": "has_garage",
    "co2": "co2_house",
    "cadastral_income": "cadastral_income_house",
    "attic": "attic_house",
}
RENAME_APARTMENT = {
    "entry_phone": "entry_phone_apartment",
    "apartement_floor": "apartement_floor_apartment",
    "terrace_surface": "terrace_surface_apartment",
    "number_floors": "number_floors_apartment",
}
BINARY_COLS = [
    "cellar", "sewer_connection", "has_swimming_pool",
    "preemption_right", "access_disabled", "running_water",
    "is_furnished", "has_garage", "leased", "has_garden",
    "has_terrace",
]
NUMERIC_KEEP_MISSING = [
    "kitchen_surface_house", "living_room_surface",
    "land_surface_house", "apartement_floor_apartment",
    "number_floors_apartment",
]
CATEGORICAL_KEEP_MISSING = ["has_equipped_kitchen", "glazing_type", "heating_type", "state"]
NUMERIC_KEY_FIELDS = [
    "primary_energy_consumption", "build_year", "bathrooms",
    "elevator", "facades_number", "area", "rooms",
    "terrace_surface_apartment", "co2_house", "attic_house",
    "entry_phone_apartment", "cadastral_income_house", "toilets",
]
STATE_GROUPED_MAPPING = {
    "To renovate": 0,
    "To be renovated": 0,
    "To restore": 0,
    "To demolish": 0,
    "Under construction": 1,
    "Normal": 2,
    "Fully renovated": 3,
    "Excellent": 3,
    "New": 4,
    "Missing": -1,
}
KITCHEN_EQUIPPED_MAPPING = {
    "Missing": -1,
    "Not equipped": 0,
    "Partially equipped": 1,
    "Fully equipped": 2,
    "Super equipped": 3,
}
GLAZING_MAPPING = {
    "Missing": -1,
    "Simple glass": 0,
    "Double glass": 1,
    "Triple glass": 2,
}
HEATING_MAPPING = {
    "Missing": -1,
    "Not specified": -1,
    "Coal": 0,
    "Wood": 1,
    "Fuel oil": 2,
    "Gas": 3,
    "Hot air": 4,
    "Electricity": 5,
    "Solar energy": 6,
}
ELECTRICAL_MAPPING = {
    "yes, certificate in accordance": 1,
    "No, certificate does not comply": 0,
}
FLOODING_MAPPING = {
    "no flooding area": 1,
    "Low risk": 1,
    "(information not available)": -1,
}
PLAUSIBLE_RANGES = {
    "price": (25_000, 5_000_000),
    "rooms": (-1, 15),
    "area": (15, 1000),
    "kitchen_surface_house": (-1, 200),
    "living_room_surface": (-1, 300),
    "land_surface_house": (-1, 30_000),
    "bathrooms": (-1, 10),
    "toilets": (-1, 10),
    "apartement_floor_apartment": (-1, 50),
    "number_floors_apartment": (-1, 50),
    "terrace_surface_apartment": (-1, 200),
    "cadastral_income_house": (-1, 10_000),
    "primary_energy_consumption": (-1, 2_000),
    "co2_house": (-1, 1_000),
    "facades_number": (-1, 4),
}
APARTMENT_SUBTYPE_MAP = {
    "ground floor": "apartment",
    "studio": "apartment",
    "student flat": "apartment",
    "loft": "apartment",
}
HOUSE_SUBTYPE_MAP = {
    "residence": "house",
    "master house": "house",
}
SUBTYPES_TO_DROP = ["mixed building"]
KEEP_PROPERTY_TYPES = ["House", "Apartment"]

# Stage 2.5
PROVINCE_TO_REGION = {
    "Provincie Antwerpen": "Flanders",
    "Province d’Anvers": "Flanders",
    "Province d'Anvers": "Flanders",
    "Provincie Oost-Vlaanderen": "Flanders",
    "Province de Flandre orientale": "Flanders",
    "Provincie West-Vlaanderen": "Flanders",
    "Province de Flandre occidentale": "Flanders",
    "Provincie Vlaams-Brabant": "Flanders",
    "Province du Brabant flamand": "Flanders",
    "Provincie Limburg": "Flanders",
    "Province du Limbourg": "Flanders",
    "Provincie Henegouwen": "Wallonia",
    "Province du Hainaut": "Wallonia",
    "Provincie Luik": "Wallonia",
    "Province de Liège": "Wallonia",
    "Provincie Namen": "Wallonia",
    "Province de Namur": "Wallonia",
    "Provincie Waals-Brabant": "Wallonia",
    "Province du Brabant wallon": "Wallonia",
    "Provincie Luxemburg": "Wallonia",
    "Province du Luxembourg": "Wallonia",
    "Brussels Hoofdstedelijk Gewest": "Brussels",
    "Région de Bruxelles-Capitale": "Brussels",
}
PRICE_TABLE_PROVINCES = {
    "province": [
        "Provincie Antwerpen", "Provincie Oost-Vlaanderen",
        "Provincie Henegouwen", "Brussels Hoofdstedelijk Gewest",
        "Provincie Luik", "Provincie West-Vlaanderen", "Provincie Namen",
        "Provincie Waals-Brabant", "Provincie Vlaams-Brabant",
        "Provincie Limburg", "Provincie Luxemburg",
    ],
    "apt_avg_m2": [2849, 2890, 1847, 3423, 2292, 3760, 2553, 3244, 3260, 2562, 2448],
    "house_avg_m2": [2419, 2257, 1411, 3308, 1708, 2048, 1673, 2342, 2539, 1926, 1620],
}
PRICE_TABLE_REGIONS = {
    "region": ["Flanders", "Wallonia", "Brussels"],
    "apt_avg_m2": [3133, 2387, 3423],
    "house_avg_m2": [2266, 1642, 3308],
}
PRICE_TABLE_NATIONAL = {
    "apartment": {"avg": 3091, "min": 2188, "max": 4358},
    "house": {"avg": 2076, "min": 1223, "max": 3296},
}
GEO_COLUMNS_KEPT = [
    "CD_REFNIS", "TX_DESCR_NL", "TX_DESCR_FR", "TX_ADM_DSTR_DESCR_NL",
    "TX_ADM_DSTR_DESCR_FR", "TX_PROV_DESCR_NL", "TX_PROV_DESCR_FR",
]
GEO_RENAMES = {
    "TX_DESCR_NL": "municipality_nl",
    "TX_DESCR_FR": "municipality_fr",
    "TX_ADM_DSTR_DESCR_NL": "arrondissement_nl",
    "TX_ADM_DSTR_DESCR_FR": "arrondissement_fr",
    "TX_PROV_DESCR_NL": "province_nl",
    "TX_PROV_DESCR_FR": "province_fr",
}
POSTAL_RENAMES = {"Postal Code": "postal_code", "Municipality code": "municipality_code"}
ENRICH_DROP = [
    "locality_lower", "municipality_code", "CD_REFNIS",
    "municipality_nl_lower", "municipality_fr_lower", "name", "province_lang",
]

# Runner
STAGE1_VERSION = "1.0.0"
STAGE2_VERSION = "1.0.0"
STAGE3_VERSION = "1.0.0"
RANDOM_STATE = 42
TECHNICAL_COLS = ["url", "property_id", "__stage1_version", "__stage2_version", "address"]

# Stage 3
MISSINGNESS_NUMERIC_COLS = [
    "area", "state",
    "facades_number", "is_furnished", "has_terrace", "has_garden",
    "has_swimming_pool", "has_equipped_kitchen", "build_year", "cellar",
    "has_garage", "bathrooms", "heating_type",
    "sewer_connection", "certification_electrical_installation",
    "preemption_right", "flooding_area_type", "leased",
    "living_room_surface", "attic_house", "glazing_type",
    "elevator", "access_disabled", "toilets",
    "cadastral_income_house",
]
LOG_FEATURES = ["area"]
TARGET_ENCODING_COLS = ["property_subtype", "property_type", "postal_code", "locality"]
TARGET_ENCODING_ALPHA = 100.0
TARGET_COL = "price"
TE_SUFFIX = "_te_price"
GEO_COLUMNS = [
    "apt_avg_m2_province", "house_avg_m2_province",
    "apt_avg_m2_region", "house_avg_m2_region",
    "province_benchmark_m2", "region_benchmark_m2",
    "national_benchmark_m2",
]
# Leakage-safe fitter (fit on train, transform all)
FITTER_NUMERIC_CONT = [
    "area", "rooms", "living_room_surface", "build_year",
    "facades_number", "bathrooms", "toilets",
    "cadastral_income_house", "median_income",
    "apt_avg_m2_province", "house_avg_m2_province",
    "apt_avg_m2_region", "house_avg_m2_region",
    "province_benchmark_m2", "region_benchmark_m2", "national_benchmark_m2",
]
IMPUTE_BINARY_COLS = [
    "cellar", "has_garage", "has_swimming_pool",
    "has_equipped_kitchen", "access_disabled",
    "elevator", "leased", "is_furnished",
    "has_terrace", "has_garden",
]
FITTER_ORDINAL_COLS = [
    "heating_type", "glazing_type",
    "sewer_connection", "certification_electrical_installation",
    "preemption_right", "flooding_area_type",
    "attic_house", "state", "region", "province",
]
# Training-script variant
TRAINING_NUMERIC_CONT = [
    "area", "rooms", "living_room_surface", "build_year",
    "facades_number", "bathrooms", "toilets",
    "cadastral_income_house", "median_income",
]
TRAINING_ORDINAL_COLS = FITTER_ORDINAL_COLS
# One-shot (unfitted) variant
ONESHOT_NUMERIC_CONT = [
    "area", "rooms", "living_room_surface", "build_year",
    "facades_number", "bathrooms", "toilets",
    "cadastral_income_house", "area_log",
]
ONESHOT_ORDINAL_COLS = [
    "heating_type", "glazing_type",
    "sewer_connection", "certification_electrical_installation",
    "preemption_right", "flooding_area_type",
    "attic_house", "state",
]
GEO_AGGREGATE_KEYS = {"postal_price_mean": "postal_code", "locality_price_mean": "locality"}

# Feature matrix
MATRIX_DROP_ALWAYS = ["property_id", "url"]
MATRIX_DROP_TRAINING = ["property_id", "url", "address"]
MATRIX_LEAKAGE = ["price_log"]
MATRIX_LEAKAGE_PREFIXES = ["diff_to_", "ratio_to_"]
TECH_PREFIX = "__stage"

# Models
GAP_ALLOWANCE = 0.20
GAP_WEIGHT = 2.0
ENSEMBLE_GRID = 21
CV_FOLDS = 5
TEST_SIZE = 0.15
TRAIN_VAL_TEST = (0.70, 0.15, 0.15)
RF_TREES = 300

# Raw listing columns used as numbers downstream (read as text from CSV, then
# coerced); derived from the columns the stages compare numerically.
RAW_NUMERIC_COLS = [
    "is_furnished", "garage", "has_garden", "has_terrace", "area", "rooms", "bathrooms", "toilets",
    "facades_number", "build_year", "elevator", "kitchen_surface", "living_room_surface", "land_surface",
    "terrace_surface", "apartement_floor", "number_floors", "primary_energy_consumption", "co2",
    "cadastral_income",
]
