"""Fixed values of the order and cost tables.

Everything in this module is a value that must equal the studied system's
for results to agree: code lists, encodings, lookup tables, ratios and
thresholds.  They are stated plainly, in their natural order, and are turned
into Spark literal maps / tiny dimension tables by ``forgeline.functions``.
"""

from __future__ import annotations

# --- FIXED VALUES (must equal the studied system) ---------------------------

# Class index of the 18-class process classifier (label map order, 0-based).
PROCESS_CLASSES = [
    "cnc_milling",
    "cnc_turning",
    "sheet_metal_bending",
    "sheet_metal_stamping",
    "injection_molding",
    "die_casting",
    "sand_casting",
    "investment_casting",
    "additive_fdm",
    "additive_slm",
    "laser_cutting",
    "forging",
    "extrusion",
    "5axis_cnc",
    "turning_milling",
    "edm",
    "vacuum_forming",
    "powder_coating",
]

# Pipeline process encoding: 1..18 in the class order above, unknown -> 0.
PIPELINE_PROCESS_CODE = {p: i + 1 for i, p in enumerate(PROCESS_CLASSES)}

# Cost-model process encoding: only the first 13 processes are known, others 0.
COST_PROCESS_CODE = {p: i + 1 for i, p in enumerate(PROCESS_CLASSES[:13])}

# Pipeline material family encoding (1..8), unknown -> 0.
PIPELINE_MATERIAL_FAMILY = {
    "AL6061": 1, "AL7075": 1, "AL2024": 1,
    "SS304": 2, "SS316L": 2, "SS17-4": 2,
    "MS_A36": 3, "MS_1018": 3,
    "TI6AL4V": 4,
    "PEEK": 5, "POM": 5, "PA66": 5,
    "ABS": 6, "PLA": 6, "PETG": 6,
    "INCONEL625": 7,
    "CARBON_FIBER": 8,
}

# Cost-model material family encoding (1..6), unknown -> 0.
COST_MATERIAL_FAMILY = {
    "AL6061": 1, "AL7075": 1, "AL2024": 1,
    "SS304": 2, "SS316L": 2, "SS17-4": 2,
    "MS_A36": 3, "MS_1018": 3,
    "TI6AL4V": 4,
    "PEEK": 5, "POM": 5, "PA66": 5,
    "ABS": 6, "PLA": 6, "PETG": 6,
}

# Materials whose prices are tracked by the price feed.
TRACKED_MATERIALS = [
    "AL6061", "AL7075", "AL2024",
    "SS304", "SS316L", "SS17-4",
    "MS_A36", "MS_1018",
    "TI6AL4V",
    "PEEK", "POM", "PA66",
    "ABS", "PLA", "PETG",
    "INCONEL625",
]

# Three fallback price tables (USD/kg); they disagree on purpose (see README).
# 1) pipeline price feed: 16 entries, unknown -> NULL
PIPELINE_FALLBACK_PRICES = {
    "AL6061": 2.80, "AL7075": 4.10, "AL2024": 3.90,
    "SS304": 3.50, "SS316L": 5.20, "SS17-4": 8.40,
    "MS_A36": 0.95, "MS_1018": 1.10,
    "TI6AL4V": 35.00,
    "PEEK": 82.00, "POM": 4.20, "PA66": 3.80,
    "ABS": 2.10, "PLA": 2.00, "PETG": 2.40,
    "INCONEL625": 55.00,
}
# 2) cost-model price fetcher: 17 entries, unknown -> 5.00
FETCHER_FALLBACK_PRICES = {
    "AL6061": 2.80, "AL7075": 4.10, "AL2024": 3.90,
    "SS304": 3.50, "SS316L": 5.20, "SS17-4": 8.40,
    "MS_A36": 0.95, "MS_1018": 1.10,
    "TI6AL4V": 35.00,
    "PEEK": 82.00, "POM": 4.20, "PA66": 3.80,
    "ABS": 2.10, "PLA": 2.00, "PETG": 2.40,
    "CARBON_FIBER": 25.00,
    "INCONEL625": 55.00,
}
# 3) cost-feature builder historical averages: 8 entries, unknown -> 5.00
FEATURE_HISTORICAL_PRICES = {
    "AL6061": 2.80, "AL7075": 4.10, "SS304": 3.50,
    "SS316L": 5.20, "TI6AL4V": 35.00, "PEEK": 80.00,
    "ABS": 2.10, "PLA": 2.00,
}
DEFAULT_PRICE_USD_PER_KG = 5.00
FALLBACK_STALENESS_DAYS = 999
LIVE_STALENESS_LIMIT_DAYS = 7
PRICE_WINDOW_DAYS = 7

# IT tolerance grade -> index; anything else -> 5.
TOLERANCE_IT_INDEX = {
    "IT4": 1, "IT5": 2, "IT6": 3, "IT7": 4,
    "IT8": 5, "IT9": 6, "IT10": 7, "IT11": 8, "IT12": 9,
}
DEFAULT_TOLERANCE_INDEX = 5

# Surface-finish preset text -> Ra (um); unparsable or missing -> 3.2.
SURFACE_FINISH_PRESETS = {
    "as_machined": 3.2,
    "fine": 1.6,
    "very_fine": 0.8,
    "mirror": 0.1,
}
DEFAULT_SURFACE_FINISH_RA = 3.2

# Cost components, in the label column order.
COST_COMPONENTS = ["machine_time", "setup", "tooling", "raw_material", "finishing"]
COST_COMPONENT_COLUMNS = ["cost_" + c for c in COST_COMPONENTS]
# Component name used by the cost models -> training label column.
MODEL_COMPONENT_COLUMN = {
    "machine_time_cost": "cost_machine_time",
    "setup_cost": "cost_setup",
    "tooling_cost": "cost_tooling",
    "raw_material_cost": "cost_raw_material",
    "finishing_cost": "cost_finishing",
}
NO_TOOLING_PROCESSES = ["additive_fdm", "additive_slm", "laser_cutting"]

# Decomposition ratios (machine_time, setup, tooling, raw_material, finishing).
DECOMPOSITION_RATIOS = {
    "cnc_milling": (0.45, 0.15, 0.10, 0.25, 0.05),
    "cnc_turning": (0.45, 0.15, 0.10, 0.25, 0.05),
    "sheet_metal_bending": (0.30, 0.25, 0.10, 0.25, 0.10),
    "sheet_metal_stamping": (0.20, 0.20, 0.30, 0.20, 0.10),
    "injection_molding": (0.20, 0.10, 0.50, 0.15, 0.05),
    "die_casting": (0.25, 0.10, 0.45, 0.15, 0.05),
    "sand_casting": (0.35, 0.15, 0.25, 0.15, 0.10),
    "additive_fdm": (0.55, 0.15, 0.00, 0.25, 0.05),
    "additive_slm": (0.50, 0.15, 0.00, 0.30, 0.05),
    "laser_cutting": (0.35, 0.15, 0.00, 0.40, 0.10),
}
DEFAULT_RATIOS = (0.40, 0.15, 0.15, 0.20, 0.10)

# Display names (classifier module text; the API module differs for EDM only).
PROCESS_DISPLAY_NAMES = {
    "cnc_milling": "CNC Milling",
    "cnc_turning": "CNC Turning",
    "sheet_metal_bending": "Sheet Metal Bending",
    "sheet_metal_stamping": "Sheet Metal Stamping",
    "injection_molding": "Injection Molding",
    "die_casting": "Die Casting",
    "sand_casting": "Sand Casting",
    "investment_casting": "Investment Casting",
    "additive_fdm": "Additive Manufacturing (FDM)",
    "additive_slm": "Additive Manufacturing (SLM)",
    "laser_cutting": "Laser Cutting",
    "forging": "Forging",
    "extrusion": "Extrusion",
    "5axis_cnc": "5-Axis CNC Machining",
    "turning_milling": "CNC Turning + Milling",
    "edm": "EDM (Electrical Discharge Machining)",
    "vacuum_forming": "Vacuum Forming",
    "powder_coating": "Powder Coating",
}

# Probability -> confidence tier; training count -> cost confidence.
TIER_HIGH_MIN_PROB = 0.55
TIER_MEDIUM_MIN_PROB = 0.25
COST_CONF_HIGH_MIN_N = 80
COST_CONF_MEDIUM_MIN_N = 25

# Classifier feature order (14 features).
FEATURE_COLUMNS = [
    "bounding_box_x", "bounding_box_y", "bounding_box_z",
    "volume", "surface_area",
    "wall_thickness_min", "wall_thickness_avg",
    "aspect_ratio",
    "hole_count", "hole_diameter_min",
    "undercut_flag", "thin_wall_flag",
    "curvature_complexity", "symmetry_score",
]

# Cost-model feature order (22 features).
COST_FEATURE_COLUMNS = [
    "bounding_box_x", "bounding_box_y", "bounding_box_z",
    "volume", "surface_area",
    "wall_thickness_min", "wall_thickness_avg",
    "aspect_ratio", "hole_count", "hole_diameter_min",
    "undercut_flag", "thin_wall_flag",
    "curvature_complexity", "symmetry_score",
    "quantity", "log_quantity", "batch_size",
    "material_code_encoded", "material_price_per_kg",
    "surface_finish_ra", "tolerance_index",
    "volume_x_price",
]
COST_MIN_PROCESS_ROWS = 20
COST_MIN_COMPONENT_ROWS = 10
COST_MIN_COMPONENT_VALUE = 0.01

# Thresholds of the ETL and feature code.
THIN_WALL_MM = 1.5
WALL_IMPUTE_FALLBACK = 1.5
HOLE_DIAMETER_FALLBACK = 5.0
CURVATURE_VARIANCE_SCALE = 0.85
COVERAGE_MIN_PER_PROCESS = 20
COVERAGE_WARN_PER_PROCESS = 100
COVERAGE_MIN_PER_MATERIAL = 5
STALE_PRICE_DAYS = 7
DRIFT_STD_THRESHOLD = 0.5
DRIFT_KS_P_LIMIT = 0.01
DRIFT_MIN_ROWS = 5
DRIFT_PROCESS_SHARE_LIMIT = 0.15
DRIFT_NUMERIC_COLUMNS = [
    "volume", "surface_area", "wall_thickness_min", "wall_thickness_avg",
    "quantity", "material_price_per_kg", "cost_total",
]
TOP1_CONFIDENCE_SPLIT = 0.15
MAPE_MIN_TRUE = 1.0

# Hard process constraints: (rule, excluded processes).
#   undercut_flag == 1          -> injection_molding, die_casting
#   any box side > 600 mm       -> injection_molding
#   wall_thickness_min < 2.0    -> sand_casting
#   wall_thickness_min < 0.8    -> injection_molding, die_casting, forging
#   wall_thickness_min < 0.5    -> cnc_milling, cnc_turning, 5axis_cnc, turning_milling
#   wall_thickness_avg > 12.0   -> sheet_metal_bending, sheet_metal_stamping, laser_cutting
# Missing inputs default to: undercut 0, box sides 0.0, wall min 10.0, wall avg 5.0.
CONSTRAINT_DEFAULTS = {
    "undercut_flag": 0, "bounding_box_x": 0.0, "bounding_box_y": 0.0,
    "bounding_box_z": 0.0, "wall_thickness_min": 10.0, "wall_thickness_avg": 5.0,
}

# Cost fallback estimate for processes without a trained model.
FALLBACK_DEFAULT_VOLUME = 50000.0
FALLBACK_DEFAULT_QUANTITY = 10.0
FALLBACK_DENSITY_G_CM3 = 2.7
FALLBACK_TOTAL_OVER_MATERIAL = 3.5
FALLBACK_SHARES = {"machine_time": 0.40, "setup": 0.15, "tooling": 0.10, "finishing": 0.05}

# Validation rules, in rule order (column, type, null policy, range, allowed, default).
VALIDATION_RULES = [
    ("part_id", "string", "required", None, None, None),
    ("bounding_box_x", "float", "required", (0.5, 3000.0), None, None),
    ("bounding_box_y", "float", "required", (0.5, 3000.0), None, None),
    ("bounding_box_z", "float", "required", (0.5, 1000.0), None, None),
    ("volume", "float", "required", (1.0, 1.0e9), None, None),
    ("surface_area", "float", "required", (1.0, 5.0e7), None, None),
    ("wall_thickness_min", "float", "flag_and_impute", (0.1, 500.0), None, None),
    ("wall_thickness_avg", "float", "flag_and_impute", (0.5, 500.0), None, None),
    ("aspect_ratio", "float", "required", (1.0, 50.0), None, None),
    ("hole_count", "int", "default_value", (0, 200), None, 0),
    ("hole_diameter_min", "float", "flag_and_impute", (0.5, 100.0), None, None),
    ("undercut_flag", "int", "default_value", None, [0, 1], 0),
    ("thin_wall_flag", "int", "required", None, [0, 1], None),
    ("curvature_complexity", "float", "default_value", (0.0, 1.0), None, 0.0),
    ("symmetry_score", "float", "default_value", (0.0, 1.0), None, 0.5),
    ("process_code", "string", "drop_row", None, PROCESS_CLASSES, None),
    ("material_code", "string", "required", None, None, None),
    ("quantity", "int", "required", (1, 1000000), None, None),
    ("material_price_per_kg", "float", "fallback_to_historical_avg", (0.50, 500.0), None, None),
    ("cost_machine_time", "float", "drop_row", (0.01, 100000.0), None, None),
    ("cost_setup", "float", "drop_row", (0.0, 50000.0), None, None),
    ("cost_tooling", "float", "drop_row", (0.0, 500000.0), None, None),
    ("cost_raw_material", "float", "drop_row", (0.01, 100000.0), None, None),
    ("cost_finishing", "float", "drop_row", (0.0, 50000.0), None, None),
    ("cost_total", "float", "drop_row", (0.01, 500000.0), None, None),
    ("cost_label_source", "string", "default_value", None, ["exact", "decomposed", "estimated"], "estimated"),
]
HISTORICAL_AVG_PRICE_FILL = 5.0
DUPLICATE_KEY = ["part_id", "process_code"]
DUPLICATE_REASON = "Duplicate combination of part_id and process_code"

# Feature-registry ranges used by the feature-vector validator (name, lo, hi),
# in registry (= FEATURE_COLUMNS) order.
FEATURE_RANGES = [
    ("bounding_box_x", 0.5, 3000.0),
    ("bounding_box_y", 0.5, 3000.0),
    ("bounding_box_z", 0.5, 1000.0),
    ("volume", 1.0, 1e9),
    ("surface_area", 1.0, 5e7),
    ("wall_thickness_min", 0.1, 50.0),
    ("wall_thickness_avg", 0.5, 100.0),
    ("aspect_ratio", 1.0, 50.0),
    ("hole_count", 0, 200),
    ("hole_diameter_min", 0.5, 100.0),
    ("undercut_flag", 0, 1),
    ("thin_wall_flag", 0, 1),
    ("curvature_complexity", 0.0, 1.0),
    ("symmetry_score", 0.0, 1.0),
]
# Features that must be present (non-null) for the feature-vector validator.
FEATURE_REQUIRED = [
    "bounding_box_x", "bounding_box_y", "bounding_box_z",
    "volume", "surface_area",
    "undercut_flag", "thin_wall_flag",
    "hole_count", "aspect_ratio",
]
VOLUME_BOX_TOLERANCE = 1.05

# Cost-model routing: processes with a trained model file; thresholds high 80 / medium 25.
ROUTED_PROCESSES = ["cnc_milling", "cnc_turning", "sheet_metal_bending", "injection_molding",
                    "additive_slm", "sand_casting"]
ROUTING_MODEL_SUFFIX = "_v2.pkl"

# Process catalog bounds: process, wall min / max (mm), hole diameter min / max (mm), least quantity; None: any.
PROCESS_CATALOG_BOUNDS = [
    ("cnc_milling", 0.5, 3000, 0.5, 3000, 1.0),
    ("cnc_turning", 1.0, 2000, 1.0, 500, 1.0),
    ("sheet_metal_bending", 0.5, 4.0, 0.5, 4.0, None),
    ("sheet_metal_stamping", 0.5, 4.0, 0.5, 4.0, None),
    ("injection_molding", 1.0, 4.0, 1.0, 4.0, 10000),
    ("die_casting", 1.5, 6.0, 1.5, 6.0, 1000),
    ("sand_casting", 3.0, None, 3.0, None, None),
    ("investment_casting", 0.5, 10.0, 0.5, 10.0, None),
    ("additive_fdm", 0.4, 3.0, 0.4, 3.0, None),
    ("additive_slm", 0.2, 2.0, 0.2, 2.0, None),
    ("laser_cutting", 0.5, 25.0, 0.5, 25.0, None),
    ("forging", 5.0, None, 5.0, None, None),
    ("extrusion", 1.0, None, 1.0, None, None),
    ("5axis_cnc", 0.5, 1500, 0.5, 1500, 1.0),
    ("turning_milling", 1.0, 1000, 1.0, 500, 1.0),
    ("edm", 0.1, None, 0.1, None, None),
    ("vacuum_forming", 0.5, 4.0, 0.5, 4.0, 100),
    ("powder_coating", None, None, None, None, None),
    ("waterjet_cutting", None, None, None, None, None),
    ("electroplating", None, None, None, None, None),
    ("anodizing", None, None, None, None, None),
    ("grinding", None, None, None, None, None),
    ("broaching", 1.0, None, 1.0, None, None),
    ("deep_draw", 0.5, 3.0, 0.5, 3.0, 500),
    ("roll_forming", 0.5, 4.0, 0.5, 4.0, 1000),
    ("hipping", None, None, None, None, None),
    ("heat_treatment", None, None, None, None, None),
    ("thread_rolling", 0.5, None, 0.5, None, None),
    ("hobbing", None, None, None, None, None),
    ("burnishing", None, None, None, None, None),
]

# Material index: commodity family per material.
MATERIAL_COMMODITY = {
    "AL6061": "Aluminium",
    "AL7075": "Aluminium",
    "SS304": "Steel",
    "SS316L": "Steel",
    "TI6AL4V": "Titanium",
    "PEEK": "Polymer",
    "ABS": "Polymer",
    "PLA": "Polymer",
}

# Values a scoring request may name.
REQUEST_SOURCE_FORMATS = ["STEP", "STL", "IGES"]
REQUEST_FINISH_PRESETS = ["as_machined", "fine", "very_fine", "mirror"]
REQUEST_TOLERANCES = ["IT4", "IT5", "IT6", "IT7", "IT8", "IT9", "IT10", "IT11", "IT12"]

# Per-process fit settings of the cost models (trees' depth, step size, number of trees).
COST_MODEL_OVERRIDES = {
    "cnc_milling": {"maxDepth": 6, "stepSize": 0.05, "maxIter": 400},
    "sheet_metal_bending": {"maxDepth": 4, "stepSize": 0.08, "maxIter": 250},
    "injection_molding": {"maxDepth": 5, "stepSize": 0.04, "maxIter": 350, "regLambda": 2.0},
    "additive_slm": {"maxDepth": 4, "stepSize": 0.05, "maxIter": 200},
    "sand_casting": {"maxDepth": 3, "stepSize": 0.05, "maxIter": 150, "minInstancesPerNode": 2},
}
