"""Fixed values of the pricing domain: products, code labels, mode settings, ladder ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# --- Fixed values: product names, their family and the pricing mode ------------
PRODUCT_MODES = {
    "GND_Com": "GND",
    "GND_Resi": "GND",
    "GND_USPS": "GND",
    "GND_CWT": "GND_CWT",
    "1DA": "AIR",
    "2DA": "AIR",
    "3DA": "AIR",
    "Air_CWT": "AIR_CWT",
    "Import": "IE",
    "Export": "IE",
}
GROUND_FAMILY = ["GND_Com", "GND_Resi", "GND_USPS"]
RESIDENTIAL_FAMILY = ["GND_Resi", "GND_USPS"]
AIR_FAMILY = ["1DA", "2DA", "3DA"]
TRADE_FAMILY = ["Import", "Export"]
PRICED_MODES = ["AIR", "GND", "IE"]
HEAVY_MODES = ["AIR_CWT", "GND_CWT"]
UNKNOWN_MODE = "Unknown"
SURCHARGE_MODE = "ACY"
UNRELIABLE_PRODUCTS = ["GND_Unclassified", "Unknown"]

# --- Fixed values: code labels --------------------------------------------------
WATCHED_COMPETITOR = "FedEx"
WATCHED_COMPETITOR_CODES = [15, 16, 60, 83]
OTHER_COMPETITOR = "Other"
CATEGORY_LABELS = {"00": "Not known", "01": "National", "02": "Major", "03": "Key", "04": "Small"}
WIN_FLAGS = {"A": "1", "C": "1", "O": "1", "R": "0"}
REASON_LABELS = {1: "RETENTION", 2: "PENETRATION", 3: "CONVERSION"}
REJECT_AFTER_DAYS = 90

# --- Fixed values: zones and weight bands ---------------------------------------
ZONES = ["2", "3", "4", "5", "6", "7", "8", "46", "47", "48"]
WEIGHT_LABELS = [
    "0_0_5_lbs", "0_5625_1_lbs", "2_2_lbs", "3_3_lbs", "4_4_lbs", "5_5_lbs", "6_10_lbs", "11_15_lbs",
    "16_20_lbs", "21_25_lbs", "26_30_lbs", "31_40_lbs", "41_50_lbs", "51_75_lbs", "76_100_lbs", "101_535068_lbs",
]
WEIGHT_EDGES = [0.0, 0.5, 1.0, 2.0, 3.0, 4.0, 5.0, 10.0, 15.0, 20.0, 25.0, 30.0, 40.0, 50.0, 75.0, 100.0, None]
WEIGHT_EDGES_AS_CODED = [0.0, 0.5, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 10.0, 15.0, 20.0, 25.0, 30.0, 40.0, 50.0, 75.0, 100.0]

# --- Fixed values: settings per pricing mode ------------------------------------
MODE_SETTINGS = {
    "AIR": {
        "price_discipline": 0.3, "volume_weight": 0.4, "prior_slack": 0.02,
        "u_price": 0.52, "u_market": -1.5, "l_price": -1.25, "l_market": 0.5, "floor": 0.25,
    },
    "GND": {
        "price_discipline": 0.3, "volume_weight": 0.4, "prior_slack": 0.02,
        "u_price": 0.7, "u_market": -1.5, "l_price": -1.3, "l_market": 0.3, "floor": 0.1,
    },
    "IE": {
        "price_discipline": 0.5, "volume_weight": 0.4, "prior_slack": 0.0,
        "u_price": 0.5, "u_market": -2.0, "l_price": -1.3, "l_market": 0.5, "floor": 0.2,
    },
}
LADDER_STRICT = {("1DA", "2DA"): 0.78928, ("2DA", "3DA"): 0.91533, ("1DA", "3DA"): 0.51308}
LADDER_RELAXED = {("1DA", "2DA"): 0.68762, ("2DA", "3DA"): 0.8136, ("1DA", "3DA"): 0.48919}

# --- Fixed values: post-processing ----------------------------------------------
SPREAD_HIGH = 0.01
SPREAD_LOW = 0.05
MAX_COST_RATIO = 0.95
GAP_LOW, GAP_HIGH = -0.2, 0.0
OFFERED_LOW, OFFERED_HIGH = 0.05, 0.70
DEFAULT_DENSITY = 1.0
DEFAULT_TIER = 6
SWEEP_STEPS = (-20, 20)

# --- Fixed values: industry segments --------------------------------------------
INDUSTRIES = {
    "Apparel and Consumer Goods": "apparel_and_consumer_goods",
    "Diversified Vehicles & Parts": "diversified_vehicles_and_parts",
    "Government": "government",
    "Healthcare": "healthcare",
    "Industrial Products": "industrial_products",
    "Professional Services": "professional_services",
    "High Tech": "high_tech",
    "Other": "other",
    "Unclassified": "unclassified",
}
UNMAPPED_INDUSTRY = "not_available"


def values_frame(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A small table as literals in the plan: its size is known, so joins can be sized."""

    def literal(value) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, bool):
            return "true" if value else "false"
        if isinstance(value, (int, float)):
            return repr(value)
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

    fields = [field.strip().rsplit(" ", 1) for field in schema.split(",")]
    casts = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in fields)
    names = ", ".join(name for name, _ in fields)
    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT {casts} FROM VALUES {body} AS t({names})")


def settings_frame(spark: SparkSession, settings: dict = MODE_SETTINGS) -> DataFrame:
    """The settings as (mode, name, value) rows."""
    rows = [(mode, name, float(value)) for mode, group in settings.items() for name, value in group.items()]
    return values_frame(spark, "mode string, name string, value double", rows)


def by_mode(mode_col, name: str, settings: dict = MODE_SETTINGS):
    """One setting as a column, chosen by mode; NULL for a mode that is not priced."""
    chosen = None
    for mode, group in settings.items():
        when = (F if chosen is None else chosen).when(mode_col == mode, F.lit(float(group[name])))
        chosen = when
    return chosen


def product_mode(product_col):
    """Pricing mode of a product."""
    chosen = None
    for product, mode in PRODUCT_MODES.items():
        chosen = (F if chosen is None else chosen).when(product_col == product, F.lit(mode))
    return chosen.otherwise(F.lit(UNKNOWN_MODE))
