"""Column names, types, status words and report titles.

Inside the package every column is snake_case. Titles with spaces appear only
when ``titled`` renames a finished report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
# A row's share of the index numerator is kept as the nearest whole number and
# the rest, so that sums do not depend on the order in which partitions arrive.
INDEX_WHOLE = T.DecimalType(38, 0)
INDEX_REST = T.DecimalType(21, 20)

PASS = "PASS"
FAIL = "FAIL"
INVESTIGATE = "INVESTIGATE"
WAIVED = "WAIVED"
KVI = "KVI"
OUTLIER = "Outlier"

KEY = ["market_name", "time_period", "upc", "condition"]


def _struct(strings, rest, rest_type) -> T.StructType:
    fields = [T.StructField(n, T.StringType()) for n in strings]
    return T.StructType(fields + [T.StructField(n, rest_type) for n in rest])


RAW_PRICING = _struct(
    ["market_name", "time_period", "upc"],
    ["units", "comp_units", "dollars", "comp_dollars"],
    MONEY,
)

PRICING = T.StructType(
    _struct(
        ["market_name", "time_period", "upc", "condition"],
        ["units", "dollars", "market_units", "market_dollars", "price_weighted_volume"],
        MONEY,
    ).fields
    + [T.StructField("kvi_quad", T.StringType()), T.StructField("outlier_flag", T.StringType())]
)

QC_INDEX = _struct(
    ["time_period", "condition"],
    [
        "store_index", "dollars", "units", "market_dollars", "market_units",
        "kvi_index", "kvi_dollars", "kvi_units", "kvi_market_dollars", "kvi_market_units",
        "market_count", "condition_count", "item_count", "kvi_item_count",
    ],
    T.DoubleType(),
)

# The column names of the input tables a user already has.
RAW_PRICING_SOURCE = {
    "market_name": "Market Name",
    "time_period": "Time Period",
    "upc": "UPC",
    "units": "Units (Proj)",
    "comp_units": "Units (Proj) - Comp Mkt",
    "dollars": "Value (Proj)",
    "comp_dollars": "Value (Proj) - Comp Mkt",
}
PRICING_SOURCE = {
    "market_name": "Market_Name",
    "time_period": "Time_Period",
    "upc": "UPC",
    "condition": "Condition",
    "units": "Units",
    "dollars": "Dollars",
    "market_units": "Market_Units",
    "market_dollars": "Market_Dollars",
    "price_weighted_volume": "50%_Price_Weighted_Volume",
    "kvi_quad": "KVI Quad",
    "outlier_flag": "50%_Outlier",
}

# Report titles, in report order. ``{raw}`` and ``{template}``
# stand for the short names a team uses for its two tables.
TITLES = {
    "duplication": {
        "distinct_combinations": "Duplication Check 1 - Distinct Combinations",
        "all_rows": "Duplication Check 2 - All Rows",
        "duplication_flag": "Duplication Flag",
    },
    "coverage": {
        "market_name": "Market Name",
        "period_date": "Time Period",
        "item_count_flag": "ITEM COUNT FLAG",
        "client_units_flag": "Client UNITS FLAG",
        "rom_units_flag": "ROM UNITS FLAG",
        "client_dollars_flag": "Client DOLLARS FLAG",
        "rom_dollars_flag": "ROM DOLLARS FLAG",
        "raw_item_count": "{raw} UPC Count",
        "raw_client_units": "{raw} Client Units",
        "raw_rom_units": "{raw} ROM Units",
        "raw_client_dollars": "{raw} Client Dollars",
        "raw_rom_dollars": "{raw} ROM Dollars",
        "template_item_count": "{template} UPC Count",
        "template_client_units": "{template} Client Units",
        "template_rom_units": "{template} ROM Units",
        "template_client_dollars": "{template} Client Dollars",
        "template_rom_dollars": "{template} ROM Dollars",
        "item_count_pct_diff": "Item Count % Difference",
        "client_units_pct_diff": "Client Units % Difference",
        "rom_units_pct_diff": "ROM Units % Difference",
        "client_dollars_pct_diff": "Client Dollars % Difference",
        "rom_dollars_pct_diff": "ROM Dollars % Difference",
    },
    "back_data": {
        "time_period": "Time Period",
        "condition": "Condition",
        "item_count_flag": "Item Count Flag",
        "index_flag": "Index Flag",
        "focus_dollars_flag": "Focus Dollars Flag",
        "focus_units_flag": "Focus Units Flag",
        "rom_dollars_flag": "ROM Dollars Flag",
        "rom_units_flag": "ROM Units Flag",
        "markets_flag": "Markets Flag",
        "item_count_pct_diff": "Item Count % Difference",
        "index_pct_diff": "Index % Difference",
        "focus_dollars_pct_diff": "Focus Dollar % Difference",
        "focus_units_pct_diff": "Focus Unit % Difference",
        "rom_dollars_pct_diff": "ROM Dollar % Difference",
        "rom_units_pct_diff": "ROM Unit % Difference",
        "markets_pct_diff": "Market % Difference",
        "prior_index": "Prior Index",
        "prior_item_count": "Prior Item Count",
        "prior_focus_dollars": "Prior Focus Dollars",
        "prior_focus_units": "Prior Focus Units",
        "prior_rom_dollars": "Prior ROM Dollars",
        "prior_rom_units": "Prior ROM Units",
        "prior_markets": "Prior Markets",
        "current_index": "Current Index",
        "current_item_count": "Current Item Count",
        "current_focus_dollars": "Current Focus Dollars",
        "current_focus_units": "Current Focus Units",
        "current_rom_dollars": "Current ROM Dollars",
        "current_rom_units": "Current ROM Units",
        "current_markets": "Current Markets",
    },
    "counts": {
        "time_period": "Time_Period",
        "market_count": "Count of Markets",
        "condition_count": "Count of Retail Conditions",
        "row_count": "Total Row Count",
        "item_count": "Distinct Item Count - Total Store",
        "kvi_item_count": "Distinct Item Count - KVI",
        "dollars": "Client Dollars",
        "units": "Client Units",
        "market_dollars": "Market Dollars",
        "market_units": "Market Units",
    },
    "index": {
        "time_period": "Time_Period",
        "condition": "Condition",
        "store_index": "Total Store Index",
        "dollars": "Dollars",
        "units": "Units",
        "market_dollars": "Market Dollars",
        "market_units": "Market Units",
        "kvi_index": "KVI Store Index",
        "kvi_dollars": "KVI Dollars",
        "kvi_units": "KVI Units",
        "kvi_market_dollars": "Market KVI Dollars",
        "kvi_market_units": "Market KVI Units",
        "market_count": "Count of Markets",
        "condition_count": "Count of Retail Conditions",
        "item_count": "Distinct Item Count - Total Store",
        "kvi_item_count": "Distinct Item Count - KVI",
    },
}


def titled(df: DataFrame, report: str, raw: str = "Raw", template: str = "Template") -> DataFrame:
    """Select a report's columns in order and rename them to their titles."""
    return df.select(
        *[
            F.col(name).alias(title.format(raw=raw, template=template))
            for name, title in TITLES[report].items()
        ]
    )
