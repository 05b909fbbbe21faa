"""The roads feed: rule suite and its silver and gold steps."""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata.operators.clean import dedup_full_row, null_policy
from strata.operators.enrich import classify_contains, map_codes
from strata.operators.rules import Between, ColumnSet, NotNull, Suite
from strata.schemas import BATCH_COLUMN, ROADS_COLUMNS

TABLE = "raw_roads"

# The roads suite as the source pipeline defines it.
SUITE = Suite(
    TABLE,
    (
        ColumnSet(tuple(name for name, _ in ROADS_COLUMNS)),
        NotNull("Road_ID"),
        Between("Total_Link_Length_Km", min_value=0),
        Between("Road_Category_Id", min_value=1, max_value=5),
    ),
)

# Road category code -> name, and name substring -> road type.
CATEGORY_NAMES = {
    "TA": "Class A Trunk Road",
    "TM": "Class A Trunk Motor",
    "PA": "Class A Principal Road",
    "PM": "Class A Principal Motorway",
    "M": "Class B Road",
}
ROAD_TYPES = (("Class A", "Major"), ("Class B", "Minor"))


def category_name(df: DataFrame) -> DataFrame:
    return map_codes(df, "Road_Category", "Road_Category_Name", CATEGORY_NAMES, default="NA")


def road_type(df: DataFrame) -> DataFrame:
    return classify_contains(df, "Road_Category_Name", "Road_Type", ROAD_TYPES, default="NA")


def silver(bronze: DataFrame, dedup: bool = True) -> DataFrame:
    """dedup (payload) -> null policy -> category name -> road type."""
    df = dedup_full_row(bronze) if dedup else bronze
    return road_type(category_name(null_policy(df)))


def silver_stream_step(bronze: DataFrame) -> DataFrame:
    return road_type(category_name(null_policy(bronze.drop(BATCH_COLUMN))))


def gold(silver_df: DataFrame) -> DataFrame:
    """Gold roads is silver roads as is."""
    return silver_df
