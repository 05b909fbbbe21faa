"""The traffic feed: rule suite and its silver and gold steps."""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata.operators.clean import dedup_full_row, null_policy
from strata.operators.enrich import ratio, stamp, sum_columns
from strata.operators.rules import Between, ColumnSet, MatchesStrftime, NotNull, Suite
from strata.schemas import BATCH_COLUMN, EXTRACT_TIME, LOADING_TIME, TRAFFIC_COLUMNS, TRANSFORMED_TIME

TABLE = "raw_traffic"

# The traffic suite as the source pipeline defines it.  The
# category rule names ``Road_Category_Id`` while the column is spelled
# ``Road_Category_ID``; Spark resolves names case-insensitively and the
# label keeps the rule's spelling.
SUITE = Suite(
    TABLE,
    (
        ColumnSet(tuple([name for name, _ in TRAFFIC_COLUMNS] + [EXTRACT_TIME])),
        NotNull("Record_ID"),
        MatchesStrftime("Count_date", "%m/%d/%Y %H:%M"),
        Between("hour", min_value=1, max_value=24),
        Between("Road_Category_Id", min_value=1, max_value=5),
    ),
)

# The derived columns of the published silver and gold schemas.
EV_COUNT = "Electrics_Vehicles_Count"
MOTOR_COUNT = "Motor_Vehicles_Count"
INTENSITY = "Vehicle_Indensity"  # spelling of the published gold schema

# The motor-vehicle classes summed into the motor count
# (pedal cycles are not motor vehicles).
MOTOR_CLASSES = ("Two_wheeled_motor_vehicles", "Cars_and_taxis", "Buses_and_coaches", "LGV_Type", "HGV_Type")


def ev_count(df: DataFrame) -> DataFrame:
    return sum_columns(df, EV_COUNT, ["EV_Car", "EV_Bike"])


def motor_count(df: DataFrame) -> DataFrame:
    return sum_columns(df, MOTOR_COUNT, [*MOTOR_CLASSES, EV_COUNT])


def vehicle_intensity(df: DataFrame) -> DataFrame:
    return ratio(df, INTENSITY, MOTOR_COUNT, "Link_length_km")


def silver(bronze: DataFrame, dedup: bool = True) -> DataFrame:
    """dedup (payload) -> null policy -> EV count -> motor count -> stamp."""
    df = dedup_full_row(bronze) if dedup else bronze
    df = null_policy(df)
    df = motor_count(ev_count(df))
    return stamp(df, TRANSFORMED_TIME)


def silver_stream_step(bronze: DataFrame) -> DataFrame:
    """The stateless part of ``silver`` (streams dedup separately, with state);
    the batch label belongs to bronze only."""
    return stamp(motor_count(ev_count(null_policy(bronze.drop(BATCH_COLUMN)))), TRANSFORMED_TIME)


def gold(silver_df: DataFrame) -> DataFrame:
    """intensity -> load stamp."""
    return stamp(vehicle_intensity(silver_df), LOADING_TIME)
