"""Schemas of the traffic and roads feeds and of the quarantine table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Column names, order and types of the two landing feeds and of
# the quarantine table, as the source pipeline defines them.
TRAFFIC_COLUMNS = [
    ("Record_ID", IntegerType()),
    ("Count_point_id", IntegerType()),
    ("Direction_of_travel", StringType()),
    ("Year", IntegerType()),
    ("Count_date", StringType()),
    ("hour", IntegerType()),
    ("Region_id", IntegerType()),
    ("Region_name", StringType()),
    ("Local_authority_name", StringType()),
    ("Road_name", StringType()),
    ("Road_Category_ID", IntegerType()),
    ("Start_junction_road_name", StringType()),
    ("End_junction_road_name", StringType()),
    ("Latitude", DoubleType()),
    ("Longitude", DoubleType()),
    ("Link_length_km", DoubleType()),
    ("Pedal_cycles", IntegerType()),
    ("Two_wheeled_motor_vehicles", IntegerType()),
    ("Cars_and_taxis", IntegerType()),
    ("Buses_and_coaches", IntegerType()),
    ("LGV_Type", IntegerType()),
    ("HGV_Type", IntegerType()),
    ("EV_Car", IntegerType()),
    ("EV_Bike", IntegerType()),
]

ROADS_COLUMNS = [
    ("Road_ID", IntegerType()),
    ("Road_Category_Id", IntegerType()),
    ("Road_Category", StringType()),
    ("Region_ID", IntegerType()),
    ("Region_Name", StringType()),
    ("Total_Link_Length_Km", DoubleType()),
    ("Total_Link_Length_Miles", DoubleType()),
    ("All_Motor_Vehicles", DoubleType()),
]

QUARANTINE_COLUMNS = [
    ("table_name", StringType()),
    ("gx_batch_id", StringType()),
    ("violated_rules", StringType()),
    ("raw_data", StringType()),
    ("ingestion_time", TimestampType()),
]

# Audit columns added by the layers; they differ per run, so they never take
# part in duplicate detection.
EXTRACT_TIME = "Extract_Time"
TRANSFORMED_TIME = "Transformed_Time"
LOADING_TIME = "Loading_Time"
BATCH_COLUMN = "_batch_id"
AUDIT_COLUMNS = (EXTRACT_TIME, TRANSFORMED_TIME, LOADING_TIME, BATCH_COLUMN)


def _struct(cols) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in cols])


TRAFFIC_SCHEMA = _struct(TRAFFIC_COLUMNS)
ROADS_SCHEMA = _struct(ROADS_COLUMNS)
QUARANTINE_SCHEMA = _struct(QUARANTINE_COLUMNS)
# Bronze traffic carries the ingest audit column; it is also the schema used to
# parse quarantined ``raw_data`` back into rows.
TRAFFIC_BRONZE_SCHEMA = _struct(TRAFFIC_COLUMNS + [(EXTRACT_TIME, TimestampType())])
ROADS_BRONZE_SCHEMA = ROADS_SCHEMA


def with_corrupt_record(schema: StructType, column: str = "_corrupt_record") -> StructType:
    """Schema plus a string column that receives unparsable CSV lines."""
    return StructType(list(schema.fields) + [StructField(column, StringType(), True)])


# The comments of the quarantine columns.
QUARANTINE_COMMENTS = {
    "table_name": "Table the rows were meant for",
    "gx_batch_id": "Batch that delivered the rows",
    "violated_rules": "Labels of the broken rules, joined with semicolons",
    "raw_data": "The row as JSON",
    "ingestion_time": "When the row was quarantined",
}


def ddl(schema: StructType, varchar: int | None = None, comments: Mapping[str, str] | None = None) -> str:
    """Column list for ``CREATE TABLE``; strings become ``VARCHAR(n)`` if asked."""
    parts = []
    for field in schema.fields:
        type_sql = field.dataType.simpleString().upper()
        if varchar and isinstance(field.dataType, StringType):
            type_sql = f"VARCHAR({varchar})"
        note = (comments or {}).get(field.name)
        parts.append(f"`{field.name}` {type_sql}" + (f" COMMENT '{note}'" if note else ""))
    return ", ".join(parts)
