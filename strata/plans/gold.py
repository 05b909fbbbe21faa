"""Gold reports: traffic joined with roads, regional summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.joins import join_aggregated
from strata.plans.traffic import INTENSITY, MOTOR_COUNT

TRAFFIC_KEYS = ("Region_id", "Road_Category_ID")
ROADS_KEYS = ("Region_ID", "Road_Category_Id")


# Statistics of one (region, category) over its roads: name and SQL.
ROAD_STATISTICS = (
    ("n_roads", "count(1)"),
    ("road_link_km_avg", "avg(Total_Link_Length_Km)"),
    ("road_link_km_sum", "sum(Total_Link_Length_Km)"),
    ("road_vehicles_sum", "sum(All_Motor_Vehicles)"),
)


def traffic_roads_join(gold_traffic: DataFrame, silver_roads: DataFrame) -> DataFrame:
    """Every traffic row with the road statistics of its (region, category).

    (region, category) is not a key of the roads data -- several roads
    share it -- so the roads side is aggregated to one row per key before
    the join; a raw join would multiply each traffic row.
    """
    aggs = [F.expr(sql).alias(name) for name, sql in ROAD_STATISTICS]
    return join_aggregated(gold_traffic, silver_roads, TRAFFIC_KEYS, ROADS_KEYS, aggs, how="left")


def traffic_roads_sql(gold_traffic: str, silver_roads: str) -> str:
    """The same join over two catalog tables, as the text of a view: it always
    shows the roads known now, whatever order the feeds arrived in."""
    keys = ", ".join(ROADS_KEYS)
    stats = ", ".join(f"{sql} AS {name}" for name, sql in ROAD_STATISTICS)
    on = " AND ".join(f"t.{a} = r.{b}" for a, b in zip(TRAFFIC_KEYS, ROADS_KEYS))
    names = ", ".join(f"r.{name}" for name, _ in ROAD_STATISTICS)
    return f"SELECT t.*, {names} FROM {gold_traffic} t LEFT JOIN (SELECT {keys}, {stats} FROM {silver_roads} GROUP BY {keys}) r ON {on}"


def region_summary(gold_traffic: DataFrame, keys: Sequence[str] = TRAFFIC_KEYS) -> DataFrame:
    """Counts, totals and mean intensity per key (partial + final aggregate)."""
    return gold_traffic.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_records"),
        F.sum(F.col(MOTOR_COUNT).cast("long")).alias("total_motor_vehicles"),
        F.round(F.avg(INTENSITY), 6).alias("avg_intensity"),
        F.round(F.sum("Link_length_km"), 4).alias("total_link_km"),
    )


def region_states(gold_traffic: DataFrame, keys: Sequence[str] = TRAFFIC_KEYS) -> DataFrame:
    """One batch's part of :func:`region_summary`: counts and sums that can be added."""
    return gold_traffic.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_records"),
        F.sum(F.col(MOTOR_COUNT).cast("long")).alias("motor_vehicles"),
        F.count(INTENSITY).alias("n_intensity"),
        F.sum(INTENSITY).alias("intensity"),
        F.sum("Link_length_km").alias("link_km"),
    )


def combine_region_states(states: DataFrame, keys: Sequence[str] = TRAFFIC_KEYS) -> DataFrame:
    """The summary of all batches from their states."""
    return states.groupBy(*keys).agg(
        F.sum("n_records").alias("n_records"),
        F.sum("motor_vehicles").alias("total_motor_vehicles"),
        F.round(F.try_divide(F.sum("intensity"), F.sum("n_intensity")), 6).alias("avg_intensity"),
        F.round(F.sum("link_km"), 4).alias("total_link_km"),
    )
