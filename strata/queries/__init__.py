"""Registry of the queries (Spark) and their DuckDB oracle SQL."""

from strata.queries.oracle import ORACLE
from strata.queries.spark_side import QUERIES

__all__ = ["ORACLE", "QUERIES"]
