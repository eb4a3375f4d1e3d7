"""The scalar functions under SQL names, for users who write SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

SQL_FUNCTIONS = {
    "haversine_distance": """
        CREATE OR REPLACE TEMPORARY FUNCTION haversine_distance(
            lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE
        RETURN 2 * 6371 * asin(sqrt(least(1.0D,
            power(sin(radians(lat2 - lat1) / 2), 2)
            + cos(radians(lat1)) * cos(radians(lat2)) * power(sin(radians(lon2 - lon1) / 2), 2))))
    """,
    "password_check": """
        CREATE OR REPLACE TEMPORARY FUNCTION password_check(word STRING) RETURNS BOOLEAN
        RETURN coalesce(length(word) >= 8 AND word RLIKE '[0-9]' AND word RLIKE '[A-Z]'
            AND word RLIKE '[a-z]', false)
    """,
    "surrogate_key": """
        CREATE OR REPLACE TEMPORARY FUNCTION surrogate_key(natural_key STRING) RETURNS STRING
        RETURN md5(coalesce(natural_key, '_dbt_utils_surrogate_key_null_'))
    """,
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the functions in the session; they are inlined into the plan by Catalyst."""
    for statement in SQL_FUNCTIONS.values():
        spark.sql(statement)
    return sorted(SQL_FUNCTIONS)
