"""Session variables bound from a scalar subquery (P18): ``set x = (select ...)`` then ``$x``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def set_variable(spark: SparkSession, name: str, sql_type: str, subquery: str, **frames) -> None:
    """``DECLARE OR REPLACE VARIABLE name type; SET VAR name = (subquery)``.

    The subquery must return one row and one column; it runs once, as
    one Spark job, and the value is then a constant in later plans.
    """
    spark.sql(f"DECLARE OR REPLACE VARIABLE {name} {sql_type}")
    spark.sql(f"SET VAR {name} = ({subquery})", **frames)


def select_with_variable(spark: SparkSession, trips: DataFrame) -> DataFrame:
    """The trips that started at the latest start time, found through a session variable."""
    var = f"latest_start_{uuid.uuid4().hex[:8]}"
    set_variable(spark, var, "TIMESTAMP_NTZ", "SELECT max(starttime) FROM {t}", t=trips)
    return spark.sql(f"SELECT bikeid, starttime, usertype FROM {{t}} WHERE starttime = {var}", t=trips)
