"""The date function and the rating views under their SQL names, for statements written as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: yyyyMM (UTC) of epoch seconds; a SQL function, which Catalyst inlines as built-in expressions.
CHANGE_DATE = """CREATE OR REPLACE TEMPORARY FUNCTION changeDate(x BIGINT) RETURNS INT
RETURN CAST(date_format(date_from_unix_date(CAST(floor(x / 86400) AS INT)), 'yyyyMM') AS INT)"""


def register(spark: SparkSession, ratings: DataFrame) -> None:
    """Define ``changeDate`` and the views ``ratings`` and ``ratingOfMonth`` in the session."""
    spark.sql(CHANGE_DATE)
    ratings.createOrReplaceTempView("ratings")
    spark.sql("SELECT mid, score, changeDate(timestamp) AS yearmonth FROM ratings").createOrReplaceTempView("ratingOfMonth")
