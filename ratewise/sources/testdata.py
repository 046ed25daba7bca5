"""Views of the driver's parquet tables in the engine's data model.

The benchmark tables are TPC-H-like; this module derives the rating model
from them with projections and one equi-join, so Catalyst prunes columns and
pushes filters into the parquet scans:

* ratings(uid, mid, score, timestamp)  lineitem JOIN orders
* items(mid, title, genres)            part
* item_factors / user_factors          embeddings, whole vectors
* rating_events(event_id, uid, mid, score, ts, event_type)  events
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import epoch_seconds_ntz, half_star
from ..functions.vectors import to_double_array


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # Both sides grow with the data: a shuffled equi-join on the order key.
    joined = li.join(od, li.l_orderkey == od.o_orderkey)
    return joined.select(
        F.col("o_custkey").cast("int").alias("uid"),
        F.col("l_partkey").cast("int").alias("mid"),
        (F.ceil(F.col("l_quantity") / 5) / 2).cast("double").alias("score"),
        epoch_seconds_ntz("o_orderdate").cast("int").alias("timestamp"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    words = F.split(F.col("p_name"), " ")
    return part.select(
        F.col("p_partkey").cast("int").alias("mid"),
        F.col("p_name").alias("title"),
        F.concat_ws("|", F.col("p_type"), F.get(words, 0), F.get(words, 1)).alias("genres"),
    )


def _factors(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").cast("int").alias(name), to_double_array("embedding").alias("features"))


def item_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(mid, features array<double>)"""
    return _factors(spark, sf_dir, "mid")


def user_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uid, features array<double>)"""
    return _factors(spark, sf_dir, "uid")


def rating_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return events_to_ratings(ev)


def events_to_ratings(ev: DataFrame) -> DataFrame:
    """events -> (event_id, uid, mid, score, ts, timestamp, event_type); works on streams too."""
    return ev.select(
        F.col("event_id"),
        F.col("user_id").cast("int").alias("uid"),
        F.get_json_object("props", "$.k").cast("int").alias("mid"),
        half_star(F.ceil(F.col("value") / 10) / 2).alias("score"),
        F.col("ts"),
        epoch_seconds_ntz("ts").cast("int").alias("timestamp"),
        F.col("event_type"),
    )


# Roles of the events in realtime scoring (fixed mapping of the test data).
TRIGGER_EVENT = "click"
SEEN_EVENT = "purchase"


def seen_items(events: DataFrame) -> DataFrame:
    """(uid, mid) pairs a user has already rated -- here: purchased."""
    return events.where(F.col("event_type") == SEEN_EVENT).select("uid", "mid").distinct()


def trigger_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == TRIGGER_EVENT)
