import math

from pyspark.sql import functions as F

from ratewise.functions.nested import decode_recs, encode_recs, recs_to_map
from ratewise.functions.scalar import (epoch_micros_ntz, epoch_seconds_ntz, java_trim, log10_at_least_one,
                                       split_pipe_list, year_month_of_epoch)
from ratewise.functions.vectors import cosine, dot, l2_norm


def one(spark, expr, value, ddl):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


def test_split_pipe_list_like_jvm_split(spark):
    cases = {"a|b||": ["a", "b"], "a||b": ["a", "", "b"], "": [""], "||": [], "|a": ["", "a"],
             "Comedy|Drama|Romance": ["Comedy", "Drama", "Romance"]}
    for s, expected in cases.items():
        assert one(spark, split_pipe_list("v"), s, "v string") == expected, s


def test_java_trim_strips_control_chars(spark):
    assert one(spark, java_trim("v"), "\t\x01 title \n\x1f", "v string") == "title"
    assert one(spark, java_trim("v"), "a b", "v string") == "a b"


def test_year_month_is_utc_and_zone_independent(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert one(spark, year_month_of_epoch("v"), 1260759144, "v int") == 200912
            # one second before a UTC month boundary
            assert one(spark, year_month_of_epoch("v"), 1262303999, "v int") == 200912
            assert one(spark, year_month_of_epoch("v"), 1262304000, "v int") == 201001
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_epoch_of_wall_clock_ignores_session_zone(spark):
    import datetime as dt
    old = spark.conf.get("spark.sql.session.timeZone")
    cases = ["2009-12-14 02:52:24", "2000-07-01 00:00:00.250001", "1969-12-31 23:59:59"]
    try:
        for zone in ("UTC", "America/Los_Angeles", "Europe/Berlin"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([(v,) for v in cases], "v string").select(
                "v", epoch_seconds_ntz(F.col("v").cast("timestamp_ntz")).alias("s"),
                epoch_micros_ntz(F.col("v").cast("timestamp_ntz")).alias("us"))
            for r in df.collect():
                t = dt.datetime.fromisoformat(r["v"]).replace(tzinfo=dt.timezone.utc)
                us = int((t - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) / dt.timedelta(microseconds=1))
                assert r["us"] == us, (zone, r)
                assert r["s"] == us // 1_000_000, (zone, r)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_log10_at_least_one(spark):
    for n, expected in [(0, 0.0), (1, 0.0), (10, 1.0), (8, math.log(8) / math.log(10))]:
        assert one(spark, log10_at_least_one("v"), n, "v long") == expected  # bit-exact ln/ln


def test_vector_expressions(spark):
    df = spark.createDataFrame([([1.0, 2.0, 2.0], [2.0, 0.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])],
                               "a array<double>, b array<double>")
    rows = df.select(dot("a", "b").alias("d"), l2_norm("a").alias("n"), cosine("a", "b").alias("c")).collect()
    assert rows[0]["d"] == 4.0 and rows[0]["n"] == 3.0
    assert abs(rows[0]["c"] - 4.0 / (3.0 * math.sqrt(5.0))) < 1e-15
    assert rows[1]["c"] is None  # zero vector: no cosine


def test_nested_roundtrip_sorted_by_score_then_mid(spark):
    flat = spark.createDataFrame([(1, 10, 2.0), (1, 11, 3.0), (1, 9, 2.0), (2, 5, 1.0)],
                                 "uid int, mid int, score double")
    nested = encode_recs(flat, "uid")
    recs = {r["uid"]: [(x["mid"], x["score"]) for x in r["recs"]] for r in nested.collect()}
    assert recs[1] == [(11, 3.0), (9, 2.0), (10, 2.0)]
    back = decode_recs(nested, "uid", mid_name="mid").where("uid = 1").orderBy("rank").collect()
    assert [(r["rank"], r["mid"]) for r in back] == [(1, 11), (2, 9), (3, 10)]
    m = nested.where("uid = 1").select(recs_to_map("recs").alias("m")).first()["m"]
    assert m == {11: 3.0, 9: 2.0, 10: 2.0}


def test_change_date_in_sql_is_inlined_and_equals_the_column_form(spark):
    from ratewise.functions import scalar, sql
    rows = [(1, 2, 3.0, t) for t in (0, 86399, 951782400, 1260759144, 2147483647, -1, -86401)] + [(1, 2, None, None)]
    df = spark.createDataFrame(rows, "uid int, mid int, score double, timestamp int")
    sql.register(spark, df)
    got = spark.sql("SELECT changeDate(timestamp) AS d, timestamp FROM ratings")
    assert {(r["timestamp"], r["d"]) for r in got.collect()} == {
        (r["timestamp"], r["d"]) for r in df.select("timestamp", scalar.year_month_of_epoch("timestamp").alias("d")).collect()}
    plan = spark.sql("SELECT mid, yearmonth, count(*) FROM ratingOfMonth GROUP BY ALL")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "partial_count" in plan
