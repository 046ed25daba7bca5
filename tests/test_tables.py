"""Stored layouts: lookups by either key open few folders; equal buckets join without a shuffle."""

import os
import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from conftest import SF_CHECK, SF_SMALL
from ratewise.operators import evaluation
from ratewise.plans import catalog
from ratewise.schemas import RATING
from ratewise.session import scratch_path
from ratewise.sources import tables
from ratewise.sources import testdata as td
from test_plans import plan


def files(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def read_files(df):
    """Number of files that the executed scan read."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.length()))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_lookup_by_either_key_opens_a_small_share_of_the_files(spark):
    ratings = td.ratings(spark, SF_CHECK)
    path = scratch_path(spark, "t-curve")
    tables.write_curve_layout(ratings, path, ["uid", "mid"], num_partitions=16)
    every = len(files(tables.read_table(spark, path, RATING)))
    assert every >= 200
    for key in ("uid", "mid"):
        value = ratings.agg(F.max(key)).first()[0]
        found = tables.lookup(spark, path, RATING, key, [value])
        assert read_files(found) <= every / 8
        assert rows(found) == rows(ratings.where(F.col(key) == value).select(*RATING.names))
        several = [r[0] for r in ratings.select(key).distinct().orderBy(key).limit(5).collect()] + [-7]
        assert rows(tables.lookup(spark, path, RATING, key, several)) == rows(ratings.where(F.col(key).isin(several)).select(*RATING.names))
    assert rows(tables.read_table(spark, path, RATING)) == rows(ratings.select(*RATING.names))


def test_curve_with_a_hot_key_nulls_and_no_rows(spark):
    schema = RATING.simpleString()[7:-1].replace(":", " ")
    hot = [(7, m, 1.0, m) for m in range(300)] + [(u, 5, 2.0, u) for u in range(300)] + [(None, 1, 3.0, 1), (3, None, 4.0, 2), (7, 5, 1.0, 5)]
    df = spark.createDataFrame(hot, schema)
    path = scratch_path(spark, "t-curve-hot")
    tables.write_curve_layout(df, path, ["uid", "mid"], bits=6, folder_bits=3, num_partitions=8)
    mine = tables.lookup(spark, path, RATING, "uid", [7])
    assert rows(mine) == rows(df.where("uid = 7")) and len(files(mine)) >= 4
    assert rows(tables.lookup(spark, path, RATING, "mid", [5, 299])) == rows(df.where("mid IN (5, 299)"))
    assert tables.read_table(spark, path, RATING).count() == len(hot)
    with pytest.raises(ValueError, match="no curve over score"):
        tables.lookup(spark, path, RATING, "score", [1])
    none = scratch_path(spark, "t-curve-none")
    tables.write_curve_layout(df.limit(0), none, ["uid", "mid"])
    assert tables.lookup(spark, none, RATING, "uid", [7]).count() == 0


def test_places_take_bits_in_turns(spark):
    df = spark.range(64).select((F.col("id") % 8).cast("int").alias("a"), F.floor(F.col("id") / 8).cast("int").alias("b"))
    for r in df.withColumn("z", tables.interleaved([F.col("a"), F.col("b")], 3)).collect():
        want = "".join(x + y for x, y in zip(f"{r.a:03b}", f"{r.b:03b}"))
        assert r.z == int(want, 2)


def test_equal_buckets_join_and_group_without_a_shuffle(spark):
    observed, predicted = catalog.stored_hold_out(spark, SF_SMALL, 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = observed.join(predicted, ["uid", "mid"])
        text = plan(joined.groupBy("uid", "mid").count())
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert len(re.findall(r"Bucketed: true", text)) == 2
        # the one exchange of the whole query moves a partial row per task
        text = plan(evaluation.pair_join_rmse(joined))
        assert len(re.findall(r"\) Exchange\n", text)) == 1 and "SinglePartition" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 << 20))
    stored = catalog.QUERIES["rating_rmse_stored"](spark, SF_SMALL).first()
    assert stored == catalog.QUERIES["rating_rmse"](spark, SF_SMALL).first()


def test_a_user_with_a_third_of_the_rows_is_dealt_over_buckets(spark):
    df = spark.range(3000).selectExpr("CAST(IF(id % 3 = 0, 1, id) AS INT) AS uid", "CAST(id AS INT) AS mid")
    stored = tables.save_bucketed(df, "t_hot", scratch_path(spark, "t-hot"), ["uid", "mid"], 8)
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name().alias("f")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_entry_works_without_a_module_of_the_corpus_operators():
    code = ("import sys; sys.modules['public_tokenizers'] = None\nimport __spark_entry__ as e\n"
            "assert 'realtime_recs' in e.queries() and 'pipeline' not in e.queries() and not e.LLM_SQL")
    done = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.abspath(__spark_entry__.__file__)), capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
