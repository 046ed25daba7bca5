"""Declared table schemas (the data model of the engine)."""

from pyspark.sql import types as T

MOVIE = T.StructType([
    T.StructField("mid", T.IntegerType(), False),
    T.StructField("title", T.StringType(), True),
    T.StructField("genres", T.StringType(), True),
])

RATING = T.StructType([
    T.StructField("uid", T.IntegerType(), False),
    T.StructField("mid", T.IntegerType(), False),
    T.StructField("score", T.DoubleType(), False),
    T.StructField("timestamp", T.IntegerType(), False),
])

RECOMMENDATION = T.StructType([
    T.StructField("mid", T.IntegerType(), False),
    T.StructField("score", T.DoubleType(), False),
])

RECS = T.ArrayType(RECOMMENDATION, False)

# Flat similarity lists as stored by the offline job (MovieRecs).
ITEM_EDGES = T.StructType([
    T.StructField("mid", T.IntegerType(), False),
    T.StructField("rank", T.IntegerType(), False),
    T.StructField("sim_mid", T.IntegerType(), False),
    T.StructField("score", T.DoubleType(), False),
])
