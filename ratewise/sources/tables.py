"""Typed table reads and writes (the persistent tables of the data model).

Format is a parameter (parquet by default); any DataFrame source that Spark
can load by path works the same way.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folder column of a bucketed lookup layout.
BUCKET = "key_bucket"
#: Folder column of a curve layout, and the side table of its cuts (readers skip names with an underscore).
CELL, CUTS = "curve_cell", "_cuts"
#: Bits of each key's position on the curve, and how many of them name the folder: 2 keys x 4 bits are 256 folders.
CURVE_BITS, FOLDER_BITS = 10, 4


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket that holds a key's rows."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Read a stored table; with a schema, no inference and fixed column order."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    if schema is not None:
        df = df.select(*[f.name for f in schema.fields])
    return df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Overwrite (drop-then-load) a stored table."""
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_lookup_layout(df: DataFrame, path: str, key: str, tiebreak: list[str] | None = None,
                        num_partitions: int | None = None, fmt: str = "parquet",
                        max_records_per_file: int = 5_000_000, bloom_columns: list[str] | None = None,
                        buckets: int | None = None, mode: str = "overwrite") -> None:
    """Write so that point/range lookups on ``key`` read few files and row groups.

    Range partitioning puts each key range in its own files; sorting inside
    them keeps row-group min/max statistics tight, so a ``key = v`` filter is
    pushed to the scan and skips everything else. The range bounds include
    the ``tiebreak`` columns, so one key holding a large share of the rows is
    cut across several tasks instead of landing in one. Without an explicit
    count, the shuffle partition count applies and AQE coalesces small ranges.

    A file has one sort order; further lookup keys (``bloom_columns``) get
    parquet bloom filters, so equality lookups on them skip row groups too.
    (A column chunk that is fully dictionary-encoded gets no bloom filter:
    its dictionary already answers equality filters.) With ``buckets``, rows
    lie in folders by a hash of the key (column ``BUCKET``), so a reader that
    looks up some keys lists only their folders.
    """
    cols = [key] + list(tiebreak or [])
    if buckets:
        df, cols = df.withColumn(BUCKET, bucket_of(key, buckets)), [BUCKET, *cols]
    ranged = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    writer = (ranged.sortWithinPartitions(*cols)
              .write.format(fmt).mode(mode).option("maxRecordsPerFile", max_records_per_file))
    if buckets:
        writer = writer.partitionBy(BUCKET)
    if fmt == "parquet":
        for c in bloom_columns or []:
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.save(path)


def position(key: Column, cuts: Column, bits: int = CURVE_BITS) -> Column:
    """How many of the sorted ``cuts`` are at or below the key (null: 0), found bit by bit; below 2 ** bits."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get(cuts, n + step - 1) <= key, n + step).otherwise(n))


def interleaved(positions: Sequence[Column], bits: int = CURVE_BITS) -> Column:
    """Place on the Z-order curve: the positions' bits taken in turns, highest first."""
    n = len(positions)
    spread = [F.shiftleft(F.shiftright(p, i).bitwiseAND(F.lit(1)).cast("long"), i * n + n - 1 - j)
              for j, p in enumerate(positions) for i in range(bits)]
    place = spread[0]
    for s in spread[1:]:
        place = place.bitwiseOR(s)
    return place


def write_curve_layout(df: DataFrame, path: str, keys: Sequence[str], bits: int = CURVE_BITS, folder_bits: int = FOLDER_BITS,
                       num_partitions: int | None = None, max_records_per_file: int = 5_000_000) -> None:
    """Write so that a lookup by *any* of the integral ``keys`` opens few folders.

    Each key's position among its own quantiles (2 ** bits - 1 cuts, kept beside the table) goes into a place on a
    Z-order curve. The first ``folder_bits`` bits of each key's position name the row's folder, so a lookup by one of
    k keys opens about one of 2 ** folder_bits folders; within them rows follow the curve, so that row groups have
    narrow ranges of every key. Rows are range-partitioned by place and then by the keys: a key that holds a large share of
    the rows is cut across tasks along the other keys. Null keys lie below the first cut.
    """
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(F.col(k).cast("long"), shares, 20 << bits).alias(k) for k in keys])
    cuts = [(k, sorted(found.first()[k] or []), bits, folder_bits, j, len(keys)) for j, k in enumerate(keys)]  # 2 ** bits values a key
    place = interleaved([position(F.col(k).cast("long"), F.lit(c) if c else F.array().cast("array<long>"), bits) for k, c, *_ in cuts], bits)
    rows = df.withColumn("_place", place).withColumn(CELL, F.shiftright("_place", (bits - folder_bits) * len(keys)).cast("int"))
    order = [CELL, "_place", *keys]
    ranged = rows.repartitionByRange(num_partitions, *order) if num_partitions else rows.repartitionByRange(*order)
    (ranged.sortWithinPartitions(*order).drop("_place").write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(CELL).parquet(path))
    side = "key string, cuts array<long>, bits int, folder_bits int, turn int, keys int"
    df.sparkSession.createDataFrame(cuts, side).coalesce(1).write.mode("overwrite").parquet(f"{path}/{CUTS}")


def lookup(spark: SparkSession, path: str, schema: T.StructType, key: str, values: Sequence[int]) -> DataFrame:
    """Rows of a curve layout whose ``key`` is one of ``values``: only the folders they can lie in are opened."""
    side = spark.read.parquet(f"{path}/{CUTS}").where(F.col("key") == key).first()
    if side is None:
        raise ValueError(f"{path} has no curve over {key}")
    drop = side["bits"] - side["folder_bits"]
    folders = sorted({sum(c <= v for c in side["cuts"]) >> drop for v in values})
    own = F.lit(0)
    for i in range(side["folder_bits"]):
        bit = F.shiftright(CELL, i * side["keys"] + side["keys"] - 1 - side["turn"]).bitwiseAND(F.lit(1))
        own = own.bitwiseOR(F.shiftleft(bit, i))
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(CELL, T.IntegerType())])).parquet(path)
    return rows.where(own.isin(folders) & F.col(key).isin(list(values))).select(*schema.names)


def save_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Save as a catalogue table with a file per bucket of ``keys``, sorted by them, and read it back.

    Tables with the same keys and number of buckets join and group by the keys without a shuffle. ``name`` gets a
    unique ending, as other readers may still hold an older table. All keys together choose the bucket, so rate
    tables by (uid, mid): a user with a third of all rows is dealt over all buckets.
    """
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, *keys).write.bucketBy(buckets, keys[0], *keys[1:]).sortBy(keys[0], *keys[1:])
     .option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)
