"""Text-line sources and parsers.

All parsers take a DataFrame with one string column ``value`` (the shape of
``spark.read.text``), so batch files, Kafka values and socket lines share one
code path. Parsing is strict whatever the session's ANSI setting: a missing
field or a malformed number raises an error and fails the job, as the
original parsers do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import java_trim

# Fixed values of the input formats.
ITEM_HEADER = "movieId,title,genres"
RATING_HEADER = "userId,movieId,rating,timestamp"
# Item line: id, then a title that may itself hold commas, then the genres
# after the last comma (greedy middle group).
ITEM_LINE_PATTERN = r"(\d+),(.+),(.+)"


def strict_cast(c, to: str, what: str):
    """Cast a string field, failing the job when it is missing or not a valid ``to``."""
    col = F.col(c) if isinstance(c, str) else c
    value = col.try_cast(to)
    return F.when(value.isNull(), F.raise_error(F.concat(
        F.lit(f"bad {what}: "), F.coalesce(col, F.lit("<missing>"))))).otherwise(value).cast(to)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def drop_header(lines: DataFrame, header: str | None = None) -> DataFrame:
    """Remove every line equal to the header (a repeated header goes too).

    When ``header`` is not given, the first line of the input is taken; that
    costs one small job returning a single row.
    """
    if header is None:
        first = lines.first()
        if first is None:
            return lines
        header = first["value"]
    return lines.where(F.col("value") != F.lit(header))


def parse_item_lines(lines: DataFrame, header: str | None = ITEM_HEADER) -> DataFrame:
    """``mid,title,genres`` lines -> (mid int, title, genres); quotes stay in titles."""
    body = drop_header(lines, header)
    # the first group is empty only where the line does not match (it needs a digit)
    g = lambda i: F.regexp_extract("value", ITEM_LINE_PATTERN, i)
    mid = F.when(g(1) == "", F.raise_error(F.concat(F.lit("bad item line: "), F.col("value")))).otherwise(g(1))
    return body.select(
        strict_cast(mid, "int", "item id").alias("mid"),
        java_trim(g(2)).alias("title"),
        java_trim(g(3)).alias("genres"),
    )


def parse_rating_lines(lines: DataFrame, header: str | None = RATING_HEADER) -> DataFrame:
    """``uid,mid,score,timestamp[,...]`` lines -> typed ratings; extra fields ignored."""
    body = drop_header(lines, header)
    parts = F.split("value", ",")
    return body.select(
        strict_cast(F.get(parts, 0), "int", "user id").alias("uid"),
        strict_cast(F.get(parts, 1), "int", "item id").alias("mid"),
        strict_cast(F.get(parts, 2), "double", "score").alias("score"),
        strict_cast(F.get(parts, 3), "int", "timestamp").alias("timestamp"),
    )


def parse_rating_events(lines: DataFrame) -> DataFrame:
    """``UID|MID|SCORE|TIMESTAMP`` lines (stream messages) -> typed events."""
    parts = F.split("value", r"\|")
    return lines.select(
        strict_cast(F.get(parts, 0), "int", "user id").alias("uid"),
        strict_cast(F.get(parts, 1), "int", "item id").alias("mid"),
        strict_cast(F.get(parts, 2), "double", "score").alias("score"),
        strict_cast(F.get(parts, 3), "int", "timestamp").alias("timestamp"),
    )


def parse_recent_lists(lists: DataFrame, key: str = "uid", items: str = "items") -> DataFrame:
    """(uid, items array<'mid:score'>) newest first -> (uid, pos, mid, score).

    ``pos`` is the 0-based list position; both fields are trimmed first.
    """
    exploded = lists.select(F.col(key).alias("uid"), F.posexplode(items).alias("pos", "item"))
    parts = F.split("item", ":")
    return exploded.select(
        "uid",
        F.col("pos").cast("int").alias("pos"),
        strict_cast(java_trim(F.get(parts, 0)), "int", "recent item id").alias("mid"),
        strict_cast(java_trim(F.get(parts, 1)), "double", "recent score").alias("score"),
    )


def kafka_lines(spark: SparkSession, servers: str, topic: str, starting: str = "latest", group: str | None = None,
                max_per_batch: int | None = None) -> DataFrame:
    """Streaming ``value`` lines from a Kafka topic (needs the Kafka connector jar).

    ``group`` names the consumer group; ``max_per_batch`` limits the offsets
    that one micro-batch takes.
    """
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", starting))
    if group:
        reader = reader.option("kafka.group.id", group)
    if max_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", max_per_batch)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def text_stream_lines(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``value`` lines from text files dropped into a folder."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(directory)
