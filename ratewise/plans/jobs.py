"""End-to-end jobs writing the named tables of a rating recommender.

All tables live under one base path (any Hadoop-compatible URI):

========================  ============================================  ==========
table                     columns                                        written by
========================  ============================================  ==========
Movie                     mid, title, genres                             load
Rating                    uid, mid, score, timestamp                     load
RateMoreMovies            rank, mid, count (count desc)                 statistics
RateMoreRecentlyMovies    rank, mid, count, yearmonth (both desc)       statistics
AverageMovies             rank, mid, avg (avg desc)                     statistics
GenresTopMovies           genres, recs array<struct<mid, score>>         statistics
UserRecs                  uid, recs                                      offline
MovieRecs                 mid, rank, sim_mid, score (flat edges)         offline
ALSTuning                 rank, lambda, rmse                             tuning
StreamRecs                upsert log of uid, recs                        streaming
========================  ============================================  ==========

MovieRecs is stored flat (one row per edge, ranked per item) rather than as
one nested list per item: an item's list has no upper bound, and the
streaming job consumes edges anyway. ``nested.encode_recs`` produces the
nested form for a bounded ``k`` when wanted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.nested import encode_recs
from ..operators import als, realtime, similarity, stats
from ..operators.ranking import global_rank
from ..schemas import ITEM_EDGES, MOVIE, RATING
from ..session import materialize
from ..sources import tables, text
from ..sources.sinks import UpsertLog
from ..streaming import profile_state, realtime_stream

# Fixed output names: users find the tables under these.
MOVIE_T, RATING_T = "Movie", "Rating"
RATE_MORE, RATE_MORE_RECENT, AVERAGE, GENRES_TOP = (
    "RateMoreMovies", "RateMoreRecentlyMovies", "AverageMovies", "GenresTopMovies")
# Folders that Rating is cut into by a hash of the user.
RATING_BUCKETS = 64
USER_RECS, MOVIE_RECS, TUNING, STREAM_RECS = "UserRecs", "MovieRecs", "ALSTuning", "StreamRecs"


def path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def read(spark: SparkSession, base: str, name: str, schema=None) -> DataFrame:
    return tables.read_table(spark, path(base, name), schema)


# -- load -------------------------------------------------------------------

def load_job(spark: SparkSession, movies_path: str, ratings_path: str, base: str) -> None:
    """Parse the two CSV feeds (header = their first line) and store Movie and Rating."""
    items = text.parse_item_lines(text.read_lines(spark, movies_path), header=None)
    ratings = text.parse_rating_lines(text.read_lines(spark, ratings_path), header=None)
    tables.write_lookup_layout(items, path(base, MOVIE_T), "mid")
    # in folders by a hash of the user, sorted by uid; bloom filters serve lookups by mid
    tables.write_lookup_layout(ratings, path(base, RATING_T), "uid", tiebreak=["mid", "timestamp"],
                               bloom_columns=["mid"], buckets=RATING_BUCKETS)


def append_ratings(ratings: DataFrame, base: str) -> None:
    """Add rows to Rating in its layout."""
    tables.write_lookup_layout(ratings.select(*RATING.names), path(base, RATING_T), "uid", tiebreak=["mid", "timestamp"],
                               bloom_columns=["mid"], buckets=RATING_BUCKETS, mode="append")


# -- statistics -------------------------------------------------------------

def statistics_job(spark: SparkSession, base: str, k: int = stats.GENRE_TOP_K) -> None:
    """All statistics from one scan of Rating; the ordered tables carry their order as ``rank``."""
    items = read(spark, base, MOVIE_T, MOVIE)
    totals = materialize(stats.monthly_totals(read(spark, base, RATING_T, RATING)))
    popular = global_rank(stats.popularity_of_totals(totals), [F.desc("count"), F.asc("mid")])
    tables.write_table(popular, path(base, RATE_MORE))
    monthly = global_rank(totals.select("mid", "count", "yearmonth"), [F.desc("yearmonth"), F.desc("count"), F.asc("mid")])
    tables.write_table(monthly, path(base, RATE_MORE_RECENT))
    averages = stats.average_of_totals(totals)
    tables.write_table(global_rank(averages, [F.desc("avg"), F.asc("mid")]), path(base, AVERAGE))
    top = stats.genre_top_of_averages(items, averages, k)
    nested = encode_recs(top.select(F.col("genre").alias("genres"), "mid", F.col("avg").alias("score")), "genres")
    tables.write_table(nested, path(base, GENRES_TOP))


# -- offline ----------------------------------------------------------------

def offline_job(spark: SparkSession, base: str, rank: int = als.REFERENCE_RANK,
                max_iter: int = als.REFERENCE_ITERATIONS, reg: float = als.REFERENCE_LAMBDA,
                seed: int = 42, k: int = 20, threshold: float = similarity.SIMILARITY_THRESHOLD,
                sims_k: int | None = None) -> None:
    ratings = read(spark, base, RATING_T, RATING)
    model = als.fit(ratings, rank, max_iter, reg, seed)
    recs = als.user_recs(model, k)
    tables.write_table(encode_recs(recs.select("uid", "mid", "score"), "uid"), path(base, USER_RECS))
    sims = similarity.item_similarity(als.item_factors(model), threshold=threshold, k=sims_k)
    tables.write_lookup_layout(sims, path(base, MOVIE_RECS), "mid", tiebreak=["rank"])


def tuning_job(spark: SparkSession, base: str, ranks=als.REFERENCE_GRID_RANKS,
               lambdas=als.REFERENCE_GRID_LAMBDAS, max_iter: int = als.REFERENCE_ITERATIONS,
               seed: int = 42) -> DataFrame:
    """Fit the grid, store every point, return the best (rank, lambda, rmse)."""
    from ..operators.evaluation import best_params
    ratings = read(spark, base, RATING_T, RATING)
    grid = als.grid_search(ratings, ranks, lambdas, max_iter, seed)
    tables.write_table(grid, path(base, TUNING))
    return best_params(read(spark, base, TUNING))


# -- streaming --------------------------------------------------------------

def recent_from_ratings(ratings: DataFrame, k: int = realtime.RECENT_K) -> DataFrame:
    """(uid, pos, mid, score): each user's k newest stored ratings (timestamp, then mid, desc)."""
    ev = ratings.select("uid", "mid", "score", F.col("timestamp").alias("ts"), F.col("mid").alias("event_id"))
    return realtime.recent_ratings(ev, k)


def user_tables(spark: SparkSession, base: str, newest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(recent, seen) of the batch's users from Rating as it is now.

    Rating lies in folders by a hash of the user. Only the folders of the
    batch's users are listed and read, whatever the number of users (at most
    RATING_BUCKETS values are collected), and only those users' rows go on.
    """
    buckets = [r[0] for r in newest.select(tables.bucket_of("uid", RATING_BUCKETS)).distinct().collect()]
    stored = spark.read.parquet(path(base, RATING_T)).where(F.col(tables.BUCKET).isin(buckets))
    mine = stored.select(*RATING.names).join(newest.select("uid").distinct(), "uid", "left_semi")
    return recent_from_ratings(mine), mine.select("uid", "mid")


def streaming_job(spark: SparkSession, base: str, lines: DataFrame, checkpoint: str,
                  recent: Callable[[], DataFrame] | None = None, trigger: dict | None = None,
                  n: int = realtime.CANDIDATES_N, threshold: float = realtime.PAIR_THRESHOLD,
                  compact_every: int = realtime_stream.COMPACT_EVERY) -> StreamingQuery:
    """Score a stream of rating lines into StreamRecs.

    Ratings are read anew for every micro-batch, so rows that were added or
    rewritten since the last one count. ``recent`` may give other (uid, pos,
    mid, score) lists -- e.g. parsed recent lists or the output of
    ``streaming.recent_state`` -- and is called for every micro-batch too. The
    similarity lists are read once.
    """
    edges = read(spark, base, MOVIE_RECS, ITEM_EDGES).select("mid", "rank", "sim_mid", "score").persist(StorageLevel.MEMORY_AND_DISK)

    def tables_now(newest: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        latest, seen = user_tables(spark, base, newest)
        return (recent() if recent else latest), edges, seen

    events = text.parse_rating_events(lines).withColumn("event_id", F.xxhash64(F.concat_ws(
        "|", "uid", "mid", "score", "timestamp")))
    triggers = events.select("uid", "mid", F.col("timestamp").alias("ts"), "event_id")
    sink = UpsertLog(path(base, STREAM_RECS), "uid", realtime_stream.VERSION_COLS)
    return realtime_stream.start(triggers, tables_now, sink, checkpoint, trigger, n, threshold, compact_every=compact_every)


def profile_streaming_job(spark: SparkSession, base: str, lines: DataFrame, ratings: DataFrame, checkpoint: str, trigger: dict | None = None,
                          n: int = realtime.CANDIDATES_N, threshold: float = realtime.PAIR_THRESHOLD,
                          compact_every: int = realtime_stream.COMPACT_EVERY) -> StreamingQuery:
    """Score a stream of trigger lines into StreamRecs with users' profiles kept in the stream's state.

    ``ratings`` is a second stream of rating lines: they join their users' recent lists and rated
    items in the same query, and a user whose profile changes is scored anew. Rating is read once,
    as the state that the first start begins with; no micro-batch reads it.
    """
    edges = read(spark, base, MOVIE_RECS, ITEM_EDGES).select("mid", "rank", "sim_mid", "score").persist(StorageLevel.MEMORY_AND_DISK)

    def rows(events: DataFrame, asks: bool) -> DataFrame:
        timed = events.withColumn("ts", F.col("timestamp").cast("long")).withColumn("event_id", F.col("mid").cast("long"))
        return profile_state.feed(timed, F.lit(asks), F.lit(not asks)).withColumn("is_rating", F.lit(not asks))

    both = rows(text.parse_rating_events(lines), True).unionByName(rows(text.parse_rating_events(ratings), False))
    sink = UpsertLog(path(base, STREAM_RECS), "uid", realtime_stream.VERSION_COLS)
    return profile_state.start(both, edges, sink, checkpoint, n=n, threshold=threshold, trigger=trigger,
                               initial=rows(read(spark, base, RATING_T, RATING), False), compact_every=compact_every)


def stream_recs(spark: SparkSession, base: str) -> DataFrame:
    """Current StreamRecs: (uid, recs) per user, newest version."""
    sink = UpsertLog(path(base, STREAM_RECS), "uid", realtime_stream.VERSION_COLS)
    return sink.read_latest(spark).select("uid", "recs")
