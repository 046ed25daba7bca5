"""Rating statistics: popularity, monthly popularity, averages, genre top lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import split_pipe_list, year_month_of_epoch
from .ranking import top_k

# Fixed parameters of the statistics job.
GENRE_TOP_K = 10
# Longest prefix of a genre that the substring match joins on.
GENRE_KEY_LEN = 3


def monthly_totals(ratings: DataFrame) -> DataFrame:
    """(mid, yearmonth, count, total): one scan from which all rating statistics follow.

    Sums of half-star scores are exact, so averages of the totals equal
    averages of the rows.
    """
    with_month = ratings.select("mid", "score", year_month_of_epoch("timestamp").alias("yearmonth"))
    return with_month.groupBy("mid", "yearmonth").agg(F.count("mid").alias("count"), F.sum("score").alias("total"))


def popularity_of_totals(totals: DataFrame) -> DataFrame:
    """(mid, count)"""
    return totals.groupBy("mid").agg(F.sum("count").alias("count"))


def average_of_totals(totals: DataFrame) -> DataFrame:
    """(mid, avg)"""
    return totals.groupBy("mid").agg((F.sum("total") / F.sum("count")).alias("avg"))


def item_popularity(ratings: DataFrame) -> DataFrame:
    """(mid, count): number of ratings per item."""
    return ratings.groupBy("mid").agg(F.count("mid").alias("count"))


def item_popularity_monthly(ratings: DataFrame) -> DataFrame:
    """(mid, count, yearmonth): ratings per item per calendar month (UTC)."""
    with_month = ratings.select("mid", year_month_of_epoch("timestamp").alias("yearmonth"))
    return (with_month.groupBy("yearmonth", "mid").agg(F.count("mid").alias("count"))
            .select("mid", "count", "yearmonth"))


def item_avg_rating(ratings: DataFrame) -> DataFrame:
    """(mid, avg): mean score per item, no minimum count."""
    return ratings.groupBy("mid").agg(F.avg("score").alias("avg"))


def items_with_avg(items: DataFrame, averages: DataFrame) -> DataFrame:
    """Items joined with their average; unrated items drop out."""
    return items.join(averages, "mid")


def distinct_genres(items: DataFrame) -> DataFrame:
    """(genre): every genre named by any item, case-sensitive."""
    return items.select(F.explode(split_pipe_list("genres")).alias("genre")).distinct()


def _grams(s, length: int):
    """Substrings of ``s`` with exactly ``length`` characters (length 0: the empty string); callers de-duplicate."""
    if length == 0:
        return F.array(F.lit(""))
    starts = F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1)))
    subs = F.transform(starts, lambda i: F.substring(s, i, F.lit(length)))
    return F.filter(subs, lambda x: F.length(x) == length)


def _match_strings(genres: DataFrame, strings: DataFrame) -> DataFrame:
    """(genre, genres) where the string contains the genre, case-insensitively: an equi-join on a prefix key.

    A genre g can only be inside a string s if g's first min(length, L)
    characters occur in s. Strings emit their distinct substrings of up to L
    characters, genres emit their prefix, the two meet by key, and the full
    ``contains`` test keeps the true matches. No Cartesian product at any size.
    """
    low = F.lower(F.col("genres"))
    keys = F.array_distinct(F.flatten(F.array(*[_grams(low, n) for n in range(GENRE_KEY_LEN + 1)])))
    by_string = strings.withColumn("gkey", F.explode(keys))
    by_genre = genres.withColumn("gkey", F.substring(F.lower(F.col("genre")), 1, GENRE_KEY_LEN))
    joined = by_string.join(by_genre, "gkey")
    return joined.where(F.contains(low, F.lower(F.col("genre")))).select("genre", "genres")


def genre_item_match(genres: DataFrame, scored_items: DataFrame) -> DataFrame:
    """(genre, item columns...) for every item whose genres contain the genre.

    Case-insensitive *substring* match (``old`` matches ``cold``), done once
    per distinct genre string (far fewer than items) and joined back.
    """
    strings = scored_items.select("genres").where(F.col("genres").isNotNull()).distinct()
    return scored_items.join(_match_strings(genres, strings), "genres")


def genre_top_items(items: DataFrame, ratings: DataFrame, k: int = GENRE_TOP_K) -> DataFrame:
    """(genre, rank, mid, avg): the k best-rated items of each genre, avg desc, mid asc."""
    return genre_top_of_averages(items, item_avg_rating(ratings), k)


def genre_top_of_averages(items: DataFrame, averages: DataFrame, k: int = GENRE_TOP_K) -> DataFrame:
    """The same from (mid, avg)."""
    scored = items_with_avg(items.select("mid", "genres"), averages)
    matched = genre_item_match(distinct_genres(items), scored)
    best = top_k(matched.select("genre", "mid", "avg"), "genre", "avg", k, tie="mid")
    return best.select("genre", F.col("rank").cast("int").alias("rank"), "mid", "avg")
