from ratewise.operators import stats

ITEMS = [(1, "a", "Comedy|Drama"), (2, "b", "cold|SMALL"), (3, "c", "old|small"),
         (4, "d", "Horror"), (5, "e", "Drama")]
RATINGS = [(10, 1, 4.0, 1260759144), (11, 1, 5.0, 1260759144), (10, 2, 3.0, 1262304000),
           (10, 3, 3.0, 1262304000), (12, 5, 4.5, 1262304000)]


def frames(spark):
    items = spark.createDataFrame(ITEMS, "mid int, title string, genres string")
    ratings = spark.createDataFrame(RATINGS, "uid int, mid int, score double, timestamp int")
    return items, ratings


def test_counts_and_months(spark):
    items, ratings = frames(spark)
    pop = {r["mid"]: r["count"] for r in stats.item_popularity(ratings).collect()}
    assert pop == {1: 2, 2: 1, 3: 1, 5: 1}
    monthly = {(r["yearmonth"], r["mid"]): r["count"] for r in stats.item_popularity_monthly(ratings).collect()}
    assert monthly == {(200912, 1): 2, (201001, 2): 1, (201001, 3): 1, (201001, 5): 1}


def test_distinct_genres_case_sensitive(spark):
    items, _ = frames(spark)
    got = {r["genre"] for r in stats.distinct_genres(items).collect()}
    assert got == {"Comedy", "Drama", "cold", "SMALL", "old", "small", "Horror"}


def genre_lists(df):
    out = {}
    for r in df.orderBy("genre", "rank").collect():
        out.setdefault(r["genre"], []).append(r["mid"])
    return out


def test_genre_top_items_substring_case_insensitive(spark):
    items, ratings = frames(spark)
    got = genre_lists(stats.genre_top_items(items, ratings, k=10))
    # 'old' is inside 'cold'; 'SMALL' and 'small' both match both items
    assert got["old"] == [2, 3]  # avg 3.0 each, tie broken by mid
    assert got["SMALL"] == [2, 3] and got["small"] == [2, 3]
    assert got["Drama"] == [1, 5]  # 4.5 vs 4.5: tie -> mid asc
    assert "Horror" not in got  # no rated item


def test_empty_genre_matches_everything(spark):
    items = spark.createDataFrame([(1, "a", "x||y"), (2, "b", "zz")], "mid int, title string, genres string")
    ratings = spark.createDataFrame([(1, 1, 1.0, 0), (1, 2, 2.0, 0)], "uid int, mid int, score double, timestamp int")
    got = genre_lists(stats.genre_top_items(items, ratings))
    assert got[""] == [2, 1]
    assert got["x"] == [1] and got["zz"] == [2]


def test_short_and_long_genres_and_null(spark):
    items = spark.createDataFrame([(1, "a", "ab|Xyz|q"), (2, "b", "xy||B"), (3, "c", "abc"), (4, "d", None)],
                                  "mid int, title string, genres string")
    ratings = spark.createDataFrame([(1, m, float(m), 0) for m in (1, 2, 3, 4)],
                                    "uid int, mid int, score double, timestamp int")
    got = genre_lists(stats.genre_top_items(items, ratings))
    assert got["B"] == [3, 2, 1] and got["ab"] == [3, 1] and got[""] == [3, 2, 1] and got["Xyz"] == [1]


def test_match_equals_a_plain_loop_and_has_no_nested_loop(spark):
    from ratewise.sources import testdata as td

    from conftest import SF_SMALL
    items, ratings = td.items(spark, SF_SMALL), td.ratings(spark, SF_SMALL)
    scored = stats.items_with_avg(items.select("mid", "genres"), stats.item_avg_rating(ratings))
    matched = stats.genre_item_match(stats.distinct_genres(items), scored)
    genres = [r["genre"] for r in stats.distinct_genres(items).collect()]
    want = {(g, r["mid"]) for r in scored.collect() for g in genres if g.lower() in r["genres"].lower()}
    assert {(r["genre"], r["mid"]) for r in matched.collect()} == want and want
    assert "NestedLoop" not in matched._jdf.queryExecution().executedPlan().toString()


def test_totals_give_all_statistics(spark):
    items, ratings = frames(spark)
    totals = stats.monthly_totals(ratings)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(stats.popularity_of_totals(totals)) == rows(stats.item_popularity(ratings))
    assert rows(stats.average_of_totals(totals)) == rows(stats.item_avg_rating(ratings))
    assert rows(totals.select("mid", "count", "yearmonth")) == rows(stats.item_popularity_monthly(ratings))
    assert rows(stats.genre_top_of_averages(items, stats.average_of_totals(totals))) == rows(stats.genre_top_items(items, ratings))
