from pyspark.sql import functions as F

from ratewise.plans import catalog, jobs
from ratewise.session import scratch_path
from ratewise.sources import text

from conftest import SF_SMALL


def sorted_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_four_jobs_end_to_end(spark):
    base = scratch_path(spark, "t-jobs")
    movies, ratings = f"{base}/in/movies", f"{base}/in/ratings"
    catalog._with_headers(spark, catalog.item_lines(spark, SF_SMALL), text.ITEM_HEADER).coalesce(1) \
        .write.text(movies)
    catalog._with_headers(spark, catalog.rating_lines(spark, SF_SMALL), text.RATING_HEADER).coalesce(1) \
        .write.text(ratings)
    out = f"{base}/tables"
    jobs.load_job(spark, movies, ratings, out)
    assert jobs.read(spark, out, jobs.RATING_T).count() == catalog.td.ratings(spark, SF_SMALL).count()

    jobs.statistics_job(spark, out)
    assert sorted_rows(jobs.read(spark, out, jobs.AVERAGE).select("mid", "avg")) == sorted_rows(
        catalog.QUERIES["item_avg_rating"](spark, SF_SMALL))
    popular = jobs.read(spark, out, jobs.RATE_MORE).orderBy("rank").collect()
    assert [r["rank"] for r in popular] == list(range(1, len(popular) + 1))
    assert [(-r["count"], r["mid"]) for r in popular] == sorted((-r["count"], r["mid"]) for r in popular)
    genres = jobs.read(spark, out, jobs.GENRES_TOP)
    flat = genres.select("genres", F.posexplode("recs").alias("pos", "r")).select(
        F.col("genres").alias("genre"), (F.col("pos") + 1).cast("int").alias("rank"), "r.mid", F.col("r.score").alias("avg"))
    assert sorted_rows(flat) == sorted_rows(catalog.QUERIES["genre_top_items"](spark, SF_SMALL))

    jobs.offline_job(spark, out, rank=4, max_iter=3, reg=0.1, sims_k=None)
    recs = jobs.read(spark, out, jobs.USER_RECS)
    assert recs.count() > 0 and recs.where(F.size("recs") > 20).count() == 0
    assert jobs.read(spark, out, jobs.MOVIE_RECS).where("score <= 0.9").count() == 0

    best = jobs.tuning_job(spark, out, ranks=(2, 4), lambdas=(0.1, 1.0), max_iter=2).first()
    assert best["rank"] in (2, 4) and best["rmse"] > 0

    events = f"{base}/in/events"
    catalog.event_lines(spark, SF_SMALL).coalesce(1).write.text(events)
    q = jobs.streaming_job(spark, out, text.text_stream_lines(spark, events), f"{base}/ckpt")
    q.awaitTermination()
    assert q.exception() is None
    stream = jobs.stream_recs(spark, out)
    users = catalog.td.rating_events(spark, SF_SMALL).select("uid").distinct().count()
    assert stream.count() == users  # every user with an event gets a (possibly empty) list


def test_command_line_load_and_statistics(spark):
    from ratewise.__main__ import main
    base = scratch_path(spark, "t-cli")
    catalog._with_headers(spark, catalog.item_lines(spark, SF_SMALL), text.ITEM_HEADER).coalesce(1) \
        .write.text(f"{base}/movies")
    catalog._with_headers(spark, catalog.rating_lines(spark, SF_SMALL), text.RATING_HEADER).coalesce(1) \
        .write.text(f"{base}/ratings")
    main(["load", "--movies", f"{base}/movies", "--ratings", f"{base}/ratings", "--base", f"{base}/t"])
    main(["statistics", "--base", f"{base}/t"])
    pop = jobs.read(spark, f"{base}/t", jobs.RATE_MORE).select("mid", "count")
    assert sorted_rows(pop) == sorted_rows(catalog.QUERIES["item_popularity"](spark, SF_SMALL))


def test_statistics_scan_ratings_once(spark):
    ratings = catalog.td.ratings(spark, SF_SMALL)
    base = scratch_path(spark, "t-once")
    jobs.append_ratings(ratings, base)
    jobs.tables.write_table(catalog.td.items(spark, SF_SMALL), jobs.path(base, jobs.MOVIE_T))
    reads, read = [], jobs.read
    try:
        jobs.read = lambda s, b, name, schema=None: (reads.append(name), read(s, b, name, schema))[1]
        jobs.statistics_job(spark, base)
    finally:
        jobs.read = read
    assert reads.count(jobs.RATING_T) == 1


def test_ratings_added_between_batches_count(spark):
    """A rating appended mid-stream hides its item from the next batch's candidates and joins the recent list."""
    base = scratch_path(spark, "t-current")
    rate = lambda rows: jobs.append_ratings(spark.createDataFrame(rows, "uid int, mid int, score double, timestamp int"), base)
    rate([(1, 10, 5.0, 100), (2, 10, 5.0, 100)])
    edges = [(20, 1, 30, 0.99), (20, 2, 40, 0.95), (30, 1, 20, 0.99), (30, 2, 10, 0.9), (40, 1, 20, 0.95), (40, 2, 10, 0.9), (10, 1, 30, 0.9), (10, 2, 40, 0.9)]
    spark.createDataFrame(edges, "mid int, rank int, sim_mid int, score double").write.parquet(jobs.path(base, jobs.MOVIE_RECS))

    def send(name, line):
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(f"{base}/in")
        q = jobs.streaming_job(spark, base, text.text_stream_lines(spark, f"{base}/in"), f"{base}/ckpt", compact_every=1)
        q.awaitTermination()
        assert q.exception() is None
        return {r["uid"]: [x["mid"] for x in r["recs"]] for r in jobs.stream_recs(spark, base).collect()}

    assert send("a", "1|20|4.0|200") == {1: [30, 40]}
    rate([(1, 30, 4.0, 300)])
    assert send("b", "1|20|4.0|400") == {1: [40]}
    assert send("c", "2|20|4.0|500") == {1: [40], 2: [30, 40]}


def test_a_batch_reads_only_its_users_folders(spark):
    base = scratch_path(spark, "t-folders")
    jobs.append_ratings(catalog.td.ratings(spark, SF_SMALL), base)
    newest = spark.createDataFrame([(7, 1)], "uid int, mid int")
    recent, seen = jobs.user_tables(spark, base, newest)
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [key_bucket" in plan or "PartitionFilters: [isnotnull(key_bucket" in plan
    want = catalog.td.ratings(spark, SF_SMALL).where("uid = 7")
    assert sorted_rows(seen) == sorted_rows(want.select("uid", "mid")) and recent.count() == min(20, want.count())


def test_profiles_in_state_begin_with_rating_and_follow_the_stream(spark):
    """Rating is the state at the first start; afterwards it can even be gone from the micro-batches' plans."""
    base = scratch_path(spark, "t-profile-job")
    jobs.append_ratings(spark.createDataFrame([(1, 10, 5.0, 100), (2, 10, 5.0, 100)], "uid int, mid int, score double, timestamp int"), base)
    edges = [(20, 1, 30, 0.99), (20, 2, 40, 0.95), (30, 1, 20, 0.99), (30, 2, 10, 0.9), (40, 1, 20, 0.95), (40, 2, 10, 0.9), (10, 1, 30, 0.9), (10, 2, 40, 0.9)]
    spark.createDataFrame(edges, "mid int, rank int, sim_mid int, score double").write.parquet(jobs.path(base, jobs.MOVIE_RECS))
    put = lambda folder, line: spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(f"{base}/{folder}")

    def run():
        q = jobs.profile_streaming_job(spark, base, text.text_stream_lines(spark, f"{base}/in"), text.text_stream_lines(spark, f"{base}/rated"), f"{base}/ckpt", compact_every=1)
        q.awaitTermination()
        assert q.exception() is None
        return {r["uid"]: [x["mid"] for x in r["recs"]] for r in jobs.stream_recs(spark, base).collect()}

    put("in", "1|20|4.0|200")
    put("rated", "3|10|5.0|100")
    assert run() == {1: [30, 40]}
    # rows that appear in Rating later are not read; those of the stream are, between two triggers
    jobs.append_ratings(spark.createDataFrame([(1, 40, 4.0, 250)], "uid int, mid int, score double, timestamp int"), base)
    put("rated", "1|30|4.0|300")
    assert run() == {1: [40]}
    put("in", "3|20|4.0|400")
    assert run() == {1: [40], 3: [30, 40]}
