"""Plain-SQL statements of the registered queries (DuckDB dialect).

Each statement inlines the mapping of the test tables onto the rating model
as CTEs, so it runs on the raw parquet views alone. Column names equal the
Spark results'.
"""

from __future__ import annotations

# -- fixture CTEs ---------------------------------------------------------
CTE = {
    "ratings": """ratings AS (
  SELECT o_custkey::INTEGER AS uid, l_partkey::INTEGER AS mid,
         (ceil(l_quantity / 5) / 2)::DOUBLE AS score,
         floor(epoch(o_orderdate))::INTEGER AS timestamp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "items": """items AS (
  SELECT p_partkey::INTEGER AS mid, p_name AS title,
         concat_ws('|', p_type, string_split(p_name, ' ')[1], string_split(p_name, ' ')[2]) AS genres
  FROM part)""",
    "item_factors": """item_factors AS (
  SELECT vec_id::INTEGER AS mid, embedding::DOUBLE[] AS features
  FROM embeddings)""",
    "user_factors": """user_factors AS (
  SELECT vec_id::INTEGER AS uid, embedding::DOUBLE[] AS features
  FROM embeddings)""",
    "ev": """ev AS (
  SELECT event_id, user_id::INTEGER AS uid, json_extract(props, '$.k')::INTEGER AS mid,
         greatest(0.5, least(5.0, ceil(value / 10) / 2))::DOUBLE AS score, ts,
         floor(epoch(ts))::INTEGER AS timestamp, event_type
  FROM events)""",
    "genres": """genre_list AS (
  SELECT DISTINCT unnest(CASE WHEN genres = '' THEN ['']
                              WHEN regexp_replace(genres, '\\|+$', '') = '' THEN []::VARCHAR[]
                              ELSE string_split(regexp_replace(genres, '\\|+$', ''), '|') END) AS genre
  FROM items)""",
}


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(CTE[c] for c in ctes) + "\n" + body


def dot_sql(a: str, b: str, n: int | None = None) -> str:
    """Dot product of two vectors, or of their first n elements."""
    return f"list_dot_product({a}, {b})" if n is None else f"list_dot_product({a}[1:{n}], {b}[1:{n}])"


def norm_sql(a: str) -> str:
    return f"sqrt({dot_sql(a, a)})"


SQL: dict[str, str] = {}

SQL["item_popularity"] = with_(["ratings"], """
SELECT mid, count(mid) AS count FROM ratings GROUP BY mid""")

SQL["item_popularity_monthly"] = with_(["ratings"], """
SELECT mid, count(mid) AS count, yearmonth FROM (
  SELECT mid, (year(d) * 100 + month(d))::INTEGER AS yearmonth
  FROM (SELECT mid, DATE '1970-01-01' + floor(timestamp / 86400)::INTEGER AS d FROM ratings))
GROUP BY yearmonth, mid""")

SQL["item_popularity_order"] = with_(["ratings"], """
SELECT row_number() OVER (ORDER BY count DESC, mid) AS rank, mid, count
FROM (SELECT mid, count(mid) AS count FROM ratings GROUP BY mid)""")

SQL["monthly_popularity_order"] = f"""
SELECT row_number() OVER (ORDER BY yearmonth DESC, count DESC, mid) AS rank, mid, count, yearmonth
FROM ({SQL["item_popularity_monthly"]})"""

SQL["monthly_popularity_sql"] = with_(["ratings"], """
SELECT mid, yearmonth, count(*) AS count, round(avg(score), 9) AS avg FROM (
  SELECT mid, score, (year(d) * 100 + month(d))::INTEGER AS yearmonth
  FROM (SELECT mid, score, DATE '1970-01-01' + floor(timestamp / 86400)::INTEGER AS d FROM ratings))
WHERE mid IS NOT NULL GROUP BY mid, yearmonth""")

SQL["item_avg_order"] = with_(["ratings"], """
SELECT row_number() OVER (ORDER BY avg DESC, mid) AS rank, mid, avg
FROM (SELECT mid, avg(score) AS avg FROM ratings GROUP BY mid)""")

SQL["item_avg_rating"] = with_(["ratings"], """
SELECT mid, avg(score) AS avg FROM ratings GROUP BY mid""")

SQL["items_with_avg"] = with_(["ratings", "items"], """
SELECT i.mid, i.title, i.genres, a.avg
FROM items i JOIN (SELECT mid, avg(score) AS avg FROM ratings GROUP BY mid) a ON i.mid = a.mid""")

SQL["distinct_genres"] = with_(["items", "genres"], """
SELECT genre FROM genre_list""")

SQL["genre_item_match"] = with_(["ratings", "items", "genres"], """
SELECT g.genre, i.mid, a.avg
FROM genre_list g
JOIN items i ON contains(lower(i.genres), lower(g.genre))
JOIN (SELECT mid, avg(score) AS avg FROM ratings GROUP BY mid) a ON i.mid = a.mid""")

SQL["genre_top_items"] = with_(["ratings", "items", "genres"], """
SELECT genre, rank, mid, avg FROM (
  SELECT g.genre, i.mid, a.avg,
         (row_number() OVER (PARTITION BY g.genre ORDER BY a.avg DESC, i.mid ASC))::INTEGER AS rank
  FROM genre_list g
  JOIN items i ON contains(lower(i.genres), lower(g.genre))
  JOIN (SELECT mid, avg(score) AS avg FROM ratings GROUP BY mid) a ON i.mid = a.mid)
WHERE rank <= 10""")

SQL["distinct_users"] = with_(["ratings"], "SELECT DISTINCT uid FROM ratings")
SQL["distinct_items"] = with_(["ratings"], "SELECT DISTINCT mid FROM ratings")

COS = f"{dot_sql('a.features', 'b.features')} / ({norm_sql('a.features')} * {norm_sql('b.features')})"
CTE["edges"] = f"""edges AS (
  SELECT mid, sim_mid, score FROM (
    SELECT a.mid, b.mid AS sim_mid, {COS} AS score
    FROM item_factors a JOIN item_factors b ON a.mid <> b.mid)
  WHERE score > 0.2)"""
CTE["split"] = """split AS (
  SELECT *, CASE WHEN ((uid::BIGINT * 2654435761 + mid::BIGINT * 40503 + timestamp::BIGINT) % 1000003)::DOUBLE
                      < 0.2 * 1000003 THEN 'test' ELSE 'train' END AS split
  FROM ratings)"""
CTE["test_joined"] = f"""test AS (SELECT uid, mid, score FROM split WHERE split = 'test'),
pred AS (SELECT t.uid, t.mid, u.features AS uf, i.features AS if_,
                {dot_sql('u.features', 'i.features')} AS prediction
         FROM test t JOIN user_factors u ON t.uid = u.uid JOIN item_factors i ON t.mid = i.mid),
joined AS (SELECT t.uid, t.mid, t.score, p.uf, p.if_, p.prediction
           FROM test t JOIN pred p ON t.uid = p.uid AND t.mid = p.mid)"""
CTE["realtime"] = """recent AS (
  SELECT uid, pos, mid, score FROM (
    SELECT uid, (row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) - 1)::INTEGER AS pos,
           mid, score FROM ev)
  WHERE pos < 20),
seen AS (SELECT DISTINCT uid, mid FROM ev WHERE event_type = 'purchase'),
trig AS (
  SELECT uid, mid FROM (
    SELECT uid, mid, row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) AS rn
    FROM ev WHERE event_type = 'click')
  WHERE rn = 1),
cands AS (
  SELECT uid, rank, mid, sim FROM (
    SELECT t.uid, e.sim_mid AS mid, e.score AS sim,
           (row_number() OVER (PARTITION BY t.uid ORDER BY e.score DESC, e.sim_mid ASC))::INTEGER AS rank
    FROM trig t JOIN edges e ON e.mid = t.mid
    WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.uid = t.uid AND s.mid = e.sim_mid))
  WHERE rank <= 20),
terms AS (
  SELECT c.uid, c.mid, r.score AS recent_score, e.score AS sim
  FROM cands c JOIN recent r ON c.uid = r.uid
  JOIN edges e ON e.mid = c.mid AND e.sim_mid = r.mid
  WHERE e.score > 0.25),
scored AS (
  SELECT uid, mid, avg(sim * recent_score) AS base,
         count(*) FILTER (WHERE recent_score > 3) AS n_high,
         count(*) FILTER (WHERE recent_score <= 3) AS n_low
  FROM terms GROUP BY uid, mid),
final AS (
  SELECT uid, mid, base + ln(greatest(n_high, 1)) / ln(10) - ln(greatest(n_low, 1)) / ln(10) AS score
  FROM scored)"""

SQL["user_item_pairs"] = with_(["ratings"], """
SELECT uid, (SELECT count(DISTINCT mid) FROM ratings) AS n_candidates, count(DISTINCT mid) AS n_rated
FROM ratings GROUP BY uid""")

SQL["predict_pairs"] = with_(["ratings", "item_factors", "user_factors"], f"""
SELECT p.uid, p.mid, round({dot_sql('u.features', 'i.features')}, 9) AS prediction
FROM (SELECT DISTINCT uid, mid FROM ratings) p
JOIN user_factors u ON p.uid = u.uid JOIN item_factors i ON p.mid = i.mid""")

SQL["user_top_items"] = with_(["item_factors", "user_factors"], f"""
SELECT uid, rank, mid, round(score, 9) AS score FROM (
  SELECT uid, mid, score,
         (row_number() OVER (PARTITION BY uid ORDER BY score DESC, mid ASC))::INTEGER AS rank
  FROM (SELECT u.uid, i.mid, {dot_sql('u.features', 'i.features')} AS score
        FROM user_factors u, item_factors i)
  WHERE score > 0)
WHERE rank <= 20""")

_SIM_LISTS = with_(["item_factors", "edges"], """
SELECT mid, (row_number() OVER (PARTITION BY mid ORDER BY score DESC, sim_mid ASC))::INTEGER AS rank,
       sim_mid, round(score, 9) AS score
FROM edges""")
SQL["item_similarity"] = _SIM_LISTS

SQL["rating_split"] = with_(["ratings", "split"], "SELECT uid, mid, score, timestamp, split FROM split")

SQL["rating_rmse"] = with_(["ratings", "item_factors", "user_factors", "split", "test_joined"], """
SELECT round(sqrt(avg((score - prediction) * (score - prediction))), 9) AS rmse, count(*) AS n_pairs
FROM joined""")


def _grid_sql() -> str:
    parts = []
    for r in (16, 32, 48, 64):
        for lam in (0.01, 0.1, 1.0):
            pred = f"({dot_sql('uf', 'if_', r)} / {1.0 + lam!r})"
            parts.append(f"SELECT {r}::INTEGER AS rank, {lam!r}::DOUBLE AS \"lambda\", "
                         f"sqrt(avg((score - {pred}) * (score - {pred}))) AS rmse FROM joined")
    return "\nUNION ALL\n".join(parts)


SQL["best_params"] = with_(["ratings", "item_factors", "user_factors", "split", "test_joined"], f"""
, grid AS (
{_grid_sql()})
SELECT rank, "lambda", round(rmse, 9) AS rmse FROM grid ORDER BY rmse, rank, "lambda" LIMIT 1""")

_RT = ["ev", "item_factors", "edges", "realtime"]

SQL["recent_ratings"] = with_(["ev"], """
SELECT uid, pos, mid, score FROM (
  SELECT uid, (row_number() OVER (PARTITION BY uid ORDER BY ts DESC, event_id DESC) - 1)::INTEGER AS pos,
         mid, score FROM ev)
WHERE pos < 20""")

SQL["candidate_items"] = with_(_RT, "SELECT uid, rank, mid, round(sim, 9) AS sim FROM cands")

SQL["pair_similarity_lookup"] = with_(_RT, """
SELECT t.uid, r.pos, t.mid, r.mid AS other_mid, round(coalesce(e.score, 0.0), 9) AS sim
FROM trig t JOIN recent r ON t.uid = r.uid
LEFT JOIN edges e ON e.mid = t.mid AND e.sim_mid = r.mid""")

SQL["realtime_base_score"] = with_(_RT, "SELECT uid, mid, round(base, 9) AS base FROM scored")
SQL["realtime_boost_counts"] = with_(_RT, "SELECT uid, mid, n_high, n_low FROM scored")
SQL["realtime_recs"] = with_(_RT, """
SELECT uid, (row_number() OVER (PARTITION BY uid ORDER BY score DESC, mid ASC))::INTEGER AS rank,
       mid, round(score, 6) AS score
FROM final""")

SQL["parse_items"] = with_(["items"], """
SELECT mid, '"' || title || ', The (' || (1990 + mid % 30)::VARCHAR || ')"' AS title, genres FROM items""")
SQL["parse_ratings"] = with_(["ratings"], "SELECT uid, mid, score, timestamp FROM ratings")
SQL["parse_rating_events"] = with_(["ev"], "SELECT uid, mid, score, timestamp FROM ev")
SQL["stream_source_ratings"] = SQL["parse_rating_events"]
SQL["parse_recent_list"] = SQL["recent_ratings"]
SQL["nested_recs_roundtrip"] = SQL["user_top_items"]
SQL["store_roundtrip"] = SQL["parse_ratings"]
SQL["rating_rmse_stored"] = SQL["rating_rmse"]
SQL["stream_realtime_recs"] = SQL["realtime_recs"]
SQL["stream_recent_state"] = SQL["recent_ratings"]
SQL["stream_upsert_recs"] = with_(_RT, """
SELECT t.uid, coalesce(f.n_recs, 0) AS n_recs, f.best_mid, round(f.best_score, 6) AS best_score,
       round(coalesce(f.sum_score, 0.0), 5) AS sum_score
FROM trig t LEFT JOIN (
  SELECT uid, count(*) AS n_recs, arg_max(mid, (score, -mid)) AS best_mid, max(score) AS best_score,
         sum(score) AS sum_score
  FROM final GROUP BY uid) f ON t.uid = f.uid""")

SQL["store_lookup"] = with_(["ratings"], """
SELECT 'uid' AS by, * FROM ratings WHERE uid = (SELECT uid FROM ratings GROUP BY uid ORDER BY count(*) DESC, uid LIMIT 1)
UNION ALL
SELECT 'mid' AS by, * FROM ratings WHERE mid = (SELECT mid FROM ratings GROUP BY mid ORDER BY count(*) DESC, mid LIMIT 1)""")

# what is determined of a fit: which rows there are, and that each obeys its rules
CTE["train_test"] = """train AS (SELECT * FROM split WHERE split = 'train'),
held AS (SELECT uid, mid, score FROM split WHERE split = 'test'
         AND uid IN (SELECT uid FROM train) AND mid IN (SELECT mid FROM train))"""
SQL["als_item_factors"] = with_(["ratings"], "SELECT DISTINCT mid, 200 AS length, true AS finite FROM ratings")
SQL["als_predict"] = with_(["ratings", "split", "train_test"], "SELECT uid, mid, score, true AS predicted FROM held")
SQL["als_user_recs"] = with_(["ratings"], "SELECT DISTINCT uid, true AS in_order, true AS in_bounds, 0::BIGINT AS missing, 0::BIGINT AS extra FROM ratings")
SQL["als_item_sims"] = with_(["ratings"], "SELECT DISTINCT mid, true AS in_order, true AS in_bounds, true AS mirrored, 0::BIGINT AS missing, 0::BIGINT AS extra FROM ratings")
SQL["als_grid_search"] = with_(["ratings", "split", "train_test"], """
SELECT r.rank, l."lambda", (SELECT sum(c * c) FROM (SELECT count(*) AS c FROM held GROUP BY uid, mid))::BIGINT AS n_pairs,
       true AS valid, true AS not_below_best, true AS best_repeats
FROM (SELECT unnest([50, 100, 200, 300]) AS rank) r, (SELECT unnest([0.01, 0.1, 1.0]::DOUBLE[]) AS "lambda") l""")
