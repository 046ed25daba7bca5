import numpy as np
import pyarrow as pa

from ratewise.llm import ngram_join


def test_shuffle_files_go_with_the_job_of_each_step(spark, monkeypatch):
    key, seen, stored = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", [], ngram_join.stored
    before = spark.conf.get(key, None)

    def watched(df, name):
        seen.append(spark.conf.get(key))
        return stored(df, name)

    monkeypatch.setattr(ngram_join, "stored", watched)
    docs = spark.createDataFrame([(i, f"a b c d e f g h i j k {i % 3}") for i in range(6)], "doc_id long, text string")
    got = sorted(map(tuple, ngram_join.join_documents(docs).select("doc_id", "component_id").collect()))
    assert got == [(i, 0) for i in range(6)]
    assert len(seen) > 5 and set(seen) == {"true"} and spark.conf.get(key, None) == before


def test_a_tile_compares_pairs_that_share_no_smaller_key():
    rng = np.random.default_rng(4)
    n, key = 60, 50
    first = [sorted(set(rng.integers(0, 70, rng.integers(1, ngram_join.FIRST_KEYS + 1)).tolist())) for _ in range(n)]
    bits = [ngram_join.bitmap(rng.integers(0, 1 << 63, size).astype(np.uint64)) for size in rng.integers(10, 2000, n)]
    tile = ngram_join._Tile(pa.table({
        "key": [key] * n, "low": pa.array([0] * n, pa.int32()), "high": pa.array([0] * n, pa.int32()), "cid": list(range(n)), "component": list(range(n)),
        "n": [100] * n, "bits": bits, "block": pa.array([0] * n, pa.int32()), "first": pa.array(first, pa.list_(pa.int64()))}), 75)
    every = np.arange(n)
    earlier = tile.earlier(every, every)
    for p in range(n):
        for q in range(n):
            if p != q:
                assert earlier[p, q] == bool({k for k in first[p] if k < key} & set(first[q]))
    p, q = np.nonzero(~np.eye(n, dtype=bool))
    assert (tile.differing(p, q) == ngram_join.differing([bits[i] for i in p], [bits[i] for i in q])).all()
