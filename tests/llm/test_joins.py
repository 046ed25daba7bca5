import random
import re

import duckdb
import numpy as np
import pytest
from llm_fixtures import SF, awkward, nothing, prose  # noqa: F401

from ratewise.llm import components, ngram_join, queries, vector_join
from ratewise.llm.lattice import SHORTEST, nearest
from ratewise.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def smallest_reachable(n, links, ids):
    label = list(range(n))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        label[root(a)] = root(b)
    groups = {}
    for i in range(n):
        groups.setdefault(root(i), []).append(i)
    return {i: min((ids[j] for j in g if ids[j] is not None), default=None) for g in groups.values() for i in g}


def plain_join(rows, percent=75):
    sets = [plain_set(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    least = smallest_reachable(len(rows), links, [i for i, _ in rows])
    return sorted(((i, len(sets[k]), least[k]) for k, (i, _) in enumerate(rows)), key=repr)


def edited(rng, text, share):
    return " ".join(rng.choice(["zap", "zip", "zop"]) + str(rng.randrange(99)) if rng.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="module")
def near(spark):
    rng = random.Random(21)
    passage = prose(rng, words=60)
    base = prose(rng, words=120)
    rows = [(i, edited(rng, base, rng.choice([0.0, 0.005, 0.01, 0.02]))) for i in range(60)]
    for i in range(100, 140):
        text = prose(rng, words=rng.choice([6, 30, 80]))
        rows += [(3 * i, text), (3 * i + 1, edited(rng, text, 0.01)), (3 * i + 2, passage + " " + prose(rng, words=70))]
    rows += [(1000, passage), (1001, None), (1002, ""), (1003, "one two"), (1004, "One  TWO"), (1005, "É x"), (1006, "é x"), (None, base), (0, rows[0][1])]
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


@pytest.mark.parametrize("split, block, frequent", [(4096, 256, 16), (7, 3, 2)])
def test_join_equals_brute_force(near, monkeypatch, split, block, frequent):
    for name, value in (("SPLIT", split), ("BLOCK", block), ("FREQUENT", frequent), ("LOCAL", 2), ("BUCKET_KEYS", 500 if split == 7 else 1_000_000), ("PARTNERS", split), ("TILE_ROWS", 1 << 18 if split > 7 else 5)):
        monkeypatch.setattr(ngram_join, name, value)
    docs, rows = near
    got = sorted((tuple(r) for r in ngram_join.join_documents(docs).collect()), key=repr)
    assert got == plain_join(rows)
    assert sum(1 for _, _, c in got if c == 0) > 20


def test_split_keys_of_two_sets(spark, monkeypatch):
    for name, value in (("BUCKET_KEYS", 3), ("FREQUENT", 2), ("LOCAL", 1)):
        monkeypatch.setattr(ngram_join, name, value)
    rng, rows = random.Random(4), []
    word = lambda: f"w{rng.randrange(10 ** 9)}"
    for k in range(6):
        passage = " ".join(word() for _ in range(40))
        # long documents have the passage outside their prefix, so only the two near copies share a key
        rows += [(100 * k + 10 + i, " ".join([passage, *(word() for _ in range(120))])) for i in range(6)]
        rows += [(100 * k + i, f"{passage} {word()}") for i in range(2)]
    got = sorted((tuple(r) for r in ngram_join.join_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == plain_join(rows)
    assert [c for i, _, c in got if i % 100 == 1] == [100 * k for k in range(6)]


def test_crossing_rows_grow_with_the_group_not_with_its_square(spark, monkeypatch):
    """Copies near the threshold that stars leave apart: what the tiles return stays linear, and no link is lost."""
    found = {}
    keep = ngram_join.stored

    def watched(df, name):
        out = keep(df, name)
        if name in ("cross-sets", "cross-links"):
            found.setdefault(name, []).append((out.count(), out.select("key", "low", "high", "cid").distinct().count() if name == "cross-sets" else 0))
        return out

    monkeypatch.setattr(ngram_join, "stored", watched)
    for n in (200, 400):
        rng = random.Random(17)
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(200)]
        rows = []
        for i in range(n):
            own = list(words)
            for at in rng.sample(range(200), 4):
                own[at] = f"x{rng.randrange(10 ** 9)}"
            rows.append((i, " ".join(own)))
        got = sorted((tuple(r) for r in ngram_join.join_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
        assert got == plain_join(rows)
    for name in ("cross-sets", "cross-links"):
        (small, _), (large, _) = found[name]
        assert large <= 2.6 * small + 50, (name, found)
    assert all(n == distinct for n, distinct in found["cross-sets"])


def test_awkward_rows(awkward):
    got = sorted((tuple(r) for r in ngram_join.join_documents(awkward).collect()), key=repr)
    assert got == plain_join([(r.doc_id, r.text) for r in awkward.collect()])


def test_one_of_each(near, awkward):
    docs, rows = near
    kept = sorted(r.doc_id for r in ngram_join.one_of_each(docs).collect())
    want = {c for _, n, c in plain_join(rows) if n}
    assert kept == sorted([*want, 1001, 1002])
    out = ngram_join.one_of_each(awkward)
    assert out.columns == awkward.columns
    ids = [r.doc_id for r in out.collect()]
    assert sorted(i for i in ids if i is not None and i <= 10) == [1, 2, 3, 4, 5, 7, 8, 9] and ids.count(None) == 1


def test_nothing_to_join(nothing):
    assert ngram_join.join_documents(nothing).count() == 0 and ngram_join.one_of_each(nothing).count() == 0


def test_sets_travel_whole():
    for n in (0, 1, 5, 3000):
        own = ngram_join._distinct(np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        assert (ngram_join.unpack_set(ngram_join.pack_set(own)) == own >> np.uint64(16)).all()


def test_bitmap_bound_holds():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 6000).astype(np.uint64)
    widths = set()
    for most in (300, 5000):
        for _ in range(150):
            a = np.sort(rng.choice(pool, rng.integers(1, most), replace=False))
            b = np.sort(np.concatenate([rng.choice(a, rng.integers(0, len(a) + 1), replace=False), rng.integers(1 << 63, (1 << 64) - 1, rng.integers(0, 200), dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            bits = [ngram_join.bitmap(a)], [ngram_join.bitmap(b)]
            widths |= {len(x[0]) for x in bits}
            apart = ngram_join.differing(*bits)[0]
            assert both <= (len(a) + len(b) - apart) / 2
            if 100 * both >= 75 * (len(a) + len(b) - both):
                assert ngram_join.may_reach(len(a), len(b), apart, 75)
    assert len(widths) >= 4


def test_shingles_of_text():
    assert len(ngram_join.shingles("a b c d e f")) == 2 and len(ngram_join.shingles("a b")) == 1 and len(ngram_join.shingles(" \n")) == 0
    assert (ngram_join.shingles("A b\tC d  E") == ngram_join.shingles("a B c D e")).all()
    assert (ngram_join.shingles("a b c d é") != ngram_join.shingles("a b c d É")).all()
    assert len(ngram_join.shingles("x" * 100_000 + " y")) == 1
    assert not set(ngram_join.shingles("ab c d e f").tolist()) & set(ngram_join.shingles("a bc d e f").tolist())


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60) if i != 30] + [(100, 100 + k) for k in range(1, 50)] + [(200, 200)] + [(rng.randrange(300, 340), rng.randrange(300, 340)) for _ in range(30)]
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    nodes = sorted({x for link in links for x in link})
    at = {x: k for k, x in enumerate(nodes)}
    least = smallest_reachable(len(nodes), [(at[a], at[b]) for a, b in links], nodes)
    assert got == {x: least[at[x]] for x in nodes}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_e8():
    assert len(np.unique(SHORTEST, axis=0)) == 240 and np.allclose((SHORTEST ** 2).sum(axis=1), 2)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 8)) * 3
    point = nearest(x)
    assert ((np.rint(2 * point) == 2 * point).all() and (np.rint(point.sum(axis=1)) % 2 == 0).all())
    assert np.isin(np.abs(point % 1).sum(axis=1), [0, 4]).all()
    distance = ((x - point) ** 2).sum(axis=1)
    assert distance.max() <= 1 + 1e-9  # the covering radius
    assert (((x[:, None] - point[:, None] - SHORTEST[None]) ** 2).sum(axis=-1).min(axis=1) >= distance - 1e-9).all()


def plain_vectors(rows, cosine=0.95):
    units = [vector_join._unit(v) for _, v in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if units[a] is not None and units[b] is not None
             and len(units[a]) == len(units[b]) and units[a] @ units[b] >= cosine]
    least = smallest_reachable(len(rows), links, [i for i, _ in rows])
    degree = [0] * len(rows)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    return sorted(((i, degree[k], least[k], i is not None and i == least[k]) for k, (i, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("block", [512, 5])
def test_vectors_equal_brute_force(spark, block, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(int(i), rng.normal(size=64).tolist()) for i in range(150)]
    centre = rng.normal(size=64)
    rows += [(1000 + k, (centre + 0.1 * rng.normal(size=64)).tolist()) for k in range(60)]
    rows += [(2000 + k, rows[3][1]) for k in range(5)] + [(3000, [2 * x for x in rows[4][1]]), (3001, rows[5][1]), (5, rows[5][1])]
    rows += [(4000, None), (4001, []), (4002, [0.0] * 64), (4003, [float("nan")] + [1.0] * 63), (4004, [None] + [1.0] * 63), (4005, [float("inf")] + [1.0] * 63),
             (4006, [1e308] * 64), (4007, [1e-300] * 64), (4008, [1.0] * 3), (4009, [1.0] * 3), (None, rows[6][1]), (None, None)]
    docs = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, n_links int, weight int")
    members, found = vector_join.link_vectors(docs, block=block)
    assert found.count() > 0
    monkeypatch.setattr(vector_join, "BLOCK", block)
    got = sorted((tuple(r) for r in vector_join.join_vectors(docs).collect()), key=repr)
    assert got == plain_vectors(rows)
    assert vector_join.join_vectors(docs.where("vec_id < 0")).count() == 0


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=(400, 64))
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.9502 * x + np.sqrt(1 - 0.9502 ** 2) * z
    docs = spark.createDataFrame([(i, v) for i, v in enumerate([*x.tolist(), *y.tolist()])], "vec_id long, embedding array<double>")
    found = sum(r.n_links for r in vector_join.join_vectors(docs).collect()) / 2
    assert found >= 0.97 * 400


@pytest.mark.parametrize("name", ["op4_lattice_join", "op6_warc", "op7_ngram_join"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, want = queries.QUERIES[name](spark, SF), con.sql(queries.SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    cols = ", ".join(df.columns)
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(con.sql(f"SELECT {cols} FROM ({queries.SQL[name]})").fetchall(), key=repr)
    assert scratch_path(spark, "x")
