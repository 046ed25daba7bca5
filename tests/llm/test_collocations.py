import random
import re
from collections import Counter

import duckdb
import pytest
from llm_fixtures import SF, awkward, nothing  # noqa: F401

from ratewise.llm import collocations, queries


def pieces_of(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0A-\x0D]", text)]


def counts_of(rows):
    f, n = Counter(), Counter()
    for lang, text in rows:
        for w in pieces_of(text):
            n[lang or "und"] += len(w)
            for k in range(1, 5):
                f.update((lang or "und", tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    return f, n


def plain(rows, least, top=2000):
    f, n = counts_of(rows)
    found = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    longest = Counter()
    for (lang, w), a in found.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                longest[lang, w[i:i + k]] = max(longest[lang, w[i:i + k]], a)
    by = {}
    for (lang, w), a in found.items():
        if 100 * longest[lang, w] < 80 * a:
            score, _, left, right = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            by.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, best in by.items() for i, (s, a, p, left, right) in enumerate(sorted(best)[:top]))


def corpus(rng):
    words = ["the", "of", "New", "york", "city", "ça", "über", "a\x0bb", "x\xa0y", "\x00", "q\x1cq", "日本"]
    rows = []
    for i in range(300):
        text = " ".join(rng.choice(words) + rng.choice(["", "", "", ",", ".", "\n", "\t"]) for _ in range(rng.randrange(60)))
        rows.append((rng.choice(["en", "de", None, "und"]), text + rng.choice(["", " new york city.", "NEW  YORK city", "\r\n"])))
    return [*rows, ("en", None), ("en", ""), (None, " \t "), ("fr", "very " * 3000), ("en", rows[0][1]), ("en", rows[0][1])]


@pytest.mark.parametrize("block, hot", [(16 << 20, 4096), (2000, 8)])
def test_equals_brute_force(spark, monkeypatch, block, hot):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", block)
    monkeypatch.setattr(collocations, "HOT_PREFIXES", hot)
    rows = corpus(random.Random(2))
    df = spark.createDataFrame([(i, lang, t, "clash", 1) for i, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string, prefix string, n int").repartition(7)
    for least, top in ((5, 2000), (30, 2000), (5, 7)):
        got = collocations.collocations(df, least=least, top=top)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(tuple(r) for r in got.collect()) == plain(rows, least, top)


def test_stripes_give_exact_counts(spark):
    rows = corpus(random.Random(6))
    totals, phrases, extensions = collocations.stripes(spark.createDataFrame(rows, "lang string, text string"), least=5)
    f, n = counts_of(rows)
    assert {r.lang: r.n for r in totals.collect()} == {k: v for k, v in n.items() if v}
    assert sorted((r.lang, r.phrase, r.f) for r in phrases.collect()) == sorted((lang, " ".join(w), c) for (lang, w), c in f.items() if c >= 5 and len(w) < 4)
    assert sorted((r.lang, f"{r.prefix} {r.next}", r.a) for r in extensions.collect()) == sorted((lang, " ".join(w), c) for (lang, w), c in f.items() if c >= 5 and len(w) > 1)


def test_awkward_and_nothing(awkward, nothing):  # noqa: F811
    got = sorted(tuple(r) for r in collocations.collocations(awkward, least=2).collect())
    assert got == plain([(r.lang, r.text) for r in awkward.collect()], 2)
    assert collocations.collocations(nothing).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 1 << 62
    df = spark.createDataFrame([(big,)], "a long")
    assert df.selectExpr("(cast(a as decimal(38,0)) * 2000000) div (cast(a as decimal(38,0)) + cast(a as decimal(38,0))) AS s").first().s == 1_000_000


def test_query_equals_sql(spark):
    sf = SF.replace("0.001", "0.01")
    got = sorted(tuple(r) for r in queries.QUERIES["op12_collocations"](spark, sf).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert got and got == sorted(con.execute(queries.SQL["op12_collocations"]).fetchall())
