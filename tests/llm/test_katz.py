import math
import random
import re
import zlib
from collections import Counter

import pytest
from llm_fixtures import SF, awkward, nothing, prose  # noqa: F401

from ratewise.llm import katz, queries

K = katz.DISCOUNTED


def words_of(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [*re.findall("[^\x20\x09-\x0D]+", text), None]  # None: the end


def training(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 != 2


class PlainKatz:
    def __init__(self, texts, order):
        self.order, self.counts = order, [Counter() for _ in range(order + 1)]
        for t in texts:
            w = words_of(t)
            for k in range(1, order + 1):
                self.counts[k].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
        self.n = sum(self.counts[1].values())
        self.d = [None] + [self.discounts(self.counts[k]) for k in range(1, order + 1)]
        self.after = Counter()
        self.followers = {(): [g[0] for g in self.counts[1]]}
        for k in range(1, order + 1):
            for g, c in self.counts[k].items():
                self.after[g[:-1]] += c
                if k > 1:
                    self.followers.setdefault(g[:-1], []).append(g[-1])
        self.memo = {}

    @staticmethod
    def discounts(counts):
        seen = Counter(counts.values())
        far = (K + 1) * seen[K + 1] / seen[1] if seen[1] else 1.0
        out = {}
        for r in range(1, K + 1):
            d = ((r + 1) * seen[r + 1] / (r * seen[r]) - far) / (1 - far) if seen[r] and far < 1 else 0
            out[r] = d if 0 < d < 1 else (r - 0.5) / r
        return out

    def total(self, h):
        """(divisor, mass left) after a history."""
        own = [self.counts[len(h) + 1][(*h, w)] for w in self.followers.get(h, [])]
        freed = sum(c * (1 - self.d[len(h) + 1][c]) for c in own if c <= K)
        return (sum(own), freed / sum(own)) if freed else (sum(own) + 1, 1 / (sum(own) + 1))

    def p(self, w, h):
        c = self.counts[len(h) + 1][(*h, w)]
        if h and h not in self.followers:
            return self.p(w, h[1:])
        if (h, None) not in self.memo:
            divisor, left = self.total(h)
            self.memo[h, None] = (divisor, left / (1 - sum(self.p(x, h[1:]) for x in self.followers[h])) if h else left)
        divisor, alpha = self.memo[h, None]
        if c:
            return self.d[len(h) + 1].get(c, 1.0) * c / divisor
        return alpha * self.p(w, h[1:]) if h else alpha

    def score(self, text):
        w = words_of(text)
        return sum(math.log10(self.p(w[i], tuple(w[max(0, i - self.order + 1):i]))) for i in range(len(w)))

    def base(self, text):
        return sum(math.log10((self.counts[1][(w,)] + 1) / (self.n + len(self.counts[1]) + 1)) for w in words_of(text))


def check(got, rows, order):
    model = PlainKatz([t for i, t in rows if training(i)], order)
    by_key = sorted(((str(i), t) for i, t in rows), key=lambda r: (r[0], len(words_of(r[1])), model.base(r[1]), r[1] or ""))
    found = sorted(got.collect(), key=lambda r: (str(r.doc_id), r.n_tokens, r.base_score))
    assert len(found) == len(by_key)
    for r, (i, t) in zip(found, by_key):
        w = words_of(t)
        assert (str(r.doc_id), r.held_out, r.n_tokens, r.train_tokens) == (i, not training(None if i == "None" else int(i)), len(w), model.n)
        assert r.n_known == sum(model.counts[1][(x,)] > 0 for x in w)
        assert r.base_score == pytest.approx(model.base(t), abs=1e-9, rel=1e-12)
        assert r.score == pytest.approx(model.score(t), abs=1e-9, rel=1e-9)
    return model


def corpus(rng):
    frequent = ["the", "of", "New", "york", "city", "ça", "a\x1cb", "x\xa0y", "日本"]
    rare = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(160):
        text = " ".join(rng.choice(frequent if rng.random() < 0.7 else rare) + rng.choice(["", "", "\n", "\t"]) for _ in range(rng.randrange(50)))
        rows.append((i, text + (" fresh%d" % i if i % 11 == 0 else "")))
    return [*rows, (500, None), (501, ""), (502, "  \x0b "), (3, rows[3][1]), (None, "the of the of"), (503, "the " * 4000)]


@pytest.mark.parametrize("order, block, bucket, hot", [(1, 8 << 20, 1 << 20, 1 << 18), (2, 8 << 20, 1 << 20, 1 << 18), (3, 2000, 300, 40), (2, 500, 50, 400), (4, 3000, 1000, 10)])
def test_equals_plain_katz(spark, monkeypatch, order, block, bucket, hot):
    for name, value in (("BLOCK_BYTES", block), ("BUCKET_PAIRS", bucket), ("HOT_HISTORIES", hot)):
        monkeypatch.setattr(katz, name, value)
    rows = corpus(random.Random(4))
    df = spark.createDataFrame([(i, t, "clash", True, 1) for i, t in rows], "doc_id long, text string, block string, train boolean, tokens int").repartition(3)
    check(katz.score_documents(df, order), rows, order)


def test_probabilities_add_up():
    rows = corpus(random.Random(9))
    model = PlainKatz([t for i, t in rows if training(i)], 3)
    known = [g[0] for g in model.counts[1]]
    for h in [(), ("the",), ("the", "of"), ("nowhere", "of"), ("x\xa0y", "日本"), ("w1",), ("w1", "w2")]:
        assert sum(model.p(w, h) for w in known) + model.p("unknown word", h) == pytest.approx(1, abs=1e-9)


def test_dealt_histories_are_used(spark, monkeypatch):
    monkeypatch.setattr(katz, "BUCKET_PAIRS", 50)
    monkeypatch.setattr(katz, "HOT_HISTORIES", 400)
    rows = corpus(random.Random(4))
    corpus_ = katz.tokens(spark.createDataFrame(rows, "doc_id long, text string"), ~katz.held_out())
    model = katz.fit(corpus_, 2)
    assert model.buckets > 50 and model.hot[1] is not None and 5 < len(model.hot[1].value[0]) <= 400
    # a dealt history lies in several buckets
    assert model.tables[1].where("history IS NOT NULL").groupBy("history").count().where("count > 1").count() > 3


def test_awkward_and_nothing(awkward, nothing):  # noqa: F811
    check(katz.score_documents(awkward), [(r.doc_id, r.text) for r in awkward.collect()], katz.ORDER)
    assert katz.score_documents(nothing).count() == 0
    untrained = katz.score(*(lambda c: (c, katz.fit(c)))(katz.tokens(awkward, awkward.doc_id < 0)))
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in untrained.collect()} == {(0, 0, 0.0, 0.0)}


def test_discounts_fall_back():
    assert katz.discounts([0, 0, 5, 0, 0, 0, 0])[1:] == [(r - 0.5) / r for r in range(1, K + 1)]
    assert all(0 < d < 1 for d in katz.discounts([0, 1000, 300, 140, 80, 50, 35])[1:])


def test_query_equals_plain_and_helps(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op11_katz"](spark, SF)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    check(got, rows, katz.ORDER)
    unseen = [r for r in got.collect() if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)
