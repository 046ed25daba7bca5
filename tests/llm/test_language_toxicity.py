import random

import numpy as np
import pytest
from llm_fixtures import SF, awkward, nothing, prose  # noqa: F401

from pyspark.sql import functions as F

from ratewise.llm import language, queries, toxicity
from ratewise.llm.common import held_out, table


@pytest.fixture(scope="module")
def languages(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, lang), lang) for i in range(300) for lang in (["en", "de"][i % 2],)]
    rows += [(900, None, "en"), (901, prose(rng), None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_of_held_out_texts(languages):
    model = language.fit(languages.where(~held_out()))
    assert model.languages == ("de", "en")
    rows = language.predict(languages, model, keep=("doc_id", "lang")).where(held_out()).collect()
    assert len(rows) > 40
    assert sum(r.lang_pred == r.lang for r in rows if r.lang) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_awkward_texts_and_columns(awkward, languages):
    model = language.fit(languages)
    rows = language.predict(awkward.drop("score"), model).collect()
    assert len(rows) == awkward.count()
    unknown = {r.doc_id for r in rows if r.lang_pred == language.UNKNOWN}
    assert {1, 2, 3} <= unknown and all(r.score == 0 for r in rows if r.lang_pred == language.UNKNOWN)
    kept = language.accepted(awkward, model, 0.1)
    assert kept.columns == awkward.columns
    assert {4, 5, 6, 10} <= {r.doc_id for r in kept.collect()} and not {1, 2, 3} & {r.doc_id for r in kept.collect()}


def test_model_without_languages(nothing, awkward):
    model = language.fit(nothing)
    assert model.languages == ()
    assert {(r.lang_pred, r.score) for r in language.predict(awkward.drop("score"), model).collect()} == {("und", 0.0)}
    assert language.predict(nothing.drop("score"), model).count() == 0


def test_long_texts_are_read_whole(languages):
    model = language.fit(languages)
    rng = random.Random(5)
    german = " ".join(prose(rng, "de", 400) for _ in range(40))
    shares = model.shares(prose(rng, "en", 400) + german)
    assert model.languages[int(np.argmax(shares))] == "de"


def test_a_language_sample_of_any_size(spark):
    """A share far below one in a million neither fails nor takes all; a bound above the corpus takes every text."""
    rng = random.Random(9)
    rows = spark.createDataFrame([("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=40)), "en") for _ in range(2000)], "text string, lang string")
    sizes = [int(language.fit(rows, sample_chars=n).slices.astype(bool).sum()) for n in (0, 2000, 1 << 40)]
    assert sizes[0] <= sizes[1] < sizes[2]


def test_more_languages_than_a_byte_has_bits(spark):
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrst"
    rows = [(i, " ".join("".join(rng.choice(letters[2 * k:2 * k + 2]) for _ in range(5)) for _ in range(60)), f"l{k}") for i in range(60) for k in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = language.predict(docs, language.fit(docs), keep=("lang",)).collect()
    assert all(r.lang == r.lang_pred for r in out)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(11)
    docs, labels = [], []
    for i in range(800):
        toxic = i % 5 == 0
        words = prose(rng, words=rng.choice([12, 40, 200])).split(" ")
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["wretch", "filthmonger"]))
        if rng.random() < (0.5 if toxic else 0.1):
            words.insert(0, "buddhist")  # a biased corpus: toxic texts mention the group more often
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([*labels, (0, None), (5000, 1)], "doc_id long, toxic int")


def test_toxicity_of_held_out_texts_and_neutral_mentions(spark, labelled):
    docs, labels = labelled
    model = toxicity.fit(docs.where(~held_out()), labels)
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    rows = toxicity.score(docs, model).where(held_out()).collect()
    assert len(rows) > 150
    assert sum((r.score >= 0.3) == bool(truth[r.doc_id]) for r in rows) >= 0.97 * len(rows)
    rng = random.Random(2)
    plain = [prose(rng) for _ in range(30)]
    both = spark.createDataFrame([(i, t) for t in plain for i, t in ((0, t), (1, "buddhist " + t), (2, "christian " + t))], "doc_id long, text string")
    scores = {i: [r.score for r in toxicity.score(both, model).collect() if r.doc_id == i] for i in range(3)}
    assert max(scores[1] + scores[2]) < 0.3
    assert abs(np.mean(scores[1]) - np.mean(scores[0])) < 0.05


def test_swaps_keep_the_rest_of_the_sentence():
    others = toxicity.counterfactuals("the Muslim girl sang", swaps=99)
    assert "the hindu girl sang" in others and len(others) == len(toxicity.IDENTITY_TERMS["belief"]) - 1
    two = toxicity.counterfactuals("a gay man and a Muslim sang", swaps=2)
    assert len(two) == len(set(two)) == 6 and sum("gay man" in x for x in two) == 2 and sum("Muslim" in x for x in two) == 4
    assert all(o.endswith(" a song") for o in toxicity.counterfactuals("a song", plain_every=1)) and toxicity.counterfactuals("a song", plain_every=1)


def plain_score(model, text):
    """The model's score from its weights, n-gram by n-gram in plain Python."""
    letters = "".join(c.lower() if len(c.lower()) == 1 else c for c in (text or "") if True)
    words = "".join(c if c.isalpha() else " " for c in letters).split()
    line = f" {' '.join(words)} " if words else ""
    weight, found = dict(zip(model.grams.tolist(), model.weights.tolist())), set()
    for n in range(toxicity.SIZES[0], toxicity.SIZES[1] + 1):
        for i in range(len(line) - n + 1):
            h = ord(line[i])
            for c in line[i + 1:i + n]:
                h = ((h ^ ord(c)) * 0x9E3779B97F4A7C15) % (1 << 64)
                h ^= h >> 29
            found.add(h)
    return 1 / (1 + np.exp(-(model.base + sum(weight.get(h, 0.0) for h in found))))


def test_scores_equal_a_plain_scorer(labelled, awkward):
    docs, labels = labelled
    model = toxicity.fit(docs.where(~held_out()), labels)
    assert np.abs(model.weights).max() > 0.5
    for df in (docs.where("doc_id < 60"), awkward.where("length(text) < 20000 OR text IS NULL")):
        for r in toxicity.score(df.select("doc_id", "text"), model, keep=("text",)).collect():
            assert abs(r.score - plain_score(model, r.text)) < 1e-9


def test_one_class_is_no_evidence(spark, labelled):
    docs, labels = labelled
    for only in (0, 1):
        model = toxicity.fit(docs, labels.where(f"toxic = {only}"))
        assert {(r.score, r.predicted) for r in toxicity.score(docs, model).collect()} == {(0.0, 0)}
        assert toxicity.accepted(docs, model).count() == docs.count()


def test_a_hot_text_counts_once(spark, labelled):
    """A third of all labelled rows are copies of one clean text: what is learned and brought to the driver stays the same."""
    docs, labels = labelled
    text = docs.where("doc_id = 1").first().text
    hot = spark.range(400).selectExpr("id + 10000 AS doc_id").withColumn("text", F.lit(text))
    more = labels.unionByName(hot.selectExpr("doc_id", "0 AS toxic"))
    sample, _, _ = toxicity._sample(docs.unionByName(hot), more, toxicity.SAMPLE_CHARS)
    assert sample.where(F.col("text") == text).count() == 1
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs.unionByName(hot), more)
    assert np.array_equal(a.grams, b.grams) and np.allclose(a.weights, b.weights) and abs(a.base - b.base) < 1e-9


def test_every_sentence_and_term_is_penalised(spark, labelled):
    """Weights of one group's n-grams are held down although it is named only in late sentences of toxic texts."""
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        parts = [prose(rng, words=8) for _ in range(6)]
        if toxic:
            parts[0] = "wretch " + parts[0]
            parts[5] = "sikh " + parts[5]
        docs.append((i, " ".join(parts)))
        labels.append((i, int(toxic)))
    model = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    f = model.filter()
    neutral = prose(rng, words=12)
    assert model.score("sikh " + neutral, f) < 0.3 <= model.score("wretch " + neutral, f)


def test_toxicity_edge_cases(awkward, nothing, labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(awkward.drop("score"), model).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    kept = toxicity.accepted(awkward, model)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    none = toxicity.fit(nothing, labels)
    assert {r.predicted for r in toxicity.score(awkward.drop("score"), none, threshold=0.6).collect()} == {0}
    assert toxicity.score(nothing.drop("score"), model).count() == 0


def test_share_below_one_in_a_million_keeps_texts(spark):
    docs = spark.range(4_000_000).selectExpr("id AS doc_id", "CAST(id AS STRING) AS text")
    sample, texts, toxic = toxicity._sample(docs, docs.selectExpr("doc_id", "CAST(doc_id % 5 = 0 AS INT) AS toxic"), 25)
    assert (texts, toxic) == (4_000_000, 800_000)
    assert 0 < sum(len(r.text) for r in sample.collect()) < 250


def test_queries_on_the_small_tables(spark):
    n = table(spark, SF, "documents").count()
    out = queries.QUERIES["op1_toxicity"](spark, SF)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == n
    out = queries.QUERIES["op2_language_filters"](spark, SF)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"] and out.count() == n
    truth = {r.doc_id: r.lang for r in table(spark, SF, "documents").collect()}
    rows = [r for r in out.collect() if r.held_out]
    assert sum(truth[r.doc_id] == r.lang_pred for r in rows) >= 0.9 * len(rows)
