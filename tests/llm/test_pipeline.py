import corpus_pipeline
import pytest
from llm_fixtures import SF, awkward, nothing  # noqa: F401
from pyspark.sql import functions as F
from test_joins import plain_join
from test_secrets_warc import plain_spans

from ratewise.llm import language, secrets, toxicity
from ratewise.llm.common import held_out, stored, table


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, docs, stored(stage(spark, docs, SF), f"test-{name}")))
        docs = out[-1][2]
    return out


def test_stages_are_the_dealt_ones(stages):
    assert [n for n, _, _ in stages] == ["language", "toxicity", "near_duplicates", "secrets", "packing"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns


def test_language_and_toxicity_keep_what_their_models_accept(spark, stages):
    _, before, after = stages[0]
    model = language.fit(before.where(~held_out()))
    want = {r.doc_id for r in language.predict(before, model).collect() if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_LANGUAGE_SCORE}
    assert {r.doc_id for r in after.collect()} == want
    _, before, after = stages[1]
    model = toxicity.fit(before.where(~held_out()), table(spark, SF, "labels"))
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in toxicity.score(before, model).collect() if r.score < toxicity.THRESHOLD}


def test_one_document_of_each_group_stays(stages):
    _, before, after = stages[2]
    groups = plain_join([(r.doc_id, r.text) for r in before.collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, n, c in groups if i == c)
    assert after.count() < before.count()


def test_secrets_are_replaced_and_nothing_else(stages):
    _, before, after = stages[3]
    old, new = {r.doc_id: r for r in before.collect()}, {r.doc_id: r for r in after.collect()}
    assert old.keys() == new.keys()
    for i, row in old.items():
        spans = plain_spans(row.text, secrets.RULES)
        assert new[i].text == (secrets.redact(row.text, spans) if spans else row.text)
        assert not plain_spans(new[i].text, secrets.BASE_RULES)
        assert new[i].n_chars == (len(new[i].text) if spans else row.n_chars)


def test_all_documents_are_packed(stages):
    _, before, after = stages[4]
    assert {r.doc_id for r in after.select("doc_id").distinct().collect()} == {r.doc_id for r in before.collect()}
    whole = after.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m"))
    assert whole.where("n <> m").count() == 0


def test_run(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == stages[-1][2].columns and got.count() == stages[-1][2].count()


def test_stages_take_awkward_and_empty_tables(spark, awkward, nothing):
    for docs in (awkward, nothing):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            columns = docs.columns
            docs = stored(stage(spark, docs, SF), f"awkward-{name}")
            assert docs.columns == columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.count()


def test_toxicity_stage_keeps_all_without_evidence(spark, awkward, tmp_path, monkeypatch):
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(20, 40)], "doc_id long, toxic int")
    labels.where("doc_id < 0").write.parquet(f"{tmp_path}/none/labels.parquet")
    labels.write.parquet(f"{tmp_path}/some/labels.parquet")
    kept = corpus_pipeline.remove_toxic(spark, awkward, f"{tmp_path}/none")
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    model = toxicity.fit(awkward, labels.where("doc_id < 0"))
    assert {(r.score, r.predicted) for r in toxicity.score(awkward.drop("score"), model).collect()} == {(0.0, 0)}
    monkeypatch.setattr(toxicity.fit, "__defaults__", (0, *toxicity.fit.__defaults__[1:]))  # no text is sampled
    kept = corpus_pipeline.remove_toxic(spark, awkward, f"{tmp_path}/some")
    assert kept.count() == awkward.count()
