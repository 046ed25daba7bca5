import hashlib
import random
import re
from collections import Counter

import pytest
from llm_fixtures import SF, awkward, nothing  # noqa: F401
from pyspark.sql import functions as F

from ratewise.llm import fingerprints, queries
from ratewise.llm.common import table


def plain_edits(rows):
    """(doc_id, n_chars, edited) by ascending id; ids must be distinct."""
    rows = sorted(rows)
    out = {}
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        out[i] = (len(text), text[:len(text) - half] + after[:half], after)
    return out


def units(text):
    return {u for u in re.split(r"(?<=[.!?\n])", text) if u}


@pytest.mark.parametrize("bucket_bytes", [20_000, 8 << 20])
def test_edits_and_likeness(spark, bucket_bytes):
    docs = table(spark, SF, "documents")
    want = plain_edits([(r.doc_id, r.text or "") for r in docs.collect()])
    rows = fingerprints.fingerprint_edits(docs, bucket_bytes).collect()
    assert len(rows) == len(want)
    errors = []
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        n, edited, after = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        for near, other in ((r.near_edited, edited), (r.near_next, after)):
            assert 0 <= near <= 1
            a, b = units(texts[r.doc_id]), units(other)
            errors.append(abs(near - (2 * len(a & b) / (len(a) + len(b)) if a or b else 1)))
    assert sum(errors) / len(errors) < 0.1
    by_text = Counter((texts[r.doc_id], r.fingerprint) for r in rows)
    assert len(by_text) == len({t for t, _ in by_text}) == len({f for _, f in by_text})


def test_order_does_not_matter_and_parts_add_up(spark):
    texts = {"whole": "One.Two.Three.", "turned": "Three.One.Two.", "part": "One.", "rest": "Two.Three.", "twice": "One.One."}
    df = spark.createDataFrame(list(texts.items()), "name string, text string")
    f = {r["name"]: r["f"] for r in fingerprints.with_fingerprint(df, "text", "f").collect()}
    assert f["whole"] == f["turned"] and f["part"] != f["twice"]
    both = fingerprints.with_fingerprint(df, "text", "f").where("name IN ('part', 'rest')").groupBy().pivot("name", ["part", "rest"]).agg(F.first("f"))
    added = both.select(fingerprints.combine(F.col("part"), F.col("rest")).alias("f"), "rest")
    assert added.first()["f"] == f["whole"]
    assert added.select(fingerprints.combine(F.col("f"), F.col("rest"), -1).alias("f")).first()["f"] == f["part"]


def words(n, seed):
    rng = random.Random(seed)
    return [f"w{rng.randrange(1 << 40):x}" for _ in range(n)]


@pytest.mark.parametrize("n", [600, 2000, 4000])
def test_likeness_of_half_edited_texts_without_sentence_signs(spark, n):
    """Close to the Dice of the words, though no sign says where a sentence ends."""
    a, errors = [words(n, seed) for seed in range(8)], []
    pairs = [(" ".join(x), " ".join(x[:n // 2] + y[n // 2:]), " ".join(["in", "front", *x])) for x, y in zip(a, a[1:] + a[:1])]
    df = spark.createDataFrame(pairs, "text string, half string, front string")
    for c in ("text", "half", "front"):
        df = fingerprints.with_fingerprint(df, c, f"f_{c}")
    like = lambda c: fingerprints.likeness(F.col("f_text"), F.col(f"f_{c}")).alias(c)
    got = df.select(like("half"), like("front")).collect()
    assert all(abs(r.half - 0.5) <= 0.25 and r.front >= 0.9 for r in got)
    assert sum(abs(r.half - 0.5) for r in got) / len(got) <= 0.1


def test_long_stretches_are_cut_by_content(spark):
    rng = random.Random(5)
    spaced = " ".join(words(900, 1))
    solid = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(20_000))
    texts = [spaced, solid, spaced + "\x01" + solid, "short.\x01\x02b", "a" * 5000, "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r.i: r.u for r in df.select("i", fingerprints.paragraphs(F.col("text")).alias("u")).collect()}
    back = lambda u: "".join(u).replace("\x02a", "\x01").replace("\x02b", "\x02")
    assert all(back(got[i]) == (t or "") for i, t in enumerate(texts))
    assert len(got[0]) > 80 and len(got[1]) > 150 and len(got[4]) in (1, 5000) and not got[5] and not got[6]
    later = df.where("i < 2").select("i", fingerprints.paragraphs(F.concat(F.lit("xyz "), "text")).alias("u")).collect()
    assert all(len(set(got[r.i]) & set(r.u)) >= len(set(got[r.i])) - 3 for r in later)


def test_sums_equal_a_plain_sum(spark):
    """Lanes and dense components against sums in plain Python over the same hashes."""
    docs = table(spark, SF, "documents").limit(60)
    rows = fingerprints.with_fingerprint(docs, "text", "f")
    rows = rows.withColumn("h", F.transform(fingerprints.paragraphs(F.col("text")), lambda p: F.xxhash64(p))).collect()
    for r in rows:
        lanes = [0] * (fingerprints.LEVELS * fingerprints.LANES)
        for h in r.h or []:
            h %= 1 << 64
            level = next((k for k in range(fingerprints.LEVELS - 1) if h >> 2 * k & 3), fingerprints.LEVELS - 1)
            at = level * fingerprints.LANES + (h >> 16) % fingerprints.LANES
            lanes[at] = (lanes[at] + ((h >> 32) % (1 << 14) | 1)) % (1 << 14)
        held = [x >> 15 * i & (1 << 14) - 1 for x in r.f.lanes for i in range(4)]
        assert held == lanes and r.f.n == len(r.h)


def test_awkward_rows(awkward, nothing):
    rows = fingerprints.fingerprint_edits(awkward, 5000).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in awkward.collect())
    prints = {r.doc_id: r.fingerprint for r in rows}
    assert prints[5] == prints[6] and prints[1] == prints[2] != prints[3]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert fingerprints.fingerprint_edits(nothing).count() == 0


def test_a_single_document_is_its_own_next(spark):
    row = fingerprints.fingerprint_edits(spark.createDataFrame([(4, "abc. de")], "doc_id long, text string")).first()
    assert row.edited_sha256 == hashlib.sha256(b"abc.abc").hexdigest() and row.near_next == 1.0


def test_main_path_is_native(spark):
    plan = queries.QUERIES["op8_fingerprints"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
