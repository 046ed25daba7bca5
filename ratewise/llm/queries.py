"""Queries and SQL of the corpus operators, by name."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ratewise.llm import byte_bpe, collocations, conversations, fingerprints, katz, language, ngram_join, packing, secrets, token_counts, toxicity, vector_join, warc
from ratewise.llm.common import held_out, table

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs.where(~held_out()), table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op2_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(~held_out()))
    return language.predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))


def op4_lattice_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join.join_vectors(table(spark, sf_dir, "embeddings"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(BYTE_RANKS)
    ids = byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return byte_bpe.decoded_digest(ids, ranks)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(spark, table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(table(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op11_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(conversations.damage(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity, op2_language_filters, op3_best_fit_packing, op4_lattice_join, op5_byte_bpe, op6_warc, op7_ngram_join, op8_fingerprints, op9_token_counts, op10_secret_scan,
                             op11_katz, op12_collocations, op13_conversation_repair)
}

#: RFC 4648 base32 of a SHA-1: five hexadecimal digits make four characters (fixed alphabet).
_BASE32 = """array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS BIGINT)
        >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '')"""

SQL: dict[str, str] = {
    "op4_lattice_join": """
        WITH RECURSIVE v AS (
            SELECT vec_id, embedding::DOUBLE[] AS x, embedding IS NOT NULL AND len(embedding) > 0
                AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
                AND len(list_filter(embedding, lambda e: e <> 0)) > 0 AS ok FROM embeddings),
        l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.ok AND b.ok AND len(a.x) = len(b.x)
              WHERE list_cosine_similarity(a.x, b.x) >= 0.95),
        n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
        r(vec_id, other) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.vec_id, l.b FROM r JOIN l ON l.a = r.other),
        c AS (SELECT vec_id, min(other) AS component_id FROM r GROUP BY vec_id)
        SELECT c.vec_id, coalesce(n.n, 0) AS n_links, component_id, c.vec_id = component_id AS kept FROM c LEFT JOIN n ON n.a = c.vec_id""",
    "op6_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
             f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
        SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM p JOIN f USING (h)""",
    "op7_ngram_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
        n AS (SELECT w.doc_id, count(g) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id),
        c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
        l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
        r(doc_id, other) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other)
        SELECT r.doc_id, n.n AS n_shingles, min(other) AS component_id FROM r JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id, n.n""",
    "op12_collocations": r"""
        WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM t),
        w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
        n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
        k AS (SELECT unnest([1, 2, 3, 4]) AS k),
        g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM w, k WHERE len(w) >= k),
        f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
        c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS x FROM f WHERE k > 1),
        s AS (SELECT lang, a, unnest(list_transform(range(1, c.k - j.k + 2), lambda i: array_to_string(x[i:i + j.k - 1], ' '))) AS phrase
              FROM c JOIN k j ON j.k > 1 AND j.k < c.k),
        m AS (SELECT lang, phrase, max(a) AS longest FROM s GROUP BY ALL),
        v AS (SELECT c.* FROM c LEFT JOIN m USING (lang, phrase) WHERE longest IS NULL OR 100::HUGEINT * longest < 80::HUGEINT * a),
        d AS (SELECT v.lang, v.phrase, a, j.k, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f + y.f) AS score FROM v JOIN k j ON j.k < v.k
              JOIN f x ON x.lang = v.lang AND x.phrase = array_to_string(v.x[1:j.k], ' ')
              JOIN f y ON y.lang = v.lang AND y.phrase = array_to_string(v.x[j.k + 1:], ' ')),
        b AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
        SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM o JOIN n USING (lang) WHERE rank <= 2000""",
}
