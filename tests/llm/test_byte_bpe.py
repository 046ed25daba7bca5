import hashlib
from collections import Counter

import public_tokenizers
import pytest
from llm_fixtures import awkward, nothing  # noqa: F401
import tiktoken

from ratewise.llm import byte_bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})


def test_ids_and_bytes_equal_the_library(spark, awkward, library):
    odd = spark.createDataFrame([(100, "a\x1cb \x1f c\x85d   x's 'sx  \n\n  y"), (101, " <|endoftext|> \xa0\xa0 . "), (102, "\0")], "doc_id long, text string")
    docs = awkward.select("doc_id", "text").unionByName(odd)
    got = byte_bpe.decode(byte_bpe.encode(docs, PATH, PATTERN, buckets=3), PATH).collect()
    want = Counter((r.doc_id, tuple(library.encode_ordinary(r.text or "")), (r.text or "").encode()) for r in docs.collect())
    assert Counter((r.doc_id, tuple(r.ids), bytes(r.decoded)) for r in got) == want


def test_digest(awkward, library):
    rows = byte_bpe.decoded_digest(byte_bpe.encode(awkward, PATH, PATTERN), PATH).collect()
    ids = library.encode_ordinary("日本語 ñandú 😀 it's")
    own = next(r for r in rows if r.doc_id == 8)
    assert own.n_tokens == len(ids)
    assert own.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert own.decoded_sha256 == hashlib.sha256("日本語 ñandú 😀 it's".encode()).hexdigest()
    assert next(r for r in rows if r.doc_id == 1).ids_sha256 == hashlib.sha256(b"").hexdigest()


def test_null_ids_decode_to_null(spark):
    ids = spark.createDataFrame([(1, [0, 255, 300]), (2, None), (3, [])], "doc_id long, ids array<int>")
    rows = {r.doc_id: r.decoded for r in byte_bpe.decode(ids, PATH).collect()}
    by_id = {i: t for t, i in byte_bpe.read_ranks(PATH).items()}
    assert rows == {1: by_id[0] + by_id[255] + by_id[300], 2: None, 3: b""}


def test_nothing(nothing):
    assert byte_bpe.decoded_digest(byte_bpe.encode(nothing, PATH, PATTERN), PATH).count() == 0
