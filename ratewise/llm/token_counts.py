"""Token counts of whole texts by overlap resynchronisation.

A short text is encoded at once. A huge one is cut into overlapping chunks
that become rows of their own, so that many tasks share it. Each chunk is
encoded with offsets and reports the token starts inside its two overlaps.
Neighbouring chunks are spliced at a start that both found, with the same
token there, right after white space: the tokenizer never merges across white
space, so whatever precedes such a start cannot change what follows it. Where
a pair has no such start (a stretch without white space), its document goes
another round with chunks and overlaps four times as wide; at last one chunk
holds it all.

Null or empty texts have 0 tokens and 0 bytes; repeated rows and null ids are
kept, each with its own count; columns besides ``doc_id`` and ``text`` are
ignored whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import steps, stored
from ratewise.llm.vocab import WHITE_SPACE, load_json_tokenizer, word_ids

CHUNK_CHARS, OVERLAP_CHARS, WIDEN = 16_384, 512, 4
TOKEN_LIMIT = 2048

_AFTER_SPACE = re.compile(f"(?<=[{WHITE_SPACE}])[^{WHITE_SPACE}]")


def _short(path: str):
    def run(batches):
        memo = word_ids(path)
        for batch in batches:
            for b in steps([batch], "text"):
                ids = memo.encode([t or "" for t in b.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("n_bytes"), pa.array([len(x) // 4 for x in ids], pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"])
    return run


def _cut(chunk: int, overlap: int):
    """Rows of one long text: chunk k covers [k * stride, k * stride + chunk)."""
    stride = chunk - overlap

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                text = row["text"]
                n = max(1, -(-(len(text) - overlap) // stride))
                for k in range(n):
                    yield pa.RecordBatch.from_pylist(
                        [{"uid": row["uid"], "k": k, "last": k == n - 1, "piece": text[k * stride:k * stride + chunk]}],
                        schema=pa.schema([("uid", pa.int64()), ("k", pa.int64()), ("last", pa.bool_()), ("piece", pa.string())]))
    return run


def _starts(piece: str, enc, low: int, high: int):
    """(char, token index, id) of tokens that start right after white space inside [low, high)."""
    found = ((m.start(), enc.char_to_token(m.start())) for m in _AFTER_SPACE.finditer(piece, max(low, 1), high))
    ids = enc.ids
    return [(c, i, ids[i]) for c, i in found if i is not None]


def _encode(path: str, chunk: int, overlap: int):
    """Per chunk: its token count, and the safe token starts in its left and right overlap (chars from the overlap's begin)."""
    stride = chunk - overlap
    start = pa.struct([("at", pa.int64()), ("id", pa.int64())])
    schema = pa.schema([("uid", pa.int64()), ("k", pa.int64()), ("last", pa.bool_()), ("n", pa.int64()),
                        ("left", pa.list_(start)), ("left_index", pa.list_(pa.int64())),
                        ("right", pa.list_(start)), ("right_index", pa.list_(pa.int64()))])

    def run(batches):
        tok = load_json_tokenizer(path)
        for batch in batches:
            for row in batch.to_pylist():
                piece = row["piece"]
                enc = tok.encode(piece, add_special_tokens=False)
                out = {"uid": row["uid"], "k": row["k"], "last": row["last"], "n": len(enc.ids)}
                for side, low, high, used in (("left", 0, overlap, row["k"] > 0), ("right", stride, stride + overlap, not row["last"])):
                    found = _starts(piece, enc, low, min(high, len(piece))) if used else []
                    out[side] = [{"at": c - low, "id": t} for c, _, t in found]
                    out[f"{side}_index"] = [i for _, i, _ in found]
                yield pa.RecordBatch.from_pylist([out], schema=schema)
    return run


def _splice(chunks: DataFrame) -> DataFrame:
    """(uid, n_tokens): n_tokens is null where some neighbours share no safe start.

    A document's count is the last chunk's, plus for each pair of neighbours
    the tokens before the splice in the left one less those in the right one.
    """
    left = chunks.where(~F.col("last")).select("uid", (F.col("k") + 1).alias("k"), "right", "right_index")
    right = chunks.where(F.col("k") > 0).select("uid", "k", "left", "left_index")
    common = F.array_intersect("right", "left")
    pair = left.join(right, ["uid", "k"]).withColumn("common", common).withColumn(
        "splice", F.get("common", F.floor(F.size("common") / 2).cast("int")))
    at = lambda side: F.get(f"{side}_index", (F.array_position(side, F.col("splice")) - 1).cast("int"))
    shift = pair.select("uid", F.col("splice").isNull().cast("int").alias("open"),
                        F.coalesce(at("right") - at("left"), F.lit(0)).alias("n"))
    ends = chunks.where("last").select("uid", F.lit(0).alias("open"), "n")
    total = ends.unionByName(shift).groupBy("uid").agg(F.sum("n").alias("n"), F.max("open").alias("open"))
    return total.select("uid", F.when(F.col("open") == 0, F.col("n")).alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS,
                 limit: int = TOKEN_LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row; ``tokenizer`` is the path of a tokenizers file."""
    if not 0 < overlap < chunk:
        raise ValueError("overlap must be positive and less than chunk")
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    is_long = F.coalesce(F.length("text"), F.lit(0)) > chunk
    done = rows.where(~is_long).mapInArrow(_short(tokenizer), f"doc_id {doc_type}, n_bytes long, n_tokens long")

    long_rows = rows.withColumn("uid", F.monotonically_increasing_id()).where(is_long)
    pending = stored(long_rows, "long-texts")
    while not pending.isEmpty():
        parts = (pending.select("uid", "text").mapInArrow(_cut(chunk, overlap), "uid long, k long, last boolean, piece string")
                 .repartition("uid", "k"))
        starts = "array<struct<at:long,id:long>>"
        chunks = stored(parts.mapInArrow(
            _encode(tokenizer, chunk, overlap),
            f"uid long, k long, last boolean, n long, left {starts}, left_index array<long>, right {starts}, right_index array<long>"),
            "chunk-starts")
        counted = stored(_splice(chunks), "spliced")
        joined = pending.join(counted, "uid")
        done = done.unionByName(joined.where(F.col("n_tokens").isNotNull()).select("doc_id", "n_bytes", "n_tokens"))
        left_over = counted.where(F.col("n_tokens").isNull())
        if left_over.isEmpty():
            break
        pending = stored(pending.join(left_over.select("uid"), "uid"), "long-texts")
        chunk, overlap = chunk * WIDEN, overlap * WIDEN
    return done.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
