"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Texts are exploded into pre-tokens with positions, block by block (some
megabytes of rows): a block is its distinct words plus, per position, the
number of the word there, counted by first occurrence. Words travel to the task that owns their hash, where
each distinct word is encoded once whatever the number of blocks that have it;
the ids travel back to the block and are put in place by position. A frequent
word thus moves once per block, never once per occurrence, and no key gathers
more than the corpus' blocks. One lineage with two shuffles, nothing collected.

Decoding looks each id up in the token-byte table (the vocabulary: a bounded
broadcast) and joins the bytes in order.

Null texts count as empty and have no ids. Repeated rows and null ids are kept,
each encoded for itself. Other columns are ignored whatever their names. An
empty table gives an empty result. The pattern must match every character.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import zlib
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from ratewise.llm.common import steps
from ratewise.llm.vocab import WHITE_SPACE

#: Distinct words that one task remembers; when full it starts anew (more work, same result).
MEMO_WORDS = 1_000_000
#: Rows and bytes of text that one block holds at most; the larger, the fewer times a word moves.
BLOCK_ROWS, BLOCK_BYTES = 10_000, 12 << 20
_ONE_BYTE = 192  # codes of a sequence below this take one byte
_SEQUENCE = -1  # slot of a block's sequence row; words of bucket b have slot b


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


@functools.lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


@functools.lru_cache(maxsize=4)
def _splitter(pattern: str):
    """The pattern with white space as the encoder's regex engine defines it."""
    import regex

    own = pattern.replace(r"[^\s", f"[^{WHITE_SPACE}").replace(r"\S", f"[^{WHITE_SPACE}]").replace(r"\s", f"[{WHITE_SPACE}]")
    return regex.compile(own)


def _pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, compressed by byte planes."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(numbers).to_bytes(4, "little") + pa.Codec("zstd", 3).compress(planes.tobytes(), asbytes=True)


def _unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    planes = pa.Codec("zstd", 3).decompress(data[4:], 4 * n, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, n).T).view("<u4").reshape(-1)


def _by_count(counts: np.ndarray) -> np.ndarray:
    """Words that occur more than once, the most frequent first."""
    often = np.flatnonzero(counts > 1)
    return often[np.argsort(-counts[often], kind="stable")]


def _pack_sequence(sequence: np.ndarray, words: int) -> bytes:
    """Word numbers by position, numbered by first occurrence.

    A first occurrence is always the next number, so 0 stands for it; another
    is 1 plus the word's place by count, which the counts tell. Small codes
    take one byte; of larger ones that byte has the high part.
    """
    counts = np.bincount(sequence, minlength=words)
    ranked = _by_count(counts)
    place = np.zeros(words, np.int64)
    place[ranked] = np.arange(1, len(ranked) + 1)
    first = np.diff(np.maximum.accumulate(sequence.astype(np.int64)), prepend=-1) > 0
    code = np.where(first, 0, place[sequence])
    high = np.minimum((code - _ONE_BYTE) >> 10, 254 - _ONE_BYTE)
    lead = np.where(code < _ONE_BYTE, code, _ONE_BYTE + high).astype(np.uint8)
    rest = (code - _ONE_BYTE - (high << 10))[code >= _ONE_BYTE]
    parts = [_pack(counts), _pack(rest), pa.Codec("zstd", 3).compress(lead.tobytes(), asbytes=True)]
    return b"".join([np.array([len(parts[0]), len(parts[1]), len(lead)], "<i8").tobytes(), *parts])


def _unpack_sequence(data: bytes) -> np.ndarray:
    a, b, n = np.frombuffer(data, "<i8", 3).tolist()
    ranked = _by_count(_unpack(data[24:24 + a]).astype(np.int64))
    code = np.frombuffer(pa.Codec("zstd", 3).decompress(data[24 + a + b:], n, asbytes=True), np.uint8).astype(np.int64)
    large = code >= _ONE_BYTE
    code[large] = _ONE_BYTE + ((code[large] - _ONE_BYTE) << 10) + _unpack(data[24 + a:24 + a + b])
    first = code == 0
    sequence = np.empty(len(code), np.int64)
    sequence[first] = np.arange(np.count_nonzero(first))
    sequence[~first] = ranked[code[~first] - 1]
    return sequence


def _pack_words(words: list[bytes]) -> tuple[bytes, bytes]:
    joined = b"".join(words)
    return _pack(np.array([len(w) for w in words], dtype="<u4")), len(joined).to_bytes(8, "little") + pa.Codec("zstd", 3).compress(joined, asbytes=True)


def _unpack_words(lengths: bytes, data: bytes) -> list[bytes]:
    joined = pa.Codec("zstd", 3).decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)
    ends = np.cumsum(_unpack(lengths)).tolist()
    return [joined[a:b] for a, b in zip([0, *ends], ends)]


def _explode(pattern: str, buckets: int, schema: pa.Schema):
    def run(batches):
        from pyspark import TaskContext

        find = _splitter(pattern).findall
        block = TaskContext.get().partitionId() << 32
        for b in steps(batches, "text", BLOCK_ROWS, BLOCK_BYTES):
            number = defaultdict(count().__next__)  # words by first occurrence
            parts, counts = [], []
            for text in b.column("text").to_pylist():
                found = find(text or "")
                counts.append(len(found))
                parts.append(np.fromiter(map(number.__getitem__, found), np.uint32, len(found)))
            sequence, words = np.concatenate(parts), list(number)
            bucket = np.array([zlib.crc32(w.encode()) % buckets for w in words], dtype=np.uint32)
            own: list[list[str]] = [[] for _ in range(buckets)]
            for w, k in zip(words, bucket.tolist()):
                own[k].append(w)
            rows = [{"key": block, "block": block, "slot": _SEQUENCE, "lengths": _pack(bucket), "data": _pack_sequence(sequence, len(words)),
                     "doc_ids": b.column("doc_id").to_pylist(), "counts": counts}]
            for slot, words in enumerate(own):
                if words:
                    lengths, data = _pack_words([w.encode() for w in words])
                    rows.append({"key": slot, "block": block, "slot": slot, "lengths": lengths, "data": data,
                                 "doc_ids": [], "counts": []})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
            block += 1
    return run


def _encode_words(path: str, pattern: str, schema: pa.Schema):
    def run(batches):
        encode, memo = _encoding(path, pattern).encode_ordinary, {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["slot"] != _SEQUENCE:
                    words = _unpack_words(row["lengths"], row["data"])
                    if len(memo) > MEMO_WORDS:
                        memo = {}
                    for w in words:
                        if w not in memo:
                            memo[w] = np.array(encode(w.decode()), dtype="<u4").tobytes()
                    ids = [memo[w] for w in words]
                    row["lengths"] = _pack(np.array([len(x) // 4 for x in ids], dtype="<u4"))
                    row["data"] = _pack(np.frombuffer(b"".join(ids), "<u4"))
                yield pa.RecordBatch.from_pylist([row], schema=schema)
    return run


def _reassemble(doc_type: pa.DataType):
    """One block: its words' ids, by bucket, put in place by position; a row per document."""
    schema = pa.schema([("doc_id", doc_type), ("ids", pa.list_(pa.int32()))])

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["slot"])
        sequence, words = rows[0], rows[1:]
        lengths = np.concatenate([*(_unpack(r["lengths"]) for r in words), np.zeros(0, "<u4")]).astype(np.int64)
        ids = np.concatenate([*(_unpack(r["data"]) for r in words), np.zeros(0, "<u4")]).astype("<i4")
        starts = np.cumsum(lengths) - lengths
        bucket = _unpack(sequence["lengths"])
        place = np.empty(len(bucket), np.int64)  # of each word when words are listed by bucket
        place[np.argsort(bucket, kind="stable")] = np.arange(len(bucket))
        at = place[_unpack_sequence(sequence["data"])]
        n = lengths[at]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        flat = ids[np.repeat(starts[at] - (ends - n), n) + np.arange(total)]
        cut = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(np.array(sequence["counts"], dtype=np.int64))])]
        lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(flat, pa.int32()))
        return pa.Table.from_arrays([pa.array(sequence["doc_ids"], doc_type), lists], schema=schema)

    return run


def encode(docs: DataFrame, ranks: str, pattern: str, buckets: int | None = None) -> DataFrame:
    """(doc_id, ids array<int>) of every row's whole text; ``ranks``: path of a rank file.

    ``buckets`` (default: the shuffle partitions) is the number of tasks that words are dealt to.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    doc_field = docs.select("doc_id").schema[0]
    doc_type = to_arrow_type(doc_field.dataType)
    schema = pa.schema([("key", pa.int64()), ("block", pa.int64()), ("slot", pa.int32()), ("lengths", pa.binary()), ("data", pa.binary()),
                        ("doc_ids", pa.list_(doc_type)), ("counts", pa.list_(pa.int64()))])
    simple = doc_field.dataType.simpleString()
    fields = f"key long, block long, slot int, lengths binary, data binary, doc_ids array<{simple}>, counts array<long>"
    exploded = docs.select("doc_id", "text").mapInArrow(_explode(pattern, buckets, schema), fields)
    encoded = exploded.repartition(buckets, "key").mapInArrow(_encode_words(ranks, pattern, schema), fields)
    return encoded.groupBy("block").applyInArrow(_reassemble(doc_type), f"doc_id {simple}, ids array<int>")


def _joined(table: list[bytes], lists: pa.ListArray) -> pa.BinaryArray:
    """Per list of ids the concatenation of their table entries; null for null."""
    width = np.array([len(t) for t in table], dtype=np.int64)
    begin = np.cumsum(width) - width
    data = np.frombuffer(b"".join(table), np.uint8)
    ids = lists.flatten().to_numpy(zero_copy_only=False)
    n = width[ids]
    ends = np.concatenate([[0], np.cumsum(n)])
    out = data[np.repeat(begin[ids] - ends[:-1], n) + np.arange(ends[-1])]
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    cut = ends[np.concatenate([[0], np.cumsum(sizes)])]
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(cut.astype(np.int64).tobytes()), pa.py_buffer(out)])
    return pc.if_else(lists.is_valid(), found, pa.scalar(None, pa.large_binary())).cast(pa.binary())


def _token_table(ranks: str) -> list[bytes]:
    """Token bytes by id; ids that no token has are empty."""
    by_id = {i: t for t, i in read_ranks(ranks).items()}
    return [by_id.get(i, b"") for i in range(max(by_id, default=-1) + 1)]


def _parts(batches):
    """Batches of at most about a million ids, one row at least."""
    for b in batches:
        sizes = pc.fill_null(pc.list_value_length(b.column("ids")), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and held + n > 1_000_000:
                yield b.slice(start, i - start)
                start, held = i, 0
            held += n
        if b.num_rows:
            yield b.slice(start)


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """The rows of ``encoded`` with ``decoded`` binary: the bytes of ``ids`` in order. Null ids decode to null."""
    shared = encoded.sparkSession.sparkContext.broadcast(_token_table(ranks))  # the vocabulary
    names = encoded.columns

    def run(batches):
        for b in _parts(batches):
            yield pa.RecordBatch.from_arrays([*b.columns, _joined(shared.value, b.column("ids"))], [*names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{fields}, decoded binary")


def decoded_digest(encoded: DataFrame, ranks: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): ids decoded and digested where they are, without moving the texts on."""
    shared = encoded.sparkSession.sparkContext.broadcast(_token_table(ranks))  # the vocabulary
    rows = encoded.select("doc_id", "ids")

    def run(batches):
        table = shared.value
        decimal = [b"%d," % i for i in range(len(table))]
        for b in _parts(batches):
            ids = b.column("ids")
            text = [hashlib.sha256(x[:-1]).hexdigest() for x in _joined(decimal, ids).to_pylist()]
            data = [hashlib.sha256(x).hexdigest() for x in _joined(table, ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pc.list_value_length(ids).cast(pa.int64()), pa.array(text), pa.array(data)],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    simple = encoded.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {simple}, n_tokens long, ids_sha256 string, decoded_sha256 string")
