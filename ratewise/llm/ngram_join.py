"""Exact Jaccard self-join of documents on word shingles.

A document is the set of its distinct shingles (64-bit hashes of five
lower-cased words); two link if their Jaccard similarity reaches the
threshold. Equal sets are one class. The join finds all links' components
without comparing all pairs and without emitting the pairs inside a group:

1. Prefix keys. Under any one order of shingles, linked sets share a shingle
   among their first n - ceil(t n) + 1. The order puts shingles counted as
   frequent over the whole corpus last (a bounded list, rarest first) and is by
   hash otherwise; it decides only how much work there is.
2. Size-banded tiles. Keys are dealt to buckets; sets with a common key meet in
   tiles of neighbouring size bands, outside of which sizes differ too much.
   Each tile proposes a star: one of its sets, chosen by key, with the others.
3. Every class has a hashed bitmap (parities of its shingles by bit). The
   differing bits of two bitmaps bound the overlap from above; pairs that
   cannot reach the threshold end there. The others get the exact intersection
   of their sorted arrays (48 bits of each hash travel).
4. Sets that verified links join already need no more comparison. Tiles whose
   sets still belong to several components compare all pairs across them,
   block by block, by bitmap, and name the sets that have a candidate at all; those get their arrays, and the tile
   intersects them exactly, likely links first, leaving out pairs that it has
   connected. It returns a spanning forest: no link is lost, and a group of n near
   copies never emits n * n rows.

Fewer words than a shingle has make one shingle of them all; a null text or one
without words has the empty set and links with nothing. Repeated rows are kept,
as are null ids (a component's id is its smallest non-null one; a null id alone
has a null component). Other columns are ignored whatever their names. An empty
table gives an empty result.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm.common import release, steps, stored
from ratewise.llm.components import components

WORDS, PERCENT = 5, 75
#: Keys that one bucket is meant to hold; sets of a key beyond which it is split; rows that are compared at a time; partners that one place takes.
BUCKET_KEYS, SPLIT, BLOCK, PARTNERS = 2_000_000, 4096, 256, 1000
#: Elements of the sets of a key beyond which it is split; rows of a bucket whose tiles are formed at a time.
SPLIT_ELEMENTS, TILE_ROWS = 2_000_000, 1 << 18
#: Shingles listed as frequent, at most; local counts below LOCAL are not reported; the list starts at FREQUENT.
MOST_FREQUENT, LOCAL, FREQUENT = 1 << 18, 3, 16
LEAST_BITS, MOST_BITS, FILTER_BITS, ORDERS, FIRST_KEYS = 1024, 1 << 16, 24, 8, 8

#: Bytes of text that are hashed at a time; the arrays fit the processor's cache.
TOGETHER = 1 << 17

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])
_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, _BASE, np.uint64))])


def _distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    return h[np.concatenate([[True], h[1:] != h[:-1]])] if len(h) else h


def _word_hashes(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, hash) of the words in lower-cased bytes."""
    inside = ~_SPACE[b]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    begin, size = edge[::2], edge[1::2] - edge[::2]
    if not len(begin):
        return begin, np.zeros(0, np.uint64)
    first = np.cumsum(size) - size
    place = np.arange(size.sum()) - np.repeat(first, size)
    value = (b[inside].astype(np.uint64) + np.uint64(1)) * _powers(1 << max(10, int(size.max()).bit_length()))[place]
    return begin, _mix(np.add.reduceat(value, first) + size.astype(np.uint64) * _STEP)


def _runs(word: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words."""
    h = np.full(len(word) - n + 1, n, np.uint64)
    for i in range(n):
        h = h * _BASE + word[i:len(word) - n + 1 + i]
    return _mix(h)


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its shingles; many texts are hashed at a time."""
    out: list[np.ndarray] = []
    data = [(t or "").encode("utf-8", "surrogatepass").translate(_LOWER) for t in texts]
    start = 0
    while start < len(data):
        end, size = start + 1, len(data[start])
        while end < len(data) and size + len(data[end]) < TOGETHER:
            size += len(data[end])
            end += 1
        own = data[start:end]
        begin, word = _word_hashes(np.frombuffer(b"\n".join(own), np.uint8))
        cut = np.concatenate([[0], np.searchsorted(begin, np.cumsum([len(d) + 1 for d in own]))])
        all_runs = _runs(word, words) if len(word) >= words else word[:0]
        for a, z in zip(cut[:-1].tolist(), cut[1:].tolist()):
            if z - a >= words:
                out.append(_distinct(all_runs[a:z - words + 1]))
            else:
                out.append(_runs(word[a:z], z - a) if z > a else word[:0])
        start = end
    return out


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of one text's shingles."""
    return shingle_sets([text], words)[0]


def pack_set(own: np.ndarray) -> bytes:
    """48 bits of each hash, as differences of the sorted array, compressed by byte planes."""
    short = _distinct(own >> np.uint64(16))
    planes = np.diff(short, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return len(short).to_bytes(4, "little") + pa.Codec("zstd", 1).compress(np.ascontiguousarray(planes.T).tobytes(), asbytes=True)


def unpack_set(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    planes = np.zeros((n, 8), np.uint8)
    planes[:, :6] = np.frombuffer(pa.Codec("zstd", 1).decompress(data[4:], 6 * n, asbytes=True), np.uint8).reshape(6, n).T
    return np.cumsum(planes.view("<u8").reshape(-1), dtype=np.uint64)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    joint = np.concatenate([a, b])
    joint.sort(kind="stable")  # two sorted runs: merged
    both = int(np.count_nonzero(joint[1:] == joint[:-1]))
    return 100 * both >= percent * (len(joint) - both)


def class_id(own: np.ndarray) -> int:
    """64-bit id of a set (order-free sums of two mixes of its elements)."""
    if not len(own):
        return 0
    total = np.array([_mix(own + _STEP).sum(dtype=np.uint64)]) * _BASE + np.uint64(len(own))
    return int(_mix(total ^ np.bitwise_xor.reduce(_mix(own * _STEP))).view(np.int64)[0])


def bitmap(own: np.ndarray) -> bytes:
    """Parity of the number of elements that hash to each bit; two to four bits an element, LEAST_BITS at least."""
    bits = max(LEAST_BITS, min(MOST_BITS, 2 << max(0, len(own) - 1).bit_length()))
    odd = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _folded(data: bytes, width: int) -> np.ndarray:
    """A bitmap at a smaller width (bytes): parities of the halves, quarters, ... add up."""
    return np.bitwise_xor.reduce(np.frombuffer(data, np.uint64).reshape(-1, width // 8), axis=0)


def differing(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Bits in which bitmaps differ, pair by pair, at the smaller width of each two."""
    width = np.minimum([len(x) for x in a], [len(x) for x in b]) if a else np.zeros(0, np.int64)
    out = np.zeros(len(a), np.int64)
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w).tolist()
        for i in range(0, len(at), BLOCK):
            part = at[i:i + BLOCK]
            x, y = (np.stack([_folded(side[k], w) for k in part]) for side in (a, b))
            out[part] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
    return out


def may_reach(n_a, n_b, differing, percent: int):
    """Whether sets of these sizes, whose bitmaps differ in so many bits, can be similar enough.

    Each differing bit needs an element that only one set has, so the overlap
    is at most (n_a + n_b - differing) / 2, and it must be percent / (100 +
    percent) of n_a + n_b at least.
    """
    return (n_a + n_b - differing) * (100 + percent) >= 2 * percent * (n_a + n_b)


def _prefix(n: int, percent: int) -> int:
    return n + (-percent * n // 100) + 1


def _band(n, percent: int):
    """Sets can link only within a band or between neighbouring ones."""
    return np.floor(np.log(n) / math.log(100 / percent) + 1e-9).astype(np.int64)


def _read_sets(docs: DataFrame) -> DataFrame:
    """Stored rows: (doc_id, cid, n, bits) per document; (null, shingle, -count, null) per shingle frequent in one task."""
    doc_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        held, size = [], 0

        def frequent():
            h, n = np.unique(np.concatenate(held), return_counts=True)
            h, n = h[n >= LOCAL], n[n >= LOCAL]
            return pa.RecordBatch.from_arrays([pa.nulls(len(h), arrow_id), pa.array(h.view(np.int64)), pa.array(-n.astype(np.int64)), pa.nulls(len(h), pa.binary())],
                                              ["doc_id", "cid", "n", "bits"])

        arrow_id, seen = None, set()
        release(memos=True)
        for b in steps(batches, "text"):
            arrow_id = b.column("doc_id").type
            sets = shingle_sets(b.column("text").to_pylist())
            ids = [class_id(s) for s in sets]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                                              pa.array([bitmap(s) for s in sets], pa.binary())], ["doc_id", "cid", "n", "bits"])
            for i, s in zip(ids, sets):
                if i not in seen:
                    seen.add(i)
                    held.append(s)
                    size += len(s)
            if size > 4_000_000:
                yield frequent()
                held, size, seen = [], 0, set()
        if held:
            yield frequent()

    return stored(docs.select("doc_id", "text").mapInArrow(run, f"doc_id {doc_type}, cid long, n long, bits binary"), "sets")


class _Order:
    """The global order of shingles: frequent ones last, by count; hashes otherwise."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        by_hash = np.argsort(hashes)
        self.hashes, self.counts = hashes[by_hash], counts[by_hash]

    def count(self, h: np.ndarray) -> np.ndarray:
        """Counts of frequent shingles, 0 for others."""
        if not len(self.hashes):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.counts[at], 0)

    def prefix(self, own: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """(shingles, counts) of the prefix of a set sorted by hash."""
        counts = self.count(own)
        first = np.argsort(counts, kind="stable")[:_prefix(len(own), percent)]
        return own[first], counts[first]


def _frequent(sets: DataFrame) -> _Order:
    found = (sets.where("n < 0").groupBy("cid").agg((-F.sum("n")).alias("count")).where(F.col("count") >= FREQUENT)
             .orderBy(F.desc("count"), "cid").limit(MOST_FREQUENT).toArrow())  # MOST_FREQUENT rows
    return _Order(found["cid"].to_numpy().view(np.uint64), found["count"].to_numpy().astype(np.int64))


_KEY = np.dtype([("key", "<u8"), ("cid", "<i8"), ("band", "<i2"), ("split", "?")])


def _pack_keys(rows: np.ndarray) -> bytes:
    """Rows of one bucket, those of a class next to each other: a class's id and band are written once, of a key 48 bits."""
    first = np.flatnonzero(np.concatenate([[True], rows["cid"][1:] != rows["cid"][:-1]]))
    counts = np.diff(np.append(first, len(rows))).astype("<u4")
    return b"".join([np.array([len(first), len(rows)], "<u4").tobytes(), rows["cid"][first].tobytes(), rows["band"][first].tobytes(),
                     counts.tobytes(), np.ascontiguousarray(rows["key"].copy().view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes(),
                     np.packbits(rows["split"]).tobytes()])


def _unpack_keys(data: bytes) -> np.ndarray:
    classes, n = np.frombuffer(data, "<u4", 2).tolist()
    at, parts = 8, []
    for kind, count in (("<i8", classes), ("<i2", classes), ("<u4", classes), ("u1", 6 * n), ("u1", -(-n // 8))):
        parts.append(np.frombuffer(data, kind, count, at))
        at += parts[-1].nbytes
    cid, band, counts, key, split = parts
    whole = np.zeros((n, 8), np.uint8)
    whole[:, 2:] = key.reshape(n, 6)
    rows = np.empty(n, _KEY)
    rows["key"], rows["cid"], rows["band"] = whole.view("<u8").reshape(-1), np.repeat(cid, counts), np.repeat(band, counts)
    rows["split"] = np.unpackbits(split, count=n).astype(bool)
    return rows


def _keys(docs: DataFrame, order, buckets: int, percent: int) -> DataFrame:
    """(bucket, data): packed prefix keys; a frequent key's sets are dealt over several buckets."""
    def run(batches):
        order_, seen = order.value, set()
        for b in steps(batches, "text"):
            parts = []
            for s in shingle_sets(b.column("text").to_pylist()):
                cid = class_id(s)
                if len(s) and cid not in seen:
                    seen.add(cid)
                    own, counts = order_.prefix(s, percent)
                    part = np.empty(len(own), _KEY)
                    part["key"], part["cid"], part["band"] = own, cid, _band(len(s), percent)
                    salts = (counts // BUCKET_KEYS + 1).astype(np.uint64)
                    salt, part["split"] = np.uint64(cid & 0x7FFFFFFF) % salts, salts > 1
                    parts.append(((own + salt * _STEP) % np.uint64(buckets), part))
            if len(seen) > 1_000_000:
                seen = set()
            if not parts:
                continue
            bucket, rows = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            by = np.argsort(bucket, kind="stable")
            bucket, rows = bucket[by], rows[by]
            cut = np.flatnonzero(np.diff(bucket, prepend=bucket[:1] + np.uint64(1)))
            ends = [*cut[1:].tolist(), len(rows)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[cut].astype(np.int64)), pa.array([_pack_keys(rows[a:z]) for a, z in zip(cut.tolist(), ends)], pa.binary())],
                ["bucket", "data"])

    return docs.select("text").mapInArrow(run, "bucket long, data binary")


def _tiles(group: pa.Table) -> pa.Table:
    """Sets that share a key with another, each with the centres of the two tiles (of its band and of the band below) that it is in; null for itself and repeats."""
    rows = np.concatenate([_unpack_keys(x.as_py()) for x in group["data"]])
    rows = rows[np.lexsort((rows["cid"], rows["key"]))]
    new_key = np.concatenate([[True], rows["key"][1:] != rows["key"][:-1]])
    rows = rows[new_key | np.concatenate([[True], rows["cid"][1:] != rows["cid"][:-1]])]
    begins = np.flatnonzero(np.concatenate([[True], rows["key"][1:] != rows["key"][:-1]]))
    # whole keys, some rows at a time
    at = np.searchsorted(begins, np.arange(TILE_ROWS, len(rows), TILE_ROWS))
    cuts = np.unique([0, *begins[at[at < len(begins)]], len(rows)])
    out = pa.concat_tables([_tiles_of(rows[a:z]) for a, z in zip(cuts[:-1], cuts[1:])])
    del rows, new_key
    release()
    return out


def _tiles_of(rows: np.ndarray) -> pa.Table:
    """The tiles of rows sorted by key and class, without repeats."""
    key = np.cumsum(np.concatenate([[0], rows["key"][1:] != rows["key"][:-1]]))
    shared = (np.bincount(key)[key] > 1) | rows["split"]
    rows, key = rows[shared], key[shared]
    # tile b of a key holds its sets of bands b and b + 1
    own = key * (1 << 16) + rows["band"]
    tile, cid = np.concatenate([own, own - 1]), np.concatenate([rows["cid"], rows["cid"]])
    # ORDERS different orders of the sets: a group's tiles share few centres, but more than one
    rank = _mix(cid.view(np.uint64) ^ _mix(np.concatenate([rows["key"], rows["key"]]) % np.uint64(ORDERS)))
    by = np.lexsort((rank, tile))
    tiles, first = np.unique(tile[by], return_index=True)
    centre = cid[by][first]
    mine = rows["cid"].copy()
    here, below = centre[np.searchsorted(tiles, own)], centre[np.searchsorted(tiles, own - 1)]
    return pa.table({"key": rows["key"].copy().view(np.int64), "cid": mine, "split": rows["split"].copy(), "centre": pa.array(here, mask=here == mine),
                     "centre_below": pa.array(below, mask=(below == mine) | (below == here))})


def _chosen(spark: SparkSession, cids: DataFrame, bits: int):
    """Broadcast filter of 2**bits bits that holds the given class ids; others may pass by chance."""
    mask = (1 << bits) - 1
    slot = F.col("cid").bitwiseAND(F.lit(mask))
    words = (cids.select(F.shiftright(slot, 5).alias("word"), F.expr("1").alias("one"), slot.bitwiseAND(F.lit(31)).cast("int").alias("bit"))
             .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow())  # 2**bits / 32 rows at most
    out = np.zeros(1 << (bits - 5), np.uint32)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return spark.sparkContext.broadcast(out)


def _arrays(docs: DataFrame, chosen, bits: int) -> DataFrame:
    """(cid, own): sorted array of the chosen classes, once a task."""
    def run(batches):
        kept, seen = chosen.value, set()
        mask = (1 << bits) - 1
        for b in steps(batches, "text"):
            rows = []
            for s in shingle_sets(b.column("text").to_pylist()):
                cid = class_id(s)
                slot = cid & mask
                if len(s) and kept[slot >> 5] >> (slot & 31) & 1 and cid not in seen:
                    seen.add(cid)
                    rows.append((cid, pack_set(s)))
            if len(seen) > 1_000_000:
                seen = set()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary()))], ["cid", "own"])

    return docs.select("text").mapInArrow(run, "cid long, own binary")


def _slices(batches):
    for b in batches:
        yield from (b.slice(i, BLOCK) for i in range(0, b.num_rows, BLOCK))


def _bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and bitmaps allow the threshold."""
    side = lambda c: classes.select(F.col("cid").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches):
        for t in _slices(batches):
            if t.num_rows:
                n_a, n_b = (t.column(c).to_numpy() for c in ("n_a", "n_b"))
                bits = differing(t.column("bits_a").to_pylist(), t.column("bits_b").to_pylist())
                ok = may_reach(n_a, n_b, bits, percent)
                yield pa.RecordBatch.from_arrays([t.column("a"), t.column("b")], ["a", "b"]).filter(pa.array(ok))

    return both.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, "a long, b long")


def _only(arrays: DataFrame, cids: DataFrame) -> DataFrame:
    """The arrays of the classes, and a few more by chance, picked before anything moves."""
    kept = _chosen(arrays.sparkSession, cids, FILTER_BITS)

    def run(batches):
        for b in batches:
            slot = b.column("cid").to_numpy() & ((1 << FILTER_BITS) - 1)
            yield b.filter(pa.array((kept.value[slot >> 5] >> (slot & 31).astype(np.uint32) & 1).astype(bool)))

    return arrays.mapInArrow(run, "cid long, own binary")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid")))


def _cids(pairs: DataFrame) -> DataFrame:
    return _ends(pairs).distinct()


def _centred(pairs: DataFrame) -> DataFrame:
    """(a, b, salt): ``a`` is the end with more partners; beyond PARTNERS it meets them in several places."""
    partners = _ends(pairs).groupBy("cid").count()
    side = lambda c: partners.select(F.col("cid").alias(c), F.col("count").alias(f"n_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    first = F.col("n_a") >= F.col("n_b")
    both = both.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("b"),
                       F.ceil(F.greatest("n_a", "n_b") / PARTNERS).alias("places"))
    return both.select("a", "b", F.pmod(F.xxhash64("b"), F.col("places")).alias("salt"))


def _verified(pairs: DataFrame, arrays: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose exact similarity reaches the threshold.

    The array of one end goes to that of the other, and the two are intersected.
    """
    salted = stored(_centred(pairs), "centred-pairs")
    sets = _only(arrays, _cids(pairs)).repartition("cid").dropDuplicates(["cid"])
    members = salted.join(sets, F.col("b") == F.col("cid")).select("a", "salt", F.col("b").alias("id"), "own")
    centres = salted.select("a", "salt").distinct().join(sets, F.col("a") == F.col("cid")).select(
        "a", "salt", F.lit(None).cast("long").alias("id"), "own")
    rows = centres.unionByName(members).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("id").asc_nulls_first())

    def run(batches):
        centre = np.zeros(0, np.uint64)
        for t in _slices(batches):
            found = []
            for a, b, own in zip(*(t.column(c).to_pylist() for c in ("a", "id", "own"))):
                own = unpack_set(own)
                if b is None:
                    centre = own
                elif similar(centre, own, percent):
                    found.append((a, b))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    return rows.select("a", "id", "own").mapInArrow(run, "a long, b long")


def _ordered(a, b):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


_TILE = "key long, low int, high int, cid long, component long, n long, bits binary, block int, first array<long>"


def _crossing(tiles: DataFrame, linked: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows of the tiles in which sets of different components meet.

    Only keys of several components take part, and of those that are in one bucket
    only keys of three sets or more. A key with more than SPLIT sets, or SPLIT_ELEMENTS elements in them, is cut
    into blocks and every pair of blocks is a task of its own. Sets
    carry their FIRST_KEYS smallest keys, so that a pair which shares many is
    mostly compared once.
    """
    rows = tiles.select("key", "cid", "split").join(linked, F.col("cid") == F.col("node"), "left").select(
        "key", "cid", "split", F.coalesce("component", "cid").alias("component"))
    rows = rows.join(classes.select("cid", "n"), "cid")
    keys = rows.groupBy("key").agg(F.count("*").alias("sets"), F.sum("n").alias("elements"), F.min("component").alias("least"),
                                    F.max("component").alias("most"), F.bool_or("split").alias("split"))
    # of two sets in one bucket one is the star's centre, so their pair has been seen; those of a split key may be in two
    keys = keys.where("least <> most AND (sets > 2 OR split)").select(
        "key", F.ceil(F.greatest(F.col("sets") / SPLIT, F.col("elements") / SPLIT_ELEMENTS)).cast("int").alias("blocks"))
    rows = stored(rows.drop("split", "n").join(keys, "key"), "cross-keys")
    first = rows.groupBy("cid").agg(F.slice(F.sort_array(F.collect_set("key")), 1, FIRST_KEYS).alias("first"))
    rows = rows.join(classes.join(first, "cid"), "cid")
    block = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    rows = rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("key", *[c.alias(n) for c, n in ((F.least("block", "other"), "low"), (F.greatest("block", "other"), "high"))],
                       "cid", "component", "n", "bits", "block", "first")


class _Tile:
    """Sets of one key, of one block or of two."""

    def __init__(self, group: pa.Table, percent: int):
        self.percent, self.key = percent, group["key"][0].as_py()
        self.cid, self.component, self.n, block = (group[c].to_numpy() for c in ("cid", "component", "n", "block"))
        self.bits = group["bits"].to_pylist()
        self.width, self.folded = np.array([len(b) for b in self.bits]), {}
        first = np.full((len(self.cid), FIRST_KEYS), self.key)
        for i, own in enumerate(group["first"].to_pylist()):
            first[i, :len(own)] = own
        # by set: numbers of its keys smaller than this one that another set here has too, -1 behind them
        _, number, times = np.unique(first, return_inverse=True, return_counts=True)
        number = number.reshape(first.shape)
        self.first = -np.sort(-np.where((first < self.key) & (times[number] > 1), number, -1).astype(np.int32), axis=1)
        low, high = group["low"][0].as_py(), group["high"][0].as_py()
        self.same = low == high
        self.left, self.right = np.flatnonzero(block == low), np.flatnonzero(block == high)

    def differing(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Bits in which the bitmaps of sets p and q differ, as ``differing``; each set is folded once to a width."""
        width = np.minimum(self.width[p], self.width[q])
        out = np.zeros(len(p), np.int64)
        for w in np.unique(width).tolist():
            if w not in self.folded:
                wide = np.flatnonzero(self.width >= w)
                row = np.zeros(len(self.width), np.int64)
                row[wide] = np.arange(len(wide))
                self.folded[w] = row, np.stack([_folded(self.bits[k], w) for k in wide])
            row, bits = self.folded[w]
            at = np.flatnonzero(width == w)
            step = max(1, TOGETHER // w)
            for i in range(0, len(at), step):
                part = at[i:i + step]
                out[part] = np.bitwise_count(bits[row[p[part]]] ^ bits[row[q[part]]]).sum(axis=1, dtype=np.int64)
        return out

    def earlier(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which pairs of these sets share a smaller key: they are compared there, and their smallest one is never skipped."""
        shared = np.zeros((len(x), len(y)), bool)
        left, right = self.first[x], np.where(self.first[y] < 0, -2, self.first[y])
        for i in np.flatnonzero((left >= 0).any(axis=0)):
            for j in np.flatnonzero((right >= 0).any(axis=0)):
                shared |= left[:, i][:, None] == right[:, j][None, :]
        return shared

    def candidates(self, open_):
        """(p, q, differing bits) of pairs whose sizes and bitmaps allow the threshold, some at a time; ``open_`` says which still matter."""
        n, percent = self.n, self.percent
        for i in range(0, len(self.left), BLOCK):
            x = self.left[i:i + BLOCK]
            for j in range(i if self.same else 0, len(self.right), BLOCK):
                y = self.right[j:j + BLOCK]
                n_x, n_y = n[x][:, None], n[y][None, :]
                may = open_(x[:, None], y[None, :]) & (100 * np.minimum(n_x, n_y) >= percent * np.maximum(n_x, n_y))
                if self.same:
                    may &= x[:, None] < y[None, :]
                p, q = np.nonzero(may & ~self.earlier(x, y) if may.any() else may)
                p, q = x[p], y[q]
                bits = self.differing(p, q)
                keep = may_reach(n[p], n[q], bits, percent)
                yield p[keep], q[keep], bits[keep]


def _met(percent: int):
    """The rows of a tile whose set has a candidate in another component: never more than the tile has."""
    def run(group: pa.Table) -> pa.Table:
        tile = _Tile(group, percent)
        found = np.zeros(len(tile.cid), bool)
        # a pair of two sets that are known to have one need not be looked at
        for p, q, _ in tile.candidates(lambda x, y: (tile.component[x] != tile.component[y]) & ~(found[x] & found[y])):
            found[p] = found[q] = True
        kept = group.filter(pa.array(found))
        at = kept.schema.get_field_index("first")
        return kept.set_column(at, "first", kept["first"].cast(pa.list_(pa.int64())))

    return run


def _spanning(percent: int):
    """Links of a tile that connect what its sets' exact similarities connect: fewer than it has sets."""
    def run(group: pa.Table) -> pa.Table:
        tile = _Tile(group, percent)
        own = group["own"].to_pylist()
        _, root = np.unique(tile.component, return_inverse=True)  # by set: one number for what is connected
        sets, links = {}, []

        def elements(k: int) -> np.ndarray:
            if k not in sets:
                sets[k] = unpack_set(own[k])
            return sets[k]

        for p, q, bits in tile.candidates(lambda x, y: root[x] != root[y]):
            order = np.argsort(bits / (tile.n[p] + tile.n[q]), kind="stable")  # likely links first
            for a, b in zip(p[order].tolist(), q[order].tolist()):
                if root[a] != root[b] and similar(elements(a), elements(b), percent):
                    links.append((int(tile.cid[a]), int(tile.cid[b])))
                    root[root == root[b]] = root[a]
        return pa.table({c: pa.array([x[i] for x in links], pa.int64()) for i, c in enumerate(("a", "b"))})

    return run


def _files_go(work):
    """Shuffle files of a step go with its job, not when the driver's memory is next cleaned: the steps are stored."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    @functools.wraps(work)
    def run(docs: DataFrame, *args, **kwargs):
        conf = docs.sparkSession.conf
        before = conf.get(key, None)
        conf.set(key, "true")
        try:
            return work(docs, *args, **kwargs)
        finally:
            if before is None:
                conf.unset(key)
            else:
                conf.set(key, before)

    return run


@_files_go
def link_classes(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(documents, links): (doc_id, cid, n) of every row, and (a, b) verified links that connect all linked classes."""
    spark = docs.sparkSession
    sets = _read_sets(docs)
    members = sets.where("n >= 0").select("doc_id", "cid", "n")
    classes = stored(sets.where("n > 0").select("cid", "n", "bits").dropDuplicates(["cid"]), "classes")
    order = spark.sparkContext.broadcast(_frequent(sets))  # MOST_FREQUENT entries
    keys = classes.agg(F.sum(F.floor(F.col("n") * (100 - percent) / 100) + 1).alias("keys")).first()["keys"] or 0
    tiles = stored(_keys(docs, order, max(1, math.ceil(keys / BUCKET_KEYS)), percent).groupBy("bucket").applyInArrow(
        _tiles, "key long, cid long, split boolean, centre long, centre_below long"), "tiles")

    def arrays_of(cids: DataFrame) -> DataFrame:
        return stored(_arrays(docs, _chosen(spark, cids, FILTER_BITS), FILTER_BITS), "arrays")

    stars = tiles.select("cid", F.explode(F.array("centre", "centre_below")).alias("centre")).where("centre IS NOT NULL")
    pairs = stored(_bounded(stars.select(*_ordered("cid", "centre")).distinct(), classes, percent), "star-pairs")
    arrays = arrays_of(_cids(pairs))
    links = stored(_verified(pairs, arrays, percent), "star-links")
    linked = stored(components(links), "star-components")
    met = stored(_crossing(tiles, linked, classes).groupBy("key", "low", "high").applyInArrow(_met(percent), _TILE), "cross-sets")
    ends = met.select("cid").distinct()
    missing = stored(ends.join(arrays, "cid", "left_anti"), "cross-classes")
    if not missing.isEmpty():
        arrays = arrays.unionByName(arrays_of(missing))
    sets = _only(arrays, ends).repartition("cid").dropDuplicates(["cid"])
    spanning = met.join(sets, "cid").select(*met.columns, "own").groupBy("key", "low", "high").applyInArrow(_spanning(percent), "a long, b long")
    return members, links.unionByName(stored(spanning, "cross-links"))


@_files_go
def _groups(docs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, cid, n, component) of every row; component is null for the empty set, which links with nothing, not even itself."""
    members, links = link_classes(docs, percent)
    found = stored(components(links), "components")
    return members.join(found, F.col("cid") == F.col("node"), "left").select(
        "doc_id", "cid", "n", F.when(F.col("n") > 0, F.coalesce("component", "cid")).alias("component"))


def join_documents(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    rows = _groups(docs, percent)
    least = rows.where(F.col("component").isNotNull()).groupBy("component").agg(F.min("doc_id").alias("least"))
    joined = rows.join(least, "component", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each group, all columns as they are: the smallest id (null ids last, repeated rows once).

    Documents without any word are in no group and all stay.
    """
    names = docs.columns
    taken = {n.lower() for n in names}
    cid = next(c for c in (f"class_{i}" for i in range(len(names) + 1)) if c not in taken)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    rows = _groups(docs, percent).where(F.col("component").isNotNull())
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "cid")
    keepers = stored(rows.groupBy("component").agg(F.min(place).alias("k"), F.count("*").alias("rows")), "keepers")
    shared = rows.join(keepers.where("rows > 1").select("component"), "component", "left_semi").select("cid").distinct()
    chosen = _chosen(docs.sparkSession, shared, FILTER_BITS)

    def split(grouped: bool):
        """Rows that may be in a group of several, with their class; or all others, as they are."""
        def run(batches):
            for b in steps(batches, "text"):
                ids = np.array([class_id(s) for s in shingle_sets(b.column("text").to_pylist())], np.int64)
                slot = ids & ((1 << FILTER_BITS) - 1)
                may = (chosen.value[slot >> 5] >> (slot & 31).astype(np.uint32) & 1).astype(bool) & (ids != 0)
                if grouped:
                    b = pa.RecordBatch.from_arrays([*b.columns, pa.array(ids)], [*names, cid])
                yield b.filter(pa.array(may if grouped else ~may))

        return run

    # only rows of groups, and a few more by chance, move
    alone = docs.mapInArrow(split(False), docs.schema)
    marked = docs.mapInArrow(split(True), f"{fields}, {cid} long")
    kept_ids = keepers.select(F.col("k.cid").alias("kept_cid"), F.col("k.doc_id").alias("kept_id"))
    same = (F.col(f"d.{cid}") == F.col("k.kept_cid")) & F.col("d.doc_id").eqNullSafe(F.col("k.kept_id"))
    kept = marked.alias("d").join(kept_ids.alias("k"), same, "left_semi").dropDuplicates(["doc_id", cid])
    return alone.unionByName(kept.select(*[f"`{n}`" for n in names]))
