"""Packing into windows of a fixed number of tokens: best-fit decreasing over lengths.

Overlong documents are first cut into full windows. What remains of each, and
every shorter document, is placed by best-fit decreasing: longest first, each
into the tightest open window that still has room. Which window that is
depends on lengths alone, and equal lengths can be exchanged, so the placement
is computed on the histogram of lengths (``window`` numbers, whatever the size
of the corpus) with windows of equal room held as ranges; a segment tree
indexed by remaining room finds the tightest open one. The resulting runs
("pieces of length l with ranks a to b go to windows c to d") are then joined
back to the pieces, whose rank within their length comes from per-partition
counts, so no task ever sees all pieces of one length.

Null text counts as empty; each document, empty ones too, carries its end id.
Repeated rows are packed separately. Null ids are kept. Extra columns are
ignored whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import steps, stored
from ratewise.llm.vocab import word_ids

WINDOW, END_ID = 2048, 1

_PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                    ("doc_tokens", pa.int64()), ("part", pa.int64()), ("nth", pa.int64())])


class RoomTree:
    """Segment tree over remaining room 0..size: does any open window have it?"""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.open = [0] * (2 * self.leaves)

    def add(self, room: int, windows: int) -> None:
        node = room + self.leaves
        while node:
            self.open[node] += windows
            node //= 2

    def tightest(self, least: int) -> int | None:
        """The smallest room of at least ``least`` that an open window has."""
        node = least + self.leaves
        if not self.open[node]:
            while node > 1 and (node % 2 or not self.open[node + 1]):
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.leaves


def place(histogram: dict[int, int], window: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best-fit decreasing over a histogram of lengths below ``window``.

    Returns runs (length, first rank, first window, per window, offset) by
    rising rank within each length, and the number of windows. Ranks from a
    run's first to the next run's fill its windows in order, ``per window``
    each, one after the other from ``offset``.
    """
    tree = RoomTree(window)
    ranges: dict[int, list[tuple[int, int]]] = {}  # room -> [first window, end)
    runs, windows = [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                fresh = -(-left // (window // length))
                ranges.setdefault(window, []).append((windows, windows + fresh))
                tree.add(window, fresh)
                windows, room = windows + fresh, window
            first, end = ranges[room].pop()
            per = min(room // length, left)
            used = min(end - first, left // per)
            if first + used < end:
                ranges[room].append((first + used, end))
            ranges.setdefault(room - per * length, []).append((first, first + used))
            tree.add(room, -used)
            tree.add(room - per * length, used)
            runs.append((length, rank, first, per, window - room))
            rank, left = rank + used * per, left - used * per
    return runs, windows


def _pieces(path: str, window: int, end_id: int):
    end = end_id.to_bytes(4, "little")

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        memo, seen = word_ids(path), Counter()
        for b in steps(batches, "text"):
            rows = []
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), memo.encode([t or "" for t in b.column("text").to_pylist()])):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, window):
                    piece = ids[4 * start:4 * (start + window)]
                    length = len(piece) // 4
                    rows.append((doc_id, start, length, zlib.crc32(piece), total, part, seen[length]))
                    seen[length] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PIECE.types)], schema=_PIECE)
    return run


def _assign(runs: list[tuple[int, int, int, int, int]]):
    """Sequence and offset of pieces below a full window, by length and rank."""
    by_length: dict[int, list] = {}
    for length, rank, first, per, offset in runs:
        by_length.setdefault(length, []).append((rank, first, per, offset))

    def run(batches):
        for batch in batches:
            ids, offsets = [], []
            for length, rank in zip(batch.column("length").to_pylist(), batch.column("rank").to_pylist()):
                own = by_length[length]
                start, first, per, offset = own[bisect.bisect_right(own, rank, key=lambda r: r[0]) - 1]
                ids.append(first + (rank - start) // per)
                offsets.append(offset + (rank - start) % per * length)
            keep = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(ids, pa.int64()), pa.array(offsets, pa.int64())],
                                             ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    Ids are the tokenizer's without special tokens, then ``end_id``. Sequences
    of best-fit windows are numbered from 0; full windows follow.
    """
    names = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = stored(rows.mapInArrow(_pieces(tokenizer, window, end_id), f"{names}, part long, nth long"), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # `window` rows at most
    histogram.pop(window, None)
    runs, windows = place(histogram, window)
    # pieces of a length in the partitions before this one
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).select("part", "length", "base")
    ranked = pieces.join(base, ["part", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    full = ranked.where(F.col("length") == window).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("rank") + F.lit(windows)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    placed = ranked.where(F.col("length") < window).mapInArrow(_assign(runs), f"{names}, sequence_id long, offset long")
    return placed.unionByName(full)
