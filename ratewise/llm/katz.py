"""Katz backoff language model: counted, stored and evaluated in partitioned tables.

P(w | h) of a word after a history of up to ``order`` - 1 words is d(c) c(h w) / c(h) where h w was
counted in training, d being the Good-Turing discount of the count c, and
otherwise alpha(h) P(w | h without its first word). alpha(h) gives the words not seen after h just the mass
that discounts left, so probabilities of all known words and one class of
unknown ones add up to one after every history. A single word not known in training has the mass that the discounts
of single words left.

An n-gram is a node: the number of its history's node and of its last word.
Blocks of tokenised texts send their distinct (history, word) pairs to the buckets of the
histories; a bucket holds a part of the table of one level: sorted pairs,
counts and, per history, the sum of lower probabilities of the words seen after it, from which alpha follows. The same
way blocks ask for counts, nodes and weights, so a text is evaluated level by level,
each token falling back along its histories. A history with a large share of all
words (``HOT_HISTORIES`` can have it at most) is dealt by word; its sums
are added up and broadcast.

Tokens: A-Z lower-cased, words between blanks, then one end, which is counted
as a word but never is part of a history. Words travel as 64-bit hashes. A null text has only its end. Without training
texts every token has probability one. A discount that Good-Turing does not define
(too few n-grams of that count) is (r - 1/2) / r for count r; a history without any count that is discounted
leaves the mass of one more word. Repeated rows count each, null ids are trained on unless the caller says otherwise. Other columns are
ignored whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import dataclasses
import functools
import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import steps, stored

#: Words of the longest n-grams; counts up to this one are discounted.
ORDER, DISCOUNTED = 2, 5
#: Bytes of text in a block, pairs meant for a bucket, histories that may be dealt.
BLOCK_BYTES, BUCKET_PAIRS, HOT_HISTORIES = 8 << 20, 1 << 20, 1 << 18
FOLDS, HELD_OUT_FOLD = 7, 2

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_END = b" "  # no word
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of 64-bit numbers as compressed planes of bytes."""
    out = [len(arrays).to_bytes(4, "little")]
    for a in arrays:
        planes = np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(-1, 8).T)
        used = 8 if a.dtype == np.float64 else max((i + 1 for i in range(8) if planes[i].any()), default=0)
        data = pa.Codec("zstd", 1).compress(planes[:used].tobytes(), asbytes=True) if used and len(a) else b""
        out.append(a.dtype.kind.encode() + bytes([used]) + len(a).to_bytes(4, "little") + len(data).to_bytes(4, "little") + data)
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    at, out = 4, []
    for _ in range(int.from_bytes(data[:4], "little")):
        kind, used = data[at:at + 1].decode(), data[at + 1]
        n, size = (int.from_bytes(data[i:i + 4], "little") for i in (at + 2, at + 6))
        planes = np.zeros((n, 8), np.uint8)
        if size:
            planes[:, :used] = np.frombuffer(pa.Codec("zstd", 1).decompress(data[at + 10:at + 10 + size], used * n, asbytes=True), np.uint8).reshape(used, n).T
        out.append(planes.reshape(-1).view({"i": "<i8", "u": "<u8", "f": "<f8"}[kind]))
        at += 10 + size
    return out


def _steps_of(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=a.dtype.type(0))


def discounts(seen: list[int]) -> list[float]:
    """d(0), d(1), ..., d(DISCOUNTED) from the numbers of n-grams counted 0, 1, ..., DISCOUNTED + 1 times."""
    out, k = [1.0], DISCOUNTED
    far = (k + 1) * seen[k + 1] / seen[1] if seen[1] else 1.0
    for r in range(1, k + 1):
        d = ((r + 1) * seen[r + 1] / (r * seen[r]) - far) / (1 - far) if seen[r] and far < 1 else 0.0
        out.append(d if 0 < d < 1 else (r - 0.5) / r)
    return out


def _discounted(c: np.ndarray, d: list[float]) -> np.ndarray:
    """d(c) c."""
    return np.where(c <= DISCOUNTED, np.array(d)[np.minimum(c, DISCOUNTED)], 1.0) * c


@dataclasses.dataclass
class Model:
    """Stored tables by level and what every task needs of them; ``hot`` has (leaves_nothing, alpha) of dealt histories."""

    order: int
    buckets: int
    hot_from: int
    words: int = 0
    vocabulary: int = 0
    unknown: float = 1.0
    total: int = 1
    tables: list[DataFrame] = dataclasses.field(default_factory=list)
    discounts: list[list[float]] = dataclasses.field(default_factory=list)
    hot: list[Broadcast | None] = dataclasses.field(default_factory=list)

    def numbers(self) -> dict:
        return {"buckets": self.buckets, "hot_from": self.hot_from, "words": self.words, "vocabulary": self.vocabulary, "unknown": self.unknown,
                "total": self.total, "discounts": self.discounts}


@dataclasses.dataclass
class Corpus:
    """Tokenised blocks, and the answers they got from a model's tables, by level."""

    blocks: DataFrame
    id_type: str
    tokens: int
    answers: list[DataFrame] = dataclasses.field(default_factory=list)


def tokens(docs: DataFrame, train: Column) -> Corpus:
    """Stored blocks of texts: (block, doc_ids, train, data); ``train`` marks the rows to learn from."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        block = TaskContext.get().partitionId() << 32
        ids, flags, runs, words, held, arrow_id = [], [], [], None, 0, None

        def closed():
            local = np.concatenate(runs)
            sizes = np.array([len(r) for r in runs], np.int64)
            hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([ids], pa.list_(arrow_id)), pa.array([flags], pa.list_(pa.bool_())), pa.array([len(local)], pa.int64()),
                 pa.array([pack(sizes, hashes, local.astype(np.int64))], pa.binary())], ["block", "doc_ids", "train", "tokens", "data"])

        for b in steps(batches, "text"):
            arrow_id = b.schema.field("doc_id").type
            for i, text, flag in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "train"))):
                if words is None:
                    words = defaultdict()
                    words.default_factory = words.__len__
                    words[_END]
                own = (text or "").encode().translate(_LOWER).split()  # bytes split at just the contract's blanks
                own.append(_END)
                ids.append(i)
                flags.append(flag)
                runs.append(np.fromiter(map(words.__getitem__, own), np.int32, len(own)))
                held += len(text or "") + 32
                if held >= BLOCK_BYTES:
                    yield closed()
                    block += 1
                    ids, flags, runs, words, held = [], [], [], None, 0
        if ids:
            yield closed()

    rows = docs.select("doc_id", "text", F.coalesce(train, F.lit(False)).alias("train"))
    blocks = stored(rows.mapInArrow(run, f"block long, doc_ids array<{id_type}>, train array<boolean>, tokens long, data binary"), "token-blocks")
    return Corpus(blocks, id_type, blocks.agg(F.sum("tokens")).first()[0] or 0)


# ---- one block in a task

def _numbered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, place of each value among them)."""
    order = np.argsort(key)
    ranked = key[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(key) else np.zeros(0, bool)
    place = np.empty(len(key), np.int64)
    place[order] = np.cumsum(new) - 1
    return ranked[new], place


class _Level:
    """Distinct n-grams of a block at one level, and the buckets that they belong to.

    ``at`` are the positions where they end, ``pair`` the number of the n-gram there.
    """

    def __init__(self, block: _Block, level: int, numbers: dict):
        self.level = level
        if level == 1:
            self.at, self.pair = np.arange(len(block.tokens)), block.tokens
            self.word, self.history = block.hashes, np.zeros(len(block.hashes), np.int64)
            route = _mixed(self.word)
        else:
            before = np.concatenate([[-1], block.here[:-1]])
            before[block.first] = -1
            # histories known in training; unknown words are asked for too, they need the history's weight
            self.at = np.flatnonzero((before >= 0) & (np.append(block.node, 0)[before] > 0))
            key, self.pair = _numbered(before[self.at] * len(block.hashes) + block.tokens[self.at])
            own = key // len(block.hashes)
            self.word, self.history = block.word[key % len(block.hashes)], block.node[own]
            self.of_history = block.count[own]
            # what the n-gram falls back to ends at the same place
            one = np.zeros(len(key), np.int64)
            one[self.pair] = block.here[self.at]
            self.lower, self.lower_total = block.count[one], block.total[one]
            route = _mixed(self.history.view(np.uint64))
            hot = np.flatnonzero(self.of_history >= numbers["hot_from"])
            route[hot] = _mixed(route[hot] ^ _mixed(self.word[hot].view(np.uint64)))
        self.bucket = (route % np.uint64(numbers["buckets"])).astype(np.int64)
        self.order = np.argsort(self.bucket.astype(np.uint16) if numbers["buckets"] < 1 << 16 else self.bucket, kind="stable")

    def restored(self, values: np.ndarray) -> np.ndarray:
        """Values in the order of travel -> by number of the n-gram."""
        back = np.empty(len(values), values.dtype)
        back[self.order] = values
        return back


class _Block:
    """Tokens of a block, and what is known of them up to some level.

    ``here`` is the number of the last level's n-gram that ends at a position (-1: none was asked for); by that number go its node,
    count and the divisor of its probability. ``word`` numbers words by their place in the block.
    """

    def __init__(self, data: bytes, train: list[bool]):
        self.sizes, self.hashes, self.tokens = unpack(data)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.trained = np.repeat(np.array(train, bool), self.sizes)
        self.here = self.node = self.count = self.total = self.word = np.zeros(0, np.int64)
        self.known, self.base, self.score = np.zeros(0, np.int64), np.zeros(0), np.zeros(0)

    def answered(self, level: int, answers: list[bytes], numbers: dict) -> None:
        """Take the answers of a level's buckets (in order of bucket): counts, nodes and weights."""
        asked = _Level(self, level, numbers)
        parts = [unpack(a) for a in answers]
        value = asked.restored(np.concatenate([p[0] for p in parts] or [np.zeros(0, np.int64)]))
        node = asked.restored(np.concatenate([p[1] for p in parts] or [np.zeros(0, np.int64)]))
        count, nothing_left = value >> 1, value & 1
        d = numbers["discounts"][level - 1]
        if level == 1:
            total = np.full(len(count), numbers["total"], np.int64)
            self.word = node
            self.known = (count > 0).astype(np.int64)[self.tokens]
            self.base = np.log10((count + 1) / (numbers["words"] + numbers["vocabulary"] + 1))[self.tokens]
            self.score = np.log10(np.where(count > 0, _discounted(count, d) / total, numbers["unknown"]))[self.tokens]
        else:
            total = asked.of_history + nothing_left
            weight = asked.restored(np.concatenate([_weights(p) for p in parts] or [np.zeros(0)]))
            own = np.log10(np.where(count > 0, _discounted(count, d) / np.maximum(total, 1), weight))
            self.score[asked.at] = own[asked.pair] + np.where(count > 0, 0.0, 1.0)[asked.pair] * self.score[asked.at]
        self.count, self.node, self.total = count, node, total
        self.here = np.full(len(self.tokens), -1, np.int64)
        self.here[asked.at] = asked.pair


def _weights(parts: list[np.ndarray]) -> np.ndarray:
    """Backoff weight per pair: given for pairs that were not seen."""
    value, _, weights = parts
    out = np.ones(len(value))
    out[value >> 1 == 0] = weights
    return out


def _grouped(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value, how often) of each run of equal values."""
    cut = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)
    return a[cut], np.diff(np.append(cut, len(a)))


def _messages(block: int, held: _Block, level: _Level, counted: bool) -> pa.RecordBatch | None:
    """(bucket, block, data) of each bucket that the block's n-grams go to; those of training texts with their counts, or all of them."""
    o = level.order
    if counted:
        count = np.bincount(level.pair[held.trained[level.at]], minlength=len(o))
        o = o[count[o] > 0]
    if not len(o):
        return None
    bucket, word, history = level.bucket[o], level.word[o], level.history[o]
    cut = np.flatnonzero(np.diff(bucket, prepend=-1))
    data = []
    for a, z in zip(cut.tolist(), [*cut[1:].tolist(), len(o)]):
        if level.level == 1:
            parts = [word[a:z]]
        else:
            h, n = _grouped(history[a:z])
            parts = [h, n, word[a:z]]
        if counted:
            own = o[a:z]
            parts.append(count[own])
            if level.level > 1:
                begin = own[np.cumsum(n) - n]
                parts += [level.lower[own], level.lower_total[own], level.of_history[begin]]
        data.append(pack(*parts))
    return pa.RecordBatch.from_arrays([pa.array(bucket[cut]), pa.array([block] * len(data), pa.int64()), pa.array(data, pa.binary())], ["bucket", "block", "data"])


def _gathered(corpus: Corpus, upto: int) -> DataFrame:
    """Blocks with their answers of the levels before ``upto``, sorted so that those of a block follow one another."""
    rows = corpus.blocks.select("block", F.lit(0).alias("level"), F.lit(-1).cast("long").alias("bucket"), "doc_ids", "train", "data")
    nothing = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ("doc_ids", "train")]
    if upto == 1:
        return rows
    for k in range(1, upto):
        rows = rows.unionByName(corpus.answers[k - 1].where("block IS NOT NULL").select("block", F.lit(k).alias("level"), "bucket", *nothing, "data"))
    return rows.repartition("block").sortWithinPartitions("block", "level", "bucket")


def _each_block(batches, upto: int, numbers: dict):
    """(block, doc_ids, _Block) with the answers of all levels before ``upto``."""
    block, ids, held, answers = None, None, None, {}

    def ready():
        for k in range(1, upto):
            held.answered(k, answers.get(k, []), numbers)
        return block, ids, held

    for b in batches:
        for i in range(b.num_rows):
            row = b.slice(i, 1)
            number, level, data = row.column("block")[0].as_py(), row.column("level")[0].as_py(), row.column("data")[0].as_py()
            if level == 0:
                if held is not None:
                    yield ready()
                block, ids, answers = number, row.column("doc_ids")[0], {}
                held = _Block(data, row.column("train")[0].as_py())
            else:
                answers.setdefault(level, []).append(data)
    if held is not None:
        yield ready()


def _sent(corpus: Corpus, model: Model, level: int, counted: bool) -> DataFrame:
    """(bucket, block, data): pairs of a level, of training texts with counts, or of all to be looked up."""
    numbers = model.numbers()

    def run(batches):
        for block, _, held in _each_block(batches, level, numbers):
            out = _messages(block, held, _Level(held, level, numbers), counted)
            if out is not None:
                yield out

    return _gathered(corpus, level).mapInArrow(run, "bucket long, block long, data binary")


# ---- one bucket in a task

def _sorted_pairs(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Order by history, then word."""
    if not len(word):
        return np.zeros(0, np.int64)
    wide = int(word.max()) + 1
    if int(history.max()) < (1 << 62) // wide:
        return np.argsort(history * np.int64(wide) + word.astype(np.int64))
    return np.lexsort((word, history))


def _counted(level: int, lower: list[float] | None, hot_from: int):
    """Merge a bucket's counts to its part of the table; numbers of n-grams by count and sums of dealt histories beside it."""
    def run(group: pa.Table) -> pa.Table:
        messages = [unpack(x) for x in group["data"].to_pylist()]
        bucket = group["bucket"][0].as_py()
        if level == 1:
            word, count = (np.concatenate([m[i] for m in messages]) for i in (0, 1))
            by = np.argsort(word)
            history = np.zeros(len(word), np.int64)
        else:
            word, count, below, below_total = (np.concatenate([m[i] for m in messages]) for i in (2, 3, 4, 5))
            history, of_history = (np.concatenate([np.repeat(m[i], m[1]) for m in messages]) for i in (0, 6))
            by = _sorted_pairs(history, word)
        word, history = word[by], history[by]
        cut = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (history[1:] != history[:-1])]))
        total = np.add.reduceat(count[by], cut)
        word, history = word[cut], history[cut]
        numbers = np.bincount(np.minimum(total, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[:DISCOUNTED + 2]
        rows = {"bucket": [bucket], "history": [None], "stats": [[*numbers.tolist(), len(total), int(total.sum())]], "seen": [None]}
        if level == 1:
            rows["data"] = [pack(_steps_of(word), total)]
        else:
            own = by[cut]
            share = _discounted(below[own], lower) / np.maximum(below_total[own], 1)
            histories, n = _grouped(history)
            begin = np.cumsum(n) - n
            seen = np.add.reduceat(share, begin)
            rows["data"] = [pack(_steps_of(histories), n, word, total, seen)]
            for i in np.flatnonzero(of_history[own][begin] >= hot_from).tolist():
                mine = total[begin[i]:begin[i] + n[i]]
                rows["bucket"].append(bucket)
                rows["history"].append(int(histories[i]))
                rows["stats"].append([*np.bincount(mine[mine <= DISCOUNTED], minlength=DISCOUNTED + 1).tolist(), int(mine.sum())])
                rows["seen"].append(float(seen[i]))
                rows["data"].append(None)
        return pa.table({"bucket": pa.array(rows["bucket"], pa.int64()), "history": pa.array(rows["history"], pa.int64()),
                         "stats": pa.array(rows["stats"], pa.list_(pa.int64())), "seen": pa.array(rows["seen"], pa.float64()), "data": pa.array(rows["data"], pa.binary())})

    return run


def _alpha(by_count: np.ndarray, total: np.ndarray, seen: np.ndarray, d: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """(leaves nothing, alpha) of histories: numbers of their words by count (0 to DISCOUNTED), their count, lower probability of the words seen."""
    nothing = by_count[:, 1:].sum(axis=1) == 0
    freed = (by_count * (np.arange(DISCOUNTED + 1) * (1 - np.array(d)))).sum(axis=1)
    left = np.where(nothing, 1 / (total + 1), freed / np.maximum(total, 1))
    return nothing, left / np.maximum(1 - seen, 1e-300)


def _found(known: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether there) of values in a sorted array that is not empty."""
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    return at, known[at] == asked


class _Table:
    """A bucket's part of one level, ready to be asked."""

    def __init__(self, level: int, data: bytes | None, d: list[float], hot: tuple | None):
        self.level, self.hot = level, hot
        self.parts = unpack(data) if data is not None else None
        if self.parts is None:
            return
        if level == 1:
            self.words, self.total = np.cumsum(self.parts[0], dtype=np.uint64), self.parts[1]
            return
        steps_, n, self.words, self.total, seen = self.parts
        self.histories = np.cumsum(steps_)
        self.begin = np.cumsum(n) - n
        self.wide = int(self.words.max()) + 1
        # places of histories are few enough for one key of place and word
        self.keys = np.repeat(np.arange(len(n)) * self.wide, n) + self.words
        small = np.repeat(np.arange(len(n)) * (DISCOUNTED + 2), n) + np.minimum(self.total, DISCOUNTED + 1)
        by_count = np.bincount(small, minlength=len(n) * (DISCOUNTED + 2)).reshape(-1, DISCOUNTED + 2)[:, :DISCOUNTED + 1]
        self.nothing, self.alpha = _alpha(by_count, np.add.reduceat(self.total, self.begin), seen, d)

    def singles(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, place) of words."""
        if self.parts is None:
            return np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
        at, there = _found(self.words, word)
        return np.where(there, self.total[at], 0), at

    def pairs(self, histories: np.ndarray, n: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, ...]:
        """(count, place, whether the history leaves nothing, alpha) of words after histories."""
        count, place = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
        nothing, alpha = np.zeros(len(histories), bool), np.ones(len(histories))
        if self.parts is not None:
            at, there = _found(self.histories, histories)
            nothing, alpha = there & self.nothing[at], np.where(there, self.alpha[at], 1.0)
            place, same = _found(self.keys, np.repeat(at * self.wide, n) + np.minimum(word, self.wide - 1))
            count = np.where(same & (word < self.wide) & np.repeat(there, n), self.total[place], 0)
        if self.hot is not None:
            at, there = _found(self.hot[0], histories)
            nothing, alpha = np.where(there, self.hot[1][at], nothing), np.where(there, self.hot[2][at], alpha)
        return count, place, np.repeat(nothing, n), np.repeat(alpha, n)


def _looked_up(level: int, d: list[float], hot: Broadcast | None, buckets: int, numbered: bool):
    """Answer each message to a bucket: per n-gram twice its count (one more if its history leaves nothing), its node, and alpha for those not seen."""
    def run(group: pa.Table) -> pa.Table:
        blocks, data = group["block"].to_pylist(), group["data"].to_pylist()
        bucket = group["bucket"][0].as_py()
        table = _Table(level, next((x for b, x in zip(blocks, data) if b is None), None), d, hot.value if hot is not None else None)
        out = []
        for block, message in zip(blocks, data):
            if block is None:
                continue
            if level == 1:
                count, place = table.singles(*unpack(message))
                value, weights = count * 2, []
            else:
                count, place, nothing, alpha = table.pairs(*unpack(message))
                value, weights = count * 2 + nothing, [alpha[count == 0]]
            node = np.where(count > 0, place * buckets + bucket + 1, 0) if numbered else np.zeros(len(count), np.int64)
            out.append((block, bucket, pack(value, node, *weights)))
        return pa.table({c: pa.array(v, t) for c, v, t in zip(("block", "bucket", "data"), zip(*out) if out else ([], [], []), (pa.int64(), pa.int64(), pa.binary()))})

    return run


def _look_up(corpus: Corpus, model: Model, level: int) -> None:
    """Add the answers of a level to the corpus."""
    table = model.tables[level - 1].where("history IS NULL").select("bucket", F.lit(None).cast("long").alias("block"), "data")
    asked = _sent(corpus, model, level, False)
    lookup = _looked_up(level, model.discounts[level - 1], model.hot[level - 1], model.buckets, level == 1 or level < model.order)
    answers = asked.unionByName(table).groupBy("bucket").applyInArrow(lookup, "block long, bucket long, data binary")
    corpus.answers.append(stored(answers, f"answers-{level}"))


def fit(corpus: Corpus, order: int = ORDER) -> Model:
    """Count the marked texts of a corpus; tables of all levels are stored. The corpus keeps its answers of all levels but the last."""
    buckets = max(1, math.ceil(corpus.tokens / BUCKET_PAIRS))
    model = Model(order, buckets, max(BUCKET_PAIRS // 4, corpus.tokens // HOT_HISTORIES))
    corpus.answers.clear()
    for level in range(1, order + 1):
        if level > 1:
            _look_up(corpus, model, level - 1)
        merge = _counted(level, model.discounts[-1] if level > 1 else None, model.hot_from)
        table = _sent(corpus, model, level, True).groupBy("bucket").applyInArrow(merge, "bucket long, history long, stats array<long>, seen double, data binary")
        table = stored(table, f"ngrams-{level}")
        sums = [F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)) for i in range(DISCOUNTED + 4)]
        *seen, distinct, total = table.where("history IS NULL").agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
        d = discounts(seen)
        model.tables.append(table)
        model.discounts.append(d)
        if level == 1:
            freed = sum(r * seen[r] * (1 - d[r]) for r in range(1, DISCOUNTED + 1))
            model.words, model.vocabulary = total, distinct
            model.total = total if freed else total + 1
            model.unknown = freed / total if freed else 1 / (total + 1)
            model.hot.append(None)
            continue
        dealt = table.where("history IS NOT NULL").groupBy("history").agg(*[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(DISCOUNTED + 2)], F.sum("seen").alias("seen"))
        rows = dealt.orderBy("history").toArrow()  # HOT_HISTORIES at most: each has that share of all words
        hot = None
        if rows.num_rows:
            numbers = np.stack([rows[f"s{i}"].to_numpy() for i in range(DISCOUNTED + 1)], axis=1)
            hot = (rows["history"].to_numpy(), *_alpha(numbers, rows[f"s{DISCOUNTED + 1}"].to_numpy(), rows["seen"].to_numpy(), d))
        model.hot.append(corpus.blocks.sparkSession.sparkContext.broadcast(hot) if hot else None)
    return model


def score(corpus: Corpus, model: Model) -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score) of every row; scores are log10 probabilities."""
    for level in range(len(corpus.answers) + 1, model.order + 1):
        _look_up(corpus, model, level)
    numbers, order = model.numbers(), model.order
    names = ["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches):
        for _, ids, held in _each_block(batches, order + 1, numbers):
            add = functools.partial(np.add.reduceat, indices=held.first)
            yield pa.RecordBatch.from_arrays(
                [ids.values, pa.array(held.trained[held.first]), pa.array(held.sizes), pa.array(add(held.known.astype(np.int64))),
                 pa.array(np.full(len(held.sizes), numbers["words"], np.int64)), pa.array(add(held.base)), pa.array(add(held.score))], names)

    return _gathered(corpus, order + 1).mapInArrow(
        run, f"doc_id {corpus.id_type}, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for documents that the registered query does not learn from; a null id is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def score_documents(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) by a model of the documents that are not held out."""
    corpus = tokens(docs, ~held_out())
    scored = score(corpus, fit(corpus, order))
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
