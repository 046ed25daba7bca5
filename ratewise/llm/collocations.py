"""Phrases whose words belong together, mined per language with stripes.

A stripe is the associative counter of the words that follow one prefix; the
words that end a piece, or that cannot be part of a frequent phrase, are counted
under null. Tasks count stripes of blocks of text, and stripes of one prefix are
merged elementwise. A level's stripes have prefixes of one length, from none to
three words, and give all that is asked for: their counters are the extensions, their sums
the totals of the prefixes (the empty prefix: all words of a language), and
the extensions' counts, passed on to the phrases inside them, the subsumption
maxima.

A phrase can be frequent only if its first and last words without the
other end are. Those of the level before are marked in a filter of bounded size;
it only saves work, a phrase passed by chance is dropped by its own count. The stripe
of a prefix with a large share of all words is dealt by next word to several
tasks; at most ``HOT_PREFIXES`` prefixes can have that share. The empty prefix's is always dealt.

Words are those of the contract: A-Z lower-cased, pieces split at ``[.,;:!?\\x0A-\\x0D]``,
words at blanks and tabs. A null text has no words; a null language is ``und``.
Repeated rows count each. Other columns are ignored whatever their names. An
empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import steps, stored

LEAST, WORDS, TOP = 30, 4, 2000
SCALE, COVERED_PERCENT = 2_000_000, 80
#: Bytes of text counted together; bits of the largest filter; prefixes that may be dealt, ways in which a stripe is dealt.
BLOCK_BYTES, FILTER_BITS, HOT_PREFIXES, WAYS = 16 << 20, 26, 4096, 64

_CUT = b"\xff"  # never part of UTF-8
_TABLE = bytes(c + 32 if 65 <= c <= 90 else 0xFF if c in b".,;:!?" or 10 <= c <= 13 else 32 if c == 9 else c for c in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def pieces_marked(text: str) -> list[bytes]:
    """Words in order, with a mark between pieces."""
    # ASCII blanks that split() cuts at are word or piece ends, and no others
    return text.encode().translate(_TABLE).replace(_CUT, b" \xff ").split()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _BASE
    return h ^ (h >> np.uint64(32))


class _Counter:
    """Words of one language in one block, numbered; 0 is the mark between pieces."""

    def __init__(self, lang: str):
        self.lang, self.ids = lang, defaultdict()
        self.ids.default_factory = self.ids.__len__
        self.ids[_CUT]
        self.runs: list[np.ndarray] = []

    def add(self, text: str) -> None:
        words = pieces_marked(text)
        words.append(_CUT)
        self.runs.append(np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words)))

    def stripes(self, size: int, passing, hot: frozenset) -> pa.RecordBatch | None:
        """Stripes of prefixes of ``size`` words: (lang, prefix, way, next, n), the last two lists."""
        words = np.concatenate(self.runs)
        names = list(self.ids)
        hashes = _mixed(np.fromiter((xxhash.xxh64_intdigest(w) for w in names), np.uint64, len(names)) ^ np.uint64(xxhash.xxh64_intdigest(self.lang.encode())))
        ways = (hashes >> np.uint64(40)) % np.uint64(WAYS)
        text = pa.array(names, pa.binary())

        if size == 0:
            count = np.bincount(words, minlength=len(names))
            kept = np.arange(1, len(names))
            prefix, follow, n, way = np.zeros((0, len(kept)), np.int64), kept, count[1:], ways[1:]
        else:
            starts = np.arange(len(words) - size)  # the last word is a mark
            good = passing(hashes) & (np.arange(len(names)) > 0) if size == 1 else np.arange(len(names)) > 0
            ok = good[words]
            for i in range(size):
                starts = starts[ok[starts + i]]
            if size > 1:
                starts = starts[passing(_phrase(hashes, words, starts, size))]
            after = words[starts + size].astype(np.int64)
            follows = after > 0
            if size == 1:
                follows &= good[after]
            else:
                follows[follows] = passing(_phrase(hashes, words, starts[follows] + 1, size))
            after[~follows] = 0
            if not len(starts):
                return None
            # number the prefixes, then count (prefix, next)
            key = words[starts].astype(np.int64)
            for i in range(1, size):
                _, key = np.unique(key * len(names) + words[starts + i], return_inverse=True)
            _, first, key = np.unique(key, return_index=True, return_inverse=True)
            pairs, n = np.unique(key * len(names) + after, return_counts=True)
            which, follow = pairs // len(names), pairs % len(names)
            at = starts[first]
            prefix = np.stack([words[at + i] for i in range(size)])[:, which]
            prefix_hash = _phrase(hashes, words, at, size)
            dealt = np.fromiter((h in hot for h in prefix_hash.tolist()), bool, len(at)) if hot else np.zeros(len(at), bool)
            way = np.where(dealt[which], ways[follow], 0)
        if not len(follow):
            return None
        # one row per (prefix, way)
        group = way if size == 0 else which * WAYS + way.astype(np.int64)
        order = np.argsort(group, kind="stable")
        group, follow, n, prefix, way = group[order], follow[order], n[order], prefix[:, order], way[order]
        cut = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        offsets = pa.array(np.append(cut, len(group)).astype(np.int32))
        nexts = text.take(pa.array(follow, mask=follow == 0)).cast(pa.string())
        parts = [text.take(pa.array(p[cut])).cast(pa.string()) for p in prefix]
        joined = pc.binary_join_element_wise(*parts, " ") if size > 1 else parts[0] if size else pa.array([""] * len(cut), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([self.lang] * len(cut), pa.string()), joined, pa.array(way[cut].astype(np.int32)),
             pa.ListArray.from_arrays(offsets, nexts), pa.ListArray.from_arrays(offsets, pa.array(n.astype(np.int64)))], ["lang", "prefix", "way", "next", "n"])


def _phrase(hashes: np.ndarray, words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Hash of the phrases of ``size`` words at ``starts``; a single word's is its own."""
    h = hashes[words[starts]]
    for i in range(1, size):
        h = _mixed(h * _BASE + hashes[words[starts + i]])
    return h


def phrase_hash(lang: str, phrase: str) -> int:
    names = phrase.encode().split(b" ")
    own = _mixed(np.array([xxhash.xxh64_intdigest(w) for w in names], np.uint64) ^ np.uint64(xxhash.xxh64_intdigest(lang.encode())))
    return int(_phrase(own, np.arange(len(names)), np.zeros(1, np.int64), len(names))[0])


class _Filter:
    """A bit per hash value; bits of other phrases may be set by chance."""

    def __init__(self, bits: int, slots: np.ndarray, values: np.ndarray):
        self.bits = bits
        self.set = np.zeros(1 << (bits - 5), np.uint32)
        self.set[slots] = values

    def __call__(self, h: np.ndarray) -> np.ndarray:
        slot = h >> np.uint64(64 - self.bits)
        return (self.set[(slot >> np.uint64(5)).astype(np.int64)] >> (slot & np.uint64(31)).astype(np.uint32) & np.uint32(1)).astype(bool)


def _hashed(phrases: DataFrame) -> DataFrame:
    """(hash, f) of (lang, phrase, f)."""
    def run(batches):
        for b in batches:
            h = [phrase_hash(lang, p) for lang, p in zip(b.column("lang").to_pylist(), b.column("phrase").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(h, np.uint64).view(np.int64)), b.column("f")], ["hash", "f"])

    return phrases.select("lang", "phrase", "f").mapInArrow(run, "hash long, f long")


def _known(phrases: DataFrame, total: int):
    """(broadcast filter of the phrases, hashes of those with a large share of all words)."""
    hashed = stored(_hashed(phrases), "frequent-phrases")
    bits = max(10, min(FILTER_BITS, (16 * hashed.count()).bit_length()))
    slot = F.expr(f"shiftrightunsigned(hash, {64 - bits})")
    marked = (hashed.select(F.shiftright(slot, 5).alias("slot"), slot.bitwiseAND(F.lit(31)).cast("int").alias("bit"))
              .groupBy("slot").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow())  # 2**(FILTER_BITS - 5) rows at most
    known = _Filter(bits, marked["slot"].to_numpy(), marked["bits"].to_numpy().astype(np.uint32))
    # phrases of one length that have so large a share are HOT_PREFIXES at most
    hot = hashed.where(F.col("f") > max(total // HOT_PREFIXES, 100 * LEAST)).select("hash").toArrow()["hash"].to_numpy()
    return phrases.sparkSession.sparkContext.broadcast((known, frozenset(hot.view(np.uint64).tolist())))


def _merged(docs: DataFrame, size: int, known, least: int) -> DataFrame:
    """Stored (lang, prefix, next, n): merged stripes of prefixes of ``size`` words; rarer words than ``least`` are under null."""
    def run(batches: Iterator[pa.RecordBatch]):
        passing, hot = known.value if known else (None, frozenset())
        held: dict[str, _Counter] = {}
        room = 0
        for b in steps(batches, "text"):
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                if text:
                    held.setdefault(lang, _Counter(lang)).add(text)
                    room += len(text)
            if room >= BLOCK_BYTES:
                yield from filter(None, (c.stripes(size, passing, hot) for c in held.values()))
                held, room = {}, 0
        yield from filter(None, (c.stripes(size, passing, hot) for c in held.values()))

    stripes = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(
        run, "lang string, prefix string, way int, next array<string>, n array<long>")
    # stripes travel whole; their counters are added where they meet
    met = stripes.repartition("lang", "prefix", "way").select("lang", "prefix", "way", F.explode(F.arrays_zip("next", "n")).alias("e"))
    merged = met.groupBy("lang", "prefix", "way", F.col("e.next").alias("next")).agg(F.sum("e.n").alias("n"))
    kept = F.when(F.col("n") >= least, F.col("next"))
    return stored(merged.groupBy("lang", "prefix", "way", kept.alias("next")).agg(F.sum("n").alias("n")).select("lang", "prefix", "next", "n"), f"stripes-{size}")


def stripes(docs: DataFrame, least: int = LEAST, words: int = WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(totals, phrases, extensions): (lang, n); (lang, phrase, f) up to ``words`` - 1 words; (lang, prefix, next, a) of two words or more.

    Phrases and extensions are all those counted ``least`` times or more, with their exact counts.
    """
    level = _merged(docs, 0, None, least)
    totals = stored(level.groupBy("lang").agg(F.sum("n").alias("n")), "language-totals")
    total = totals.agg(F.sum("n")).first()[0] or 0
    frequent = level.where("next IS NOT NULL").groupBy("lang", F.col("next").alias("phrase")).agg(F.sum("n").alias("f"))
    found, extensions = [], []
    for size in range(1, words):
        level = _merged(docs, size, _known(frequent, total), least)
        found.append(level.groupBy("lang", F.col("prefix").alias("phrase")).agg(F.sum("n").alias("f")).where(F.col("f") >= least))
        # a stripe that was dealt has its next words in one way each
        extensions.append(level.where("next IS NOT NULL").select("lang", "prefix", "next", F.col("n").alias("a")))
        frequent = extensions[-1].select("lang", F.concat_ws(" ", "prefix", "next").alias("phrase"), F.col("a").alias("f"))
    return totals, functools.reduce(DataFrame.unionByName, found), functools.reduce(DataFrame.unionByName, extensions)


def collocations(docs: DataFrame, least: int = LEAST, words: int = WORDS, top: int = TOP, covered_percent: int = COVERED_PERCENT) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best phrases of two words or more."""
    totals, phrases, extensions = stripes(docs, least, words)
    phrases = stored(phrases, "phrases")
    found = stored(extensions.select("lang", F.concat_ws(" ", "prefix", "next").alias("phrase"), "a").withColumn("words", F.split("phrase", " ")), "candidates")
    part = lambda begin, size: F.array_join(F.slice("words", begin, size), " ")
    wide = lambda c: F.col(c).cast("decimal(38,0)")

    # subsumption maxima: every extension tells the phrases inside it how often it occurs
    inside = (found.where(F.size("words") > 2)
              .select("lang", "a", "words", F.explode(F.expr("sequence(2, size(words) - 1)")).alias("k"))
              .select("lang", "a", "words", "k", F.explode(F.expr("sequence(1, size(words) - k + 1)")).alias("at"))
              .groupBy("lang", part(F.col("at"), F.col("k")).alias("phrase")).agg(F.max("a").alias("longest")))
    free = found.join(inside, ["lang", "phrase"], "left").where(
        F.col("longest").isNull() | (wide("longest") * 100 < wide("a") * covered_percent)).drop("longest")

    # all cuts; every part is counted at least as often as its phrase
    cuts = free.withColumn("k", F.explode(F.expr("sequence(1, size(words) - 1)")))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.size("words") - F.col("k")).alias("rest"))
    side = lambda name, f: phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = cuts.join(side("head", "l"), ["lang", "head"]).join(side("rest", "r"), ["lang", "rest"])
    scored = cuts.withColumn("score", F.expr(f"(cast(a as decimal(38,0)) * {SCALE}) div (cast(l as decimal(38,0)) + cast(r as decimal(38,0)))"))
    worst = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("worst"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = worst.select("lang", "phrase", "a", "worst.l", "worst.r", "worst.score").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
