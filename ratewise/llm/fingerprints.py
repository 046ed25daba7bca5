"""Document fingerprints by a homomorphic multiset hash, in DataFrame functions only.

A text is the multiset of its paragraphs: sentences and lines, cut after every
``.``, ``!``, ``?`` and line end. A stretch longer than ``LONG`` characters is cut
further by its content: after words whose hash, taken with the word before,
says so (one in ``WORDS``), and pieces that stay longer than ``LONGEST`` in the same way after
characters (one in ``CHARS``). So cuts move with the text around them, and an
edit changes the pieces it touches only. No character is lost. Each paragraph is hashed to a wide vector and a
fingerprint is the sum of its paragraphs' vectors, each component modulo a
power of two. So the order of paragraphs does not matter, equal multisets have
equal fingerprints, and paragraphs can be added or taken away by adding or
subtracting their fingerprints (:func:`combine`).

The vector has ``DENSE`` components modulo 2**62, to which every paragraph
adds: these decide equality. Its ``LEVELS * LANES`` others, modulo 2**14, are
sparse: a paragraph adds to one lane of one level, and level k gets a share of
3/4 * 4**-k of them. The lanes that differ between two fingerprints tell how
many paragraphs differ, which gives :func:`likeness`. Lanes are kept four to a
number, 15 bits apart, so that one addition and one mask add four of them.

Null text counts as empty: no paragraphs, all components 0. Two empty texts are
alike (1.0). Repeated rows and null ids are kept. Other columns are ignored
whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import stored

DENSE, LEVELS, LANES = 4, 5, 64
#: A level with more differing lanes than this is too full to count by.
FULL = 48
#: Characters beyond which a stretch is cut after words (one in WORDS), and a piece after characters (one in CHARS).
LONG, WORDS, LONGEST, CHARS = 240, 6, 1024, 48
_DENSE_MASK = (1 << 62) - 1
#: Bits of a lane, bits from one lane to the next, lanes to a number; the numbers with all lanes full, and with 1 in each.
_LANE_BITS, _FIELD, _PER = 14, 15, 4
_ONES = sum(1 << _FIELD * i for i in range(_PER))
_FULL_LANES = _ONES * ((1 << _LANE_BITS) - 1)
_GROUPS = LANES // _PER
#: Bytes of text that one bucket of neighbouring documents is meant to hold.
BUCKET_BYTES = 8 << 20
#: Buckets at most, as their begins go to all tasks; beyond MOST_BUCKETS * BUCKET_BYTES (1 TB) they hold more, and the sort of a bucket spills.
MOST_BUCKETS = (1 << 17) - 1


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _cut(piece: Column, between: str, one_in: int) -> Column:
    """The piece cut after those parts (of a split at ``between``) whose hash with the part before falls on 0."""
    marked = lambda parts: F.transform(parts, lambda p, i: F.when(
        F.pmod(F.xxhash64(F.get(parts, i - 1), p), F.lit(one_in)) == 0, F.concat(p, F.lit("\x01"))).otherwise(p))
    return F.split(F.array_join(_let(F.split(piece, between, -1), marked), ""), "\x01", -1)


def _cut_long(pieces: Column, longest: int, between: str, one_in: int) -> Column:
    return F.flatten(F.transform(pieces, lambda p: F.when(F.length(p) > longest, _cut(p, between, one_in)).otherwise(F.array(p))))


def paragraphs(text: Column) -> Column:
    """The text cut after line ends and sentence ends, long stretches by their content.

    Pieces joined again give the text, in which the control characters 1 and 2 are written as 2 with a letter,
    since 1 marks cuts.
    """
    plain = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\x02"), F.lit("\x02b")), F.lit("\x01"), F.lit("\x02a"))
    pieces = F.split(plain, r"(?<=[.!?\n])", -1)
    pieces = _cut_long(pieces, LONG, r"(?<=\s)", WORDS)
    return F.filter(_cut_long(pieces, LONGEST, "", CHARS), lambda p: p != "")


def _level(h: Column) -> Column:
    out = F.lit(LEVELS - 1)
    for k in reversed(range(LEVELS - 1)):
        out = F.when(h.bitwiseAND(F.lit(3 << 2 * k)) != 0, F.lit(k)).otherwise(out)
    return out


def _lanes(hashes: Column) -> Column:
    """Sums of all lanes, _PER to a number, in one pass over the paragraphs in the order of their numbers.

    Bits 16 to 21 of a hash pick the lane of its level, bits 32 to 45 are what is added (made odd). A paragraph is
    the number's index, its lane's place there and what it adds; an entry that adds nothing stands for each number.
    """
    low = (1 << _LANE_BITS) - 1

    def entry(h: Column) -> Column:
        lane = _level(h) * LANES + F.shiftright(h, 16).bitwiseAND(F.lit(LANES - 1))
        return F.shiftleft(lane, _LANE_BITS).bitwiseOR(F.shiftright(h, 32).bitwiseAND(F.lit(low))).bitwiseOR(F.lit(1))

    index = lambda e: F.shiftright(e, _LANE_BITS + 2)
    place = lambda e: F.shiftright(e, _LANE_BITS).bitwiseAND(F.lit(_PER - 1)).cast("int")
    adds = lambda e: F.call_function("shiftleft", e.bitwiseAND(F.lit(low)), place(e) * _FIELD)
    state = lambda at, held, done: F.struct(at.alias("at"), held.alias("held"), done.alias("done"))
    every = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(LEVELS * _GROUPS - 1).cast("long")), lambda i: F.shiftleft(i, _LANE_BITS + 2))
    return F.aggregate(
        F.sort_array(F.concat(F.transform(hashes, entry), every)),
        state(F.lit(0).cast("long"), F.lit(0).cast("long"), F.array().cast("array<long>")),
        lambda acc, e: F.when(index(e) == acc["at"], state(acc["at"], (acc["held"] + adds(e)).bitwiseAND(F.lit(_FULL_LANES)), acc["done"]))
        .otherwise(state(index(e), adds(e), F.array_append(acc["done"], acc["held"]))),
        lambda acc: F.array_append(acc["done"], acc["held"]))


def _dense(units: Column, seed: int) -> Column:
    return F.aggregate(units, F.lit(0).cast("long"), lambda acc, p: (
        acc + F.xxhash64(F.lit(seed), p).bitwiseAND(F.lit(_DENSE_MASK))).bitwiseAND(F.lit(_DENSE_MASK)))


def with_fingerprint(rows: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``: struct(n paragraphs, dense array<long>, lanes array<long>, four to a number) of column ``text``."""
    units, hashes = f"{name}__units", f"{name}__hashes"
    rows = rows.withColumn(units, paragraphs(F.col(text)))
    rows = rows.withColumn(hashes, F.transform(units, lambda p: F.xxhash64(p)))
    dense = [_dense(F.col(units), k) for k in range(DENSE)]
    lanes = _lanes(F.col(hashes))
    return rows.withColumn(name, F.struct(F.size(units).cast("long").alias("n"), F.array(*dense).alias("dense"), lanes.alias("lanes"))).drop(units, hashes)


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint of a's paragraphs with b's added (``sign`` 1) or taken away (-1)."""
    over = _ONES << _LANE_BITS
    dense = lambda x, y: (x + (y if sign > 0 else F.lit(_DENSE_MASK) - y + 1)).bitwiseAND(F.lit(_DENSE_MASK))
    lanes = lambda x, y: (x + y if sign > 0 else x + F.lit(over) - y).bitwiseAND(F.lit(_FULL_LANES))
    return F.struct((a["n"] + sign * b["n"]).alias("n"), F.zip_with(a["dense"], b["dense"], dense).alias("dense"),
                    F.zip_with(a["lanes"], b["lanes"], lanes).alias("lanes"))


def as_text(fingerprint: Column) -> Column:
    """Fixed-width hexadecimal: the number of paragraphs, dense components, lanes."""
    part = lambda array, width: F.array_join(F.transform(array, lambda x: F.lpad(F.lower(F.hex(x)), width, "0")), "")
    return F.concat(F.lpad(F.lower(F.hex(fingerprint["n"])), 16, "0"), part(fingerprint["dense"], 16), part(fingerprint["lanes"], 15))


def _count(lanes: Column) -> Column:
    """Estimated number of distinct paragraphs behind the lanes that are not 0.

    Of LANES lanes, d are hit by about ln(1 - d / LANES) / ln(1 - 1 / LANES)
    paragraphs; the fullest level that is still countable and those above it
    hold a share of 4**-k of all.
    """
    hit = lambda x: F.bit_count((x + _FULL_LANES).bitwiseAND(F.lit(_ONES << _LANE_BITS)))

    def total(d: Column) -> Column:
        counts = [F.element_at(d, k + 1) for k in range(LEVELS)]
        found = [F.log(1 - F.least(c, F.lit(LANES - 0.5)) / LANES) / math.log(1 - 1 / LANES) for c in counts]
        out = found[-1] * 4 ** (LEVELS - 1)
        for k in reversed(range(LEVELS - 1)):
            out = F.when(counts[k] <= FULL, sum(found[k + 1:], found[k]) * 4 ** k).otherwise(out)
        return out

    counts = _let(lanes, lambda held: F.array(*[
        F.aggregate(F.slice(held, k * _GROUPS + 1, _GROUPS), F.lit(0), lambda acc, x: acc + hit(x)) for k in range(LEVELS)]))
    return _let(counts, total)


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of distinct paragraphs in common (Dice), 1.0 for equal fingerprints."""
    differ = _count(F.zip_with(a["lanes"], b["lanes"], lambda x, y: x.bitwiseXOR(y)))
    share = 1 - differ / F.greatest(_count(a["lanes"]) + _count(b["lanes"]), F.lit(1.0))
    same = (a["n"] == b["n"]) & (a["dense"] == b["dense"])
    return F.when(same, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(share, F.lit(1.0))))


def _lead(column: str) -> Column:
    """The column of the next document: within a bucket by id, a copy of the next bucket's first one last."""
    return F.lead(column).over(Window.partitionBy("bucket").orderBy("ahead", "place"))


def with_next(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Rows with ``next_text``, and copies marked ``ahead`` to be dropped: the next document by ascending id (nulls first, ties by the text's hash); the last one's is the first.

    Ids alone are range-partitioned to find where buckets begin. Documents then
    move once, to their bucket, where the next row is the one below; the first
    of each bucket also goes to the end of the bucket before.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("place", F.struct(F.coalesce("doc_id", F.lit(-1 << 63)).alias("id"), F.xxhash64("text").alias("hash")))
    ids = stored(rows.select("place", F.octet_length("text").cast("long").alias("bytes")), "document-ids")
    size = ids.agg(F.sum("bytes").alias("bytes")).first()["bytes"] or 0
    ranged = ids.repartitionByRange(max(1, min(MOST_BUCKETS, -(-size // bucket_bytes))), "place")
    firsts = stored(ranged.groupBy(F.spark_partition_id().alias("part")).agg(F.min("place").alias("place")), "bucket-begins")
    begins = firsts.agg(F.sort_array(F.collect_list("place")).alias("begins")).scalar()  # MOST_BUCKETS entries at most
    # how many buckets begin at or before a place, found bit by bit
    bits = F.array(*[F.lit(1 << k) for k in reversed(range(MOST_BUCKETS.bit_length()))])
    passed = F.aggregate(bits, F.lit(0), lambda n, step: F.when(F.get("begins", n + step - 1) <= F.col("place"), n + step).otherwise(n))
    rows = rows.withColumn("begins", begins).withColumn("bucket", passed - 1)
    first = F.get("begins", F.col("bucket")) == F.col("place")
    before = F.pmod(F.col("bucket") - 1, F.size("begins"))
    own, ahead = F.struct("bucket", F.lit(False).alias("ahead")), F.struct(before.alias("bucket"), F.lit(True).alias("ahead"))
    to = F.explode(F.when(first, F.array(own, ahead)).otherwise(F.array(own)))
    rows = rows.select("doc_id", "text", "place", to.alias("to")).select("doc_id", "text", "place", "to.bucket", "to.ahead")
    return rows.withColumn("next_text", _lead("text"))


def fingerprint_edits(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and how like it the edited text and the next document are.

    The edited text has the last floor(n_chars / 2) code points replaced by the
    first as many of the next document.
    """
    rows = with_next(docs, bucket_bytes)
    rows = with_fingerprint(rows, "text", "own")
    rows = rows.withColumn("next", _lead("own")).where(~F.col("ahead"))
    chars, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    rows = rows.withColumn("edited_text", F.concat(F.substring("text", F.lit(1), chars - half), F.substring("next_text", F.lit(1), half)))
    rows = with_fingerprint(rows, "edited_text", "edited")
    return rows.select("doc_id", chars.cast("long").alias("n_chars"), F.sha2(F.col("edited_text"), 256).alias("edited_sha256"),
                       as_text(F.col("own")).alias("fingerprint"), as_text(F.col("edited")).alias("edited_fingerprint"),
                       likeness(F.col("own"), F.col("edited")).alias("near_edited"),
                       likeness(F.col("own"), F.col("next")).alias("near_next"))
