"""Language identification with language-bitmask n-gram filters.

For each language the character n-grams (lower case, letters only, one blank
between words) that are typical of it are put into a Bloom filter. All
languages share one bit-sliced filter: each slot holds a word with one bit per
language, so and-ing an n-gram's few slots returns every language that may
contain it. A text's score per language is the number of its n-grams with that
language's bit (a popcount), corrected for the filter's false positives, as a
share of all its n-grams; the highest decides.

Fit: at most ``SAMPLE_CHARS`` characters of text per language (a bound on the
fit only, spread over documents by hash) give the n-gram counts. An n-gram is typical of a language if its
relative frequency there is at least ``SHARE`` of its highest one.

Null texts and texts without a letter give ``und`` and score 0. Empty
training data give a model without languages, which answers ``und`` throughout.
Ties go to the smaller language name. Null languages are not learned from.
Repeated rows are scored each; columns besides doc_id, text (and lang in the
fit) are ignored whatever their names.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import steps, stored
from ratewise.llm.ngrams import clean, ngrams, passes

#: Least and most characters of an n-gram.
SIZES = (2, 4)
SLOT_BITS, HASHES = 20, 2
SAMPLE_CHARS = 4_000_000
LEAST_COUNT, SHARE = 3, 0.2
UNKNOWN = "und"
_BITS = np.arange(256)[:, None] >> np.arange(8) & 1


def _slots(h: np.ndarray, bits: int, hashes: int) -> list[np.ndarray]:
    """Slots of n-gram hashes; double hashing with an odd step."""
    mask = np.uint64((1 << bits) - 1)
    step = (h >> np.uint64(40)) | np.uint64(1)
    return [((h + np.uint64(k) * step) & mask).view(np.int64) for k in range(hashes)]


@dataclass(frozen=True)
class LanguageFilters:
    """``slices[b]``: one byte per slot, with a bit for each of languages 8 b to 8 b + 7."""

    languages: tuple[str, ...]
    slices: np.ndarray
    hashes: int

    @functools.cached_property
    def false_rates(self) -> np.ndarray:
        """Chance that an n-gram not in a language's filter passes it."""
        fill = [np.mean(self.slices[i // 8] >> (i % 8) & 1) for i in range(len(self.languages))]
        return np.minimum(np.array(fill) ** self.hashes, 0.999)

    def shares(self, text: str | None) -> np.ndarray | None:
        """Per language the corrected share of the text's n-grams; None without a letter."""
        passed = np.zeros((len(self.slices), 256), dtype=np.int64)  # n-grams by the byte of languages that the filters return
        total, bits = 0, int(self.slices.shape[1]).bit_length() - 1
        for part in passes(text or ""):
            for h in ngrams(clean(part), *SIZES):
                total += len(h)
                slots = _slots(h, bits, self.hashes)
                for k, own in enumerate(self.slices):
                    passed[k] += np.bincount(functools.reduce(np.bitwise_and, (own[s] for s in slots)), minlength=256)
        if not total:
            return None
        hits = (passed @ _BITS).reshape(-1)[:len(self.languages)]
        return np.clip((hits / total - self.false_rates) / (1 - self.false_rates), 0, 1)


def fit(docs: DataFrame, bits: int = SLOT_BITS, hashes: int = HASHES, sample_chars: int = SAMPLE_CHARS) -> LanguageFilters:
    """Filters from ``text`` and ``lang``; rows where either is null teach nothing."""
    rows = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select(F.col("text"), F.col("lang").cast("string"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.sum(F.length("text")).alias("n")).collect()}  # a row per language
    languages = tuple(sorted(sizes))
    code = {name: i for i, name in enumerate(languages)}
    slices = np.zeros((max(1, -(-len(languages) // 8)), 1 << bits), dtype=np.uint8)
    if not languages:
        return LanguageFilters(languages, slices, hashes)
    # all 64 bits of the hash decide: a share of any size keeps its texts
    last = {k: min(max((1 << 64) * sample_chars // max(1, sizes[k]) - 1, 0) - (1 << 63), (1 << 63) - 1) for k in languages}
    sample = rows.where(F.xxhash64("text") <= F.element_at(F.create_map(*[F.lit(x).cast(t) for k in languages for x, t in ((k, "string"), (last[k], "long"))]), F.col("lang")))

    def count(batches):
        held: dict[int, list] = {}
        for b in steps(batches, "text"):
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
                for part in passes(text):
                    held.setdefault(code[lang], []).extend(ngrams(clean(part), *SIZES))
            for i, found in held.items():
                if sum(map(len, found)) > 4_000_000:
                    yield from rows_of(i, found)
                    held[i] = []
        for i, found in held.items():
            yield from rows_of(i, found)

    def rows_of(i, found):
        if found:
            h, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), i, np.int32)), pa.array(h.view(np.int64)), pa.array(n)],
                                             ["lang", "gram", "n"])

    counts = sample.mapInArrow(count, "lang int, gram long, n long").groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    # stored once: the totals and the typical n-grams both come from it
    counts = stored(counts, "ngram-counts")
    total = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    rate = F.col("n") / F.element_at(F.create_map(*[F.lit(x) for k, v in total.items() for x in (k, float(v))]), F.col("lang"))
    by_gram = counts.withColumn("rate", rate).groupBy("gram").agg(F.max("rate").alias("best"), F.collect_list(F.struct("lang", "n", "rate")).alias("own"))
    typical = by_gram.select("gram", F.explode("own").alias("o"), "best").where(
        (F.col("o.n") >= LEAST_COUNT) & (F.col("o.rate") >= SHARE * F.col("best"))).select("gram", F.col("o.lang").alias("lang"))

    def fill(batches):
        for b in batches:
            grams, lang = b.column("gram").to_numpy(zero_copy_only=False).view(np.uint64), b.column("lang").to_numpy(zero_copy_only=False)
            for s in _slots(grams, bits, hashes):
                yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(lang // 8), pa.array(1 << lang % 8)],
                                                 ["slot", "slice", "mask"])

    masks = typical.mapInArrow(fill, "slot long, slice int, mask int").groupBy("slot", "slice").agg(F.bit_or("mask").alias("mask"))
    got = masks.toArrow()  # 2**bits rows a slice at most
    slices[got["slice"].to_numpy(), got["slot"].to_numpy()] = got["mask"].to_numpy()
    return LanguageFilters(languages, slices, hashes)


def predict(docs: DataFrame, model: LanguageFilters, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, then lang_pred and score (0 to 1) of every row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits bytes a slice, whatever the input

    def run(batches):
        model = shared.value
        for b in steps(batches, "text"):
            langs, scores = [], []
            for text in b.column("text").to_pylist():
                shares = model.shares(text) if model.languages else None
                best = UNKNOWN if shares is None else model.languages[int(np.argmax(shares))]
                langs.append(best)
                scores.append(0.0 if shares is None else float(shares.max()))
            cols = [b.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             [*keep, "lang_pred", "score"])

    rows = docs.select(*keep, "text") if "text" not in keep else docs.select(*keep)
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, f"{fields}, lang_pred string, score double")


def accepted(docs: DataFrame, model: LanguageFilters, least: float) -> DataFrame:
    """The documents, all columns as they are, whose language is known with a score of ``least`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits bytes a slice, whatever the input

    def run(batches):
        model = shared.value
        for b in steps(batches, "text"):
            shares = [model.shares(t) if model.languages else None for t in b.column("text").to_pylist()]
            yield b.filter(pa.array([s is not None and float(s.max()) >= least for s in shares], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
