"""Toxicity by a counterfactual-regularised classifier.

Features are character n-grams (lower case, letters, one blank between words)
that occur in a text. Fit, on the distinct labelled texts of at most ``sample_chars`` characters
(chosen by hash; copies of a text weigh once, whatever their number; the bound limits the fit only):

1. Each distinct sentence counts as toxic if every text that has it is; n-grams
   clearly more frequent in toxic sentences become features (``most_features`` at most, the clearest), and so do those of
   the identity terms.
2. Counterfactuals: in every labelled sentence every identity term is swapped for ``swaps`` others of its kind,
   chosen by hash (of sentences without one, each ``plain_every``-th by hash gets one in front), which must not change the score.
3. Logistic regression over texts, and over those of their sentences that have
   a feature, minimises log loss + L2 + ``PENALTY`` times the mean squared change of the linear score over the counterfactual pairs,
   so that a neutral mention of a group moves no score.
4. Scale and base of the linear score are refitted on the whole texts.

Null and empty texts have no features and get the model's base score. Rows
without a label, and labels without a text, teach nothing; of repeated labels
of one document the higher counts. If labelled texts lack a class, or there are
none, there is no evidence against a document: the score is 0, below every threshold,
and ``accepted`` keeps all. Columns besides the named ones are ignored.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import release, steps, stored
from ratewise.llm.ngrams import clean, ngrams, passes

SIZES = (4, 6)
SAMPLE_CHARS = 30_000_000
THRESHOLD = 0.3
MOST_FEATURES, LEAST_SENTENCES, LEAST_Z, LEAST_SHARE = 8192, 5, 6.0, 0.5
PENALTY, L2, ROUNDS = 10.0, 1e-4, 400
#: Other terms that one identity term is swapped for; of sentences without a term every so many get one.
SWAPS, PLAIN_EVERY = 2, 8

#: Identity terms by kind; any two of a kind are counterfactuals of each other.
IDENTITY_TERMS = {
    "belief": ("atheist", "buddhist", "catholic", "christian", "hindu", "jewish", "muslim", "sikh"),
    "origin": ("african", "american", "arab", "asian", "european", "indian", "immigrant", "refugee"),
    "gender": ("female", "male", "man", "nonbinary", "transgender", "woman"),
    "love": ("bisexual", "gay", "heterosexual", "lesbian", "queer", "straight"),
    "body": ("blind", "deaf", "disabled", "elderly", "old", "young"),
    "looks": ("black", "brown", "white"),
}
_KIND = {t: k for k, terms in IDENTITY_TERMS.items() for t in terms}
_TERM = re.compile(r"\b(" + "|".join(sorted(_KIND, key=len, reverse=True)) + r")\b", re.IGNORECASE)
_SENTENCE = re.compile(r"[^.!?\n]+")


def _grams(text: str) -> np.ndarray:
    found = [np.unique(np.concatenate([*ngrams(clean(part), *SIZES), np.zeros(0, np.uint64)])) for part in passes(text, 64)]
    return np.unique(np.concatenate(found)) if len(found) > 1 else found[0] if found else np.zeros(0, np.uint64)


def counterfactuals(sentence: str, swaps: int = SWAPS, plain_every: int = PLAIN_EVERY) -> list[str]:
    """The sentence with one identity term swapped: each of its terms for ``swaps`` others of the kind, chosen by hash.

    A sentence without a term, if its hash falls on it, is returned with one in front.
    """
    found = list(_TERM.finditer(sentence))
    number = zlib.crc32(sentence.encode("utf-8", "surrogatepass"))
    if not found:
        if number % plain_every:
            return []
        terms = sorted(_KIND)
        return [f"{terms[number // plain_every % len(terms)]} {sentence}"]
    out = []
    for m in found:
        others = [t for t in IDENTITY_TERMS[_KIND[m[0].lower()]] if t != m[0].lower()]
        begin = (number + m.start()) % len(others)
        out += [sentence[:m.start()] + t + sentence[m.end():] for t in (others + others)[begin:begin + min(swaps, len(others))]]
    return out


@dataclass(frozen=True)
class ToxicityModel:
    """``grams``: sorted n-gram hashes with their ``weights``; ``base``: the linear score of a text without any."""

    grams: np.ndarray
    weights: np.ndarray
    base: float

    def present(self, text: str | None, filter_: np.ndarray) -> np.ndarray:
        """Indices of the features that occur in the text."""
        found = []
        for part in passes(text or "", 64):
            for h in ngrams(clean(part), *SIZES):
                h = h[filter_[(h & _FILTER_MASK).view(np.int64)]]
                at = np.searchsorted(self.grams, h)
                at[at == len(self.grams)] = 0
                found.append(at[self.grams[at] == h] if len(self.grams) else at[:0])
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def filter(self) -> np.ndarray:
        """A bit per slot: does some feature's hash fall there?"""
        out = np.zeros(int(_FILTER_MASK) + 1, dtype=bool)
        out[(self.grams & _FILTER_MASK).view(np.int64)] = True
        return out

    def score(self, text: str | None, filter_: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-(self.base + self.weights[self.present(text, filter_)].sum()))))


_FILTER_MASK = np.uint64((1 << 20) - 1)


def _sample(docs: DataFrame, labels: DataFrame, sample_chars: int) -> tuple[DataFrame, int, int]:
    """(text, toxic) of labelled texts, of at most about ``sample_chars`` characters, chosen by the text's hash; the numbers of all labelled texts and of toxic ones."""
    one = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text")
    sizes = texts.select("doc_id", F.length("text").alias("n")).join(one, "doc_id")
    found = sizes.agg(F.sum("n").alias("n"), F.count("*").alias("texts"), F.count_if(F.col("toxic") > 0).alias("toxic")).first()
    # all 64 bits of the hash decide: a share of any size keeps its texts
    last = max((1 << 64) * sample_chars // max(1, found["n"] or 0) - 1, 0) - (1 << 63)
    chosen = texts.where(F.xxhash64("text") <= F.lit(last)) if last < (1 << 63) - 1 else texts
    # copies are one row before anything is brought together
    return chosen.join(one, "doc_id").select("text", "toxic").distinct(), found["texts"], found["toxic"]


def _unlearned() -> ToxicityModel:
    """The model without evidence: every score is 0."""
    return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), -np.inf)


def _sentence_counts(sample: DataFrame) -> DataFrame:
    """(gram, n, toxic) over distinct sentences; the last row, gram null, has the totals."""
    def split(batches):
        release(memos=True)
        for b in steps(batches, "text"):
            rows = [(s.strip().lower(), y) for t, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist())
                    for s in _SENTENCE.findall(t) if s.strip()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32()))],
                                                 ["text", "toxic"])

    sentences = sample.mapInArrow(split, "text string, toxic int").groupBy("text").agg(F.min("toxic").alias("toxic"))

    def count(batches):
        held = {0: [], 1: []}
        number = [0, 0]

        def flush(y):
            h, n = np.unique(np.concatenate([*held[y], np.zeros(0, np.uint64)]), return_counts=True)
            held[y] = []
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n), pa.array(n * y)], ["gram", "n", "toxic"])

        for b in batches:
            for text, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                y = int(y > 0)
                held[y].append(_grams(text))
                number[y] += 1
            for y in held:
                if sum(map(len, held[y])) > 2_000_000:
                    yield flush(y)
        yield from map(flush, held)
        release()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([sum(number)]), pa.array([number[1]])], ["gram", "n", "toxic"])

    return sentences.mapInArrow(count, "gram long, n long, toxic long").groupBy("gram").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))


def _features(counts: DataFrame, most: int) -> np.ndarray:
    """Hashes of the chosen n-grams, sorted: at most ``most`` and those of the identity terms."""
    total = counts.where(F.col("gram").isNull()).first()
    n, toxic = (total["n"], total["toxic"]) if total else (0, 0)
    chosen = np.zeros(0, np.uint64)
    if 0 < toxic < n:
        p = toxic / n
        z = (F.col("toxic") - F.col("n") * p) / F.sqrt(F.col("n") * p * (1 - p))
        best = (counts.where(F.col("gram").isNotNull() & (F.col("toxic") >= LEAST_SENTENCES) & (F.col("toxic") >= LEAST_SHARE * F.col("n")))
                .withColumn("z", z).where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "gram").limit(most))
        chosen = best.select("gram").toArrow()["gram"].to_numpy().view(np.uint64)
    return np.unique(np.concatenate([chosen, *(_grams(t) for t in _KIND)]))


def _regress(rows, cols, toxic, weight, pairs, size: int) -> tuple[np.ndarray, float]:
    """Weights and base; ``pairs``: (row, col, sign) entries of the differences between counterfactuals, and a weight per row."""
    n, (p_row, p_col, p_sign, p_weight) = len(toxic), pairs
    share, p_share = weight / weight.sum(), p_weight / max(1.0, p_weight.sum())
    positive = (weight * toxic).sum()
    w, base = np.zeros(size), float(np.log((positive + 0.5) / (weight.sum() - positive + 0.5)))
    moment, square, rate = np.zeros(size + 1), np.zeros(size + 1), 0.1
    for step in range(1, ROUNDS + 1):
        z = base + np.bincount(rows, w[cols], minlength=n)
        g = (1 / (1 + np.exp(-z)) - toxic) * share
        change = np.bincount(p_row, w[p_col] * p_sign, minlength=len(p_share)) * p_share
        grad = np.bincount(cols, g[rows], minlength=size) + L2 * w
        grad += 2 * PENALTY * np.bincount(p_col, change[p_row] * p_sign, minlength=size)
        grad = np.append(grad, g.sum())
        moment = 0.9 * moment + 0.1 * grad
        square = 0.99 * square + 0.01 * grad ** 2
        move = rate * (moment / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
        w, base = w - move[:-1], base - float(move[-1])
    return w, base


def _calibrate(z: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Scale and base that make the linear scores of whole texts fit their labels (Newton steps, lightly damped)."""
    x, p = np.stack([z, np.ones_like(z)], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        y = 1 / (1 + np.exp(-np.clip(x @ p, -30, 30)))
        hessian = (x * (weight * y * (1 - y))[:, None]).T @ x + np.diag([0.1, 0.1])
        step = np.linalg.solve(hessian, x.T @ (weight * (y - toxic)) + 0.1 * (p - [1.0, 0.0]))
        p = p - np.clip(step, -1, 1)
    return float(max(p[0], 0.1)), float(p[1])


_TEXT, _SENTENCE_ROW, _PAIR = range(3)
#: Numbers that an encoding task holds before it passes its rows on, also inside a long text.
MOST_HELD = 1 << 18


def _coded(model: ToxicityModel, filter_: np.ndarray, text: str, label: int, swaps: int, plain_every: int):
    """(kind, toxic, has, lacks): the text, its sentences with a feature, and what each counterfactual changes."""
    none = np.zeros(0, np.int32)
    yield _TEXT, label, model.present(text, filter_).astype(np.int32), none
    for m in _SENTENCE.finditer(text):
        s = m[0]
        own = model.present(s, filter_).astype(np.int32)
        # sentences teach what each piece of evidence is worth alone; those without any feature teach nothing
        if len(own):
            yield _SENTENCE_ROW, label, own, none
        for other in counterfactuals(s, swaps, plain_every):
            its = model.present(other, filter_).astype(np.int32)
            gone, come = np.setdiff1d(own, its), np.setdiff1d(its, own)
            if len(gone) or len(come):
                yield _PAIR, 0, gone, come


def fit(docs: DataFrame, labels: DataFrame, sample_chars: int = SAMPLE_CHARS, most_features: int = MOST_FEATURES,
        swaps: int = SWAPS, plain_every: int = PLAIN_EVERY) -> ToxicityModel:
    """Learn from (doc_id, text) and (doc_id, toxic); pass training documents only."""
    chosen, *_ = _sample(docs, labels, sample_chars)
    sample = stored(chosen, "labelled-texts")
    features = _features(stored(_sentence_counts(sample), "sentence-ngrams"), most_features)
    empty = ToxicityModel(features, np.zeros(len(features)), 0.0)
    shared = docs.sparkSession.sparkContext.broadcast(empty)  # most_features hashes and the terms'

    kinds = (pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()))

    def encode(batches):
        model = shared.value
        filter_ = model.filter()
        rows, held = [], 0

        def coded():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["kind", "toxic", "has", "lacks"])

        for b in steps(batches, "text"):
            for text, label in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                label = int(label > 0)
                for row in _coded(model, filter_, text, label, swaps, plain_every):
                    rows.append(row)
                    held += 8 + len(row[2]) + len(row[3])
                    if held >= MOST_HELD:
                        yield coded()
                        rows, held = [], 0
        if rows:
            yield coded()
        release()

    # of a bounded sample; rows with the same features are one with a weight
    coded = sample.mapInArrow(encode, "kind int, toxic int, has array<int>, lacks array<int>")
    got = coded.groupBy("kind", "toxic", "has", "lacks").agg(F.count("*").alias("weight")).toArrow().sort_by([("kind", "ascending")])
    kind, toxic, weight = (got[c].to_numpy().astype(float) for c in ("kind", "toxic", "weight"))
    own = kind != _PAIR
    toxic, weights = toxic[own], weight[own]
    if not 0 < toxic.sum() < len(toxic):
        return _unlearned()
    n = int(own.sum())
    has, lacks = (got[c].combine_chunks() for c in ("has", "lacks"))
    spread = lambda lists: (np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy()), lists.flatten().to_numpy().astype(np.int64))
    rows, cols = spread(has[:n])
    (g_row, g_col), (c_row, c_col) = spread(has[n:]), spread(lacks[n:])
    pairs = (np.concatenate([g_row, c_row]), np.concatenate([g_col, c_col]), np.concatenate([np.ones(len(g_row)), -np.ones(len(c_row))]), weight[n:])
    w, base = _regress(rows, cols, toxic, weights, pairs, len(features))
    whole = np.flatnonzero(kind[:n] == _TEXT)
    scale, shift = _calibrate((base + np.bincount(rows, w[cols], minlength=n))[whole], toxic[whole], weights[whole])
    return ToxicityModel(features, w * scale, base * scale + shift)


def score(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, then score (0 to 1) and predicted (1 from ``threshold`` on) of every row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MOST_FEATURES hashes and the terms'

    def run(batches):
        model = shared.value
        filter_ = model.filter()
        for b in steps(batches, "text"):
            scores = np.array([model.score(t, filter_) for t in b.column("text").to_pylist()])
            cols = [b.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                                             [*keep, "score", "predicted"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    rows = docs.select(*keep) if "text" in keep else docs.select(*keep, "text")
    return rows.mapInArrow(run, f"{fields}, score double, predicted int")


def accepted(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns as they are, that score below ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MOST_FEATURES hashes and the terms'

    def run(batches):
        model = shared.value
        filter_ = model.filter()
        for b in steps(batches, "text"):
            yield b.filter(pa.array([model.score(t, filter_) < threshold for t in b.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
