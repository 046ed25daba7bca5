"""Secret scans through a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived:
every match must contain them. Texts are indexed segment by segment: a task
takes a few megabytes of rows, maps each needed trigram to the sorted list of
rows that hold it (case folded, so the list can only be too long), evaluates
each rule's query by intersecting and uniting those lists, and runs the
expression on the surviving rows alone. A rule without a mandatory trigram
scans every row. Segments are independent: no shuffle, bounded memory, and a
lost task is simply run again.

Null texts count as empty and have no spans. Repeated rows are scanned each;
null ids are kept. Columns besides the kept ones are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import product
from re import _constants as sre
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import steps

#: Alternatives that one literal run may have before it is cut.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` (ASCII semantics) whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    def spans(self, text: str) -> list[tuple[int, str, int]]:
        return [(m.start(), self.kind, m.end()) for m in _compiled(self.pattern).finditer(text)
                if m.end(self.group) - m.start(self.group) >= self.least]


# The base rules, in the order in which ties are listed.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
# Public shapes of further credentials.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_bot", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES


@functools.lru_cache(maxsize=None)
def _compiled(pattern: str) -> re.Pattern:
    return re.compile(pattern, re.ASCII)


# A query is True (no condition), a trigram, or ("and" | "or", parts).
def _all(parts: Iterable) -> object:
    parts = [p for p in dict.fromkeys(parts) if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any(parts: Iterable) -> object:
    parts = list(dict.fromkeys(parts))
    return True if True in parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _of_strings(strings: Iterable[str]) -> object:
    """Some string of these occurs: any of them, each with all its trigrams."""
    # bytes are folded, as the index folds them: only ASCII letters change
    folded = sorted({s.encode().lower() for s in strings})
    return _any(_all(s[i:i + 3] for i in range(len(s) - 2)) for s in folded)


def _node(op, arg) -> tuple[list[str] | None, object]:
    """(all strings that the node matches, if few; the query that every match fulfils)."""
    if op is sre.LITERAL:
        return [chr(arg)], True
    if op is sre.IN:
        chars = [chr(x) for kind, x in arg if kind is sre.LITERAL]
        return (chars, True) if len(chars) == len(arg) <= 8 else (None, True)
    if op is sre.SUBPATTERN:
        return _sequence(arg[3])
    if op is sre.BRANCH:
        parts = [_sequence(p) for p in arg[1]]
        if all(s is not None for s, _ in parts):
            return [x for s, _ in parts for x in s], True
        return None, _any(q if s is None else _of_strings(s) for s, q in parts)
    if op is sre.MAX_REPEAT:
        least, most, item = arg
        strings, query = _sequence(item)
        if (least, most) == (0, 1) and strings is not None:
            return ["", *strings], True
        if least == most and strings is not None and len(strings) ** least <= MOST_STRINGS:
            return ["".join(p) for p in product(strings, repeat=least)], True
        return None, True if not least else query if strings is None else _of_strings(
            "".join(p) for p in product(strings, repeat=least)) if len(strings) ** least <= MOST_STRINGS else True
    return None, True


def _sequence(nodes) -> tuple[list[str] | None, object]:
    run, found, exact = [""], [], True
    for op, arg in nodes:
        strings, query = _node(op, arg)
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = [a + b for a in run for b in strings]
            continue
        found.append(_of_strings(run))
        exact = False
        if strings is None:
            found.append(query)
            run = [""]
        else:
            run = strings
    return (run, True) if exact else (None, _all([*found, _of_strings(run)]))


def trigram_query(pattern: str) -> object:
    """The Boolean trigram query that every match of the expression fulfils; True if there is none."""
    strings, query = _sequence(_parser.parse(pattern, re.ASCII))
    return query if strings is None else _of_strings(strings)


def _trigrams(query) -> set[bytes]:
    if isinstance(query, bytes):
        return {query}
    return set() if query is True else set().union(*map(_trigrams, query[1]))


class TrigramIndex:
    """Postings of one segment's texts for the trigrams that the rules ask for."""

    def __init__(self, texts: list[bytes], lookup: np.ndarray, wanted: list[bytes]):
        joined = np.frombuffer(b"\0\0".join(texts).lower(), dtype=np.uint8)
        starts = np.concatenate([[0], np.cumsum([len(t) + 2 for t in texts])[:-1]])
        b = joined.astype(np.uint32)
        codes = b[:-2] << 16 | b[1:-1] << 8 | b[2:] if len(b) > 2 else b[:0]
        which = lookup[codes]
        at = np.flatnonzero(which)
        rows = np.searchsorted(starts, at, side="right") - 1
        self.rows = np.arange(len(texts))
        self.postings = {t: np.unique(rows[which[at] == i + 1]) for i, t in enumerate(wanted)}

    def candidates(self, query) -> np.ndarray:
        """Sorted rows that fulfil the query."""
        if query is True:
            return self.rows
        if isinstance(query, bytes):
            return self.postings[query]
        parts = [self.candidates(q) for q in query[1]]
        if query[0] == "or":
            return functools.reduce(np.union1d, parts)
        return functools.reduce(lambda a, c: np.intersect1d(a, c, assume_unique=True), sorted(parts, key=len))


@functools.lru_cache(maxsize=4)
def _plan(rules: tuple[Rule, ...]) -> tuple[list, np.ndarray, list[bytes]]:
    queries = [trigram_query(r.pattern) for r in rules]
    wanted = sorted(set().union(*map(_trigrams, queries)))
    if len(wanted) > 65_534:
        raise ValueError("the rules ask for too many trigrams")
    lookup = np.zeros(1 << 24, dtype=np.uint16 if len(wanted) > 254 else np.uint8)
    for i, t in enumerate(wanted):
        lookup[int.from_bytes(t, "big")] = i + 1
    return queries, lookup, wanted


def find_spans(texts: list[str], rules: tuple[Rule, ...] = RULES) -> list[list[tuple[int, str, int]]]:
    """Per text its spans (start, kind, end) by start, then the rules' order."""
    queries, lookup, wanted = _plan(rules)
    index = TrigramIndex([t.encode() for t in texts], lookup, wanted)
    found: list[list] = [[] for _ in texts]
    for order, (rule, query) in enumerate(zip(rules, queries)):
        for row in index.candidates(query).tolist():
            found[row].extend((start, order, kind, end) for start, kind, end in rule.spans(texts[row]))
    return [[(start, kind, end) for start, _, kind, end in sorted(spans)] for spans in found]



def redact(text: str, spans: list[tuple[int, str, int]]) -> str:
    """The text with each span, overlapping ones as one, replaced by its first kind in brackets."""
    out, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row: doc_id, spans array<struct<start, kind, end>> in code points, end exclusive."""
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))

    def run(batches):
        for b in steps(batches, "text"):
            found = find_spans([t or "" for t in b.column("text").to_pylist()], rules)
            rows = [[{"start": s, "kind": k, "end": e} for s, k, e in spans] for spans in found]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(rows, span)], ["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {doc_type}, spans array<struct<start:long,kind:string,end:long>>")


def digest(found: DataFrame, base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Counts and digests of a scan: n_<kind> per base kind, base_sha256, spans as text."""
    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    of = lambda kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    kinds = [r.kind for r in base]
    return found.select(
        "doc_id", *[F.size(of([k])).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(listed(of(kinds)), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents with secrets replaced in ``text`` and ``n_chars``, if there is such a column, set to match; rows without a secret stay as they are."""
    counted = "n_chars" in docs.columns

    def run(batches):
        for b in steps(batches, "text"):
            texts = b.column("text").to_pylist()
            spans = find_spans([t or "" for t in texts], rules)
            new = [redact(t, s) if s else t for t, s in zip(texts, spans)]
            cols = {"text": pa.array(new, pa.string())}
            if counted:
                chars = [len(n) if s else c for n, s, c in zip(new, spans, b.column("n_chars").to_pylist())]
                cols["n_chars"] = pa.array(chars, b.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays([cols.get(n, b.column(n)) for n in b.schema.names], b.schema.names)

    return docs.mapInArrow(run, docs.schema)
