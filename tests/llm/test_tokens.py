import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import awkward, nothing  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from ratewise.llm import packing, token_counts
from ratewise.llm.vocab import WHITE_SPACE, word_ids

PATH = public_tokenizers.path("word_bpe_49k.json")
MEMO = word_ids(PATH)


def ids(text):
    return MEMO.tok.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abcXYZéÉßµªİΣς .,;:!?'12\t\n\x1c\x1f\x85\xa0́日한ﬁK<|>") | st.characters(codec="utf-8"), max_size=30))
def test_memo_encodes_as_the_tokenizer(text):
    assert np.frombuffer(MEMO.encode([text])[0], "<u4").tolist() == ids(text)


def test_memo_handles_special_strings_and_every_white_space():
    from re import escape, sub
    every = [chr(c) for c in range(0x3100) if sub(f"[{WHITE_SPACE}]", "", chr(c)) == ""]
    assert escape("\x1c") not in every
    for text in ["a<|endoftext|>b <|startoftext|>", *(f"It{c}'s one{c}{c}two" for c in [*every, "\x1c", "​"])]:
        assert np.frombuffer(MEMO.encode([text])[0], "<u4").tolist() == ids(text), repr(text)


@pytest.mark.parametrize("chunk, overlap", [(16_384, 512), (300, 20), (64, 8)])
def test_counts_equal_the_tokenizer_whatever_the_chunks(awkward, chunk, overlap):
    got = token_counts.count_tokens(awkward, PATH, chunk, overlap).collect()
    want = [(r.doc_id, len((r.text or "").encode()), len(ids(r.text)), len(ids(r.text)) > 2048) for r in awkward.collect()]
    assert Counter(map(tuple, got)) == Counter(want)
    assert any(r.over_limit for r in got)


def test_counts_of_nothing(nothing):
    out = token_counts.count_tokens(nothing, PATH)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and out.count() == 0


def best_fit_decreasing(lengths, window):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fitting = [r for r in rooms if r >= n]
        room = min(fitting) if fitting else window
        if fitting:
            rooms.remove(room)
        rooms.append(room - n)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(40))
def test_placement_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    window = rng.choice([8, 32, 100])
    histogram = {rng.randint(1, window - 1): rng.randint(1, 30) for _ in range(rng.randint(1, 12))}
    runs, windows = packing.place(histogram, window)
    used, taken = [0] * windows, set()
    for n, count in histogram.items():
        own = [r for r in runs if r[0] == n]
        for rank in range(count):
            _, first, start, per, offset = [r for r in own if r[1] <= rank][-1]
            w, at = start + (rank - first) // per, offset + (rank - first) % per * n
            cells = {(w, x) for x in range(at, at + n)}
            assert not cells & taken
            taken |= cells
            used[w] += n
    assert sorted(window - u for u in used) == best_fit_decreasing([n for n, c in histogram.items() for _ in range(c)], window)


@pytest.mark.parametrize("window", [2048, 50])
def test_pieces_hold_every_id_once_without_gaps(awkward, window):
    pieces = packing.pack(awkward, PATH, window=window).collect()
    texts = Counter((r.doc_id, tuple(ids(r.text) + [1])) for r in awkward.collect())
    by_doc, by_sequence = defaultdict(Counter), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id][(p.start, p.length, p.ids_crc32, p.doc_tokens)] += 1
        by_sequence[p.sequence_id].append((p.offset, p.length))
    for (doc_id, own), copies in texts.items():
        for start in range(0, len(own), window):
            piece = own[start:start + window]
            key = (start, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes()), len(own))
            assert by_doc[doc_id][key] >= copies
    assert sum(p.length for p in pieces) == sum(len(own) * n for (_, own), n in texts.items())
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= window


def test_packing_of_nothing(nothing):
    assert packing.pack(nothing, PATH).count() == 0
