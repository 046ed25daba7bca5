"""Texts and tables for the corpus operators' tests: ordinary rows and every awkward case."""

import random

import pytest

SF = "/root/testdata/sf0.001"
SYLLABLES = {"en": ["th", "er", "on", "an", "re", "he", "in", "ed"], "de": ["sch", "ein", "ung", "keit", "ver", "zu", "pf", "ü"]}


def prose(rng, lang="en", words=40):
    out = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    return " ".join(out[:words // 2]) + ". " + " ".join(out[words // 2:]) + "."


@pytest.fixture(scope="session")
def awkward(spark):
    """Null, empty, blank, very long, repeated and null-id rows, and extra columns with clashing names."""
    rng = random.Random(7)
    long = " ".join(prose(rng, words=400) for _ in range(20))
    same = prose(rng)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, long), (5, same), (5, same), (6, same), (None, same), (None, None),
            (7, "a"), (8, "日本語 ñandú 😀 it's"), (9, "x" * 5000), (10, same.upper())]
    rows += [(20 + i, prose(rng, "de" if i % 3 else "en")) for i in range(20)]
    return spark.createDataFrame([(i, t, None if i == 7 else "en", "src", 1 if t is None else len(t), 0.5, "k", 3) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, score double, key string, n long")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("doc_id < 0")
