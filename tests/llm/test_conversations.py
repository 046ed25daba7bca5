import hashlib
import itertools
import random
import re
import zlib

import pytest
from llm_fixtures import SF

from ratewise.llm import conversations, queries

SPACE = " \t\n\x0b\x0c\r"
COST = {"K": 0, "R": 1, "D": 2, "I": 5}


def legal(audit, rows):
    """(cost, repaired rows) of an audit, None if it breaks a rule; rows are (role, text, fault)."""
    at, out, cost = 0, [], 0
    for e in audit:
        cost += COST[e]
        if e == "I":
            out.append((None, ""))
            continue
        role, text, fault = rows[at]
        at += 1
        if e == "D":
            continue
        if fault in ("blank", "duplicate"):
            return None
        cost += 5 * (fault == "truncated")
        out.append((role if e == "K" else None, text))
    if at < len(rows):
        return None
    initials = ""
    for i, (role, _) in enumerate(out):
        want = "u" if not initials or initials[-1] in "sa" else "a"
        initial = role[:1] if role is not None else want
        if initial == "s" and i == 0:
            want = "s"
        if initial != want or not initial:
            return None
        initials += initial
    if not re.fullmatch("(s?(ua)+)?", initials):
        return None
    named = [(role if role is not None else {"u": "user", "a": "assistant"}[i], text) for (role, text), i in zip(out, initials)]
    return cost, named


def cheapest(rows):
    """Brute force over all audits with up to two turns inserted in each gap."""
    best = None
    for edits in itertools.product("DKR", repeat=len(rows)):
        for gaps in itertools.product(("", "I", "II"), repeat=len(rows) + 1):
            a = "".join(g + e for g, e in itertools.zip_longest(gaps, edits, fillvalue=""))
            found = legal(a, rows)
            if found and (best is None or (found[0], a) < best[:2]):
                best = (found[0], a, found[1])
    return best


def stepwise(rows):
    """Least (cost, audit) over the four states, whole strings kept: exact as no audit of the same rows begins another."""
    best = {"": (0, "")}
    for role, _, fault in rows:
        new = {}
        for tail, (cost, a) in best.items():
            options = [(tail, cost + 2, a + "D")]
            if fault not in ("blank", "duplicate"):
                for n in range(3):
                    here = tail
                    for _ in range(n):
                        here = "a" if here == "u" else "u"
                    for e, initial, price in [("K", role[:1], 0), ("R", "u", 1), ("R", "a", 1)]:
                        if initial == "s" and here == "" or initial == "u" and here != "u" or initial == "a" and here == "u":
                            options.append((initial, cost + 5 * n + price + 5 * (fault == "truncated"), a + "I" * n + e))
            for t, c, s in options:
                new[t] = min(new.get(t, (c, s)), (c, s))
        best = new
    return min((c + 5 * k, a + "I" * k) for t, (c, a) in best.items() for k in [{"": 0, "s": 2, "u": 1, "a": 0}[t]])


def faults(rows):
    """(role, text) in order -> (role, text, fault)."""
    seen, out = set(), []
    for role, text in rows:
        core = text.rstrip(SPACE)
        out.append((role, text, "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""))
        seen.add((role, text))
    return out


def plain_report(rows, solve):
    """The contract's columns of one conversation, from (turn, role, text) after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    known = [t for t, _, _ in rows if t is not None]
    marked = faults([(r, t) for _, r, t in rows])
    cost, a = solve(marked)[:2]
    repaired = legal(a, marked)[1]
    count = lambda f: sum(x[2] == f for x in marked)
    illegal = sum(x[0][:1] + y[0][:1] not in ("su", "ua", "au") for x, y in zip(marked, marked[1:]))
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    text = "\n".join(f"{r}:{t}" for r, t in repaired)
    return (gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, a, hashlib.sha256(text.encode()).hexdigest())


def plain_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        fold = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fold == 1 else re.sub("[.!?]", "", text) if fold == 2 else text
        mine += [(turn, "user" if fold == 4 else role, text)] * {0: 0, 3: 2}.get(fold, 1)
    return out


def rows_of(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def random_rows(rng, n, faulty=0.2):
    roles = [rng.choice(["user", "assistant", "system", "tool", "umpire", "", "assistant"]) if rng.random() < faulty else ("assistant" if i % 2 else "user") for i in range(n)]
    return [(r, rng.choice(["", " \t", "x", "a.", "b!"]) if rng.random() < faulty else f"t{rng.randrange(10 ** 6)}.") for r in roles]


def test_audits_equal_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        rows = faults(random_rows(rng, rng.randrange(5), 0.7))
        want = cheapest(rows)
        assert stepwise(rows) == want[:2]
        assert conversations.audit([(r[:1] if r[:1] in ("s", "u", "a") else "?", f) for r, _, f in rows]) == want[1]


def test_products_solve_like_the_rows():
    rng = random.Random(5)
    for _ in range(60):
        rows = faults(random_rows(rng, rng.randrange(1, 60), 0.4))
        kinds = [(r[:1] if r[:1] in ("s", "u", "a") else "?", f) for r, _, f in rows]
        want = stepwise(rows)
        assert conversations.audit(kinds) == want[1]
        steps = [conversations.row_step(*k) for k in kinds]
        size = rng.randrange(1, 9)
        parts = [conversations.product(steps[i:i + size]) for i in range(0, len(steps), size)]
        end = conversations.ending(parts)
        found = "".join(conversations.audit(kinds[i * size:(i + 1) * size], a, b) for i, (a, b) in enumerate(conversations.crossings(parts, conversations.START, end)))
        assert found + "I" * conversations.ENDING[end] == want[1]


@pytest.mark.parametrize("block_rows, block_bytes", [(1024, 1 << 20), (3, 1 << 20), (1024, 30)])
def test_reports_equal_plain(spark, monkeypatch, block_rows, block_bytes):
    monkeypatch.setattr(conversations, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(conversations, "BLOCK_BYTES", block_bytes)
    rng = random.Random(8)
    rows = []
    for conv in [*range(40), None]:
        for i, (role, text) in enumerate(random_rows(rng, rng.choice([1, 2, 5, 9, 40]), 0.25)):
            rows.append((conv, None if rng.random() < 0.05 else i + rng.choice([0, 0, 0, 1, 7]), None if rng.random() < 0.03 else role, None if rng.random() < 0.03 else text))
        if rng.random() < 0.3:
            rows += [rows[-1]] * 3
    rows += [(99, 5, "user", "long " * 5000 + "."), (99, 5, "user", "long " * 5000 + "?"), (98, None, None, None), (97, 2 ** 40, "assistant", "é."), (97, -3, "user", "ü?")]
    # one conversation holds a third of all rows
    rows += [(1000, i, "assistant" if i % 2 else "user", rng.choice(["same.", f"t{i}.", f"t{i}"])) for i in range(300)]
    damaged = plain_damage(rows)
    want = {c: plain_report(r, stepwise) for c, r in damaged.items()}
    df = spark.createDataFrame([(*r, "clash", 7) for r in rows], "conv_id long, turn long, role string, text string, codes string, copies int").repartition(5)
    assert rows_of(conversations.report(conversations.damage(df))) == want


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "assistant", "a."), (1, 2, "tool", "x."), (2, 0, "user", "q?"), (3, 0, "user", " ")]
    got = conversations.repaired_turns(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"))
    by = {}
    for r in sorted(got.collect()):
        by.setdefault(r.conv_id, []).append((r.role, r.text))
    assert by == {1: [("system", "s."), ("user", "a."), ("assistant", "x.")]}


def test_nothing_to_repair(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.report(conversations.damage(empty)).count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(gone, 0, "user", "hi.")], empty.schema)
    assert [tuple(r) for r in conversations.report(conversations.damage(one)).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_query_equals_plain(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {c: plain_report(r, stepwise) for c, r in plain_damage(rows).items()}
    assert rows_of(queries.QUERIES["op13_conversation_repair"](spark, SF)) == want
