"""Repair of conversations: the cheapest edits that make turns alternate, by divide and conquer.

Rows of a conversation, in order, must become ``(system? (user assistant)+)?``.
Each row is kept (0), reroled to user or assistant (1) or deleted (2, a must
for blank rows and duplicates); an empty user or assistant turn may be inserted
anywhere (5); a truncated row that stays costs 5 more. After any row the output
is in one of four states: nothing yet, after system, after user, after
assistant.

Hirschberg's method: a vector of four costs runs forward from the begin to the
middle, another backward from the end; they meet in the states that an optimal
path may cross, the one whose audit (edits' initials in order) is least in ASCII order is taken,
and both halves are solved alike. Nothing but the two vectors is kept, so space is
linear. Beside each forward cost goes the rank of its least audit among the
four: audits of the same rows that end in different states differ, and none begins
another, so ranks decide ties exactly.

No conversation is gathered whole. Rows are sorted by range, cut into blocks of
bounded rows and bytes, and a conversation of several blocks is solved over
their four by four matrices (cost and rank from state to state): matrices of the blocks of
one partition are multiplied first, then those of the partitions, then the
crossings go back down to the blocks. Duplicates across blocks are found by
digests of role and text. Only the hash of a repaired conversation, which is
sequential by definition, streams its blocks through one task.

Order within a conversation: turn (nulls first), then role, then text in byte order.
Null role or text: one space, so a null text is blank. A null conversation id
is a conversation of its own. Roles count by their first letter (s, u, a; others
must be reroled or deleted); a kept row keeps its role as it is. Repeated rows are duplicates. Other
columns are ignored whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import stored

#: Rows and bytes of text that a block holds at most (a longer text is a block of its own).
BLOCK_ROWS, BLOCK_BYTES = 1024, 4 << 20
#: Leading characters of a text that may place a row in a partition; rows are then sorted by whole texts.
ROUTE_CHARS = 32

FAULTS = ("", "blank", "duplicate", "truncated")
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 60
_BLANKS = " \t\n\x0b\x0c\r"

#: (cost, rank) from state to state; ranks compare audits that begin in the same state.
Step = list[list[tuple]]


def _inserted(state: int) -> Iterator[tuple[int, int]]:
    """(inserted turns, state after them): more than these would only go round."""
    yield 0, state
    if state in (START, SYSTEM):
        yield 1, USER
        yield 2, ASSISTANT
    else:
        yield 1, ASSISTANT if state == USER else USER


@functools.lru_cache(maxsize=16)
def row_step(initial: str, fault: str) -> Step:
    """The cheapest, then ASCII-least edits of one row from state to state: (cost, audit).

    Turns are inserted right before a row that stays: before a deletion the
    same turns can go after it, which is the lesser audit.
    """
    out = [[(NEVER, "")] * 4 for _ in range(4)]

    def offer(a: int, b: int, cost: int, audit: str) -> None:
        out[a][b] = min(out[a][b], (cost, audit))

    for state in range(4):
        offer(state, state, DELETE, "D")
        if fault in ("blank", "duplicate"):
            continue
        extra = TRUNCATED if fault == "truncated" else 0
        for n, here in _inserted(state):
            then = ASSISTANT if here == USER else USER
            offer(state, then, n * INSERT + REROLE + extra, "I" * n + "R")
            if initial == ("a" if here == USER else "u"):
                offer(state, then, n * INSERT + extra, "I" * n + "K")
            if initial == "s" and here == START:
                offer(state, SYSTEM, n * INSERT + extra, "I" * n + "K")
    return out


#: Turns still to insert after the last row.
ENDING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}


def forward(steps: Sequence[Step], begin: int) -> list[tuple[int, int]]:
    """Per state (cost of the cheapest way there, rank of its least audit among the states)."""
    now = [(0, 0) if s == begin else (NEVER, s) for s in range(4)]
    for step in steps:
        best = []
        for b in range(4):
            cost, rank, a = min((now[a][0] + step[a][b][0], now[a][1], a) for a in range(4))
            best.append((cost, rank, step[a][b][1], b) if cost < NEVER else (NEVER, 9, step[a][b][1], b))
        order = {x[3]: i for i, x in enumerate(sorted(best, key=lambda x: (x[0] >= NEVER, x[1], x[2] if x[0] < NEVER else x[3])))}
        now = [(min(x[0], NEVER), order[x[3]]) for x in best]
    return now


def backward(steps: Sequence[Step], end: int) -> list[int]:
    """Per state the cost of the cheapest way from it to the end."""
    now = [0 if s == end else NEVER for s in range(4)]
    for step in reversed(steps):
        now = [min(min(step[a][b][0] + now[b] for b in range(4)), NEVER) for a in range(4)]
    return now


def crossings(steps: Sequence[Step], begin: int, end: int) -> list[tuple[int, int]]:
    """(state before, state after) of each step on the cheapest, then audit-least way."""
    out, todo = [], [(0, len(steps), begin, end)]
    while todo:
        low, high, a, b = todo.pop()
        if high - low == 1:
            out.append((a, b))
        elif high > low:
            mid = (low + high) // 2
            to, on = forward(steps[low:mid], a), backward(steps[mid:high], b)
            _, _, here = min((to[s][0] + on[s], to[s][1], s) for s in range(4))
            todo += [(mid, high, here, b), (low, mid, a, here)]
    return out


def ending(steps: Sequence[Step]) -> int:
    """The state after the last step on the cheapest, then audit-least way."""
    return min((cost + INSERT * ENDING[s], rank, s) for s, (cost, rank) in enumerate(forward(steps, START)))[2]


def product(steps: Sequence[Step]) -> Step:
    """All steps as one."""
    return [forward(steps, a) for a in range(4)]


def audit(kinds: Sequence[tuple[str, str]], begin: int = START, end: int | None = None) -> str:
    """Initials of the edits of rows given as (initial of the role, fault); with no ``end`` the conversation ends here."""
    steps = [row_step(*k) for k in kinds]
    last = end is None
    end = ending(steps) if last else end
    edits = "".join(s[a][b][1] for s, (a, b) in zip(steps, crossings(steps, begin, end)))
    return edits + "I" * ENDING[end] if last else edits


# ---- rows to blocks

_INITIALS = "sua?"


def _fault(text: str) -> int:
    text = text.rstrip(_BLANKS)
    return 1 if not text else 3 if text[-1] not in ".!?" else 0


def _kinds(codes: str) -> list[tuple[str, str]]:
    return [(_INITIALS[(ord(c) - 97) // 4], FAULTS[(ord(c) - 97) % 4]) for c in codes]


def _spoken(role: str, text: str, conv) -> bytes:
    h = hashlib.blake2b(digest_size=16)
    for part in (repr(conv), role, text):
        data = part.encode("utf-8", "surrogatepass")
        h.update(len(data).to_bytes(8, "little") + data)
    return h.digest()


def _blocks(rows: DataFrame) -> DataFrame:
    """Stored blocks: (bid, conv_id, codes, turns, roles, texts, digests); bid grows along a conversation.

    ``codes`` has a letter per row (role and fault); duplicates within the block are
    marked, and only rows that may be the first of their like have a text and a digest.
    """
    conv_type, turn_type = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role"]
    placed = rows.repartitionByRange(*keys, F.substring("text", 1, ROUTE_CHARS)).sortWithinPartitions(*keys, "text")
    names = ["bid", "conv_id", "codes", "turns", "roles", "texts", "digests"]

    def run(batches):
        bid = TaskContext.get().partitionId() << 40
        types: dict[str, pa.DataType] = {}
        done: list[tuple] = []
        conv = open_ = None
        codes, turns, roles, texts, digests, seen, size = [], [], [], [], [], set(), 0

        def close():
            nonlocal bid, codes, turns, roles, texts, digests, seen, size
            done.append((bid, conv, "".join(codes), turns, roles, texts, digests))
            bid += 1
            codes, turns, roles, texts, digests, seen, size = [], [], [], [], [], set(), 0

        def flush():
            columns = list(zip(*done))
            kinds = [pa.int64(), types["conv"], pa.string(), pa.list_(types["turn"]), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.binary())]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        held = 0
        for batch in batches:
            types = {"conv": batch.schema.field("conv_id").type, "turn": batch.schema.field("turn").type}
            for c, turn, role, text, copies in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "turn", "role", "text", "copies"))):
                if open_ is None or c != conv:
                    if open_:
                        close()
                    conv, open_ = c, True
                for _ in range(copies):
                    if len(codes) >= BLOCK_ROWS or size + len(text) > BLOCK_BYTES and codes:
                        close()
                    fault, digest = _fault(text), None
                    if fault != 1:
                        digest = _spoken(role, text, c)
                        if digest in seen:
                            fault, digest = 2, None
                        else:
                            seen.add(digest)
                    at = _INITIALS.find(role[:1]) if role[:1] in ("s", "u", "a") else 3
                    codes.append(chr(97 + 4 * at + fault))
                    turns.append(turn)
                    roles.append(role)
                    texts.append(text if digest else "")
                    digests.append(digest)
                    size += len(text)
                    held += len(text)
            if held > BLOCK_BYTES or len(done) > 2000:
                if done:
                    yield flush()
                held = 0
        if open_:
            close()
        if done:
            yield flush()

    schema = f"bid long, conv_id {conv_type}, codes string, turns array<{turn_type}>, roles array<string>, texts array<string>, digests array<binary>"
    return stored(placed.select("conv_id", "turn", "role", "text", "copies").mapInArrow(run, schema), "conversation-blocks")


# ---- conversations of several blocks

def _with_duplicates(rows: DataFrame) -> DataFrame:
    """The rows with the ``places`` of their codes marked as duplicates."""
    def mark(codes: str, places: list[int] | None) -> str:
        out = list(codes)
        for p in places or ():
            out[p] = chr(97 + (ord(out[p]) - 97) // 4 * 4 + 2)
        return "".join(out)

    def run(batches):
        for b in batches:
            codes = [mark(*x) for x in zip(b.column("codes").to_pylist(), b.column("places").to_pylist())]
            yield b.set_column(b.schema.get_field_index("codes"), "codes", pa.array(codes, pa.string())).drop_columns(["places"])

    return rows.mapInArrow(run, rows.drop("places").schema)


def _flat(step: Step) -> tuple[list[int], list[int]]:
    return [x[0] for row in step for x in row], [x[1] for row in step for x in row]


def _steps(group: pa.Table) -> list[Step]:
    return [[list(zip(c[i:i + 4], r[i:i + 4])) for i in range(0, 16, 4)] for c, r in zip(group["cost"].to_pylist(), group["rank"].to_pylist())]


def _matrices(rows: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            if b.num_rows:
                flat = [_flat(product([row_step(*k) for k in _kinds(c)])) for c in b.column("codes").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("lead"), b.column("part"), b.column("bid"), pa.array([f[0] for f in flat], pa.list_(pa.int64())),
                                                  pa.array([f[1] for f in flat], pa.list_(pa.int64()))], ["lead", "part", "bid", "cost", "rank"])

    return rows.select("lead", "part", "bid", "codes").mapInArrow(run, "lead long, part long, bid long, cost array<long>, rank array<long>")


def _joined_part(group: pa.Table) -> pa.Table:
    group = group.sort_by("bid")
    cost, rank = _flat(product(_steps(group)))
    return pa.table({"lead": group["lead"][:1], "part": group["part"][:1], "cost": pa.array([cost], pa.list_(pa.int64())), "rank": pa.array([rank], pa.list_(pa.int64()))})


def _solved_parts(group: pa.Table) -> pa.Table:
    group = group.sort_by("part")
    steps = _steps(group)
    states = crossings(steps, START, ending(steps))
    return pa.table({"lead": group["lead"], "part": group["part"], "first": pa.array([a for a, _ in states], pa.int32()), "last": pa.array([b for _, b in states], pa.int32())})


def _solved_blocks(group: pa.Table) -> pa.Table:
    group = group.sort_by("bid")
    states = crossings(_steps(group), group["first"][0].as_py(), group["last"][0].as_py())
    return pa.table({"bid": group["bid"], "before": pa.array([a for a, _ in states], pa.int32()), "after": pa.array([b for _, b in states], pa.int32())})


def _long_ones(blocks: DataFrame) -> DataFrame:
    """(conv_id, bid, codes, before, after, closes) of the blocks of conversations that have several."""
    several = blocks.groupBy("conv_id").agg(F.min("bid").alias("lead"), F.max("bid").alias("tail"), F.count("*").alias("n")).where("n > 1")
    several = several.select(F.col("conv_id").alias("conv"), "lead", "tail")
    light = stored(blocks.select("conv_id", "bid", "codes", "digests").join(several, F.col("conv_id").eqNullSafe(F.col("conv"))).drop("conv"), "long-conversations")
    said = light.select("bid", F.posexplode("digests").alias("place", "digest")).where("digest IS NOT NULL")
    first = said.groupBy("digest").agg(F.min("bid").alias("first"))
    again = said.join(first, "digest").where("bid > first").groupBy("bid").agg(F.collect_list("place").alias("places"))  # BLOCK_ROWS at most
    rows = stored(_with_duplicates(light.drop("digests").join(again, "bid", "left").select(
        "lead", "tail", F.shiftright("bid", 40).alias("part"), "conv_id", "bid", "codes", "places")), "long-codes")
    matrices = stored(_matrices(rows), "block-matrices")
    parts = matrices.groupBy("lead", "part").applyInArrow(_joined_part, "lead long, part long, cost array<long>, rank array<long>")
    ends = parts.groupBy("lead").applyInArrow(_solved_parts, "lead long, part long, first int, last int")
    states = matrices.join(ends, ["lead", "part"]).groupBy("lead", "part").applyInArrow(_solved_blocks, "bid long, before int, after int")
    return rows.join(states, "bid").select("conv_id", "bid", "codes", "before", "after", (F.col("bid") == F.col("tail")).alias("closes"))


# ---- repaired pieces

def _rewritten(edits: str, begin: int, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """Roles and texts after the edits."""
    state, at = begin, 0
    out_roles, out_texts = [], []
    for e in edits:
        if e == "D":
            at += 1
            continue
        if e == "K" and state == START and roles[at][:1] == "s":
            state = SYSTEM
        else:
            state = ASSISTANT if state == USER else USER
        out_roles.append(roles[at] if e == "K" else "assistant" if state == ASSISTANT else "user")
        out_texts.append("" if e == "I" else texts[at])
        at += e != "I"
    return out_roles, out_texts


_PIECE = "codes string, edits string, turns array<{turn}>, roles array<string>, texts array<string>"


def repair(rows: DataFrame) -> DataFrame:
    """Pieces of repaired conversations: (conv_id, bid, codes, edits, turns, roles, texts).

    ``rows`` are (conv_id, turn, role, text) and may have ``copies`` (a row counts so often; 0: only its conversation counts). ``roles``
    and ``texts`` are those after the edits; ``codes`` and ``turns`` those of the rows before. The pieces of a conversation
    lie in one partition, in order of ``bid``.
    """
    conv_type, turn_type = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    clean = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), copies.alias("copies"))
    blocks = _blocks(clean)
    plans = _long_ones(blocks)
    nothing = {"turns": f"array<{turn_type}>", "roles": "array<string>", "texts": "array<string>"}
    both = plans.select("conv_id", "bid", F.lit(0).alias("kind"), "codes", "before", "after", "closes", *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()]).unionByName(
        blocks.select("conv_id", "bid", F.lit(1).alias("kind"), "codes", *[F.lit(None).cast(t).alias(c) for c, t in (("before", "int"), ("after", "int"), ("closes", "boolean"))], *nothing))
    both = both.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "bid", "kind")
    names = ["conv_id", "bid", "codes", "edits", "turns", "roles", "texts"]

    def run(batches):
        plan = None
        for b in batches:
            out = []
            columns = [b.column(c).to_pylist() for c in ("conv_id", "bid", "kind", "codes", "before", "after", "closes", "turns", "roles", "texts")]
            for conv, bid, kind, codes, before, after, closes, turns, roles, texts in zip(*columns):
                if kind == 0:
                    plan = (bid, codes, before, after, closes)
                    continue
                if plan and plan[0] == bid:
                    _, codes, begin, end, closes = plan
                    edits = audit(_kinds(codes), begin, end) + "I" * (ENDING[end] if closes else 0)
                else:
                    begin, edits = START, audit(_kinds(codes))
                plan = None
                out.append((conv, bid, codes, edits, turns, *_rewritten(edits, begin, roles, texts)))
            if out:
                kinds = [b.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string(), b.schema.field("turns").type, pa.list_(pa.string()), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return both.mapInArrow(run, f"conv_id {conv_type}, bid long, " + _PIECE.format(turn=turn_type))


def repaired_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, bid, place, role, text): the turns of the repaired conversations in order of (bid, place)."""
    turns = F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "t")
    return repair(rows).select("conv_id", "bid", turns).select("conv_id", "bid", "place", F.col("t.roles").alias("role"), F.col("t.texts").alias("text"))


class _Report:
    """Counts of one conversation, piece by piece."""

    def __init__(self, conv):
        self.conv, self.counts, self.illegal, self.cost = conv, [0] * 4, 0, 0
        self.turns, self.low, self.high, self.last_turn = 0, None, None, None
        self.audit, self.hash, self.before, self.any = [], hashlib.sha256(), "", False

    def add(self, codes, edits, turns, roles, texts) -> None:
        kinds = _kinds(codes)
        for turn in turns:
            if turn is not None and turn != self.last_turn:
                self.turns, self.last_turn, self.high = self.turns + 1, turn, turn
                self.low = turn if self.low is None else self.low
        at = 0
        for e in edits:
            self.cost += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[e]
            if e in "KR" and kinds[at][1] == "truncated":
                self.cost += TRUNCATED
            at += e != "I"
        for initial, fault in kinds:
            self.counts[FAULTS.index(fault)] += 1
            self.illegal += bool(self.before) and self.before + initial not in ("su", "ua", "au")
            self.before = initial
        self.audit.append(edits)
        for role, text in zip(roles, texts):
            self.hash.update(("\n" if self.any else "").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
            self.any = True

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, *self.counts[1:], self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


def report(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation."""
    pieces = repair(rows)
    conv_type = rows.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches):
        now, conv_arrow = None, None

        def done(out):
            kinds = [conv_arrow, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

        for b in batches:
            conv_arrow, out = b.schema.field("conv_id").type, []
            for conv, *piece in zip(*(b.column(c).to_pylist() for c in ("conv_id", "codes", "edits", "turns", "roles", "texts"))):
                if now is None or now.conv != conv:
                    if now is not None:
                        out.append(now.row())
                    now = _Report(conv)
                now.add(*piece)
            if out:
                yield done(out)
        if now is not None:
            yield done([now.row()])

    return pieces.mapInArrow(run, f"conv_id {conv_type}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows damaged by the remainder of crc32(conv_id:turn) modulo 20; nulls are one space."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fold = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    text = F.when(fold == 1, "").when(fold == 2, F.translate(word("text"), ".!?", "")).otherwise(word("text"))
    return conversations.select(
        "conv_id", "turn", F.when(fold == 4, "user").otherwise(word("role")).alias("role"), F.when(fold == 0, "").otherwise(text).alias("text"),
        F.when(fold == 0, 0).when(fold == 3, 2).otherwise(1).alias("copies"))
