"""Conversation structure repair with an auction shortest-path algorithm.

A conversation's rows form a lattice: one layer per gap between rows, and in
each layer the four states of the role pattern ``(s?(ua)+)?`` (nothing yet,
after system, after user, after assistant). Keep, Rerole, Delete go to the next
layer, Insert stays in its layer; arcs have small integer costs and every cycle
(inserting a pair) has a positive one.

The auction keeps a price per node, never above the cost of an arc plus the
price at its end. A path starts at the origin: if the price of its last node is
below the best arc's cost plus end price, the price is raised to it and the
path contracts by that node; else the path is extended along that arc. On
arrival the origin's price is the shortest distance and every arc of every
shortest path is tight. The lattice is solved in blocks of ``BLOCK`` layers from
the last to the first: the four exact prices at a cut stand for all that comes
after, and each of the four states at the block's head is an origin in turn.
Prices in a block stay near those of its cut, so the work is linear in the rows.
The audit is then read off by walking tight arcs from the start, always the
ASCII-least edit from which tight arcs still lead to the end.

How it is spread: the first place of every (conversation, role, text) is one
partial minimum; rows with it are dealt by conversation, sorted by turn and
streamed through the tasks. A task holds one byte and four prices a row of one
conversation, its texts go to a spooled file beyond ``SPOOL`` bytes (the digest
of a repaired conversation is one sequential hash over all of it, and which
rows it takes depends on the last one). Short conversations of equal structure
are solved once per task (bounded memo).

Defined cases: a null role or text is one space, a null ``conv_id`` or ``turn``
is one space in the damage key; null turns come first; rows of one turn are
ordered by role, then text; a null ``conv_id`` is one conversation; roles count
by their first character, so unknown and empty roles must be reroled or
deleted; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import tempfile
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.llm.common import prepare

BLOCK = 64                 # layers that are solved at a time
SPOOL = 4 << 20            # bytes of a conversation's texts held in memory
MEMO = 1 << 15             # structures remembered per task
MEMO_ROWS = 32             # rows of a remembered structure, at most
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
BLANKS = "\\x20\\x09-\\x0D"

# Pattern states and what follows each: the state that a role leads to, and the
# role that an inserted or reroled turn has there.
STARTED, SYSTEM, USER, ASSISTANT = range(4)
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
OTHER = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
ENDS = (STARTED, ASSISTANT)

# A row's structure in one byte: the role's initial (one of s, u, a, or 0) in the
# low bits, then whether it must go, then whether its text is cut off.
INITIALS = {"s": 1, "u": 2, "a": 3}
MUST_GO, CUT = 4, 8
_STEP = [[NEXT[state].get({1: "s", 2: "u", 3: "a"}.get(k)) for k in range(4)] for state in range(4)]


def arcs(code: int, state: int) -> list[tuple[str, int, int, int]]:
    """Edits of one row in a state, ASCII order: (letter, cost, rows taken, next state)."""
    out = [("D", DELETE, 1, state), ("I", INSERT, 0, OTHER[state])]
    if not code & MUST_GO:
        extra = TRUNCATED if code & CUT else 0
        kept = _STEP[state][code & 3]
        if kept is not None:
            out.append(("K", extra, 1, kept))
        out.append(("R", REROLE + extra, 1, OTHER[state]))
    return out


ARCS = [[arcs(code, state) for state in range(4)] for code in range(16)]


def auction(codes: bytes, price: array, lo: int, hi: int) -> None:
    """Exact prices of the four states in layer ``lo``, and feasible ones between,
    given the exact prices in layer ``hi`` (``price`` holds four a layer)."""
    floor = min(price[4 * hi:4 * hi + 4])
    for i in range(4 * lo, 4 * hi):
        price[i] = floor
    for origin in range(4 * lo, 4 * lo + 4):
        path = [origin]
        while path[-1] < 4 * hi:
            node = path[-1]
            layer = node >> 2
            best, to = None, 0
            for _, cost, taken, state in ARCS[codes[layer]][node & 3]:
                end = 4 * (layer + taken) + state
                if best is None or cost + price[end] < best:
                    best, to = cost + price[end], end
            if price[node] < best:
                price[node] = best
                if node != origin:
                    path.pop()
            else:
                path.append(to)


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Least cost and the ASCII-least audit among the cheapest ones."""
    n = len(codes)
    price = array("q", bytes(32 * (n + 1)))
    for state in (USER, SYSTEM):  # after the last row only inserts are left
        price[4 * n + state] = INSERT + price[4 * n + OTHER[state]]
    cuts = [*range(0, n, BLOCK), n]
    for k in range(len(cuts) - 2, -1, -1):
        auction(codes, price, cuts[k], cuts[k + 1])
    out, state = [], STARTED
    for lo, hi in zip(cuts, cuts[1:]):
        live = _live(codes, price, lo, hi)
        layer = lo
        while layer < hi:
            for letter, cost, taken, to in ARCS[codes[layer]][state]:
                end = 4 * (layer + taken) + to
                if price[4 * layer + state] == cost + price[end] and live[end - 4 * lo]:
                    out.append(letter)
                    layer, state = layer + taken, to
                    break
            else:
                raise AssertionError("no tight arc")
    while state not in ENDS:
        out.append("I")
        state = OTHER[state]
    return price[STARTED], "".join(out)


def _live(codes: bytes, price: array, lo: int, hi: int) -> bytearray:
    """Nodes of a block from which tight arcs lead to its end."""
    live = bytearray(4 * (hi - lo)) + b"\1\1\1\1"
    for layer in range(hi - 1, lo - 1, -1):
        for _ in range(4):  # inserts chain at most through the four states of a layer
            for state in range(4):
                node = 4 * layer + state
                live[node - 4 * lo] |= any(price[node] == cost + price[4 * (layer + taken) + to] and live[4 * (layer + taken - lo) + to]
                                           for _, cost, taken, to in ARCS[codes[layer]][state])
    return live


# ---------------------------------------------------------------- rows in order

class _Texts:
    """Role and text of a conversation's rows in order, in memory up to ``SPOOL`` bytes."""

    def __init__(self) -> None:
        self.file = tempfile.SpooledTemporaryFile(max_size=SPOOL)

    def add(self, role: str, text: str) -> None:
        role, text = role.encode(), text.encode()
        self.file.write(len(role).to_bytes(8, "big") + len(text).to_bytes(8, "big") + role + text)

    def rows(self) -> Iterator[tuple[str, str]]:
        self.file.seek(0)
        while head := self.file.read(16):
            role = self.file.read(int.from_bytes(head[:8], "big"))
            yield role.decode(), self.file.read(int.from_bytes(head[8:], "big")).decode()
        self.file.close()


def repaired(rows: Iterator[tuple[str, str]], audit: str) -> Iterator[tuple[str, str]]:
    """The turns that an audit makes of ``(role, text)`` rows."""
    state = STARTED
    for letter in audit:
        if letter == "I":
            state = OTHER[state]
            yield ROLE[state], ""
            continue
        role, text = next(rows)
        if letter == "K":
            state = NEXT[state][role[:1]]
            yield role, text
        elif letter == "R":
            state = OTHER[state]
            yield ROLE[state], text


class _Conversation:
    def __init__(self, conv_id: int | None, key: str) -> None:
        self.conv_id, self.key = conv_id, key
        self.codes, self.texts, self.last = bytearray(), _Texts(), None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = None

    def add(self, turn: int | None, role: str, text: str, blank: bool, again: bool, cut: bool) -> None:
        """The next row; ``again``: role and text were there at an earlier turn."""
        if turn is not None and turn != self.high:
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
        again = again or self.last == (role, text)
        if self.last is not None:
            self.illegal += self.last[0][:1] + role[:1] not in ("su", "ua", "au")
        self.last = (role, text)
        code = INITIALS.get(role[:1], 0)
        if blank:
            self.blank, code = self.blank + 1, code | MUST_GO
        elif again:
            self.duplicate, code = self.duplicate + 1, code | MUST_GO
        elif cut:
            self.truncated, code = self.truncated + 1, code | CUT
        self.codes.append(code)
        self.texts.add(role, text)

    def edits(self, memo: dict) -> tuple[int, str]:
        codes = bytes(self.codes)
        if len(codes) > MEMO_ROWS:
            return cheapest_edits(codes)
        if codes not in memo:
            if len(memo) >= MEMO:
                memo.clear()
            memo[codes] = cheapest_edits(codes)
        return memo[codes]

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[_Conversation]:
    """Conversations of a partition sorted by key, turn, role and text."""
    now = None
    for b in batches:
        for conv_id, key, turn, role, text, copies, blank, again, cut in zip(*(b.column(i).to_pylist() for i in range(b.num_columns))):
            if now is None or now.key != key:
                if now is not None:
                    yield now
                now = _Conversation(conv_id, key)
            for _ in range(copies):
                now.add(turn, role, text, blank, again, cut)
    if now is not None:
        yield now


# ---------------------------------------------------------------- Spark

def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after the stated damage: ``copies`` is 0 for a dropped row, 2 for a repeated one."""
    def or_space(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")).cast("binary")) % 20
    text = or_space("text")
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(or_space("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def in_order(rows: DataFrame) -> DataFrame:
    """Rows with their faults, dealt by conversation and sorted inside it."""
    rows = rows.select(
        "conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"), F.col("turn").cast("long").alias("turn"),
        "role", "text", "copies",
        F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256).alias("same"))
    place = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn"))
    first = rows.where("copies > 0").groupBy("key", "same").agg(F.min(place).alias("first"))
    return (rows.join(first, ["key", "same"], "left")
            .select("conv_id", "key", "turn", "role", "text", "copies",
                    (~F.col("text").rlike(f"[^{BLANKS}]")).alias("blank"),
                    F.coalesce(place > F.col("first"), F.lit(False)).alias("again"),
                    (~F.col("text").rlike(f"[.!?][{BLANKS}]*\\z")).alias("cut"))
            .repartition("key").sortWithinPartitions("key", F.asc_nulls_first("turn"), "role", "text"))


def repair(rows: DataFrame) -> DataFrame:
    """Per ``conv_id`` of ``rows`` (``conv_id, turn, role, text, copies``): its
    faults, the least repair cost, the audit and the repaired text's digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, memo = [], {}
        for c in _conversations(batches):
            cost, audit = c.edits(memo)
            digest = hashlib.sha256()
            for i, (role, text) in enumerate(repaired(c.texts.rows(), audit)):
                digest.update(f"{'\n' if i else ''}{role}:{text}".encode())
            out.append((c.conv_id, c.gaps, c.blank, c.duplicate, c.truncated, c.illegal, cost, audit, digest.hexdigest()))
            if len(out) == 512:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=names)
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    id_type = rows.schema["conv_id"].dataType.simpleString()
    types = [to_arrow_type(rows.schema["conv_id"].dataType), *[pa.int64()] * 6, pa.string(), pa.string()]
    prepare(rows.sparkSession)
    return in_order(rows).mapInArrow(run, f"conv_id {id_type}, gaps long, blank long, duplicate long, truncated long, illegal long, "
                                          "cost long, audit string, repaired_sha256 string")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations themselves: ``conv_id, position, role, text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = {}
        for c in _conversations(batches):
            held, size, position = [], 0, 0
            for role, text in repaired(c.texts.rows(), c.edits(memo)[1]):
                held.append((c.conv_id, position, role, text))
                position, size = position + 1, size + len(text) + 64
                if size > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), types)], names=names)
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), types)], names=names)
    names = ["conv_id", "position", "role", "text"]
    id_type = rows.schema["conv_id"].dataType.simpleString()
    types = [to_arrow_type(rows.schema["conv_id"].dataType), pa.int64(), pa.string(), pa.string()]
    prepare(rows.sparkSession)
    return in_order(rows).mapInArrow(run, f"conv_id {id_type}, position long, role string, text string")
