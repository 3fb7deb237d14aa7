import hashlib
import random
import re
import zlib

from corpusloom.llm import turn_repair as R
from corpusloom.llm.queries import op12_turn_repair

SF = "/root/testdata/sf0.001"
GAP = "[^\x20\x09-\x0D]"


def slow_edits(rows):
    """(cost, audit) over rows of (initial, must go, truncated): every state's best (cost, text) from the end."""
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    new = {"": "u", "s": "u", "u": "a", "a": "u"}

    def with_inserts(best):
        for _ in range(5):
            for state in best:
                cost, audit = best[new[state]]
                best[state] = min(best[state], (cost + 2, "I" + audit))
        return best
    far = (10 ** 9, "")
    best = with_inserts({"": (0, ""), "s": far, "u": far, "a": (0, "")})
    for initial, must_go, cut in reversed(rows):
        now = {}
        for state in best:
            options = [(best[state][0] + 3, "D" + best[state][1])]
            if not must_go:
                if initial in step[state]:
                    cost, audit = best[step[state][initial]]
                    options.append((cost + cut, "K" + audit))
                cost, audit = best[new[state]]
                options.append((cost + 2 + cut, "R" + audit))
            now[state] = min(options)
        best = with_inserts(now)
    return best[""]


def slow_query(rows):
    """The contract, read row by row over (conv_id, turn, role, text)."""
    after, ids = [], []
    for conv, turn, role, text in rows:
        ids.append(conv)
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        after += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv in dict.fromkeys(ids):
        own = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        faults, seen, codes = [], set(), []
        for _, _, role, text in own:
            last = re.findall(GAP, text)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            codes.append((role[:1], fault in ("blank", "duplicate"), int(fault == "truncated")))
        cost, audit = slow_edits(codes)
        turns = [r[1] for r in own if r[1] is not None]
        state, lines, at = "", [], 0
        for letter in audit:
            if letter == "I":
                state = "assistant" if state == "user" else "user"
                lines.append(f"{state}:")
                continue
            role, text = own[at][2:]
            at += 1
            if letter == "K":
                lines.append(f"{role}:{text}")
                state = "user" if role[:1] == "u" else "assistant" if role[:1] == "a" else "system"
            elif letter == "R":
                state = "assistant" if state == "user" else "user"
                lines.append(f"{state}:{text}")
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:])), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def code(row):
    return R.INITIALS.get(row[0], 0) | (R.MUST_GO if row[1] else R.CUT if row[2] else 0)


def test_auction_finds_the_least_audit():
    r = random.Random(5)
    for n in [*range(8)] * 60 + [20, 63, 64, 65, 130, 400]:
        rows = [(r.choice("suatx"), r.random() < 0.2, 0) for _ in range(n)]
        rows = [(a, b, int(not b and r.random() < 0.3)) for a, b, _ in rows]
        assert R.cheapest_edits(bytes(map(code, rows))) == slow_edits(rows)


def test_prices_are_feasible_and_exact_at_cuts():
    r = random.Random(6)
    codes = bytes(r.choice([1, 2, 3, 0, 4, 10, 11]) for _ in range(150))
    n = len(codes)
    price = R.array("q", bytes(32 * (n + 1)))
    price[4 * n + R.USER], price[4 * n + R.SYSTEM] = 2, 4
    R.auction(codes, price, 100, n)
    for layer in range(100, n):
        for state in range(4):
            assert all(price[4 * layer + state] <= cost + price[4 * (layer + taken) + to] for _, cost, taken, to in R.ARCS[codes[layer]][state])


def test_long_conversation_is_linear():
    codes = bytes(random.Random(7).choice([1, 2, 3, 0, 6, 10, 11]) for _ in range(20_000))
    cost, audit = R.cheapest_edits(codes)
    assert cost > 0 and len(audit) - audit.count("I") == 20_000


def compare(spark, rows):
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, key string, copies int")
    key = lambda x: (x[0] is None, x[0] or 0)
    got = sorted((tuple(x) for x in R.repair(R.damaged(table)).collect()), key=key)
    assert got == sorted(slow_query(rows), key=key)


def test_awkward_rows(spark):
    r = random.Random(8)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "User", None]
    texts = ["Done.", "Well?", "cut off", "", " \n\t", None, "é漢😀!", "Ja. \n", "x" * 3000 + ".", "Yes!\x85", "nbsp "]
    rows = [(None if c == 0 else c, None if r.random() < 0.1 else r.randrange(12), r.choice(roles), r.choice(texts))
            for c in range(120) for _ in range(r.randrange(1, 9))]
    compare(spark, rows + rows[:40])


def test_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(R, "SPOOL", 1000)
    r = random.Random(9)
    compare(spark, [(7, t, r.choice(["user", "assistant"]), "word " * r.randrange(60) + r.choice([".", ""])) for t in range(1500)])


def test_repaired_turns(spark):
    rows = [(1, 0, "assistant", "Hello.", 1), (1, 1, "user", "Hi.", 1), (2, 0, "user", "x", 0), (3, 0, "system", "S.", 1), (3, 1, "user", "U.", 1)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, copies int")
    got = sorted(map(tuple, R.repaired_turns(table).collect()))
    assert got == [(1, 0, "user", ""), (1, 1, "assistant", "Hello."), (1, 2, "user", "Hi."), (1, 3, "assistant", ""),
                   (3, 0, "system", "S."), (3, 1, "user", "U."), (3, 2, "assistant", "")]
    for conv in (1, 3):
        assert re.fullmatch("(s?(ua)+)?", "".join(x[2][0] for x in got if x[0] == conv))


def test_query_on_the_table(spark):
    rows = [tuple(x) for x in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, op12_turn_repair(spark, SF).collect())) == sorted(slow_query(rows))


def test_empty(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert R.repair(R.damaged(table)).count() == 0
