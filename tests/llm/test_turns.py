"""Conversation repair against an exhaustive search and a plain table of whole edit strings."""

import hashlib
import random
import re
import zlib

import pyarrow as pa
import pytest

from hazardlens.llm import turns
from hazardlens.llm.queries import QUERIES
from hazardlens.llm.turns import BLANK, DUPLICATE, FAULT_OFFSET, SOUND, TRUNCATED, Search

SF = "/root/testdata/sf0.001"
LEGAL = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\f\r"


def exhaustive(rows, inserts=3):
    """``(cost, audit)`` of the best of all ways; rows are ``(initial, fault)``."""
    best = (1 << 30, "")

    def go(at, left, roles, cost, audit):
        nonlocal best
        if cost > best[0]:
            return
        if at == len(rows) and LEGAL.fullmatch(roles):
            best = min(best, (cost, audit))
        if left:
            for role in "ua":
                go(at, left - 1, roles + role, cost + 5, audit + "I")
        if at < len(rows):
            initial, fault = rows[at]
            go(at + 1, left, roles, cost + 2, audit + "D")
            if fault not in (BLANK, DUPLICATE):
                more = 5 if fault == TRUNCATED else 0
                go(at + 1, left, roles + (initial or "?"), cost + more, audit + "K")
                for role in "ua":
                    go(at + 1, left, roles + role, cost + more + 1, audit + "R")

    go(0, inserts, "", 0, "")
    return best


def table(rows):
    """``(cost, audit)`` by a table of the best whole strings, without pruning."""
    after = {0: 2, 1: 2, 2: 3, 3: 2}
    best = {0: (0, "")}

    def inserted():
        for _ in range(3):
            for s, (c, a) in list(best.items()):
                best[after[s]] = min(best.get(after[s], (1 << 30, "")), (c + 5, a + "I"))

    for initial, fault in rows:
        inserted()
        new = {}
        for s, (c, a) in best.items():
            ways = [(s, c + 2, a + "D")]
            if fault not in (BLANK, DUPLICATE):
                more = 5 if fault == TRUNCATED else 0
                ways.append((after[s], c + 1 + more, a + "R"))
                if initial == "s" and s == 0:
                    ways.append((1, c + more, a + "K"))
                if initial == "ua"[after[s] - 2]:
                    ways.append((after[s], c + more, a + "K"))
            for t, cost, audit in ways:
                new[t] = min(new.get(t, (1 << 30, "")), (cost, audit))
        best.clear()
        best.update(new)
    inserted()
    return min(best[s] for s in (0, 3) if s in best)


def searched(rows, settle=False):
    search, out, held = Search(), b"", 0
    for initial, fault in rows:
        search.turn(initial, fault)
        if settle:
            out += search.settled()
        held = max(held, search.unresolved())
    cost, rest = search.finish()
    return (cost, "".join(chr((c - 64) % 32 + 64) for c in out + rest)), held


def some(rng, n):
    initials = rng.choice(["suax", "ua", "u", "sua", "uuua"])
    faults = rng.choice([[SOUND], [SOUND, SOUND, SOUND, TRUNCATED], [SOUND, BLANK], [SOUND, BLANK, DUPLICATE, TRUNCATED]])
    return [(rng.choice(initials) if rng.random() < 0.9 else "", rng.choice(faults)) for _ in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_search_equals_all_ways(seed):
    rng = random.Random(seed)
    for _ in range(60):
        rows = some(rng, rng.randrange(6))
        assert searched(rows)[0] == exhaustive(rows) == table(rows), rows


@pytest.mark.parametrize("seed", range(4))
def test_search_equals_table_of_strings(seed):
    rng = random.Random(100 + seed)
    for _ in range(150):
        rows = some(rng, rng.randrange(60))
        want = table(rows)
        assert searched(rows)[0] == want and searched(rows, settle=True)[0] == want, rows


def test_memory_stays_small_and_edits_leave_early():
    rng = random.Random(3)
    rows = [("ua"[i % 2], SOUND if rng.random() < 0.9 else rng.choice([BLANK, DUPLICATE, TRUNCATED])) for i in range(100_000)]
    _, held = searched(rows, settle=True)
    assert held < 200
    # only users: which turn goes is open to the end, and all of it is held, a byte for each survivor
    rows = [("u", SOUND)] * 2001
    got, held = searched(rows, settle=True)
    assert got == table(rows) and held < 4 * 2001


def plain_repair(rows):
    """The contract's row of one damaged conversation, ``rows`` as ``(turn, role, text)`` in order."""
    known, facts = set(), []
    for _, role, text in rows:
        end = text.rstrip(SPACE)[-1:]
        fault = BLANK if not end else DUPLICATE if (role, text) in known else SOUND if end in ".!?" else TRUNCATED
        known.add((role, text))
        facts.append((role[:1], fault))
    cost, audit = table(facts)
    out, at, expected = [], 0, "user"
    for letter in audit:
        if letter == "I":
            role, text = expected, ""
        else:
            _, role, text = rows[at]
            at += 1
            role = expected if letter == "R" else role
        if letter != "D":
            out.append(f"{role}:{text}")
            expected = {"u": "assistant"}.get(role[:1], "user")
    numbers = {t for t, _, _ in rows if t is not None}
    pairs = list(zip(rows, rows[1:]))
    return {
        "gaps": max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
        **{n: sum(f == k for _, f in facts) for n, k in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))},
        "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest(),
    }


def order(row):
    turn, role, text = row
    return turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def damaged(rows):
    """The rows of all conversations by id, after the damage."""
    out = {}
    for conversation, turn, role, text in rows:
        group = out.setdefault(conversation, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = ":".join(" " if x is None else str(x) for x in (conversation, turn))
        fault = zlib.crc32(key.encode()) % 20
        if fault == 1:
            text = ""
        elif fault == 2:
            text = re.sub("[.!?]", "", text)
        elif fault == 4:
            role = "user"
        group.extend([(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1))
    return {c: sorted(g, key=order) for c, g in out.items()}


def odd_rows():
    rng = random.Random(8)
    texts = ["Yes.", "No?", "cut", " \t\n", "", "a b.", "end. ", "é!", None, "ok. \r\n"]
    rows = []
    for conversation in [None, *range(60)]:
        for _ in range(rng.randrange(1, 14)):
            turn = rng.choice([None, *range(-2, 9)])
            role = rng.choice(["user", "assistant", "system", "user", "assistant", None, "", "User", "agent", "élan"])
            rows.append((conversation, turn, role, rng.choice(texts) if rng.random() < 0.6 else f"Line {rng.random()}."))
    return rows + rows[:20]


def test_query_equals_plain_repair_on_odd_rows(spark, tmp_path):
    rows = odd_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.withColumns({c: df["turn"] for c in ("_conv", "_edits", "cost")}).repartition(5).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: r.asDict() for r in QUERIES["op11_conversation_repair"](spark, str(tmp_path)).collect()}
    want = {c: {"conv_id": c, **plain_repair(g)} for c, g in damaged(rows).items()}
    assert got == want
    assert all(any(w[n] for w in want.values()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal"))


def test_query_equals_plain_repair_on_given_rows(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: r.asDict() for r in QUERIES["op11_conversation_repair"](spark, SF).collect()}
    assert got == {c: {"conv_id": c, **plain_repair(g)} for c, g in damaged(rows).items()}


def test_edits_in_pieces_and_inserts(monkeypatch):
    monkeypatch.setattr(turns, "PIECE", 8)
    facts = [(c, "ua"[i % 2], BLANK if i == 9 else SOUND) for c in (1, None) for i in range(30)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(("_conv", "_initial", "_fault"), f)) for f in facts[a : a + 25]]) for a in (0, 25, 50)]
    found = [r for b in turns._searched(iter(batches)) for r in b.to_pylist()]
    for conversation in (1, None):
        mine = [r for r in found if r["_conv"] == conversation]
        assert [r["_piece"] for r in mine] == list(range(len(mine))) and len(mine) > 2
        rows = [(i, f) for c, i, f in facts if c == conversation]
        assert "".join(chr((c - 64) % 32 + 64) for r in mine for c in r["_edits"]) == table(rows)[1]
    # an insert is never cheapest at these costs, but applied where it stands
    kinds = pa.schema([("_conv", pa.int64()), ("_edits", pa.binary()), ("_turn", pa.int64()), ("_role", pa.string()), ("_text", pa.string())])
    rows = [(1, b"KI", None, None, None), (1, b"KI", None, None, None), (1, None, 4, "system", "x."), (1, None, 5, "assistant", "y.")]
    rows += [(2, b"KI", None, None, None), (2, None, 0, "user", "z.")]
    batch = pa.RecordBatch.from_pylist([dict(zip(kinds.names, r)) for r in rows], kinds)
    out = list(turns._applied(iter([batch.slice(0, 3), batch.slice(3)])))
    got = [(r["_conv"], r["place"], r["edit"], r["role"], r["text"]) for b in out for r in b.to_pylist()]
    assert got == [
        (1, 0, "keep", "system", "x."),
        (1, 1, "insert", "user", ""),
        (1, 2, "keep", "assistant", "y."),
        (1, 3, "insert", "user", ""),
        (2, 0, "keep", "user", "z."),
        (2, 1, "insert", "assistant", ""),
    ]
    first, _ = [r for b in turns._summed(iter(out)) for r in b.to_pylist()]
    assert (first["audit"], first["cost"], first["illegal"]) == ("KIKI", 10, 1)
    assert first["repaired_sha256"] == hashlib.sha256(b"system:x.\nuser:\nassistant:y.\nuser:").hexdigest()


def test_repair_gives_rows_in_order(spark):
    rows = [("c", i, "ua"[i % 2] + "x", f"t{i}.") for i in range(50) if i != 20] + [("d", 0, "system", "s."), ("e", 0, "user", "x" * 100_000)]
    df = spark.createDataFrame(rows, "k string, n int, who string, said string")
    got = turns.repair(df, "k", "n", "who", "said").collect()
    mine = [r for r in got if r["k"] == "c"]
    assert [r["place"] for r in mine] == list(range(len(mine)))
    assert [r["turn"] for r in mine if r["turn"] is not None] == [r[1] for r in rows[:49]]
    roles = "".join(r["role"][0] for r in mine if r["role"])
    assert LEGAL.fullmatch(roles)
    assert [(r["k"], r["edit"], r["fault"]) for r in got if r["k"] == "e"] == [("e", "delete", "truncated")]
    assert turns.repair(df.limit(0), "k", "n", "who", "said").collect() == []
    assert FAULT_OFFSET[SOUND] == 0
