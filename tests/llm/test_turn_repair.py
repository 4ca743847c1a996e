"""Conversation repair against a search over automaton states, on planted damage and edges."""

import functools
import hashlib
import random
import zlib

import pytest

import __spark_entry__ as E
from halyard.llm import turn_repair as R

SCHEMA = "conv_id long, turn long, role string, text string, place long, edit string, audit string"


def cheapest(kinds):
    """Least (cost, audit) by states of the grammar: start, after s, after u, after a."""
    @functools.cache
    def best(i, state, inserted):
        options = [(0, "")] if i == len(kinds) and state in "0a" else []
        after = {"0": "su", "s": "u", "u": "a", "a": "u"}[state]
        if i < len(kinds):
            kind, cut = kinds[i] & 7, 3 * (kinds[i] >= R.CUT)
            c, a = best(i + 1, state, 0)
            options.append((c + 4, "D" + a))
            if kind != R.FORCED:
                for to in after:
                    c, a = best(i + 1, to, 0)
                    own = {"u": R.USER, "a": R.ASSISTANT, "s": R.SYSTEM}[to] == kind
                    if own or to != "s":
                        options.append((c + cut + 3 * (not own), "KR"[not own] + a))
        if inserted < 2:
            for to in after.replace("s", ""):
                c, a = best(i, to, inserted + 1)
                options.append((c + 3, "I" + a))
        return min(options, default=(1 << 30, ""))
    return best(0, "0", 0)


def random_kinds(rng, n, forced=0.1):
    return bytes(R.FORCED if rng.random() < forced else rng.choice((0, 0, 1, 1, 2, 3)) + R.CUT * (rng.random() < 0.2) for _ in range(n))


def test_audits_are_the_cheapest():
    rng = random.Random(3)
    for n in list(range(7)) * 150 + [20, 40] * 10:
        kinds = random_kinds(rng, n)
        assert R.audit(kinds) == cheapest(kinds), kinds


def test_blocks_change_nothing(monkeypatch):
    rng = random.Random(4)
    every = [random_kinds(rng, 60) for _ in range(20)]
    want = [R.audit(k) for k in every]
    monkeypatch.setattr(R, "BLOCK", 3)
    monkeypatch.setattr(R, "FIRST_BUDGET", 1)
    assert [R.audit(k) for k in every] == want


def test_long_conversations():
    rng = random.Random(5)
    clean = bytes([R.USER, R.ASSISTANT] * 5000)
    assert R.audit(clean) == (0, "K" * 10_000)
    hurt = bytes(k for k in clean if rng.random() > 0.02)
    cost, edits = R.audit(hurt)
    spelled, kinds = "".join(R.targets(edits)), iter(hurt)
    assert spelled == "ua" * (len(spelled) // 2) and cost > 0
    for e in edits:
        if e != "I":
            next(kinds)
    assert next(kinds, None) is None


def plain(rows):
    """The contract's damage and repair of one conversation's (conv_id, turn, role, text) rows, row by row."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if harm == 1:
            text = ""
        elif harm == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif harm == 4:
            role = "user"
        out += [(turn, role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1)
    out.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    turns = [t for t, _, _ in out if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    kinds, seen, counts = [], set(), {"b": 0, "d": 0, "t": 0}
    for _, role, text in out:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "-"
        seen.add((role, text))
        if fault != "-":
            counts[fault] += 1
        kinds.append(R.FORCED if fault in "bd" else {"u": 0, "a": 1, "s": 2}.get(role[:1], 3) + R.CUT * (fault == "t"))
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(out, out[1:]))
    cost, audit = cheapest(bytes(kinds))
    roles, turns, repaired = R.targets(audit), iter(out), []
    for e in audit:
        if e == "I":
            repaired.append({"u": "user", "a": "assistant"}[next(roles)] + ":")
            continue
        _, role, text = next(turns)
        if e != "D":
            to = next(roles)
            repaired.append(({"u": "user", "a": "assistant"}[to] if e == "R" else role) + ":" + text)
    return gaps, counts["b"], counts["d"], counts["t"], illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest()


def check(spark, table, rows):
    got = {r["conv_id"]: tuple(r)[1:] for r in table.collect()}
    want = {}
    for r in rows:
        want.setdefault(r[0], []).append(tuple(r))
    assert got.keys() == want.keys()
    for conv, turns in want.items():
        assert got[conv] == plain(turns), conv


def test_op11(spark, sf):
    rows = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    check(spark, E.queries()["op11_turn_repair"](spark, sf), rows)


@pytest.fixture
def edge_turns():
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (1, None, None, None), (None, 0, "user", "One?"), (None, 4, "assistant", "Two"),
            (2, None, "", "x."), (2, None, "", "x."), (3, 5, "usher", "a　b."), (3, 6, "a:", "user:x!"), (3, 9, "Assistant", "."), (4, 1, "system", "s."),
            (5, 2, "tool", "t" * 300_000), (5, 3, "user", " \t\n\x0b\x0c\r"), (5, 8, "user", " ")]
    rows += [(6, i, ("user", "assistant")[i % 2], f"Turn {i}.") for i in range(800)]
    return rows + [(c, t, r, x) for c in range(20, 60) for t, r, x in [(c, "user", "Go.")]]


def test_edges(spark, edge_turns, tmp_path):
    full = [(*r, -1, "e", "a") for r in edge_turns]
    spark.createDataFrame(full, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    check(spark, E.queries()["op11_turn_repair"](spark, str(tmp_path)), edge_turns)
    fixed = R.repair(spark.createDataFrame(full, SCHEMA))
    turns = fixed.where("conv_id = 6 and place >= 0").orderBy("place").collect()
    assert len(turns) == 800 and [t["text"] for t in turns] == [f"Turn {i}." for i in range(800)]
    empty = R.repair(spark.createDataFrame(full, SCHEMA).limit(0))
    assert empty.count() == 0
