"""Conversation repair against exhaustive search, a plain dynamic program and hand-made cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from touchcredit.llm import conversations as C
from touchcredit.llm.common import ensure_importable

GRAMMAR = re.compile(r"(s?(ua)+)?\Z")
SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, fault int, cost long, audit string, place long"


def fault_of(role, text, seen):
    bare = text.strip(SPACE)
    if not bare:
        return C.BLANK
    if (role, text) in seen:
        return C.DUPLICATE
    return C.SOUND if bare[-1] in ".!?" else C.TRUNCATED


def exhaustive(turns):
    """(cost, audit, lines) by trying every edit string, with at most two inserted turns at a place."""
    best = None

    def go(i, cost, audit, lines):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(turns):
            if GRAMMAR.match("".join(r[:1] or "?" for r, _ in lines)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, list(lines))
        else:
            role, text, fault = turns[i]
            go(i + 1, cost + 2, audit + "D", lines)
            if fault not in (C.BLANK, C.DUPLICATE):
                more = 5 if fault == C.TRUNCATED else 0
                go(i + 1, cost + more, audit + "K", [*lines, (role, text)])
                for r in ("user", "assistant"):
                    go(i + 1, cost + 1 + more, audit + "R", [*lines, (r, text)])
        if not audit.endswith("II"):
            for r in ("user", "assistant"):
                go(i, cost + 5, audit + "I", [*lines, (r, "")])

    go(0, 0, "", [])
    return best


def by_program(turns):
    """(cost, audit) by a backward dynamic program over whole strings."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    @lru_cache(None)
    def best(i, state, inserted):
        options = []
        if i == len(turns):
            if state in (0, 3):
                options.append((0, ""))
        else:
            role, _, fault = turns[i]
            c, s = best(i + 1, state, 0)
            options.append((c + 2, "D" + s))
            if fault not in (C.BLANK, C.DUPLICATE):
                more = 5 if fault == C.TRUNCATED else 0
                for mark, initial, price in (("K", role[:1], 0), ("R", "u", 1), ("R", "a", 1)):
                    if (state, initial) in step:
                        c, s = best(i + 1, step[state, initial], 0)
                        options.append((c + price + more, mark + s))
        if inserted < 2:
            for initial in "ua":
                if (state, initial) in step:
                    c, s = best(i, step[state, initial], inserted + 1)
                    options.append((c + 5, "I" + s))
        return min(options, default=(10 ** 9, ""))

    return best(0, 0, 0)


def run(turns):
    edits = []
    r = C.Repair(lambda *e: edits.append(e))
    for t in turns:
        r.turn(*t)
    cost = r.finish()
    return cost, "".join(e[0] for e in edits), [(e[2], e[3]) for e in edits if e[0] != "D"], r


def draw(rng, n):
    return [(rng.choice(["system", "user", "assistant", "user", "assistant", "tool", " "]), rng.choice("abcdef"),
             rng.choice([0, 0, 0, 0, C.BLANK, C.DUPLICATE, C.TRUNCATED])) for _ in range(n)]


def test_exhaustive():
    rng = random.Random(3)
    for case in range(400):
        turns = draw(rng, rng.randint(0, 5))
        assert run(turns)[:3] == exhaustive(turns), turns


def test_long_conversations():
    rng = random.Random(4)
    for case in range(300):
        turns = draw(rng, rng.randint(0, 60))
        cost, audit, lines, _ = run(turns)
        assert (cost, audit) == by_program(turns)
        assert GRAMMAR.match("".join(r[:1] for r, _ in lines))


def test_survivors_coalesce():
    """A conversation in order is emitted as it streams, whatever its length; an unresolved one is still exact."""
    seen = []
    r = C.Repair(lambda *e: seen.append(e))
    held = 0
    for i in range(50_000):
        r.turn("user" if i % 2 == 0 else "assistant", "x.", C.SOUND)
        if i % 997 == 3:
            r.turn("user", "", C.BLANK)
        held = max(held, r.unresolved)
    assert held < 40 and len(seen) > 50_000 - 40 and r.finish() == 2 * 51
    # nothing settles whether the first or the last turn of an odd number goes: the tie stays open and D first wins
    odd = [("tool", "x", C.SOUND)] * 301
    cost, audit, _, r = run(odd)
    assert (cost, audit) == (302, "D" + "R" * 300) and r.unresolved > 250
    r = C.Repair(lambda *e: None)
    for _ in range(100_000):
        r.turn("tool", "x", C.SOUND)
    assert r.finish() == 100_000


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if key == 1 else re.sub("[.!?]", "", text) if key == 2 else text
        role = "user" if key == 4 else role
        out += [(conv, turn, role, text)] * (0 if key == 0 else 2 if key == 3 else 1)
    return out


def expected(rows):
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in damaged(rows) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, turns, counts = set(), [], [0, 0, 0, 0]
        for _, _, role, text in mine:
            fault = fault_of(role, text, seen)
            seen.add((role, text))
            counts[fault] += 1
            turns.append((role, text, fault))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        known = [r[1] for r in mine if r[1] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        cost, audit = by_program(tuple(turns))
        lines, state, left = [], 0, list(turns)
        for mark in audit:
            due = "assistant" if state == 2 else "user"
            if mark == "I":
                lines.append((due, ""))
            else:
                role, text, _ = left.pop(0)
                if mark == "D":
                    continue
                lines.append((role if mark == "K" else due, text))
            state = {"s": 1, "u": 2, "a": 3}[lines[-1][0][0]]
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out.append((conv, gaps, counts[1], counts[2], counts[3], illegal, cost, audit, digest))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def table(spark, rows):
    return spark.createDataFrame([(c, t, r, x, 1, 2, "a", 3) for c, t, r, x in rows], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    out = []
    for conv in [*range(120), None, -7]:
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "User", "", None])
            text = rng.choice(["Hello there.", "And now", "Is it? ", "ok!", "", " \n", None, "É. \x0b", "x" * 50 + ".", "a b c", "no "])
            out.append((conv, rng.choice([turn, turn, turn * 2, None, -turn]), role, text))
    out += [(500, k, "user" if k % 2 else "assistant", f"turn {k}.") for k in range(3000)]
    return out + [(501, 1, "user", "long. " * 50_000)]


def test_audit_against_program(spark, rows):
    ensure_importable(spark)
    got = C.audit(C.damage(C.as_turns(table(spark, rows)))).collect()
    small = [r for r in rows if r[0] not in (500,)]
    have = sorted((tuple(r) for r in got if r["conv_id"] != 500), key=lambda r: (r[0] is not None, r[0] or 0))
    assert have == expected(small)
    long = next(r for r in got if r["conv_id"] == 500)
    assert long["gaps"] > 0 and long["cost"] > 0 and len(long["audit"]) > 2500


def test_repair_gives_the_turns(spark, rows):
    turns = C.damage(C.as_turns(table(spark, rows)))
    edits = C.repair(turns).toPandas()
    digests = {r["conv_id"]: r for r in C.audit(turns).collect()}
    for conv, part in edits[edits["conv_id"].notna()].groupby("conv_id"):
        part = part.sort_values("step")
        lines = part[part["edit"] != "D"]
        assert "".join(part["edit"]) == digests[conv]["audit"]
        text = "\n".join(f"{r}:{t}" for r, t in zip(lines["role"], lines["text"]))
        assert hashlib.sha256(text.encode()).hexdigest() == digests[conv]["repaired_sha256"]


def test_all_dropped_and_empty(spark):
    ensure_importable(spark)
    gone = [(c, t) for c in range(2000) for t in (0,) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:3]
    got = C.audit(C.damage(C.as_turns(table(spark, [(c, t, "user", "x.") for c, t in gone])))).collect()
    assert sorted(tuple(r) for r in got) == sorted((c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, _ in gone)
    assert C.audit(C.damage(C.as_turns(table(spark, [(1, 1, "user", "x")]).limit(0)))).count() == 0
