"""Conversation repair against an exhaustive search."""

import hashlib
import random
import re
import zlib

import pytest

from tenure.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string, piece string, id string, rows int, copies string"


def cheapest(rows):
    """(cost, audit, repaired) by trying all edits; rows: (role, text, alive, truncated)."""
    best = None
    named = {"u": "user", "a": "assistant"}
    seen: dict = {}

    def go(k, state, cost, audit, out, inserted):
        nonlocal best
        if best and cost > best[0]:
            return
        if seen.setdefault((k, state, inserted), (cost, audit)) < (cost, audit):
            return
        seen[k, state, inserted] = (cost, audit)
        if k == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(r[0][:1] for r in out)):
            if best is None or (cost, audit) < best[:2]:
                best = (cost, audit, list(out))
        if inserted < 3:
            for x in "ua":
                if (state, x) in repair.STEP:
                    go(k, repair.STEP[state, x], cost + 2, audit + "I", out + [(named[x], "")], inserted + 1)
        if k < len(rows):
            role, text, alive, truncated = rows[k]
            go(k + 1, state, cost + 3, audit + "D", out, 0)
            if alive:
                if (state, role[:1]) in repair.STEP:
                    go(k + 1, repair.STEP[state, role[:1]], cost + truncated, audit + "K", out + [(role, text)], 0)
                for x in "ua":
                    if (state, x) in repair.STEP:
                        go(k + 1, repair.STEP[state, x], cost + 2 + truncated, audit + "R", out + [(named[x], text)], 0)

    go(0, 0, 0, "", [], 0)
    return best


def forward(rows):
    """The same, row by row: for long conversations."""
    named = {"u": "user", "a": "assistant"}

    def inserted(best):
        for _ in range(2):
            for p, (cost, audit, out) in list(best.items()):
                for x in "ua":
                    put(best, repair.STEP.get((p, x)), (cost + 2, audit + "I", out + [(named[x], "")]))
        return best

    def put(best, q, way):
        if q is not None and (q not in best or way[:2] < best[q][:2]):
            best[q] = way

    now = inserted({0: (0, "", [])})
    for role, text, alive, truncated in rows:
        after: dict = {}
        for p, (cost, audit, out) in now.items():
            put(after, p, (cost + 3, audit + "D", out))
            if alive:
                put(after, repair.STEP.get((p, role[:1])), (cost + truncated, audit + "K", out + [(role, text)]))
                for x in "ua":
                    put(after, repair.STEP.get((p, x)), (cost + 2 + truncated, audit + "R", out + [(named[x], text)]))
        now = inserted(after)
    return min(now[q] for q in (0, 3) if q in now)


def brute(rows, damage=False):
    by = {r[0]: [] for r in rows}
    for conv, turn, role, text in (r[:4] for r in rows):
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        by[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, flags, faults = set(), [], [0, 0, 0]
        for _, role, text in own:
            body = re.sub(r"[\x20\x09-\x0d]+\Z", "", text)
            cut = bool(body) and body[-1] not in ".!?"
            fault = 0 if not body else 1 if (role, text) in seen else 2 if cut else None
            seen.add((role, text))
            if fault is not None:
                faults[fault] += 1
            flags.append((role, text, fault not in (0, 1), fault == 2))
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, kept = (cheapest if len(flags) < 40 else forward)(flags)
        said = "\n".join(f"{r}:{t}" for r, t in kept)
        out[conv] = (gaps, *faults, illegal, cost, audit, hashlib.sha256(said.encode()).hexdigest())
    return out


def _rows(seed, n, convs=25):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "", " \t", "Why? ", "x!", "long one.\n", None, "a. b"]
    roles = ["system", "user", "user", "assistant", "assistant", "tool", None, ""]
    rows = [(rng.randint(0, convs), rng.choice([None, *range(-5, 20)]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]
    rows += [(None, 1, "user", "ok."), (None, 2, "user", "ok."), rows[0], rows[0], rows[1]]
    return [(*r, "p", "i", 4, "c") for r in rows]


def _got(spark, rows, damage=False, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    found = repair.digest(repair.repair(repair.damaged(df) if damage else df, **kw), df).collect()
    assert len(found) == len({r[0] for r in found})
    return {r[0]: tuple(r[1:]) for r in found}


@pytest.mark.parametrize("seed, n, per_piece, damage", [(1, 150, 256, True), (2, 200, 2, False), (3, 250, 1, True)])
def test_repair_equals_exhaustive_search(spark, seed, n, per_piece, damage):
    rows = _rows(seed, n)
    assert _got(spark, rows, damage, turns_per_piece=per_piece) == brute(rows, damage)


def test_repair_of_long_and_empty_conversations(spark):
    rng = random.Random(5)
    rows = [(1, 3 * t, rng.choice(["user", "assistant", "assistant"]), f"turn {t // 2}" + rng.choice(".,")) for t in range(700)]
    rows += [(2, 10**12, "user", "far."), (2, -(10**12), "assistant", "early."), (3, None, None, None)]
    rows = [(*r, "p", "i", 4, "c") for r in rows]
    for per_piece in (256, 1):
        assert _got(spark, rows, turns_per_piece=per_piece) == brute(rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.digest(repair.repair(empty), empty).count() == 0


def test_repair_counts_copies_without_gathering():
    cell = repair.piece_cell(["u", "a"], [100_000, 1], [True, True], [False, False])
    best = repair.chosen([cell["costs"]], [cell["audits"]], [cell["illegal"]], ["u"], ["a"])
    assert best == {"cost": 3 * 99_999, "audit": "K" + "D" * 99_999 + "K", "illegal": 99_999}
    assert [x["row"] for x in repair.picks(0, best["audit"], ["user", "assistant"], [100_000, 1])] == [1, 2]
