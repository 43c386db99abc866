import hashlib
import heapq
import random
import re
import zlib

import pytest

from topicloom.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, place int, run int, conv string, hit int"
GAP = " \t\n\x0b\f\r"


def cheapest(codes):
    """(cost, audit) by going through all prefixes in order."""
    heap = [(0, "", 0, 0)]
    moves = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
    seen = set()
    while heap:
        cost, audit, at, state = heapq.heappop(heap)
        if at == len(codes) and state in (0, 3):
            return cost, audit
        if (at, state) in seen:
            continue
        seen.add((at, state))
        to = 3 if state == 2 else 2
        heapq.heappush(heap, (cost + 3, audit + "I", at, to))
        if at < len(codes):
            code = codes[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, state))
            if code != "x":
                extra = 3 if code.isupper() else 0
                heapq.heappush(heap, (cost + 3 + extra, audit + "R", at + 1, to))
                if (code.lower(), state) in moves:
                    heapq.heappush(heap, (cost + extra, audit + "K", at + 1, moves[code.lower(), state]))


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(name.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if hit == 0:
            continue
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        if hit == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if hit == 3 else 1)
    return out


def repaired(rows):
    """The digest of one conversation of damaged rows."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    turns = {r[1] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    seen, codes, faults = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, _, role, text in rows:
        bare = text.rstrip(GAP)
        kind = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if kind:
            faults[kind] += 1
        code = role[:1] if role[:1] in ("s", "u", "a") else "o"
        codes += "x" if kind in ("blank", "duplicate") else code.upper() if kind == "truncated" else code
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = cheapest(codes)
    lines, left, last = [], list(rows), None
    for letter in audit:
        name = "assistant" if last == "u" else "user"
        if letter == "I":
            lines.append(name + ":")
        else:
            _, _, role, text = left.pop(0)
            if letter == "D":
                continue
            lines.append(f"{role if letter == 'K' else name}:{text}")
        last = lines[-1][0]
    return (gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def expected(rows):
    groups = {r[0]: [] for r in rows}
    for r in damage(rows):
        groups[r[0]].append(r)
    return {conv: repaired(found) for conv, found in groups.items()}


def made(seed, n):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "", " ", "\n", "Why?", "Well! ", "é.", "a. ", "x.\u0085", None, "long " * 50]
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, 12)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "ua"])
            rows.append((conv, rng.choice([turn, turn, turn, None, turn * 3]), role, rng.choice(texts)))
    rows += [(None, t, "user", "Hm.") for t in range(4)] + [(None, None, None, None)] * 3 + [(n, 0, "user", "x" * 300_000 + ".")]
    return rows + [rows[0]] * 20


@pytest.mark.parametrize("run", [2048, 4])
def test_against_brute_force(spark, run, monkeypatch):
    monkeypatch.setattr(cr, "RUN", run)
    rows = made(run, 150)
    # One conversation with a third of all rows.
    rng = random.Random(8)
    rows += [(-1, i // 2, rng.choice(["user", "assistant"]), f"{rng.randrange(200)}{rng.choice(['.', '', '?'])}") for i in range(400)]
    df = spark.createDataFrame([(*r, 1, 2, "c", 3) for r in rows], SCHEMA).repartition(4)
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in cr.repair_digest(df).collect()}
    want = expected(rows)
    assert got.keys() == want.keys()
    for conv in want:
        assert got[conv] == want[conv], conv


def test_runs_add_up_to_the_best_of_the_whole():
    rng = random.Random(1)
    for _ in range(400):
        codes = "".join(rng.choice("suaSUAoOx" if rng.random() < 0.6 else "ua") for _ in range(rng.randrange(1, 14)))
        want = cheapest(codes)
        assert cr.search(codes, cr.START, cr.ENDS)[:2] == want
        for size in (1, 3, 5):
            parts = [codes[i:i + size] for i in range(0, len(codes), size)]
            cost, ways = cr.chained([cr.run_table(p, i == 0, i == len(parts) - 1) for i, p in enumerate(parts)])
            assert (cost, "".join(audit for _, audit in ways)) == want


def test_a_long_run_takes_a_straight_way():
    rng = random.Random(2)
    codes = "".join(rng.choice("suaSUAoOx") for _ in range(50_000))
    cost, audit, _ = cr.search(codes, cr.START, cr.ENDS)
    bounds = cr.lower_bounds(codes, cr.ENDS)
    assert cost == bounds[0][cr.START] and len(audit.replace("I", "")) == len(codes)


def test_repaired_rows_have_the_pattern(spark):
    rows = damage(made(3, 60))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    report, lines = cr.repair(df)
    found = {}
    for r in sorted(lines.collect(), key=lambda r: (r["conv"], r["place"], r["at"])):
        found.setdefault(r["conv"], []).append(r["role"][0])
    for r in report.collect():
        assert re.fullmatch("(s?(ua)+)?", "".join(found.get(r["conv"], []))), r
    assert report.count() == len({r[0] for r in rows})
