"""Conversation repair against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from riskflow.llm import conversations as C

VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
GOOD = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def brute_damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        shown = VISIBLE.findall(text)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def repairs(rows, found, most=2):
    """All repairs with at most `most` insertions at a place: (cost, audit, text)."""
    options = []
    for (_, _, role, text), fault in zip(rows, found):
        more = 3 if fault == "truncated" else 0
        row = [(4, "D", None)]
        if fault not in ("blank", "duplicate"):
            row += [(more, "K", (role, text))] + [(3 + more, "R", (r, text)) for r in ("user", "assistant")]
        options.append(row)
    inserts = [[]] + [list(t) for n in range(1, most + 1) for t in itertools.product(("user", "assistant"), repeat=n)]
    best = None

    def walk(i, cost, audit, lines):
        nonlocal best
        if best and cost > best[0]:
            return
        for before in inserts:
            c, a, l = cost + 3 * len(before), audit + "I" * len(before), lines + [(r, "") for r in before]
            if i == len(rows):
                if GOOD.fullmatch("".join(r[:1] for r, _ in l)) and (best is None or (c, a) < best[:2]):
                    best = (c, a, "\n".join(f"{r}:{t}" for r, t in l))
                continue
            for more, edit, line in options[i]:
                walk(i + 1, c + more, a + edit, l + ([line] if line else []))

    walk(0, 0, "", [])
    return best


def brute_row(conv, rows):
    found = faults(rows)
    turns = [t for _, t, _, _ in rows if t is not None]
    cost, audit, text = repairs(rows, found)
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts = [found.count(f) for f in ("blank", "duplicate", "truncated")]
    return (conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def made(rng, conv, size):
    return [
        (conv, rng.choice([None, i, i, i, i + 1, 2 * i]), rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None]),
         rng.choice(["", None, " \n", "Yes.", "Yes.", "No", "Ü!", "Why? ", f"text {i}.", f"text {i}.", f"text {i}"]))
        for i in range(size)
    ]


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    return sorted((brute_row(conv, brute_damaged(part)) for conv, part in groups.items()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = [r for conv in [None, *range(220)] for r in made(rng, conv, rng.choice([1, 2, 2, 3, 4]))]
    return out + [(1000, 1, "user", "A."), (1000, 1, "user", "A."), (1001, None, None, None), (1002, -5, "assistant", "B. "), (1002, 9**10, "user", "B.")]


@pytest.mark.parametrize("block, giant", [(16_384, 200_000), (1, 200_000), (2, 2), (16_384, 1)])
def test_against_brute_force(spark, rows, monkeypatch, block, giant):
    # Blocks of one or two rows are spilled; with small giants, repeated rows are found beforehand.
    monkeypatch.setattr(C, "BLOCK_ROWS", block)
    monkeypatch.setattr(C, "GIANT_ROWS", giant)
    monkeypatch.setattr(C, "_repaired", _with_block(block))
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA + ", key string, block int")
    got = C.repair_of_damaged(docs).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows)


def _with_block(size):
    """_repaired with a block size of its own in the Python worker."""
    original = C._repaired

    def repaired(batches):
        from riskflow.llm import conversations

        conversations.BLOCK_ROWS = size
        return original(batches)

    return repaired


def test_repaired_rows_have_the_reported_hash(spark, rows):
    docs = C.damaged(spark.createDataFrame(rows, SCHEMA))
    report = C.repair_report(docs)
    lines, edits = {}, {}
    for r in sorted(C.repaired_rows(docs, report).collect(), key=lambda r: r["position"]):
        lines.setdefault(r["conv_id"], []).append((r["position"], f"{r['role']}:{r['text']}"))
        edits[r["conv_id"]] = edits.get(r["conv_id"], "") + r["edit"]
    for r in report.collect():
        found = lines.get(r["conv_id"], [])
        assert [p for p, _ in found] == list(range(len(found)))
        assert hashlib.sha256("\n".join(t for _, t in found).encode()).hexdigest() == r["repaired_sha256"]
        assert edits.get(r["conv_id"], "") == r["audit"].replace("D", "")


def test_state_is_carried_over_batches(spark):
    n = 40_000
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"{i}.") for i in range(n)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        got = C.repair_report(spark.createDataFrame(rows, SCHEMA)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    text = "\n".join(f"{r}:{t}" for _, _, r, t in rows)
    assert [tuple(r) for r in got] == [(1, n, 0, 0, 0, 0, 0, 0, "K" * n, hashlib.sha256(text.encode()).hexdigest())]


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.repair_of_damaged(empty).count() == 0 and C.repaired_rows(empty, C.repair_report(empty)).count() == 0
