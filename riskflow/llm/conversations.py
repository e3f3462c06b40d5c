"""Repair of conversation structure at least cost, streaming over rows in order.

Rows are partitioned by conversation and sorted by turn within each partition; one pass then goes over them with the state
of a dynamic program, which is carried over the borders of Arrow batches. The program has four states (nothing yet, after
a system row, after a user row, after an assistant row). For each it keeps the least cost and the rank of the path that
is first in ASCII order, and per row four bytes of backpointers. The paths to different states never are one another's
beginning (each ends with a row's own edit and covers all rows), so that ranks decide ties for good.

Memory is bounded: after BLOCK_ROWS rows or BLOCK_BYTES of text of one conversation, hashes of the repaired texts are
moved on for each state, and the block's backpointers leave the task as a row of their own. Spilled blocks are written
with the results and read backwards in a second pass. In a conversation of more than GIANT_ROWS rows repeated rows are
found by an aggregation beforehand, not by a set in the task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from riskflow.llm.common import ship, stored

BLOCK_ROWS, BLOCK_BYTES = 16_384, 4_000_000
GIANT_ROWS = 200_000
EMITTED_ROWS = 2_000

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3
USER, ASSISTANT = "user", "assistant"
LEGAL = {"su", "ua", "au"}
_SPACE, _STOPS = " \t\n\x0b\x0c\r", ".!?"
# States: nothing yet, after s, after u, after a. What an insertion, or a changed role, leads to from each.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
GIVEN = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
KEPT = {("s", START): AFTER_S, **{("u", p): AFTER_U for p in (START, AFTER_S, AFTER_A)}, ("a", AFTER_U): AFTER_A}
KEPT |= {("", p): p for p in range(4)}  # an empty role has no initial
# Insertions that lead to a state in which a conversation may end.
CLOSING = (0, 2, 1, 0)
_EDITS = (DELETE, KEEP, REROLE)
_NO = 255

Config = tuple[tuple[int | None, ...], tuple[int, ...]]
FIRST: Config = ((0, None, None, None), (0, 0, 0, 0))


def inserted(state: int, count: int) -> int:
    for _ in range(count):
        state = GIVEN[state]
    return state


def advanced(config: Config, initial: str, deleted: bool, truncated: bool) -> tuple[Config, int, bytes]:
    """The program's state after one more row, the cost taken off all of its costs, and the row's backpointers.

    A pointer holds the state before, the number of insertions before the row (more than two never pay), and the edit.
    """
    costs, ranks = config
    best: list[tuple | None] = [None] * 4
    for p in range(4):
        if costs[p] is None:
            continue
        for k in range(3):
            at, cost = inserted(p, k), costs[p] + k * COSTS[INSERT]
            moves = [(DELETE, at, COSTS[DELETE])]
            if not deleted:
                more = TRUNCATED_COST if truncated else 0
                moves.append((REROLE, GIVEN[at], COSTS[REROLE] + more))
                if (initial, at) in KEPT:
                    moves.append((KEEP, KEPT[initial, at], COSTS[KEEP] + more))
            for edit, q, more in moves:
                found = (cost + more, ranks[p], INSERT * k + edit, p * 9 + k * 3 + _EDITS.index(edit))
                if best[q] is None or found < best[q]:
                    best[q] = found
    least = min(b[0] for b in best if b)
    order = sorted((q for q in range(4) if best[q]), key=lambda q: best[q][1:3])
    ranked = tuple(order.index(q) if best[q] else 0 for q in range(4))
    return (tuple(b and b[0] - least for b in best), ranked), least, bytes(b[3] if b else _NO for b in best)


def path(pointers: list[bytes] | bytes, state: int) -> tuple[list[str], int]:
    """The edits of a block's rows, each with the insertions before it, that lead to `state`; and the state before."""
    edits = []
    rows = pointers if isinstance(pointers, list) else [pointers[i : i + 4] for i in range(0, len(pointers), 4)]
    for row in reversed(rows):
        code = row[state]
        edits.append(INSERT * (code % 9 // 3) + _EDITS[code % 3])
        state = code // 9
    edits.reverse()
    return edits, state


def applied(edits: str, state: int, role: str, text: str) -> Iterator[tuple[str, str, str]]:
    """What becomes of one row: (edit, role, text) of the rows inserted before it and of itself."""
    for edit in edits:
        if edit == DELETE:
            continue
        if edit != KEEP:
            state = GIVEN[state]
        else:
            state = KEPT[role[:1], state]
        given = USER if state == AFTER_U else ASSISTANT
        yield (edit, role if edit == KEEP else given, "" if edit == INSERT else text)


def moved(edits: str, state: int, role: str) -> int:
    for edit in edits:
        if edit in (INSERT, REROLE):
            state = GIVEN[state]
        elif edit == KEEP:
            state = KEPT[role[:1], state]
    return state


class _Text:
    """Hash of rows `role:text`, joined by line feeds."""

    def __init__(self, begun: bool = False, digest=None) -> None:
        self.begun, self.digest = begun, digest or hashlib.sha256()

    def copy(self) -> _Text:
        return _Text(self.begun, self.digest.copy())

    def add(self, role: str, text: str) -> None:
        if self.begun:
            self.digest.update(b"\n")
        self.begun = True
        self.digest.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))


_steps: dict[tuple, tuple[Config, int, bytes]] = {}


class Conversation:
    """The state carried over the rows of one conversation."""

    def __init__(self, key: str) -> None:
        self.key, self.rows, self.block = key, 0, 0
        self.turns: tuple[int, int, int] | None = None  # smallest, greatest, distinct
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.initial: str | None = None
        self.before: tuple | None = None
        self.seen: set[bytes] = set()
        self.config = FIRST
        self.pointers: list[bytes] = []
        self.texts: list[tuple[str, str]] = []
        self.bytes = 0
        self.hashes: dict[int, _Text] = {START: _Text()}

    def add(self, turn: int | None, role: str, text: str, later: bool | None) -> dict | None:
        """One more row; `later` tells whether an equal row has an earlier turn, None that it is to be found here.
        Gives a spilled block if one is full."""
        if turn is not None:
            low, high, n = self.turns or (turn, turn, 0)
            self.turns = (low, turn, n + (n == 0 or turn != high))
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        seen = text.rstrip(_SPACE)
        blank = not seen
        duplicate = not blank and self._seen(turn, role, text, later)
        truncated = not blank and not duplicate and seen[-1] not in _STOPS
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        step = (self.config, initial if initial in ("s", "u", "a", "") else "?", blank or duplicate, truncated)
        if step not in _steps:
            _steps[step] = advanced(*step)
        self.config, cost, pointers = _steps[step]
        self.cost += cost
        self.pointers.append(pointers)
        self.texts.append((role, text))
        self.rows += 1
        self.bytes += len(text)
        if len(self.pointers) >= BLOCK_ROWS or self.bytes >= BLOCK_BYTES:
            return self._spilled()
        return None

    def _seen(self, turn: int | None, role: str, text: str, later: bool | None) -> bool:
        row, before = (turn, role, text), self.before
        self.before = row
        if later is not None:  # an equal row of the same turn is next to this one
            return later or row == before
        digest = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        if digest in self.seen:
            return True
        self.seen.add(digest)
        return False

    def _hashed(self, state: int) -> _Text:
        edits, origin = path(self.pointers, state)
        out = self.hashes[origin].copy()
        for edit, (role, text) in zip(edits, self.texts, strict=True):
            for _, r, t in applied(edit, origin, role, text):
                out.add(r, t)
            origin = moved(edit, origin, role)
        return out

    def _spilled(self) -> dict:
        self.hashes = {q: self._hashed(q) for q in range(4) if self.config[0][q] is not None}
        block = {"key": self.key, "block": self.block, "pointers": b"".join(self.pointers)}
        self.pointers, self.texts, self.bytes, self.block = [], [], 0, self.block + 1
        return block

    def end(self) -> list[dict]:
        """The result, after the last spilled block if there are any."""
        costs, ranks = self.config
        total, _, closing, state = min((c + CLOSING[q] * COSTS[INSERT], ranks[q], INSERT * CLOSING[q], q) for q, c in enumerate(costs) if c is not None)
        out = []
        if self.block and self.pointers:
            out.append(self._spilled())
        text = self.hashes[state].copy() if self.block else self._hashed(state)
        for _, role, content in applied(closing, state, "", ""):
            text.add(role, content)
        low, high, distinct = self.turns or (0, -1, 0)
        result = {
            "key": self.key, "n_rows": self.rows, "gaps": high - low + 1 - distinct, "blank": self.blank, "duplicate": self.duplicate,
            "truncated": self.truncated, "illegal": self.illegal, "cost": self.cost + total, "repaired_sha256": text.digest.hexdigest(),
            "audit": None if self.block else "".join(path(self.pointers, state)[0]) + closing, "state": state, "closing": closing,
        }
        return [*out, result | ({"spilled": self.block} if self.block else {})]


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_SCHEMA = f"key string, n_rows long, {', '.join(f'{c} long' for c in _COUNTS)}, audit string, repaired_sha256 string, spilled long, state int, closing string, block long, pointers binary"
_NAMES = [c.split()[0] for c in _SCHEMA.split(", ")]


def _frame(rows: list[dict], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame({n: pd.Series([r.get(n) for r in rows], dtype=object) for n in names})


def _repaired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    now: Conversation | None = None
    out: list[dict] = []
    for batch in batches:
        for key, turn, known, role, text, later in zip(*(batch[c] for c in ("_key", "turn", "known", "role", "text", "later")), strict=True):
            if now is None or key != now.key:
                if now is not None:
                    out += now.end()
                now = Conversation(key)
            block = now.add(int(turn) if known else None, role, text, None if later < 0 else bool(later))
            if block or len(out) >= EMITTED_ROWS:
                out += [block] if block else []
                yield _frame(out, _NAMES)
                out = []
    if now is not None:
        out += now.end()
    if out:
        yield _frame(out, _NAMES)


def _audits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of a conversation from the last to the first, its result before them: the edits of each block."""
    state = START
    for batch in batches:
        out = []
        for key, block, pointers, end, closing in zip(*(batch[c] for c in ("key", "block", "pointers", "state", "closing")), strict=True):
            if pointers is None:
                state = int(end)
                out.append({"key": key, "block": block, "edits": closing})
            else:
                edits, state = path(bytes(pointers), state)
                out.append({"key": key, "block": block, "edits": "".join(edits)})
        yield _frame(out, ["key", "block", "edits"])


def _key(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("k"), F.col(column).cast("string")), F.lit("null"))


def _filled(rows: DataFrame, id_column: str) -> DataFrame:
    blank = F.lit(" ")
    return rows.select(
        _key(id_column).alias("_key"), F.coalesce(F.col("turn").cast("long"), F.lit(0).cast("long")).alias("turn"), F.col("turn").isNotNull().alias("known"),
        F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
    )


def _in_order(rows: DataFrame) -> DataFrame:
    """By conversation, within it by turn (null first); equal turns by role and text."""
    return rows.repartition("_key").sortWithinPartitions("_key", "known", "turn", "role", "text")


def _with_later(rows: DataFrame) -> DataFrame:
    """Adds `later`: in giant conversations, 1 if an equal row has an earlier turn, else 0; -1 in all others."""
    giant = stored(rows.groupBy("_key").count().filter(F.col("count") > GIANT_ROWS).select("_key"), "giant")
    if giant.isEmpty():
        return rows.withColumn("later", F.lit(-1))
    usual = rows.join(giant, "_key", "left_anti").withColumn("later", F.lit(-1))
    large = rows.join(giant, "_key").withColumn("_sha", F.sha2(F.col("text").cast("binary"), 256))
    order = F.struct("known", "turn")
    first = large.filter("text rlike '[^\\\\x20\\\\x09-\\\\x0D]'").groupBy("_key", "role", "_sha").agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n"))
    marked = large.join(stored(first.filter("_n > 1").drop("_n"), "repeated"), ["_key", "role", "_sha"], "left")
    later = F.when(order > F.col("_first"), 1).otherwise(0)
    return usual.unionByName(marked.withColumn("later", later).select(*rows.columns, "later"))


def repair_report(rows: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """One row per conversation in `rows` (id_column, turn, role, text): the id, n_rows, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256.

    Rows go by turn, nulls first; those of equal turn by role and text. A null role or text is one space; rows with a
    null id are one conversation. `gaps` counts the whole turns missing between the smallest and the greatest; without
    any turn it is 0. The first fault of a row counts: blank (white space only), duplicate (its role and text have come
    before), truncated (does not end with one of .!?). `audit` holds the edits of the cheapest repair after which the
    roles' initials match (s?(ua)+)?, of equally cheap ones that first in ASCII order; an empty role has no
    initial and can be kept anywhere. Other columns are left out; an
    empty table gives none.
    """
    ship(rows.sparkSession)
    ordered = _in_order(_with_later(_filled(rows, id_column)))
    results = stored(ordered.mapInPandas(_repaired, _SCHEMA), "conversations")
    report = results.filter("block is null")
    if not report.filter("spilled is not null").isEmpty():
        ends = report.filter("spilled is not null").select("key", F.col("spilled").alias("block"), F.lit(None).cast("binary").alias("pointers"), "state", "closing")
        blocks = results.filter("block is not null").select("key", "block", "pointers", "state", "closing").unionByName(ends)
        backwards = blocks.repartition("key").sortWithinPartitions("key", F.col("block").desc())
        pieces = stored(backwards.mapInPandas(_audits, "key string, block long, edits string"), "audits")
        # An audit is one value, however long: it is put together here.
        whole = pieces.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("block", "edits"))).alias("_pieces"))
        whole = whole.select("key", F.array_join("_pieces.edits", "").alias("_audit"))
        report = report.join(whole, "key", "left").withColumn("audit", F.coalesce("audit", "_audit"))
    number = F.when(F.col("key") != "null", F.expr("substr(key, 2)")).cast(rows.schema[id_column].dataType)
    return report.select(number.alias(id_column), "n_rows", *_COUNTS, "audit", "repaired_sha256")


def _rewritten(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["key", "position", "edit", "role", "text"]
    key, audit, at, state, position = None, "", 0, START, 0

    def emitted(edits: str, role: str, text: str) -> list[dict]:
        nonlocal state, position
        found = [{"key": key, "position": position + i, "edit": e, "role": r, "text": t} for i, (e, r, t) in enumerate(applied(edits, state, role, text))]
        state, position = moved(edits, state, role), position + len(found)
        return found

    for batch in batches:
        out: list[dict] = []
        for new, role, text, edits in zip(*(batch[c] for c in ("_key", "role", "text", "audit")), strict=True):
            if edits is not None:  # the audit comes before the rows of its conversation
                out += emitted(audit[at:], "", "")
                key, audit, at, state, position = new, edits, 0, START, 0
                continue
            end = at
            while audit[end] == INSERT:
                end += 1
            out += emitted(audit[at : end + 1], role, text)
            at = end + 1
        yield _frame(out, names)
    yield _frame(emitted(audit[at:], "", ""), names)


def repaired_rows(rows: DataFrame, report: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """The rows after the repair that `report` (from repair_report) tells: id, position, edit, role, text."""
    ship(rows.sparkSession)
    body = _filled(rows, id_column).withColumn("audit", F.lit(None).cast("string")).withColumn("part", F.lit(1))
    audits = report.select(
        _key(id_column).alias("_key"), F.lit(0).cast("long").alias("turn"), F.lit(False).alias("known"), F.lit("").alias("role"), F.lit("").alias("text"), "audit", F.lit(0).alias("part")
    )
    ordered = body.unionByName(audits).repartition("_key").sortWithinPartitions("_key", "part", "known", "turn", "role", "text")
    out = ordered.mapInPandas(_rewritten, "key string, position long, edit string, role string, text string")
    number = F.when(F.col("key") != "null", F.expr("substr(key, 2)")).cast(rows.schema[id_column].dataType)
    return out.select(number.alias(id_column), "position", "edit", "role", "text")


def damaged(rows: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """`rows` (id_column, turn, role, text) with faults put in, chosen by the crc32 of `id:turn` modulo 20, nulls as one
    space: 0 drops the row, 1 empties its text, 2 takes away its .!?, 3 repeats it, 4 makes its role user."""
    blank = F.lit(" ")
    named = F.concat_ws(":", F.coalesce(F.col(id_column).cast("string"), blank), F.coalesce(F.col("turn").cast("string"), blank))
    code = (F.crc32(named.cast("binary")) % 20).alias("_code")
    filled = rows.select(id_column, "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), code).filter("_code <> 0")
    text = F.when(F.col("_code") == 1, "").when(F.col("_code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_code") == 4, USER).otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("_code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return filled.select(id_column, "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


def repair_of_damaged(rows: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """repair_report of damaged `rows`, with a row for every id in `rows`: one that lost all its rows has zeros."""
    report = repair_report(damaged(rows, id_column), id_column).withColumnRenamed(id_column, "_of")
    ids = rows.select(id_column).distinct()
    joined = ids.join(report, F.col(id_column).eqNullSafe(F.col("_of")), "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        id_column,
        *[F.coalesce(c, zero).alias(c) for c in _COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
