"""Packing documents into sequences of a fixed length.

A document is cut into full windows and one remainder. Full windows are sequences of their own. For the remainders the
histogram of lengths is all that has to be known at one place: combinations of two or three lengths that fill a window
are enumerated, non-negative least squares finds how often to repeat each, repeats are rounded down to what the
histogram holds, and lengths that are left are packed greedily, longest first with the best fitting partners. Lengths
that find no partners to fill a window are laid end to end and cut where a window ends, so that whatever the histogram
is, a sequence but the last has less than 0.4 % of padding. The plan says for each length which of its pieces, by number,
go where; its size depends on the window, not on the input.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from riskflow.llm.common import Batches, map_batches, stored, text_slices
from riskflow.llm.tokens import check_byte_level, encoder, vocabulary_size

# Of a combination of three lengths one at least is a multiple of this.
GRID = 128
# A sequence may stay short of the window by this part of it.
SPARE = 256
ITERATIONS = 300

# ids are kept of remainders only, as these may be cut once more.
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, nth long, ids binary"
_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth", "ids"]
# Where a plan's row has this in place of a sequence, its pieces follow each other on the line that is cut.
LINE = -1


def combinations(window: int, grid: int = GRID) -> np.ndarray:
    """Rows of two or three lengths that sum to `window`, in descending order; 0 stands for no third length."""
    lengths = np.arange(1, window)
    pairs = [np.sort([lengths, window - lengths], axis=0)[::-1].T]
    out = [np.concatenate([pairs[0], np.zeros((len(pairs[0]), 1), np.int64)], axis=1)]
    for c in range(grid, window - 1, grid):
        a = np.arange(1, window - c)
        out.append(np.sort(np.stack([a, window - c - a, np.full(len(a), c)], axis=1), axis=1)[:, ::-1])
    rows = np.concatenate(out)
    keys = np.sort((rows[:, 0] * window + rows[:, 1]) * window + rows[:, 2])
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    return np.stack([keys // (window * window), keys // window % window, keys % window], axis=1)


def solve(combos: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Repeats x >= 0 of the combinations that minimise the squared distance of the used lengths to the histogram.

    Accelerated projected gradient steps; each costs as much as there are combinations.
    """

    def used(x: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(combos[:, i], weights=x, minlength=len(histogram)) for i in range(3))
        out[0] = 0
        return out

    def gradient(x: np.ndarray) -> np.ndarray:
        rest = used(x) - histogram
        rest[0] = 0
        return rest[combos].sum(axis=1)

    # The greatest eigenvalue, by power iteration.
    v = np.ones(len(combos))
    for _ in range(30):
        u = used(v)
        v = u[combos].sum(axis=1)
        norm = np.linalg.norm(v)
        v /= norm
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(ITERATIONS):
        new = np.maximum(0, y - gradient(y) / norm)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(histogram: np.ndarray, window: int) -> tuple[np.ndarray, int]:
    """From the number of remainders of each length: rows of (length, first nth, repeats, first sequence, offset), sorted
    by length and nth, and the number of sequences before those cut from the line. Pieces nth, nth + 1, ... go to
    consecutive sequences. In rows with LINE for the first sequence the offset is that of the first piece on the line."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    taken = np.zeros(len(left), np.int64)
    rows, sequences = [], 0

    def place(lengths: list[int], repeats: int) -> None:
        nonlocal sequences
        offset = 0
        for length in lengths:
            rows.append((length, int(taken[length]), repeats, sequences, offset))
            taken[length] += repeats
            left[length] -= repeats
            offset += length
        sequences += repeats

    if left.sum():
        combos = combinations(window)
        x = solve(combos, left.astype(float))
        for k in np.argsort(-x, kind="stable"):
            if x[k] < 1:
                break
            lengths = [int(a) for a in combos[k] if a]
            need = Counter(lengths)
            repeats = min(int(x[k] + 1e-6), *(int(left[a]) // n for a, n in need.items()))
            if repeats > 0:
                place(lengths, repeats)
    # The rest: the longest piece and then, again and again, the longest one that still fits; what fills no window so
    # goes to the line.
    top, on_line = window - 1, 0
    while True:
        while top > 0 and not left[top]:
            top -= 1
        if top == 0:
            break
        lengths, room, counts = [], window, left.copy()
        best = top
        while best > 0:
            lengths.append(best)
            counts[best] -= 1
            room -= best
            fits = np.flatnonzero(counts[1 : room + 1])
            best = int(fits[-1]) + 1 if len(fits) else 0
        if room > window // SPARE:
            repeats = int(left[top])
            rows.append((top, int(taken[top]), repeats, LINE, on_line))
            on_line += repeats * top
            left[top] = 0
            continue
        need = Counter(lengths)
        place(lengths, min(int(left[a]) // n for a, n in need.items()))
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return table, sequences


def _cut(vocabulary: str, end_id: int, window: int, stored_type: str):
    def cut(batches: Batches) -> Batches:
        part, seen = TaskContext.get().partitionId(), np.zeros(window + 1, np.int64)
        for batch in batches:
            for rows in text_slices(batch, "_text"):
                ids, ends = encoder(vocabulary).encode(rows.column("_text"))
                n = np.diff(ends) + 1
                doc_ends = np.cumsum(n)
                all_ids = np.full(int(doc_ends[-1]), end_id, np.uint32)
                own = np.ones(len(all_ids), bool)
                own[doc_ends - 1] = False
                all_ids[own] = ids
                pieces = -(-n // window)
                doc = np.repeat(np.arange(len(n)), pieces)
                nth_of_doc = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = nth_of_doc * window
                length = np.minimum(window, n[doc] - start)
                raw = memoryview(all_ids.astype("<u4").tobytes())
                begin = (doc_ends - n)[doc] + start
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
                # The number of each piece among this task's pieces of its length.
                order = np.argsort(length, kind="stable")
                ordered = length[order]
                run = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
                sizes = np.diff(np.concatenate([run, [len(ordered)]]))
                nth = np.empty(len(length), np.int64)
                nth[order] = np.arange(len(ordered)) - np.repeat(run, sizes) + seen[ordered]
                seen[ordered[run]] += sizes
                rest = length < window
                kept = all_ids[np.repeat(rest, length)].astype(stored_type)
                bounds = np.concatenate([[0], np.cumsum(np.where(rest, length, 0))]) * kept.itemsize
                kept = pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(kept.tobytes())])
                columns = [rows.column("doc_id").take(pa.array(doc)), start, length, crcs, n[doc], np.full(len(doc), part, np.int32), nth]
                columns.append(kept)
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=_NAMES)

    return cut


def pack(
    docs: DataFrame, vocabulary: str, end_id: int, window: int = 2048, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are documents of the end id alone. Repeated rows and null ids are packed like any other row.
    A sequence holds at most `window` ids; what is missing to `window` is padding. An empty table gives no rows.
    """
    check_byte_level(vocabulary)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
    stored_type = "<u2" if max(vocabulary_size(vocabulary), end_id + 1) <= 1 << 16 else "<u4"
    pieces = stored(map_batches(rows, _cut(vocabulary, end_id, window, stored_type), _PIECES), "pieces")
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "lengths")

    # At most `window` rows come to the driver.
    histogram = np.zeros(window + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).toLocalIterator():
        histogram[row["length"]] = row["n"]
    table, sequences = plan(histogram[:window], window)
    line_sequences = -(-sum(int(n) * int(k) for n, _, k, at, _ in table if at == LINE) // window)
    # A search key over (length, nth); the last slot of a length ends where its pieces end.
    lengths, firsts, first_sequence, offsets = table[:, 0], table[:, 1], table[:, 3], table[:, 4]
    bounds = np.searchsorted(lengths, np.arange(window + 1))

    def assign(batches: Batches) -> Batches:
        for batch in batches:
            length, nth = (batch.column(c).to_numpy() for c in ("length", "nth"))
            sequence, offset = nth.copy(), np.zeros(len(nth), np.int64)
            line = np.full(len(nth), -1)
            for value in np.flatnonzero(np.bincount(length, minlength=1)):
                if value < window:
                    here = np.flatnonzero(length == value)
                    low, high = bounds[value], bounds[value + 1]
                    slot = low + np.searchsorted(firsts[low:high], nth[here], side="right") - 1
                    later = nth[here] - firsts[slot]
                    sequence[here], offset[here] = first_sequence[slot] + later, offsets[slot]
                    cut = first_sequence[slot] == LINE
                    line[here[cut]] = (offsets[slot] + later * value)[cut]
            laid = line >= 0
            sequence[laid], offset[laid] = sequences + line[laid] // window, line[laid] % window
            # Full windows come after all others.
            sequence[length == window] += sequences + line_sequences
            head = np.where(laid, np.minimum(length, window - offset), length)
            crcs = batch.column("ids_crc32").to_numpy().copy()
            split = np.flatnonzero(head < length)
            tails = np.zeros(len(split), np.int64)
            for i, (row, at) in enumerate(zip(split.tolist(), head[split].tolist(), strict=True)):
                ids = np.frombuffer(batch.column("ids")[row].as_buffer(), stored_type).astype("<u4")
                crcs[row], tails[i] = zlib.crc32(ids[:at].tobytes()), zlib.crc32(ids[at:].tobytes())
            both = np.concatenate([np.arange(len(nth)), split])
            start, doc_tokens = (batch.column(c).to_numpy() for c in ("start", "doc_tokens"))
            columns = [
                batch.column("doc_id").take(pa.array(both)),
                np.concatenate([start, start[split] + head[split]]),
                np.concatenate([head, (length - head)[split]]),
                np.concatenate([crcs, tails]),
                doc_tokens[both],
                np.concatenate([sequence, sequence[split] + 1]),
                np.concatenate([offset, np.zeros(len(split), np.int64)]),
            ]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)

    numbered = pieces.join(counts.select("length", "part", "before"), ["length", "part"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("nth") + F.col("before")).alias("nth"), "ids"
    )
    out = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return map_batches(numbered, assign, out)
