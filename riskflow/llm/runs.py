"""Periodic runs in the words of a text, by online dyadic square catching.

A run of period q is a stretch of words that repeats with smallest period q and that no neighbouring word continues.
Words are appended to a stream. For each power of two L a catcher stands on every completed block of L words that begins
at a multiple of L / 2. Each appended word completes one suffix of L words per level, which is compared with the one
catcher it lies between L / 2 + 1 and L words behind: hashes of blocks are made from those of their halves, so that this
is one step per word and level. A hit is a square; squares of neighbouring catchers with equal distance are one. Squares
are then merged into runs by going on, word by word, as far as the distance holds.

A run of period q that is four periods long holds, at the level with L / 2 < q <= L, a catcher that finds its block again
first at distance q; larger multiples caught at other levels lead to the same stretch, and the smallest period counts.
Words are compared by exact codes, hashes only choose where to look. Many words are appended at a time, as arrays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskflow.llm.common import NOT_SPACE, Batches, PlainNames, map_batches, mix, text_bytes, text_slices, word_spans

LEAST_WORDS = 6
LEAST_PERIODS = 4
# Words that are appended at a time: bounds the arrays of one step, not the result.
APPENDED = 1 << 20
# Steps in which all squares are extended together; those that hold longer go on alone, in doubling steps.
COMMON_STEPS = 48
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
NEW_COLUMNS = ["n_words", "runs", "collapsed"]


class _Level:
    def __init__(self, size: int) -> None:
        self.size, self.half = size, size // 2
        self.step = max(self.half, 1)
        self.base, self.kept = 0, np.zeros(0, np.uint64)  # hashes of the last blocks; the first begins at `base`
        self.last = (-1, -1)  # the last catcher that was hit, and its distance

    def next(self) -> int:
        return self.base + len(self.kept)


class Catchers:
    """Catches squares in a stream of word codes. Periods up to `longest` / LEAST_PERIODS are looked for."""

    def __init__(self, longest: int) -> None:
        self.levels, size = [], 1
        while True:
            self.levels.append(_Level(size))
            if size >= longest // LEAST_PERIODS:
                break
            size *= 2
        self.words = 0
        self.squares: list[tuple[np.ndarray, np.ndarray]] = []

    def append(self, codes: np.ndarray) -> None:
        self.words += len(codes)
        below: _Level | None = None
        for level in self.levels:
            first, end = level.next(), self.words - level.size + 1  # blocks that are complete now
            if below is None:
                new = mix(codes.astype(np.uint64) + np.uint64(1))
            elif end > first:
                at = first - below.base
                left = below.kept[at : at + end - first]
                right = below.kept[at + level.half : at + level.half + end - first]
                new = mix(left * _FACTOR + right)
            else:
                break  # nor is any larger block complete
            level.kept = np.concatenate([level.kept, new])
            self._compare(level, first, end)
            if below is not None:
                self._forget(below)
            below = level
        if below is self.levels[-1]:
            self._forget(below)

    def _forget(self, level: _Level) -> None:
        # Later suffixes look back by `size` at most, and so do the blocks of the next level.
        old = max(level.next() - level.size, level.base)
        level.kept = level.kept[old - level.base :].copy()
        level.base = old

    def _compare(self, level: _Level, first: int, end: int) -> None:
        suffix = np.arange(max(first, level.half + 1), end)
        if not len(suffix):
            return
        catcher = (suffix - level.half - 1) // level.step * level.step
        hit = level.kept[suffix - level.base] == level.kept[catcher - level.base]
        suffix, catcher = suffix[hit], catcher[hit]
        if not len(suffix):
            return
        # A catcher reports its first hit only: later ones are farther off.
        new = np.diff(catcher, prepend=level.last[0]) != 0
        suffix, catcher = suffix[new], catcher[new]
        if not len(suffix):
            return
        distance = suffix - catcher
        before, apart = np.concatenate([[level.last[0]], catcher[:-1]]), np.concatenate([[level.last[1]], distance[:-1]])
        alone = (catcher - before != level.step) | (distance != apart)
        level.last = (int(catcher[-1]), int(distance[-1]))
        self.squares.append((catcher[alone], distance[alone]))

    def runs(self, codes: np.ndarray) -> np.ndarray:
        """Rows (begin, end, period) of all runs in `codes`, the whole stream, whose first and last words are unique."""
        if not self.squares:
            return np.zeros((0, 3), np.int64)
        at, period = (np.concatenate(x) for x in zip(*self.squares, strict=True))
        right, left = _extended(codes, at, period, 1), _extended(codes, at - 1, period, -1)
        begin, end = at - left, at + right + period
        long = (end - begin >= LEAST_PERIODS * period) & (end - begin >= LEAST_WORDS)
        found = np.stack([begin[long], end[long], period[long]], axis=1)
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        same = (found[1:, :2] == found[:-1, :2]).all(axis=1)
        return found[np.concatenate([[True], ~same])] if len(found) else found


def _extended(codes: np.ndarray, at: np.ndarray, period: np.ndarray, way: int) -> np.ndarray:
    """How many words from `at` on (way 1) or back (way -1) equal the word one period later."""
    last, held = len(codes) - 1, np.zeros(len(at), np.int64)
    going = np.arange(len(at))
    for _ in range(COMMON_STEPS):
        x = at[going] + way * held[going]
        going = going[codes[x] == codes[np.minimum(x + period[going], last)]]
        if not len(going):
            return held
        held[going] += 1
    for g in going.tolist():
        a, p, n, size = int(at[g]), int(period[g]), int(held[g]), COMMON_STEPS
        while True:
            if way > 0:
                low = a + n
                high = min(low + size, last + 1 - p)
                differ = codes[low:high] != codes[low + p : high + p]
            else:
                high = a - n + 1
                low = max(high - size, 0)
                differ = (codes[low:high] != codes[low + p : high + p])[::-1]
            stop = int(differ.argmax()) if differ.any() else -1
            n += stop if stop >= 0 else len(differ)
            if stop >= 0 or not len(differ):
                break
            size *= 2
        held[g] = n
    return held


def runs_of(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs (begin, end, period) of each text, with the text's number: `codes` of all words, text i from first[i] on.

    Texts with the same number of levels are one stream, with a word of its own between them.
    """
    counts = np.diff(first)
    classes = np.where(counts >= LEAST_WORDS, np.ceil(np.log2(np.maximum(counts // LEAST_PERIODS, 1))).astype(np.int64), -1)
    rows, texts = [np.zeros((0, 3), np.int64)], [np.zeros(0, np.int64)]
    for c in np.unique(classes[classes >= 0]).tolist():
        chosen = np.flatnonzero(classes == c)
        n = counts[chosen]
        begin = np.cumsum(n + 1) - n  # in the stream, which begins with a separator
        stream = np.empty(int(n.sum()) + len(n) + 1, np.int64)
        separators = np.concatenate([begin - 1, [len(stream) - 1]])
        stream[separators] = -1 - np.arange(len(separators))
        inside = np.arange(int(n.sum())) + np.repeat(begin - (np.cumsum(n) - n), n)
        stream[inside] = codes[np.arange(int(n.sum())) + np.repeat(first[chosen] - (np.cumsum(n) - n), n)]
        catchers = Catchers(int(n.max()))
        for low in range(0, len(stream), APPENDED):
            catchers.append(stream[low : low + APPENDED])
        found = catchers.runs(stream)
        text = np.searchsorted(begin, found[:, 0], side="right") - 1
        found[:, :2] -= begin[text][:, None]
        rows.append(found)
        texts.append(chosen[text])
    found, text = np.concatenate(rows), np.concatenate(texts)
    order = np.lexsort((found[:, 2], found[:, 0], text))
    return found[order], text[order]


def _codes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words' bytes without what is between them, and a number for each word: the same for identical words."""
    packed = data[NOT_SPACE[data]] if len(data) else data
    offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(packed))])
    return packed, words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _joined(packed: np.ndarray, lengths: np.ndarray, kept: np.ndarray, first: np.ndarray) -> pa.StringArray:
    """For each text its kept words, joined by one space."""
    n = lengths[kept]
    ends = np.cumsum(n + 1)  # of each kept word and a space in the buffer of all
    out = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
    if len(ends):
        out[np.arange(int(n.sum())) + np.repeat(np.arange(len(n)), n)] = packed[np.repeat(kept, lengths)]
        borders = np.concatenate([[0], np.cumsum(kept)])[first]  # kept words before each text
        closing = borders[1:][np.diff(borders) > 0] - 1  # the last word of each text has no space behind it
        full = np.ones(len(out), bool)
        full[ends[closing] - 1] = False
        out = out[full]
        spaces = np.concatenate([[0], np.cumsum(n + 1)])[borders] - np.concatenate([[0], np.cumsum(np.diff(borders) > 0)])
        offsets = spaces.astype(np.int32)
    else:
        offsets = np.zeros(len(first), np.int32)
    return pa.StringArray.from_buffers(len(first) - 1, pa.py_buffer(offsets), pa.py_buffer(out))


def _texts_runs(column: pa.Array) -> list[pa.Array]:
    data, text_ends = text_bytes(column)
    starts, stops, first = word_spans(data, text_ends, NOT_SPACE)
    packed, codes = _codes(data, starts, stops)
    found, text = runs_of(codes, first)
    lengths = found[:, 1] - found[:, 0]
    edges = np.zeros(len(codes) + 1, np.int64)  # what follows a run's first period is dropped
    np.add.at(edges, first[text] + found[:, 0] + found[:, 2], 1)
    np.add.at(edges, first[text] + found[:, 1], -1)
    kept = np.cumsum(edges[:-1]) == 0
    struct = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (found[:, 0], lengths, found[:, 2])], names=["start", "length", "period"])
    offsets = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(column)))]).astype(np.int32)
    return [pa.array(np.diff(first), pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), struct), _joined(packed, stops - starts, kept, first)]


def _described(text_column: str):
    def describe(batches: Batches) -> Batches:
        for batch in batches:
            for part in text_slices(batch, text_column):
                columns = [*part.columns, *_texts_runs(part.column(text_column))]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, *NEW_COLUMNS])

    return describe


def find_runs(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """`docs` with n_words, runs and collapsed; columns of these names are replaced.

    Words are [^\\x20\\x09-\\x0D]+, numbered from 0, and compared as they are. `runs` are (start, length, period) of at
    least LEAST_WORDS words and LEAST_PERIODS periods, by start, then period. `collapsed` holds the words that no run
    contains after its first period, joined by one space. A null or empty text has no words, no runs and an empty
    `collapsed`. Each row is on its own, so repeated rows and ids give repeated results; an empty table gives none. No
    shuffle; a text is held whole by one task, with some 60 bytes a word besides.
    """
    plain = PlainNames(docs.drop(*NEW_COLUMNS))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.df.schema.fields)
    schema = f"{kinds}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return plain.restored(map_batches(plain.df, _described(plain[text_column]), schema), *NEW_COLUMNS)


def planted(number: str, words: str) -> str:
    """SQL for the words with a repetition put in: where the crc32 of `number` is divisible by 10, the words from
    crc32 div 10 modulo their number on are repeated with a period of 1 + the rest's length div (3 + (crc32 div 10) % 8)."""
    n, h = f"cast(size({words}) as long)", f"coalesce(crc32(cast(cast({number} as string) as binary)), 1L)"
    g = f"({h} div 10)"
    return f"""if({h} % 10 = 0 and size({words}) > 0,
      transform(array(struct({words} as w, {g} % greatest({n}, 1L) as a, 3 + {g} % 8 as k)),
        v -> transform(array(1 + (size(v.w) - v.a) div v.k),
          p -> transform(sequence(0L, greatest(size(v.w) - 1L, 0L)), i -> get(v.w, cast(if(i < v.a, i, v.a + (i - v.a) % p) as int))))[0])[0],
      {words})"""


def with_planted_repetition(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`docs` with a repetition put into about every tenth text, chosen by its id. Other texts, and those of null ids, stay.

    A changed text has its words joined by one space.
    """
    h = F.crc32(F.col(id_column).cast("string").cast("binary"))
    words = f"filter(split(`{text_column}`, '[\\\\x20\\\\x09-\\\\x0D]+'), x -> x <> '')"
    # The words are bound to a variable, so that they are made once for a row.
    changed = F.expr(f"array_join(transform(array({words}), s -> {planted(f'`{id_column}`', 's')})[0], ' ')")
    return docs.withColumn(text_column, F.when(F.coalesce(h % 10 == 0, F.lit(False)), changed).otherwise(F.col(text_column)))


def digests(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Of rows from `find_runs`: the number of runs, the run with most periods, and hashes of all runs and of the rest."""
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    # Runs come by start, then period: a later one wins by more periods only.
    best = F.expr("aggregate(runs, get(runs, 0), (b, r) -> if(r.length * b.period > b.length * r.period, r, b))")
    rows = found.select(id_column, F.size("runs").cast("long").alias("n_runs"), best.alias("_best"), listed.alias("_listed"), "collapsed")
    return rows.select(
        id_column,
        "n_runs",
        *[F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(F.col("_listed").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
