"""Benchmark decontamination with suffix arrays over shards of the documents.

The words of a shard (a few megabytes of documents) are numbered by the benchmark's vocabulary; all other words are 0,
which matches nothing. The shard's suffix array holds the suffixes that can match a window at all, that is, that start
with at least as many benchmark words as the shortest window has. Each suffix of each benchmark item is searched in it
by bisection; the range found holds every place of its window. Windows that follow each other in item and document are
one verbatim match of maximal length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskflow.llm.common import ALPHANUMERIC, Batches, PlainNames, map_batches, stored, text_bytes, text_slices, word_hashes, word_spans

WINDOW = 10
# A larger benchmark is searched in parts of so many words, one after another, so that what is sent out is bounded.
PART_WORDS = 2_000_000

MATCHES = "array<struct<item_id:string,item_word:int,doc_word:int,n_words:int>>"
_MATCH = pa.struct([("item_id", pa.string()), ("item_word", pa.int32()), ("doc_word", pa.int32()), ("n_words", pa.int32())])


@dataclass
class TestSuffixes:
    """All suffixes of some items that hold a window. codes: a row each, to the depth of the longest window."""

    vocabulary: np.ndarray  # sorted hashes; a word's code is its place in it plus 1
    items: list[list[str]]  # the ids of all items with the same words
    item: np.ndarray
    word: np.ndarray
    window: np.ndarray
    codes: np.ndarray


def test_suffixes(items: list[tuple[str, str]], window: int) -> TestSuffixes | None:
    data, ends = text_bytes(pa.array([text for _, text in items], pa.string()))
    starts, stops, first = word_spans(data, ends, ALPHANUMERIC)
    hashes = word_hashes(data, starts, stops, ALPHANUMERIC)
    # Items with the same words are searched once.
    same: dict[bytes, int] = {}
    ids: list[list[str]] = []
    kept = []
    for k, (name, _) in enumerate(items):
        words = hashes[first[k] : first[k + 1]].tobytes()
        if words and words not in same:
            same[words] = len(ids)
            ids.append([])
            kept.append(k)
        if words:
            ids[same[words]].append(name)
    hashes = np.concatenate([hashes[:0], *(hashes[first[k] : first[k + 1]] for k in kept)])
    first = np.concatenate([[0], np.cumsum([first[k + 1] - first[k] for k in kept], dtype=np.int64)]).astype(np.int64)
    ids = [sorted(set(names)) for names in ids]
    if not len(hashes):
        return None
    vocabulary = np.array(sorted(set(hashes.tolist())), np.uint64)
    codes = np.searchsorted(vocabulary, hashes) + 1
    sizes = np.diff(first)
    windows = np.minimum(sizes, window)
    item = np.repeat(np.arange(len(ids)), np.maximum(sizes - windows + 1, 0) * (sizes > 0))
    count = np.bincount(item, minlength=len(ids))
    word = np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
    depth = np.arange(int(windows.max()))
    at = (first[item] + word)[:, None] + depth
    rows = np.where(depth < windows[item][:, None], codes[np.minimum(at, len(codes) - 1)], 0)
    return TestSuffixes(vocabulary, ids, item, word, windows[item], rows.astype(np.int32))


def _keys(codes: np.ndarray, wide: bool) -> np.ndarray:
    """Rows of codes as byte strings that compare like the rows."""
    rows = np.ascontiguousarray(codes.astype(">u4" if wide else ">u2"))
    return rows.view(f"S{rows.shape[1] * rows.itemsize}").ravel()


class ShardSearch:
    """Searches all test suffixes in shards of documents."""

    def __init__(self, tests: TestSuffixes) -> None:
        self.tests = tests
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(tests.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
        self.shortest = int(tests.window.min())
        self.depth = tests.codes.shape[1]
        self.wide = len(tests.vocabulary) + 2 > 0xFFFF
        highest = 0xFFFFFFFF if self.wide else 0xFFFF
        self.low = _keys(tests.codes, self.wide)
        self.high = _keys(np.where(np.arange(self.depth) < tests.window[:, None], tests.codes, highest), self.wide)

    def find(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words of each text, and the matches as rows of (text, item, item_word, doc_word, n_words)."""
        data, ends = text_bytes(texts)
        starts, stops, first = word_spans(data, ends, ALPHANUMERIC)
        hashes = word_hashes(data, starts, stops, ALPHANUMERIC)
        codes = np.zeros(len(hashes) + self.depth, np.int64)
        some = np.flatnonzero(self.maybe[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.searchsorted(self.tests.vocabulary, hashes[some])
        codes[some] = np.where(self.tests.vocabulary[np.minimum(at, len(self.tests.vocabulary) - 1)] == hashes[some], at + 1, 0)
        places = np.arange(len(hashes))
        stop = np.where(codes[: len(hashes)] == 0, places, len(hashes))
        stop = np.minimum.accumulate(stop[::-1])[::-1] if len(stop) else stop
        stop = np.minimum(stop, np.repeat(first[1:], np.diff(first)))
        suffixes = np.flatnonzero(stop - places >= self.shortest)
        n_words = np.diff(first)
        if not len(suffixes):
            return n_words, np.zeros((0, 5), np.int64)
        depth = np.arange(self.depth)
        rows = codes[suffixes[:, None] + depth]
        rows[depth >= (stop[suffixes] - suffixes)[:, None]] = 0
        keys = _keys(rows, self.wide)
        order = np.argsort(keys, kind="stable")
        keys, suffixes = keys[order], suffixes[order]  # the suffix array of the shard
        low = np.searchsorted(keys, self.low, side="left")
        high = np.searchsorted(keys, self.high, side="right")
        size = np.maximum(high - low, 0)
        found = np.repeat(np.arange(len(size)), size)
        within = np.arange(len(found)) - np.repeat(np.cumsum(size) - size, size)
        place = suffixes[low[found] + within]
        doc = np.searchsorted(first, place, side="right") - 1
        item, word, window = self.tests.item[found], self.tests.word[found], self.tests.window[found]
        doc_word = place - first[doc]
        # Windows one word apart in both are one match.
        order = np.lexsort((word, doc_word - word, item, doc))
        doc, item, word, doc_word, window = doc[order], item[order], word[order], doc_word[order], window[order]
        goes_on = np.zeros(len(doc) + 1, bool)
        goes_on[1:-1] = (
            (doc[1:] == doc[:-1]) & (item[1:] == item[:-1]) & (doc_word[1:] - word[1:] == doc_word[:-1] - word[:-1]) & (word[1:] == word[:-1] + 1)
        )
        begin, end = np.flatnonzero(~goes_on[:-1]), np.flatnonzero(~goes_on[1:])
        return n_words, np.stack([doc[begin], item[begin], word[begin], doc_word[begin], end - begin + window[begin]], axis=1)


def _parts(benchmark: DataFrame, id_column: str, text_column: str, most: int) -> Iterator[list[tuple[str, str]]]:
    """The items, in runs of about `most` words: the driver holds one run at a time."""
    items = benchmark.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("i"), F.coalesce(F.col(text_column), F.lit("")).alias("t"))
    part, size = [], 0
    for row in items.toLocalIterator():
        part.append((row["i"], row["t"]))
        size += len(row["t"]) // 2 + 1
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def with_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    part_words: int = PART_WORDS,
) -> DataFrame:
    """`docs` with the columns n_words, matches (item_id, item_word, doc_word, n_words of each verbatim match) and item_ids.

    A match names the least id of the items with the same words; the column item_ids lists the ids of all items found.

    Words are runs of letters and digits after lower-casing A-Z, where every character beyond ASCII counts as a letter. A window is
    `window` words of an item, or all words of a shorter one. Null and empty texts, of either side, have no words. Items
    that repeat an id count as one; a null id counts as empty. Columns named n_words, matches or item_ids are replaced.
    """
    spark = docs.sparkSession
    base = docs.drop("n_words", "matches", "item_ids")
    none = {"matches": F.array().cast(MATCHES), "item_ids": F.array().cast("array<string>")}
    current = base.withColumns(none)
    parts = 0
    for items in _parts(benchmark, item_column, item_text_column, part_words):
        tests = test_suffixes(items, window)
        if tests is None:
            continue
        if parts:  # a large benchmark: one stored step for each part
            current = stored(current.drop("n_words"), "matches")
        shared = spark.sparkContext.broadcast(tests)  # PART_WORDS bounds it
        more = {"n_words": F.lit(0).cast("long"), "_matches": none["matches"], "_item_ids": none["item_ids"]}
        found = map_batches(current, _search(shared, text_column), current.withColumns(more).schema)
        merged = {"matches": F.concat("matches", "_matches"), "item_ids": F.array_distinct(F.concat("item_ids", "_item_ids"))}
        current = found.withColumns(merged).drop("_matches", "_item_ids")
        parts += 1
    if parts == 0:
        current = map_batches(base, _count(text_column), base.withColumn("n_words", F.lit(0).cast("long")).schema).withColumns(none)
    return current.select(*base.columns, "n_words", "matches", "item_ids")


def _lists(found: np.ndarray, rows: int, items: list[list[str]]) -> tuple[pa.Array, pa.Array]:
    """For each text its matches, and the ids of the items they are of. `found` is ordered by text."""
    edges = np.searchsorted(found[:, 0], np.arange(rows + 1)).astype(np.int32)
    first = pa.array([ids[0] for ids in items], pa.string())
    fields = [first.take(pa.array(found[:, 1])), *(pa.array(found[:, k].astype(np.int32)) for k in (2, 3, 4))]
    matches = pa.ListArray.from_arrays(pa.array(edges), pa.StructArray.from_arrays(fields, fields=list(_MATCH)))
    pairs = found[:, :2]
    pairs = pairs[np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(axis=1)])] if len(pairs) else pairs
    ids: list[list[str]] = [[] for _ in range(rows)]
    for text, item in pairs.tolist():
        ids[text] += items[item]
    return matches, pa.array(ids, pa.list_(pa.string()))


def _search(shared, text_column: str):
    def search(batches: Batches) -> Batches:
        finder = ShardSearch(shared.value)
        for batch in batches:
            for part in text_slices(batch, text_column):
                n_words, found = finder.find(part.column(text_column))
                matches, item_ids = _lists(found, part.num_rows, finder.tests.items)
                columns = [*part.columns, pa.array(n_words, pa.int64()), matches, item_ids]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "n_words", "_matches", "_item_ids"])

    return search


def _count(text_column: str):
    def count(batches: Batches) -> Batches:
        for batch in batches:
            for part in text_slices(batch, text_column):
                data, ends = text_bytes(part.column(text_column))
                n_words = np.diff(word_spans(data, ends, ALPHANUMERIC)[2])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n_words, pa.int64())], names=[*part.schema.names, "n_words"])

    return count


def hit_words(matches: Column) -> Column:
    """Words inside any match: the size of the union of its spans."""
    spans = F.sort_array(F.transform(matches, lambda m: F.struct(m["doc_word"].alias("a"), (m["doc_word"] + m["n_words"]).alias("b"))))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    total = F.aggregate(
        spans,
        start,
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["b"] - F.greatest(s["a"], acc["end"]))).alias("n"), F.greatest(acc["end"], s["b"]).alias("end")
        ),
        lambda acc: acc["n"].cast("long"),
    )
    return total


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, matches, item_ids."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    found = with_matches(rows, benchmark, window)
    items = F.sort_array(F.array_distinct("item_ids"))
    return found.select(
        "doc_id",
        "n_words",
        hit_words(F.col("matches")).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items).cast("binary"), 256).alias("items_sha256"),
        (F.size("matches") > 0).alias("contaminated"),
        "matches",
        "item_ids",
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_column: str = "text") -> DataFrame:
    """The rows of `docs` without any verbatim window of the benchmark, with their columns."""
    plain = PlainNames(docs)
    return plain.restored(with_matches(plain.df, benchmark, window, plain[text_column]).filter(F.size("matches") == 0))
