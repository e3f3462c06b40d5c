"""Token-id files compressed by Re-Pair grammars.

A file is a Parquet table of blocks in ascending order of documents. Each block holds some megabytes of text as one
grammar: rules that stand for a pair of symbols each, the lengths of their expansions, and the sequence of symbols.
No rule spans two documents, so any document is decoded alone from its symbols.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from riskflow.llm.common import Batches, map_batches, new_path, text_slices
from riskflow.llm.tokens import check_byte_level, encoder

# Rules start here; token ids are below.
FIRST_RULE = 1 << 20
# A pair becomes a rule from this many occurrences on. Each round replaces up to so many pairs, the frequent first.
MIN_COUNT = 16
RULES_PER_ROUND = 1 << 13
# Rounds over the whole sequence go on while each shortens it by this share; then only the frequent pairs' places are kept.
WHOLE_ROUND_GAIN = 0.1
_SLOTS = 18
_NO_RANK = np.int64(2**62)

BLOCK_SCHEMA = """shard int, block int, n_ids long, doc_ids array<long>, id_ends binary, symbol_ends binary,
    rules binary, rule_lengths binary, symbols binary"""


@dataclass
class Grammar:
    """rules: an array of pairs of symbols; lengths: ids in the expansion of each rule."""

    rules: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray

    def expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rules one after another, and where each rule's begin."""
        starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64) if len(self.lengths) else np.zeros(0, np.int64)
        flat = np.zeros(int(self.lengths.sum()), np.uint32)
        done = np.zeros(len(self.rules), bool)
        while not done.all():  # once for each round of the compression
            ready = ~done
            for side in (0, 1):
                inner = self.rules[:, side] >= FIRST_RULE
                ready &= ~inner | done[np.where(inner, self.rules[:, side] - FIRST_RULE, 0)]
            which = np.flatnonzero(ready)
            ids, ends = self._expand(self.rules[which].ravel(), flat, starts)
            size = self.lengths[which].astype(np.int64)
            begin = np.concatenate([[0], np.cumsum(size)[:-1]])
            flat[np.arange(len(ids)) + np.repeat(starts[which] - begin, size)] = ids
            done[which] = True
        return flat, starts

    def _expand(self, symbols: np.ndarray, flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rule = symbols >= FIRST_RULE
        size = np.ones(len(symbols), np.int64)
        size[rule] = self.lengths[symbols[rule] - FIRST_RULE]
        ends = np.cumsum(size)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
        begin = ends - size
        out[begin[~rule]] = symbols[~rule]
        of_rule, at = size[rule], begin[rule]
        within = np.arange(int(of_rule.sum())) - np.repeat(np.cumsum(of_rule) - of_rule, of_rule)
        out[np.repeat(at, of_rule) + within] = flat[np.repeat(starts[symbols[rule] - FIRST_RULE], of_rule) + within]
        return out, ends

    def decode(self, low: int = 0, high: int | None = None) -> np.ndarray:
        """The ids of the symbols from `low` to before `high`."""
        flat, starts = self.expansions()
        return self._expand(self.symbols[low:high], flat, starts)[0]


def compress(ids: np.ndarray, ends: np.ndarray) -> tuple[Grammar, np.ndarray]:
    """A grammar for the ids, and where each document ends among its symbols; documents end at `ends` among the ids.

    Each round counts all pairs and replaces those that occur MIN_COUNT times or more, at most RULES_PER_ROUND of them.
    Where two such pairs overlap, the more frequent one is replaced; what is left comes in later rounds. In the end no
    pair inside documents occurs MIN_COUNT times.
    """
    symbols = ids.astype(np.uint64)
    last = np.zeros(len(ids), bool)
    last[ends[ends > 0] - 1] = True
    last[-1:] = True
    rules, lengths = np.zeros((0, 2), np.uint32), np.zeros(0, np.uint32)
    while len(symbols) > 1:
        pairs = (symbols[:-1] << np.uint64(32)) | symbols[1:]
        pairs[last[:-1]] = 0xFFFFFFFFFFFFFFFF
        ordered = np.sort(pairs)
        edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))
        count, distinct = np.diff(edge), ordered[edge[:-1]]
        often = np.flatnonzero((count >= MIN_COUNT) & (distinct != 0xFFFFFFFFFFFFFFFF))
        if not len(often):
            break
        often = often[np.argsort(-count[often], kind="stable")[:RULES_PER_ROUND]]
        chosen = distinct[often]
        # A hash table without chains: of two pairs in a slot the more frequent is taken now, the other in a later round.
        slot = _slot(chosen)
        table, rank = np.full(1 << _SLOTS, 0xFFFFFFFFFFFFFFFE, np.uint64), np.zeros(1 << _SLOTS, np.int32)
        table[slot[::-1]], rank[slot[::-1]] = chosen[::-1], np.arange(len(chosen), dtype=np.int32)[::-1]
        slot = _slot(pairs)
        none = np.int32(len(chosen))
        ranks = np.where(table[slot] == pairs, rank[slot], none)
        best = ranks < none
        best[1:] &= ranks[1:] < ranks[:-1]
        best[:-1] &= ranks[:-1] <= ranks[1:]
        at = np.flatnonzero(best)
        used, new = ranks[at], np.zeros(len(chosen), np.int64)
        taken = np.flatnonzero(np.bincount(used, minlength=len(chosen)))
        new[taken] = np.arange(len(taken)) + len(rules)
        symbols[at] = (new[used] + FIRST_RULE).astype(np.uint64)
        last[at] = last[at + 1]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        before = len(symbols)
        symbols, last = symbols[keep], last[keep]
        rules, lengths = _with_rules(rules, lengths, chosen[taken])
        if len(symbols) > (1 - WHOLE_ROUND_GAIN) * before:
            symbols, last, rules, lengths = _replace_the_rest(symbols, last, rules, lengths)
            break
    return Grammar(rules, lengths, symbols.astype(np.uint32)), np.flatnonzero(last) + 1


def _slot(pairs: np.ndarray) -> np.ndarray:
    return ((pairs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOTS)).astype(np.int64)


def _with_rules(rules: np.ndarray, lengths: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rules and their lengths, with one more rule for each pair."""
    made = np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32)
    inner = made >= FIRST_RULE
    sizes = np.ones(made.shape, np.uint32)
    sizes[inner] = lengths[made[inner] - FIRST_RULE]
    return np.concatenate([rules, made]), np.concatenate([lengths, sizes.sum(axis=1, dtype=np.uint32)])


def _replace_the_rest(
    symbols: np.ndarray, last: np.ndarray, rules: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Go on until no pair occurs MIN_COUNT times, looking only at places of frequent pairs.

    Symbols form a linked list. A pair of known symbols never becomes more frequent, and every pair with a new symbol lies
    beside a place just replaced, so that counts over the kept and these places are exact. Of a run of equal symbols every
    other pair is replaced.
    """
    n = len(symbols)
    symbols, last = symbols.copy(), last.copy()
    after, before = np.arange(1, n + 2), np.arange(-1, n)  # n, as well as -1, stands for no place
    rank = np.full(n + 1, _NO_RANK)
    alive = np.ones(n, bool)
    pairs = (symbols[:-1] << np.uint64(32)) | symbols[1:]
    ordered = np.sort(pairs)
    edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))
    marked = np.zeros(1 << _SLOTS, bool)  # a first sieve: slots of frequent pairs
    marked[_slot(ordered[edge[:-1]][np.diff(edge) >= MIN_COUNT])] = True
    places = np.flatnonzero(marked[_slot(pairs)] & ~last[:-1])
    pairs = pairs[places]
    while len(places):
        order = np.argsort(pairs)
        ordered = pairs[order]
        edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))
        count, distinct = np.diff(edge), ordered[edge[:-1]]
        by_count = np.argsort(-count, kind="stable")
        of_pair = np.empty(len(count), np.int64)
        of_pair[by_count] = np.arange(len(count))
        chosen = distinct[by_count]
        ranks = np.empty(len(places), np.int64)
        ranks[order] = np.repeat(np.where(count >= MIN_COUNT, of_pair, _NO_RANK), count)
        often = np.flatnonzero(ranks < _NO_RANK)
        if not len(often):
            break
        places, pairs, ranks = places[often], pairs[often], ranks[often]
        # Of overlapping pairs the more frequent goes, of a run of one pair every other, from the first on.
        rank[places] = ranks
        lowest = (rank[before[places]] >= ranks) & (rank[after[places]] >= ranks)
        rank[places] = _NO_RANK
        goes_on = np.zeros(len(places), bool)
        goes_on[1:] = (before[places[1:]] == places[:-1]) & (ranks[1:] == ranks[:-1])
        index = np.arange(len(places))
        now = lowest & ((index - np.maximum.accumulate(np.where(goes_on, 0, index))) % 2 == 0)
        at, used = places[now], ranks[now]
        taken, rule = np.unique(used, return_inverse=True)
        symbols[at] = (rule + len(rules) + FIRST_RULE).astype(np.uint64)
        rules, lengths = _with_rules(rules, lengths, chosen[taken])
        gone = after[at]
        alive[gone] = False
        last[at] = last[gone]
        after[at] = after[gone]
        before[after[at]] = at
        # Places whose pair is still the same, and those beside a new symbol, in order.
        rest, old = places[~now], pairs[~now]
        still = alive[rest] & ~last[rest]
        rest, old = rest[still], old[still]
        rest = rest[(symbols[rest] << np.uint64(32)) | symbols[after[rest]] == old]
        beside = np.concatenate([at, before[at]])
        beside = beside[beside >= 0]
        places = np.unique(np.concatenate([rest, beside[~last[beside]]]))
        pairs = (symbols[places] << np.uint64(32)) | symbols[after[places]]
    return symbols[alive], last[alive], rules, lengths


def _write_blocks(vocabulary: str, end_id: int):
    def write(batches: Batches) -> Batches:
        shard, block = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in text_slices(batch, "_text"):
                ids, ends = encoder(vocabulary).encode(part.column("_text"))
                ends = ends[1:] + np.arange(1, len(ends))  # each document has one id more
                all_ids = np.full(len(ids) + len(ends), end_id, np.uint32)
                own = np.ones(len(all_ids), bool)
                own[ends - 1] = False
                all_ids[own] = ids
                grammar, symbol_ends = compress(all_ids, ends)
                row = {
                    "shard": shard, "block": block, "n_ids": len(all_ids), "doc_ids": part.column("doc_id").to_pylist(),
                    "id_ends": ends.astype(np.int64).tobytes(), "symbol_ends": symbol_ends.astype(np.int64).tobytes(),
                    "rules": grammar.rules.tobytes(), "rule_lengths": grammar.lengths.tobytes(), "symbols": grammar.symbols.tobytes(),
                }
                yield pa.RecordBatch.from_pylist([row], schema=_ARROW_BLOCK)
                block += 1

    return write


_ARROW_BLOCK = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64()))]
    + [(name, pa.binary()) for name in ("id_ends", "symbol_ends", "rules", "rule_lengths", "symbols")]
)


def write_ids(
    docs: DataFrame, path: str, vocabulary: str, end_id: int, id_column: str = "doc_id", text_column: str = "text"
) -> None:
    """Encode whole texts (null: empty), put `end_id` after each and write them in ascending order of ids as grammar blocks.

    The ids of documents are integers; null comes first and repeated rows stay, in the order of their texts.
    """
    check_byte_level(vocabulary)
    text = F.coalesce(F.col(text_column), F.lit("")).alias("_text")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text)
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("_text"))
    map_batches(ordered, _write_blocks(vocabulary, end_id), BLOCK_SCHEMA).write.parquet(path)


def _decoded(batches: Batches) -> Batches:
    for batch in batches:
        for row in batch.to_pylist():
            grammar = Grammar(
                np.frombuffer(row["rules"], np.uint32).reshape(-1, 2), np.frombuffer(row["rule_lengths"], np.uint32), np.frombuffer(row["symbols"], np.uint32)
            )
            ids = grammar.decode()
            ends = np.frombuffer(row["id_ends"], np.int64)
            starts = np.concatenate([[0], ends[:-1]])
            raw = memoryview(ids.astype("<u4").tobytes())
            crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            n = len(ends)
            columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(starts), pa.array(ends - starts), pa.array(crcs, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([row["shard"]] * n, pa.int32()), pa.array([row["block"]] * n, pa.int32())],
                names=["doc_id", "in_block", "n_tokens", "ids_crc32", "shard", "block"],
            )


def document_index(blocks: DataFrame) -> DataFrame:
    """From the blocks read back, one row per document: doc_id, start, n_tokens, ids_crc32 of its decoded ids."""
    # One row per block of some megabytes: the running sum over them is small.
    order = Window.orderBy("shard", "block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select("shard", "block", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("_before"))
    documents = map_batches(
        blocks, _decoded, "doc_id long, in_block long, n_tokens long, ids_crc32 long, shard int, block int"
    )
    return documents.join(before, ["shard", "block"]).select(
        "doc_id", (F.col("_before") + F.col("in_block")).alias("start"), "n_tokens", "ids_crc32"
    )


def encode_and_read_back(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """write_ids to a new file of the work folder, and document_index of it. An empty table gives no rows."""
    spark = docs.sparkSession
    path = new_path(spark, "token-ids")
    write_ids(docs, path, vocabulary, end_id)
    return document_index(spark.read.schema(BLOCK_SCHEMA).parquet(path))


