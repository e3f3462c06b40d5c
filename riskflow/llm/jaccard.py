"""Near-duplicate classes by an exact Jaccard join of word n-gram sets.

Tiles. Sizes are cut into bands, and a pair belongs to the band of its smaller set. Sets of a band (and the slightly
larger ones that may be partners) are cut by hash into so many segments that a pair as similar as asked for must agree
in some segment that is not empty. A tile is one band, segment and segment content; only sets of a tile are compared.
Comparison. Hashed bitmaps bound the overlap from above by bit counts: pairs are joined with sizes and bitmaps first, and
the sorted arrays are moved and intersected only for those that may still be similar enough.
Classes. Equal sets are one node. In a first round each node is compared with the most central member of its tiles
only, and links are contracted. Tiles whose members are one class by then are done. Of the others, small ones give
their pairs between different classes. Members of large ones, which share a long passage, are left out if too many of
their shingles are theirs alone; the rest meet again in tiles of their rarest shingles, in the same two steps. Only what
is large and open even then is compared in blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from riskflow.llm.common import NOT_SPACE, Batches, PlainNames, map_batches, mix, ship, stored, text_bytes, text_slices, word_hashes, word_spans
from riskflow.llm.components import components
from riskflow.llm.exact_dedup import filter_of, with_repeated

BAND_RATIO = 1.5
# Segments beyond the greatest number that can differ.
SPARE_SEGMENTS = 4
# Bits of a set's bitmap: at least so many for each element, so that bit counts mean as much for large sets.
BITS_PER_ELEMENT = 2
# Members of a tile up to which its open pairs are listed; beyond, blocks of so many sets are compared.
BLOCK = 32
# Shingles of members of large tiles that are counted first, as a multiple of those that a partner may lack.
COUNTED_FIRST = 2

_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


class Bands:
    """Size bands for a similarity of `percent` in 100."""

    def __init__(self, percent: int, largest: int) -> None:
        self.percent = percent
        self.lows = [1]
        while self.lows[-1] <= largest:
            self.lows.append(max(self.lows[-1] + 1, int(self.lows[-1] * BAND_RATIO)))

    def differing(self, band: int) -> int:
        """The most elements in which two similar enough sets of the band's tiles can differ."""
        small = self.lows[band + 1] - 1
        large = small * 100 // self.percent
        return (small + large) * (100 - self.percent) // (100 + self.percent)

    def of(self, size: int) -> list[int]:
        """The bands in whose tiles a set of this size takes part: its own and those of smaller partners."""
        home = int(np.searchsorted(self.lows, size, side="right")) - 1
        least = -(-size * self.percent // 100)  # the smallest partner
        return [b for b in range(home, -1, -1) if least <= self.lows[b + 1] - 1]


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of each text (of fewer words: the whole sequence), and where each text's begin."""
    sizes = np.diff(first)
    counts = np.where(sizes >= width, sizes - width + 1, np.minimum(sizes, 1))
    starts = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(starts[-1]) + np.repeat(first[:-1] - starts[:-1], counts)
    length = np.repeat(np.minimum(sizes, width), counts)
    total = length.astype(np.uint64)
    for i in range(width):
        word = words[np.minimum(at + i, max(len(words) - 1, 0))] if len(words) else words
        # Each place has a multiplier of its own; a missing word adds nothing.
        total = mix(total + np.where(i < length, word * _MULTIPLIERS[i % 3] + np.uint64(i), np.uint64(0)))
    return total, starts


def _sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, ends = text_bytes(texts)
    starts, stops, first = word_spans(data, ends, NOT_SPACE)
    hashes, begin = shingle_hashes(word_hashes(data, starts, stops, NOT_SPACE), first, width)
    out = []
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        s = np.sort(hashes[a:b])
        if len(s) > 1:
            new = s[1:] != s[:-1]
            if not new.all():
                s = s[np.concatenate([[True], new])]
        out.append(s)
    return out


def _tiles(s: np.ndarray, bands: Bands) -> np.ndarray:
    """The tiles of a set: a hash for each of its bands and segments."""
    out, mixed, high = [], mix(s), s >> np.uint64(32)
    for band in bands.of(len(s)):
        d = bands.differing(band)
        if d == 0:
            continue  # only equal sets are similar enough, and they are one node
        k = d + SPARE_SEGMENTS
        segment = (high * np.uint64(k)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        content = np.add.reduceat(mixed, first)
        number = segment[first]
        if k - len(first) >= SPARE_SEGMENTS:  # so many are empty that a pair might agree in these alone
            empty = np.setdiff1d(np.arange(k, dtype=np.uint64), number)
            content, number = np.concatenate([content, np.zeros(len(empty), np.uint64)]), np.concatenate([number, empty])
        out.append(mix(content + mix(number + np.uint64(band << 32))))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _describe(width: int, percent: int):
    def describe(batches: Batches) -> Batches:
        bands = Bands(percent, 1)
        for batch in batches:
            for part in text_slices(batch, "_text"):
                sets = _sets(part.column("_text"), width)
                largest = max(map(len, sets), default=1)
                if largest >= bands.lows[-1]:
                    bands = Bands(percent, largest)
                one = [int(s.sum(dtype=np.uint64)) for s in sets]
                two = [int(np.bitwise_xor.reduce(mix(s))) if len(s) else 0 for s in sets]
                tiles = [_tiles(s, bands) if len(s) else s for s in sets]
                flat = np.concatenate(tiles) if tiles else np.zeros(0, np.uint64)
                offsets = np.concatenate([[0], np.cumsum([len(t) for t in tiles])]).astype(np.int32)
                columns = [
                    part.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(np.array(one, np.uint64).view(np.int64)),
                    pa.array(np.array(two, np.uint64).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "d1", "d2", "tiles"])

    return describe


def _signatures(width: int):
    def signatures(batches: Batches) -> Batches:
        for batch in batches:
            for part in text_slices(batch, "_text"):
                sets = _sets(part.column("_text"), width)
                bits = []
                for s in sets:
                    size = max(64, 1 << (BITS_PER_ELEMENT * len(s)).bit_length())
                    flags = np.zeros(size, bool)
                    flags[(s & np.uint64(size - 1)).astype(np.int64)] = True
                    bits.append(np.packbits(flags).tobytes())
                columns = [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(bits, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "n", "bits"])

    return signatures


def _arrays(width: int):
    def arrays(batches: Batches) -> Batches:
        for batch in batches:
            for part in text_slices(batch, "_text"):
                sets = [s.tobytes() for s in _sets(part.column("_text"), width)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return arrays


class _Sets:
    """The sets of nodes: their sizes and bitmaps are stored, their arrays are made anew from texts where wanted."""

    def __init__(self, rows: DataFrame, nodes: DataFrame, width: int, percent: int) -> None:
        self.rows, self.width, self.percent = rows.filter("doc_id is not null"), width, percent
        made = map_batches(self.texts(nodes), _signatures(width), "node long, n long, bits binary")
        self.signatures = stored(made.join(nodes, "node", "left_semi"), "signatures")

    def texts(self, nodes: DataFrame) -> DataFrame:
        """(doc_id, _text) of stored `nodes`, and of few others."""
        wanted = stored(filter_of(nodes), "filter")
        return with_repeated(self.rows, "doc_id", wanted, "_wanted").filter("_wanted").select("doc_id", "_text")

    def arrays(self, nodes: DataFrame) -> DataFrame:
        """(node, shingles) of stored `nodes`."""
        return map_batches(self.texts(nodes), _arrays(self.width), "node long, shingles binary").join(nodes, "node", "left_semi")


def _least_shared(n: np.ndarray | int, m: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The least intersection of sets of n and m elements with 100 * intersection >= percent * union."""
    return -(-percent * (n + m) // (100 + percent))


def _enough(x: bytes, y: bytes, percent: int) -> bool:
    """Whether the sorted arrays share enough elements."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    both = np.sort(np.concatenate([a, b]))
    return int((both[1:] == both[:-1]).sum()) >= _least_shared(len(a), len(b), percent)


def _narrowed(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (rows) in so many words: half by half, as an element's bit is its hash modulo the size."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


def _most_shared(n: np.ndarray | int, m: np.ndarray | int, x_bits: np.ndarray, y_bits: np.ndarray) -> np.ndarray:
    """A bound of the intersection from above: each bit of one bitmap only stands for an element of one set only."""
    words = min(x_bits.shape[-1], y_bits.shape[-1])
    x_bits, y_bits = _narrowed(x_bits, words), _narrowed(y_bits, words)
    only_x, only_y = (np.bitwise_count(a & ~b).sum(axis=-1, dtype=np.int64) for a, b in ((x_bits, y_bits), (y_bits, x_bits)))
    return np.minimum(n - only_x, m - only_y)


def similar(x: bytes, y: bytes, x_bits: np.ndarray, y_bits: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union: bit counts first, then the sorted arrays."""
    n, m = len(x) // 8, len(y) // 8
    return bool(_most_shared(n, m, x_bits, y_bits) >= _least_shared(n, m, percent)) and _enough(x, y, percent)


def _bounded(percent: int):
    def bounded(batches: Batches) -> Batches:
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in ("x_n", "y_n"))
            x, y = batch.column("x_bits").to_pylist(), batch.column("y_bits").to_pylist()
            widths = np.array([len(b) for b in x]) * (1 << 32) + np.array([len(b) for b in y])
            possible = np.zeros(batch.num_rows, bool)
            for width in np.unique(widths):  # bitmaps of equal sizes together
                at = np.flatnonzero(widths == width)
                xs, ys = (np.frombuffer(b"".join([side[i] for i in at.tolist()]), np.uint64).reshape(len(at), -1) for side in (x, y))
                possible[at] = _most_shared(n[at], m[at], xs, ys) >= _least_shared(n[at], m[at], percent)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(possible)], names=["a", "b", "possible"])

    return bounded


def _verify(percent: int):
    def verify(batches: Batches) -> Batches:
        for batch in batches:
            x, y = batch.column("x"), batch.column("y")
            keep = [_enough(x[i].as_py(), y[i].as_py(), percent) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(keep, pa.bool_())], names=["a", "b", "linked"])

    return verify


def _possible(pairs: DataFrame, sets: _Sets) -> DataFrame:
    """The stored pairs (a, b) with `possible`: whether bit counts leave room for a link. No array is read."""
    of = lambda node, side: sets.signatures.select(F.col("node").alias(node), F.col("n").alias(f"{side}_n"), F.col("bits").alias(f"{side}_bits"))
    rows = pairs.join(of("a", "x"), "a").join(of("b", "y"), "b").select("a", "b", "x_n", "y_n", "x_bits", "y_bits")
    return stored(map_batches(rows, _bounded(sets.percent), "a long, b long, possible boolean"), "bounded")


def _compared(pairs: DataFrame, sets: _Sets) -> DataFrame:
    """The stored pairs (a, b) with the result of the comparison in `linked`."""
    bounded = _possible(pairs, sets)
    near = bounded.filter("possible").select("a", "b")
    nodes = stored(near.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "compared-nodes")
    arrays = stored(sets.arrays(nodes), "arrays")
    one, two = (arrays.select(F.col("node").alias(node), F.col("shingles").alias(side)) for node, side in (("a", "x"), ("b", "y")))
    rows = near.join(one, "a").join(two, "b").select("a", "b", "x", "y")
    decided = stored(map_batches(rows, _verify(sets.percent), "a long, b long, linked boolean"), "compared")
    return decided.unionByName(bounded.filter("not possible").select("a", "b", F.lit(False).alias("linked")))


def _open_pairs(batches: Batches) -> Batches:
    """All pairs of different classes in tiles of at most BLOCK members."""
    for batch in batches:
        a, b = [], []
        for members in batch.column("members").to_pylist():
            for i, m in enumerate(members):
                for o in members[:i]:
                    if m["label"] != o["label"]:
                        a.append(max(m["node"], o["node"]))
                        b.append(min(m["node"], o["node"]))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _block(percent: int):
    def compare(table: pa.Table) -> pa.Table:
        """Links between the left and right sets of one block pair; classes that are linked already are skipped."""
        rows = table.to_pylist()
        bits = [np.frombuffer(r["bits"], np.uint64) for r in rows]
        merged: dict[int, int] = {}

        def root(x: int) -> int:
            while merged.get(x, x) != x:
                x = merged[x]
            return x

        left = [i for i, r in enumerate(rows) if r["side"] == 0]
        right = [i for i, r in enumerate(rows) if r["side"] == 1]
        links = []
        for i in left:
            for j in right:
                p, q = root(rows[i]["label"]), root(rows[j]["label"])
                if p != q and similar(rows[i]["shingles"], rows[j]["shingles"], bits[i], bits[j], percent):
                    merged[max(p, q)] = min(p, q)
                    links.append((rows[i]["node"], rows[j]["node"]))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return compare


def near_duplicate_classes(
    docs: DataFrame, width: int = 3, percent: int = 90, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id.

    Words are runs of anything but ASCII white space, with A-Z in lower case. The set of a text holds its distinct
    `width`-grams; one of fewer words holds its whole sequence. Sets are linked if 100 * intersection >= percent * union;
    component_id is the smallest id that links lead to. Null and empty texts have an empty set and no links. A row with a
    null id has no links and a null component. Rows that repeat an id count as one document with the links of each.
    Shingles are compared by 64-bit hashes.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
    base = stored(
        map_batches(rows, _describe(width, percent), "doc_id long, n_shingles long, d1 long, d2 long, tiles array<long>"), "sets"
    )
    kept = base.filter("n_shingles > 0 and doc_id is not null")
    nodes = stored(kept.groupBy("d1", "d2").agg(F.min("doc_id").alias("node")), "nodes")
    # Equal sets have equal tiles and one `set`; they are merged before anything is shuffled.
    entries = kept.select("d1", "d2", F.explode("tiles").alias("tile")).withColumn("set", F.xxhash64("d1", "d2"))
    shared = stored(
        entries.groupBy("tile").agg(F.min("set").alias("_low"), F.max("set").alias("_high")).filter("_low < _high").select("tile"), "tiles"
    )
    # Only entries of shared tiles go on; the filter lets few others into the shuffle.
    maybe = with_repeated(entries, "tile", stored(filter_of(shared), "filter"), "_shared").filter("_shared").select("tile", "d1", "d2").distinct()
    members = stored(maybe.join(shared, "tile").join(nodes, ["d1", "d2"]).select("tile", "node"), "members")
    sets = _Sets(rows, stored(members.select("node").distinct(), "shared-nodes"), width, percent)

    links, labels, compared, left = _with_centres(members, sets, None)
    links = links.unionByName(_listed_links(left, sets, compared))
    many = stored(left.filter(F.col("size") > BLOCK).select("node").distinct(), "many")
    if not many.isEmpty():
        rivals = stored(_with_company(many, sets), "rivals")
        rare = stored(_rarest(sets.arrays(rivals), percent), "rare")
        links, labels, compared, left = _with_centres(rare, sets, links)
        links = links.unionByName(_listed_links(left, sets, compared))
        large = left.filter(F.col("size") > BLOCK)
        if not large.isEmpty():
            links = links.unionByName(stored(_block_links(large, sets), "blocks"))
    again = _ids_of_several_sets(base)
    links = links.unionByName(_links_of_ids(base, again, nodes))
    labels = stored(components(links), "labels")

    classes = nodes.select("d1", "d2", "node").join(labels, "node", "left")
    classes = stored(classes.select("d1", "d2", F.coalesce("label", "node").alias("component_id")), "classes")
    keyed = base.select("doc_id", "n_shingles", "d1", "d2")
    some = keyed.filter("n_shingles > 0 and doc_id is not null").join(classes, ["d1", "d2"])
    # An empty set has the component of its id's other sets, if there are any.
    of_ids = some.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component_id").alias("_of_id"))
    none = keyed.filter("n_shingles = 0 or doc_id is null").join(of_ids, "doc_id", "left")
    none = none.select("doc_id", "n_shingles", F.coalesce("_of_id", "doc_id").alias("component_id"))
    return some.select("doc_id", "n_shingles", "component_id").unionByName(none)


def _ids_of_several_sets(base: DataFrame) -> DataFrame:
    sets = base.filter("doc_id is not null").groupBy("doc_id")
    sets = sets.agg(*(f(c).alias(f"_{f.__name__}_{c}") for c in ("n_shingles", "d1", "d2") for f in (F.min, F.max)))
    several = " or ".join(f"_min_{c} < _max_{c}" for c in ("n_shingles", "d1", "d2"))
    return stored(sets.filter(several).select("doc_id"), "repeated-ids")


def _links_of_ids(base: DataFrame, again: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links between the nodes of one id: each with the smallest."""
    rows = base.filter("n_shingles > 0").join(again, "doc_id", "left_semi").select("doc_id", "d1", "d2").distinct()
    of_id = stored(rows.join(nodes.select("d1", "d2", "node"), ["d1", "d2"]).select("doc_id", "node"), "nodes-of-ids")
    least = stored(of_id.groupBy("doc_id").agg(F.min("node").alias("b")), "least-nodes")
    return of_id.join(least, "doc_id").select(F.col("node").alias("a"), "b").filter("a <> b")


def _with_centres(members: DataFrame, sets: _Sets, links: DataFrame | None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """One round over tiles (tile, node): each node is compared with the most central member of its tiles.

    Gives all links so far, the labels of classes, the pairs compared, and the members (tile, node, label, size) of the
    tiles that still hold several classes.
    """
    degree = stored(members.groupBy("node").agg(F.count(F.lit(1)).alias("degree")), "degrees")
    ranked = members.join(degree, "node").select("tile", "node", F.struct((-F.col("degree")).alias("d"), F.col("node").alias("n")).alias("rank"))
    centres = stored(ranked.groupBy("tile").agg(F.min("rank").alias("centre")), "centres")
    best = members.join(centres, "tile").groupBy("node").agg(F.min("centre").alias("centre"))
    compared = _compared(best.select(F.col("node").alias("a"), F.col("centre.n").alias("b")).filter("a <> b"), sets)
    found = compared.filter("linked").select("a", "b")
    links = found if links is None else links.unionByName(found)
    labels = stored(components(links), "labels")
    classed = stored(members.join(labels, "node", "left").select("tile", "node", F.coalesce("label", "node").alias("label")), "classed")
    sizes = classed.groupBy("tile").agg(F.min("label").alias("_low"), F.max("label").alias("_high"), F.count(F.lit(1)).alias("size"))
    left = stored(classed.join(stored(sizes.filter("_low < _high").select("tile", "size"), "open"), "tile"), "left")
    return links, labels, compared, left


def _listed_links(left: DataFrame, sets: _Sets, compared: DataFrame) -> DataFrame:
    """Links among the pairs of different classes in open tiles of at most BLOCK members; each pair is compared once."""
    small = left.filter(F.col("size") <= BLOCK).groupBy("tile").agg(F.collect_list(F.struct("node", "label")).alias("members"))
    listed = map_batches(small.select("members"), _open_pairs, "a long, b long").distinct()
    known = compared.filter("not linked").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return _compared(listed.join(known, ["a", "b"], "left_anti"), sets).filter("linked").select("a", "b")


def _counted_first(width: int, percent: int):
    share = min(1.0, COUNTED_FIRST * (100 - percent) / 100)
    below = np.uint64(min(int(share * 2.0**64), 2**64 - 1))

    def counted(batches: Batches) -> Batches:
        for batch in batches:
            for part in text_slices(batch, "_text"):
                sets = [s[mix(s) <= below] for s in _sets(part.column("_text"), width)]
                nodes = np.repeat(part.column("doc_id").to_numpy(), [len(s) for s in sets])
                flat = np.concatenate(sets).view(np.int64)
                for low in range(0, len(flat), 1 << 20):
                    rows = slice(low, low + (1 << 20))
                    yield pa.RecordBatch.from_arrays([pa.array(nodes[rows]), pa.array(flat[rows])], names=["node", "shingle"])

    return counted


def _with_company(nodes: DataFrame, sets: _Sets) -> DataFrame:
    """Those of `nodes` that may have a similar one among them.

    A partner holds `percent` in 100 of a set's shingles, so a set with more shingles of its own than the rest has none.
    To see that it is enough to count some shingles, chosen by hash for all sets alike. Others that pass the filter of
    texts only make fewer shingles unique. An id of several texts always stays.
    """
    shingles = map_batches(sets.texts(nodes), _counted_first(sets.width, sets.percent), "node long, shingle long")
    single = shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("df"), F.min("node").alias("node")).filter("df = 1")
    alone = stored(single.groupBy("node").agg(F.count(F.lit(1)).alias("alone")), "alone")
    sizes = sets.signatures.groupBy("node").agg(F.count(F.lit(1)).alias("texts"), F.max("n").alias("n"))
    without = alone.join(sizes, "node").filter(f"texts = 1 and 100 * (n - alone) < {sets.percent} * n")
    return nodes.join(without, "node", "left_anti")


def _exploded(batches: Batches) -> Batches:
    for batch in batches:
        sets = [np.frombuffer(s.as_py(), np.int64) for s in batch.column("shingles")]
        sizes = [len(s) for s in sets]
        nodes, n = np.repeat(batch.column("node").to_numpy(), sizes), np.repeat(sizes, sizes)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        for low in range(0, len(flat), 1 << 20):
            part = slice(low, low + (1 << 20))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[part]), pa.array(n[part]), pa.array(flat[part])], names=["node", "n", "tile"])


def _rarest(arrays: DataFrame, percent: int) -> DataFrame:
    """Another kind of tiles for nodes that share large ones: (tile, node) for the rarest shingles of each.

    In the order of their frequency among these nodes, two similar enough sets of n and m shingles share one among
    the first n - ceil(percent * n / 100) + 1 and m - ceil(percent * m / 100) + 1. What many have in common comes last.
    """
    shingles = map_batches(arrays.select("node", "shingles"), _exploded, "node long, n long, tile long")
    counts = stored(shingles.groupBy("tile").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "frequencies")
    rows = stored(shingles.join(counts, "tile"), "frequent")  # the others, all unique, come first and match nothing
    frequent = rows.groupBy("node").agg(F.count(F.lit(1)).alias("c"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy("df", "tile"))
    prefix = F.expr(f"n - cast(ceil(n * {percent} / 100.0) as long) + 1 - (n - c)")
    return rows.join(frequent, "node").withColumn("_rank", rank).filter(F.col("_rank") <= prefix).select("tile", "node")


def _block_links(members: DataFrame, sets: _Sets) -> DataFrame:
    """Links between classes in large tiles. Only members outside the tile's largest class stand on the left of blocks."""
    sizes = members.groupBy("tile", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("tile").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("all"))
    largest = stored(largest.select("tile", F.col("top.label").alias("top"), (F.col("all") - F.col("top.n")).alias("minor"), "all"), "largest")
    rows = members.join(largest, "tile")
    of = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    spread = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), of(n).cast("long")).cast("int")
    every = lambda n: F.sequence(F.lit(0), of(n) - 1)
    left = rows.filter("label <> top").select("tile", spread("minor", 1).alias("i"), F.explode(every("all")).alias("j"), F.lit(0).alias("side"), "node", "label")
    right = rows.select("tile", F.explode(every("minor")).alias("i"), spread("all", 2).alias("j"), F.lit(1).alias("side"), "node", "label")
    described = sets.arrays(stored(members.select("node").distinct(), "large")).join(sets.signatures.select("node", "bits"), "node")
    blocks = left.unionByName(right).join(stored(described, "arrays"), "node")
    ship(members.sparkSession)
    return blocks.groupBy("tile", "i", "j").applyInArrow(_block(sets.percent), "a long, b long").distinct()


def keep_one_of_each_class(docs: DataFrame, width: int = 3, percent: int = 90, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs` with the smallest id of their class, with their columns. Rows that repeat an id are one
    document and stay or go together; rows with a null id stay."""
    classes = near_duplicate_classes(docs, width, percent, id_column, text_column)
    dropped = stored(classes.filter("doc_id <> component_id").select("doc_id").distinct(), "dropped").withColumnRenamed("doc_id", "_dropped")
    blocks = stored(filter_of(dropped), "filter")
    plain = PlainNames(docs)
    number = F.col(plain[id_column]).cast("long")
    flagged = with_repeated(plain.df.withColumn("_id", F.coalesce(number, F.lit(0).cast("long"))), "_id", blocks, "_maybe")
    sure = flagged.filter(number.isNull() | ~F.col("_maybe"))
    rest = flagged.filter(number.isNotNull() & F.col("_maybe")).join(dropped, F.col("_id") == F.col("_dropped"), "left_anti")
    return plain.restored(sure).unionByName(plain.restored(rest))
