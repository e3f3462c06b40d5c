"""Removal of repeated multi-line chunks, in DataFrame operations only.

Each line has a hash, and a rolling hash goes over each line and the one before it. A chunk begins where the rolling
hash is smaller than its neighbours, which depends on four lines only: an insertion moves no boundary further away. A
chunk has two lines or more. Hashes of chunks that certainly occur once need no shuffle; the others are grouped by the
chunk's own bytes, the first occurrence stays and all others are removed.

Chunks miss a repeated passage that shares its chunk with other lines. without_repeated_passages has a fine level as
well: every two consecutive lines, and every line of 50 words or more, found by the same filter and compared by SHA-256.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskflow.llm.common import PlainNames, stored
from riskflow.llm.exact_dedup import filter_of, repeated_cells, with_repeated

_KEY = ["_id", "_hash"]
# A line of so many words is looked at alone.
LINE_WORDS = 50


def _with_cuts(docs: DataFrame, text_column: str) -> DataFrame:
    """Adds _lines, and _cuts: where the chunks begin and their number of lines."""
    lines = docs.withColumn("_lines", F.split(F.col(text_column), "\n", -1))
    hashed = lines.withColumn("_h", F.transform("_lines", F.md5))
    # The rolling hash of each line, as a hex string; strings are compared.
    rolled = hashed.withColumn(
        "_r", F.zip_with(F.concat(F.array(F.lit("")), F.slice("_h", 1, F.greatest(F.size("_h") - 1, F.lit(0)))), "_h", lambda a, b: F.md5(F.concat(a, b)))
    )
    # A line begins a chunk if it is the first, or if it has neighbours on both sides and the smallest rolling hash.
    starts = F.expr("""
        concat(array(0), transform(filter(
          zip_with(zip_with(slice(_r, 1, greatest(size(_r) - 2, 0)), slice(_r, 2, greatest(size(_r) - 2, 0)), (a, b) -> struct(a as a, b as b)),
            zip_with(slice(_r, 3, greatest(size(_r) - 2, 0)), sequence(1, greatest(size(_r) - 2, 1)), (c, i) -> struct(c as c, i as i)),
            (x, y) -> struct(x.a as a, x.b as b, y.c as c, y.i as i)),
          t -> t.b < t.a and t.b <= t.c), t -> t.i))
    """)
    begun = rolled.withColumn("_s", F.when(F.col("_lines").isNotNull(), starts)).drop("_h", "_r")
    sizes = "zip_with(_s, concat(slice(_s, 2, size(_s) - 1), array(size(_lines))), (a, b) -> struct(a as a, b - a as n))"
    return begun.withColumn("_cuts", F.expr(sizes)).drop("_s")


def with_chunks(docs: DataFrame, text_column: str) -> DataFrame:
    """Adds _chunks: the texts of the chunks in order, and their number of lines. Null has none."""
    cut = _with_cuts(docs, text_column)
    # _lines stands twice in the lambda, so that it is made once for a row and not for each chunk.
    chunks = F.expr("transform(_cuts, c -> struct(array_join(slice(_lines, c.a + 1, c.n), '\n') as text, least(c.n, size(_lines)) as n))")
    return cut.withColumn("_chunks", chunks).withColumn("n_lines", F.coalesce(F.size("_lines"), F.lit(0))).drop("_cuts", "_lines")


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """A row is known by its id and the hash of its text; rows that repeat both are one document."""
    return docs.withColumn("_id", F.coalesce(F.col(id_column).cast("long"), F.lit(-(2**63)))).withColumn("_hash", F.xxhash64(text_column))


def _removals(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """For each document that loses chunks: its key and the numbers of these chunks."""
    keyed = _keyed(docs.select(id_column, text_column), id_column, text_column)
    # The outer form: for the other one, Spark puts a filter on the size of _chunks, with all that makes it written out
    # again and again, below.
    chunks = with_chunks(keyed, text_column).select(*_KEY, F.posexplode_outer("_chunks").alias("nth", "_chunk"))
    chunks = chunks.select(*_KEY, "nth", F.col("_chunk.text").alias("chunk"), F.col("_chunk.n").alias("n"))
    # Chunks of two lines or more with something to be seen in them.
    chunks = chunks.filter("n > 1 and chunk rlike '[^ \\\\t\\\\r\\\\n]'").withColumn("_chunk_hash", F.xxhash64("chunk")).drop("n")
    blocks = stored(repeated_cells(chunks.select("_chunk_hash")), "filter")
    maybe = with_repeated(chunks, "_chunk_hash", blocks, "_repeated").filter("_repeated").select(*_KEY, "nth", "chunk")
    maybe = stored(maybe.distinct(), "chunks")
    place = F.struct(*_KEY, "nth")
    groups = maybe.groupBy("chunk").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    # Grouped and joined by the chunk's bytes; both sides are stored, so that Spark can split a frequent chunk.
    removed = maybe.join(stored(groups, "groups"), "chunk").filter(place != F.col("first"))
    return removed.groupBy(*_KEY).agg(F.collect_set("nth").alias("_gone"))


def _kept(gone: Column) -> Column:
    chunk = F.filter("_chunks", lambda c, i: ~F.array_contains(gone, i))
    return F.array_join(F.transform(chunk, lambda c: c["text"]), "\n")


def without_repeated_chunks(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`docs` with the text cleaned, and n_lines, n_removed_lines and n_removed_chunks.

    Lines end at line feeds. The first occurrence, by id, hash of the text and position, stays. Null texts stay null and
    have no lines; an empty text is one empty line. Chunks of white space alone stay. Null ids come first.
    """
    plain = PlainNames(docs.drop("n_lines", "n_removed_lines", "n_removed_chunks"))
    id_name, text_name = plain[id_column], plain[text_column]
    removals = stored(_removals(plain.df, id_name, text_name), "removals")
    touched = stored(filter_of(removals.select(F.xxhash64(*_KEY).alias("key"))), "filter")
    keyed = _keyed(plain.df, id_name, text_name).withColumn("_row", F.xxhash64(*_KEY))
    flagged = with_repeated(keyed, "_row", touched, "_touched").drop("_row")
    lines = F.coalesce(F.size(F.split(F.col(text_name), "\n", -1)), F.lit(0)).cast("long")
    zero = F.lit(0).cast("long")
    new = ["n_lines", "n_removed_lines", "n_removed_chunks"]
    same = flagged.filter("not _touched").withColumns(dict(zip(new, [lines, zero, zero], strict=True)))
    changed = with_chunks(flagged.filter("_touched").join(removals, _KEY, "left"), text_name)
    gone = F.coalesce("_gone", F.array().cast("array<int>"))
    removed_lines = F.aggregate(F.filter("_chunks", lambda c, i: F.array_contains(gone, i)), F.lit(0), lambda a, c: a + c["n"])
    changed = changed.select(
        *[c for c in plain.df.columns if c != text_name],
        F.when(F.size(gone) > 0, _kept(gone)).otherwise(F.col(text_name)).alias(text_name),
        F.col("n_lines").cast("long"),
        F.coalesce(removed_lines, F.lit(0)).cast("long").alias("n_removed_lines"),
        F.size(gone).cast("long").alias("n_removed_chunks"),
    )
    return plain.restored(same, *new).unionByName(plain.restored(changed, *new))


def _repeated_lines(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """For each document that loses lines: its key and the places of these lines, in order."""
    keyed = _keyed(docs.select(id_column, text_column).filter(F.col(text_column).isNotNull()), id_column, text_column)
    # Chunks of three lines or more (of two they are among the pairs), pairs of lines, long lines.
    units = F.expr(f"""
        concat(
          transform(filter(_cuts, c -> c.n > 2), c -> struct(c.a as at, least(c.n, size(_lines)) as n, array_join(slice(_lines, c.a + 1, c.n), '\n') as text)),
          transform(zip_with(slice(_lines, 1, size(_lines) - 1), slice(_lines, 2, size(_lines) - 1), (a, b) -> concat(a, '\n', b)),
            (t, i) -> struct(i as at, 2 as n, t as text)),
          filter(transform(_lines, (t, i) -> struct(i as at, 1 as n, t as text)),
            u -> length(u.text) >= {2 * LINE_WORDS - 1} and regexp_count(u.text, '[^\\\\x20\\\\x09-\\\\x0D]+') >= {LINE_WORDS}))
    """)
    # The outer form, as for chunks.
    rows = _with_cuts(keyed, text_column).select(*_KEY, F.explode_outer(units).alias("_unit")).select(*_KEY, "_unit.at", "_unit.n", "_unit.text")
    rows = rows.filter("text rlike '[^ \\\\t\\\\r\\\\n]'").withColumn("_unit_hash", F.xxhash64("text"))
    blocks = stored(repeated_cells(rows.select("_unit_hash")), "filter")
    maybe = with_repeated(rows, "_unit_hash", blocks, "_repeated").filter("_repeated")
    maybe = stored(maybe.select(*_KEY, "at", "n", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")).distinct(), "units")
    place = F.struct(*_KEY, "at")
    groups = maybe.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("rows")).filter("rows > 1").drop("rows")
    # Both sides are stored, so that Spark can split a frequent pair of lines.
    removed = maybe.join(stored(groups, "groups"), "digest").filter(place != F.col("first"))
    spans = removed.groupBy(*_KEY).agg(F.collect_set(F.struct("at", "n")).alias("_spans"))
    return spans.select(*_KEY, F.expr("array_sort(array_distinct(flatten(transform(_spans, s -> sequence(s.at, s.at + s.n - 1)))))").alias("_gone"))


def without_repeated_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`docs` with the text cleaned, and n_lines, n_removed_lines and n_removed_runs.

    A line goes if it is in a chunk, or one of two consecutive lines, or alone has 50 words or more, and the same bytes
    stand at an earlier place by id, hash of the text and position. So of repeated runs of two lines or more, nothing is
    left after the first occurrence, and of each line some occurrence stays. Otherwise as without_repeated_chunks.
    """
    plain = PlainNames(docs.drop("n_lines", "n_removed_lines", "n_removed_runs"))
    id_name, text_name = plain[id_column], plain[text_column]
    removals = stored(_repeated_lines(plain.df, id_name, text_name), "removals")
    touched = stored(filter_of(removals.select(F.xxhash64(*_KEY).alias("key"))), "filter")
    keyed = _keyed(plain.df, id_name, text_name).withColumn("_row", F.xxhash64(*_KEY))
    flagged = with_repeated(keyed, "_row", touched, "_touched").drop("_row")
    lines = F.split(F.col(text_name), "\n", -1)
    zero = F.lit(0).cast("long")
    new = ["n_lines", "n_removed_lines", "n_removed_runs"]
    same = flagged.filter("not _touched").withColumns(dict(zip(new, [F.coalesce(F.size(lines), F.lit(0)).cast("long"), zero, zero], strict=True)))
    changed = flagged.filter("_touched").join(removals, _KEY, "left").withColumn("_gone", F.coalesce("_gone", F.array().cast("array<int>")))
    changed = changed.withColumn("_lines", lines)
    # The lines between two that go; _lines stands twice, as above.
    kept = F.expr("""array_join(flatten(zip_with(concat(array(-1), _gone), concat(_gone, array(size(_lines))),
        (a, b) -> slice(_lines, a + 2, least(b, size(_lines)) - a - 1))), '\n')""")
    runs = F.expr("size(filter(zip_with(concat(array(-2), slice(_gone, 1, greatest(size(_gone) - 1, 0))), _gone, (a, b) -> b - a), d -> d > 1))")
    changed = changed.select(
        *[c for c in plain.df.columns if c != text_name],
        F.when(F.size("_gone") > 0, kept).otherwise(F.col(text_name)).alias(text_name),
        F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.size("_gone").cast("long").alias("n_removed_lines"),
        F.when(F.size("_gone") > 0, runs).otherwise(0).cast("long").alias("n_removed_runs"),
    )
    return plain.restored(same, *new).unionByName(plain.restored(changed, *new))
