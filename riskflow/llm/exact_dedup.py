"""Exact dedup by two passes over a Bloom filter, in DataFrame operations only.

Pass 1 counts how many rows fall on each cell of the filter (one cell per hash, so eight bytes a row are shuffled, summed
before the shuffle) and keeps the cells with two rows or more as bits. Pass 2 looks each row up: a row whose bit is not
set has no equal and passes straight through; only the others are shuffled and grouped by their full digest.
The filter has a fixed number of cells. On more rows it lets more single rows into the shuffle; results do not change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskflow.llm.common import LOWER, UPPER, PlainNames, stored

# Cells of the filter: 16 MB of bits at most, whatever the input.
CELLS = 1 << 27
_WORDS_PER_BLOCK = 64


def normalized(text: Column) -> Column:
    """A-Z in lower case and nothing else changed; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def repeated_cells(hashes: DataFrame, cells: int = CELLS) -> DataFrame:
    """The filter of pass 1: blocks of bits, set where two rows or more of the only column (long) fall on a cell."""
    (name,) = hashes.columns
    return _blocks(hashes.groupBy(F.pmod(F.col(name), F.lit(cells)).alias("cell")).count().filter("count > 1"))


def filter_of(hashes: DataFrame, cells: int = CELLS) -> DataFrame:
    """A filter with the bits of all values of the only column (long) set."""
    (name,) = hashes.columns
    return _blocks(hashes.select(F.pmod(F.col(name), F.lit(cells)).alias("cell")))


def _blocks(set_cells: DataFrame) -> DataFrame:
    words = set_cells.groupBy(F.shiftright("cell", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(cell & 63 as int)))").alias("bits")
    )
    return (
        words.groupBy(F.shiftright("word", 6).alias("block"))
        .agg(F.map_from_entries(F.collect_list(F.expr(f"struct(cast(word & {_WORDS_PER_BLOCK - 1} as int), bits)"))).alias("set"))
        .select("block", F.expr(f"transform(sequence(0, {_WORDS_PER_BLOCK - 1}), i -> coalesce(try_element_at(set, i), 0L))").alias("bits"))
    )


def with_repeated(rows: DataFrame, name: str, filter_blocks: DataFrame, flag: str, cells: int = CELLS) -> DataFrame:
    """Pass 2: adds the boolean column `flag`, false where the hash in column `name` certainly occurs once."""
    blocks = F.broadcast(filter_blocks.select(F.col("block").alias("_block"), F.col("bits").alias("_bits")))  # 16 MB at most
    cell = f"pmod(`{name}`, {cells}L)"
    word = f"get(_bits, cast(shiftright({cell}, 6) & {_WORDS_PER_BLOCK - 1} as int))"
    hit = F.expr(f"{word} & shiftleft(1L, cast({cell} & 63 as int))")
    return (
        rows.join(blocks, F.expr(f"shiftright({cell}, 12) = _block"), "left")
        .withColumn(flag, F.coalesce(hit != 0, F.lit(False)))
        .drop("_block", "_bits")
    )


def duplicate_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", cells: int = CELLS) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Equal are texts that are identical after lower-casing A-Z; null counts as empty. The row with the largest id stays.
    A null id is below all others. Of rows that repeat an id with an equal text, one stays. An empty table gives none.
    """
    digest = F.sha2(normalized(F.col(text_column)).cast("binary"), 256)
    rows = stored(docs.select(F.col(id_column).alias("doc_id"), digest.alias("text_sha256")), "digests")
    rows = rows.withColumn("_hash", F.xxhash64("text_sha256"))
    flagged = with_repeated(rows, "_hash", repeated_cells(rows.select("_hash"), cells), "_repeated", cells).drop("_hash")
    single = flagged.filter("not _repeated").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    ids = stored(flagged.filter("_repeated").groupBy("text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("_rows")), "repeated")
    groups = stored(
        ids.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.sum("_rows").alias("group_size")), "groups"
    )
    # Both sides are stored rows, so that Spark can split a large group over tasks.
    grouped = (
        ids.join(groups, "text_sha256")
        .withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows"))))
        .select(
            "doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_nth") == 1)).alias("kept"), "text_sha256"
        )
    )
    return single.unionByName(grouped)


def drop_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", cells: int = CELLS) -> DataFrame:
    """The rows of `docs` that stay, with their columns. Only rows of possibly repeated texts are shuffled."""
    plain = PlainNames(docs)
    id_name, text_name = plain[id_column], plain[text_column]
    digest = F.sha2(normalized(F.col(text_name)).cast("binary"), 256)
    rows = plain.df.withColumn("_sha", digest).withColumn("_hash", F.xxhash64("_sha"))
    blocks = stored(repeated_cells(rows.select("_hash"), cells), "filter")
    flagged = with_repeated(rows, "_hash", blocks, "_repeated", cells)
    repeated = flagged.filter("_repeated")
    keep = stored(repeated.groupBy("_sha").agg(F.max(id_name).alias("_keep")), "keep").withColumnRenamed("_sha", "_of")
    # On digest and id: no key holds a whole group. Rows that repeat an id and its text meet in one window.
    kept = repeated.join(keep, (F.col("_sha") == F.col("_of")) & F.col(id_name).eqNullSafe(F.col("_keep")), "left_semi")
    nth = F.row_number().over(Window.partitionBy("_sha", id_name).orderBy(F.lit(1)))
    kept = kept.withColumn("_nth", nth).filter("_nth = 1")
    return plain.restored(flagged.filter("not _repeated")).unionByName(plain.restored(kept))
