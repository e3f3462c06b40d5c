"""Joins and fan-outs that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskflow.sources.storage import stored

# A key with more rows than this is split over several tasks.
ROWS_PER_TASK = 1_000_000
# Up to so many heavy keys are kept on the driver and broadcast; a longer list is a stored table and joined as one.
LISTED_KEYS = 10_000
MAX_PARTS = 100_000
# Keys are counted in so many cells before any is counted alone. On large inputs a heavy key has at least this share of
# all rows, 16 times what a cell holds on average.
CELLS = 1 << 17
SMALLEST_SHARE = 16 / CELLS
COPIES_PER_CHUNK = 65_536


@dataclass(frozen=True)
class HeavyKeys:
    """Heavy values of one key column with the number of parts to split each into; `nulls` are the parts of null."""

    table: DataFrame | None = None  # (key, _parts), without null
    nulls: int = 1

    def __bool__(self) -> bool:
        return self.table is not None or self.nulls > 1

    def parts(self) -> dict:
        """All heavy values and their parts, on the driver; for looking at, not for plans."""
        rows = [tuple(r) for r in self.table.collect()] if self.table is not None else []
        return dict(rows) | ({None: self.nulls} if self.nulls > 1 else {})


Heavy = Mapping[str, HeavyKeys]


class EvenKeys(dict):
    """For callers that know that no key is heavy: nothing is measured and nothing is split."""

    def __missing__(self, key: str) -> HeavyKeys:
        return HeavyKeys()


def heavy_keys(df: DataFrame, *keys: str, rows_per_task: int | None = None) -> Heavy:
    """Values of each key column with more rows than the limit, however many there are, and the parts to split each into.

    A first job counts rows by a hash of the key into CELLS cells, merged before the shuffle, so that it moves no more
    than CELLS numbers per task and column however many keys there are. No key has more rows than its cell: only the keys
    of cells above the limit are counted one by one, by a second job that most inputs never need. The limit is
    `rows_per_task`, or else ROWS_PER_TASK, and for large inputs the share SMALLEST_SHARE of all rows, so that on average
    a cell stays far below it. The result steers how joins are split, not what they return.
    """
    columns = list(enumerate(keys))
    cell = lambda i, k: F.when(F.col(k).isNull(), F.lit(CELLS)).otherwise(F.pmod(F.xxhash64(F.col(k).cast("string")), F.lit(CELLS))) + i * (CELLS + 1)
    cells = [cell(i, k) for i, k in columns]
    cells = df.select((F.explode(F.array(*cells)) if len(keys) > 1 else cells[0]).alias("cell")).groupBy("cell").count()
    least = rows_per_task or ROWS_PER_TASK
    # One row: the number of rows and the cells above the least limit, of which there are CELLS a column at most.
    total, listed = cells.agg(
        F.sum("count"), F.collect_list(F.when(F.col("count") > least, F.struct("cell", "count")))
    ).first()
    limit = rows_per_task or max(ROWS_PER_TASK, int((total or 0) / len(keys) * SMALLEST_SHARE))
    full = {r["cell"]: r["count"] for r in listed if r["count"] > limit}
    nulls = {k: min(-(-full.pop((i + 1) * CELLS + i, 0) // limit), MAX_PARTS) for i, k in columns}
    out = {k: HeavyKeys(None, max(nulls[k], 1)) for k in keys}
    for i, k in columns:
        hot = [c - i * (CELLS + 1) for c in full if i * (CELLS + 1) <= c < (i + 1) * (CELLS + 1)]
        if hot:
            out[k] = HeavyKeys(_counted(df.select(k), k, hot, limit), out[k].nulls)
    return out


def _counted(rows: DataFrame, key: str, hot: list[int], limit: int) -> DataFrame | None:
    """The keys in `hot` cells with more than `limit` rows, counted exactly, and their parts."""
    cells = F.broadcast(rows.sparkSession.createDataFrame([(c,) for c in hot], "_cell long"))  # CELLS numbers at most
    own = rows.filter(F.col(key).isNotNull()).withColumn("_cell", F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(CELLS)))
    counted = own.join(cells, "_cell").groupBy(key).count().filter(F.col("count") > limit)
    found = counted.select(key, F.least(F.ceil(F.col("count") / limit), F.lit(MAX_PARTS)).cast("int").alias("_parts"))
    listed = found.take(LISTED_KEYS + 1)
    if len(listed) > LISTED_KEYS:
        return stored(found)
    return F.broadcast(rows.sparkSession.createDataFrame(listed, found.schema)) if listed else None


def no_repeats(df: DataFrame, key: str) -> bool:
    """Whether no value of `key`, null included, is on two rows.

    64-bit hashes are counted, merged before the shuffle: 8 bytes and a count per row are moved. Values that share a hash
    look like a repeat, so that False may be wrong, about once in a billion billion pairs, but True never is.
    """
    counts = df.select(F.xxhash64(key).alias("hash")).groupBy("hash").count()
    return (counts.agg(F.max("count")).first()[0] or 0) <= 1


def _with_parts(df: DataFrame, key: str, heavy: HeavyKeys) -> DataFrame:
    if heavy.table is None:
        return df.withColumn("_parts", F.lit(None).cast("int"))
    return df.join(heavy.table, key, "left")


def split_rows(df: DataFrame, key: str, heavy: HeavyKeys) -> tuple[DataFrame, DataFrame]:
    """The rows whose key is not heavy, and those whose key is."""
    is_heavy = F.col("_parts").isNotNull()
    if heavy.nulls > 1:
        is_heavy |= F.col(key).isNull()
    rows = _with_parts(df, key, heavy)
    return rows.filter(~is_heavy).drop("_parts"), rows.filter(is_heavy).drop("_parts")


def task_salt(parts: Column | int, *spread_by: str) -> Column:
    """A part number below `parts`. The partition id spreads copies of one row and is the same on a task retry."""
    parts = F.lit(parts) if isinstance(parts, int) else parts
    return F.pmod(F.xxhash64(F.spark_partition_id(), *spread_by), parts.cast("long")).cast("int")


def in_parts(df: DataFrame, key: str, heavy: HeavyKeys, name: str, flag: str | None = None) -> DataFrame:
    """Repeat each row once per part of its key, numbered in column `name`; `flag` tells which keys are heavy."""
    rows = _with_parts(df, key, heavy)
    if flag:
        rows = rows.withColumn(flag, F.col("_parts").isNotNull())
    return rows.withColumn(name, F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")


def to_part(df: DataFrame, key: str, heavy: HeavyKeys, name: str, spread_by: str | None = None) -> DataFrame:
    """Give each row one part of its key, in column `name`."""
    spread = [spread_by] if spread_by else []
    salt = F.when(F.col("_parts").isNotNull(), task_salt(F.coalesce("_parts", F.lit(1)), *spread)).otherwise(0)
    if heavy.nulls > 1:
        salt = F.when(F.col(key).isNull(), task_salt(heavy.nulls, *spread)).otherwise(salt)
    return _with_parts(df, key, heavy).withColumn(name, salt).drop("_parts")


def lookup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    heavy: HeavyKeys,
    how: str = "inner",
    spread_by: str | None = None,
) -> DataFrame:
    """Join many rows per key to a side with one row, or few, per key; `key` comes first in the result.

    Without heavy keys this is a plain join. Else the rows of a heavy key are split into parts, and what matches it
    on the right is repeated once per part. Rows without a key match nothing and are spread out in a left join.
    """
    if not heavy:
        return left.join(right, key, how)
    return (
        to_part(left, key, heavy, "_part", spread_by)
        .join(in_parts(right, key, heavy, "_part"), [key, "_part"], how)
        .drop("_part")
    )


def repeat_rows(df: DataFrame, copies: str, number: str) -> DataFrame:
    """`copies` (at least one) copies of each row, numbered from 1, made in chunks to keep memory flat."""
    n = F.col(copies).cast("long")
    return (
        df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / COPIES_PER_CHUNK))))
        .withColumn(
            number,
            F.explode(
                F.sequence(
                    F.col("_chunk") * COPIES_PER_CHUNK + 1,
                    F.least(F.col("_chunk") * COPIES_PER_CHUNK + COPIES_PER_CHUNK, n),
                )
            ),
        )
        .drop("_chunk")
    )


def first_per_key(df: DataFrame, key: str, order: list[str | Column]) -> DataFrame:
    """One row per key, the first in `order`. Spark keeps one row per key and task before it shuffles."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")
