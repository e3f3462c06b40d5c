"""Reading inputs and served predictions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from riskflow.schemas import SCHEMAS
from riskflow.sources.published import current_path
from riskflow.sources.storage import stored


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None, **options: str) -> DataFrame:
    """CSV with a header row. A schema is applied by position; without one every column is a string.

    `escape='"'` in the options reads fields with doubled quotes.
    """
    reader = spark.read.options(header=True, **options)
    return (reader.schema(schema) if schema else reader).csv(path)


@dataclass(frozen=True)
class CheckedRows:
    """Rows that fit their schema; bad rows as (file, line); how many there are of each."""

    good: DataFrame
    bad: DataFrame
    good_count: int
    bad_count: int


def read_checked_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    max_bad_share: float = 1.0,
    work_dir: str | None = None,
    **options: str,
) -> CheckedRows:
    """CSV with a header row, read once: rows that fit the schema and rows that do not are stored in one pass, then counted.

    Bad is a row with a value that cannot be read, with too few fields or with too many. A null or empty field is good.
    Without a schema every column is a string, named by the header. Raises if more than `max_bad_share` of the rows are bad.
    """
    if schema is None:
        schema = read_csv(spark, path, **options).schema
    line, file = (next(n for n in (stem + "_" * i for i in range(len(schema) + 1)) if n not in schema.names) for stem in ("_line", "_file"))
    reader = spark.read.options(header=True, **options).options(mode="PERMISSIVE", columnNameOfCorruptRecord=line)
    is_bad = F.col(line).isNotNull()
    rows = reader.schema(StructType([*schema.fields]).add(line, "string")).csv(path)
    kept = stored(rows.withColumn(file, F.when(is_bad, F.col("_metadata.file_path"))), work_dir)
    # Counted from one stored column: a session that has observed metrics cannot serialise tree models fitted in it later.
    good, bad = kept.agg(F.count_if(~is_bad), F.count_if(is_bad)).first()
    if bad > max_bad_share * (good + bad):
        raise ValueError(f"{path}: {bad} of {good + bad} rows cannot be read")
    return CheckedRows(
        kept.filter(~is_bad).select(*[F.col(f"`{n}`") for n in schema.names]),
        kept.filter(is_bad).select(F.col(file).alias("file"), F.col(line).alias("line")),
        good,
        bad,
    )


def load_checked_data(
    spark: SparkSession,
    data_paths: Mapping[str, str],
    schemas: Mapping[str, StructType] = SCHEMAS,
    max_bad_share: float = 1.0,
    work_dir: str | None = None,
    **options: str,
) -> dict[str, CheckedRows]:
    """The datasets that have a schema, by name, each with its bad rows apart. A path that does not exist raises at once."""
    return {
        name: read_checked_csv(spark, path, schemas[name], max_bad_share, work_dir, **options)
        for name, path in data_paths.items()
        if name in schemas
    }


def load_data(
    spark: SparkSession,
    data_paths: Mapping[str, str],
    schemas: Mapping[str, StructType] = SCHEMAS,
    **options: str,
) -> dict[str, DataFrame]:
    """The datasets that have a schema, by name. A path that does not exist raises at once."""
    known = {name: path for name, path in data_paths.items() if name in schemas}
    for name in data_paths.keys() - known.keys():
        print(f"No schema for '{name}': skipped.")
    return {name: read_csv(spark, path, schemas[name], **options) for name, path in known.items()}


def read_labels(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Fraud labels as strings, columns taken from the header."""
    return read_csv(spark, path, **options)


def read_predictions(spark: SparkSession, path: str, view: str | None = "predictions") -> DataFrame:
    """The latest predictions published at `path`, or plain parquet there, also as a view for SQL. Only the columns a query uses are read."""
    df = spark.read.parquet(current_path(spark, path))
    if view:
        df.createOrReplaceTempView(view)
    return df


def bucket_predicates(key: str, buckets: int) -> list[str]:
    """Conditions that cut a table by the text of its key's last two characters' codes: one for each bucket.

    Every row is in exactly one; a null or empty key is in bucket 0. The functions are those of common SQL databases.
    """
    last = f"coalesce(ascii(right({key}, 1)), 0) * 31 + coalesce(ascii(left(right({key}, 2), 1)), 0)"
    return [f"mod({last}, {buckets}) = {i}" for i in range(buckets)]


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str = "predictions",
    properties: Mapping[str, str] | None = None,
    view: str | None = "predictions",
    key: str = "transaction_id",
    connections: int = 16,
    one_connection: bool = False,
    **parallel: object,
) -> DataFrame:
    """Predictions from a database table, read over several connections.

    The table is cut into `connections` buckets of the text column `key`. `parallel` gives another cut: predicates, or
    column, lowerBound, upperBound and numPartitions. A read in one task has to be asked for with `one_connection`.
    """
    if not parallel and not one_connection:
        parallel = {"predicates": bucket_predicates(key, connections)}
    df = spark.read.jdbc(url, table, properties=dict(properties or {}), **parallel)
    if view:
        df.createOrReplaceTempView(view)
    return df


def fetch_data(spark: SparkSession, query: str) -> DataFrame:
    """Result of a SQL query over the registered views, not pulled to the driver."""
    return spark.sql(query)
