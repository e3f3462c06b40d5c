"""Writing scored transactions, so that a failed run leaves what was there before."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from riskflow.sources.published import publish

# Options of Spark's own JDBC writer; a plain connection does not get them.
SPARK_OPTIONS = {"driver", "batchsize", "truncate", "isolationlevel", "numpartitions", "createtableoptions", "createtablecolumntypes"}
# Databases that end a transaction at each change of a table, but rename several tables in one step.
RENAME_AT_ONCE = ("jdbc:mysql:", "jdbc:mariadb:")


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace the data at `path`: read it with `read_predictions`, or from `published.current_path`."""
    publish(df.sparkSession, path, df.write.parquet)


def swap_statements(url: str, table: str, staged: str) -> list[str]:
    """What puts `staged` in the place of `table`, in one transaction or one atomic rename."""
    if url.startswith(RENAME_AT_ONCE):
        old = f"{staged}_old"
        return [
            f"CREATE TABLE IF NOT EXISTS {table} LIKE {staged}",
            f"RENAME TABLE {table} TO {old}, {staged} TO {table}",
            f"DROP TABLE {old}",
        ]
    return [f"DROP TABLE IF EXISTS {table}", f"ALTER TABLE {staged} RENAME TO {table.rsplit('.', 1)[-1]}"]


def connect(spark: SparkSession, url: str, properties: Mapping[str, str]):
    """A connection of the driver. Spark has registered the database's driver class when it has written or read there."""
    own = spark._jvm.java.util.Properties()
    for name, value in properties.items():
        if name.lower() not in SPARK_OPTIONS:
            own.setProperty(name, str(value))
    return spark._jvm.java.sql.DriverManager.getConnection(url, own)


def _execute(connection, statements: Sequence[str]) -> None:
    """All statements in one transaction."""
    connection.setAutoCommit(False)
    try:
        statement = connection.createStatement()
        for text in statements:
            statement.execute(text)
        connection.commit()
    except BaseException:
        connection.rollback()
        raise


def _count(connection, table: str) -> int:
    rows = connection.createStatement().executeQuery(f"SELECT COUNT(*) FROM {table}")
    rows.next()
    return rows.getLong(1)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str = "predictions",
    properties: Mapping[str, str] | None = None,
    connections: int = 16,
    batch_size: int = 10_000,
    rows: int | None = None,
) -> None:
    """Replace a database table in two phases: all rows go to a new table beside it, which then takes its place.

    A run that fails leaves the old table whole, and its new table is dropped. A task that is run again after its rows were
    committed would leave them twice: with `rows`, the number there must be, the new table is counted before it is used.
    The rows are shuffled to at most `connections` tasks first, so that the work before the write keeps its parallelism.
    """
    spark, given = df.sparkSession, dict(properties or {})
    staged = f"{table}_new_{uuid.uuid4().hex[:12]}"
    try:
        df.repartition(connections).write.jdbc(
            url, staged, mode="overwrite", properties={"batchsize": str(batch_size), **given}
        )
        connection = connect(spark, url, given)
        try:
            if rows is not None and (found := _count(connection, staged)) != rows:
                raise RuntimeError(f"{staged} has {found} rows, {rows} expected: {table} was left as it is")
            _execute(connection, swap_statements(url, table, staged))
        finally:
            connection.close()
    except Exception as error:
        try:
            connection = connect(spark, url, given)
            try:
                _execute(connection, [f"DROP TABLE IF EXISTS {staged}"])
            finally:
                connection.close()
        except Exception as second:  # the first error is what matters
            error.add_note(f"{staged} could not be dropped: {second}")
        raise
