"""The feature table: one row per labelled transaction."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from riskflow import constants as C
from riskflow.functions import columns as X
from riskflow.operators import sessions as S, transactions as T
from riskflow.operators.skew import heavy_keys, lookup, no_repeats
from riskflow.schemas import SCHEMAS
from riskflow.sources.readers import load_checked_data, load_data, read_checked_csv, read_labels


def feature_table(
    transactions: DataFrame,
    events: DataFrame,
    customers: DataFrame,
    labels: DataFrame,
    as_of: dt.date | None = None,
    browsing_events: Sequence[str] = C.BROWSING_EVENTS,
    columns: Sequence[str] = tuple(C.FEATURE_COLUMNS),
    unique_ids: bool | None = None,
) -> DataFrame:
    """All features in one pass over each input.

    Equal to `feature_table_stepwise`, but the events are read once and transactions are shuffled once per key. Name
    only the needed `columns`, so that the rest (such as the item JSON) is not shuffled. Where transaction_id does not
    repeat, the steps that merge rows of one id are left out. That is measured, unless the caller states it in
    `unique_ids`.
    """
    transactions = transactions.filter("transaction_id is not null")
    if unique_ids is None:
        unique_ids = no_repeats(transactions, "transaction_id")
    heavy = heavy_keys(transactions, "session_id", "customer_id")
    heavy_labels = heavy_keys(labels, "transaction_id")
    id_keys = T.label_keys(heavy_labels)
    sessions = S.session_rollup(events, browsing_events).withColumn("in_session", F.lit(True))
    profiles = T.one_profile_per_customer(customers, as_of).withColumn("known_customer", F.lit(True))
    how = "inner" if unique_ids else "left"

    rows = _sold(transactions, columns)
    rows = lookup(rows, sessions, "session_id", heavy["session_id"], how, spread_by="transaction_id")
    rows = lookup(rows, profiles, "customer_id", heavy["customer_id"], how, spread_by="transaction_id")
    rows = T.spread_for_labels(rows, heavy_labels)

    def finished(rows: DataFrame) -> DataFrame:
        counts = [F.col(level).cast("int").alias(count) for level, count in zip(S.LEVELS, S.COUNTS)]
        # The condition on items needs the session too, so that it is not tested below the join by reading the JSON again.
        rows = rows.filter("listed > 0").filter("if(listed > 0, items > 0, false)").withColumnRenamed("pieces", "purchases_count")
        rows = S.add_event_level_ratios(rows.select("*", *counts))
        if set(CLOCK_FROM) <= set(rows.columns):
            rows = S.with_session_clock(rows)
        return T.add_account_and_promo_features(T.attach_labels(rows, labels, heavy_labels), as_of).select(*columns)

    return finished(rows if unique_ids else _merged(rows, id_keys, columns))


def _sold(transactions: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The transaction columns that are carried on, with the number of items and pieces read from the JSON."""
    needed = {"transaction_id", "session_id", "customer_id", "created_at", "total_amount", "promo_code", *columns}
    return (
        T.add_geolocation(transactions)
        .withColumn("quantities", X.item_quantities(F.col("product_metadata")))
        .select(
            *[c for c in transactions.columns if c in needed],
            "geolocation",
            F.xxhash64("product_metadata").alias("item_hash"),
            T.row_hash(transactions).alias("row_hash"),
            F.greatest(F.size("quantities"), F.lit(0)).alias("items"),
            X.array_total(F.col("quantities")).alias("pieces"),
        )
    )


SUMMED = [*S.LEVELS, "pieces", "items"]
COMPLETE = "in_session and known_customer"
CLOCK_FROM = ["start_time", "finish_time"]
CLOCK = ["midpoint_time", "hour", "time_of_day"]


def _merged(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per id: events and pieces summed over all its rows, the rest from its first complete row.

    Rows of one id are merged before the shuffle as well as after it, so no task has to hold all of them. A row carries
    the columns of its order once, and others only if `columns` need them.
    """
    order = T.transaction_order(F.col("row_hash"), F.col("item_hash"))
    needed = {*columns, "listed", "first_join_date", "age", "promo_code", "label_heavy", *(CLOCK_FROM if {*CLOCK} & {*columns} else [])}
    ordering = ["session_id", "created_at", "customer_id", "item_hash", "total_amount", "row_hash"]
    others = [c for c in rows.columns if c in needed and c not in [*keys, *SUMMED, *ordering]]
    merged = rows.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in SUMMED], F.min(F.when(F.expr(COMPLETE), F.struct(*order, *others))).alias("kept")
    )
    return merged.filter("kept is not null").select(*keys, *SUMMED, "kept.*")


def feature_table_stepwise(
    transactions: DataFrame,
    events: DataFrame,
    customers: DataFrame,
    labels: DataFrame,
    as_of: dt.date | None = None,
    browsing_events: Sequence[str] = C.BROWSING_EVENTS,
) -> DataFrame:
    """The feature table as a chain of the single operators. It defines the result; `feature_table` is faster."""
    heavy = heavy_keys(transactions, "session_id", "customer_id", "transaction_id")
    rows = S.add_event_level_ratios(S.add_event_level_features(transactions, events, heavy))
    rows = T.enrich_feature_data(rows, S.calculate_session_times(events), customers, as_of, heavy)
    rows = T.add_purchases_count(rows, transactions, heavy)
    rows = T.add_account_and_promo_features(T.add_fraud_labels(rows, labels), as_of)
    rows = S.calculate_browsing_time(rows, events, browsing_events, heavy)
    return rows.select(*C.FEATURE_COLUMNS)


def preprocess_data(
    spark: SparkSession,
    data_paths: Mapping[str, str],
    schemas: Mapping[str, StructType] = SCHEMAS,
    as_of: dt.date | None = None,
    csv_options: Mapping[str, str] | None = None,
    max_bad_share: float | None = None,
    work_dir: str | None = None,
    **feature_options: object,
) -> DataFrame:
    """The feature table from CSV files. `csv_options` go to the reader, such as `escape='"'` for doubled quotes.

    With `max_bad_share`, each file is read once into a stored table, rows that do not fit their schema are left out, and
    more than that share of them in a file is an error. Without it unreadable fields are null, as Spark reads them.
    """
    options = dict(csv_options or {})
    if max_bad_share is None:
        tables = load_data(spark, data_paths, schemas, **options)
        labels = read_labels(spark, data_paths["fraud_transaction"], **options)
    else:
        limits = {"max_bad_share": max_bad_share, "work_dir": work_dir, **options}
        used = {name: data_paths[name] for name in ("transactions", "browsing_behaviour", "customer")}
        tables = {name: found.good for name, found in load_checked_data(spark, used, schemas, **limits).items()}
        labels = read_checked_csv(spark, data_paths["fraud_transaction"], **limits).good
    return feature_table(
        tables["transactions"],
        tables["browsing_behaviour"],
        tables["customer"],
        labels,
        as_of,
        **feature_options,
    )
