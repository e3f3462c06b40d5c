"""Operators on transactions: items, purchases, labels, customers and derived columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from riskflow.functions import columns as X
from riskflow.operators.skew import Heavy, first_per_key, heavy_keys, in_parts, lookup, repeat_rows, to_part
from riskflow.schemas import SCHEMAS

# Which row stands for a customer id that occurs more than once.
CUSTOMER_ORDER = ["first_join_date", "age", "gender"]


def row_hash(transactions: DataFrame) -> Column:
    """One hash over all transaction columns that a table has."""
    own = {name for name in transactions.columns if name in SCHEMAS["transactions"].fieldNames()}
    return F.xxhash64(*sorted(own))


def transaction_order(whole_row: Column, item_hash: Column | None = None) -> list[Column]:
    """Which row stands for a transaction id that occurs more than once: the first in this order.

    `whole_row` comes last, so that the order is total: rows that tie are equal in all transaction columns.
    """
    item_hash = F.xxhash64("product_metadata") if item_hash is None else item_hash
    return [F.col("session_id"), F.col("created_at"), F.col("customer_id"), item_hash, F.col("total_amount"), whole_row]


def transaction_items(transactions: DataFrame) -> DataFrame:
    """One row per item in product_metadata."""
    return transactions.select("transaction_id", F.inline(X.items(F.col("product_metadata"))))


def purchases(transactions: DataFrame) -> DataFrame:
    """Number of pieces bought per transaction id; ids without a readable item are left out."""
    quantities = X.item_quantities(F.col("product_metadata"))
    return (
        transactions.select("transaction_id", quantities.alias("quantities"))
        .filter("transaction_id is not null and size(quantities) > 0")
        .groupBy("transaction_id")
        .agg(F.sum(X.array_total(F.col("quantities"))).alias("purchases_count"))
    )


def add_purchases_count(features: DataFrame, transactions: DataFrame, heavy: Heavy | None = None) -> DataFrame:
    """Add purchases_count; rows without a readable item are dropped."""
    heavy = heavy if heavy is not None else heavy_keys(features, "transaction_id")
    return lookup(features, purchases(transactions), "transaction_id", heavy["transaction_id"])


def add_geolocation(features: DataFrame) -> DataFrame:
    return features.withColumn(
        "geolocation", X.geolocation(F.col("shipment_location_lat"), F.col("shipment_location_long"))
    )


def customer_profile(customers: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Age, year of joining and gender. An unreadable join date gives a null year."""
    return customers.select(
        "customer_id",
        X.whole_years(F.col("birthdate"), as_of).alias("age"),
        F.year(F.col("first_join_date").try_cast("date")).alias("first_join_year"),
        "gender",
        "first_join_date",
    )


def one_profile_per_customer(customers: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return first_per_key(
        customer_profile(customers, as_of).filter("customer_id is not null"), "customer_id", CUSTOMER_ORDER
    )


def dedup_transactions(features: DataFrame) -> DataFrame:
    """One row per transaction id, the first in `transaction_order`."""
    return first_per_key(features, "transaction_id", transaction_order(F.xxhash64(*sorted(features.columns))))


def enrich_feature_data(
    features: DataFrame,
    session_times: DataFrame,
    customers: DataFrame,
    as_of: dt.date | None = None,
    heavy: Heavy | None = None,
) -> DataFrame:
    """Add geolocation, session times and the customer profile, and keep one row per transaction id.

    Rows without a session in `session_times` or without a customer are dropped. Hashes for the order of rows are made
    before the joins, so that the item JSON is shuffled only for a caller who keeps it.
    """
    heavy = heavy if heavy is not None else heavy_keys(features, "session_id", "customer_id")
    profiles = one_profile_per_customer(customers, as_of)
    hashes = {"_items": F.xxhash64("product_metadata"), "_row": F.xxhash64(*sorted(features.columns))}
    rows = features.withColumns(hashes)
    rows = lookup(rows, session_times, "session_id", heavy["session_id"], spread_by="transaction_id")
    rows = lookup(rows, profiles, "customer_id", heavy["customer_id"], spread_by="transaction_id")
    joined = [c for c in rows.columns if c not in features.columns and c not in hashes]
    order = transaction_order(F.xxhash64("_row", *sorted(joined)), F.col("_items"))
    kept = add_geolocation(first_per_key(rows, "transaction_id", order))
    own = [c for c in rows.columns if c in features.columns]
    return kept.select(*own, "geolocation", *joined)


def spread_for_labels(features: DataFrame, heavy_labels: Heavy) -> DataFrame:
    """Repeat a row once per part of a heavy label id, so that its copies are made in several tasks."""
    heavy = heavy_labels["transaction_id"]
    return in_parts(features, "transaction_id", heavy, "label_part", "label_heavy") if heavy else features


def label_keys(heavy_labels: Heavy) -> list[str]:
    return ["transaction_id", "label_part"] if heavy_labels["transaction_id"] else ["transaction_id"]


def attach_labels(spread: DataFrame, labels: DataFrame, heavy_labels: Heavy) -> DataFrame:
    """Left join of labels to rows from `spread_for_labels`, as counts per id that are then repeated as rows."""
    heavy, keys = heavy_labels["transaction_id"], label_keys(heavy_labels)
    labels = labels.filter("transaction_id is not null")
    if heavy:
        labels = to_part(labels, "transaction_id", heavy, "label_part")
    counted = labels.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_labels"), F.count_if(F.col("is_fraud") == "true").alias("_frauds")
    )
    rows = spread.join(counted, keys, "left")
    if heavy:
        # A part that got no label is not an unlabelled row: a heavy id has labels in other parts.
        rows = rows.filter("_labels is not null or not label_heavy")
    return (
        repeat_rows(rows.withColumn("_labels", F.coalesce("_labels", F.lit(1))), "_labels", "_number")
        .withColumn("is_fraud", F.when(F.col("_number") <= F.col("_frauds"), 1).otherwise(0))
        .drop("label_part", "label_heavy", "_labels", "_frauds", "_number")
    )


def add_fraud_labels(features: DataFrame, labels: DataFrame, heavy: Heavy | None = None) -> DataFrame:
    """Add is_fraud: 1 where the label is exactly "true", else 0, also without a label.

    An id with several labels gives one row per label. Rows of `features` are expected to be spread over ids, as
    they are after `enrich_feature_data`.
    """
    heavy = heavy if heavy is not None else heavy_keys(labels, "transaction_id")
    return attach_labels(spread_for_labels(features, heavy), labels, heavy)


def add_account_and_promo_features(features: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Add account_age in years, age_bin and promo_code_used."""
    return features.withColumns(
        {
            "account_age": X.whole_years(F.col("first_join_date").try_cast("date"), as_of),
            "age_bin": X.age_bin(F.col("age")),
            "promo_code_used": F.when(F.col("promo_code").isNull(), 0).otherwise(1),
        }
    )
