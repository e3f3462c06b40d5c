"""Registered queries over the driver's tables, each with the SQL that gives the same rows in DuckDB.

Every query reads whole tables. Ages are counted to a fixed day, and timestamps leave without a time zone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import TimestampType

from riskflow import constants as C
from riskflow.fixtures import input_cte, input_table
from riskflow.functions import columns as X
from riskflow.operators import geo, marts, ml, sampling, sessions as S, transactions as T, trees
from riskflow.operators.skew import heavy_keys, lookup
from riskflow.plans.features import CLOCK, CLOCK_FROM, feature_table
from riskflow.sources.storage import stored

AS_OF = dt.date(2024, 6, 30)
# Two boosted trees over C.NUMERIC_COLUMNS, with split points and leaves fitted to the labels once.
BOOSTED = [
    trees.TreeNode(*node)
    for node in [
        (0, 0, 2, 467717.234375, 1, 2, None, 1.0),
        (0, 1, 3, 97.5, 3, 4, None, 1.0),
        (0, 2, 4, 26.78499984741211, 5, 6, None, 1.0),
        (0, 3, None, None, None, None, -0.9150909739564752, 1.0),
        (0, 4, None, None, None, None, -0.8707692307692307, 1.0),
        (0, 5, None, None, None, None, 0.6590909090909091, 1.0),
        (0, 6, None, None, None, None, 0.8260869565217391, 1.0),
        (1, 0, 5, 32146.5, 1, 2, None, 0.5),
        (1, 1, 0, 7.5, 3, 4, None, 0.5),
        (1, 2, 4, 13.394999980926514, 5, 6, None, 0.5),
        (1, 3, None, None, None, None, -0.3331633882491908, 0.5),
        (1, 4, None, None, None, None, -0.28660438475559785, 0.5),
        (1, 5, None, None, None, None, -0.1703661938797375, 0.5),
        (1, 6, None, None, None, None, 0.06050779198436567, 0.5),
    ]
]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


class Inputs:
    """The input tables of one test-data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        table = input_table(self.spark, self.sf_dir, name)
        setattr(self, name, table)
        return table

    def features(self, *columns: str) -> DataFrame:
        return feature_table(
            self.transactions, self.browsing_behaviour, self.customer, self.fraud_transaction, AS_OF,
            columns=columns or C.FEATURE_COLUMNS,
        )

    def model_rows(self) -> DataFrame:
        return self.features("transaction_id", *C.CATEGORICAL_COLUMNS, *C.NUMERIC_COLUMNS, C.LABEL_COLUMN)

    def scored(self, *columns: str) -> DataFrame:
        """Features with a rule in place of a model, so that SQL can follow."""
        rule = F.when(F.col("purchases_count") > 100, 1.0).otherwise(0.0)
        return self.features(*columns, "purchases_count", "is_fraud").withColumn("prediction", rule)

    def with_city(self, df: DataFrame) -> DataFrame:
        return geo.add_city_features(df, geo.place_cells(self.places), keys_from=self.transactions)


def query(oracle: str | None = None, inputs: str = ""):
    """Register a query under its function name. `oracle` follows the WITH entries for `inputs`."""

    def register(build: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return without_time_zone(build(Inputs(spark, sf_dir)))

        QUERIES[build.__name__] = run
        if oracle is not None:
            ORACLE_SQL[build.__name__] = oracle_text(inputs.split(), oracle)
        return build

    return register


def without_time_zone(df: DataFrame) -> DataFrame:
    return df.select(
        [
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else f.name
            for f in df.schema.fields
        ]
    )


L1, L2, BROWSING = (
    "(" + ", ".join(f"'{e}'" for e in events) + ")"
    for events in (C.LEVEL_1_EVENTS, C.LEVEL_2_EVENTS, C.BROWSING_EVENTS)
)
AGE_BIN = """case when age < 10 then '<10' when age < 20 then '10-19' when age < 30 then '20-29'
  when age < 40 then '30-39' when age < 50 then '40-49' when age < 60 then '50-59' else '60+' end"""
NAME = "case {0} when 0 then 'Non-Fraud' when 1 then 'Fraud' end"
SQL_HASH = "cast('0x' || substr(md5(transaction_id || ':{0}42'), 1, 8) as bigint) / 4294967296.0"

TABLES = ["customer", "browsing_behaviour", "transactions", "fraud_transaction", "places"]
# Derived WITH entries: what each needs, and its text.
DERIVED = {
    "levels": (
        "browsing_behaviour",
        f"""select *, case when event_type in {L1} then 'L1' when event_type in {L2} then 'L2' else 'L3' end
          as event_level from browsing_behaviour_v""",
    ),
    "counts": (
        "transactions levels",
        """select transaction_id, count(*) filter (where event_level = 'L1') as L1,
          count(*) filter (where event_level = 'L2') as L2, count(*) filter (where event_level = 'L3') as L3
          from transactions_v join levels_v using (session_id) group by transaction_id""",
    ),
    "ratios": (
        "transactions counts",
        """select t.*, cast(L1 as int) as L1_count, cast(L2 as int) as L2_count, cast(L3 as int) as L3_count,
          cast(round(cast(L1 as double) / (L1 + L2 + L3) * 100, 2) as float) as L1_ratio,
          cast(round(cast(L2 as double) / (L1 + L2 + L3) * 100, 2) as float) as L2_ratio
          from transactions_v t left join counts_v using (transaction_id)""",
    ),
    "times": (
        "browsing_behaviour",
        """select *, cast(hour(midpoint_time) as int) as hour, case when hour(midpoint_time) < 6 then 'night'
          when hour(midpoint_time) < 12 then 'morning' when hour(midpoint_time) < 18 then 'afternoon'
          else 'evening' end as time_of_day
          from (select session_id, min(event_time) as start_time, max(event_time) as finish_time,
            make_timestamp(epoch_us(min(event_time))
              + cast(round((epoch_us(max(event_time)) - epoch_us(min(event_time))) / 2.0) as bigint)) as midpoint_time
            from browsing_behaviour_v group by session_id)""",
    ),
    "profile": (
        "customer",
        f"""select customer_id,
          cast(floor(datediff('day', birthdate, date '{AS_OF}') / 365.0) as bigint) as age,
          cast(year(cast(first_join_date as date)) as int) as first_join_year, gender, first_join_date
          from customer_v""",
    ),
    "account": (
        "profile",
        f"""select *, cast(floor(datediff('day', cast(first_join_date as date), date '{AS_OF}') / 365.0) as bigint)
          as account_age, {AGE_BIN} as age_bin from profile_v""",
    ),
    "items": (
        "transactions",
        """select transaction_id, x.product_id as product_id, x.quantity as quantity, x.item_price as item_price
          from (select transaction_id, unnest(from_json(product_metadata,
            '[{"product_id":"INTEGER","quantity":"INTEGER","item_price":"INTEGER"}]')) as x from transactions_v)""",
    ),
    "purchases": (
        "items",
        """select transaction_id, cast(sum(quantity) as bigint) as purchases_count
          from items_v group by transaction_id""",
    ),
    "gaps": (
        "browsing_behaviour",
        f"""select *, epoch_us(event_time) // 1000000 - epoch_us(previous_event_time) // 1000000 as time_spent
          from (select session_id, event_type, event_time, lag(event_time) over (partition by session_id
            order by event_time, coalesce(event_type in {BROWSING}, false) desc, event_type nulls first)
            as previous_event_time from browsing_behaviour_v)""",
    ),
    "browsing": (
        "gaps",
        f"""select session_id, cast(coalesce(sum(time_spent), 0) as bigint) as total_browsing_time
          from gaps_v where event_type in {BROWSING} group by session_id""",
    ),
    "features": (
        "ratios times account purchases browsing fraud_transaction",
        """select r.* exclude (product_metadata),
          cast(shipment_location_lat as varchar) || ',' || cast(shipment_location_long as varchar) as geolocation,
          t.* exclude (session_id), a.* exclude (customer_id), purchases_count, total_browsing_time,
          case when f.is_fraud = 'true' then 1 else 0 end as is_fraud,
          case when promo_code is null then 0 else 1 end as promo_code_used
          from ratios_v r join times_v t using (session_id) join account_v a using (customer_id)
          join purchases_v using (transaction_id) left join fraud_transaction_v f using (transaction_id)
          join browsing_v using (session_id)""",
    ),
    "scored": (
        "features",
        "select *, case when purchases_count > 100 then 1.0::double else 0.0::double end as prediction from features_v",
    ),
    "boosted": (
        "features",
        f"""select *, cast(margin > 0 as int)::double as prediction, 1 / (1 + exp(-2 * margin)) as probability
          from (select *, {trees.margin_sql(BOOSTED, lambda i: f"cast({C.NUMERIC_COLUMNS[i]} as double)")} as margin from features_v)""",
    ),
    "nearest": (
        "transactions places",
        """select lat, long, min(city) as city from (
          select p.lat, p.long, c.city,
            (p.lat - c.lat) * (p.lat - c.lat) + (p.long - c.lon) * (p.long - c.lon) as d,
            min((p.lat - c.lat) * (p.lat - c.lat) + (p.long - c.lon) * (p.long - c.lon))
              over (partition by p.lat, p.long) as least
          from (select distinct shipment_location_lat as lat, shipment_location_long as long from transactions_v) p,
            places_v c) where d = least group by lat, long""",
    ),
    "located": (
        "scored nearest",
        """select s.*, city from scored_v s
          join nearest_v on lat = shipment_location_lat and long = shipment_location_long""",
    ),
    "sample": (
        "features",
        f"select * from features_v where is_fraud = 1 or {SQL_HASH.format('')} < 0.2",
    ),
    "categories": (
        "features",
        """select feature, category, row_number() over (partition by feature order by n desc, category) - 1 as position,
          count(*) over (partition by feature) as categories from (
            select 'payment_method' as feature, payment_method as category, count(*) as n from features_v group by 2
            union all select 'age_bin', age_bin, count(*) from features_v group by 2)""",
    ),
    "indexed": (
        "features categories",
        """select f.*, p.position as payment_method_position, p.categories - 1 as payment_method_size,
          a.position as age_bin_position, a.categories - 1 as age_bin_size from features_v f
          join categories_v p on p.feature = 'payment_method' and p.category = f.payment_method
          join categories_v a on a.feature = 'age_bin' and a.category = f.age_bin""",
    ),
}


def oracle_text(needed: list[str], select: str) -> str:
    order: list[str] = []

    def need(name: str) -> None:
        if name in DERIVED:
            for other in DERIVED[name][0].split():
                need(other)
        if name not in order:
            order.append(name)

    for name in needed:
        need(name)
    if not needed:
        return select
    entries = [f"{n}_v as ({DERIVED[n][1]})" if n in DERIVED else input_cte(n) for n in order]
    return f"with {', '.join(entries)} {select}"


# --- events and sessions ---------------------------------------------------------------------------------------------


@query(
    """select transaction_id, session_id, event_type, count(*) as events
    from transactions_v join browsing_behaviour_v using (session_id) group by all""",
    "transactions browsing_behaviour",
)
def session_event_join(t: Inputs) -> DataFrame:
    return S.session_event_join(t.transactions, t.browsing_behaviour).select(
        "transaction_id", "session_id", "event_type", "events"
    )


@query("select * from levels_v", "levels")
def event_levels(t: Inputs) -> DataFrame:
    return S.with_event_level(t.browsing_behaviour)


@query("select * from counts_v", "counts")
def event_level_pivot(t: Inputs) -> DataFrame:
    return S.event_level_pivot(t.transactions, t.browsing_behaviour)


@query("select transaction_id, session_id, customer_id, L1_count, L2_count, L3_count from ratios_v", "ratios")
def event_level_counts(t: Inputs) -> DataFrame:
    return S.add_event_level_features(t.transactions, t.browsing_behaviour).select(
        "transaction_id", "session_id", "customer_id", *S.COUNTS
    )


@query("select transaction_id, L1_ratio, L2_ratio from ratios_v", "ratios")
def event_level_ratios(t: Inputs) -> DataFrame:
    return S.add_event_level_ratios(S.add_event_level_features(t.transactions, t.browsing_behaviour)).select(
        "transaction_id", "L1_ratio", "L2_ratio"
    )


@query("select * from times_v", "times")
def session_times(t: Inputs) -> DataFrame:
    return S.calculate_session_times(t.browsing_behaviour)


@query("select time_of_day, count(*) as sessions from times_v group by time_of_day", "times")
def time_of_day(t: Inputs) -> DataFrame:
    return S.calculate_session_times(t.browsing_behaviour).groupBy("time_of_day").agg(F.count("*").alias("sessions"))


@query("select * from gaps_v", "gaps")
def event_gaps(t: Inputs) -> DataFrame:
    return S.event_gaps(t.browsing_behaviour)


@query(
    """select transaction_id, session_id, total_browsing_time from transactions_v join browsing_v using (session_id)""",
    "transactions browsing",
)
def browsing_time(t: Inputs) -> DataFrame:
    return S.calculate_browsing_time(t.transactions, t.browsing_behaviour).select(
        "transaction_id", "session_id", "total_browsing_time"
    )


# --- transactions and customers --------------------------------------------------------------------------------------


@query(
    """select transaction_id, cast(shipment_location_lat as varchar) || ',' || cast(shipment_location_long as varchar)
    as geolocation from transactions_v""",
    "transactions",
)
def geolocation(t: Inputs) -> DataFrame:
    return T.add_geolocation(t.transactions).select("transaction_id", "geolocation")


@query("select * from profile_v", "profile")
def customer_profile(t: Inputs) -> DataFrame:
    return T.customer_profile(t.customer, AS_OF)


@query(
    """select t.* exclude (product_metadata),
    cast(shipment_location_lat as varchar) || ',' || cast(shipment_location_long as varchar) as geolocation,
    s.* exclude (session_id), c.* exclude (customer_id)
    from transactions_v t join times_v s using (session_id) join profile_v c using (customer_id)""",
    "transactions times profile",
)
def enriched_transactions(t: Inputs) -> DataFrame:
    times = S.calculate_session_times(t.browsing_behaviour)
    # The clock follows from both times; it is told after the last shuffle. The other columns keep their order.
    rows = T.enrich_feature_data(t.transactions, times.select("session_id", *CLOCK_FROM), t.customer, AS_OF)
    at = rows.columns.index(CLOCK_FROM[-1]) + 1
    # Item order in the JSON text is not defined, so the text itself is not compared.
    return S.with_session_clock(rows).select(*rows.columns[:at], *CLOCK, *rows.columns[at:]).drop("product_metadata")


@query("select * from items_v", "items")
def transaction_items(t: Inputs) -> DataFrame:
    return T.transaction_items(t.transactions)


@query(
    """select transaction_id, cast(list_sum(list_transform(from_json(product_metadata,
      '[{"product_id":"INTEGER","quantity":"INTEGER","item_price":"INTEGER"}]'), lambda x: x.quantity)) as bigint) as purchases_count
    from transactions_v where product_metadata is not null""",
    "transactions",
)
def purchases_count(t: Inputs) -> DataFrame:
    return T.add_purchases_count(t.transactions, t.transactions).select("transaction_id", "purchases_count")


@query(
    """select transaction_id, case when is_fraud = 'true' then 1 else 0 end as is_fraud
    from transactions_v left join fraud_transaction_v using (transaction_id)""",
    "transactions fraud_transaction",
)
def fraud_labels(t: Inputs) -> DataFrame:
    return T.add_fraud_labels(t.transactions, t.fraud_transaction).select("transaction_id", "is_fraud")


@query(
    """select transaction_id, account_age, age_bin, case when promo_code is null then 0 else 1 end as promo_code_used
    from transactions_v join account_v using (customer_id)""",
    "transactions account",
)
def account_promo_features(t: Inputs) -> DataFrame:
    profiles = T.one_profile_per_customer(t.customer, AS_OF)
    heavy = heavy_keys(t.transactions, "customer_id")["customer_id"]
    rows = lookup(t.transactions, profiles, "customer_id", heavy, spread_by="transaction_id")
    return T.add_account_and_promo_features(rows, AS_OF).select(
        "transaction_id", "account_age", "age_bin", "promo_code_used"
    )


@query("select age_bin, count(*) as customers from account_v group by age_bin", "account")
def age_bins(t: Inputs) -> DataFrame:
    return (
        T.customer_profile(t.customer, AS_OF)
        .groupBy(X.age_bin(F.col("age")).alias("age_bin"))
        .agg(F.count("*").alias("customers"))
    )


@query(
    """select * exclude (n) from (select *, row_number() over (partition by transaction_id
      order by session_id, created_at) as n from (
        select transaction_id, session_id, created_at, total_amount from transactions_v
        union all select transaction_id, session_id, created_at - interval 1 day, total_amount from transactions_v
        union all select transaction_id, session_id || 'x', created_at, total_amount from transactions_v))
    where n = 1""",
    "transactions",
)
def dedup_transactions(t: Inputs) -> DataFrame:
    rows = t.transactions
    earlier = rows.withColumn("created_at", F.col("created_at") - F.expr("interval 1 day"))
    elsewhere = rows.withColumn("session_id", F.concat("session_id", F.lit("x")))
    return T.dedup_transactions(rows.unionByName(earlier).unionByName(elsewhere)).select(
        "transaction_id", "session_id", "created_at", "total_amount"
    )


@query("select * from features_v", "features")
def feature_table_all(t: Inputs) -> DataFrame:
    return t.features(*[c for c in C.FEATURE_COLUMNS if c != "product_metadata"])


QUERIES["feature_table"] = QUERIES.pop("feature_table_all")
ORACLE_SQL["feature_table"] = ORACLE_SQL.pop("feature_table_all")


# --- place lookup ----------------------------------------------------------------------------------------------------


@query(
    """select transaction_id, city from transactions_v
    join nearest_v on lat = shipment_location_lat and long = shipment_location_long""",
    "nearest",
)
def nearest_place(t: Inputs) -> DataFrame:
    return t.with_city(t.transactions).select("transaction_id", "city")


# --- summary tables --------------------------------------------------------------------------------------------------


@query(f"select transaction_id, label, {NAME.format('label')} as label_name from "
       "(select transaction_id, cast(cast(transaction_id as bigint) % 3 as int) as label from transactions_v)",
       "transactions")
def label_names(t: Inputs) -> DataFrame:
    # Classes 0, 1 and an unknown 2.
    rows = t.transactions.select("transaction_id", (F.col("transaction_id").cast("long") % 3).cast("int").alias("label"))
    return marts.with_label_name(rows, "label", "label_name")


@query("select transaction_id, is_fraud from features_v where is_fraud = 1", "features")
def label_split(t: Inputs) -> DataFrame:
    return marts.rows_of_class(t.features("transaction_id", "is_fraud"), 1)


@query(f"select {', '.join(C.SERVED_COLUMNS)} from located_v", "located")
def served_predictions(t: Inputs) -> DataFrame:
    columns = [c for c in C.SERVED_COLUMNS if c not in ("city", "prediction", "purchases_count", "is_fraud")]
    return marts.served_predictions(t.with_city(t.scored(*columns)))


@query(
    f"""select {NAME.format('is_fraud')} as is_fraud, avg(purchases_count) as purchases_count
    from features_v group by features_v.is_fraud""",
    "features",
)
def avg_purchases_by_label(t: Inputs) -> DataFrame:
    return marts.average_purchases_by_label(t.features("purchases_count", "is_fraud"))


@query(
    """select payment_method, count(*) as total_transactions, count(*) filter (where is_fraud = 'true') as fraud_count,
    count(*) filter (where is_fraud = 'true') / cast(count(*) as double) * 100 as fraud_rate
    from transactions_v left join fraud_transaction_v using (transaction_id) group by payment_method""",
    "transactions fraud_transaction",
)
def payment_method_fraud_rate(t: Inputs) -> DataFrame:
    return marts.payment_method_fraud_rate(T.add_fraud_labels(t.transactions, t.fraud_transaction))


@query(
    f"""select {NAME.format('is_fraud')} as actual, count(*) filter (where prediction = 1) as "Fraud",
    count(*) filter (where prediction = 0) as "Non-Fraud" from scored_v group by is_fraud""",
    "scored",
)
def confusion_matrix(t: Inputs) -> DataFrame:
    return marts.confusion_matrix(t.scored())


@query(
    f"""select label, bin, lo + bin * w as bin_start, count(*) as transactions,
    count(*) / cast(sum(count(*)) over (partition by label) as double) * 100 as percent
    from (select label, lo, w, case when w > 0 then least(cast(floor((v - lo) / w) as bigint), 49) else 0 end as bin
      from (select {NAME.format('is_fraud')} as label, cast(purchases_count as double) as v,
        min(cast(purchases_count as double)) over () as lo,
        (max(cast(purchases_count as double)) over () - min(cast(purchases_count as double)) over ()) / 50.0::double as w
        from scored_v)) group by label, bin, lo, w""",
    "scored",
)
def purchases_histogram(t: Inputs) -> DataFrame:
    return marts.purchases_histogram(t.scored())


@query(
    """select shipment_location_lat, shipment_location_long, city, is_fraud,
    case when is_fraud = 1 then 255 else 0 end as red, 0 as green, case when is_fraud = 1 then 0 else 255 end as blue
    from located_v""",
    "located",
)
def map_points(t: Inputs) -> DataFrame:
    points = marts.map_points(t.with_city(t.scored("shipment_location_lat", "shipment_location_long")))
    channels = [F.col("color")[i].alias(name) for i, name in enumerate(["red", "green", "blue"])]
    return points.select(*C.MAP_COLUMNS, *channels)


@query(
    """select round(coalesce(avg(shipment_location_lat), 0), 6) as latitude,
    round(coalesce(avg(shipment_location_long), 0), 6) as longitude from features_v where is_fraud = 1""",
    "features",
)
def map_center(t: Inputs) -> DataFrame:
    points = marts.rows_of_class(t.features("shipment_location_lat", "shipment_location_long", "is_fraud"), 1)
    # A float mean depends on the order of summing in its last digits.
    return marts.map_center(points).select(F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"))


# --- sampling and models ---------------------------------------------------------------------------------------------


@query(
    f"select transaction_id, {', '.join([*C.CATEGORICAL_COLUMNS, *C.NUMERIC_COLUMNS])}, is_fraud from sample_v", "sample"
)
def balanced_sample(t: Inputs) -> DataFrame:
    return sampling.balanced_sample(t.model_rows(), key="transaction_id").select(
        "transaction_id", *C.CATEGORICAL_COLUMNS, *C.NUMERIC_COLUMNS, C.LABEL_COLUMN
    )


@query(
    f"""select transaction_id, is_fraud, case when {SQL_HASH.format('split:')} < 0.8 then 'train' else 'test' end as part
    from sample_v""",
    "sample",
)
def train_test_split(t: Inputs) -> DataFrame:
    train, test = sampling.balanced_train_test_split(t.model_rows(), key="transaction_id")
    return (
        train.withColumn("part", F.lit("train"))
        .unionByName(test.withColumn("part", F.lit("test")))
        .select("transaction_id", "is_fraud", "part")
    )


def assembled(t: Inputs) -> DataFrame:
    rows = stored(t.model_rows())
    return Pipeline(stages=ml.feature_stages()).fit(rows).transform(rows)


@query(
    """select transaction_id, cast(payment_method_position as double) as payment_method_index,
    cast(age_bin_position as double) as age_bin_index from indexed_v""",
    "indexed",
)
def string_index(t: Inputs) -> DataFrame:
    return assembled(t).select("transaction_id", "payment_method_index", "age_bin_index")


@query(
    """select transaction_id, 'payment_method' as feature, cast(payment_method_position as int) as position
    from indexed_v where payment_method_position < payment_method_size
    union all select transaction_id, 'age_bin', cast(age_bin_position as int)
    from indexed_v where age_bin_position < age_bin_size""",
    "indexed",
)
def one_hot(t: Inputs) -> DataFrame:
    rows = assembled(t)
    features = [
        F.struct(F.lit(c).alias("feature"), vector_to_array(F.col(f"{c}_vec")).alias("values"))
        for c in C.CATEGORICAL_COLUMNS
    ]
    return (
        rows.select("transaction_id", F.inline(F.array(*features)))
        .select("transaction_id", "feature", F.posexplode("values").alias("position", "value"))
        .filter("value = 1")
        .drop("value")
    )


@query(
    f"""select transaction_id, cast(position as int) as position, value from (
      select transaction_id, range as position, case when range = payment_method_position then 1.0::double
        else 0.0::double end as value from indexed_v, range(100) where range < payment_method_size
      union all select transaction_id, payment_method_size + range, case when range = age_bin_position then 1.0::double
        else 0.0::double end from indexed_v, range(100) where range < age_bin_size
      union all select transaction_id, payment_method_size + age_bin_size + range, [{', '.join(
        f'cast({c} as double)' for c in C.NUMERIC_COLUMNS)}][range + 1] from indexed_v, range({len(C.NUMERIC_COLUMNS)}))""",
    "indexed",
)
def feature_vector(t: Inputs) -> DataFrame:
    return assembled(t).select(
        "transaction_id", F.posexplode(vector_to_array("features")).alias("position", "value")
    )


def fitted(name: str, train: DataFrame) -> PipelineModel:
    """The pipeline fitted to the rows. They are read many times, so they are chosen once and stored."""
    return ml.create_ml_pipelines()[name].fit(stored(train.drop("transaction_id")))


def gbt_scores(t: Inputs) -> tuple[DataFrame, DataFrame]:
    """All rows scored by boosted trees, and the held-out rows among them."""
    rows = stored(t.model_rows())
    train, test = sampling.split(sampling.balanced_sample(rows, key="transaction_id"), key="transaction_id")
    model = fitted("gbt_pipeline", train)
    return model.transform(rows), model.transform(test)


@query(
    f"""select transaction_id, is_fraud, true as class_known from sample_v
    where {SQL_HASH.format('split:')} >= 0.8""",
    "sample",
)
def rf_train_score(t: Inputs) -> DataFrame:
    sample = stored(sampling.balanced_sample(t.model_rows(), key="transaction_id"))
    train, test = sampling.split(sample, key="transaction_id")
    model = fitted("rf_pipeline", train)
    return model.transform(test).select("transaction_id", "is_fraud", F.col("prediction").isin(0.0, 1.0).alias("class_known"))


@query("select transaction_id, true as consistent, true as in_range from features_v", "features")
def score_transactions(t: Inputs) -> DataFrame:
    probability = vector_to_array("probability")[1]
    return gbt_scores(t)[0].select(
        "transaction_id",
        (F.col("prediction") == (probability > 0.5).cast("double")).alias("consistent"),
        probability.between(0, 1).alias("in_range"),
    )


def boosted_scores(t: Inputs, *columns: str) -> DataFrame:
    """The features scored by the fixed trees."""
    feature = lambda i: F.col(C.NUMERIC_COLUMNS[i]).cast("double")
    rows = t.features(*columns, *C.NUMERIC_COLUMNS)
    scored = rows.withColumns({"margin": trees.margin(BOOSTED, feature), "probability": trees.boosted_probability(BOOSTED, feature)})
    return scored.withColumn("prediction", F.when(F.col("margin") > 0, 1.0).otherwise(0.0))


@query("select transaction_id, prediction, round(probability, 9) as fraud_probability from boosted_v", "boosted")
def raw_scores(t: Inputs) -> DataFrame:
    return boosted_scores(t, "transaction_id").select("transaction_id", "prediction", F.round("probability", 9).alias("fraud_probability"))


@query(
    """select round(sum(n * (2 * above + p)) / cast(2.0 * any_value(positives) * any_value(negatives) as double), 9) as area,
    cast(any_value(positives) as bigint) as positives, cast(any_value(negatives) as bigint) as negatives
    from (select *, sum(p) over () as positives, sum(n) over () as negatives,
        coalesce(sum(p) over (order by score desc rows between unbounded preceding and 1 preceding), 0) as above
      from (select round(probability, 9) as score, count(*) filter (where is_fraud = 1) as p, count(*) filter (where is_fraud = 0) as n
        from boosted_v group by 1))""",
    "boosted",
)
def roc_area(t: Inputs) -> DataFrame:
    scored = boosted_scores(t, "is_fraud").select("is_fraud", F.round("probability", 9).alias("score"))
    return ml.area_under_roc(scored, "score").withColumn("area", F.round("area", 9))


@query(
    f"""select mart, label, item, n, round(value, 6) as value from (
      select 'confusion_matrix' as mart, {NAME.format('is_fraud')} as label, {NAME.format('prediction::int')} as item, count(*) as n, null::double as value
        from scored_v group by 2, 3
      union all select 'fraud_rate', null, payment_method, count(*), count(*) filter (where is_fraud = 1) / cast(count(*) as double) * 100
        from scored_v group by payment_method
      union all select 'average_purchases', {NAME.format('is_fraud')}, null, count(*), avg(purchases_count) from scored_v group by is_fraud
      union all select 'histogram', label, cast(bin as varchar), count(*), count(*) / cast(sum(count(*)) over (partition by label) as double) * 100
        from (select label, case when w > 0 then least(cast(floor((v - lo) / w) as bigint), 49) else 0 end as bin
          from (select {NAME.format('is_fraud')} as label, cast(purchases_count as double) as v,
            min(cast(purchases_count as double)) over () as lo,
            (max(cast(purchases_count as double)) over () - min(cast(purchases_count as double)) over ()) / 50.0::double as w
            from scored_v)) group by label, bin
      union all select 'map_center', null, 'latitude', count(*), coalesce(avg(shipment_location_lat), 0) from scored_v where is_fraud = 1
      union all select 'map_center', null, 'longitude', count(*), coalesce(avg(shipment_location_long), 0) from scored_v where is_fraud = 1)""",
    "scored",
)
def dashboard_marts(t: Inputs) -> DataFrame:
    """All summary tables of the dashboard from one aggregation."""
    scored = t.scored("payment_method", "shipment_location_lat", "shipment_location_long")
    return marts.dashboard_marts(scored).withColumn("value", F.round("value", 6))


@query("select true as accuracy_holds, true as f1_holds, true as auc_holds")
def held_out_quality(t: Inputs) -> DataFrame:
    """Whether boosted trees find a rule in the features: the metrics on held-out rows must be far above guessing.

    The labels are made by the rule, as those of the fixtures are chosen by id for the most part.
    """
    rule = (F.col("total_amount") > 200_000) | (F.col("purchases_count") > 130)
    rows = stored(t.model_rows().withColumn(C.LABEL_COLUMN, rule.cast("int")))
    train, test = sampling.split(rows, key="transaction_id")
    scored = stored(fitted("gbt_pipeline", train).transform(test).select("is_fraud", "prediction", "rawPrediction", "probability"))
    quality = ml.evaluate(scored)
    quality["areaUnderROC"] = ml.area_under_roc(scored.withColumn("score", vector_to_array("probability")[1]), "score").first()["area"]
    floors = {"accuracy": 0.95, "f1": 0.95, "areaUnderROC": 0.97}
    found = [quality[name] >= floor for name, floor in floors.items()]
    return t.spark.createDataFrame([tuple(map(bool, found))], "accuracy_holds boolean, f1_holds boolean, auc_holds boolean")
