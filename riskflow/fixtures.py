"""Views that build the engine's input tables from the driver's test tables.

The texts run in Spark and in DuckDB alike. A name in braces is a source table; doubled braces are literal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "customer": """
select cast(c_custkey as int) as customer_id, c_name as username,
  case when c_custkey % 2 = 0 then 'F' else 'M' end as gender,
  date '1950-01-01' + cast((c_custkey * 37) % 22000 as int) as birthdate,
  cast(date '2012-01-01' + cast((c_custkey * 13) % 4000 as int) as string) as first_join_date
from {customer}""",
    # Event type 'error' becomes null on purpose.
    "browsing_behaviour": """
select cast(user_id as string) || '-' || cast(day(ts) as string) as session_id,
  case event_type
    when 'purchase' then (case event_id % 3 when 0 then 'AP' when 1 then 'ATC' else 'CO' end)
    when 'view' then (case event_id % 4 when 0 then 'VC' when 1 then 'VP' when 2 then 'VI' else 'SER' end)
    when 'click' then 'SCR' when 'signup' then 'HP' else null end as event_type,
  cast(ts as timestamp) as event_time,
  case when event_id % 3 = 0 then 'WEB' else 'MOBILE' end as traffic_source,
  case when event_id % 2 = 0 then 'Android' else 'iOS' end as device_type
from {events}""",
    "transactions": """
select cast(o_orderdate as timestamp) as created_at, cast(o_custkey as int) as customer_id,
  cast(o_orderkey as string) as transaction_id,
  cast(cast(floor(o_custkey / 10) as int) as string) || '-' || cast(1 + o_orderkey % 30 as string) as session_id,
  product_metadata,
  case substr(o_orderpriority,1,1) when '1' then 'Credit Card' when '2' then 'Debit Card'
    when '3' then 'Gopay' when '4' then 'OVO' else 'LinkAja' end as payment_method,
  case when o_orderstatus = 'P' then 'Failed' else 'Success' end as payment_status,
  cast(case when o_orderkey % 3 = 0 then 500 + o_orderkey % 7 else 0 end as float) as promo_amount,
  case when o_orderkey % 3 = 0 then 'PROMO' || cast(o_orderkey % 7 as string) end as promo_code,
  cast(o_orderkey % 5 * 1000 as float) as shipment_fee,
  cast(-600 + o_custkey * 7 % 1200 as double) / cast(10 as double) as shipment_location_lat,
  cast(-1700 + o_custkey * 11 % 3400 as double) / cast(10 as double) as shipment_location_long,
  cast(o_totalprice as float) as total_amount,
  case when o_orderstatus = 'P' then 0 else 1 end as clear_payment
from {orders} left join (
  select l_orderkey, '[' || string_agg(e, ',') || ']' as product_metadata from (
    select l_orderkey, '{{"product_id":' || cast(l_partkey as string)
      || ',"quantity":' || cast(cast(l_quantity as int) as string)
      || ',"item_price":' || cast(cast(floor(l_extendedprice) as int) as string) || '}}' as e
    from {lineitem}) t group by l_orderkey) items_v on l_orderkey = o_orderkey""",
    "fraud_transaction": """
select cast(o_orderkey as string) as transaction_id,
  case when o_orderkey % 20 = 0 or o_totalprice > 470000 then 'true' else 'false' end as is_fraud
from {orders} where o_orderkey % 7 <> 3""",
    "places": """
select s_name as city,
  cast(-600 + s_suppkey * 37 % 1200 as double) / cast(10 as double) as lat,
  cast(-1700 + s_suppkey * 113 % 3400 as double) / cast(10 as double) as lon
from {supplier}""",
}

SOURCES = ["customer", "events", "orders", "lineitem", "supplier"]


def input_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table as a DataFrame over the driver's parquet files. Sets the session time zone to UTC.

    Items are dealt out by order as numbers, before the view makes longer texts of them.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    text = VIEWS[name]
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in SOURCES if "{%s}" % t in text}
    if "lineitem" in used:
        used["lineitem"] = used["lineitem"].repartition("l_orderkey")
    return spark.sql(text, **used)


def input_cte(*names: str) -> str:
    """The same tables as WITH entries for DuckDB, each named `<name>_v`."""
    return ", ".join(f"{n}_v as ({VIEWS[n].format(**{t: t for t in SOURCES})})" for n in names)
