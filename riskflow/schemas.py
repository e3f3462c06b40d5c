"""Declared schemas of the input datasets, all fields nullable."""

from pyspark.sql.types import StructType


def _schema(**columns: str) -> StructType:
    schema = StructType()
    for name, type_name in columns.items():
        schema.add(name, type_name)
    return schema


SCHEMAS = {
    "category": _schema(category_id="integer", cat_level1="string", cat_level2="string", cat_level3="string"),
    "customer": _schema(
        customer_id="integer",
        first_name="string",
        last_name="string",
        username="string",
        email="string",
        gender="string",
        birthdate="date",
        first_join_date="string",
    ),
    "product": _schema(
        product_id="integer",
        gender="string",
        baseColour="string",
        season="string",
        usage="string",
        year="integer",
        productDisplayName="string",
        category_id="integer",
    ),
    "browsing_behaviour": _schema(
        session_id="string",
        event_type="string",
        event_time="timestamp",
        traffic_source="string",
        device_type="string",
    ),
    "transactions": _schema(
        created_at="timestamp",
        customer_id="integer",
        transaction_id="string",
        session_id="string",
        product_metadata="string",
        payment_method="string",
        payment_status="string",
        promo_amount="float",
        promo_code="string",
        shipment_fee="float",
        shipment_location_lat="double",
        shipment_location_long="double",
        total_amount="float",
        clear_payment="integer",
    ),
    "fraud_transaction": _schema(transaction_id="string", is_fraud="string"),
}

# JSON held in transactions.product_metadata.
ITEMS_DDL = "array<struct<product_id:int, quantity:int, item_price:int>>"
