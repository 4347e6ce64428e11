"""Declared schemas of the logical tables the operators consume.

The source systems declare none; these are the types the bronze layer
binds.  Operators only rely on column names, so any key type and either
timestamp kind (``timestamp`` or ``timestamp_ntz``) works.
"""

from pyspark.sql import types as T

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("country", T.StringType()),
])

ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("order_date", T.TimestampType()),
    T.StructField("total_amount", T.DecimalType(12, 2)),
])

ORDER_ITEMS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", T.DecimalType(10, 2)),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("category", T.StringType()),
])

LOGIN_HISTORY = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("login_date", T.TimestampType()),
    T.StructField("ip_address", T.StringType()),
])

INTERACTION = T.StructType([
    T.StructField("InteractionID", T.StringType()),
    T.StructField("Timestamp", T.TimestampType()),
    T.StructField("Channel", T.StringType()),
    T.StructField("Action", T.StringType()),
])

ENTERPRISE_CAMPAIGN = T.StructType([
    T.StructField("CustomerID", T.LongType()),
    T.StructField("CampaignID", T.StringType()),
    T.StructField("Engagement", T.StructType([
        T.StructField("Opens", T.IntegerType()),
        T.StructField("Clicks", T.IntegerType()),
    ])),
    T.StructField("Interactions", T.ArrayType(INTERACTION)),
])

CUSTOMER_SUPPORT = T.StructType([
    T.StructField("CustomerID", T.LongType()),
    T.StructField("TicketID", T.StringType()),
    T.StructField("Timestamp", T.TimestampType()),
    T.StructField("Issue", T.StructType([T.StructField("Status", T.StringType())])),
])

# Sales fact, current and historical alike (same nine columns, same order).
SALES = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("order_date", T.TimestampType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", T.DecimalType(10, 2)),
    T.StructField("sales_amount", T.DecimalType(21, 2)),
    T.StructField("order_year", T.IntegerType()),
    T.StructField("order_month", T.IntegerType()),
])

SALES_COLUMNS = [f.name for f in SALES.fields]

#: Declared schemas by dataset name, for jobs that name one (``--schema``).
DATASETS = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "login_history": LOGIN_HISTORY,
    "customer_support": CUSTOMER_SUPPORT,
    "enterprise_campaign": ENTERPRISE_CAMPAIGN,
    "sales": SALES,
}


def declared_schema(text: str) -> T.StructType:
    """The schema of a dataset in :data:`DATASETS`, or one written as DDL
    (``id long, amount decimal(10,2)``)."""
    if text in DATASETS:
        return DATASETS[text]
    return T.StructType.fromDDL(text)
