"""Binding of the driver's TPC-H-style test tables to the logical tables.

The test data (``<sf_dir>/<table>.parquet``) has no customers/orders/logins
schema of its own; this module derives each logical table from it with
Spark.  Every table grows with the data.  The DuckDB text of the same
binding is in :mod:`retail_insights.sources.fixture_sql`; both must change
together.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the binding.
AS_OF = _dt.date(2001, 8, 1)            # last order date at every scale
HISTORY_CUTOFF = _dt.date(2000, 1, 1)   # orders before it form the archive
EVENT_SHIFT_DAYS = 8218                 # moves 2024-01 events to 2001-07
EMAIL_DOMAIN = "@example.com"
IP_PREFIX = "10.0.0."
CHANNELS = ["Email", "Web", "App"]               # by k % 3
ACTIONS = {"view": "Opened", "click": "Clicked", "purchase": "Converted"}
TICKET_STATUSES = ["Open", "Resolved", "Pending"]  # by k % 3
CAMPAIGNS = 5                                    # CampaignID = 'CMP-' || k % 5


class Fixture:
    """Logical tables over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """A test table; its files are listed and its schema read once per binding."""
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))
        return self._raw[name]

    # -- relational tables -------------------------------------------------
    def customers(self) -> DataFrame:
        nation = self.raw("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
        return self.raw("customer").join(nation, "c_nationkey").select(
            F.col("c_custkey").alias("customer_id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit(EMAIL_DOMAIN)).alias("email"),
            "country",
        )

    def orders(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_date"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
        )

    def current_orders(self) -> DataFrame:
        """Orders still in the operational database (from the cutoff on)."""
        return self.orders().filter(F.col("order_date") >= F.lit(HISTORY_CUTOFF))

    def archived_orders(self) -> DataFrame:
        """All other orders; an order without a date is in the archive."""
        return self.orders().filter(
            F.col("order_date").isNull() | (F.col("order_date") < F.lit(HISTORY_CUTOFF)))

    def order_items(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("unit_price"),
        )

    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
        )

    def history(self, orders: DataFrame | None = None) -> DataFrame:
        """The sales archive: the lines of archived orders (or of ``orders``,
        a part of them)."""
        from retail_insights.operators.sales import sales_fact

        return sales_fact(self.archived_orders() if orders is None else orders,
                          self.order_items(), self.products())

    # -- event-derived tables ---------------------------------------------
    def _events(self, types: list[str], days: int | None = None) -> DataFrame:
        """Events of the given types.  ``days`` keeps those of the window that
        ends at the as-of date; the bound stands on the raw time, so that it
        reaches the scan."""
        events = self.raw("events").filter(F.col("event_type").isin(*types))
        if days is not None:
            first = AS_OF - _dt.timedelta(days=days) + _dt.timedelta(days=EVENT_SHIFT_DAYS)
            kind = events.schema["ts"].dataType
            events = events.filter(F.col("ts") >= F.lit(first.isoformat()).cast(kind))
        return events.select(
            "event_id", "user_id", "event_type",
            (F.col("ts") - F.expr(f"INTERVAL {EVENT_SHIFT_DAYS} DAYS")).alias("event_time"),
            F.get_json_object("props", "$.k").cast("int").alias("k"),
        )

    def logins(self, days: int | None = None) -> DataFrame:
        return self._events(["error"], days).select(
            F.col("user_id").alias("customer_id"),
            F.col("event_time").alias("login_date"),
            F.concat(F.lit(IP_PREFIX), F.col("k").cast("string")).alias("ip_address"),
        )

    def campaigns(self, days: int | None = None) -> DataFrame:
        """Campaign documents, one per event: no document grows with a
        customer's activity, and making them needs no shuffle."""
        ev = self._events(list(ACTIONS), days)
        action = F.create_map(*[F.lit(x) for kv in ACTIONS.items() for x in kv])[F.col("event_type")]
        interaction = F.struct(
            F.concat(F.lit("I"), F.col("event_id").cast("string")).alias("InteractionID"),
            F.col("event_time").alias("Timestamp"),
            _pick(CHANNELS, F.col("k")).alias("Channel"),
            action.alias("Action"),
        )
        return ev.select(
            F.col("user_id").alias("CustomerID"),
            F.concat(F.lit("CMP-"), (F.col("k") % CAMPAIGNS).cast("string")).alias("CampaignID"),
            F.struct(
                (F.col("event_type") == "view").cast("int").alias("Opens"),
                (F.col("event_type") == "click").cast("int").alias("Clicks"),
            ).alias("Engagement"),
            F.array(interaction).alias("Interactions"),
        )

    def support(self, days: int | None = None) -> DataFrame:
        return self._events(["error"], days).select(
            F.col("user_id").alias("CustomerID"),
            F.concat(F.lit("T"), F.col("event_id").cast("string")).alias("TicketID"),
            F.col("event_time").alias("Timestamp"),
            F.struct(_pick(TICKET_STATUSES, F.col("k")).alias("Status")).alias("Issue"),
        )


def _pick(values: list[str], k: Column) -> Column:
    """``values[k % len(values)]``."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (k % len(values)) + 1)
