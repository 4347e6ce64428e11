"""The fixture binding of :mod:`retail_insights.sources.fixture` as DuckDB
SQL, for the oracle queries in ``__spark_entry__.oracle_sql``.

Each oracle query is ``WITH <BINDING>, ... SELECT ...`` over the driver's
pre-registered views.  Type rules: ranks, years and months are INTEGER,
counts BIGINT, money sums are cast to the decimal type Spark derives, and
ratios are divided as DOUBLE (see ``retail_insights.functions.metrics``).
"""

from retail_insights.sources import fixture as fx

AS_OF_SQL = f"DATE '{fx.AS_OF.isoformat()}'"
CUTOFF_SQL = f"DATE '{fx.HISTORY_CUTOFF.isoformat()}'"


def since(days: int) -> str:
    """Start of a ``days``-day window ending at the fixture's as-of date."""
    return f"({AS_OF_SQL} - INTERVAL {days} DAY)"


def _case_pick(values: list[str], expr: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} % {len(values)} {whens} END"


_ACTION_SQL = "CASE event_type " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in fx.ACTIONS.items()) + " END"
_ENGAGEMENT_TYPES = ", ".join(f"'{k}'" for k in fx.ACTIONS)

BINDING = f"""
b_customers AS (
    SELECT c.c_custkey AS customer_id,
           split_part(c.c_name, '#', 1) AS first_name,
           split_part(c.c_name, '#', 2) AS last_name,
           'c' || CAST(c.c_custkey AS VARCHAR) || '{fx.EMAIL_DOMAIN}' AS email,
           n.n_name AS country
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
),
b_orders AS (
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
           CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount
    FROM orders
),
b_items AS (
    SELECT l_orderkey AS order_id, l_partkey AS product_id,
           CAST(l_quantity AS INTEGER) AS quantity,
           CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price
    FROM lineitem
),
b_products AS (
    SELECT p_partkey AS product_id, p_name AS name, p_type AS category FROM part
),
b_sales AS (
    SELECT o.order_id, o.customer_id, o.order_date, i.product_id, i.quantity, i.unit_price,
           CAST(i.quantity * i.unit_price AS DECIMAL(21,2)) AS sales_amount,
           CAST(year(o.order_date) AS INTEGER) AS order_year,
           CAST(month(o.order_date) AS INTEGER) AS order_month
    FROM b_orders o
    JOIN b_items i ON o.order_id = i.order_id
    JOIN b_products p ON i.product_id = p.product_id
),
b_current_sales AS (
    SELECT * FROM b_sales WHERE order_date >= {CUTOFF_SQL}
),
b_events AS (
    SELECT event_id, user_id, event_type,
           ts - INTERVAL {fx.EVENT_SHIFT_DAYS} DAY AS event_time,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events
),
b_logins AS (
    SELECT user_id AS customer_id, event_time AS login_date,
           '{fx.IP_PREFIX}' || CAST(k AS VARCHAR) AS ip_address
    FROM b_events WHERE event_type = 'error'
),
b_interactions AS (
    SELECT user_id AS CustomerID,
           'CMP-' || CAST(k % {fx.CAMPAIGNS} AS VARCHAR) AS CampaignID,
           CAST(event_type = 'view' AS INTEGER) AS Opens,
           CAST(event_type = 'click' AS INTEGER) AS Clicks,
           'I' || CAST(event_id AS VARCHAR) AS InteractionID,
           event_time AS Timestamp,
           {_case_pick(fx.CHANNELS, 'k')} AS Channel,
           {_ACTION_SQL} AS Action
    FROM b_events WHERE event_type IN ({_ENGAGEMENT_TYPES})
),
b_tickets AS (
    SELECT user_id AS CustomerID, 'T' || CAST(event_id AS VARCHAR) AS TicketID, event_time AS Timestamp,
           {_case_pick(fx.TICKET_STATUSES, 'k')} AS Status
    FROM b_events WHERE event_type = 'error'
)"""


def query(*ctes: str, select: str) -> str:
    """``WITH <binding>, <ctes> <select>``."""
    parts = [BINDING.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + select.strip()
