"""Spark-native retail customer analytics.

Every operator in :mod:`retail_insights.operators` is a pure, lazy function
``DataFrame... -> DataFrame`` built from built-in Spark SQL functions, so
Catalyst can push filters into scans, prune columns and pick join strategies,
and AQE can re-plan at run time.  Nothing in an operator triggers an action.
"""

from retail_insights.operators import (  # noqa: F401
    best_customer_products,
    best_customers,
    churn_risk,
    customer_segments,
    flatten_interactions,
    flatten_tickets,
    high_risk_customers,
    omni_channel,
    peak_sales_months,
    product_growth,
    purchase_trend,
    sales_fact,
    top_customers,
    with_history,
    yearly_retention,
    yoy_comparison,
)
