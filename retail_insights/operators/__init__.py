"""Analytic operators: pure, lazy ``DataFrame -> DataFrame`` functions."""

from retail_insights.operators.churn import churn_risk
from retail_insights.operators.engagement import (
    flatten_interactions,
    flatten_tickets,
    omni_channel,
)
from retail_insights.operators.risk import high_risk_customers, high_risk_orders, suspicious_logins
from retail_insights.operators.rollup import monthly_rollup
from retail_insights.operators.sales import conform, known_lines, sales_fact, with_history
from retail_insights.operators.segments import customer_segments
from retail_insights.operators.spending import (
    best_customer_products,
    best_customers,
    of_customers,
    top_customer_ids,
    top_customers,
)
from retail_insights.operators.trends import (
    peak_sales_months,
    product_growth,
    purchase_trend,
    yearly_retention,
    yoy_comparison,
)

__all__ = [
    "best_customer_products",
    "best_customers",
    "churn_risk",
    "conform",
    "customer_segments",
    "flatten_interactions",
    "flatten_tickets",
    "high_risk_customers",
    "high_risk_orders",
    "known_lines",
    "monthly_rollup",
    "of_customers",
    "omni_channel",
    "peak_sales_months",
    "product_growth",
    "purchase_trend",
    "sales_fact",
    "suspicious_logins",
    "top_customer_ids",
    "top_customers",
    "with_history",
    "yearly_retention",
    "yoy_comparison",
]
