"""Oracle SQL for the marketing views: measures of the sold orders by channel."""

from tillstar.oracle import big, grouped, measures, pct, q, ratio

# An order is a new customer's if it falls on the customer's first day.
FIRST_DAYS = """
SELECT traffic_source,
       CASE WHEN order_date > min(order_date) OVER (PARTITION BY customer_id) THEN 'Returning Customer'
            ELSE 'New Customer' END AS customer_type,
       customer_id, revenue, profit
FROM sold"""


def by_rank(column: str, order: str) -> str:
    """Rank as one more than the number of channels that are better."""
    better = ">" if order == "high" else "<"
    return big(f"1 + (SELECT count(*) FROM channels o WHERE o.{column} {better} channels.{column})")


CHANNELS = {"revenue": "revenue", "profit": "profit", "margin_pct": "margin", "aov": "order_value",
            "return_rate_pct": "return_rate", "avg_discount_pct": "discount"}

SQL = {
    "mkt_channel_performance": grouped(
        "traffic_source channel_type is_paid", total_orders="orders", unique_customers="customers",
        units_sold="units", total_revenue="revenue", gross_revenue="list_revenue", total_profit="profit",
        total_discounts="reductions", aov="order_value", profit_margin_pct="margin", return_rate_pct="return_rate",
        avg_rating="stars", revenue_share_pct="share"),
    "mkt_channel_monthly_trend": grouped(
        "year month month_label traffic_source channel_type", orders="orders", revenue="revenue", profit="profit",
        aov="order_value", profit_margin_pct="margin"),
    "mkt_channel_category_matrix": grouped(
        "traffic_source product_category", orders="orders", revenue="revenue", profit="profit",
        profit_margin_pct="margin", avg_discount_pct="discount"),
    "mkt_channel_country_matrix": grouped(
        "traffic_source customer_country region", {"customer_country": "country_name"}, orders="orders",
        revenue="revenue", profit="profit", aov="order_value"),
    "mkt_channel_new_vs_returning": q(f"""
SELECT traffic_source, customer_type, {big("count(*)")} AS orders, {big("count(DISTINCT customer_id)")} AS customers,
       CAST(sum(revenue) AS DOUBLE) AS revenue, CAST(sum(profit) AS DOUBLE) AS profit,
       {ratio("sum(revenue)", "count(*)")} AS aov,
       {pct("sum(revenue)", "max(whole)")} AS pct_channel_revenue
FROM ({FIRST_DAYS})
JOIN (SELECT traffic_source, sum(revenue) AS whole FROM sold GROUP BY traffic_source) USING (traffic_source)
GROUP BY traffic_source, customer_type"""),
    "mkt_channel_efficiency_ranking": q(f"""
, channels AS (SELECT traffic_source, is_paid, {measures(CHANNELS)} FROM sold GROUP BY traffic_source, is_paid)
SELECT *, {by_rank("margin_pct", "high")} AS margin_rank, {by_rank("aov", "high")} AS aov_rank,
       {by_rank("return_rate_pct", "low")} AS return_rank, {by_rank("profit", "high")} AS profit_rank
FROM channels"""),
    "mkt_channel_discount_analysis": grouped(
        "traffic_source is_paid", total_orders="orders",
        discounted_orders=big("count(*) FILTER (discount_percent > 0)"),
        discount_usage_rate_pct=pct("count(*) FILTER (discount_percent > 0)", "count(*)"),
        avg_discount_when_applied=ratio("sum(discount_percent)", "count(*) FILTER (discount_percent > 0)"),
        total_discount_cost="reductions", total_profit="profit", profit_margin_pct="margin"),
}
