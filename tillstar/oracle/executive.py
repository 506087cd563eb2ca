"""Oracle SQL for the executive reports (ties broken by natural key).

Growth is taken against the row one place earlier (a join on numbered rows),
running shares against the sum of the rows that are not behind."""

from tillstar.oracle import big, grouped, measures, pct, q, ratio


def growth(keys: str, names: str, column: str, out: dict, more: str = "") -> str:
    """Measures by period with the growth of ``column`` over the period before."""
    order = ", ".join(keys.split())
    return q(f"""
, periods AS (
  SELECT {order}, {names}, row_number() OVER (ORDER BY {order}) AS i, sum(revenue) AS r, {measures(out)}
  FROM sold GROUP BY {order}, {names}
)
SELECT {", ".join(f"CAST(now.{k} AS BIGINT) AS {k}" for k in keys.split())},
       {", ".join("now." + n for n in names.split(", "))}, {", ".join("now." + c for c in out)},
       {pct("now.r - earlier.r", "earlier.r")} AS {column}{more}
FROM periods now LEFT JOIN periods earlier ON earlier.i = now.i - 1""")


# Leakage classes, each with its orders and what it counts.
LEAKS = [
    ("High Discount (>30%)", "discount_percent > 30", "reductions"),
    ("Returns", "is_returned = 1", "CAST(0 AS DOUBLE)"),
    ("Low Rating Orders (<=2.0)", "rating <= 2.0", "reductions"),
]
LEAK_MEASURES = {"affected_orders": "orders", "discount_cost": "reductions", "profit_generated": "profit",
                 "margin_pct": "margin"}

SQL = {
    "exec_scorecard": grouped(
        "", total_orders="orders", total_customers="customers", total_units_sold="units", net_revenue="revenue",
        gross_revenue="list_revenue", total_discounts="reductions", total_shipping="shipping", net_profit="profit",
        profit_margin_pct="margin", avg_order_value="order_value",
        avg_revenue_per_customer=ratio("sum(revenue)", "count(DISTINCT customer_id)"),
        discount_rate_pct="reduction_rate", return_rate_pct="return_rate", avg_product_rating="stars",
        period_start="from", period_end="to"),
    "exec_monthly_trend": growth(
        "year month", "month_label, quarter_label", "mom_revenue_growth_pct",
        {"orders": "orders", "customers": "customers", "revenue": "revenue", "profit": "profit",
         "discounts": "reductions", "aov": "order_value", "profit_margin_pct": "margin"},
        more=""",
       CAST((SELECT sum(p.r) FROM periods p WHERE p.year = now.year AND p.month <= now.month) AS DOUBLE) AS ytd_revenue"""),
    "exec_top_products": grouped(
        "product_id product_category", tail="ORDER BY sum(revenue) DESC, product_id, product_category LIMIT 10",
        rank="rank", orders="orders", units_sold="units", revenue="revenue", profit="profit",
        profit_margin_pct="margin", avg_discount_pct="discount", avg_rating="stars", return_rate_pct="return_rate",
        revenue_share_pct="share"),
    "exec_category_scorecard": grouped(
        "product_category", orders="orders", units_sold="units", unique_customers="customers", revenue="revenue",
        gross_revenue="list_revenue", profit="profit", total_discounts="reductions", aov="order_value",
        profit_margin_pct="margin", avg_discount_pct="discount", avg_rating="stars", return_rate_pct="return_rate",
        revenue_share_pct="share", revenue_rank=big("dense_rank() OVER (ORDER BY sum(revenue) DESC)")),
    "exec_top_customers": q(f"""
, spent AS (
  SELECT customer_id, sum(revenue) AS r, {measures({"orders": "orders", "lifetime_revenue": "revenue",
                                                    "lifetime_profit": "profit", "aov": "order_value",
                                                    "profit_margin_pct": "margin", "first_order_date": "from",
                                                    "last_order_date": "to", "revenue_share_pct": "share"})}
  FROM sold GROUP BY customer_id
), best AS (SELECT * FROM spent ORDER BY r DESC, customer_id LIMIT 10)
SELECT {big("1 + (SELECT count(*) FROM spent o WHERE o.r > best.r)")} AS rank, {big("customer_id")} AS customer_id,
       customer_country, orders, lifetime_revenue, lifetime_profit, aov, profit_margin_pct, first_order_date,
       last_order_date, revenue_share_pct,
       {pct("(SELECT sum(o.r) FROM spent o WHERE o.r > best.r OR (o.r = best.r AND o.customer_id <= best.customer_id))",
            "(SELECT sum(r) FROM spent)")} AS cumulative_revenue_pct
FROM best JOIN latest USING (customer_id)"""),
    "exec_top_countries": grouped(
        "customer_country region", {"customer_country": "country_name"}, rank="rank", orders="orders",
        customers="customers", revenue="revenue", profit="profit", aov="order_value", profit_margin_pct="margin",
        return_rate_pct="return_rate", revenue_share_pct="share"),
    "exec_top_channels": grouped(
        "traffic_source channel_type is_paid", rank="rank", orders="orders", customers="customers",
        revenue="revenue", profit="profit", discounts="reductions", aov="order_value", profit_margin_pct="margin",
        return_rate_pct="return_rate", revenue_share_pct="share"),
    "exec_qbr": growth(
        "year quarter", "quarter_label", "qoq_revenue_growth_pct",
        {"gross_revenue": "list_revenue", "less_discounts": "reductions", "net_revenue": "revenue",
         "shipping_costs": "shipping", "operating_profit": "profit", "profit_margin_pct": "margin",
         "orders": "orders", "active_customers": "customers", "avg_rating": "stars",
         "return_rate_pct": "return_rate"}),
    "exec_returns": grouped(
        "product_category", total_orders="orders", returned_orders="returned", return_rate_pct="return_rate",
        returned_revenue="returned_revenue", returned_profit_lost="returned_profit",
        avg_rating_returned="stars_returned", avg_rating_kept="stars_kept",
        avg_discount_on_returns=ratio("sum(discount_percent * is_returned)", "sum(is_returned)")),
    "exec_profit_leakage": q(" UNION ALL ".join(
        f"SELECT '{label}' AS leakage_type, {measures(LEAK_MEASURES | {'discount_cost': cost})} FROM sold WHERE {holds}"
        for label, holds, cost in LEAKS)),
}
