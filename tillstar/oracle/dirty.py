"""Oracle SQL for the cleaning operators on spoiled lines."""

from tillstar.oracle import big, dbl, q

COLUMNS = ["order_id", "order_date", "customer_id", "product_id", "product_category", "product_price",
           "discount_percent", "quantity", "customer_country", "traffic_source", "payment_method", "shipping_cost",
           "rating", "is_returned", "discounted_price", "revenue", "profit"]
WHOLE = {"order_id", "customer_id", "product_id", "quantity", "is_returned"}
MONEY = {"product_price", "discount_percent", "shipping_cost", "rating", "discounted_price", "revenue", "profit"}


def out(c: str) -> str:
    return f"{big(c) if c in WHOLE else dbl(c) if c in MONEY else c} AS {c}"


# The faults by line, with what the coercion makes of them (null).
SPOILED = """
, spoiled AS (
  SELECT * REPLACE (
           CASE WHEN k % 31 = 0 THEN revenue + 1 ELSE revenue END AS revenue,
           CASE WHEN k % 37 = 0 THEN discounted_price + 5 ELSE discounted_price END AS discounted_price,
           CASE WHEN k % 29 <> 0 THEN rating END AS rating,
           CASE WHEN k % 41 <> 0 THEN customer_country END AS customer_country,
           CASE WHEN k % 17 <> 0 THEN traffic_source END AS traffic_source,
           CASE WHEN k % 19 <> 0 THEN quantity END AS quantity,
           CASE WHEN k % 23 <> 0 THEN order_date END AS order_date)
  FROM (SELECT *, order_id * 7 + s1 AS k FROM raw_sales)
)"""
FIRST = SPOILED + """
, kept AS (SELECT DISTINCT ON (order_id) * FROM spoiled ORDER BY order_id, s1, s2, s3, s4, s5)"""
LINE = "CAST(order_id AS BIGINT) AS order_id, CAST(s1 AS BIGINT) AS line_number"


def most_frequent(c: str, table: str) -> str:
    return (f"(SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)")


def middle(c: str, table: str) -> str:
    return f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM {table})"


def filled(c: str, table: str) -> str:
    if c in ("quantity", "rating"):
        return f"coalesce({dbl(c)}, {middle(c, table)}) AS {c}"
    if c in ("customer_country", "traffic_source"):
        return f"coalesce({c}, {most_frequent(c, table)}) AS {c}"
    return out(c)


LACKS = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in ("order_date", "customer_country", "traffic_source")) + ")"

SQL = {
    "dirty_parse_dates": q(SPOILED + f" SELECT {LINE}, order_date FROM spoiled"),
    "dirty_coerce_types": q(SPOILED + f" SELECT {LINE}, order_date, {out('quantity')}, {out('rating')}, {out('revenue')} FROM spoiled"),
    "dirty_trim_strings": q(SPOILED + f" SELECT {LINE}, customer_country, traffic_source FROM spoiled"),
    "dirty_impute_median": q(SPOILED + f" SELECT {LINE}, {filled('quantity', 'spoiled')}, {filled('rating', 'spoiled')} FROM spoiled"),
    "dirty_impute_mode": q(SPOILED + f" SELECT {LINE}, {filled('customer_country', 'spoiled')}, "
                                     f"{filled('traffic_source', 'spoiled')} FROM spoiled"),
    "dirty_checks": q(SPOILED + f"""
SELECT {big("count(*)")} AS rows_checked,
       {big("count(*) FILTER (abs(round(discounted_price * quantity, 2) - revenue) > 0.05)")} AS revenue_mismatches,
       {big("count(*) FILTER (abs(round(product_price * (100 - discount_percent) * 0.01, 2) - discounted_price) > 0.10)")}
         AS price_mismatches
FROM spoiled"""),
    "clean_pipeline": q(FIRST + f" SELECT {', '.join(filled(c, 'kept') for c in COLUMNS)} FROM kept"),
    "dirty_load_audit": q(FIRST + f"""
SELECT CASE WHEN lacks = '' THEN 'loaded' ELSE 'quarantined' END AS outcome, nullif(lacks, '') AS missing,
       {big("count(*)")} AS row_count
FROM (SELECT {LACKS} AS lacks FROM kept) GROUP BY lacks"""),
}
