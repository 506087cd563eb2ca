"""Oracle SQL for the data-quality reports (raw = staged line grain)."""

from pyspark.sql import types as T

from tillstar.oracle import big, dbl, pct, q, snap
from tillstar.schemas import CATEGORICAL_COLUMNS, OUTLIER_COLUMNS, RAW_SALES

RAW = [f.name for f in RAW_SALES.fields]
NUMERIC = [f.name for f in RAW_SALES.fields if isinstance(f.dataType, (T.LongType, T.IntegerType, T.DecimalType))]
NOT_NULL = [f.name for f in RAW_SALES.fields if not f.nullable]
ORDER = "(order_id, s1, s2, s3, s4, s5)"


def norm(c: str, prefix: str = "") -> str:
    t = RAW_SALES[c].dataType
    if isinstance(t, T.DecimalType):
        return f"CAST({prefix}{c} AS DOUBLE) AS {c}"
    if isinstance(t, (T.IntegerType, T.LongType)):
        return f"CAST({prefix}{c} AS BIGINT) AS {c}"
    return f"{prefix}{c}"


NORM17 = ", ".join(norm(c) for c in RAW)


def quantiles(table: str, cols: list, probs: list) -> str:
    vals = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS DECIMAL(38,4)) AS value FROM {table} WHERE {c} IS NOT NULL"
        for c in cols)
    pv = ", ".join(f"(CAST({p} AS DOUBLE))" for p in probs)
    return f"""
, qv AS (
  {vals}
), qr AS (
  SELECT column_name, value, ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY value) AS rn,
         COUNT(*) OVER (PARTITION BY column_name) AS n
  FROM qv
), qneed AS (
  SELECT DISTINCT column_name, n, p,
         CAST(floor(CAST(n - 1 AS DOUBLE) * p) + 1 AS BIGINT) AS lo,
         CAST(LEAST(floor(CAST(n - 1 AS DOUBLE) * p) + 2, n) AS BIGINT) AS hi,
         CAST(n - 1 AS DOUBLE) * p - floor(CAST(n - 1 AS DOUBLE) * p) AS frac
  FROM qr, (VALUES {pv}) t(p)
), quant AS (
  SELECT k.column_name, k.p,
         CAST(MAX(CASE WHEN r.rn = k.lo THEN r.value END) AS DOUBLE)
           + (CAST(MAX(CASE WHEN r.rn = k.hi THEN r.value END) AS DOUBLE)
              - CAST(MAX(CASE WHEN r.rn = k.lo THEN r.value END) AS DOUBLE)) * k.frac AS value
  FROM qneed k JOIN qr r ON r.column_name = k.column_name AND (r.rn = k.lo OR r.rn = k.hi)
  GROUP BY k.column_name, k.p, k.frac
)"""


def _profile() -> str:
    parts = []
    for f in RAW_SALES.fields:
        c = f.name
        parts.append(
            f"SELECT '{c}' AS column_name, '{f.dataType.simpleString()}' AS dtype, "
            f"{big(f'COUNT({c})')} AS non_null, {big(f'COUNT(*) - COUNT({c})')} AS null_count, "
            f"{pct(f'COUNT(*) - COUNT({c})', 'COUNT(*)')} AS null_pct, "
            f"{big(f'COUNT(DISTINCT CAST({c} AS VARCHAR))')} AS distinct_count, "
            f"arg_min(CAST({c} AS VARCHAR), {ORDER}) FILTER (WHERE {c} IS NOT NULL) AS sample_value "
            f"FROM raw_sales")
    return q("\nUNION ALL\n".join(parts))


def _numeric_summary() -> str:
    base = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT({c}) AS cnt, SUM(CAST({c} AS DECIMAL(38,4))) AS s, "
        f"stddev_samp(CAST(CAST({c} AS DECIMAL(38,4)) AS DOUBLE)) AS sd, MIN({c}) AS mn, MAX({c}) AS mx "
        f"FROM raw_sales" for c in NUMERIC)
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    pcols = ",\n       ".join(
        f"{snap(f'MAX(CASE WHEN qt.p = CAST({p} AS DOUBLE) THEN qt.value END)')} AS p{int(round(p * 100))}"
        for p in probs)
    return q(quantiles("raw_sales", NUMERIC, probs) + f"""
, base AS (
  {base}
)
SELECT b.column_name, {big("b.cnt")} AS count,
       {snap("CAST(b.s AS DOUBLE) / b.cnt")} AS mean,
       {snap("b.sd")} AS std,
       {snap("CAST(b.mn AS DOUBLE)")} AS min,
       {pcols},
       {snap("CAST(b.mx AS DOUBLE)")} AS max
FROM base b JOIN quant qt ON b.column_name = qt.column_name
GROUP BY b.column_name, b.cnt, b.s, b.sd, b.mn, b.mx""")


def _null_counts() -> str:
    parts = "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, {big(f'COUNT(*) - COUNT({c})')} AS null_count FROM raw_sales" for c in RAW)
    return q(f", nc AS ({parts})\nSELECT * FROM nc WHERE null_count > 0")


def _impute_median() -> str:
    cols = []
    for c in RAW:
        if c == "rating":
            cols.append("COALESCE(CAST(rating AS DOUBLE), (SELECT value FROM quant)) AS rating")
        else:
            cols.append(norm(c))
    return q(quantiles("raw_sales", ["rating"], [0.5]) + f"\nSELECT {', '.join(cols)} FROM raw_sales")


def _impute_mode() -> str:
    cols = []
    for c in RAW:
        if c in CATEGORICAL_COLUMNS:
            mode = (f"(SELECT {c} FROM raw_sales WHERE {c} IS NOT NULL GROUP BY {c} "
                    f"ORDER BY COUNT(*) DESC, {c} LIMIT 1)")
            cols.append(f"COALESCE({c}, {mode}) AS {c}")
        else:
            cols.append(norm(c))
    return q(f"SELECT {', '.join(cols)} FROM raw_sales")


def _outliers() -> str:
    vals = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM clean" for c in OUTLIER_COLUMNS)
    return q(quantiles("clean", OUTLIER_COLUMNS, [0.25, 0.75]) + f"""
, b AS (
  SELECT column_name, MAX(CASE WHEN p = 0.25 THEN value END) AS q1, MAX(CASE WHEN p = 0.75 THEN value END) AS q3
  FROM quant GROUP BY column_name
), bb AS (
  SELECT column_name, q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM b
), v AS (
  {vals}
)
SELECT bb.column_name, bb.q1, bb.q3, bb.iqr, bb.lower, bb.upper,
       {big("COUNT(CASE WHEN v.value < bb.lower OR v.value > bb.upper THEN 1 END)")} AS outlier_count,
       {pct("COUNT(CASE WHEN v.value < bb.lower OR v.value > bb.upper THEN 1 END)", "COUNT(*)")} AS outlier_pct
FROM v JOIN bb ON v.column_name = bb.column_name
GROUP BY bb.column_name, bb.q1, bb.q3, bb.iqr, bb.lower, bb.upper""")


def _value_counts() -> str:
    vals = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM clean WHERE {c} IS NOT NULL"
        for c in CATEGORICAL_COLUMNS)
    return q(f"""
, v AS (
  {vals}
), vc AS (
  SELECT column_name, value, COUNT(*) AS n FROM v GROUP BY column_name, value
)
SELECT column_name, value, {big("n")} AS n,
       {big("COUNT(*) OVER (PARTITION BY column_name)")} AS distinct_values
FROM vc ORDER BY column_name, n DESC, value""")


_MM_REV = "ABS(ROUND(discounted_price * quantity, 2) - revenue) > 0.05"
_MM_DP = "ABS(ROUND(product_price * (100 - discount_percent) * CAST(0.01 AS DECIMAL(3,2)), 2) - discounted_price) > 0.10"


def _scorecard() -> str:
    nulls = " + ".join(f"(COUNT(*) - COUNT({c}))" for c in RAW)
    return q(f"""
, a AS (
  SELECT COUNT(*) AS rows_n, MIN(order_date) AS lo, MAX(order_date) AS hi, {nulls} AS nulls,
         COUNT(*) - COUNT(DISTINCT order_id) AS dups,
         COUNT(CASE WHEN {_MM_REV} THEN 1 END) AS rev_mm,
         COUNT(CASE WHEN {_MM_DP} THEN 1 END) AS dp_mm,
         COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT product_id) AS products,
         COUNT(DISTINCT product_category) AS categories, COUNT(DISTINCT customer_country) AS countries,
         COUNT(DISTINCT traffic_source) AS sources, COUNT(DISTINCT payment_method) AS payments,
         {pct("SUM(is_returned)", "COUNT(is_returned)")} AS ret,
         {snap("CAST(SUM(discount_percent) AS DOUBLE) / COUNT(discount_percent)")} AS disc
  FROM clean
), r AS (
  SELECT 'Total records' AS check_name, CAST(rows_n AS VARCHAR) AS value, 'info' AS kind FROM a
  UNION ALL SELECT 'Date range', CAST(lo AS VARCHAR) || ' → ' || CAST(hi AS VARCHAR), 'info' FROM a
  UNION ALL SELECT 'Null values remaining', CAST(nulls AS VARCHAR), 'defect' FROM a
  UNION ALL SELECT 'Duplicate order_ids', CAST(dups AS VARCHAR), 'defect' FROM a
  UNION ALL SELECT 'Revenue mismatches', CAST(rev_mm AS VARCHAR), 'defect' FROM a
  UNION ALL SELECT 'Price mismatches', CAST(dp_mm AS VARCHAR), 'defect' FROM a
  UNION ALL SELECT 'Unique customers', CAST(customers AS VARCHAR), 'info' FROM a
  UNION ALL SELECT 'Unique products', CAST(products AS VARCHAR), 'info' FROM a
  UNION ALL SELECT 'Product categories', CAST(categories AS VARCHAR), 'info' FROM a
  UNION ALL SELECT 'Countries', CAST(countries AS VARCHAR), 'info' FROM a
  UNION ALL SELECT 'Traffic sources', CAST(sources AS VARCHAR), 'info' FROM a
  UNION ALL SELECT 'Payment methods', CAST(payments AS VARCHAR), 'info' FROM a
  UNION ALL SELECT 'Return rate', printf('%.2f%%', ret), 'info' FROM a
  UNION ALL SELECT 'Avg discount %', printf('%.2f%%', disc), 'info' FROM a
)
SELECT check_name, value,
       CASE WHEN kind = 'defect' THEN CASE WHEN value = '0' THEN 'PASS' ELSE 'FAIL' END
            ELSE CASE WHEN value IS NULL OR value = '0' THEN 'WARN' ELSE 'INFO' END END AS status
FROM r""")


def _constraints() -> str:
    rows = [
        ("pk_raw_sales", "COUNT(*) - COUNT(DISTINCT order_id)"),
        ("chk_quantity_positive", "COUNT(CASE WHEN NOT (quantity > 0) THEN 1 END)"),
        ("chk_discount_range", "COUNT(CASE WHEN NOT (discount_percent BETWEEN 0 AND 100) THEN 1 END)"),
        ("chk_is_returned", "COUNT(CASE WHEN NOT (is_returned IN (0, 1)) THEN 1 END)"),
        ("chk_revenue_non_negative", "COUNT(CASE WHEN NOT (revenue >= 0) THEN 1 END)"),
    ] + [(f"not_null_{c}", f"COUNT(*) - COUNT({c})") for c in NOT_NULL]
    return q("\nUNION ALL ".join(
        f"SELECT '{n}' AS constraint_name, {big(e)} AS violations FROM raw_sales" for n, e in rows))


_FKS = [("date_key", "dim_date"), ("customer_key", "dim_customer"), ("product_key", "dim_product"),
        ("country_key", "dim_country"), ("traffic_source_key", "dim_traffic_source"),
        ("payment_method_key", "dim_payment_method")]


def _integrity() -> str:
    any_orphan = " OR ".join(f"NOT EXISTS (SELECT 1 FROM {d} x WHERE x.{fk} = f.{fk})" for fk, d in _FKS)
    parts = "\n  UNION ALL ".join(
        f"SELECT 'fact_sales.{fk}' AS foreign_key, '{d}' AS \"references\", "
        f"{big('COUNT(*)')} AS orphans FROM fact_sales f WHERE NOT EXISTS "
        f"(SELECT 1 FROM {d} x WHERE x.{fk} = f.{fk})" for fk, d in _FKS)
    return q(f"""
, o AS (
  {parts}
)
SELECT foreign_key, "references", orphans, CASE WHEN orphans = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM o
UNION ALL
SELECT 'ALL', '*', {big("COUNT(*)")}, CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END
FROM fact_sales f WHERE {any_orphan}""")


_UNIQUE = [("dim_date", "date_key"), ("dim_customer", "customer_key"), ("dim_customer", "customer_id"),
           ("dim_product", "product_key"), ("dim_product", "product_id"), ("dim_country", "country_key"),
           ("dim_country", "country_name"), ("dim_traffic_source", "traffic_source_key"),
           ("dim_traffic_source", "traffic_source"), ("dim_payment_method", "payment_method_key"),
           ("dim_payment_method", "payment_method"), ("fact_sales", "sales_key"), ("fact_sales", "order_id")]


def _unique() -> str:
    return q("\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{k}' AS key_column, {big(f'COUNT(*) - COUNT(DISTINCT {k})')} AS duplicates "
        f"FROM {t}" for t, k in _UNIQUE))


# column counts of the star tables as built (audit columns included)
_TABLE_COLS = {"fact_sales": 21, "dim_date": 16, "dim_customer": 15, "dim_product": 12, "dim_country": 4,
               "dim_traffic_source": 4, "dim_payment_method": 4}

SQL = {
    "dq_profile": _profile(),
    "dq_numeric_summary": _numeric_summary(),
    "dq_null_counts": _null_counts(),
    "impute_median": _impute_median(),
    "impute_mode": _impute_mode(),
    "parse_dates": q(f"SELECT {big('order_id')} AS order_id, order_date FROM raw_sales"),
    "coerce_types": q(f"SELECT {NORM17} FROM raw_sales"),
    "trim_strings": q("SELECT " + big("order_id") + " AS order_id, "
                      + ", ".join(f"trim({c}) AS {c}" for c in CATEGORICAL_COLUMNS) + " FROM raw_sales"),
    "dup_full_rows": q(f"""
, g AS (SELECT {', '.join(RAW)}, COUNT(*) AS c FROM raw_sales GROUP BY ALL)
SELECT {big('SUM(c)')} AS total_rows, {big('COUNT(*)')} AS distinct_rows, {big('SUM(c - 1)')} AS full_row_duplicates
FROM g"""),
    "dup_keys": q(f"""
, g AS (SELECT order_id, COUNT(*) AS c FROM raw_sales GROUP BY order_id)
SELECT {big('SUM(c)')} AS total_rows, {big('COUNT(*)')} AS distinct_keys, {big('SUM(c - 1)')} AS duplicate_keys
FROM g"""),
    "dedup_keep_first": q(f"SELECT {NORM17} FROM clean"),
    "derive_date_parts": q(f"""SELECT {NORM17}, {big('year(order_date)')} AS order_year,
       {big('month(order_date)')} AS order_month, {big('quarter(order_date)')} AS order_quarter,
       strftime(order_date, '%A') AS order_dow FROM clean"""),
    "check_revenue": q(f"SELECT {big('COUNT(*)')} AS rows_checked, "
                       f"{big(f'COUNT(CASE WHEN {_MM_REV} THEN 1 END)')} AS revenue_mismatches FROM clean"),
    "check_discounted_price": q(f"SELECT {big('COUNT(*)')} AS rows_checked, "
                                f"{big(f'COUNT(CASE WHEN {_MM_DP} THEN 1 END)')} AS price_mismatches FROM clean"),
    "outliers_iqr": _outliers(),
    "value_counts": _value_counts(),
    "dq_scorecard": _scorecard(),
    "constraint_checks": _constraints(),
    "referential_integrity": _integrity(),
    "unique_key_checks": _unique(),
    "raw_totals": q(f"""SELECT {dbl('SUM(revenue)')} AS total_revenue, {dbl('SUM(profit)')} AS total_profit,
       CAST(SUM(revenue) AS DOUBLE) / NULLIF(CAST(SUM(profit) AS DOUBLE), 0) AS revenue_profit_ratio
FROM raw_sales"""),
    "raw_monthly": q(f"""SELECT CAST(date_trunc('month', order_date) AS DATE) AS order_month,
       {dbl('SUM(revenue)')} AS revenue, {dbl('SUM(profit)')} AS profit
FROM raw_sales GROUP BY 1 ORDER BY 1 LIMIT 12"""),
    "table_sizes": q("\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, {big('COUNT(*)')} AS row_count, CAST({n} AS BIGINT) AS column_count FROM {t}"
        for t, n in _TABLE_COLS.items())),
    "build_summary": q(f"""
SELECT MIN(dd.full_date) AS first_order_date, MAX(dd.full_date) AS last_order_date,
       {big('COUNT(*)')} AS orders, {dbl('SUM(fs.revenue)')} AS total_revenue, {dbl('SUM(fs.profit)')} AS total_profit,
       (SELECT {big('COUNT(*)')} FROM dim_customer) AS customers,
       (SELECT {big('SUM(CAST(is_repeat_customer AS INTEGER))')} FROM dim_customer) AS repeat_customers,
       (SELECT {pct('SUM(CAST(is_repeat_customer AS INTEGER))', 'COUNT(*)', 1)} FROM dim_customer) AS repeat_customer_pct,
       (SELECT {big('COUNT(DISTINCT product_category)')} FROM dim_product) AS categories
FROM fact_sales fs JOIN dim_date dd ON fs.date_key = dd.date_key"""),
}

SQL["dq_profile_by_file"] = SQL["dq_profile"]
