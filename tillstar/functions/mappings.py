"""Business lookup values and label rules.

FIXED VALUES — these must equal the reference warehouse exactly (labels,
region and currency codes, channel and payment classifications, segment,
band and tier names).  They are stated once here, in natural order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: country -> (region, currency); unknown -> ('Other', 'USD')
COUNTRY_REGION = {
    "USA": "North America",
    "Canada": "North America",
    "UK": "Europe",
    "UAE": "Middle East",
    "India": "South Asia",
    "Germany": "Europe",
    "France": "Europe",
    "Australia": "Oceania",
}
COUNTRY_CURRENCY = {
    "USA": "USD",
    "Canada": "CAD",
    "UK": "GBP",
    "UAE": "AED",
    "India": "INR",
    "Germany": "EUR",
    "France": "EUR",
    "Australia": "AUD",
}
REGION_FALLBACK = "Other"
CURRENCY_FALLBACK = "USD"

# --- fixed values: traffic source -> channel type; paid sources
CHANNEL_TYPE = {
    "Paid Ads": "Paid",
    "Email": "Owned",
    "Social Media": "Paid/Organic",
    "Organic": "Organic",
    "Direct": "Direct",
}
PAID_SOURCES = ["Paid Ads", "Social Media"]

# --- fixed values: payment method -> payment type; digital wallets
PAYMENT_TYPE = {
    "Credit Card": "Card",
    "Debit Card": "Card",
    "PayPal": "Digital Wallet",
    "Apple Pay": "Digital Wallet",
    "Cash on Delivery": "COD",
}
DIGITAL_WALLETS = ["PayPal", "Apple Pay"]
OTHER = "Other"

# --- fixed values: RFM segment labels, in rule order (first match wins)
SEG_CHAMPIONS = "Champions"
SEG_LOYAL = "Loyal Customers"
SEG_POTENTIAL = "Potential Loyalists"
SEG_PROMISING = "Promising"
SEG_AT_RISK = "At Risk"
SEG_LOST = "Lost Customers"
SEG_HIBERNATING = "Hibernating"
SEG_NEED_ATTENTION = "Need Attention"

# --- fixed values: discount bands of the KPI view (integer percent bands)
KPI_BAND_LABELS = ["0% (No Discount)", "1–10%", "11–20%", "21–30%", "31–40%", "40%+"]
# --- fixed values: discount bands of the notebook (left-closed bins)
NB_BAND_EDGES = [0, 0.001, 10, 20, 30, 40, 101]
NB_BAND_LABELS = ["No Discount", "1-10%", "11-20%", "21-30%", "31-40%", "40%+"]

# --- fixed values: CLV tiers and their thresholds
CLV_TIERS = ["Bronze", "Silver", "Gold", "Platinum"]
CLV_EDGES = [1000, 5000, 10000]

# --- fixed values: Pareto groups
PARETO_TOP = "Top 80% Revenue"
PARETO_BOTTOM = "Bottom 20% Revenue"

# --- fixed values: trend and signal labels of the window reports
TREND_UP = "Upward trend expected"
TREND_DOWN = "Downward trend expected"
TREND_FLAT = "Flat"
ABOVE_AVG = "Above Average"
BELOW_AVG = "Below Average"
PERFORMANCE_TIERS = ["Top Performer", "Strong Performer", "Average Performer", "Underperformer"]

# --- fixed values: customer type of the channel acquisition view
NEW_CUSTOMER = "New Customer"
RETURNING_CUSTOMER = "Returning Customer"

# --- fixed values: repeat-buyer labels of the notebook summary
REPEAT_LABEL = "Repeat Customers"
ONE_TIME_LABEL = "One-Time Buyers"

# --- fixed values: profit-leakage classes (SQL report, then notebook)
LEAK_DISCOUNT = "High Discount (>30%)"
LEAK_RETURNS = "Returns"
LEAK_LOW_RATING = "Low Rating Orders (<=2.0)"
NB_LEAK_DISCOUNT = "Deep Discounts (>30%)"
NB_LEAK_RETURNS = "Returns"
NB_LEAK_LOW_RATING = "Low-Rated Orders (≤2.0★)"


def lookup(col: Column, mapping: dict, default: str | None) -> Column:
    """CASE col WHEN k THEN v ... ELSE default END as a native expression."""
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default))


def region_of(country: Column) -> Column:
    return lookup(country, COUNTRY_REGION, REGION_FALLBACK)


def currency_of(country: Column) -> Column:
    return lookup(country, COUNTRY_CURRENCY, CURRENCY_FALLBACK)


def channel_type_of(source: Column) -> Column:
    return lookup(source, CHANNEL_TYPE, OTHER)


def is_paid_of(source: Column) -> Column:
    return source.isin(PAID_SOURCES)


def payment_type_of(method: Column) -> Column:
    return lookup(method, PAYMENT_TYPE, OTHER)


def is_wallet_of(method: Column) -> Column:
    return method.isin(DIGITAL_WALLETS)


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """Eight-way RFM segment rule; the first matching rule wins."""
    return (F.when((r >= 4) & (f >= 4) & (m >= 4), SEG_CHAMPIONS)
            .when((r >= 3) & (f >= 3) & (m >= 3), SEG_LOYAL)
            .when((r >= 4) & (f <= 2), SEG_POTENTIAL)
            .when((r >= 3) & (f >= 3) & (m <= 2), SEG_PROMISING)
            .when((r <= 2) & (f >= 3) & (m >= 3), SEG_AT_RISK)
            .when((r == 1) & (f >= 2), SEG_LOST)
            .when((r <= 2) & (f <= 2) & (m <= 2), SEG_HIBERNATING)
            .otherwise(SEG_NEED_ATTENTION))


def kpi_discount_band(pct: Column) -> Column:
    """KPI view bands: =0, (0,10], (10,20], (20,30], (30,40], >40.

    Equal to the integer BETWEEN bands on whole percentages, without their
    gaps for fractional percentages."""
    lb = KPI_BAND_LABELS
    return (F.when(pct == 0, lb[0]).when(pct <= 10, lb[1]).when(pct <= 20, lb[2])
            .when(pct <= 30, lb[3]).when(pct <= 40, lb[4]).otherwise(lb[5]))


def nb_discount_band(pct: Column) -> Column:
    """Notebook bands: left-closed bins on NB_BAND_EDGES; outside -> null."""
    e, lb = NB_BAND_EDGES, NB_BAND_LABELS
    expr = None
    for i, label in enumerate(lb):
        cond = (pct >= e[i]) & (pct < e[i + 1])
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def nb_band_order(pct: Column) -> Column:
    """Position of the notebook band (1..6) for ordering; null outside."""
    e = NB_BAND_EDGES
    expr = None
    for i in range(len(e) - 1):
        cond = (pct >= e[i]) & (pct < e[i + 1])
        expr = F.when(cond, i + 1) if expr is None else expr.when(cond, i + 1)
    return expr


def clv_tier_left_closed(revenue: Column) -> Column:
    """SQL tiers: >=10000 Platinum, >=5000 Gold, >=1000 Silver, else Bronze."""
    return (F.when(revenue >= CLV_EDGES[2], CLV_TIERS[3]).when(revenue >= CLV_EDGES[1], CLV_TIERS[2])
            .when(revenue >= CLV_EDGES[0], CLV_TIERS[1]).otherwise(CLV_TIERS[0]))


def clv_tier_right_closed(revenue: Column) -> Column:
    """Notebook tiers: (0,1000] (1000,5000] (5000,10000] (10000,inf); else null."""
    return (F.when(revenue <= 0, F.lit(None).cast("string"))
            .when(revenue <= CLV_EDGES[0], CLV_TIERS[0]).when(revenue <= CLV_EDGES[1], CLV_TIERS[1])
            .when(revenue <= CLV_EDGES[2], CLV_TIERS[2]).when(revenue.isNotNull(), CLV_TIERS[3]))
