"""Hand-made raw sales rows for the semantic-trap tests."""

from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from tillstar.schemas import RAW_COLUMNS, RAW_SALES

D = Decimal


def _q2(x: Decimal) -> Decimal:
    return x.quantize(D("0.01"), rounding=ROUND_HALF_UP)


def raw_row(order_id, **kw):
    price = D(str(kw.get("product_price", "100.00")))
    pct = D(str(kw.get("discount_percent", "0")))
    qty = int(kw.get("quantity", 1))
    ship = D(str(kw.get("shipping_cost", "0.00")))
    dprice = D(str(kw["discounted_price"])) if "discounted_price" in kw else _q2(price * (100 - pct) / 100)
    revenue = D(str(kw["revenue"])) if "revenue" in kw else _q2(dprice * qty)
    profit = D(str(kw["profit"])) if "profit" in kw else revenue - ship
    rating = kw.get("rating", "4.0")
    vals = {
        "order_id": order_id,
        "order_date": kw.get("order_date", dt.date(2024, 1, 15)),
        "customer_id": kw.get("customer_id", 1),
        "product_id": kw.get("product_id", 1),
        "product_category": kw.get("product_category", "Electronics"),
        "product_price": price,
        "discount_percent": pct.quantize(D("0.01")),
        "quantity": qty,
        "customer_country": kw.get("customer_country", "USA"),
        "traffic_source": kw.get("traffic_source", "Direct"),
        "payment_method": kw.get("payment_method", "Credit Card"),
        "shipping_cost": ship,
        "rating": None if rating is None else D(str(rating)),
        "is_returned": int(kw.get("is_returned", 0)),
        "discounted_price": dprice,
        "revenue": revenue,
        "profit": profit,
    }
    return tuple(vals[c] for c in RAW_COLUMNS)


def make_raw(spark, rows):
    return spark.createDataFrame([raw_row(i + 1, **r) if isinstance(r, dict) else r for i, r in enumerate(rows)],
                                 RAW_SALES)
