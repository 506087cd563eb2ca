"""Order-insensitive result comparison (column names sorted, rows as multisets)."""

from __future__ import annotations

import math


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        s = v.isoformat()
        return s[:10] if s.endswith("T00:00:00") else s
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def canonical(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(rows, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def same_result(scols, srows, dcols, drows) -> tuple[bool, str]:
    if sorted(scols) != sorted(dcols):
        return False, f"columns differ: {sorted(scols)} vs {sorted(dcols)}"
    if len(srows) != len(drows):
        return False, f"row counts differ: {len(srows)} vs {len(drows)}"
    a, b = canonical(scols, srows), canonical(dcols, drows)
    if a != b:
        diff = [x for x in a if x not in set(b)][:3]
        return False, f"values differ, e.g. {diff}"
    return True, "ok"
