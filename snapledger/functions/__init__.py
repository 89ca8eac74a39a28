"""Column-level helpers shared by the operators (all built-in Spark expressions)."""

from snapledger.functions.columns import (
    days_after,
    desc_order,
    gmv_amount,
    hours_after,
    latest_per_key,
    money_to_double,
    ntz,
    session_clock,
    stamp,
    status_from_release,
    year_bounds,
)
from snapledger.functions.skew import hot_keys, salted_join

__all__ = [
    "days_after",
    "desc_order",
    "gmv_amount",
    "hours_after",
    "latest_per_key",
    "money_to_double",
    "ntz",
    "session_clock",
    "stamp",
    "status_from_release",
    "year_bounds",
    "hot_keys",
    "salted_join",
]
