"""Column-level helpers; every one is a composition of Spark built-ins."""

from poolbook.functions.scalar import (
    as_day,
    byte_prefix,
    concat_skip_null,
    hex_bytes,
    replace_value,
    scale_amount,
    scale_weight,
    usd_value,
)
from poolbook.functions.generators import calendar, day_span, zip_explode
from poolbook.functions.ordering import change_order

__all__ = [
    "as_day",
    "byte_prefix",
    "calendar",
    "change_order",
    "concat_skip_null",
    "day_span",
    "hex_bytes",
    "replace_value",
    "scale_amount",
    "scale_weight",
    "usd_value",
    "zip_explode",
]
