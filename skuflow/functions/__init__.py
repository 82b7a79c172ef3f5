from skuflow.functions.columns import (  # noqa: F401
    iso_now,
    iso_text,
    quantity_or_zero,
    signed_quantity,
    trace_line,
    utf8,
)
