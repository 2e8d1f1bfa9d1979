from giftlens.functions.expr import (  # noqa: F401
    NA_TOKENS, TRUTHY, FALSY, elapsed_days, add_days, strict_double, parse_flag,
    normalize_categorical, null_tokens_to_null, parse_timestamp, safe_div,
    pct_change, order_key, month_start, month_label,
)
