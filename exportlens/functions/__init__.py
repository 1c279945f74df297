"""Column-level helpers. Everything here is a native Spark expression."""

from exportlens.functions.bands import band, bin_right, tag_contains
from exportlens.functions.exact import (
    as_double,
    avg_ratio,
    avg_when,
    clamp,
    count_when,
    dec,
    mean,
    mean_double,
    money_sum,
    pct,
    rate_pct,
    ratio_of_sums,
    round_half_even,
    round_half_up,
    round_mean,
    round_ratio,
    safe_div,
    scale_units,
    sum_when,
)
from exportlens.functions.text import days_since, ordered_join, padded_id, short_text

__all__ = [
    "as_double", "avg_ratio", "avg_when", "band", "bin_right", "clamp", "count_when",
    "days_since", "dec", "mean", "mean_double", "money_sum", "ordered_join", "padded_id", "pct",
    "rate_pct", "ratio_of_sums", "round_half_even", "round_half_up", "round_mean", "round_ratio",
    "safe_div",
    "scale_units", "short_text", "sum_when", "tag_contains",
]
