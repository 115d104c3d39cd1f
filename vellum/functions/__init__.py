from vellum.functions.dates import month_floor, month_index, month_range, next_month
from vellum.functions.text import (
    CASE_ACCENT_INSENSITIVE,
    CASE_INSENSITIVE,
    collapse_spaces,
    normalise_name,
    not_equal_collated,
    strip_unicode,
    title_case,
)

__all__ = [
    "CASE_ACCENT_INSENSITIVE",
    "CASE_INSENSITIVE",
    "collapse_spaces",
    "month_floor",
    "month_index",
    "month_range",
    "next_month",
    "normalise_name",
    "not_equal_collated",
    "strip_unicode",
    "title_case",
]
