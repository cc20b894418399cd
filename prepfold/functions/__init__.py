"""Column expressions shared by the operators."""

from .scalar import (day_of_week, excluding, half_up, inverse_log, iso_day_of_week,
                     like_flag, log_or_null, null_if_above, parse_date, safe_div,
                     to_double)

__all__ = ["day_of_week", "excluding", "half_up", "inverse_log", "iso_day_of_week",
           "like_flag", "log_or_null", "null_if_above", "parse_date", "safe_div",
           "to_double"]
