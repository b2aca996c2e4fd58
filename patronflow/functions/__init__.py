"""Column-level rules shared by all reports."""

from .bins import bin_index, equal_width_bin, recode
from .dates import (day_of, days_between, format_day, month_label, month_of,
                    month_offset, start_of_month, start_of_previous_month)
from .nulls import (collated, count_distinct_na, empty_fallback, fill_from, if_na,
                    strict_max, strict_min, strict_sum)
from .numbers import cast_numeric, ratio, round_half_even
from .states import (INVALID_STATES, device_class, is_canceled, is_open,
                     is_valid, valid_only)
from .text import (cascade, first_name, fold_ascii, last_match, matches,
                   split_pick)

__all__ = [
    "INVALID_STATES", "bin_index", "cascade", "cast_numeric", "collated",
    "count_distinct_na", "day_of", "days_between", "device_class",
    "empty_fallback", "equal_width_bin", "fill_from", "first_name",
    "fold_ascii", "format_day", "if_na", "is_canceled", "is_open", "is_valid",
    "last_match", "matches", "month_label", "month_of", "month_offset",
    "ratio", "recode", "round_half_even", "split_pick", "start_of_month",
    "start_of_previous_month", "strict_max", "strict_min", "strict_sum",
    "valid_only",
]
