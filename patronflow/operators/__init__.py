"""DataFrame-level building blocks."""

from .aggregates import (control_totals, distinct_values, first_by_key,
                         first_last, frequency_table, global_median,
                         median_by)
from .codes import TextCodes, packed_order, text_codes
from .joins import duplicate_keys, left_join, right_join
from .quantiles import exact_quantiles, sketch_quantiles, sketch_size
from .reshape import (concat_by_group, crosstab, explode_array, explode_named,
                      fill_na, flatten_structs, melt_pairs, pair_counts, pivot_flags,
                      pivot_wide, values_of)
from .reuse import hold, hold_by, lazily
from .totals import Totals, TotalsDiffer

__all__ = [
    "TextCodes", "Totals", "TotalsDiffer", "packed_order", "text_codes",
    "concat_by_group", "control_totals", "crosstab", "distinct_values",
    "duplicate_keys", "exact_quantiles", "explode_array", "explode_named",
    "fill_na", "first_by_key", "hold_by", "sketch_quantiles", "sketch_size", "first_last", "flatten_structs",
    "frequency_table", "global_median", "hold", "lazily",
    "left_join", "median_by",
    "melt_pairs", "pair_counts", "pivot_flags", "pivot_wide", "right_join", "values_of",
]
