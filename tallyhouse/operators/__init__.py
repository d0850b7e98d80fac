from tallyhouse.operators.counts import (
    argmax_group,
    count_by,
    count_where,
    distinct_count,
    domain_counts,
    row_count,
    top_counts,
    top_rows,
)
from tallyhouse.operators.extremes import extreme_rows_by_group, extremes_by_group, widest_spread
from tallyhouse.operators.keys import new_rows
from tallyhouse.operators.lists import items_by_group
from tallyhouse.operators.quality import (
    duplicate_groups,
    empty_row_records,
    empty_rows,
    quality_report,
    repeated_row_records,
)
from tallyhouse.operators.ranks import mean_and_median_by_rank
from tallyhouse.operators.sketched import top_counts_by_cells
from tallyhouse.operators.skipping import files_that_may_hold, write_key_index
from tallyhouse.operators.totals import describe_totals, extreme_total, mean_and_median, totals_by

__all__ = [
    "argmax_group",
    "count_by",
    "count_where",
    "describe_totals",
    "distinct_count",
    "domain_counts",
    "duplicate_groups",
    "empty_row_records",
    "empty_rows",
    "extreme_rows_by_group",
    "extreme_total",
    "extremes_by_group",
    "files_that_may_hold",
    "items_by_group",
    "mean_and_median",
    "mean_and_median_by_rank",
    "new_rows",
    "quality_report",
    "repeated_row_records",
    "row_count",
    "top_counts",
    "top_counts_by_cells",
    "top_rows",
    "totals_by",
    "widest_spread",
    "write_key_index",
]
