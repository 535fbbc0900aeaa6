from gridledger.operators.checks import assert_unique, control_total, diff_tables, row_digests
from gridledger.operators.intervals import attach_range, interval_index, range_lookup
from gridledger.operators.joins import (
    anti_join,
    attach_either,
    cascade_lookup,
    exact_or_wildcard,
    filter_pairs,
    lookup,
    spread_join,
)
from gridledger.operators.months import (
    calendar_frame,
    expand_between,
    first_month,
    gap_months,
    last_month,
    map_gaps,
    month_date,
    month_maps,
    months_of_year,
    project_on_calendar,
)
from gridledger.operators.sets import (
    append_common,
    append_mapped,
    intersect_distinct,
    union_distinct,
)
from gridledger.operators.updates import (
    assign,
    attach,
    attach_all,
    delete_matching,
    detach,
    keep_matching,
    matched,
    merge_update,
    overlay,
    unpack,
    update_where,
)
from gridledger.operators.windows import (
    count_distinct_over,
    fill_last,
    keep_extreme,
    qualify,
    top1,
)

__all__ = [
    "anti_join", "append_common", "append_mapped", "assert_unique", "assign", "attach", "attach_all", "attach_either", "attach_range",
    "calendar_frame", "cascade_lookup", "control_total", "count_distinct_over", "delete_matching", "detach",
    "diff_tables", "exact_or_wildcard", "expand_between", "fill_last", "filter_pairs", "first_month", "gap_months",
    "intersect_distinct", "interval_index", "keep_extreme", "keep_matching", "last_month", "lookup", "map_gaps", "matched", "merge_update", "month_date",
    "month_maps", "months_of_year", "overlay",
    "project_on_calendar", "qualify", "range_lookup", "row_digests", "spread_join", "top1", "union_distinct", "unpack",
    "update_where",
]
