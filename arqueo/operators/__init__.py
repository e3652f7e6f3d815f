"""Generic DataFrame -> DataFrame operators of the engine."""

from .agg import (conditional_rows, distinct_values, group_having, group_min_max, group_sum,  # noqa: F401
                  latest_period, percent, period_end, pivot_sum, row_total, sum_numeric, totals)
from .filters import (beyond, classify, codes, date_bound, dropna, fill0, flag_mismatch, front,  # noqa: F401
                      matches, negate, numeric_cols, only_diff, overwrite, prefix_columns, prefix_filter,
                      up_to, with_literals, years)
from .joins import (anti, as_of_years, concat_columns, enrich, full_detail,  # noqa: F401
                    having_semi, hierarchy, inner, lookup, natural_join, semi, star)
from .netting import monthly_snapshots, net_pending, net_pending_semi  # noqa: F401
from .reconcile import match_vouchers, reconcile, subtract  # noqa: F401
from .reshape import dedupe_subset, union_all, unpivot  # noqa: F401
from .topk import recent_years, sort_out, top_keys, top_n, top_n_other  # noqa: F401
from .windows import (cumulative, dedupe, forward_fill, latest_snapshot, rank_by,  # noqa: F401
                      running_balance, severity_rank, share)
