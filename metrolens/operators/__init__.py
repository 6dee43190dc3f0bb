"""DataFrame -> DataFrame operators (lazy unless stated)."""

from metrolens.operators.aggregates import (
    conditional_count,
    global_count,
    group_avg,
    group_count,
    group_sum,
    share_by,
)
from metrolens.operators.exact import exact_stats
from metrolens.operators.joins import JOIN_STRATEGIES, BroadcastRefused, hinted_join, ratio_join, with_strategy
from metrolens.operators.nearest import assign_nearest, distinct_points, nearest_join, nearest_summary
from metrolens.operators.ranking import group_count_sql, register_view, topk_per_group, topk_sql
from metrolens.operators.ranking_all import rank_all
from metrolens.operators.setops import bucket_diff, diff_tables, except_distinct, same_rows, union_all
from metrolens.operators.skew import skew_join
from metrolens.operators.sorting import limit_n, with_position

__all__ = [
    "conditional_count", "global_count", "group_avg", "group_count", "group_sum", "share_by",
    "JOIN_STRATEGIES", "BroadcastRefused", "hinted_join", "ratio_join", "with_strategy",
    "assign_nearest", "distinct_points", "nearest_join", "nearest_summary",
    "group_count_sql", "register_view", "topk_per_group", "topk_sql",
    "rank_all", "skew_join", "exact_stats",
    "bucket_diff", "diff_tables", "except_distinct", "same_rows", "union_all",
    "limit_n", "with_position",
]
