"""Plan-shape helpers shared by the operators: lineage, skew, range blocks."""

from textmill.plans.layout import bounded_broadcast, buckets_for, spread
from textmill.plans.lineage import Dealt, materialize, scratch_dir
from textmill.plans.ordering import block_of, global_rank, range_bounds, running_sum, wide_rank
from textmill.plans.skew import hot_values, lookup_join, salted_join

__all__ = [
    "Dealt",
    "block_of",
    "bounded_broadcast",
    "buckets_for",
    "global_rank",
    "hot_values",
    "lookup_join",
    "materialize",
    "range_bounds",
    "running_sum",
    "salted_join",
    "scratch_dir",
    "spread",
    "wide_rank",
]
