"""Table operators: DataFrames in, DataFrame out."""

from .distinct import distinct_counts
from .joins import left_lookup
from .ordering import following_value, ordered_blocks, surrogate_key
from .profile import column_profile, table_profile
from .ranking import latest_per_key, top_n, top_n_per_group
from .rollup import roll_up

__all__ = [
    "column_profile",
    "distinct_counts",
    "following_value",
    "latest_per_key",
    "left_lookup",
    "ordered_blocks",
    "roll_up",
    "surrogate_key",
    "table_profile",
    "top_n",
    "top_n_per_group",
]
