from rollcall.operators.histograms import (
    bin_by_category,
    bin_by_range,
    bin_sizes,
    histogram_by,
    size_histogram,
    size_histograms,
)
from rollcall.operators.lookup import attach_category
from rollcall.operators.members import attach_records, explode_members, membership_counts, record_sizes
from rollcall.operators.ranks import with_rank
from rollcall.operators.scores import contribution_scores, sort_scores, top_bottom
from rollcall.operators.stats import member_stats

__all__ = [
    "attach_category",
    "attach_records",
    "bin_by_category",
    "bin_by_range",
    "bin_sizes",
    "contribution_scores",
    "explode_members",
    "histogram_by",
    "membership_counts",
    "member_stats",
    "record_sizes",
    "size_histogram",
    "size_histograms",
    "sort_scores",
    "top_bottom",
    "with_rank",
]
