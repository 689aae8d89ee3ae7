from rollcall.functions.markup import extract_groups, observe_bad, repair, split_bad
from rollcall.functions.measures import co_members, share_hundredths
from rollcall.functions.specs import (
    Bin,
    category_of,
    parse_bins,
    parse_categories,
    parse_ranges,
)

__all__ = [
    "Bin",
    "category_of",
    "co_members",
    "extract_groups",
    "observe_bad",
    "parse_bins",
    "parse_categories",
    "parse_ranges",
    "repair",
    "share_hundredths",
    "split_bad",
]
