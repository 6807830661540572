"""Reusable plan fragments built from DataFrame operators."""

from regstar.operators.aggregates import arg_max_rows, share_of, weighted_share
from regstar.operators.asof import as_of
from regstar.operators.lookup import bounded_broadcast, lookup, repeats, role_lookup
from regstar.operators.nearest import nearest_codes, proposals
from regstar.operators.quality import duplicate_keys, orphans, orphans_by_key, unmapped_codes
from regstar.operators.recode import latest_source, recode, union_all, union_distinct
from regstar.operators.runtime_filter import may_match

__all__ = [
    "arg_max_rows",
    "as_of",
    "bounded_broadcast",
    "duplicate_keys",
    "latest_source",
    "lookup",
    "may_match",
    "nearest_codes",
    "orphans",
    "orphans_by_key",
    "proposals",
    "recode",
    "repeats",
    "role_lookup",
    "share_of",
    "union_all",
    "union_distinct",
    "unmapped_codes",
    "weighted_share",
]
