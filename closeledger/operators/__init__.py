"""Relational operators of the ledger extracts, each a composition of
built-in DataFrame operations."""

from closeledger.operators.balances import balance, nonzero, nonzero_keys
from closeledger.operators.control import check_reconciled, reconcile, row_count
from closeledger.operators.dimension import DEFAULT_BROADCAST_ROWS, bounded, bounded_broadcast
from closeledger.operators.hierarchy import duplicate_leaf_impact, duplicate_leaves, in_hierarchy, join_leaves, leaf_set, member_flag
from closeledger.operators.rules import FLAG, HierarchyRef, SegmentRule, tag_one, tag_segments, tag_segments_union
from closeledger.operators.watermark import EMPTY_WATERMARK, up_to, watermark_bound, watermark_frame

__all__ = [
    "DEFAULT_BROADCAST_ROWS",
    "EMPTY_WATERMARK",
    "FLAG",
    "HierarchyRef",
    "SegmentRule",
    "balance",
    "bounded",
    "bounded_broadcast",
    "check_reconciled",
    "duplicate_leaf_impact",
    "duplicate_leaves",
    "in_hierarchy",
    "join_leaves",
    "leaf_set",
    "member_flag",
    "nonzero",
    "nonzero_keys",
    "reconcile",
    "row_count",
    "tag_one",
    "tag_segments",
    "tag_segments_union",
    "up_to",
    "watermark_bound",
    "watermark_frame",
]
