"""Segment rules: data-driven business-segment labelling of ledger lines.

A ``SegmentRule`` is a conjunction of code equalities, an account condition
(inclusive *string* range, allow-list, or either) and hierarchy memberships.
Every line that satisfies a rule is labelled with the rule's flag.

``tag_segments`` does this in one pass over the fact: it filters once by
the OR of the rules' column predicates (pushed into the scan), marks each
distinct hierarchy membership once with a left join against a
de-duplicated, size-checked broadcast leaf set, builds the array of
matching flags and explodes it.  A line that meets two rules therefore
appears once per rule, which is what a UNION ALL of one SELECT per rule
gives, without scanning the fact once per rule.  ``tag_segments_union``
is that literal UNION ALL form, kept for equivalence tests and benchmarks.

Predicates compare raw codes: ``'99999 '`` is outside ``'40000'..'99999'``
and ``'15050 '`` is not in the list.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeledger.functions.labels import tag
from closeledger.operators.dimension import DEFAULT_BROADCAST_ROWS, broadcast_or_restrict
from closeledger.operators.hierarchy import in_hierarchy, leaf_set, member_flag
from closeledger.operators.membership import membership_filter

FLAG = "bus_flg"


@dataclass(frozen=True)
class HierarchyRef:
    """``letter || column`` must be a leaf under ``node`` of ``tree``."""

    column: str
    letter: str
    node: str
    tree: str | None = None


@dataclass(frozen=True)
class SegmentRule:
    flag: str
    codes: tuple[tuple[str, str], ...] = ()
    account_range: tuple[str, str] | None = None
    account_list: tuple[str, ...] = ()
    hierarchies: tuple[HierarchyRef, ...] = field(default_factory=tuple)
    account_column: str = "account"

    def with_code(self, column: str, value: str) -> SegmentRule:
        """The same rule with one more code equality (e.g. a ledger)."""
        return replace(self, codes=tuple(c for c in self.codes if c[0] != column) + ((column, value),))

    def columns(self) -> list[str]:
        """Fact columns that the rule looks at."""
        return [*(c for c, _ in self.codes), self.account_column, *(h.column for h in self.hierarchies)]

    def column_predicate(self) -> Column:
        """Everything except hierarchy membership, on raw values."""
        parts = [F.col(c) == F.lit(v) for c, v in self.codes]
        acct = F.col(self.account_column)
        account_terms = []
        if self.account_range is not None:
            lo, hi = self.account_range
            account_terms.append(acct.between(F.lit(lo), F.lit(hi)))
        if self.account_list:
            account_terms.append(acct.isin(*self.account_list))
        if account_terms:
            parts.append(reduce(lambda a, b: a | b, account_terms))
        return reduce(lambda a, b: a & b, parts) if parts else F.lit(True)


def _any(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, preds)


def check_flags(rules: list[SegmentRule]) -> None:
    """Rules are aggregated one by one, so two may not share a flag."""
    if not rules:
        raise ValueError("at least one segment rule is required")
    if len({r.flag for r in rules}) < len(rules):
        raise ValueError("two segment rules have one flag; their balances would be merged")


def tag_segments(
    df: DataFrame,
    leaves: DataFrame,
    rules: list[SegmentRule] | tuple[SegmentRule, ...],
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    grain: list[str] | None = None,
) -> DataFrame:
    """Single-pass labelling: ``df`` plus column ``bus_flg``, one row per
    (line, matching rule); lines matching no rule are dropped.

    A leaf set that is neither small nor small after the cut to used codes needs
    a shuffle join.  Lines that can match no rule by the membership filters of
    such sets are dropped before it, and with ``grain`` (the keys that the
    caller sums ``amount`` by) the others are summed to groups first."""
    rules = list(rules)
    check_flags(rules)
    out = df.filter(_any([r.column_predicate() for r in rules]))

    refs: list[HierarchyRef] = []
    for r in rules:
        for h in r.hierarchies:
            if h not in refs:
                refs.append(h)
    flag_of = {}
    # one size check for every leaf set (raw listings bound the distinct
    # sets); a set too large is cut to the codes the lines carry
    keys = [tag(h.letter, F.col(h.column)) for h in refs]
    sides = broadcast_or_restrict(
        [leaf_set(leaves, h.node, h.tree, distinct=False) for h in refs], ["leaf"] * len(refs), keys, out, max_broadcast_rows
    )
    if not all(small for _, small in sides):
        out = _thinned(out, rules, refs, keys, sides, max_broadcast_rows)
        if grain is not None:
            needed = [*grain, *(c for r in rules for c in r.columns())]
            out = out.groupBy(*dict.fromkeys(needed)).agg(F.sum("amount").alias("amount"))
    for i, (h, key, (side, small)) in enumerate(zip(refs, keys, sides)):
        name = f"__in_{i}"
        flag_of[h] = name
        out = member_flag(out, key, side, name, small=small)

    def full(r: SegmentRule) -> Column:
        return reduce(lambda a, b: a & b, [r.column_predicate()] + [F.col(flag_of[h]) for h in r.hierarchies])

    if len(rules) == 1 and not refs:
        return out.withColumn(FLAG, F.lit(rules[0].flag))
    # one candidate per rule (NULL when the rule does not match), exploded
    # and filtered: all of it stays in generated code (no lambda functions)
    flags = F.array(*[F.when(full(r), F.lit(r.flag)) for r in rules])
    return out.withColumn(FLAG, F.explode(flags)).filter(F.col(FLAG).isNotNull()).drop(*flag_of.values())


def _thinned(df: DataFrame, rules, refs, keys, sides, max_broadcast_rows: int) -> DataFrame:
    """Lines that may still match a rule by the filters of the large sets."""
    maybe = {}
    for i, (h, key, (side, small)) in enumerate(zip(refs, keys, sides)):
        kept = None if small else membership_filter(side, "leaf", max_broadcast_rows)
        if kept is not None:
            maybe[h] = f"__maybe_{i}"
            df = kept.flag(df, key, maybe[h])
    if not maybe:
        return df
    may_match = [reduce(lambda a, b: a & b, [r.column_predicate()] + [F.col(maybe[h]) for h in r.hierarchies if h in maybe]) for r in rules]
    return df.filter(_any(may_match)).drop(*maybe.values())


def tag_one(
    df: DataFrame,
    leaves: DataFrame,
    rule: SegmentRule,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Lines of one rule, with memberships as left semi joins (the
    ``IN (select leaf ...)`` form)."""
    out = df.filter(rule.column_predicate())
    for h in rule.hierarchies:
        out = in_hierarchy(out, h.column, h.letter, leaves, h.node, h.tree, max_broadcast_rows)
    return out.withColumn(FLAG, F.lit(rule.flag))


def tag_segments_union(
    df: DataFrame,
    leaves: DataFrame,
    rules: list[SegmentRule] | tuple[SegmentRule, ...],
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """One scan per rule, then UNION ALL of the lines; with one flag per rule,
    aggregates over it are those of each rule."""
    check_flags(list(rules))
    parts = [tag_one(df, leaves, r, max_broadcast_rows) for r in rules]
    return reduce(lambda a, b: a.unionByName(b), parts)
