"""Segment tagging by an index over the rules, for many rules.

``rules.tag_segments`` holds every rule in the plan; with thousands of rules the
plan itself becomes the cost.  Here the rules are data, and the plan depends on
the ledger's columns only:

* every rule has an anchor, the one of its code equalities whose column tells the
  rules apart best, and its accounts as disjoint intervals, each listed under the
  account bins it touches (bin edges are quantiles of the intervals' ends, at most
  ``BINS`` of them, found by a balanced tree of comparisons);
* a line offers each anchor column's value with its own account bin, and one equi
  join finds the rules' rows; the account range and the other codes are checked on
  the pairs found;
* hierarchy memberships of a line come from one join per code column with the
  leaves of all the nodes the rules name, as the set of nodes a code lies under.

A rule meets a line through one of its rows at most, so the result has one row
per (line, matching rule), as the UNION ALL of all rules.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closeledger.functions.labels import tag
from closeledger.operators.dimension import DEFAULT_BROADCAST_ROWS, bounded, salted_join
from closeledger.operators.rules import FLAG, SegmentRule, check_flags

#: Account bins at most.
BINS = 64
#: Names of an anchor and a bin that every line offers.
ANY, ANY_BIN = "", -1

Interval = tuple[str, str]


def intervals(rule: SegmentRule) -> list[Interval] | None:
    """The rule's accounts as disjoint intervals, ascending; None: all."""
    if rule.account_range is None and not rule.account_list:
        return None
    found = [(a, a) for a in rule.account_list]
    if rule.account_range is not None and rule.account_range[0] <= rule.account_range[1]:
        found.append(tuple(rule.account_range))
    out: list[Interval] = []
    for low, high in sorted(found):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def edges(found: list[Interval]) -> list[str]:
    """Lower edges of all bins but the first."""
    ends = sorted({e for i in found for e in i})
    step = max(1, -(-len(ends) // (BINS - 1)))
    return ends[::step]


def _bin(account: Column, cuts: list[str], first: int = 0) -> Column:
    """Number of edges up to an account, by halving."""
    if not cuts:
        return F.lit(first)
    mid = len(cuts) // 2
    return F.when(account < F.lit(cuts[mid]), _bin(account, cuts[:mid], first)).otherwise(_bin(account, cuts[mid + 1 :], first + mid + 1))


def _bins_of(interval: Interval, cuts: list[str]) -> range:
    low, high = (sum(c <= e for c in cuts) for e in interval)
    return range(low, high + 1)


class RuleIndex:
    """The rules as rows, and what the plan needs to know of them."""

    def __init__(self, rules: list[SegmentRule]) -> None:
        check_flags(rules)
        self.rules = rules
        accounts = {r.account_column for r in rules}
        if len(accounts) > 1:
            raise ValueError(f"the rules look at several account columns: {sorted(accounts)}")
        [self.account] = accounts
        self.codes = sorted({c for r in rules for c, _ in r.codes})
        self.refs = sorted({h for r in rules for h in r.hierarchies}, key=repr)
        self.pairs = sorted({(h.column, h.letter) for h in self.refs})
        kinds = {c: len({v for r in rules for k, v in r.codes if k == c}) for c in self.codes}
        self.anchors = {r.flag: max((c for c, _ in r.codes), key=lambda c: (kinds[c], c), default=ANY) for r in rules}
        self.cuts = edges([i for r in rules for i in intervals(r) or ()])

    def rows(self) -> list[tuple]:
        """anchor, value, bin, flag, low, high, a value or None per code
        column, a list of nodes or None per pair."""
        out = []
        for r in self.rules:
            wanted = dict(r.codes)
            if len(set(r.codes)) > len(wanted) or None in wanted.values():
                continue  # two values for one column, or NULL: never true
            anchor, found = self.anchors[r.flag], intervals(r)
            nodes = [[self.refs.index(h) for h in r.hierarchies if (h.column, h.letter) == p] or None for p in self.pairs]
            rest = [r.flag, *[wanted.get(c) for c in self.codes], *nodes]
            places = [(ANY_BIN, None, None)] if found is None else [(b, *i) for i in found for b in _bins_of(i, self.cuts)]
            out += [(anchor, wanted.get(anchor, ANY), b, low, high, *rest) for b, low, high in places]
        return out

    def schema(self) -> str:
        codes = [f"_r_code{i} string" for i in range(len(self.codes))]
        nodes = [f"_r_nodes{i} array<int>" for i in range(len(self.pairs))]
        return ", ".join(["_r_anchor string", "_r_value string", "_r_bin int", "_r_low string", "_r_high string", "_r_flag string", *codes, *nodes])

    def members(self, leaves: DataFrame) -> DataFrame:
        """(_leaf, _nodes): the numbers of the rules' nodes a leaf lies under."""
        nodes = [(i, h.node, h.tree) for i, h in enumerate(self.refs)]
        named = leaves.sparkSession.createDataFrame(nodes, "_n int, _node string, _tree string")
        same = (F.col("node") == F.col("_node")) & (F.col("_tree").isNull() | (F.col("treecd") == F.col("_tree")))
        return leaves.join(F.broadcast(named), same).groupBy(F.col("leaf").alias("_leaf")).agg(F.collect_set("_n").alias("_nodes"))


def tag_segments_indexed(
    df: DataFrame, leaves: DataFrame, rules: list[SegmentRule] | tuple[SegmentRule, ...], max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS
) -> DataFrame:
    """``rules.tag_segments`` by the index: ``df`` plus column ``bus_flg``,
    one row per (line, matching rule)."""
    index, spark = RuleIndex(list(rules)), df.sparkSession
    out = df
    if index.pairs:
        members = index.members(leaves)
        (small,) = bounded([members], max_broadcast_rows)
        for i, (column, letter) in enumerate(index.pairs):
            side = members.select(F.col("_leaf").alias(f"_leaf{i}"), F.col("_nodes").alias(f"_nodes{i}"))
            key, leaf = tag(letter, F.col(column)), F.col(f"_leaf{i}")
            out = out.join(F.broadcast(side), key == leaf, "left") if small else salted_join(out, side, key, leaf, "left")
            out = out.drop(f"_leaf{i}")
    account = F.col(index.account)
    own_bin = F.when(account.isNotNull(), _bin(account, index.cuts))
    offers = [
        F.struct(F.lit(a).alias("anchor"), (F.lit(ANY) if a == ANY else F.col(a)).alias("value"), b.alias("bin"))
        for a in sorted(set(index.anchors.values()))
        for b in (own_bin, F.lit(ANY_BIN))
    ]
    out = out.withColumn("_offer", F.explode(F.array(*offers)))
    found = spark.createDataFrame(index.rows(), index.schema())
    on = (F.col("_offer.anchor") == F.col("_r_anchor")) & (F.col("_offer.value") == F.col("_r_value")) & (F.col("_offer.bin") == F.col("_r_bin"))
    (small,) = bounded([found], max_broadcast_rows)
    if small:
        out = out.join(F.broadcast(found), on)
    else:
        key = lambda *c: F.concat_ws("\x00", *[F.col(x).cast("string") for x in c])
        out = out.filter("_offer.value IS NOT NULL AND _offer.bin IS NOT NULL").withColumn("_key", key("_offer.anchor", "_offer.value", "_offer.bin"))
        out = salted_join(out, found.withColumn("_r_key", key("_r_anchor", "_r_value", "_r_bin")), F.col("_key"), F.col("_r_key"), "inner").drop("_key", "_r_key")
    checks = [F.col("_r_low").isNull() | account.between(F.col("_r_low"), F.col("_r_high"))]
    checks += [F.col(f"_r_code{i}").isNull() | (F.col(c) == F.col(f"_r_code{i}")) for i, c in enumerate(index.codes)]
    none = F.array().cast("array<int>")
    checks += [
        F.col(f"_r_nodes{i}").isNull() | (F.size(F.array_except(f"_r_nodes{i}", F.coalesce(F.col(f"_nodes{i}"), none))) == 0) for i in range(len(index.pairs))
    ]
    return out.filter(reduce(lambda a, b: a & b, checks)).select(*[F.col(f"`{c}`") for c in df.columns], F.col("_r_flag").alias(FLAG))


def anchor_load(rules: list[SegmentRule]) -> Counter:
    """Rows of the index per (anchor, value, bin): the rules that one line
    meets at most through one offer."""
    return Counter(r[:3] for r in RuleIndex(list(rules)).rows())
