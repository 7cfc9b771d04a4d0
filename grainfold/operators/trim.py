"""Per-group tail trim without sorting a group in one task.

A group may be a tenth of the data. Instead of ranking its rows, the trim searches the
value at the cut: a histogram per group finds the bucket the cut falls in, the next
histogram splits that bucket, until few rows are left in it. Every round is one scan with a
map-side aggregate; the driver sees one row per group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grainfold.functions.numbers import all_finite, kept_rows
from grainfold.session import written


WIDE = 1e6


def trim_group_tail(
    rows: DataFrame,
    group: str,
    by: str,
    ties: Sequence[str],
    keep: float = 0.9,
    buckets: int = 4096,
    rank_rows: int = 100_000,
) -> DataFrame:
    """Keep the ``floor(keep * n) + 1`` rows with the smallest ``by`` in every group.

    Among equal ``by`` the smaller ``ties`` stay. The result has ``group``, ``by``, ``ties``
    and ``copies``: rows at the cut that are equal in all of these are given once, with the
    number of them that is kept; elsewhere ``copies`` is 1. All ordering columns are doubles;
    rows with a null, NaN or infinite one are dropped first and do not count in n. ``rank_rows`` bounds the rows of a group that are ranked in one task.
    ``rows`` is scanned several times, so pass a table or a narrow projection of one.
    """
    order = [by, *ties]
    rows = rows.select(group, *order).where(all_finite(order))
    cuts = _find_cuts(rows, group, order, keep, buckets, rank_rows)
    placed = rows.join(cuts, group)
    bounded = _bounded(placed, order)
    inside = placed.where(~F.col("_all") & _in_region(bounded))
    before = placed.where(F.col("_all") | _before_region(bounded))

    folded = inside.groupBy(group, *order, "_need").agg(F.count(F.lit(1)).alias("_n"))
    ranked = Window.partitionBy(group).orderBy(*order)
    upto = F.sum("_n").over(ranked.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    at_cut = (
        folded.withColumn("_upto", upto)
        .withColumn("copies", F.least("_n", F.col("_need") - F.col("_upto") + F.col("_n")))
        .where(F.col("copies") > 0)
    )
    columns = [group, *order]
    whole = before.select(*columns, F.lit(1).cast("long").alias("copies"))
    return whole.unionByName(at_cut.select(*columns, "copies"))


def _find_cuts(rows, group, order, keep, buckets, rank_rows) -> DataFrame:
    """One row per group with the region its cut lies in.

    ``_low_j`` and ``_high_j`` bound ordering column j inside the region and are null where
    it is not bounded; ``_need`` rows of the region are kept, after all rows before it.
    The regions are a table throughout; of all groups the driver sees one row with the number of
    those still searched and the deepest bounded column.
    """
    size, low, high = F.count(F.lit(1)), F.min(order[0]), F.max(order[0])
    regions = rows.groupBy(group).agg(size.alias("_size"), low.alias("_low0"), high.alias("_high0"))
    regions = regions.withColumn("_need", kept_rows(keep, F.col("_size")))
    regions = regions.withColumns({
        "_all": F.col("_need") == F.col("_size"), "_at": F.lit(0), "_stuck": F.lit(False),
        **{f"{side}{j}": F.lit(None).cast("double") for j in range(1, len(order)) for side in ("_low", "_high")},
    })
    regions = written(_with_open(regions, order, rank_rows), "regions")
    while True:
        searched, deepest = regions.agg(F.count_if("_open"), F.max("_at")).first()
        unused = [f"{side}{j}" for j in range((deepest or 0) + 1, len(order)) for side in ("_low", "_high")]
        found = regions.drop("_open", "_size", "_at", "_stuck", *unused)
        if not searched:
            return found
        asked = regions.where("_open").drop("_open", "_size", "_at", "_all", *unused)
        split = _split_regions(rows.join(asked, group), group, order, buckets)
        regions = written(_with_open(_narrowed(regions, split, group, order), order, rank_rows), "regions")


def _with_open(regions: DataFrame, order: Sequence[str], rank_rows: int) -> DataFrame:
    """Groups whose region is small enough, or all one row, need no further search."""
    last = len(order) - 1
    one_row = (F.col("_at") == last) & F.coalesce(F.col(f"_low{last}") == F.col(f"_high{last}"), F.lit(False))
    return regions.withColumn("_open", ~F.col("_all") & (F.col("_size") > rank_rows) & ~one_row)


def _narrowed(regions: DataFrame, split: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Regions with the buckets that ``split`` has found for some groups."""
    both = regions.join(split, group, "left")
    new, at = F.col("low").isNotNull(), F.col("_at")
    one_value = new & (F.col("low") == F.col("high")) & (at < len(order) - 1)
    columns, stuck = {}, F.lit(False)
    for j in range(len(order)):
        old_low, old_high = F.col(f"_low{j}"), F.col(f"_high{j}")
        here, following = new & (at == j), one_value & (at == j - 1)
        for side, old in (("low", old_low), ("high", old_high)):
            columns[f"_{side}{j}"] = F.when(here, F.col(side)).when(following, F.col(f"next_{side}")).otherwise(old)
        stuck = stuck | (here & (F.col("low") == old_low) & (F.col("high") == old_high) & (F.col("low") < F.col("high")))
    columns |= {
        "_size": F.coalesce("size", "_size"), "_need": F.coalesce("need", "_need"),
        "_at": at + one_value.cast("int"), "_stuck": stuck,
    }
    return both.withColumns(columns).drop("need", "size", "low", "high", "next_low", "next_high")


def _split_regions(placed: DataFrame, group: str, order: Sequence[str], buckets: int):
    """The bucket each group's cut falls in: its size, its bounds and the rows still needed."""
    bounded = _bounded(placed, order)
    depth = len(bounded)

    def searched(column_at):
        """The column at the last bound of the group's region."""
        at = column_at(depth - 1)
        for j in reversed(range(depth - 1)):
            at = F.when(F.col(f"_low{j + 1}").isNull(), column_at(j)).otherwise(at)
        return at

    value = searched(lambda j: F.col(order[j]))
    low = searched(lambda j: F.col(f"_low{j}"))
    high = searched(lambda j: F.col(f"_high{j}"))
    following = searched(lambda j: F.col(order[min(j + 1, len(order) - 1)]))
    # over a wide range equal steps of the logarithm, so that a few huge values cost one round
    wide = F.coalesce(high / 2 - low / 2 > WIDE, F.lit(False))
    at, least, most = (F.when(wide, _squeezed(x)).otherwise(x) for x in (value, low, high))
    share = F.when(most > least, (at - least) / (most - least)).otherwise(0.0)
    bucket = F.least(F.floor(share * buckets), F.lit(buckets - 1))
    # values too close together for buckets: the least one, and all others
    bucket = F.when(F.col("_stuck"), (value > low).cast("bigint")).otherwise(bucket)
    counts = (
        placed.where(_in_region(bounded))
        .select(group, F.col("_need").alias("_left"), bucket.alias("_bucket"),
                value.alias("_value"), following.alias("_next"))
        .groupBy(group, "_left", "_bucket")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.min("_value").alias("low"),
            F.max("_value").alias("high"),
            F.min("_next").alias("next_low"),
            F.max("_next").alias("next_high"),
        )
    )
    upto = Window.partitionBy(group).orderBy("_bucket")
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        counts.withColumn("_upto", F.sum("size").over(upto))
        .withColumn("need", F.col("_left") - F.col("_upto") + F.col("size"))
        .where((F.col("need") > 0) & (F.col("need") <= F.col("size")))
        .select(group, "need", "size", "low", "high", "next_low", "next_high")
    )


def _squeezed(value: Column) -> Column:
    return F.signum(value) * F.log1p(F.abs(value))


def _bounded(placed: DataFrame, order: Sequence[str]) -> Sequence[str]:
    """The ordering columns that are bounded in the region of at least one group."""
    return [name for j, name in enumerate(order) if f"_low{j}" in placed.columns]


def _in_region(bounded: Sequence[str]) -> Column:
    within = [
        F.col(name).between(F.col(f"_low{j}"), F.col(f"_high{j}"))
        for j, name in enumerate(bounded)
    ]
    # the first column is always bounded, later ones may be free in some groups
    free = [F.col(f"_low{j}").isNull() for j in range(1, len(bounded))]
    return reduce(and_, [within[0], *(f | w for f, w in zip(free, within[1:]))])


def _before_region(bounded: Sequence[str]) -> Column:
    """Rows that sort before every row of the region."""
    before = F.lit(False)
    for j, name in reversed(list(enumerate(bounded))):
        low, value = F.col(f"_low{j}"), F.col(name)
        before = (value < low) | ((value == low) & (F.col(f"_high{j}") == low) & before)
        before = F.coalesce(before, F.lit(False)) if j else before
    return before
