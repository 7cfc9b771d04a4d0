"""Frequent itemsets and association rules."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainfold.functions.numbers import support_threshold
from grainfold.operators.counting import basket_blocks, counted, promising_pairs
from grainfold.session import written

#: Items of a fragment of a basket, about.
FRAGMENT = 100_000


# --- baskets ------------------------------------------------------------------------------


def basket_fragments(pairs: DataFrame, basket: str, item: str, length: int = FRAGMENT) -> DataFrame:
    """``basket, fragment, items``: the distinct items of a basket, ascending, about ``length`` a fragment.

    Fragments are numbered from 0; items go to them by their hash, so none is met twice. A basket
    of up to ``length`` items is one fragment. However large a basket is, no row holds more than a
    fragment of it. Null baskets and items take no part, so a basket of nulls only gives no row.
    """
    rows = pairs.select(F.col(basket).alias("_basket"), F.col(item).alias("_item"))
    rows = written(rows.where(F.col("_basket").isNotNull() & F.col("_item").isNotNull()).distinct(), "pairs")
    several = rows.groupBy("_basket").agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > length)
    several = written(several.select("_basket", F.ceil(F.col("_size") / length).alias("_fragments")), "large")
    rows = rows.join(several, "_basket", "left")
    fragment = F.pmod(F.xxhash64("_item"), F.coalesce("_fragments", F.lit(1))).cast("int")
    found = rows.groupBy("_basket", fragment.alias("fragment")).agg(F.array_sort(F.collect_list("_item")).alias("items"))
    return found.select(F.col("_basket").alias(basket), "fragment", "items")


def to_baskets(pairs: DataFrame, basket: str, item: str) -> DataFrame:
    """``basket, items``: the distinct items of a basket, ascending.

    Whole baskets as values of a row; ``basket_fragments`` is for baskets of any size.
    """
    parts = basket_fragments(pairs, basket, item)
    return parts.groupBy(basket).agg(F.array_sort(F.flatten(F.collect_list("items"))).alias("items"))


# --- frequent sets ------------------------------------------------------------------------


def frequent_itemsets(
    pairs: DataFrame,
    basket: str = "basket",
    item: str = "item",
    support: float = 0.3,
    max_size: int = 10,
) -> DataFrame:
    """``items, support`` of all sets of up to ``max_size`` items in enough baskets.

    ``pairs`` lists the items of every basket, repeats allowed. Enough is the rounded-down
    share ``support`` of all baskets, at least one.

    Baskets are packed into blocks of frequent items once. Tasks count the pairs of their own
    baskets and report those that reach their share there; pairs with a gap are counted again.
    Larger sets go size by size: candidates come from a join of the sets of one size, lose those
    with a rare part, and are counted in one scan. Sets and items stay in tables throughout.
    """
    distinct = pairs.select(F.col(basket).alias("basket"), F.col(item).alias("item"))
    distinct = written(distinct.dropna().distinct(), "pairs")
    least = support_threshold(support, distinct.select("basket").distinct().count())
    counts = distinct.groupBy("item").agg(F.count(F.lit(1)).alias("support"))
    numbered = _numbered(counts.where(F.col("support") >= least))
    levels = [numbered.select(F.array("item").alias("items"), "support")]
    if max_size < 2 or numbered.count() < 2:
        return levels[0]

    blocks = written(basket_blocks(distinct.join(numbered.select("item", "at"), "item"), 2), "baskets")
    level = written(_frequent_pairs(blocks, numbered, least), "level")
    for size in range(3, max_size + 2):
        levels.append(level.select("items", "support"))
        # a set of this size has as many parts that lack one item
        if size > max_size or level.count() < size:
            break
        found = counted(blocks, candidates(level, size)).where(F.col("n") >= least)
        level = written(found.withColumnRenamed("n", "support"), "level")
    return reduce(DataFrame.unionByName, levels)


def _numbered(items: DataFrame) -> DataFrame:
    """The rows with ``at``, numbers in the order of ``item``."""
    return written(items.sort("item").withColumn("at", F.monotonically_increasing_id()), "items")


def _frequent_pairs(blocks: DataFrame, numbered: DataFrame, least: int) -> DataFrame:
    """``positions, items, support`` of frequent pairs."""
    baskets = blocks.agg(F.sum(F.size("sizes")).cast("long")).first()[0]
    if not baskets:
        return numbered.limit(0).select(
            F.array("at").alias("positions"), F.array("item").alias("items"), "support")
    found = written(promising_pairs(blocks, least, baskets), "pair_counts")
    gap, several = found.where("x is null").agg(F.sum("missed"), F.count(F.lit(1)) > 1).first()
    known = found.where("x is not null").groupBy("x", "y").agg(F.sum("n").alias("n"), F.sum("missed").alias("covered"))
    frequent = known.where((F.col("n") >= least) & (F.col("covered") == gap)).select("x", "y", "n")
    if gap and several:  # else all of their chunks have reported them
        # not reported by all chunks, yet in enough baskets if the others have as many as they may
        asked = known.where((F.col("covered") < gap) & (F.col("n") + gap - F.col("covered") >= least))
        again = counted(blocks, asked.select(F.array("x", "y").alias("positions"), "x", "y"))
        frequent = frequent.unionByName(again.where(F.col("n") >= least).select("x", "y", "n"))
    names = numbered.select("at", "item")
    first, second = (names.select(F.col("at").alias(c), F.col("item").alias(f"_{c}")) for c in "xy")
    return frequent.join(first, "x").join(second, "y").select(
        F.array("x", "y").alias("positions"), F.array("_x", "_y").alias("items"), F.col("n").alias("support"))


def candidates(level: DataFrame, size: int) -> DataFrame:
    """``positions, items`` of sets of ``size`` all of whose parts that lack one item are in ``level``.

    Two sets that differ in the last item only make a candidate; its other parts are looked up.
    """
    sides = [
        level.selectExpr(
            f"slice(positions, 1, {size - 2}) _head", f"element_at(positions, -1) _{side}",
            f"positions _{side}_positions", f"items _{side}_items")
        for side in ("left", "right")
    ]
    made = sides[0].join(sides[1], "_head").where("_left < _right")
    # without either of the last two items a candidate is one of the two sets it was made from
    parts = made.selectExpr(
        "concat(_left_positions, array(_right)) positions",
        "concat(_left_items, slice(_right_items, -1, 1)) items",
        f"explode(sequence(0, {size - 3})) _out",
    ).selectExpr("positions", "items", "filter(positions, (_, at) -> at <> _out) _part")
    whole = parts.join(level.selectExpr("positions _part"), "_part", "left_semi")
    if size > 3:
        whole = whole.groupBy("positions", "items").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == size - 2)
    return whole.select("positions", "items")


# --- given sets ---------------------------------------------------------------------------


def set_counter(pairs: DataFrame, basket: str = "basket", item: str = "item") -> Callable[[DataFrame], DataFrame]:
    """A function that counts given sets over the baskets, which are packed once.

    It takes ``items`` and gives ``items, support`` of the distinct sets that some basket holds.
    Nulls take no part: neither in baskets nor, as items, in given sets.
    """
    distinct = pairs.select(F.col(basket).alias("basket"), F.col(item).alias("item"))
    distinct = written(distinct.dropna().distinct(), "pairs")
    numbered = _numbered(distinct.select("item").distinct())
    blocks = written(basket_blocks(distinct.join(numbered, "item"), 1), "baskets")

    def count(sets: DataFrame) -> DataFrame:
        asked = sets.select(F.array_sort(F.array_distinct("items")).alias("items")).distinct()
        members = asked.select("items", F.explode("items").alias("item")).join(numbered, "item")
        known = members.groupBy("items").agg(F.array_sort(F.collect_list("at")).alias("positions"))
        return counted(blocks, known.where(F.size("positions") == F.size("items"))).select("items", F.col("n").alias("support"))

    return count


def count_sets(
    sets: DataFrame, pairs: DataFrame, basket: str = "basket", item: str = "item"
) -> DataFrame:
    """``items, support``: how many baskets hold all items of each given set.

    Sets that no basket holds are left out. Every task makes trees of the sets, file by file, and
    looks up its own baskets in them, so sets and baskets are never multiplied into rows.
    """
    return set_counter(pairs, basket, item)(sets)


# --- rules --------------------------------------------------------------------------------


MOST_ITEMS = 20


def proper_subsets(items: Column) -> Column:
    """All subsets but the empty and the full one; none for fewer than two items.

    A set of n items has 2**n - 2 of them, so sets of more than ``MOST_ITEMS`` raise an error.
    """
    size = F.size(items)
    too_many = F.raise_error(F.format_string(f"%s items are over {MOST_ITEMS}", size.cast("string")))
    size = F.when(size > MOST_ITEMS, too_many.cast("int")).otherwise(size)
    masks = F.sequence(F.lit(1).cast("long"), F.call_function("shiftleft", F.lit(1).cast("long"), size) - 2)
    subsets = F.transform(
        masks, lambda mask: F.filter(items, lambda _, at: F.getbit(mask, at) == 1)
    )
    return F.when(F.size(items) > 1, subsets)


def antecedents(itemsets: DataFrame) -> DataFrame:
    """``items, support, antecedent``: every set with each of its proper subsets."""
    subsets = F.explode(proper_subsets(F.col("items"))).alias("antecedent")
    return itemsets.select("items", "support", subsets)


def association_rules(
    itemsets: DataFrame,
    confidence: float = 0.6,
    supports: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``antecedent, consequent, confidence`` of all rules that reach ``confidence``.

    The support of an antecedent is looked up among the sets, or in ``supports``: a table
    ``items, support``, or a function that makes one from a table of ``items``.

    Antecedents lose one item at a time. A smaller one has no smaller support, so it can only reach
    the confidence if all that have one item more did; those whose support is not known give no
    rule and count as if they did. The work follows the rules that exist, whatever the size of a set.
    """
    sets = written(itemsets.select("items", "support").distinct(), "sets")
    known = sets if supports is None else supports
    level, rules = sets.withColumn("antecedent", F.col("items")), []
    while True:
        level = _smaller(level, whole=not rules)
        if not isinstance(known, DataFrame):
            level = written(level, "antecedents")
            parts = known(level.select(F.col("antecedent").alias("items")).distinct())
        else:
            parts = known
        parts = parts.select(F.col("items").alias("antecedent"), F.col("support").alias("_part"))
        ratio = F.col("support").cast("double") / F.col("_part")
        level = level.join(parts, "antecedent", "left").withColumn("confidence", ratio)
        level = written(level.where(F.col("confidence").isNull() | (F.col("confidence") >= confidence)), "antecedents")
        rules.append(level.where(F.col("confidence").isNotNull()).select(
            "antecedent", F.array_except("items", "antecedent").alias("consequent"), "confidence"))
        if level.isEmpty():
            return reduce(DataFrame.unionByName, rules)


def _smaller(level: DataFrame, whole: bool) -> DataFrame:
    """``items, support, antecedent`` with one item less, where all antecedents with one more are in ``level``."""
    without = F.transform("antecedent", lambda out: F.array_remove("antecedent", out))
    made = level.where(F.size("antecedent") > 1).select("items", "support", F.explode(without).alias("antecedent"))
    if whole:
        return made
    made = made.groupBy("items", "support", "antecedent").agg(F.count(F.lit(1)).alias("_n"))
    return made.where(F.col("_n") == F.size("items") - F.size("antecedent")).drop("_n")
