"""Exact counts of items that share a basket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from layoutgraph.plans.session import cut

BASKET_LIMIT = 400  # items; larger baskets are paired block by block
BLOCK = 200  # items of a block of a large basket


def baskets(rows: DataFrame, basket: str | Column, item: str | Column) -> DataFrame:
    """Distinct (basket, item); null or blank on either side is left out."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    return rows.select(col(basket).alias("basket"), col(item).alias("item")).filter(F.col("basket").rlike(r"\S") & F.col("item").rlike(r"\S")).distinct()


def pair_counts(members: DataFrame, n: int, min_count: int = 1, min_lift: float = 0.0, lists: bool = False) -> DataFrame:
    """Pairs a < b of items sharing a basket: (a, b, n_ab, n_a, n_b), for the pairs with n_ab >= ``min_count`` and
    n_ab * n >= ``min_lift`` * n_a * n_b, where n is the number of baskets.

    ``members`` holds distinct (basket, item). As n_ab <= min(n_a, n_b), an item rarer than ``min_count`` or more
    frequent than n / ``min_lift`` is in no such pair and is dropped before pairing; no qualifying pair is lost.
    With ``lists`` a column baskets holds the sorted baskets of each pair.
    Baskets above BASKET_LIMIT items are cut into blocks whose pairs of blocks are spread over tasks.
    """
    freq = members.groupBy("item").agg(F.count(F.lit(1)).alias("n_item"))
    usable = freq.filter((F.col("n_item") >= min_count) & (F.col("n_item") * F.lit(float(min_lift)) <= F.lit(float(n))))
    rows = cut(members.join(usable, "item").select("basket", "item", "n_item"), "baskets")
    sizes = rows.groupBy("basket").agg(F.count(F.lit(1)).alias("size"))
    large = sizes.filter(F.col("size") > BASKET_LIMIT)
    if large.isEmpty():
        small_rows, pairs = rows, None
    else:
        small_rows = rows.join(large, "basket", "left_anti")
        blocks = F.ceil(F.col("size") / BLOCK).cast("int")
        own = F.pmod(F.xxhash64("item"), blocks).cast("int")
        cut_rows = rows.join(large, "basket").withColumn("blocks", blocks).withColumn("own", own)
        left = cut_rows.select("basket", "item", "n_item", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        left = left.select("basket", "item", "n_item", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
        right = left.select("basket", "lo", "hi", F.col("item").alias("b"), F.col("n_item").alias("n_b"))
        met = left.withColumnsRenamed({"item": "a", "n_item": "n_a"}).join(right, ["basket", "lo", "hi"]).filter("a < b")
        # two items of one block meet in every pair of blocks that holds theirs; only (block, block) itself counts
        own_of = lambda c: F.pmod(F.xxhash64(c), F.col("blocks"))
        met = met.join(large.select("basket", blocks.alias("blocks")), "basket")
        pairs = met.filter((own_of("a") != own_of("b")) | (F.col("lo") == F.col("hi"))).select("basket", "a", "b", "n_a", "n_b")
    many = small_rows.groupBy("basket").agg(F.sort_array(F.collect_list(F.struct("item", "n_item"))).alias("xs")).filter(F.size("xs") > 1)
    met = F.expr("explode(flatten(transform(xs, (x, i) -> transform(slice(xs, i + 2, size(xs)), y -> struct(x.item as a, y.item as b, x.n_item as n_a, y.n_item as n_b)))))")
    small = many.select("basket", met.alias("p")).select("basket", "p.*")
    pairs = small if pairs is None else small.unionByName(pairs)
    found = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_ab"), F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"), *([F.array_sort(F.collect_list("basket")).alias("baskets")] if lists else []))
    return found.filter((F.col("n_ab") >= min_count) & (F.col("n_ab") * F.lit(float(n)) >= F.lit(float(min_lift)) * F.col("n_a") * F.col("n_b")))


def mention_baskets(mentions: DataFrame) -> DataFrame:
    """(basket = chunk id, item = normalized) of Entity rows; a joined chunk_id counts for each of its ids."""
    rows = mentions.select(F.explode(F.split("chunk_id", ",")).alias("chunk"), "normalized")
    return baskets(rows, F.trim("chunk"), "normalized")
