"""Bounded results for the driver. An ordered limit would send every partition's best rows to the driver, as many as the
limit times the partitions; these send no more than the bound."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, functions as F

SPACE = 1 << 40


def sample(df: DataFrame, n: int, *on: str) -> list[Row]:
    """At most ``n`` rows, all if there are no more: those whose hash of the columns ``on`` is below a threshold set by
    the number of rows, the same at every run and partitioning. The threshold aims four standard deviations below ``n``
    and falls while more than ``n`` rows pass it, so no arbitrary row is cut off; rows alike in ``on`` pass together or
    not at all. Where even the least hash has more than ``n`` rows, they are alike, and ``n`` of them are given."""
    total = df.count()
    if total <= n:
        return df.collect()
    if n <= 0:
        return []
    hashed = df.withColumn("_hash", F.pmod(F.xxhash64(*on), F.lit(SPACE)))
    share = max(n - 4 * n**0.5, n / 2) / total
    while share * SPACE >= 1:
        rows = hashed.filter(F.col("_hash") < int(share * SPACE)).drop("_hash").limit(n + 1).collect()
        if 0 < len(rows) <= n:
            return rows
        if not rows:  # few distinct values, none of them low
            break
        share /= 2
    least = hashed.agg(F.min("_hash")).first()[0]
    return hashed.filter(F.col("_hash") == least).drop("_hash").limit(n).collect()


def samples(df: DataFrame, n: int, by: str, *on: str) -> dict[object, list[Row]]:
    """``sample`` of the rows of each value of ``by``, of which there must be few: the same rows, from three passes over ``df``
    for all values together. Only where the first threshold lets no row or too many pass is a value sampled on its own."""
    limits = {r[by]: SPACE if r["_rows"] <= n else int(max(n - 4 * n**0.5, n / 2) / r["_rows"] * SPACE) for r in df.groupBy(by).agg(F.count(F.lit(1)).alias("_rows")).collect()}
    if not limits:
        return {}
    bound = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    low = df.withColumn("_hash", F.pmod(F.xxhash64(*on), F.lit(SPACE))).filter(F.col("_hash") < bound[F.col(by)]).drop("_hash")
    fit = [r[by] for r in low.groupBy(by).agg(F.count(F.lit(1)).alias("_rows")).collect() if r["_rows"] <= n]
    out: dict[object, list[Row]] = {v: [] for v in fit}
    for r in low.filter(F.col(by).isin(fit)).collect() if fit else []:
        out[r[by]].append(r)
    return out | {v: sample(df.filter(F.col(by) == v), n, *on) for v in limits if v not in out}


def most_frequent(df: DataFrame, count: str, n: int) -> list[Row]:
    """The ``n`` rows with the highest ``count``, most frequent first; equal counts in the order of the other columns. The
    counts' histogram tells the boundary level; of that level, ordered by the driver's bound, only what fits is sent."""
    levels = df.groupBy(count).agg(F.count(F.lit(1)).alias("_rows")).collect()
    above, taken, edge, room = None, 0, None, 0
    for level in sorted(levels, key=lambda r: -r[count]):
        if taken + level["_rows"] > n:
            edge, room = level[count], n - taken
            break
        taken += level["_rows"]
        above = level[count]
    rows = df.filter(F.col(count) >= above).collect() if above is not None else []
    if edge is not None and room > 0:
        rows += df.filter(F.col(count) == edge).orderBy(*[c for c in df.columns if c != count]).limit(room).collect()
    return sorted(rows, key=lambda r: (-r[count], tuple(r)))
