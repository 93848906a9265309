"""Problem 3: how surprising it is that items occur together.

The counts come from operators/cooccur.py and are exact. The null model is the bipartite configuration model: an item i
is in a basket c with probability x_i*y_c / (1 + x_i*y_c), fitted so that every item keeps its expected frequency and
every basket its expected size. Items of one frequency share x and baskets of one size share y, so the fit runs on the
two degree histograms; with R rows these have at most sqrt(2R) entries each (distinct degrees sum to R or less), which
bounds what reaches the driver. The count of a pair under the null is Poisson-binomial over the baskets; its upper tail
is evaluated once per distinct (frequency, frequency, count) and corrected by Benjamini-Hochberg over all item pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from layoutgraph.plans.session import cut

CERTAIN = 1e9


def fit_null(item_degrees: dict[int, int], basket_sizes: dict[int, int], rounds: int = 20_000, tol: float = 1e-9) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Fitted (degree, x) and (size, y) with the sizes' multiplicities, by the usual fixed point of the model. An item in
    every basket, or a basket of every item, is certain: it has no finite fit and is
    held at CERTAIN. Margins that aren't met to a thousandth raise an error."""
    d, dn = np.array(sorted(item_degrees)), np.array([item_degrees[k] for k in sorted(item_degrees)], float)
    s, sn = np.array(sorted(basket_sizes)), np.array([basket_sizes[k] for k in sorted(basket_sizes)], float)
    total = float((d * dn).sum()) or 1.0
    x, y = d / math.sqrt(total), s / math.sqrt(total)
    for _ in range(rounds):
        nx = np.minimum(d / ((sn * y)[None, :] / (1 + np.outer(x, y))).sum(1), CERTAIN)
        ny = np.minimum(s / ((dn * nx)[:, None] / (1 + np.outer(nx, y))).sum(0), CERTAIN)
        done = max(np.abs(nx / x - 1).max(), np.abs(ny / y - 1).max()) < tol
        x, y = nx, ny
        if done:
            break
    p = np.outer(x, y) / (1 + np.outer(x, y))
    off = max(np.abs((p * sn).sum(1) / d - 1).max(), np.abs((p * dn[:, None]).sum(0) / s - 1).max())
    if not off < 1e-3:
        raise ValueError(f"the null model keeps its margins only to {off:.1g} after {rounds} rounds")
    return d, x, s, np.vstack([y, sn])


def poisson_binomial_tail(q: np.ndarray, m: np.ndarray, k: int) -> tuple[float, float]:
    """(mean, P(X >= k)) where X sums m[j] Bernoulli(q[j]), exact but for rounding; below 1e-300 that is given.

    Above the mean the distribution is tilted by exp(theta*n) so that it centres near k; its probabilities there are
    large and come from the characteristic function by a discrete Fourier transform over a window outside which less
    than 1e-18 lies. Taking the tilt back gives P(n) with full relative precision however small it is."""
    q = np.clip(q, 0.0, 1 - 1e-12)
    mean = float((m * q).sum())
    if k <= 0:
        return mean, 1.0
    m, q = m[q > 0], q[q > 0]
    total = int(m.sum())
    if k > total:
        return mean, 0.0
    if k == total:
        return mean, max(math.exp(float((m * np.log(q)).sum())), 1e-300)
    theta, tilted, low, high = 0.0, q, 0.0, math.inf
    if k > mean:
        theta = math.log(k / mean)
        for _ in range(100):
            tilted = 1 / (1 + np.exp(-theta) * (1 - q) / q)
            off, var = float((m * tilted).sum()) - k, float((m * tilted * (1 - tilted)).sum())
            if abs(off) <= 0.1 * max(math.sqrt(var), 0.1):
                break
            low, high = (theta, high) if off < 0 else (low, theta)
            theta -= off / var if var > 0 else 0.0
            if not low < theta < high:
                theta = (low + high) / 2 if math.isfinite(high) else 2 * low + 1
    centre, var = float((m * tilted).sum()), float((m * tilted * (1 - tilted)).sum())
    d = 15 + math.sqrt(200 + 84 * var)  # Bernstein: 2*exp(-d*d / (2*var + 2*d/3)) < 1e-18
    first, last = max(0, math.floor(centre - d)), min(total, math.ceil(centre + d))
    if k < first:
        return mean, 1.0
    n = last - first + 1
    t = 2 * math.pi * np.arange(n // 2 + 1) / n
    phi = np.zeros(len(t), complex)
    step = max(1, 500_000 // len(q))
    for i in range(0, len(t), step):
        half = np.sin(t[i : i + step, None] / 2) ** 2
        size = 0.5 * np.log1p(np.maximum(-4 * tilted * (1 - tilted) * half, -1 + 1e-300)) @ m
        angle = np.arctan2(tilted * np.sin(t[i : i + step, None]), 1 - 2 * tilted * half) @ m
        phi[i : i + step] = np.exp(size - 1j * angle)
    at = np.arange(k, last + 1)
    p = np.maximum(np.fft.irfft(phi, n)[at % n], 0.0) if n > 1 else np.ones(len(at))
    if not theta:
        return mean, min(1.0, float(p.sum()))
    log_p = float((m * np.log1p(q * math.expm1(theta))).sum()) - theta * k + math.log(float((p * np.exp(-theta * (at - k))).sum()))
    return mean, min(1.0, max(math.exp(min(log_p, 0.0)), 1e-300))


def surprise(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """``pairs`` with expected (count under the null), p_value and q_value (false-discovery rate over all pairs of
    items; p-values are rounded up to a hundredth of a decade before ranking, so q errs upwards)."""
    spark = pairs.sparkSession
    hist = lambda key: {int(r[0]): int(r[1]) for r in members.groupBy(key).agg(F.count(F.lit(1)).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("m")).collect()}
    degrees, sizes = hist("item"), hist("basket")
    items = sum(degrees.values())
    tests = max(1.0, items * (items - 1) / 2)
    d, x, _, ym = fit_null(degrees, sizes) if degrees else (np.zeros(0), np.zeros(0), None, np.zeros((2, 0)))
    at = {int(k): float(v) for k, v in zip(d, x)}
    y, m = ym

    def tails(batches):
        for pdf in batches:
            out = []
            for a, b, k in zip(pdf.n_a, pdf.n_b, pdf.n_ab):
                pa, pb = at[int(a)] * y, at[int(b)] * y
                out.append(poisson_binomial_tail(pa / (1 + pa) * (pb / (1 + pb)), m, int(k)))
            yield pdf.assign(expected=[v[0] for v in out], p_value=[v[1] for v in out])

    classes = pairs.groupBy("n_a", "n_b", "n_ab").agg(F.count(F.lit(1)).alias("pairs"))
    # the cost of a class grows with its frequencies; a number given keeps small ones from being put into one task
    classes = classes.repartition(4 * spark.sparkContext.defaultParallelism, "n_a", "n_b", "n_ab")
    tested = cut(classes.mapInPandas(tails, "n_a long, n_b long, n_ab long, pairs long, expected double, p_value double"), "tails")
    bin_of = F.ceil(F.log10(F.greatest("p_value", F.lit(1e-300))) * 100).cast("int")
    bins = tested.groupBy(bin_of.alias("bin")).agg(F.sum("pairs").alias("pairs")).orderBy("bin").collect()  # at most 30,001 rows
    ranks = np.cumsum([r["pairs"] for r in bins]) if bins else np.zeros(0)
    raw = [min(1.0, 10 ** (r["bin"] / 100) * tests / rank) for r, rank in zip(bins, ranks)]
    q = np.minimum.accumulate(raw[::-1])[::-1] if raw else []
    qs = spark.createDataFrame(pd.DataFrame({"bin": [int(r["bin"]) for r in bins], "q_value": [float(v) for v in q]}), "bin int, q_value double")
    tested = tested.withColumn("bin", bin_of).join(F.broadcast(qs), "bin").drop("bin", "pairs")
    return pairs.join(tested, ["n_a", "n_b", "n_ab"]).select("a", "b", "n_ab", "n_a", "n_b", "expected", "p_value", "q_value")
