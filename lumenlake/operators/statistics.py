"""Exact order statistics and two-sample tests.

For ranks, rows are reduced once to counts per value, which are written.
Medians are narrowed: only values near the middle are ordered.  The tails of the distributions are integrated
in columns of the few rows that are left.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from lumenlake.operators.ordering import running_total
from lumenlake.plans.workspace import written


def _value_counts(rows: DataFrame, by: list[str], value: str, *more: Column) -> DataFrame:
    """One row per group and value, written: the input is read once, whatever follows."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"), *more)
    return written(counts, "value-counts")


# A sketch places a value within 1 / SKETCH of the rows; the bracket is this many times as wide on each side.
SKETCH, SLACK = 10_000, 5


def summarise(rows: DataFrame, by: list[str], value: str, ranges: list[str] | None = None) -> DataFrame:
    """n, mean, sample deviation, min, max and exact median of the non-null values.

    The measured columns are written, then read twice, however many values
    differ.  The first pass takes the moments and, from mergeable sketches, a
    bracket around the middle of each group; the second exchanges the values
    inside the brackets, a thousandth of all, and counts what lies below.
    ``ranges`` are further columns whose extremes are wanted.
    """
    ends = [(f"{name}_{c}", f, c) for c in ranges or [] for name, f in (("min", F.min), ("max", F.max))]
    kept = [*by, value, *(c for c in ranges or [] if c not in (*by, value))]
    measured = written(rows.where(F.col(value).isNotNull()).select(*kept), "value-rows")
    number, side = F.col(value).cast("double"), SLACK / SKETCH
    totals = measured.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg(number).alias("mean"),
        F.stddev_samp(number).alias("stdev"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        *(f(c).alias(alias) for alias, f, c in ends),
        F.percentile_approx(value, [0.5 - side, 0.5 + side], SKETCH).alias("_bracket"),
    )
    totals = written(totals, "value-totals")
    brackets = totals.select(*by, "n", F.col("_bracket")[0].alias("_low"), F.col("_bracket")[1].alias("_high"))
    medians = written(medians_within(measured, by, value, brackets), "value-medians")
    missed = brackets.join(medians, by, "left_anti")
    if not missed.isEmpty():  # a sketch beyond its promise: these groups are ordered whole
        whole = totals.join(missed.select(*by), by, "left_semi").select(*by, "n", F.col("min").alias("_low"), F.col("max").alias("_high"))
        medians = medians.unionByName(written(medians_within(measured, by, value, whole), "value-medians"))
    extremes = [alias for alias, _, _ in ends]
    return totals.join(medians, by).select(*by, "n", "mean", "stdev", "min", "max", *extremes, "median")


def medians_within(rows: DataFrame, by: list[str], value: str, brackets: DataFrame) -> DataFrame:
    """(*by, median): the mean of the middle values of each group whose bracket holds them both.

    ``brackets`` are (*by, n, _low, _high), few rows.  What lies below a
    bracket is one null row per group, which stands first in the order.
    """
    near = rows.select(*by, value).join(brackets, by).where(F.col(value) <= F.col("_high"))
    inside = F.when(F.col(value) >= F.col("_low"), F.col(value))
    counts = near.groupBy(*by, inside.alias("_v")).agg(F.count("*").alias("_n"))
    ranked = running_total(counts, "_v", "_n", "_upto", by).join(brackets.select(*by, "n"), by)
    below = F.col("_upto") - F.col("_n")
    middle = lambda place: F.min(F.when((below < place) & (place <= F.col("_upto")), F.col("_v")))
    low, high = F.expr("(n + 1) div 2"), F.expr("n div 2 + 1")
    found = ranked.groupBy(*by).agg(((middle(low) + middle(high)) / 2).alias("median"))
    return found.where("median is not null")


def mann_whitney(rows: DataFrame, value: str, first: Column, by: list[str]) -> DataFrame:
    """U of the sample marked by ``first`` against the rest, with its normal z, and whether values are tied.

    z has the tie correction and the continuity correction of one half.
    """
    counts = _value_counts(rows, by, value, F.count_if(first).alias("_in"))
    ranked = running_total(counts, value, "_n", "_upto", by)
    ranked = ranked.withColumn("_rank", F.col("_upto") - (F.col("_n") - 1) / 2)
    ties = F.col("_n").cast("double")
    sums = ranked.groupBy(*by).agg(
        F.sum("_in").alias("n_first"),
        (F.sum("_n") - F.sum("_in")).alias("n_second"),
        F.sum(F.col("_rank") * F.col("_in")).alias("_ranks"),
        F.sum(ties * ties * ties - ties).alias("_ties"),
    )
    n1, n2 = F.col("n_first").cast("double"), F.col("n_second").cast("double")
    n = n1 + n2
    u = F.col("_ranks") - n1 * (n1 + 1) / 2
    spread = F.sqrt(n1 * n2 / 12 * ((n + 1) - F.col("_ties") / F.nullif(n * (n - 1), F.lit(0.0))))
    largest = F.greatest(u, n1 * n2 - u)
    z = (largest - n1 * n2 / 2 - 0.5) / F.nullif(spread, F.lit(0.0))
    return sums.select(*by, "n_first", "n_second", u.alias("u"), z.alias("z"), (F.col("_ties") > 0).alias("tied"))


def welch(rows: DataFrame, value: str, first: Column, by: list[str]) -> DataFrame:
    """Welch's t of the marked sample against the rest, with its degrees of freedom."""
    one, two = F.when(first, F.col(value)), F.when(~first, F.col(value))
    moments = rows.groupBy(*by).agg(
        *(f(x).alias(f"_{n}{i}") for i, x in ((1, one), (2, two))
          for n, f in (("n", F.count), ("mean", F.avg), ("var", F.var_samp)))
    )
    v1 = F.col("_var1") / F.nullif("_n1", F.lit(0))
    v2 = F.col("_var2") / F.nullif("_n2", F.lit(0))
    t = (F.col("_mean1") - F.col("_mean2")) / F.nullif(F.sqrt(v1 + v2), F.lit(0.0))
    terms = v1 * v1 / F.nullif(F.col("_n1") - 1, F.lit(0)) + v2 * v2 / F.nullif(F.col("_n2") - 1, F.lit(0))
    df = (v1 + v2) * (v1 + v2) / F.nullif(terms, F.lit(0.0))
    return moments.select(*by, t.alias("t"), df.alias("df"))


def spearman(rows: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """Rank correlation: average ranks of both columns, then their Pearson correlation."""
    pairs = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*by, x, y).agg(F.count("*").alias("_w"))
    pairs = written(pairs, "value-pairs")
    weighted = lambda column: pairs.groupBy(*by, column).agg(F.sum("_w").alias("_n"))

    def ranks(column: str, name: str) -> DataFrame:
        counted = running_total(weighted(column), column, "_n", "_upto", by)
        return counted.select(*by, column, (F.col("_upto") - (F.col("_n") - 1) / 2).alias(name))

    both = pairs.join(ranks(x, "_rx"), by + [x]).join(ranks(y, "_ry"), by + [y])
    # Mean ranks are (n + 1) / 2, so deviations are exact halves.
    sizes = pairs.groupBy(*by).agg(F.sum("_w").alias("n"))
    dx = F.col("_rx") - (F.col("n") + 1) / 2
    dy = F.col("_ry") - (F.col("n") + 1) / 2
    w = F.col("_w")
    sums = both.join(sizes, by).groupBy(*by, "n").agg(
        F.sum(w * dx * dy).alias("_xy"), F.sum(w * dx * dx).alias("_xx"), F.sum(w * dy * dy).alias("_yy")
    )
    rho = F.col("_xy") / F.nullif(F.sqrt(F.col("_xx") * F.col("_yy")), F.lit(0.0))
    return sums.select(*by, "n", rho.alias("rho"))


# --- tails, as columns of the aggregated rows ---------------------------------

_STEP, _REACH = 0.05, 80


def normal_two_sided(z: Column) -> Column:
    """Both tails beyond a z that is taken from the larger U; 1 where it is not positive."""
    return F.when(z <= 0, F.lit(1.0)).otherwise(_two_sided(z, lambda x: F.exp(-x * x / 2)))


# The exact tail is taken where one sample is this small and the table of arrangements at most that long.
EXACT_SAMPLE, EXACT_TABLE = 8, 2000


def _arrangements(n1: Column, n2: Column) -> Column:
    """Number of arrangements of two samples by U from 0 to n1 n2, as an array.

    The i-th step gives the i-th member of the first sample its place among
    the second: the counts are multiplied by 1 - q^(n2 + i) and divided by
    1 - q^i, where q^k shifts the array by k.
    """
    places = F.sequence(F.lit(0), n1 * n2)
    at = lambda counts, k: F.when(k < 0, F.lit(0.0)).otherwise(F.get(counts, k))

    def step(counts: Column, i: Column) -> Column:
        shifted = F.transform(places, lambda k: F.get(counts, k) - at(counts, k - n2 - i))
        return F.transform(F.array(shifted), lambda c: F.transform(
            places, lambda k: F.aggregate(F.sequence(k % i, k, i), F.lit(0.0), lambda total, j: total + F.get(c, j))
        ))[0]

    one = F.transform(places, lambda k: F.when(k == 0, 1.0).otherwise(0.0))
    return F.aggregate(F.sequence(F.lit(1), n1), one, step)


def exact_two_sided(u: Column, n1: Column, n2: Column) -> Column:
    """Share of all arrangements at least as far from the middle as U; null for samples beyond the exact bounds.

    U is symmetric, so the smaller sample counts as the first.
    """
    few, many = F.least(n1, n2).cast("int"), F.greatest(n1, n2).cast("int")
    usable = (few >= 1) & (few <= EXACT_SAMPLE) & (few * many <= EXACT_TABLE)
    low = F.least(u, n1 * n2 - u).cast("int")
    tails = F.transform(
        F.array(_arrangements(few, many)),
        lambda c: 2 * F.aggregate(F.slice(c, 1, low + 1), F.lit(0.0), lambda a, x: a + x) / F.aggregate(c, F.lit(0.0), lambda a, x: a + x),
    )
    return F.when(usable, F.least(tails[0], F.lit(1.0)))


def mann_whitney_two_sided(u: Column, z: Column, n1: Column, n2: Column, tied: Column) -> Column:
    """The exact tail for small samples without ties, the normal one otherwise."""
    return F.coalesce(F.when(~tied, exact_two_sided(u, n1, n2)), normal_two_sided(z))


def student_two_sided(t: Column, df: Column) -> Column:
    """Both tails of Student's distribution beyond t; null without degrees of freedom."""
    freedom = F.when(df > 0, df.cast("double"))
    return _two_sided(t, lambda x: F.exp(-(freedom + 1) / 2 * F.log1p(x * x / freedom)))


def spearman_two_sided(rho: Column, n: Column) -> Column:
    """By Student's distribution of rho; exact correlation has no tail, two pairs have no test."""
    t = rho * F.sqrt((n - 2) / F.nullif(1 - rho * rho, F.lit(0.0)))
    return F.when(F.abs(rho) >= 1, F.when(n > 2, F.lit(0.0))).otherwise(student_two_sided(t, n - 2))


def _two_sided(at: Column, density: Callable[[Column], Column]) -> Column:
    """Area of a symmetric density beyond ``at``, as a share of the area beyond zero.

    Exp-sinh quadrature: the distance from the lower end runs through
    exp(pi/2 sinh u) at equal steps of u, which suits tails of any weight.
    """
    u = lambda i: i * F.lit(_STEP)
    nodes = F.transform(
        F.sequence(F.lit(-_REACH), F.lit(_REACH)),
        lambda i: F.struct(F.exp(F.sinh(u(i)) * (math.pi / 2)).alias("x"), F.cosh(u(i)).alias("w")),
    )
    area = lambda low: F.aggregate(
        nodes, F.lit(0.0), lambda total, k: total + k["x"] * k["w"] * density(low + k["x"])
    )
    return area(F.abs(at)) / area(F.lit(0.0))
