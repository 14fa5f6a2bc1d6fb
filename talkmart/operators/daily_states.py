"""Daily states of a group's figures that add up to any window, so that before/after figures need no rows again.

``people`` holds one theta sketch per day and group: distinct people of a window, and of two windows at once. A
sketch is exact up to ``2 ** lg`` people and has a standard error of ``2 ** (-lg / 2)`` beyond. ``scores`` counts
scores per bin of a fixed width: sums, means and counts of a window are exact, a quantile is off by half a bin at
most. Both merge in any order, and a day can be replaced without the others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Logarithm of the people that a sketch tells apart exactly; it takes 8 bytes for each, 128 KB at most.
LG_PEOPLE = 14


def people_states(rows: DataFrame, by: Sequence[str], who: str, day: str = "ingestion_date", lg: int = LG_PEOPLE) -> DataFrame:
    """(day, *by, n_rows, people). Rows without a person count as rows only."""
    return rows.groupBy(day, *by).agg(F.count(F.lit(1)).alias("n_rows"), F.theta_sketch_agg(who, lg).alias("people"))


def score_states(rows: DataFrame, by: Sequence[str], score: str, width: float, day: str = "ingestion_date") -> DataFrame:
    """(day, *by, bin, n, total): scores from ``bin * width`` up to the next bin. NULL and NaN scores are left out.

    At most the range of scores over ``width`` rows per day and group. ``total`` has six decimals, so it does not
    depend on the order of rows.
    """
    value = F.col(score).cast("double")
    known = rows.filter(value.isNotNull() & ~F.isnan(value))
    return known.groupBy(day, *by, F.floor(value / width).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value.cast("decimal(18,6)")).alias("total")
    )


def _in_windows(states: DataFrame, windows: Mapping[str, tuple[str, str]], day: str) -> DataFrame:
    """The states of each window (first and last day, both inside); windows may overlap. The bounds reach the scan."""
    bounds = lambda first, last: F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    parts = [states.filter(bounds(*ends)).withColumn("window", F.lit(name)) for name, ends in windows.items()]
    return reduce(DataFrame.unionByName, parts)


def people_figures(states: DataFrame, by: Sequence[str], windows: Mapping[str, tuple[str, str]], day: str = "ingestion_date", lg: int = LG_PEOPLE) -> DataFrame:
    """(window, *by, n_rows, n_people) of states merged over each window."""
    merged = _in_windows(states, windows, day).groupBy("window", *by)
    merged = merged.agg(F.sum("n_rows").alias("n_rows"), F.theta_union_agg("people", lg).alias("people"))
    return merged.select("window", *by, "n_rows", F.theta_sketch_estimate("people").alias("n_people"))


def people_in_both(states: DataFrame, by: Sequence[str], one: tuple[str, str], other: tuple[str, str], day: str = "ingestion_date", lg: int = LG_PEOPLE) -> DataFrame:
    """(*by, n_both): people who appear in both windows; groups that only one window has are left out."""
    sides = _in_windows(states, {"one": one, "other": other}, day).groupBy(*by)
    pick = lambda name: F.theta_union_agg(F.when(F.col("window") == name, F.col("people")), lg)
    has = lambda name: F.count_if(F.col("window") == name) > 0
    merged = sides.agg(pick("one").alias("one"), pick("other").alias("other"), (has("one") & has("other")).alias("found")).filter("found")
    return merged.select(*by, F.theta_sketch_estimate(F.theta_intersection("one", "other")).alias("n_both"))


def _quantile(per_mille: int, width: float) -> Column:
    """Middle of the lowest bin up to which at least that share of the scores lies."""
    reached = 1000 * F.col("up_to") >= per_mille * F.col("all")
    return (F.min(F.when(reached, F.col("bin"))) + F.lit(0.5)) * F.lit(width)


def score_figures(states: DataFrame, by: Sequence[str], windows: Mapping[str, tuple[str, str]], width: float, per_mille: Sequence[int] = (500,), day: str = "ingestion_date") -> DataFrame:
    """(window, *by, n_scored, mean, q500, ...) of states merged over each window.

    A quantile is the middle of the bin that holds the exact one (the score at position ``ceil(share * n)``). What
    is ordered per group are the bins of a window, not its rows.
    """
    bins = _in_windows(states, windows, day).groupBy("window", *by, "bin").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    group = Window.partitionBy("window", *by)
    ordered = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = bins.withColumn("up_to", F.sum("n").over(ordered)).withColumn("all", F.sum("n").over(group))
    return placed.groupBy("window", *by).agg(
        F.sum("n").alias("n_scored"),
        (F.sum("total").cast("double") / F.sum("n")).alias("mean"),
        *(_quantile(q, width).alias(f"q{q}") for q in per_mille),
    )
