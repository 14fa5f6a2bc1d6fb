"""How sure is a before/after difference: a Poisson bootstrap over posts.

Sentences of one post are not independent, so whole posts are drawn again. Each post gets a Poisson(1) weight per
replicate from a digest of its key, so the same posts give the same interval, however they are partitioned.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Weights come from 28 bits of a digest; a digest gives this many.
BITS, PER_DIGEST = 28, 4


def poisson_steps(bits: int = BITS) -> list[int]:
    """A number below ``2 ** bits`` has as weight how many of these it reaches: Poisson(1) to that precision."""
    steps, total, k = [], 0.0, 0
    while True:
        total += math.exp(-1) / math.factorial(k)
        step = round(total * 2**bits)
        if step >= 2**bits:
            return steps
        steps.append(step)
        k += 1


def _weight(digits: Column) -> Column:
    number = F.conv(digits, 16, 10).cast("long")
    return sum(((number >= step).cast("int") for step in poisson_steps()), F.lit(0))


def shift_intervals(
    rows: DataFrame, by: Sequence[str], unit: str, before: Column, score: str, replicates: int = 200, tail_per_mille: int = 25, seed: int = 0
) -> DataFrame:
    """(*by, n_before, n_after, shift, low, high, n_replicates) per group.

    ``shift`` is the mean score after less the mean before, ``low`` to ``high`` its interval with ``tail_per_mille``
    of the replicates on either side. A replicate without scores on one side has no shift and is not counted. Rows with
    a NULL score or side are left out; rows with a NULL ``unit`` are one post. The weight of a post is the same in all groups.

    Posts are summed first; the replicates of a post are added up within its task, so what is shuffled is at
    most ``replicates`` rows per group and task.
    """
    value = F.col(score).cast("double")
    known = rows.withColumn("_before", before).filter(value.isNotNull() & ~F.isnan(value) & F.col("_before").isNotNull())
    side = lambda first, x: F.sum(F.when(F.col("_before") == first, x))
    one, exact = F.lit(1), value.cast("decimal(18,6)")
    sides = {"n_before": side(True, one), "n_after": side(False, one), "t_before": side(True, exact), "t_after": side(False, exact)}
    posts = known.groupBy(*by, F.col(unit).cast("string").alias("_unit")).agg(*(F.coalesce(x, F.lit(0)).alias(n) for n, x in sides.items()))

    blocks = -(-replicates // PER_DIGEST)
    drawn = posts.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("_block").cast("string"), F.coalesce("_unit", F.lit("-"))))
    digits = F.array(*(F.substring(digest, 1 + 8 * i, BITS // 4) for i in range(PER_DIGEST)))
    drawn = drawn.select("*", F.posexplode(digits).alias("_place", "_digits"))
    drawn = drawn.withColumn("_replicate", F.col("_block") * PER_DIGEST + F.col("_place")).filter(F.col("_replicate") < replicates)
    drawn = drawn.withColumn("_weight", _weight(F.col("_digits"))).filter("_weight > 0")
    weighed = [F.sum(F.col(n) * F.col("_weight")).alias(n) for n in sides]
    means = F.when((F.col("n_before") > 0) & (F.col("n_after") > 0), _shift())
    shifts = drawn.groupBy(*by, "_replicate").agg(*weighed).select(*by, means.alias("shift"))
    # At most one number per replicate and group.
    ordered = shifts.groupBy(*by).agg(F.sort_array(F.collect_list("shift")).alias("_shifts"))
    size = F.size("_shifts")
    rank = F.greatest(F.lit(1), F.ceil(size * tail_per_mille / 1000).cast("int"))
    ends = ordered.select(
        *(F.col(c).alias(f"_{c}") for c in by),
        F.when(size > 0, F.try_element_at("_shifts", rank)).alias("low"),
        F.when(size > 0, F.try_element_at("_shifts", size + 1 - rank)).alias("high"),
        size.alias("n_replicates"),
    )
    whole = posts.groupBy(*by).agg(*(F.sum(n).alias(n) for n in sides))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    shift = F.when((F.col("n_before") > 0) & (F.col("n_after") > 0), _shift()).alias("shift")
    joined = whole.select(*by, "n_before", "n_after", shift).join(ends, same, "left")
    return joined.select(*by, "n_before", "n_after", "shift", "low", "high", F.coalesce("n_replicates", F.lit(0)).alias("n_replicates"))


def _shift() -> Column:
    mean = lambda side: F.col(f"t_{side}").cast("double") / F.col(f"n_{side}")
    return mean("after") - mean("before")
