"""Exact medians of keys of any size, without a buffer that grows with the rows.

A key of up to `most` values is Spark's median. For a larger one the values at its middle ranks are selected: a sketch of the values that are
still possible (fixed size, made in part before the shuffle) names two of them that surely bracket the wanted rank; counts below and at these two are
exact, and say whether one of them is the answer or which values between them still can be. Each round leaves about a 60th of the values, so a trillion
take five, and values that occur many times cost nothing: they are counted, never gathered. Only keys go to a table of their own, one row for each rank.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.operators.blocks import same
from textmill.session import discard, small, written

MOST = 10_000
#: Points of a sketch, and its accuracy (the error of a rank is below a 10000th of the values).
POINTS, ACCURACY = 128, 10_000
ROUNDS = 40


def medians(rows: DataFrame, value: Column, keys: list[str], most: int = MOST) -> DataFrame:
    """keys and median (double) of the values that aren't null, for each key that has one."""
    every = written(rows.select(*keys, value.cast("double").alias("_v")).filter(F.col("_v").isNotNull()), "values")
    sizes = written(every.groupBy(*keys).agg(F.count("*").alias("_n")), "sizes")
    joined = lambda d: every.alias("a").join(small(d).alias("b"), same("a", "b", keys))
    few = joined(sizes.filter(F.col("_n") <= most)).select("a.*").groupBy(*keys).agg(F.median("_v").alias("median"))
    # a large key's two middle ranks, among the values between two that are ruled out
    ranks = F.explode(F.array(F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2))).alias("_r")
    open_ = written(sizes.filter(F.col("_n") > most).select(*keys, ranks, F.lit(None).cast("double").alias("_lo"), F.lit(None).cast("double").alias("_hi")).select("*", F.monotonically_increasing_id().alias("_t")), "ranks")
    found: list[DataFrame] = []
    for _ in range(ROUNDS):
        if not open_.limit(1).count():
            break
        inside = joined(open_).filter((F.col("_lo").isNull() | (F.col("_v") > F.col("_lo"))) & (F.col("_hi").isNull() | (F.col("_v") < F.col("_hi")))).select(*(F.col(f"a.{k}") for k in keys), "_t", "_r", "_v")
        points = [i / POINTS for i in range(POINTS + 1)]
        sketch = inside.groupBy("_t").agg(F.count("*").alias("_n"), F.first("_r").alias("_rank"), F.percentile_approx("_v", points, ACCURACY).alias("_q"))
        at = F.floor(F.col("_rank") * POINTS / F.col("_n")).cast("int")
        sketch = written(sketch.select(F.col("_t").alias("_s"), F.col("_n"), F.get("_q", F.greatest(at - 1, F.lit(0))).alias("_a"), F.get("_q", F.least(at + 2, F.lit(POINTS))).alias("_b")), "sketches")
        both = inside.join(small(sketch), F.col("_t") == F.col("_s"))
        # NaN is above all numbers here as it is in Spark's order
        is_ = lambda x, y: F.count_if(F.col("_v") < F.col(x)) if y == "<" else F.count_if(F.col("_v") == F.col(x))
        short = F.col("_n") <= most
        counts = both.groupBy(*keys, "_t").agg(F.first("_r").alias("_r"), F.first("_a").alias("_a"), F.first("_b").alias("_b"), is_("_a", "<").alias("_la"), is_("_a", "=").alias("_ea"), is_("_b", "<").alias("_lb"), is_("_b", "=").alias("_eb"),
                                               F.sort_array(F.collect_list(F.when(short, F.col("_v")))).alias("_few"))
        r = F.col("_r")
        answer = F.when(F.size("_few") > 0, F.get("_few", r.cast("int"))).when((r >= F.col("_la")) & (r < F.col("_la") + F.col("_ea")), F.col("_a")).when((r >= F.col("_lb")) & (r < F.col("_lb") + F.col("_eb")), F.col("_b"))
        before = open_.select(F.col("_t").alias("_s"), "_lo", "_hi")
        low, high = r < F.col("_la"), r >= F.col("_lb") + F.col("_eb")
        step = counts.join(small(before), F.col("_t") == F.col("_s")).select(
            *keys, "_t", answer.alias("_answer"),
            F.when(low, r).when(high, r - F.col("_lb") - F.col("_eb")).otherwise(r - F.col("_la") - F.col("_ea")).alias("_r"),
            F.when(low, F.col("_lo")).when(high, F.col("_b")).otherwise(F.col("_a")).alias("_lo"), F.when(low, F.col("_a")).when(high, F.col("_hi")).otherwise(F.col("_b")).alias("_hi"))
        step = written(step, "ranks")
        found.append(step.filter(F.col("_answer").isNotNull()).select(*keys, "_answer"))
        open_ = step.filter(F.col("_answer").isNull()).select(*keys, "_r", "_lo", "_hi", "_t")
        discard(sketch)
    else:
        raise RuntimeError("ranks didn't settle")
    if not found:
        return few
    return few.unionByName(reduce(DataFrame.unionByName, found).groupBy(*keys).agg(F.avg("_answer").alias("median")))
