"""Medians by selection against sorting."""

import random
import statistics

import pytest

from textmill.operators import ranks
from pyspark.sql import functions as F


@pytest.mark.parametrize("most", [10, 100_000])
def test_medians(spark, most):
    r = random.Random(3)
    rows = [("even", r.gauss(0, 1)) for _ in range(4000)] + [("odd", r.gauss(0, 1)) for _ in range(4001)] + [("ties", float(r.choice((1, 1, 1, 2, 5)))) for _ in range(3000)] + [("all", 7.0)] * 2000
    rows += [("wide", r.choice((-1, 1)) * 10.0 ** r.randint(-300, 300)) for _ in range(3000)] + [("half", float(k % 2)) for k in range(2000)] + [("one", 3.5), ("two", 1.0), ("two", 2.0), ("none", None), (None, 4.0), (None, 6.0), (None, 5.0)]
    rows += [("inf", x) for x in (float("-inf"), float("inf"), 1.0) for _ in range(50)] + [(f"k{k % 40}", r.random()) for k in range(900)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    by = {}
    for k, v in rows:
        if v is not None:
            by.setdefault(k, []).append(v)
    got = {x.k: x.median for x in ranks.medians(df, F.col("v"), ["k"], most).collect()}
    assert got == {k: statistics.median(v) for k, v in by.items()}


def test_no_values(spark):
    assert ranks.medians(spark.createDataFrame([], "k string, v double"), F.col("v"), ["k"]).collect() == []
