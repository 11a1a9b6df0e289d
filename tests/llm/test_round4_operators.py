"""Cases of the fourth round: batches before the first day."""

import datetime as dt

from textmill.llm import enrichment


def test_enrichment_before_the_first_day(spark):
    """Batches are numbered by the formula alone, so days before the first give numbers below 0, each with its own H; an empty batch emits what its H has passed."""
    on = lambda m, d: dt.datetime(2023, m, d)
    sales = [(10, 7, None, on(11, 20)), (11, 7, on(11, 10), on(11, 20)), (12, 8, on(11, 20), on(11, 20))]
    changes = [(1, 7, 0, "I", on(11, 1), 1.25), (2, 7, 0, "U", on(11, 19), 2.0), (3, 7, 0, "D", on(12, 20), 3.0)]  # in batches -4, -3 and -1
    got = enrichment.enriched(spark.createDataFrame(sales, "sale_id long, client_id long, sold_at timestamp_ntz, arrived_at timestamp_ntz"),
                              spark.createDataFrame(changes, "change_id long, client_id long, seq long, op string, valid_at timestamp_ntz, balance double"))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == [("sale", 10, -3, 2, None, None, None), ("sale", 11, -2, 2, 1, 125, "I"), ("sale", 12, 10, 0, None, None, None)]
