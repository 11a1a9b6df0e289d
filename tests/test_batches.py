"""What a Python worker holds at once."""

from textmill.operators import model


def test_scored_by_bounded_batches(spark):
    """However many pairs a task has, a batch has at most 1000, and its bytes are bounded; the model sees `batch` at most."""
    marks = lambda: lambda src, mt: [float(len(src))] * len(src)
    for key in ("maxRecordsPerBatch", "maxBytesPerBatch"):
        spark.conf.unset(f"spark.sql.execution.arrow.{key}")
    pairs = spark.range(2500, numPartitions=1).selectExpr("id", "'f' as field", "repeat('a', 100) as src", "'b' as mt")
    got = sorted((r.id, r.qe_score) for r in model.scored(pairs, marks, batch=16).collect())
    # two batches of 1000 (62 calls of 16, one of 8), one of 500 (31 calls of 16, one of 4)
    assert [x for x, _ in got] == list(range(2500)) and sorted({s for _, s in got}) == [4.0, 8.0, 16.0] and sum(s == 8.0 for _, s in got) == 16
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(8 << 20)
