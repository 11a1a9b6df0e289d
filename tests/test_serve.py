"""A model's stage with planted failures, and how often it loads."""

import os

from pyspark.sql import functions as F

from textmill.operators import serve


def maker(folder=None):
    def load():
        if folder:
            import uuid

            open(os.path.join(folder, f"{os.getpid()}-{uuid.uuid4().hex}"), "w").close()

        def run(texts, cap):
            if any("bad" in t for t in texts):
                raise ValueError("cannot say bad")
            if any("short" in t for t in texts) and len(texts) > 1:
                return texts[1:]
            return [f"{t[::-1]}|{cap}" for t in texts]

        return run

    return load


def test_failures_go_to_a_table_of_their_own(spark):
    rows = [(k, "bad " * (k % 5 + 1) if k % 11 == 0 else None if k % 13 == 0 else "short" if k % 17 == 0 else f"text {k} " * (k % 60), k) for k in range(600)]
    df = spark.createDataFrame(rows, "id long, text string, _model int").repartition(5)
    got = serve.served(df, maker(), tokens=200, most=8)
    want = {k: None if t is None else f"{t[::-1]}|{min(512, max(32, 3 * len(t.split())))}" for k, t, _ in rows if k % 11}
    assert {r.id: r.text for r in got.done.collect()} == want and got.done.columns == df.columns
    assert {(r.id, r.error) for r in got.failed.collect()} == {(k, "ValueError: cannot say bad") for k in range(0, 600, 11)}


def test_loads_once_in_a_worker(spark, tmp_path):
    """Many tasks and two stages load a model once for each worker process."""
    df = spark.range(400).select("id", F.col("id").cast("string").alias("text")).repartition(40)
    first = serve.served(df, maker(str(tmp_path)), out="said", name="m1")
    second = serve.served(first.done.repartition(40), maker(str(tmp_path)), text="said", out="again", name="m1")
    assert second.done.count() == 400
    pids = [f.split("-")[0] for f in os.listdir(tmp_path)]
    assert len(pids) == len(set(pids)) <= spark.sparkContext.defaultParallelism * 2
    assert sum(r.rows for r in second.load.collect()) == 400


def test_batches():
    lengths = sorted([1, 2, 3, 50, 51, 52, 500, 9000])
    cut = list(serve.batches(lengths, 200, 3))
    assert [x for a, z in cut for x in lengths[a:z]] == lengths and all(z - a == 1 or (z - a <= 3 and (z - a) * lengths[z - 1] <= 200) for a, z in cut)
    assert list(serve.batches([])) == []


def test_no_texts(spark):
    got = serve.served(spark.createDataFrame([], "id long, text string"), maker())
    assert got.done.collect() == [] and got.failed.collect() == []
