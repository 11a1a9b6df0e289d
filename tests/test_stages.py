"""Versions of stage tables, gates inside a write, and counters observed as stages are written."""

import pytest
from pyspark.sql import functions as F

from textmill.operators import audit, parallel
from textmill.sources.stages import StageTable


def ids(df):
    return sorted(r.id for r in df.collect())


def test_a_write_that_dies_leaves_the_old_version(spark, tmp_path):
    t = StageTable(spark, f"file://{tmp_path}/t")
    assert t.latest() is None
    with pytest.raises(FileNotFoundError):
        t.read()
    assert t.write(spark.range(5)) == 1
    half = spark.range(100, numPartitions=10).withColumn("id", F.when(F.col("id") == 95, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="killed"):
        t.write(half)
    assert t.versions() == [1] and ids(t.read()) == list(range(5))
    assert t.write(spark.range(3)) == 2 and ids(t.read()) == [0, 1, 2] and ids(t.read(1)) == list(range(5))
    assert t.restore(1) == 3 and ids(t.read()) == list(range(5))
    with pytest.raises(FileNotFoundError):
        t.read(9)
    assert len(t.clean(keep=1)) == 2 and t.versions() == [3] and ids(t.read()) == list(range(5))


def test_empty_versions_keep_their_schema(spark, tmp_path):
    t = StageTable(spark, f"file://{tmp_path}/t")
    t.write(spark.range(5).filter("id > 9").withColumn("x", F.lit("a")))
    assert t.read().columns == ["id", "x"] and t.read().count() == 0


def sides(spark, bad):
    long = "x" * 60
    s = spark.createDataFrame([(f"i{k}", long) for k in range(30)], "id string, a string")
    t = spark.createDataFrame([(f"i{k}", long if k >= bad else long[:6]) for k in range(30)], "id string, a string")
    return s, t


def test_a_gate_inside_the_write(spark, tmp_path):
    to, side = (StageTable(spark, f"file://{tmp_path}/{x}") for x in ("to", "side"))
    runs = spark.sparkContext.accumulator(0)

    def checked(bad):
        s, t = sides(spark, bad)

        def count(batches):
            for b in batches:
                runs.add(b.num_rows)
                yield b

        g = parallel.gate(s, t, ["a"])
        return g.mapInArrow(count, g.schema), parallel.id_parity(s, t)

    assert parallel.gated(*checked(0), to, side) == 1 and runs.value == 30
    with pytest.raises(ValueError) as e:
        parallel.gated(*checked(25), to, side)
    assert runs.value == 60 and to.versions() == [1] and side.read().count() == 25
    assert str(e.value).startswith("missing in target 0, in source 0; i0 a truncated 10%; ") and str(e.value).endswith("and 5 more")
    rows, parity = checked(25)
    with pytest.raises(ValueError) as again:
        parallel.check_gate(rows, parity)
    assert str(again.value) == str(e.value) and runs.value == 90
    assert parallel.check_gate(*checked(0)).count() == 30


def test_counters_are_observed(spark, tmp_path):
    run = audit.Run()
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    a = run.stage("read", spark.range(100).mapInArrow(count, "id long"), StageTable(spark, f"file://{tmp_path}/a"), odd=F.count_if(F.col("id") % 2 == 1))
    run.stage("filter", a.filter("id < 40"), StageTable(spark, f"file://{tmp_path}/b"), total=F.sum("id"))
    run.stage("none", a.filter("id < 0"), StageTable(spark, f"file://{tmp_path}/c"), total=F.sum("id"))
    assert run.counters() == {"read": {"rows": 100, "odd": 50}, "filter": {"rows": 40, "total": 780, "removed": 60}, "none": {"rows": 0, "total": 0, "removed": 40}}
    assert [(r.section, r.key, r.value) for r in run.report(spark).orderBy("ord").collect()][:3] == [("read", "rows", 100.0), ("read", "odd", 50.0), ("filter", "rows", 40.0)]
    assert seen.value == 100
