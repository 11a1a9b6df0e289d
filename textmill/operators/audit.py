"""Audits: presence, completeness, lengths, leaks, residual hyphens, before and after."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from textmill.functions.text import has_hyphen, has_leak, hyphen_words, is_nonblank, sentence_count, token_count, word_count
from textmill.sources.stages import StageTable


def presence(rows: DataFrame, optional: list[str], mandatory: list[str], by: list[str] = ()) -> DataFrame:
    """Percentages by group: optional fields that aren't null, mandatory ones that aren't blank either."""
    rate = lambda c: F.avg(c.cast("double")) * 100
    return rows.groupBy(*by).agg(*[rate(F.col(c).isNotNull()).alias(f"{c}_present") for c in optional], *[rate(is_nonblank(F.col(c))).alias(f"{c}_nonblank") for c in mandatory])


def complete(mandatory: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [is_nonblank(F.col(c)) for c in mandatory])


def incomplete(rows: DataFrame, mandatory: list[str], keep: list[str]) -> DataFrame:
    """The rows with a blank mandatory field, and which they are."""
    blank = F.filter(F.array(*[F.when(~is_nonblank(F.col(c)), F.lit(c)) for c in mandatory]), lambda x: x.isNotNull())
    return rows.filter(~complete(mandatory)).select(*keep, F.array_join(blank, ",").alias("missing"))


def totals(rows: DataFrame, fields: list[str], by: list[str] = ()) -> DataFrame:
    """Sentences and words over all fields."""
    add = lambda f: reduce(lambda a, b: a + b, [f(F.col(c)) for c in fields])
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.sum(add(sentence_count)).alias("sentences"), F.sum(add(word_count)).alias("words"))


def lengths(rows: DataFrame, fields: list[str], by: list[str] = ()) -> DataFrame:
    """Mean and sample deviation of white-space tokens over each field's rows that aren't blank."""
    long = rows.select(*by, F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in fields])).alias("x")).select(*by, "x.field", "x.value")
    n = token_count(F.col("value")).cast("double")
    return long.filter(is_nonblank(F.col("value"))).groupBy(*by, "field").agg(F.count("*").alias("n"), F.avg(n).alias("mean"), F.stddev_samp(n).alias("std"))


def frequencies(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def before_after(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """Counts of each value in both tables, 0 where it is missing; one aggregation over both."""
    both = before.select(column, F.lit(1).alias("_b"), F.lit(0).alias("_a")).unionByName(after.select(column, F.lit(0).alias("_b"), F.lit(1).alias("_a")))
    return both.groupBy(column).agg(F.sum("_b").alias("n_before"), F.sum("_a").alias("n_after"))


def first_violation(tests: dict[str, Column]) -> Column:
    """The name of the first test, in order, that holds; null for none."""
    return F.coalesce(*[F.when(c, F.lit(name)) for name, c in tests.items()])


def leaks(rows: DataFrame, fields: list[str], keep: list[str]) -> DataFrame:
    hit = first_violation({c: has_leak(F.col(c)) for c in fields})
    return rows.select(*keep, hit.alias("field")).filter(F.col("field").isNotNull())


def hyphens(rows: DataFrame, fields: list[str], keep: list[str]) -> DataFrame:
    hit = first_violation({c: has_hyphen(F.col(c)) for c in fields})
    words = F.coalesce(*[hyphen_words(F.col(c)) for c in fields])
    return rows.select(*keep, hit.alias("field"), words.alias("words")).filter(F.col("field").isNotNull())


def duplicate_ids(rows: DataFrame, key: str = "id") -> DataFrame:
    return rows.select(F.col(key).alias("id")).groupBy("id").agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def check_unique(rows: DataFrame, key: str = "id") -> None:
    found = duplicate_ids(rows, key).limit(20).collect()
    if found:
        raise ValueError(f"ids that aren't unique: {[r['id'] for r in found]}")


def report(counters: dict[str, dict[str, float]], spark) -> DataFrame:
    """Counters as section, key, value in the order given."""
    rows = [(i, s, k, float(v)) for i, (s, k, v) in enumerate((s, k, v) for s, d in counters.items() for k, v in d.items())]
    return spark.createDataFrame(rows, "ord int, section string, key string, value double")


class Run:
    """Counters of a run's stages, gathered in the stages' own pass: each stage's rows are observed as they are written, so a report scans nothing."""

    def __init__(self) -> None:
        self._stages: list[tuple[str, Observation, list[str]]] = []

    def stage(self, section: str, df: DataFrame, to: StageTable, **counters: Column) -> DataFrame:
        """df written as a new version of a stage table and read again, with `rows` and counters (aggregates over df's rows) noted under the section."""
        seen = Observation()
        of = {"rows": F.count(F.lit(1)), **counters}
        version = to.write(df.observe(seen, *[F.coalesce(c.cast("double"), F.lit(0.0)).alias(k) for k, c in of.items()]))
        self._stages.append((section, seen, list(of)))
        return to.read(version)

    def counters(self) -> dict[str, dict[str, float]]:
        """What each stage has noted, in the order of the stages; `removed` is what a stage has less than the one before."""
        out: dict[str, dict[str, float]] = {}
        before = None
        for section, seen, keys in self._stages:
            got = seen.get
            out[section] = {k: got[k] for k in keys}
            if before is not None:
                out[section]["removed"] = before - got["rows"]
            before = got["rows"]
        return out

    def report(self, spark: SparkSession) -> DataFrame:
        return report(self.counters(), spark)


def phase_report(before: DataFrame, after: DataFrame, mandatory: list[str], optional: list[str], fields: list[str]) -> DataFrame:
    """Completeness and totals of two snapshots as phase, key, value: one plan over both."""
    both = before.withColumn("phase", F.lit("before")).unionByName(after.withColumn("phase", F.lit("after")))
    add = lambda f: reduce(lambda a, b: a + b, [f(F.col(c)) for c in fields])
    rate = lambda c: F.avg(c.cast("double")) * 100
    values = {
        "rows": F.count("*").cast("double"),
        "incomplete": F.count_if(~complete(mandatory)).cast("double"),
        "sentences": F.sum(add(sentence_count)).cast("double"),
        "words": F.sum(add(word_count)).cast("double"),
        **{f"present {c}": rate(F.col(c).isNotNull()) for c in optional},
        **{f"nonblank {c}": rate(is_nonblank(F.col(c))) for c in mandatory},
    }
    wide = both.groupBy("phase").agg(*[v.alias(f"v{i}") for i, v in enumerate(values.values())])
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), F.col(f"v{i}").alias("value")) for i, k in enumerate(values)])
    return wide.select("phase", F.explode(pairs).alias("x")).select("phase", "x.key", "x.value")
