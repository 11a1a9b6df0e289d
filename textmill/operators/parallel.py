"""Parallel corpora: id parity, length-ratio gate, quality summaries, worst pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions.text import is_nonblank, length_ratio, strip
from textmill.operators.blocks import same
from textmill.operators.ranks import medians
from textmill.session import written
from textmill.sources.stages import StageTable

FLOOR, SHORTEST, WORST, EXCERPT, FAILURES = 0.30, 40, 20, 200, 20


def id_parity(source: DataFrame, target: DataFrame, key: str = "id") -> DataFrame:
    """One row: ids that only one side has, and that both have."""
    s, t = source.select(F.col(key).alias("s")).distinct(), target.select(F.col(key).alias("t")).distinct()
    both = s.join(t, F.col("s") == F.col("t"), "full_outer")
    return both.agg(F.count_if(F.col("t").isNull()).alias("missing_in_target"), F.count_if(F.col("s").isNull()).alias("missing_in_source"), F.count_if(F.col("s").isNotNull() & F.col("t").isNotNull()).alias("in_both"))


def pairs(source: DataFrame, target: DataFrame, fields: list[str], key: str = "id") -> DataFrame:
    """key, field, src, mt for ids of both sides; fields are taken once each."""
    fields = list(dict.fromkeys(fields))
    side = lambda df, name: df.select(key, F.struct(*[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) for f in fields]).alias(name))
    both = side(source, "_s").join(side(target, "_t"), key)  # a record crosses the shuffle once, whatever its fields
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col("_s")[f].alias("src"), F.col("_t")[f].alias("mt")) for f in fields])
    return both.select(key, F.inline(each))


def gate(source: DataFrame, target: DataFrame, fields: list[str], exempt: DataFrame | None = None, key: str = "id", floor: float = FLOOR, shortest: int = SHORTEST) -> DataFrame:
    """key, field, ratio, status of the pairs whose source is long enough: EMPTY, truncated, pending (truncated, but exempt), ok."""
    p = pairs(source, target, fields, key).withColumn("ratio", length_ratio(F.col("src"), F.col("mt"), shortest)).filter(F.col("ratio").isNotNull())
    flagged = F.lit(False)
    if exempt is not None:
        e = exempt.select(F.col(key).alias("_k"), F.col("field").alias("_f")).distinct()
        p = p.join(e, (F.col(key) == F.col("_k")) & (F.col("field") == F.col("_f")), "left")
        flagged = F.col("_k").isNotNull()
    status = F.when(strip(F.col("mt")) == "", "EMPTY").when(F.col("ratio") < floor, F.when(flagged, "pending").otherwise("truncated")).otherwise("ok")
    return p.select(key, "field", "ratio", status.alias("status"))


def gate_totals(checked: DataFrame) -> DataFrame:
    """field, n, n_empty, n_truncated, n_pending, and the median and least ratio of what isn't empty."""
    of = lambda s: F.count_if(F.col("status") == s)
    ratio = F.when(F.col("status") != "EMPTY", F.col("ratio"))
    checked = written(checked.select("field", "status", "ratio"), "checked")
    out = checked.groupBy("field").agg(F.count("*").alias("n"), of("EMPTY").alias("n_empty"), of("truncated").alias("n_truncated"), of("pending").alias("n_pending"), F.min(ratio).alias("min_ratio"))
    m = medians(checked, ratio, ["field"])
    return out.alias("a").join(m.alias("b"), same("a", "b", ["field"]), "left").select("a.field", "n", "n_empty", "n_truncated", "n_pending", F.col("median").alias("median_ratio"), "min_ratio")


def failed(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("status").isin("EMPTY", "truncated"))


def failures(checked: DataFrame, key: str = "id", most: int = FAILURES) -> DataFrame:
    """The first failures; how many there are in all is check_gate's to say."""
    return failed(checked).orderBy(key, "field").limit(most)


def gate_error(checked: DataFrame, parity: DataFrame, key: str = "id") -> str | None:
    """What check_gate() says, or None if all is well. checked should be written: it is read twice."""
    p = parity.first()
    bad = failures(checked, key).collect()
    if not (bad or p["missing_in_target"] or p["missing_in_source"]):
        return None
    more = failed(checked).count() - len(bad) if len(bad) == FAILURES else 0
    said = [f"{r[key]} {r['field']} {r['status']} {r['ratio']:.0%}" for r in bad] + ([f"and {more} more"] if more else [])
    return f"missing in target {p['missing_in_target']}, in source {p['missing_in_source']}; " + "; ".join(said)


def check_gate(checked: DataFrame, parity: DataFrame, key: str = "id") -> DataFrame:
    """An error that names the first failures and counts the others, if there is any; else the checked rows. The gate's plan runs once: what it has found is written, and read for the failures."""
    kept = written(checked, "gate")
    if error := gate_error(kept, parity, key):
        raise ValueError(error)
    return kept


def gated(checked: DataFrame, parity: DataFrame, to: StageTable, side: StageTable, key: str = "id") -> int:
    """checked as a new version of the stage table `to`, if the gate passes. If not, `to` stays as it is, all failures are a new version of `side`, and the error is check_gate's.
    The gate's plan runs once, as it is written; the assertion is made on what was written, before it can be read as a version."""

    def check(rows: DataFrame) -> None:
        if error := gate_error(rows, parity, key):
            side.write(failed(rows))
            raise ValueError(error)

    return to.write(checked, check)


def quality_pairs(source: DataFrame, target: DataFrame, fields: list[str], key: str = "id", shortest: int = 1) -> DataFrame:
    p = pairs(source, target, fields, key)
    return p.filter((F.length(strip(F.col("src"))) >= shortest) & is_nonblank(F.col("mt")))


def quality_summary(scored: DataFrame, score: str = "qe_score") -> DataFrame:
    """field (null: all), n, mean, median, min, max, stdev (0 for one): one aggregation by grouping sets, and medians by selection."""
    c = F.col(score)
    scored = written(scored.select("field", score), "scored")
    by = scored.groupingSets([[F.col("field")], []], F.col("field"))
    out = by.agg(F.grouping("field").alias("_all"), F.count(c).alias("n"), F.avg(c).alias("mean"), F.min(c).alias("min"), F.max(c).alias("max"), F.coalesce(F.stddev_samp(c), F.when(F.count(c) == 1, F.lit(0.0))).alias("stdev"))
    each = scored.select("field", score, F.lit(0).cast("byte").alias("_all")).unionByName(scored.select(F.lit(None).cast(scored.schema["field"].dataType).alias("field"), score, F.lit(1).cast("byte").alias("_all")))
    m = medians(each, c, ["field", "_all"])
    return out.alias("a").join(m.alias("b"), same("a", "b", ["field", "_all"]), "left").select("a.field", "n", "mean", "median", "min", "max", "stdev")


def worst(scored: DataFrame, score: str = "qe_score", order: tuple[str, ...] = ("id", "field"), k: int = WORST) -> DataFrame:
    """The k lowest scores with excerpts."""
    cut = [F.left(F.col(c), F.lit(EXCERPT)).alias(c) for c in ("src", "mt")]
    return scored.orderBy(score, *order).limit(k).select(*order, score, *cut)
