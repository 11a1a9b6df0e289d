"""Quality rules: counts over each text, then robust multivariate outliers, in DataFrame functions only.

The counts of a text give a vector of transformed statistics (FEATURES). For each cell (language and source; where
those have too few documents, the language; then all) the minimum-covariance-determinant estimate of centre and
scatter is searched from STARTS, which are the same in every run: median deviations alone, and with the correlations of
hyperbolic tangents and of spatial signs. A concentration step takes the three quarters of the documents that lie nearest, whose mean and
scatter are the next estimate. Each start makes FIRST steps; the one with the least determinant in its cell goes on until no cell's determinant falls
any more. A last step takes all within the 97.5 % bound. A document whose Mahalanobis distance from its cell is over the cutoff is rejected.

Statistics are whole numbers (ten thousandths) and their sums decimals, so the estimates don't depend on the order of
rows. Distances are ranked in bins of a thirty-second of a natural logarithm, so a cell's quantile is a sum of counts:
no cell is ever gathered in one task. A floor is added to each variance: statistics that are zero for nearly all
documents of a cell would else reject any document that isn't zero.

Defined cases: a null or empty text has no words, fails the base rule and takes no part in the estimates; null language
or source is a value like any other; a cell with fewer than LEAST documents even when pooled rejects nothing; documents
with the same id each get a row, an empty table gives none; assess() reads no other columns, whatever their names, and keep() keeps them all.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import small, written

#: Documents that a cell must have at least for estimates of its own.
LEAST = 100
SHARE = 0.75
#: Starts of the search, their steps before they are compared, and the most steps after that; a determinant that falls by less than FALL (of its logarithm) has settled.
STARTS = ("deviations", "tangents", "signs")
FIRST, STEPS, FALL = 2, 20, 1e-3
#: Chance that a clean normal document is rejected: small beside the documents of a large corpus.
REJECT = 1e-12
SCALE = 10_000
#: Name, and standard deviation that is taken as noise in any case. Where a cell has none of its own, each statistic must be
#: able to pass the cutoff of REJECT (65.2, 8.07 deviations) alone: repeats do so below the base rule's half, (ln 51 / 0.48)**2 = 67.1.
FEATURES = (("word_length", 0.08), ("symbols", 0.35), ("dup_lines", 0.48), ("repeats", 0.48), ("marks", 0.15))
P = len(FEATURES)


def chi2_below(x: float, k: int) -> float:
    """The chi-square distribution with k degrees of freedom."""
    a, x, term, total = k / 2, x / 2, 1 / (k / 2), 0.0
    n = a
    while term > total * 1e-16 or n < x:
        total += term
        n += 1
        term *= x / n
    return min(1.0, total * math.exp(-x + a * math.log(x) - math.lgamma(a))) if x > 0 else 0.0


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_below(mid, k) < p else (low, mid)
    return high


def consistency(share: float) -> float:
    """What the scatter of the nearest share of a normal sample is multiplied with."""
    return share / chi2_below(chi2_quantile(share, P), P + 2)


def text_counts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_marks; the text itself is dropped."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    d = docs.withColumn("_t", text).drop(text_column)
    d = d.withColumn("_s", F.regexp_replace("_t", r"[\t-\r]", " "))
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    d = d.withColumn("_w", F.array_remove(F.split("_s", " "), "")).withColumn("_l", lines)
    d = d.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.replace(F.col("_s"), F.lit(" "))).cast("long"),
        "n_symbols": F.length(F.regexp_replace("_t", "[^#*$%&|<>]+", "")).cast("long"),
        "n_marks": F.length(F.regexp_replace("_t", "[^!?.,;:]+", "")).cast("long"),
        "n_lines": F.size("_l").cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "_h": F.when(F.size("_w") >= 3, F.transform(F.slice("_w", 1, F.size("_w") - 2), lambda x, i: F.xxhash64(x, F.get("_w", i + 1), F.get("_w", i + 2)))),
    }).drop("_t", "_s", "_w", "_l")
    return d.withColumn("n_repeat_words", _repeated("_h")).drop("_h")


def _repeated(hashes: str) -> Column:
    """Words covered by windows whose hash is there twice or more: the windows, sorted by hash and place packed into one
    number, have their equals beside them. Only texts that have such a window pay for the sort."""
    h, n = F.col(hashes), F.size(hashes)
    width = F.expr(f"shiftleft(1L, cast(ceil(log2(size({hashes}) + 1)) as int))")
    s = F.sort_array(F.transform(h, lambda x, i: x - F.pmod(x, width) + i))
    at = lambda x: F.pmod(x, width)

    def starts(s: Column) -> Column:
        same = lambda a, b: F.get(h, at(F.get(s, a)).cast("int")) == F.get(h, at(F.get(s, b)).cast("int"))
        twice = F.filter(F.transform(s, lambda x, j: F.when(((j > 0) & same(j - 1, j)) | ((j < n - 1) & same(j, j + 1)), at(x))), lambda x: x.isNotNull())
        return F.sort_array(twice)

    # a one-element transform names the sorted array, so that it is made once
    covered = F.aggregate(
        F.flatten(F.transform(F.array(s), starts)),
        F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("end")),
        lambda a, i: F.struct((a["words"] + i + 3 - F.greatest(i, a["end"])).alias("words"), (i + 3).cast("long").alias("end")),
        lambda a: a["words"],
    )
    return F.when(F.size(F.array_distinct(h)) < n, covered).otherwise(F.lit(0).cast("long"))


def features(d: DataFrame) -> DataFrame:
    """d with its statistics x0, x1, ... in ten thousandths."""
    words, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    values = {
        "word_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        "symbols": F.log1p(100 * F.col("n_symbols") / words),
        "dup_lines": F.log1p(100 * F.col("n_dup_lines") / lines),
        "repeats": F.log1p(100 * F.col("n_repeat_words") / words),
        "marks": F.log1p(10 * F.col("n_marks") / words),
    }
    return d.withColumns({f"x{i}": F.round(values[name] * SCALE).cast("long") for i, (name, _) in enumerate(FEATURES)})


def _cells(d: DataFrame) -> DataFrame:
    """d with `cell`: the number of documents decides which."""
    fine = F.to_json(F.struct(F.col("lang").cast("string").alias("l"), F.col("source").cast("string").alias("s")), {"ignoreNullFields": "false"})
    coarse = F.to_json(F.struct(F.col("lang").cast("string").alias("l")), {"ignoreNullFields": "false"})
    d = d.withColumns({"_fine": fine, "_coarse": coarse})
    usable = d.filter(~F.col("base_failed"))
    n_fine = usable.groupBy("_fine", "_coarse").agg(F.count("*").alias("n"))
    n_coarse = n_fine.filter(F.col("n") < LEAST).groupBy("_coarse").agg(F.sum("n").alias("nc"))
    names = n_fine.join(n_coarse, "_coarse", "left").select("_fine", F.when(F.col("n") >= LEAST, F.col("_fine")).when(F.col("nc") >= LEAST, F.col("_coarse")).otherwise(F.lit("all")).alias("cell"))
    return d.join(small(written(names, "quality-cells")), "_fine", "left").drop("_fine", "_coarse")


def _factored(e: DataFrame, cov: dict, keep: list[str]) -> DataFrame:
    """keep, centres m0, ..., lower triangle c00, c10, c11, ... of the Cholesky factor of cov, and logdet, its determinant's logarithm."""
    for i in range(P):
        for j in range(i + 1):
            rest = cov[i, j]
            for k in range(j):
                rest = rest - F.col(f"c{i}{k}") * F.col(f"c{j}{k}")
            e = e.withColumn(f"c{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"c{j}{j}"))
    logdet = sum((F.log(F.col(f"c{i}{i}")) for i in range(1, P)), F.log(F.col("c00"))) * 2
    return e.select(*keep, *(f"m{i}" for i in range(P)), *(f"c{i}{j}" for i in range(P) for j in range(i + 1)), logdet.alias("logdet"))


def _sums(x: list[Column]) -> list[Column]:
    """n, s0, ..., q00, q10, ...: whole numbers, so that sums don't depend on the order of rows."""
    wide = lambda c: c.cast("decimal(20,0)")
    return [F.count("*").alias("n"), *(F.sum(wide(x[i])).alias(f"s{i}") for i in range(P)), *(F.sum(wide(x[i] * x[j])).alias(f"q{i}{j}") for i in range(P) for j in range(i + 1))]


def _estimate(rows: DataFrame, factor: float, keep: list[str]) -> DataFrame:
    """Centre and scatter of the rows of each cell (and start), with the noise of FEATURES added; see _factored()."""
    e = rows.groupBy(*keep).agg(*_sums([F.col(f"x{i}") for i in range(P)]))
    n = F.col("n").cast("double")
    e = e.withColumns({f"m{i}": F.col(f"s{i}").cast("double") / n for i in range(P)})
    cov = {(i, j): factor * (F.col(f"q{i}{j}").cast("double") / n - F.col(f"m{i}") * F.col(f"m{j}")) + ((FEATURES[i][1] * SCALE) ** 2 if i == j else 0) for i in range(P) for j in range(i + 1)}
    return _factored(e, cov, keep)


def _distance(rows: DataFrame, estimate: DataFrame, how: str = "inner") -> DataFrame:
    """rows with d2, the squared Mahalanobis distance, by forward substitution; a row for each start of the estimate. The estimate, a row
    for each cell and start, is broadcast behind a count, so a hot cell stays where it is."""
    d = rows.join(small(estimate), "cell", how)
    for i in range(P):
        y = F.col(f"x{i}") - F.col(f"m{i}")
        for j in range(i):
            y = y - F.col(f"c{i}{j}") * F.col(f"y{j}")
        d = d.withColumn(f"y{i}", y / F.col(f"c{i}{i}"))
    d2 = sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, P)), F.col("y0") * F.col("y0"))
    return d.withColumn("d2", d2).drop(*(f"m{i}" for i in range(P)), *(f"c{i}{j}" for i in range(P) for j in range(i + 1)), "logdet", *(f"y{i}" for i in range(P)))


def _nearest(d: DataFrame, keep: list[str]) -> DataFrame:
    """The rows of d in the nearest SHARE of their cell (and start), whole bins of distance at a time."""
    d = d.withColumn("bin", F.floor(F.log(F.col("d2") + 1e-9) * 32).cast("int"))
    bins = d.groupBy(*keep, "bin").agg(F.count("*").alias("k"))
    up = Window.partitionBy(*keep).orderBy("bin")
    bins = bins.withColumns({"below": F.sum("k").over(up) - F.col("k"), "whole": F.sum("k").over(Window.partitionBy(*keep))})
    last = bins.filter(F.col("below") < SHARE * F.col("whole")).groupBy(*keep).agg(F.max("bin").alias("last"))
    return d.join(small(written(last, "quality-bins")), keep).filter(F.col("bin") <= F.col("last"))


def _starts(usable: DataFrame) -> DataFrame:
    """cell, start and the estimates that the search begins with, for cells of LEAST documents and more."""
    middle = usable.groupBy("cell").agg(F.count("*").alias("n"), *(F.percentile(f"x{i}", F.lit(0.5)).alias(f"m{i}") for i in range(P))).filter(F.col("n") >= LEAST).drop("n")
    middle = written(middle, "quality-middle")
    d = usable.join(small(middle), "cell")
    spread = d.groupBy("cell").agg(*(F.percentile(F.round(F.abs(F.col(f"x{i}") - F.col(f"m{i}"))), F.lit(0.5)).alias(f"d{i}") for i in range(P)))
    width = [F.sqrt(F.pow(1.4826 * F.col(f"d{i}"), 2) + (FEATURES[i][1] * SCALE) ** 2) for i in range(P)]
    scale = written(middle.join(spread, "cell").select("cell", *(f"m{i}" for i in range(P)), *(width[i].alias(f"w{i}") for i in range(P))), "quality-scale")
    d = usable.join(small(scale), "cell")
    z = [(F.col(f"x{i}") - F.col(f"m{i}")) / F.col(f"w{i}") for i in range(P)]
    length = F.sqrt(sum((x * x for x in z[1:]), z[0] * z[0]) + 1e-9)
    whole = lambda c: F.round(c * SCALE).cast("long")
    made = {"tangents": [whole(F.tanh(x)) for x in z], "signs": [whole(x / length) for x in z]}
    out = []
    for name in STARTS:
        if name == "deviations":
            e, r = scale, {(i, j): F.lit(0.0) for i in range(P) for j in range(i)}
        else:
            e = d.groupBy("cell").agg(*_sums(made[name])).join(small(scale), "cell")
            n = F.col("n").cast("double")
            c = {(i, j): F.col(f"q{i}{j}").cast("double") / n - F.col(f"s{i}").cast("double") / n * F.col(f"s{j}").cast("double") / n for i in range(P) for j in range(i + 1)}
            # a statistic that doesn't vary goes with none
            r = {(i, j): F.coalesce(F.try_divide(0.99 * c[i, j], F.sqrt(c[i, i] * c[j, j])), F.lit(0.0)) for i in range(P) for j in range(i)}
        cov = {(i, j): F.col(f"w{i}") * F.col(f"w{j}") * (r[i, j] if i != j else F.lit(1.0)) for i in range(P) for j in range(i + 1)}
        out.append(_factored(e.withColumn("start", F.lit(name)), cov, ["cell", "start"]))
    return reduce(DataFrame.unionByName, out)


def estimates(usable: DataFrame) -> DataFrame:
    """The minimum-covariance-determinant estimate of each cell of usable (cell, x0, ...)."""
    step = lambda e, keep: written(_estimate(_nearest(_distance(usable, e), keep), consistency(SHARE), keep), "quality-estimate")
    tried = written(_starts(usable), "quality-starts")
    for _ in range(FIRST):
        tried = step(tried, ["cell", "start"])
    names = [c for c in tried.columns if c not in ("cell", "start")]
    best = tried.groupBy("cell").agg(F.min(F.struct("logdet", "start", *(c for c in names if c != "logdet"))).alias("e")).select("cell", *(F.col(f"e.{c}").alias(c) for c in names))
    best = written(best, "quality-best")
    for _ in range(STEPS):
        further = step(best, ["cell"])
        both = further.select("cell", F.struct(*names).alias("new")).join(best.select("cell", F.struct(*names).alias("old")), "cell")
        fell = F.col("new.logdet") < F.col("old.logdet") - FALL
        both = written(both.select("cell", fell.alias("fell"), F.when(fell, F.col("new")).otherwise(F.col("old")).alias("e")), "quality-best")
        best = both.select("cell", *(F.col(f"e.{c}").alias(c) for c in names))
        if not both.filter("fell").limit(1).count():
            break
    near = _distance(usable, best).filter(F.col("d2") <= chi2_quantile(0.975, P))
    return written(_estimate(near, consistency(0.975), ["cell"]), "quality-estimate")


def assess(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", key: bool = False) -> DataFrame:
    """doc_id, the counts, base_failed, kept, d2 for each row of docs (which has lang and source); key: also text_key, a hash of the text."""
    d = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    if key:
        d = d.withColumn("text_key", F.xxhash64("text"))
    d = text_counts(d)
    d = d.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    d = written(features(d), "quality-counts")
    d = written(_cells(d), "quality-rows")
    usable = d.filter(~F.col("base_failed")).select("cell", *(f"x{i}" for i in range(P)))
    judged = _distance(d, estimates(usable), "left")
    outlier = F.coalesce(F.col("d2") > chi2_quantile(1 - REJECT, P), F.lit(False))
    return judged.select("doc_id", *["text_key"] * key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~outlier).alias("kept"), "d2")


def keep(docs: DataFrame) -> DataFrame:
    """The rows of docs that assess() keeps, with all their columns."""
    verdict = assess(docs, key=True)
    gone = small(written(verdict.filter(~F.col("kept")).select("doc_id", "text_key").distinct(), "quality-rejects"))
    same = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.xxhash64("d.text") == F.col("g.text_key"))
    return docs.alias("d").join(gone.alias("g"), same, "left_anti")
