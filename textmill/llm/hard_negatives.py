"""Hard-negative mining by a vector-approximation file.

Every dimension is cut into CELLS cells at quantiles of a bounded sample of SAMPLE rows, and a vector's approximation is the cell of each of its
components, one byte a dimension, stored once beside the vector. For an anchor, a table for each two dimensions gives the least and the greatest
share that a pair of cells can have in an inner product, so that a row's score is bounded from below and above by looking its cells up and adding.
Only rows whose bounds let them enter an answer are scored exactly:

1. positives: of the rows with the anchor's label those whose upper bound reaches the last of the best lower bounds;
2. negatives: of the other rows those whose bounds meet the window of a positive, and whose upper bound reaches the last of the best lower bounds
   of rows that are surely inside.

Bounds hold for every row whatever the sample was (a block's outer cells end where its own rows do), so results are exact. Rows are dealt in blocks
of about ROWS, anchors in blocks of about ANCHORS, and each two blocks meet in a task: a task's memory is bounded, nothing is broadcast but the cells'
ends, and a label of any size is spread over all blocks. A block gives an anchor's best few rows, which are then ranked over the blocks.

Defined cases: rows whose id, label or vector is null, or that hold a null or non-finite component, take no part (nor do components so large that
`scale` times them isn't finite); vectors of different lengths don't meet; rows are told apart by themselves, so a repeated anchor gives its answers
again, and another row with an anchor's id counts as another row; anchors without positives, and windows without rows, give nothing, as an empty
table does; other columns, whatever their names, are not read. A score beyond 64 bits counts as the nearest 64-bit number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from textmill.llm.common import discard, prepared, whole_runs, written

CELLS = 64
SAMPLE = 4096
ROWS, ANCHORS = 8192, 8192
EXACT, LARGEST = float(1 << 53), float(1 << 63)


def usable(df: DataFrame, anchor: Column) -> DataFrame:
    """vec_id, label, anchor, dim, embedding (doubles) of the rows that take part."""
    label = F.col("label").cast("long") if isinstance(df.schema["label"].dataType, IntegralType) else F.xxhash64("label")
    e = F.col("embedding").cast("array<double>")
    odd = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), anchor.alias("anchor"), F.col("embedding").isNull().alias("_none"), e.alias("embedding"), F.col("label").isNull().alias("_unlabelled")) \
        .filter(~F.col("_none") & ~F.col("_unlabelled") & F.col("vec_id").isNotNull() & ~odd).select("vec_id", "label", F.coalesce("anchor", F.lit(False)).alias("anchor"), F.size("embedding").alias("dim"), "embedding")


def ends_of(values: np.ndarray, cells: int = CELLS) -> np.ndarray:
    """The ends (dim, cells - 1) of the cells of each column of whole numbers: cell c has the values from end c - 1 up to end c, which it doesn't have."""
    out = np.full((values.shape[1], cells - 1), np.inf)
    for d in range(values.shape[1]):
        v = np.unique(values[:, d])
        at = np.unique(v[np.linspace(0, len(v) - 1, cells + 1).astype(int)[1:-1]])
        out[d, : len(at)] = at
    return out


def fitted(rows: DataFrame, scale: float, sample: int = SAMPLE, cells: int = CELLS) -> dict[int, np.ndarray]:
    """The cells' ends of each length of vectors, from a sample of about `sample` rows of the whole table."""
    n = rows.count()
    some = rows.filter(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(max(1, n))) < sample).select("embedding").limit(2 * sample).toArrow()
    by: dict[int, list] = {}
    for v in some.column(0).to_pylist():
        by.setdefault(len(v), []).append(v)
    return {d: ends_of(np.floor(scale * np.array(v)), cells) for d, v in by.items()}


def approximated(rows: DataFrame, scale: float, ends: dict[int, np.ndarray]) -> DataFrame:
    """The vector-approximation file: row, vec_id, label, anchor, dim, code (a byte for each component), vec (the whole numbers as doubles)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(4).to_numpy(zero_copy_only=False)
            flat = np.floor(scale * b.column(5).flatten().to_numpy(zero_copy_only=False))
            at = np.concatenate([[0], np.cumsum(dims)])
            codes: list = [None] * b.num_rows
            vecs: list = [None] * b.num_rows
            for d in np.unique(dims).tolist():
                own = np.flatnonzero(dims == d)
                m = flat[at[own][:, None] + np.arange(d)]
                e = ends.get(d)
                code = np.zeros(m.shape, np.uint8)
                for k in range(d if e is not None else 0):
                    code[:, k] = np.searchsorted(e[k], m[:, k], side="right")
                for i, c, v, good in zip(own.tolist(), code, m, np.isfinite(m).all(axis=1), strict=True):
                    if good:
                        codes[i], vecs[i] = c.tobytes(), v.tobytes()
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(5)), pa.array(codes, pa.binary()), pa.array(vecs, pa.binary())], names=["row", "vec_id", "label", "anchor", "dim", "code", "vec"])

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "anchor", "dim", "embedding")  # numbered once: what is written stays
    out = numbered.mapInArrow(encode, "row long, vec_id long, label long, anchor boolean, dim int, code binary, vec binary")
    return written(out.filter(F.col("vec").isNotNull()), "va-file")


class Block:
    """Rows of one length, sorted by label, with what is looked up for an anchor."""

    def __init__(self, codes: np.ndarray, vecs: np.ndarray, labels: np.ndarray, ends: np.ndarray | None):
        self.vecs, self.labels, d = vecs, labels, vecs.shape[1]
        ends = np.full((d, 0), 0.0) if ends is None else ends
        self.cells = ends.shape[1] + 1
        least, most = (vecs.min(axis=0), vecs.max(axis=0)) if len(vecs) else (np.zeros(d), np.zeros(d))
        low, high = np.concatenate([least[:, None], ends], axis=1), np.concatenate([ends - 1, most[:, None]], axis=1)
        # no cell ends beyond the block's own rows, and what no row is in is nothing
        self.low, self.high = np.clip(low, least[:, None], most[:, None]), np.clip(high, least[:, None], most[:, None])
        if d % 2:
            self.low, self.high = (np.concatenate([x, np.zeros((1, self.cells))]) for x in (self.low, self.high))
            codes = np.concatenate([codes, np.zeros((len(codes), 1), np.uint8)], axis=1)
        self.at = np.ascontiguousarray((codes[:, 0::2].astype(np.intp) * self.cells + codes[:, 1::2]).T)
        self.largest = float(np.abs(vecs).max()) if vecs.size else 0.0

    def of_label(self, label: int) -> slice:
        return slice(*np.searchsorted(self.labels, [label, label + 1]).tolist()) if label < np.iinfo(np.int64).max else slice(int(np.searchsorted(self.labels, label)), len(self.labels))

    def bounds(self, q: np.ndarray, part: slice) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest score that each row of the part can have with q."""
        q2 = np.concatenate([q, [0.0]]) if len(q) % 2 else q
        x, y = q2[:, None] * self.low, q2[:, None] * self.high
        slack = 1e-12 * len(q) * self.largest * float(np.abs(q).max(initial=0.0))  # for sums that doubles can't hold
        out = []
        for t, spare in ((np.minimum(x, y), -slack), (np.maximum(x, y), slack)):
            tables = (t[0::2, :, None] + t[1::2, None, :]).reshape(len(self.at), self.cells**2)
            total = np.full(part.stop - part.start, spare)
            for table, at in zip(tables, self.at, strict=True):
                total += table.take(at[part])
            out.append(np.clip(total, -LARGEST, LARGEST))
        return out[0], out[1]

    def scores(self, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The exact scores of some rows."""
        if len(q) * self.largest * float(np.abs(q).max(initial=0.0)) < EXACT:
            return (self.vecs[rows] @ q).astype(np.int64)
        whole = [int(v) for v in q.tolist()]
        exact = (sum(int(a) * b for a, b in zip(v, whole, strict=True)) for v in self.vecs[rows].tolist())
        return np.array([max(-(1 << 63), min((1 << 63) - 1, s)) for s in exact], np.int64)


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, by score, then smaller id, then row."""
    return np.lexsort((rows, ids, ~scores))[:k]


def kth(values: np.ndarray, k: int) -> float:
    """The k-th largest, or minus infinity."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


def _dealt(file: DataFrame, anchors: DataFrame, rows: int, per: int) -> DataFrame:
    """x, y, dim, kind (0: anchor), label, row, vec_id, code, vec, pid, pscore: each block of anchors beside each block of rows."""
    n, a = file.count(), anchors.count()
    kx, ky = max(1, -(-n // rows)), max(1, -(-a // per))
    mark = lambda k: F.pmod(F.xxhash64("row"), F.lit(k)).cast("int")
    none = F.lit(None).cast("array<long>")
    left = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(kx - 1))).alias("x"), mark(ky).alias("y"), "dim", F.lit(0).alias("kind"), "label", "row", "vec_id", F.lit(None).cast("binary").alias("code"), "vec", "pid", "pscore")
    right = file.select(mark(kx).alias("x"), F.explode(F.sequence(F.lit(0), F.lit(ky - 1))).alias("y"), "dim", F.lit(1).alias("kind"), "label", "row", "vec_id", "code", "vec", none.alias("pid"), none.alias("pscore"))
    return left.unionByName(right).repartition("x", "y").sortWithinPartitions("x", "y", "dim", "kind", "label", "row")


def _answers(ends: dict[int, np.ndarray], positives: int, negatives: int, low: int, high: int, mine: bool):
    """A function of dealt rows that gives (anchor, anchor_id, place, positive_id, positive_score, row, other_id, score): the best rows of each block."""
    def of_anchor(block: Block, q: np.ndarray, label: int, row: int, ids: np.ndarray, rows: np.ndarray, wanted: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        own = block.of_label(label)
        if mine:
            least, most = block.bounds(q, own)
            least[rows[own] == row] = -np.inf
            may = np.flatnonzero((most >= kth(least, positives)) & (rows[own] != row)) + own.start
            s = block.scores(q, may)
            top = best(s, ids[may], rows[may], positives)
            yield 0, may[top], s[top]
            return
        windows = [(-(-low * p // 100), high * p // 100) for p in wanted]
        live = [(j, a, z) for j, (a, z) in enumerate(windows) if a <= z]
        if not live:
            return
        least, most = block.bounds(q, slice(0, len(rows)))
        least[own] = np.inf
        may = np.flatnonzero((least <= max(z for *_, z in live)) & (most >= min(a for _, a, _ in live)))
        if not len(may):
            return
        least, most = least[may], most[may]
        inside = []
        for _, a, z in live:
            open_ = (least <= z) & (most >= a)
            inside.append(open_ & (most >= kth(least[(least >= a) & (most <= z)], negatives)))
        some = np.logical_or.reduce(inside)
        s = np.zeros(len(may), np.int64)
        s[some] = block.scores(q, may[some])
        for (j, a, z), open_ in zip(live, inside, strict=True):
            hit = np.flatnonzero(open_ & (s >= a) & (s <= z))
            top = hit[best(s[hit], ids[may[hit]], rows[may[hit]], negatives)]
            yield j, may[top], s[top]

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, edges in whole_runs(batches, 3):
            kinds = t.column(3).to_numpy()
            out: list[list] = [[] for _ in range(8)]
            for s, e in zip(edges, edges[1:], strict=False):
                a = s + int((kinds[s:e] == 0).sum())
                if a == s or a == e:
                    continue
                dim = t.column(2)[s].as_py()
                read = lambda c, x, z, kind: np.frombuffer(b"".join(t.column(c).slice(x, z - x).to_pylist()), kind).reshape(z - x, dim)  # noqa: B023, E731
                rows, ids, labels = (t.column(c).slice(a, e - a).to_numpy() for c in (5, 6, 4))
                block = Block(read(7, a, e, np.uint8), read(8, a, e, np.float64), labels, ends.get(dim))
                heads = zip(read(8, s, a, np.float64), *(t.column(c).slice(s, a - s).to_pylist() for c in (4, 5, 6, 9, 10)), strict=True)
                for q, label, row, vec_id, pid, pscore in heads:
                    for j, at, scores in of_anchor(block, q, label, row, ids, rows, pscore or []):
                        n = len(at)
                        for c, v in zip(out, ([row] * n, [vec_id] * n, [j] * n, [pid[j] if pid else None] * n, [pscore[j] if pscore else None] * n, rows[at].tolist(), ids[at].tolist(), scores.tolist()), strict=True):
                            c += v
            kinds_ = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds_, strict=True)], names=ANSWER)

    return answer


ANSWER = ["anchor", "anchor_id", "place", "positive_id", "positive_score", "row", "other_id", "score"]
_KINDS = "anchor long, anchor_id long, place int, positive_id long, positive_score long, row long, other_id long, score long"


def hard_negatives(df: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0, rows: int = ROWS, anchors: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each row of df (vec_id, label, embedding) that `anchor` holds for
    and each of its first `positives` other rows of the same label, the first `negatives` rows of other labels whose score is from `low` to `high`
    hundredths of the positive's. A score is the inner product of floor(scale * component); higher ones come first, of equal ones the smaller id."""
    prepared(df.sparkSession)
    ok = usable(df, anchor)
    ends = fitted(ok, scale)
    file = approximated(ok, scale, ends)
    none = F.lit(None).cast("array<long>")
    heads = file.filter("anchor").select("dim", "label", "row", "vec_id", "vec", none.alias("pid"), none.alias("pscore"))
    order = [F.col("score").desc(), "other_id", "row"]
    near = _dealt(file, heads, rows, anchors).mapInArrow(_answers(ends, positives, negatives, low, high, True), _KINDS)
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("anchor").orderBy(*order))).filter(F.col("rank") <= positives)
    lists = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "other_id", "score"))).alias("p"))
    heads = heads.drop("pid", "pscore").join(lists.withColumnRenamed("anchor", "row"), "row").select("dim", "label", "row", "vec_id", "vec", F.col("p.other_id").alias("pid"), F.col("p.score").alias("pscore"))
    heads = written(heads, "anchors")
    far = _dealt(file, heads, rows, anchors).mapInArrow(_answers(ends, positives, negatives, low, high, False), _KINDS)
    far = far.withColumn("rank", F.row_number().over(Window.partitionBy("anchor", "place").orderBy(*order))).filter(F.col("rank") <= negatives)
    out = written(far.select("anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "hard-negatives")
    discard(file, heads)
    return out
