"""Embedding near-duplicates by randomised rotation and binary codes.

A unit vector is rotated at random. Stored for each distinct vector, once: the signs of the rotated vector (its binary code), the
inner product of code (as a unit vector) and vector (its correction factor), the rotated vector in bytes, and how far those are
from it (their residual). <code(x), y> / factor(x) is an unbiased estimate of the cosine of x and y; for a cosine c its error has
the scale sqrt((1 - f**2) / f**2) * sqrt(1 - c**2) / sqrt(dim - 1), and y's bytes in place of y add residual(y) / factor(x) at
most. A pair is recomputed in double precision if the estimate is not below the wanted cosine by more than CONFIDENCE
times that scale (a chance of 2e-9 to miss) and the residual, and no pair is linked without. Vectors themselves are fetched only for rows that have such a pair.

Pairs are those that share BITS signs of a rotation in one of several tables. Bits grow with the logarithm of the vectors
that share a label, tables with the bits, so that two vectors just at the wanted cosine share a table with a chance of
1 - MISS. A pair is counted in its first shared table, so nothing is counted twice and pairs are never
written out: a block gives each vector's number of links and one link to its group's smallest. Buckets of any size are dealt in
blocks, two and two. Equal vectors are one class from the start.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite components, and those with a null label,
are linked with nothing; vectors of different lengths aren't compared; rows with the same id are one node and each count as a
vector; columns other than vec_id, label and embedding are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import keyed_join, prepared, small, whole_runs, written
from textmill.llm.components import components

COSINE = 0.98
MISS = 1e-4
CONFIDENCE = 6.0
BLOCK = 2048


def rotation(dim: int, number: int) -> np.ndarray:
    """A random rotation, the same in every task."""
    g = np.random.default_rng([dim, number, 17]).standard_normal((dim, dim))
    q, r = np.linalg.qr(g)
    return q * np.sign(np.diag(r))


_rotations: dict[tuple[int, int], np.ndarray] = {}


def _rotation(dim: int, number: int) -> np.ndarray:
    if (dim, number) not in _rotations:
        _rotations[dim, number] = rotation(dim, number)
    return _rotations[dim, number]


def tables_for(vectors: int) -> tuple[int, int]:
    """(bits of a bucket, tables) for so many vectors to compare with one another."""
    bits = max(4, min(31, math.ceil(math.log2(max(2, vectors))) + 3))
    agree = (1 - math.acos(COSINE) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - agree))


def vectors(df: DataFrame) -> DataFrame:
    """vec_id, label, dim, key (digest of the label's text and the components), vec (the components as they are; null if not to be linked)."""
    dtype = _dtype(df)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, keys, vecs = [], [], []
            for label, x in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                v = None
                if label is not None and x and None not in x:
                    v = np.array(x, dtype) + np.dtype(dtype).type(0)
                    v = v if np.isfinite(v).all() and v.any() else None
                raw = None if v is None else v.tobytes()
                dims.append(None if v is None else len(v))
                vecs.append(raw)
                keys.append(None if v is None else hashlib.blake2b(label.encode() + b"\0" + raw, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(dims, pa.int32()), pa.array(keys, pa.binary()), pa.array(vecs, pa.binary())], names=["vec_id", "label", "dim", "key", "vec"])

    kinds = {c: df.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    return df.select("vec_id", "label", F.col("label").cast("string").alias("said"), "embedding").mapInArrow(rows, f"vec_id {kinds['vec_id']}, label {kinds['label']}, dim int, key binary, vec binary")


def _dtype(df: DataFrame) -> str:
    return "<f4" if df.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"


def stored(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of vectors (rows of x, not zero): signs of the rotated unit vectors, correction factors, their bytes, the bytes' unit, residuals."""
    d = x.shape[1]
    x = x / np.abs(x).max(axis=1)[:, None]
    turned = (x / np.sqrt((x * x).sum(axis=1))[:, None]) @ _rotation(d, 0).T
    signs = turned > 0
    factor = (np.where(signs, turned, -turned)).sum(axis=1) / math.sqrt(d)
    unit = np.abs(turned).max(axis=1) / 127
    steps = np.rint(turned / unit[:, None]).astype(np.int8)
    return signs, factor, steps, unit, np.sqrt(((turned - steps * unit[:, None]) ** 2).sum(axis=1))


def may_link(signs: np.ndarray, factor: np.ndarray, near: np.ndarray, residual: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs of left and right can't be ruled out: estimates by the codes of left and the bytes (near) of right."""
    d = near.shape[1]
    f = factor[left, None]
    estimate = np.where(signs[left], 1.0, -1.0) / math.sqrt(d) @ near[right].T / f
    scale = np.sqrt(np.maximum(0, 1 - f**2)) / f * math.sqrt(1 - COSINE**2)
    return estimate >= COSINE - scale * min(CONFIDENCE / math.sqrt(max(1, d - 1)), 1.0) - residual[right] / f - 1e-9


def _coded(classes: DataFrame, bits: int, tables: int, dtype: str) -> DataFrame:
    """node, label, dim, codes (the bucket in each table, by rotations of their own), packed (the same as bytes), signs, steps, nums (factor, unit,
    residual) of each class, written to the shared folder."""
    wide = "<u2" if bits <= 16 else "<u4"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits, dtype=np.int64)
        for b in batches:
            dims, vecs = b.column(2).to_pylist(), b.column(3).to_pylist()
            codes = np.zeros((len(dims), tables), np.int64)
            kept: list[list] = [[b""] * len(dims) for _ in range(3)]
            for d in set(dims):
                mine = [i for i, x in enumerate(dims) if x == d]
                x = np.frombuffer(b"".join(vecs[i] for i in mine), dtype).reshape(-1, d).astype(np.float64)
                need = bits * tables
                signs = np.concatenate([x @ _rotation(d, 1 + r).T for r in range(-(-need // d))], axis=1)[:, :need] > 0
                codes[mine] = (signs.reshape(len(mine), tables, bits) * weights).sum(axis=2)
                sign, factor, steps, unit, residual = stored(x)
                nums = np.stack([factor, unit, residual], axis=1)
                for i, g, h, n in zip(mine, np.packbits(sign, axis=1), steps, nums, strict=True):
                    for c, v in zip(kept, (g, h, n), strict=True):
                        c[i] = v.tobytes()
            packed = [c.tobytes() for c in codes.astype(wide)]
            columns = [b.column(0), b.column(1), b.column(2), pa.array(list(codes.astype(np.int32)), pa.list_(pa.int32())), *(pa.array(c, pa.binary()) for c in (packed, *kept))]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "label", "dim", "codes", "packed", "signs", "steps", "nums"])

    label = classes.schema["label"].dataType.simpleString()
    return written(classes.select("node", "label", "dim", "vec").mapInArrow(rows, f"node long, label {label}, dim int, codes array<int>, packed binary, signs binary, steps binary, nums binary"), "vector-codes")


GROUP = ["label", "dim", "table", "code", "u", "v"]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(table of rows, dim, number of the hash table, left, right) of each block of rows (GROUP, own, node, packed, ...)."""
    for t, edges in whole_runs(batches, 6):
        dims, table, u, v, own = (t.column(c).to_numpy() for c in (1, 2, 4, 5, 6))
        for s, e in zip(edges, edges[1:], strict=False):
            if e - s > 1:
                left = np.flatnonzero(own[s:e] == u[s])
                yield t.slice(s, e - s), int(dims[s]), int(table[s]), left, left if u[s] == v[s] else np.flatnonzero(own[s:e] == v[s])


def _matrix(t: pa.Table, column: str, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(t.column(column).to_pylist()), dtype).reshape(t.num_rows, -1)


def _first(codes: np.ndarray, a: np.ndarray, b: np.ndarray, table: int) -> np.ndarray:
    """Which pairs share no table before this one."""
    return ~(codes[a, :table] == codes[b, :table]).any(axis=1) if table else np.ones(len(a), bool)


def _chunks(left: np.ndarray, right: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Parts of left, and which of their pairs with right to take (each pair once where left is right)."""
    for s in range(0, len(left), 64):
        i = left[s : s + 64]
        once = np.arange(s, s + len(i))[:, None] < np.arange(len(right))[None, :] if left is right else np.ones((len(i), len(right)), bool)
        yield i, once


def _open(dealt: DataFrame, coded: DataFrame, wide: str) -> DataFrame:
    """The rows of dealt (GROUP, own, node), with packed, that have a pair in their block which codes and factors leave open."""
    full = dealt.join(coded.select("node", "packed", "signs", "steps", "nums"), "node").select(*GROUP, "own", "node", "packed", "signs", "steps", "nums")
    full = full.repartition(*GROUP).sortWithinPartitions(*GROUP, "own", "node")
    label = dealt.schema["label"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, d, table, left, right in _blocks(batches):
            signs = np.unpackbits(_matrix(t, "signs", "u1"), axis=1)[:, :d] > 0
            factor, unit, residual = _matrix(t, "nums", "<f8").T
            near, codes = _matrix(t, "steps", "i1") * unit[:, None], _matrix(t, "packed", wide)
            live = np.zeros(t.num_rows, bool)
            for i, once in _chunks(left, right):
                p, q = np.nonzero(may_link(signs, factor, near, residual, i, right) & once)
                a, b = i[p], right[q]
                new = _first(codes, a, b, table)
                live[a[new]] = live[b[new]] = True
            if live.any():
                yield from t.select([*GROUP, "own", "node", "packed"]).filter(pa.array(live)).combine_chunks().to_batches()

    return written(full.mapInArrow(rows, f"label {label}, dim int, table int, code int, u int, v int, own int, node long, packed binary"), "open-vectors")


def _exact(live: DataFrame, classes: DataFrame, wide: str, dtype: str) -> DataFrame:
    """node, links (vectors of other classes linked directly), root (a linked one of its group, the smallest), from the rows that _open() leaves."""
    full = live.join(classes.select("node", "n", "vec"), "node").select(*GROUP, "own", "node", "packed", "n", "vec")
    full = full.repartition(*GROUP).sortWithinPartitions(*GROUP, "own", "node")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, _, table, left, right in _blocks(batches):
            x, codes = _matrix(t, "vec", dtype).astype(np.float64), _matrix(t, "packed", wide)
            norm, n, node = np.sqrt((x * x).sum(axis=1)), t.column("n").to_numpy(), t.column("node").to_numpy()
            found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i, once in _chunks(left, right):
                p, q = np.nonzero((x[i] @ x[right].T >= (COSINE - 1e-9) * norm[i, None] * norm[right]) & once)
                a, b = i[p], right[q]
                linked = _first(codes, a, b, table)
                linked &= np.einsum("ij,ij->i", x[a], x[b]) / (norm[a] * norm[b]) >= COSINE
                found_a.append(a[linked])
                found_b.append(b[linked])
            a, b = np.concatenate(found_a), np.concatenate(found_b)
            if not len(a):
                continue
            links = np.bincount(a, n[b], t.num_rows) + np.bincount(b, n[a], t.num_rows)
            root = np.arange(t.num_rows)
            while True:  # the smallest of each group, by both ends of every pair
                new = root.copy()
                np.minimum.at(new, a, root[b])
                np.minimum.at(new, b, root[a])
                if (new == root).all():
                    break
                root = new
            k = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(node[k], pa.int64()), pa.array(links[k].astype(np.int64)), pa.array(node[root[k]], pa.int64())], names=["node", "links", "root"])

    return written(full.mapInArrow(rows, "node long, links long, root long"), "vector-links")


def links_of(classes: DataFrame, bits: int, tables: int, dtype: str, block: int = BLOCK) -> DataFrame:
    """_exact() for all classes (node, label, dim, n, vec)."""
    coded = _coded(classes, bits, tables, dtype)
    at = GROUP[:4]
    lean = coded.select("label", "dim", "node", F.posexplode("codes").alias("table", "code"))
    several = lean.groupBy(*at).agg(F.count("*").alias("k")).filter(F.col("k") > 1).select(*at, F.ceil(F.col("k") / block).cast("int").alias("parts"))
    dealt = lean.join(small(written(several, "buckets")), at).withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select(*at, F.least("own", "with").alias("u"), F.greatest("own", "with").alias("v"), "own", "node")
    wide = "<u2" if bits <= 16 else "<u4"
    return _exact(small(_open(small(written(dealt, "dealt-vectors")), coded, wide)), classes, wide, dtype)


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of embeddings (vec_id, label, embedding)."""
    prepared(embeddings.sparkSession)
    v = written(vectors(embeddings), "vectors")
    valid = v.filter(F.col("key").isNotNull() & F.col("vec_id").isNotNull())
    classes = valid.groupBy("label", "dim", "key").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"), F.min("vec").alias("vec"))
    classes = written(classes.select(F.monotonically_increasing_id().alias("node"), "*"), "vector-classes")
    most = classes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    found = links_of(classes, *tables_for(most), _dtype(embeddings))
    edges = found.select(F.col("root").alias("a"), F.col("node").alias("b"))
    # a row's id is a node as well: an id that has several vectors joins their components
    ids = valid.groupBy("vec_id").agg(F.count("*").alias("k")).filter(F.col("k") > 1).select("vec_id")
    again = valid.select("vec_id", "key").join(small(written(ids, "repeated-vectors")), "vec_id").join(classes.select("key", "node"), "key").select("vec_id", "node")
    low = again.groupBy("vec_id").agg(F.min("node").alias("a"))
    roots = components(edges.unionByName(again.join(low, "vec_id").select("a", F.col("node").alias("b"))))
    own = classes.join(roots, "node", "left").select("key", "id", "n", "node", F.coalesce("root", "node").alias("root"))
    first = own.groupBy("root").agg(F.min("id").alias("first"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    per_class = own.join(first, "root").join(links, "node", "left").select("key", "n", "first", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    rows = v.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("key")).alias("key"))
    out = keyed_join(rows, written(per_class, "vector-places"), "key", F.col("n"))
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("first", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
