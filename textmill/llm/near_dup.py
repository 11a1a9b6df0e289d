"""MinHash near-duplicates by an LSH forest of sorted signature orders, confirmed on full shingle sets.

A text, lower-cased A-Z, gives the set of 64-bit hashes of its 5-word shingles, and SIGNATURE minima of it, 16 bits of each.
Texts with equal sets are one class from the start; a class is a node, whatever ids its documents have. There are TREES
orders of a signature's values: order t begins at value DEPTH * t and goes on around, KEY values long. Every order is sorted
as a whole over the cluster (range partitions, so classes with a common prefix, however many, are spread), and there

1. neighbours: two classes beside one another that share DEPTH values or more have the longest common prefixes that either
   has in that order; these pairs, at most TREES for each class, are confirmed on full sets and joined to components;
2. regions: the classes that share DEPTH values in an order. A region of up to BLOCK classes is taken at that depth; a larger
   one is cut where prefixes part, deeper and deeper, until its parts are that small or signatures are equal. A part whose
   classes are all in one component is done, since more links in it can't change the result. In the others all pairs of
   different components are compared, first by signatures, then by full sets in blocks that give a spanning forest only;
3. the rest: regions that were cut and are still in several components are compared as a whole, in blocks dealt two and two;
   the rows of the largest component only meet the others. So depth decides the order of the work, never what is found.

Two texts of similarity 0.75 share no region with a chance of (1 - 0.75**DEPTH)**TREES, 2.4e-5, and their signatures agree in
less than LEAST_ESTIMATE with a chance below 2e-6. Nothing is capped. Rows written for a region are linear in its classes
up to BLOCK of them, and grow by a BLOCK-th of the square in step 3 only.

Defined cases: a null text, or one without words, has an empty set and is linked with nothing; fewer than five words
are one shingle; in near_duplicates() a null id is linked with nothing, in one_of_each() its row counts like others; an id that occurs with different texts joins the components of its texts
in near_duplicates() (it is one document there), but not in one_of_each(), where each row is a text of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import BoundedCache, discard, held, keyed_join, no_null_text, prepared, small, whole_runs, written
from textmill.llm.components import components

WORDS = 5
NUM, DEN = 75, 100  # similarity of links: DEN * intersection >= NUM * union
TREES, DEPTH = 28, 4
SIGNATURE = TREES * DEPTH
#: Values by which an order is sorted.
KEY = 16
LEAST_ESTIMATE = 0.55
#: Classes, and shingles, that are compared with one another in one task.
BLOCK, BLOCK_SHINGLES = 1024, 2_000_000
_lower = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_random = np.random.default_rng(20240229)
_odd = _random.integers(0, 1 << 63, SIGNATURE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_xor = _random.integers(0, 1 << 63, SIGNATURE, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit integers that spreads them."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingler:
    def __init__(self):
        import xxhash

        self.words = BoundedCache(lambda keys: [xxhash.xxh3_64_intdigest(k) for k in keys], 100_000)

    def hashes(self, text: str) -> np.ndarray:
        """The text's shingle set as sorted distinct 64-bit hashes."""
        words = text.encode().translate(_lower).split()
        if not words:
            return np.empty(0, np.uint64)
        known = self.words.ensure(words)
        w = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = max(1, len(w) - WORDS + 1)
        h = np.full(n, min(len(w), WORDS), np.uint64)
        for k in range(min(len(w), WORDS)):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + w[k : k + n]
        return np.unique(_mixed(h))


def signature(h: np.ndarray) -> np.ndarray:
    """SIGNATURE minima, 16 bits of a hash of each."""
    low = np.full(SIGNATURE, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(h), 512):
        np.minimum(low, ((h[a : a + 512, None] ^ _xor) * _odd).min(axis=0), out=low)
    return (_mixed(low) >> np.uint64(48)).astype("<u2")


def signatures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, text_key, n_shingles, set_key (a 128-bit digest of the set; null for an empty set), sig for each row of docs, written to the shared folder."""
    import xxhash

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = held(Shingler)
        for b in batches:
            n, key, sig = [], [], []
            for t in b.column(2).to_pylist():
                h = s.hashes(t)
                n.append(len(h))
                key.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
                sig.append(signature(h).tobytes() if len(h) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(sig, pa.binary())], names=["doc_id", "text_key", "n_shingles", "set_key", "sig"])

    kind = docs.schema[id_column].dataType.simpleString()
    out = docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(text_column).alias("text_key"), no_null_text(text_column).alias("text"))
    return written(out.mapInArrow(rows, f"doc_id {kind}, text_key long, n_shingles long, set_key binary, sig binary"), "signatures")


def classes_of(sig: DataFrame, unnamed: bool = False) -> DataFrame:
    """node, set_key, id (the smallest of its documents), text_key (of that one's text), n (rows), size (shingles), sig of each distinct set.
    unnamed: rows without an id count as well; a class of such rows alone has no id."""
    valid = sig.filter(F.col("set_key").isNotNull() & (F.col("doc_id").isNotNull() | F.lit(unnamed)))
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key"))  # rows without an id come last
    c = valid.groupBy("set_key").agg(least.alias("l"), F.count("*").alias("n"), F.min("n_shingles").cast("int").alias("size"), F.min("sig").alias("sig"))
    c = c.select("set_key", F.col("l.doc_id").alias("id"), F.col("l.text_key").alias("text_key"), "n", "size", "sig")
    return written(c.select(F.monotonically_increasing_id().alias("node"), "*"), "classes")  # numbered once: what is written stays


def parted(shared: np.ndarray, most: int) -> np.ndarray:
    """The depth of each row of a sorted region: DEPTH, or where more than `most` rows share that, as many more values as it
    takes. shared: how many values a row has in common with the one before."""
    depth = np.full(len(shared), DEPTH)
    for d in range(DEPTH + 1, KEY + 1):
        part = np.cumsum(shared < depth)
        large = np.bincount(part)[part] > most
        if not large.any():
            break
        depth[large] = d
    return depth


def forest(classes: DataFrame, block: int = BLOCK) -> DataFrame:
    """region, part (of the region, by its own depth), prev (the neighbour before), node, size: the classes of each sorted order that share
    DEPTH values with a neighbour. What begins or ends a range partition is there in any case."""
    import xxhash

    wide = F.concat("sig", F.substring("sig", 1, 2 * KEY))
    orders = F.array(*(F.concat(F.unhex(F.lit(f"{t:02x}")), F.substring("_w", 2 * DEPTH * t + 1, 2 * KEY)) for t in range(TREES)))
    rows_in = classes.select("node", "size", wide.alias("_w")).select("node", "size", F.explode(orders).alias("order"))
    ordered = rows_in.repartitionByRange("order", "node").sortWithinPartitions("order", "node")

    def digest(raw: bytes) -> int:
        return xxhash.xxh3_64_intdigest(raw) - (1 << 63)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(parts: list[tuple], begins: bool, ends: bool) -> Iterator[pa.RecordBatch]:
            keys, node, size, shared = (np.concatenate(x) for x in zip(*parts, strict=True))
            starts = np.flatnonzero(shared < DEPTH)
            many = np.diff(np.append(starts, len(node)))
            out: list[list] = [[], [], [], [], []]
            last = starts[-1]
            for s, n in zip(starts.tolist(), many.tolist(), strict=True):
                if n == 1 and not (begins and s == 0 or ends and s == last):
                    continue
                region = digest(keys[s, : 1 + 2 * DEPTH].tobytes())
                own = shared[s : s + n].copy()
                own[0] = 0
                if n <= block:
                    part = [region] * n
                else:
                    depth = parted(own, block)
                    heads = np.flatnonzero(own < depth)
                    part = []
                    for a, z in zip(heads.tolist(), [*heads[1:].tolist(), n], strict=True):
                        d = int(depth[a])
                        part += [region if d == DEPTH else digest(keys[s + a, : 1 + 2 * d].tobytes())] * (z - a)
                ids = node[s : s + n].tolist()
                for c, v in zip(out, ([region] * n, part, [None, *ids[:-1]], ids, size[s : s + n].tolist()), strict=True):
                    c += v
            if out[0]:
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:4]), pa.array(out[4], pa.int32())], names=["region", "part", "prev", "node", "size"])

        held_: list[tuple] = []
        first = True
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint8).reshape(b.num_rows, -1)
            node, size = b.column(0).to_numpy(), b.column(1).to_numpy()
            before = np.concatenate([held_[-1][0][-1:] if held_ else keys[:1] ^ 255, keys[:-1]])
            same = np.concatenate([(keys[:, :1] == before[:, :1]), np.ascontiguousarray(keys[:, 1:]).view("<u2") == np.ascontiguousarray(before[:, 1:]).view("<u2")], axis=1)
            shared = np.maximum(np.logical_and.accumulate(same, axis=1).sum(axis=1) - 1, 0)
            cuts = np.flatnonzero(shared < DEPTH)
            if not len(cuts):
                held_.append((keys, node, size, shared))
                continue
            a, z = cuts[0], cuts[-1]
            if held_:
                yield from flush([*held_, (keys[:a], node[:a], size[:a], shared[:a])], first, False)
                first = False
            if z > a:
                yield from flush([(keys[a:z], node[a:z], size[a:z], shared[a:z])], first, False)
                first = False
            held_ = [(keys[z:], node[z:], size[z:], shared[z:])]
        if held_:
            yield from flush(held_, first, True)

    return written(ordered.select("node", "size", "order").mapInArrow(rows, "region long, part long, prev long, node long, size int"), "forest")


def similar(pairs: DataFrame, classes: DataFrame, least: float = LEAST_ESTIMATE) -> DataFrame:
    """The pairs (a, b) whose signatures agree in a share of `least` or more."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), "<u2").reshape(-1, SIGNATURE) for c in (2, 3))
                yield b.select([0, 1]).filter(pa.array((x == y).mean(axis=1) >= least))

    s = classes.select("node", "sig")
    p = pairs.join(s.withColumnsRenamed({"node": "a", "sig": "x"}), "a").join(s.withColumnsRenamed({"node": "b", "sig": "y"}), "b").select("a", "b", "x", "y")
    return p.mapInArrow(rows, "a long, b long")


def set_table(docs: DataFrame, need: DataFrame, repeated: bool) -> DataFrame:
    """node, hashes (its set as sorted 64-bit integers) for the nodes of need (node, id, text_key, set_key), from docs (id, text); written to
    the shared folder. repeated: rows may share id and text."""
    import xxhash

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = held(Shingler)
        for b in batches:
            nodes, out = [], []
            for i, t, k in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True):
                h = s.hashes(t or "")
                if xxhash.xxh3_128_digest(h.tobytes()) == k:
                    nodes.append(i)
                    out.append(h.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(out, pa.binary())], names=["node", "hashes"])

    n = small(written(need, "needed")).withColumnsRenamed({"id": "_id", "text_key": "_key"})
    some = docs.join(n, (F.xxhash64("text") == F.col("_key")) & F.col("id").eqNullSafe(F.col("_id"))).select("node", "text", "set_key")
    sets = some.mapInArrow(rows, "node long, hashes binary")
    return written(sets.groupBy("node").agg(F.first("hashes").alias("hashes")) if repeated else sets, "sets")


def confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, repeated: bool = False) -> DataFrame:
    """The pairs (a < b) whose full sets reach the similarity; docs: id and text.

    Pairs are dealt by a and a salt, so a class with very many partners is spread; in a task a's set is made once and each
    partner's as it comes. Sets are made only for classes that are in a pair.
    """
    pairs = written(pairs, "candidates")
    salted = pairs.select("a", F.pmod(F.xxhash64("b"), F.lit(1 << 20)).cast("int").alias("salt"), "b")
    need = classes.join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node").select("node", "id", "text_key", "set_key")
    sets = set_table(docs, need, repeated)
    fewer = salted.groupBy("a").agg(F.ceil(F.count("*") / 64).cast("int").alias("parts"))
    salted = salted.join(fewer, "a").select("a", F.pmod("salt", F.col("parts")).alias("salt"), "b")
    heads = salted.select("a", "salt").distinct().join(sets.withColumnRenamed("node", "a"), "a").select("a", "salt", F.lit(None).cast("long").alias("b"), "hashes")
    tails = salted.join(sets.withColumnRenamed("node", "b"), "b").select("a", "salt", "b", "hashes")
    dealt = heads.unionByName(tails).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.empty(0, np.uint64)
        for x in batches:
            a, b, keep = x.column(0).to_pylist(), x.column(2).to_pylist(), []
            for i, (other, h) in enumerate(zip(b, x.column(3).to_pylist(), strict=True)):
                h = np.frombuffer(h, np.uint64)
                if other is None:
                    mine = h
                elif len(h) * DEN >= NUM * len(mine) and len(mine) * DEN >= NUM * len(h):
                    both = len(mine) + len(h) - len(np.union1d(mine, h))
                    if DEN * both >= NUM * (len(mine) + len(h) - both):
                        keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], names=["a", "b"])

    out = written(dealt.mapInArrow(rows, "a long, b long"), "confirmed")
    discard(pairs, sets)
    return out


def open_rows(rows: DataFrame, roots: DataFrame, block: int) -> DataFrame:
    """group, x, y, own, node, root for rows (group, node, size) of the groups that are in several components: dealt to blocks of
    which each two meet, but for those of the group's largest component among themselves."""
    rows = rows.join(roots, "node", "left").select("group", "node", "size", F.coalesce("root", "node").alias("root"))
    rows = written(rows, "group-rows")
    per = rows.groupBy("group", "root").agg(F.count("*").alias("n"), F.sum("size").alias("w"))
    most = F.max(F.struct("n", "w", "root"))
    g = per.groupBy("group").agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("w").alias("w"), most.alias("m")).filter(F.col("k") > 1)
    blocks = lambda n, w: F.ceil(F.greatest(n / block, w / BLOCK_SHINGLES)).cast("int")
    one = (F.col("n") <= block) & (F.col("w") <= BLOCK_SHINGLES)
    g = g.select("group", F.when(one, F.lit(None)).otherwise(F.col("m.root")).alias("large"), F.when(one, 0).otherwise(blocks(F.col("m.n"), F.col("m.w"))).alias("ka"), F.when(one, 1).otherwise(blocks(F.col("n") - F.col("m.n"), F.col("w") - F.col("m.w"))).alias("kb"))
    rows = rows.join(small(written(g, "open-groups")), "group")
    major = F.coalesce(F.col("root") == F.col("large"), F.lit(False))
    mark = F.xxhash64("node")
    own = F.when(major, F.pmod(mark, F.greatest(F.col("ka"), F.lit(1)))).otherwise(F.col("ka") + F.pmod(mark, F.col("kb"))).cast("int")
    rows = rows.withColumns({"own": own, "with": F.explode(F.sequence(F.when(major, F.col("ka")).otherwise(0), F.col("ka") + F.col("kb") - 1))})
    return rows.select("group", F.least("own", "with").alias("x"), F.greatest("own", "with").alias("y"), "own", "node", "root")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(group's table, first row, end, places of x's rows, places of y's rows, roots) of each block of rows (group, x, y, own, node, root, ...)."""
    for t, edges in whole_runs(batches, 3):
        x, y, own, roots = (t.column(c).to_numpy() for c in (1, 2, 3, 5))
        for s, e in zip(edges, edges[1:], strict=False):
            if e - s > 1:
                left = np.flatnonzero(own[s:e] == x[s])
                yield t, s, e, left, left if x[s] == y[s] else np.flatnonzero(own[s:e] == y[s]), roots[s:e]


def screened(dealt: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of open_rows() that have, in their block, a class of another component with a signature like theirs."""
    near = dealt.join(classes.select("node", "sig"), "node").select("group", "x", "y", "own", "node", "root", "sig")
    near = near.repartition("group", "x", "y").sortWithinPartitions("group", "x", "y", "own", "node")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, s, e, left, right, roots in _blocks(batches):
            sig = np.frombuffer(b"".join(t.column(6).slice(s, e - s).to_pylist()), "<u2").reshape(-1, SIGNATURE)
            live = np.zeros(e - s, bool)
            for a in range(0, len(left), 64):
                i = left[a : a + 64]
                close = (roots[i, None] != roots[right]) & (np.count_nonzero(sig[i, None, :] == sig[right], axis=2) >= LEAST_ESTIMATE * SIGNATURE)
                live[i] |= close.any(axis=1)
                live[right] |= close.any(axis=0)
            if live.any():
                yield from t.slice(s, e - s).select([0, 1, 2, 3, 4, 5]).filter(pa.array(live)).combine_chunks().to_batches()

    return written(near.mapInArrow(rows, "group long, x int, y int, own int, node long, root long"), "live-rows")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections, above the diagonal. Shingles that few have are counted pair by pair, the others by products of 0-1 matrices."""
    n = len(sets)
    flat, row = np.concatenate(sets), np.repeat(np.arange(n), [len(h) for h in sets])
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    many = np.diff(np.append(first, len(flat)))
    col, few = np.repeat(np.arange(len(first)), many), np.repeat(many <= 8, many)
    both = np.zeros(n * n, np.int64)
    for k in range(1, 8):
        i = np.flatnonzero((col[k:] == col[:-k]) & few[k:])
        if not len(i):
            break
        both += np.bincount(row[i] * n + row[i + k], minlength=n * n)
    both = both.reshape(n, n)
    often = np.flatnonzero(many > 8)
    at = np.full(len(first), -1)
    at[often] = np.arange(len(often))
    place, row = at[col[~few]], row[~few]
    for a in range(0, len(often), 4096):
        mine = (place >= a) & (place < a + 4096)
        m = np.zeros((n, min(4096, len(often) - a)), np.float32)
        m[row[mine], place[mine] - a] = 1
        both += np.triu(m @ m.T, 1).astype(np.int64)
    return both


def spanning(live: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: in each block, every class that is linked with one of another component, with the smallest class it is joined to."""
    full = live.join(sets, "node").select("group", "x", "y", "own", "node", "root", "hashes")
    full = full.repartition("group", "x", "y").sortWithinPartitions("group", "x", "y", "own", "node")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, s, e, left, right, roots in _blocks(batches):
            sets_ = [np.frombuffer(h, np.uint64) for h in t.column(6).slice(s, e - s).to_pylist()]
            node, size = t.column(4).slice(s, e - s).to_numpy(), np.array([len(h) for h in sets_])
            both = overlaps(sets_)
            may = np.zeros(both.shape, bool)
            may[np.ix_(left, right)] = True
            may |= may.T
            linked = may & (roots[:, None] != roots) & (DEN * both >= NUM * (size[:, None] + size - both))
            p, q = np.nonzero(np.triu(linked, 1))
            label = np.arange(e - s)
            while True:
                new = label.copy()
                np.minimum.at(new, p, label[q])
                np.minimum.at(new, q, label[p])
                if (new == label).all():
                    break
                label = new
            b = np.flatnonzero(label != np.arange(e - s))
            if len(b):
                yield pa.RecordBatch.from_arrays([pa.array(node[label[b]], pa.int64()), pa.array(node[b], pa.int64())], names=["a", "b"])

    return written(full.mapInArrow(rows, "a long, b long"), "region-links")


def linked(classes: DataFrame, docs: DataFrame, repeated: bool = False, block: int = BLOCK) -> DataFrame:
    """node, root for the classes that are in a component with others; docs: id and text."""
    found = forest(classes, block)
    pairs = found.filter(F.col("prev").isNotNull()).select(F.least("prev", "node").alias("a"), F.greatest("prev", "node").alias("b")).distinct()
    links = confirmed(similar(pairs, classes), docs, classes, repeated)
    roots = components(links)
    parts = found.groupBy("region").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter(F.col("p") != F.col("q")).select("region")
    cut = written(parts, "cut-regions")
    for name, rows in (("part", found), ("region", found.join(small(cut), "region", "left_semi"))):
        if name == "region" and not cut.limit(1).count():
            break
        live = screened(open_rows(rows.select(F.col(name).alias("group"), "node", "size"), roots, block), classes)
        need = classes.join(live.select("node").distinct(), "node").select("node", "id", "text_key", "set_key")
        sets = set_table(docs, need, repeated)
        links = spanning(live, sets)
        discard(live, sets)
        roots = components(links.unionByName(roots.select(F.col("root").alias("a"), F.col("node").alias("b"))))
    return roots


def repeated_ids(sig: DataFrame, unnamed: bool = False) -> DataFrame:
    """doc_id, several (has different sets) of the ids that more than one row has."""
    valid = sig.filter(F.col("set_key").isNotNull() & (F.col("doc_id").isNotNull() | F.lit(unnamed)))
    ids = valid.groupBy("doc_id").agg(F.count("*").alias("n"), (F.min("set_key") != F.max("set_key")).alias("several"))
    return written(ids.filter(F.col("n") > 1).select("doc_id", "several"), "repeated-ids")


def placed(docs: DataFrame, id_column: str, text_column: str, unnamed: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """signatures(), the classes with their root and the smallest id of their component (set_key, n, root, first), and repeated_ids()."""
    prepared(docs.sparkSession)
    sig = signatures(docs, id_column, text_column)
    classes, again = classes_of(sig, unnamed), repeated_ids(sig, unnamed)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    roots = linked(classes, texts, bool(again.limit(1).count()))
    own = classes.select("node", "set_key", "id", "n").join(roots, "node", "left").select("set_key", "id", "n", F.coalesce("root", "node").alias("root"))
    own = written(own, "class-roots")
    first = own.groupBy("root").agg(F.min("id").alias("first"))
    return sig, written(own.join(first, "root").select("set_key", "n", "root", "first"), "placed"), again


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs: an empty table gives none, texts are taken whole, other columns are not read.
    Rows without an id are linked with nothing."""
    prepared(docs.sparkSession)
    sig, place, again = placed(docs, id_column, text_column)
    several = again.filter("several").select("doc_id")
    if several.limit(1).count():  # an id with different texts is one document
        ids = sig.join(several, "doc_id").select("doc_id", "set_key").distinct().join(place, "set_key").select("doc_id", "root").distinct()
        low = ids.groupBy("doc_id").agg(F.min("root").alias("a"))
        more = components(ids.join(low, "doc_id").select("a", F.col("root").alias("b")))
        joined = place.join(more.select(F.col("root").alias("_top"), F.col("node").alias("root")), "root", "left").withColumn("root", F.coalesce("_top", "root")).drop("_top")
        joined = written(joined, "joined")
        place = joined.drop("first").join(joined.groupBy("root").agg(F.min("first").alias("first")), "root")
    rows = sig.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key"))
    out = keyed_join(rows, place.select("set_key", "n", "first"), "set_key", F.col("n"))
    return out.select("doc_id", "n_shingles", F.coalesce("first", "doc_id").alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """docs with one row of each component: the smallest id (rows without one come last and count like others), of its texts in the component the
    one with the smallest hash, of rows that have both in common any one. Rows without words stay; all columns stay, whatever their names.
    An empty table stays empty; texts are taken whole, however long."""
    sig, place, again = placed(docs, id_column, text_column, unnamed=True)
    rows = sig.filter(F.col("set_key").isNotNull()).select("doc_id", "text_key", "set_key")
    rows = written(keyed_join(rows, place.select("set_key", "n", "root"), "set_key", F.col("n")).select("doc_id", "text_key", "root"), "row-roots")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key"))
    best = rows.groupBy("root").agg(F.count("*").alias("n"), least.alias("best")).filter(F.col("n") > 1)
    best = written(best, "best-rows")
    some = keyed_join(rows, best, "root", F.col("n"), "inner")
    other = ~F.col("doc_id").eqNullSafe(F.col("best.doc_id")) | (F.col("text_key") != F.col("best.text_key"))
    gone = small(written(some.filter(other).select("doc_id", "text_key").distinct(), "near-copies"))
    mine = F.col(f"d.{id_column}").eqNullSafe(F.col("g.doc_id")) & (F.xxhash64(f"d.{text_column}") == F.col("g.text_key"))
    left = docs.alias("d").join(gone.alias("g"), mine, "left_anti")
    if not again.limit(1).count():
        return left
    twice = small(written(rows.groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).filter(F.col("n") > 1), "repeated-rows"))
    once = left.alias("d").join(twice.alias("g"), mine, "left_anti")
    same = left.alias("d").join(twice.alias("g"), mine, "left_semi").withColumn("_textmill_key", F.xxhash64(text_column))
    return once.unionByName(same.dropDuplicates([id_column, "_textmill_key"]).drop("_textmill_key"))
