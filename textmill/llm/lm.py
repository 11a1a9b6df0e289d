"""LM scoring: word counts and a log-frequency Bloom filter of the counts of pairs and triples of neighbours.

Training texts give exact word counts (over dictionary blocks, see blocks) and the counts of pairs and triples, with start
and end. These are quantised to levels, the logarithm to base BASE; the filter holds an n-gram once for each
level up to its own, so a count is read by probing level after level until one isn't there, and errors only raise it. The
largest count seen says how many levels there are.
The filter is cut into segments, about four for each partition of the input and order. A segment is built in the task that sums its bucket's n-grams, as large as all
of them need to leave it FILL full (FILTER_BYTES are the least in all), so every counted n-gram is in it whatever the corpus.
Nothing is broadcast, since a filter that holds all of them grows with the corpus: the same task holds the bucket's n-grams of every block, trained on or not, probes its segment for
them, and the levels go back to their blocks as the word counts do.

A text's score sums log10 of (triple + STRENGTH * below) / (pair before + STRENGTH), where below is
(pair + STRENGTH * unigram) / (word before + STRENGTH), and unigram (c + 1) / (N + V + 1). Word counts are exact. Of a level's range
the least is taken for what is divided and the largest for the pair divided by, so that what a context gives
to all words adds up to one at most, but for the filter's errors (an absent n-gram reads as present with a chance of FILL ** PROBES).

Defined cases: a null or empty text has one token, its end; a document with a null id counts as one with the empty id; if no
document is in training, N and V are 0 and every word is new; repeated rows are texts of their own, an empty table has none; columns other than id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm import blocks
from textmill.llm.common import no_null_text, prepared, sweep, written

#: The least size of the filter.
FILTER_BYTES = 32 << 20
#: Share of a segment's bits that are set at most: an absent pair is read as present with a chance of FILL ** PROBES.
FILL = 0.2
#: Smaller blocks than for encoding alone: a block's n-grams are sorted in memory.
BLOCK_BYTES = 12 << 20
PROBES = 3
#: Bits of an n-gram's hash; the upper ones are its bucket.
BITS = 48
BASE = 1.5
START, END = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC949C7DEFE8D6A31)
STRENGTH = 4.0
_lower = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def split_words(text: str) -> list[bytes]:
    return text.encode().translate(_lower).split()


def hashes_of(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), "<u8", len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mixed((a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0x7F4A7C159E3779B9) + (a >> np.uint64(7))))


class Chain:
    """A block's texts (codes into h, the hashes of words) one after another, each with two starts before and its end behind.
    What is said of each token, the ends included, comes in the order of the texts."""

    def __init__(self, h: np.ndarray, texts: list[np.ndarray]):
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        begins = np.concatenate([[0], np.cumsum(self.sizes + 2)[:-1]])
        self.codes = np.zeros(int((self.sizes + 2).sum()), np.int64)  # 0: start, 1: end
        for b, c in zip(begins.tolist(), texts, strict=True):
            self.codes[b + 2 : b + 2 + len(c)] = c
            self.codes[b + 2 : b + 2 + len(c)] += 2
            self.codes[b + 2 + len(c)] = 1
        self.token = np.ones(len(self.codes), bool)
        self.token[begins] = self.token[begins + 1] = False
        self.hashes = np.concatenate([[START, END], h]).astype(np.uint64)

    def own(self, of: np.ndarray) -> np.ndarray:
        """What `of` (start, end, words) has of each token."""
        return of[self.codes[self.token]]

    def before(self, of: np.ndarray) -> np.ndarray:
        """What `of` has of the word, or start, before each token."""
        return of[self.codes[:-1][self.token[1:]]]

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes, of BITS bits, of the pair and the triple that end at each token."""
        chain, token, down = self.hashes[self.codes], self.token[2:], np.uint64(64 - BITS)
        pairs = _both(chain[:-1], chain[1:])
        return pairs[1:][token] >> down, _both(pairs[:-1], chain[2:])[token] >> down


def bucket_bits(docs: DataFrame) -> int:
    """So many bits for buckets that there are two to four of each order for a partition of the scan: a bucket keeps its size as the input grows."""
    return max(4, min(16, math.ceil(math.log2(2 * max(1, docs.rdd.getNumPartitions())))))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(0)) % 7 == 2


def _word_sums(table: DataFrame) -> DataFrame:
    """Per block and bucket: block, n, x (codes), y (counts in all), z (word hashes), and on one row of each bucket
    its tokens and distinct words. Rows of a bucket come together; they stay packed until both passes over them are made."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["block", "n", "x", "y", "z", "tokens", "distinct"]
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 3, pa.int64(), pa.int64()]

        def finish(held: list[tuple]) -> Iterator[pa.RecordBatch]:
            total: dict[bytes, int] = {}
            for _, n, x, _, z in held:
                for w, c in zip(blocks.blob_words(x, n), blocks.loose(z, "<u4").tolist(), strict=True):
                    if c:
                        total[w] = total.get(w, 0) + c
            sums = (sum(total.values()), len(total))
            for at in range(0, len(held), 16):
                out = []
                for block, n, x, y, _ in held[at : at + 16]:
                    words = blocks.blob_words(x, n)
                    c = np.fromiter((total.get(w, 0) for w in words), "<i8", n)
                    out.append((block, n, y, blocks.squeezed(c), hashes_of(words).tobytes(), *sums))
                    sums = (0, 0)
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=names)

        at, held = None, []
        for b in batches:
            for bucket, *row in zip(*(b.column(c).to_pylist() for c in range(6)), strict=True):
                if bucket != at and held:
                    yield from finish(held)
                    held = []
                at = bucket
                held.append(tuple(row))
        if held:
            yield from finish(held)

    w = table.filter(F.col("kind") == "w").select("bucket", "block", "n", "x", "y", "z").repartition("bucket").sortWithinPartitions("bucket")
    return written(w.mapInArrow(rows, "block long, n long, x binary, y binary, z binary, tokens long, distinct long"), "word-sums")


def _places(pairs: np.ndarray, level: int, probe: int, bits: int) -> np.ndarray:
    seed = (level * PROBES + probe + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
    x = (pairs + np.uint64(seed)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(32))) % np.uint64(bits)


def levels_of(counts: np.ndarray) -> np.ndarray:
    return (1 + np.floor(np.log(counts) / math.log(BASE) + 1e-9)).astype(np.int64)


def _ends() -> tuple[np.ndarray, np.ndarray]:
    low, n = [0.0], 1
    while low[-1] < 1 << 63:
        low.append(float(math.ceil(BASE ** (n - 1) - 1e-9)))
        n += 1
    return np.array(low[:-1]), np.array([0.0, *(max(a, b - 1) for a, b in zip(low[1:], low[2:], strict=False))])


#: The least and the largest count of each level; 0 for level 0.
LEAST_OF, MOST_OF = _ends()


def segment_bytes(counts: np.ndarray, least: int) -> int:
    """The bytes of a segment for all pairs with these counts."""
    return max(least, math.ceil(int(levels_of(counts).sum()) * PROBES / -math.log(1 - FILL) / 8))


def segment(pairs: np.ndarray, counts: np.ndarray, size: int) -> bytes:
    """A segment of `size` bytes of the filter, with every pair."""
    level, bits = levels_of(counts), 8 * size
    flags = np.zeros(bits, np.bool_)
    for k in range(1, int(level.max(initial=0)) + 1):
        pairs, level = pairs[level >= k], level[level >= k]
        for p in range(PROBES):
            flags[_places(pairs, k, p, bits)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def _packed(steps: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted numbers as differences: the three low bytes, which don't compress, and the rest, which does."""
    d = np.diff(steps, prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(d.view("u1").reshape(-1, 8)[:, :3]).tobytes(), blocks.squeezed((d >> np.uint64(24)).astype("<u4").view("u1").reshape(-1, 4).T.copy())


def _loose(x: bytes, y: bytes) -> np.ndarray:
    low = np.frombuffer(x, "u1").reshape(-1, 3)
    d = np.zeros((len(low), 8), "u1")
    d[:, :3] = low
    d[:, 3:7] = blocks.loose(y, "u1").reshape(4, -1).T
    return np.cumsum(d.view("<u8").reshape(-1))


def _gram_rows(table: DataFrame, bits: int) -> DataFrame:
    """bucket (of pairs, then of triples), block, x, y (a block's distinct n-grams in it, sorted), z (their counts in training texts)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("x", pa.binary()), ("y", pa.binary()), ("z", pa.binary())])

        def of_block(block: int, words: list, texts: list) -> Iterator[tuple]:
            h = np.zeros(max((int(codes.max()) for codes, _ in words), default=-1) + 1, np.uint64)
            for codes, mine in words:
                h[codes] = mine
            chain = Chain(h, [c for _, c in texts])
            flags = np.repeat(np.array([flag for flag, _ in texts]), chain.sizes).astype(np.uint64)
            for order, found in enumerate(chain.grams()):
                every, counts = _distinct(found, flags)
                cuts = np.searchsorted(every, np.arange((1 << bits) + 1).astype(np.uint64) << np.uint64(BITS - bits))
                for k in range(1 << bits):
                    a, b = cuts[k], cuts[k + 1]
                    if a < b:
                        yield (order << bits) + k, block, *_packed(every[a:b] & np.uint64((1 << BITS - bits) - 1)), blocks.squeezed(counts[a:b].astype("<u4"))

        def all_rows() -> Iterator[tuple]:
            at, words, texts, packed = None, [], [], blocks.Packed()
            for b in batches:
                for block, seq, flag, n, x, y in zip(*(b.column(c).to_pylist() for c in range(6)), strict=True):
                    if block != at:
                        if texts:
                            yield from of_block(at, words, texts)
                        at, words, texts = block, [], []
                    if seq < 0:
                        words.append((blocks.word_codes(y), hashes_of(blocks.blob_words(x, n))))
                    else:
                        texts.append((flag, packed.take(x, n)))
            if texts:
                yield from of_block(at, words, texts)

        yield from blocks.in_batches(all_rows(), schema)

    whole = table.select("block", F.coalesce("seq", F.lit(-1)).alias("seq"), "flag", "n", "x", "y")
    whole = whole.repartition("block").sortWithinPartitions("block", "seq")
    return whole.mapInArrow(rows, "bucket int, block long, x binary, y binary, z binary")


def _distinct(found: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct numbers and how often each occurs with a flag."""
    every = (found << np.uint64(1)) | flags
    every.sort()
    first = np.flatnonzero(np.concatenate([[True], every[1:] >> np.uint64(1) != every[:-1] >> np.uint64(1)]))
    return every[first] >> np.uint64(1), np.add.reduceat(every & np.uint64(1), first)


def _levels(table: DataFrame, bits: int, least: int) -> DataFrame:
    """block, n (a bucket), x (what the filter says of the levels of the block's n-grams in it, in their order). A bucket's sorted
    n-grams are summed block by block, none is in two buckets, and rows stay packed until both passes over them are made."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed(some: list) -> tuple[np.ndarray, np.ndarray]:
            found, inverse = np.unique(np.concatenate([p for p, _ in some]), return_inverse=True)
            return found, np.bincount(inverse, np.concatenate([c for _, c in some]), len(found))

        def finish(bucket: int, held: list) -> Iterator[pa.RecordBatch]:
            some = [(np.zeros(0, np.uint64), np.zeros(0))]
            for _, x, y, z in held:
                counts = blocks.loose(z, "<u4")
                some.append((_loose(x, y)[counts > 0], counts[counts > 0]))
                if len(some) > 64:  # keeps what is unpacked near the number of distinct n-grams
                    some = [summed(some)]
            found, counts = summed(some)
            size = segment_bytes(counts, least)
            made = Filter(segment(found, counts, size), int(levels_of(counts).max(initial=0)))
            for at in range(0, len(held), 64):
                part = held[at : at + 64]
                levels = [blocks.squeezed(made.levels(_loose(x, y)).astype("u1")) for _, x, y, _ in part]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int64()), pa.array([bucket] * len(part), pa.int64()), pa.array(levels, pa.binary())], names=["block", "n", "x"])

        at, held = None, []
        for b in batches:
            for bucket, *row in zip(*(b.column(c).to_pylist() for c in range(5)), strict=True):
                if bucket != at and held:
                    yield from finish(at, held)
                    held = []
                at = bucket
                held.append(tuple(row))
        if held:
            yield from finish(at, held)

    g = _gram_rows(table, bits).repartition("bucket").sortWithinPartitions("bucket")
    return written(g.mapInArrow(rows, "block long, n long, x binary"), "gram-levels")


class Filter:
    """A segment; most: the level of its largest count, where that is known."""

    def __init__(self, raw: bytes, most: int = len(LEAST_OF) - 1):
        self.bits, self.most = np.frombuffer(raw, np.uint8), most

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """What the filter says of each n-gram's level."""
        level = np.zeros(len(grams), np.int64)
        open_ = np.arange(len(grams))
        for k in range(1, self.most + 1):
            for p in range(PROBES):
                at = _places(grams[open_], k, p, 8 * len(self.bits)).astype(np.int64)
                open_ = open_[self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1]
            if not len(open_):
                break
            level[open_] = k
        return level


def levels_back(found: np.ndarray, parts: list[np.ndarray]) -> np.ndarray:
    """The level of each n-gram, from those of the distinct ones in the order of their hashes, which is that of a block's buckets."""
    distinct, inverse = np.unique(found, return_inverse=True)
    level = np.concatenate([np.zeros(0, "u1"), *parts])
    if len(level) != len(distinct):
        raise ValueError(f"{len(distinct)} n-grams in a block, levels of {len(level)}")
    return level.astype(np.int64)[inverse]


def score(docs: DataFrame, filter_bytes: int = FILTER_BYTES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of docs."""
    prepared(docs.sparkSession)
    rows_in = docs.select(F.col(id_column).alias("doc_id"), (~held_out(id_column)).alias("flag"), no_null_text(text_column).alias("text"))
    table = blocks.block_table(rows_in, split_words, blocks.buckets_for(docs), with_counts=True, most=BLOCK_BYTES)
    sums = _word_sums(table)
    sweep(docs.sparkSession)
    bits = bucket_bits(docs)
    levels = _levels(table, bits, max(8, filter_bytes >> bits + 1))
    sweep(docs.sparkSession)
    ends = table.filter((F.col("kind") == "d") & F.col("flag")).count()
    tokens, distinct = sums.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    total, kinds = tokens + ends, distinct + (ends > 0)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        less = math.log10(total + kinds + 1)

        def finish(words: list, parts: dict[int, bytes], texts: list) -> Iterator[pa.RecordBatch]:
            top = max((int(codes.max()) for codes, _, _ in words), default=-1) + 1
            c, h = np.zeros(top, np.int64), np.zeros(top, np.uint64)
            for codes, y, z in words:
                c[codes], h[codes] = y, z
            chain = Chain(h, [codes for *_, codes in texts])
            at = np.concatenate([[0], np.cumsum(chain.sizes)[:-1]])
            counts = np.concatenate([[ends, ends], c])
            own, history = chain.own(counts), chain.before(counts)
            pair, triple = (levels_back(g, [blocks.loose(parts[i], "u1") for i in sorted(parts) if i >> bits == k]) for k, g in enumerate(chain.grams()))
            base = np.log10(own + 1) - less
            two = np.minimum(LEAST_OF[pair], np.minimum(own, history))
            before = np.empty(len(own))  # the pair that a triple's third word follows; of a text's first word, two starts
            before[1:] = MOST_OF[pair[:-1]]
            before[at] = ends
            before = np.minimum(before, history)
            three = np.minimum(np.minimum(LEAST_OF[triple], MOST_OF[pair]), before)
            p = (two + STRENGTH * np.power(10, base)) / (history + STRENGTH)
            p = np.log10((three + STRENGTH * p) / (before + STRENGTH))
            sums = zip(np.add.reduceat((own > 0).astype(np.int64), at).tolist(), np.add.reduceat(base, at).tolist(), np.add.reduceat(p, at).tolist(), strict=True)
            out = [(doc, not flag, len(codes) + 1, known, total, b, q) for (doc, flag, codes), (known, b, q) in zip(texts, sums, strict=True)]
            for k in range(0, len(out), 1000):
                yield blocks.record_batch(out[k : k + 1000], schema)

        at, packed = None, blocks.Packed()
        words, parts, texts = [], {}, []
        for b in batches:
            for block, seq, doc, flag, n, x, y, z in zip(*(b.column(i).to_pylist() for i in range(8)), strict=True):
                if block != at:
                    if texts:
                        yield from finish(words, parts, texts)
                    at, words, parts, texts = block, [], {}, []
                if seq >= 0:
                    texts.append((doc, flag, packed.take(x, n)))
                elif y is None:
                    parts[n] = x
                else:
                    words.append((blocks.word_codes(x), blocks.loose(y, "<i8"), np.frombuffer(z, "<u8")))
        if texts:
            yield from finish(words, parts, texts)

    id_type = blocks._schema(table.schema["doc_id"].dataType).field("doc_id").type
    fields = [("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
    schema = pa.schema([("doc_id", id_type), *fields])
    kind = table.schema["doc_id"].dataType.simpleString()
    none = F.lit(None).cast("binary")
    answers = sums.select("block", "n", "x", "y", "z").unionByName(levels.select("block", "n", "x", none.alias("y"), none.alias("z")))
    return blocks.by_block(table, answers).mapInArrow(rows, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
