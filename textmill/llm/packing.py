"""Packing: mixture-controlled sequences by deficit round-robin over source queues.

Each source is a queue of its documents' tokens, in the order of the materialised token table. A window gives every
queue a credit of window_tokens times its share of the mixture; a queue is served whole bursts out of its credit, and
what is left (its deficit, below one burst) is carried to the next window. Tokens can be cut anywhere, so the state of
the round robin after k windows has a closed form, served(k) = burst * floor(k * window * share / burst), and any
partition can place its documents from their offset in the queue alone: no window is gathered anywhere, and deficits
carry over partitions by construction. Sequences are cut from the served stream every `length` tokens; the tokens left
at its end are cut to powers of two, so there is no padding at all.

The mixture is a weight for each source, or an exponent: shares are then as the sources' tokens to that power, which gives
small sources more than their own share (MIXTURE; 1 is the corpus' own mixture). A queue that runs dry leaves its
share to the rest, in phases. Every token is packed.

At most QUEUES sources, those with the most documents and those that have a weight, are queues of their own; the others share one queue. So the schedule,
which is held on the driver and in tasks, has a bounded size however many sources there are.

Defined cases: a null or empty text has the end id alone; a null source is a queue of its own; documents with the same
id are packed each; an empty table gives no pieces; a text of any length is cut where a sequence ends; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import bisect
import re
import unicodedata
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import held, no_null_text, prepared, small, tokenizer, written
from textmill.llm.token_counts import balanced

END_ID = 1
#: Shares of the sources in a window are as their tokens to this power.
MIXTURE = 0.7
QUEUES, OTHERS = 256, "(others)"


#: A full stop or comma beside another mark, with which it is one word to the tokenizer.
_touching = re.compile(r"[.,](?:(?=[^\w\s]|[_\x1c-\x1f])|(?<=[^\w\s].)|(?<=[_\x1c-\x1f].))")


class WordEncoder:
    """ids of a text, as little-endian 16-bit integers: the text is cut at ASCII white space, which the tokenizer drops,
    and each distinct word is encoded once while the cache holds it.

    There are fewer distinct words in lower case and without full stops and commas behind them, so texts are brought
    to that first where it is what the tokenizer does itself. New words of letters are encoded in one string, and the
    tokens that end a word tell them apart.
    """

    def __init__(self, path: str, limit: int = 400_000):
        self.tokenizer = tokenizer(path)
        if self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16:
            raise ValueError(f"{path}: ids don't fit 16 bits")
        self.limit, self.words, self.older = limit, {}, {}
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ends[[i for piece, i in vocabulary.items() if piece.endswith(suffix)]] = True

    @staticmethod
    def cut(text: str) -> list[bytes]:
        """Words whose ids one after the other are the text's."""
        if "<|" in text or "'" in text or "\u0130" in text or "\u03a3" in text or not unicodedata.is_normalized("NFC", text):
            return text.encode().split()
        if _touching.search(text):
            return text.lower().encode().split()
        return text.lower().encode().replace(b".", b" .").replace(b",", b" ,").split()

    def _each(self, words: list[bytes]) -> list[bytes]:
        return [np.array(e.ids, "<u2").tobytes() for batch in balanced([w.decode() for w in words]) for e in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)]

    def _joined(self, words: list[bytes]) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(words), 2000):
            part = words[at : at + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, "<u2")
            ends = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(ends) == len(part) and ends[-1] == len(ids):
                raw = ids.tobytes()
                out += [raw[2 * a : 2 * b] for a, b in zip([0, *ends], ends, strict=False)]
            else:  # a word is more than one to the tokenizer
                out += self._each(part)
        return out

    def known(self, words: set[bytes]) -> dict[bytes, bytes]:
        """A mapping that has every one of words. When it is full, what it has is set aside for one more turn: words
        that occur again come back from there."""
        new = words.difference(self.words)
        if len(self.words) + len(new) > self.limit:
            self.words, self.older = {}, self.words
            new = words
        back = new.intersection(self.older)
        self.words.update((w, self.older[w]) for w in back)
        new = new.difference(back)
        letters = [w for w in new if len(w) <= 100 and w.decode().isalpha()]
        rest = list(new.difference(letters))
        self.words.update(zip(letters, self._joined(letters), strict=True))
        self.words.update(zip(rest, self._each(rest), strict=True))
        return self.words

    def many(self, texts: list[str]) -> Iterator[bytes]:
        """ids of each text; new words are encoded together for a few megabytes of texts."""
        for batch in balanced(texts, 4 << 20):
            cut = [self.cut(t) for t in batch]
            known = self.known(set().union(*cut))
            for words in cut:
                yield b"".join(map(known.__getitem__, words))


def queue_of(docs: DataFrame, source_column: str, named: list[str], most: int = QUEUES) -> Column:
    """The queue of a row: its source, or OTHERS where there are more sources than queues and the source is a small one without a weight."""
    source = F.col(source_column).cast("string")
    counts = docs.groupBy(source.alias("s")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "s").limit(most + 1).collect()  # bounded
    if len(counts) <= most:
        return source
    own = sorted({r["s"] for r in counts[:most] if r["s"] is not None} | set(named))
    return F.when(source.isNull() | source.isin(own), source).otherwise(F.lit(OTHERS))


def token_table(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", named: list[str] | None = None) -> DataFrame:
    """doc_id, source (its queue), part, start (the tokens of the same queue before it in the same part), n, ids: written to the shared folder."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, part, end = held(WordEncoder, path), TaskContext.get().partitionId(), np.array([END_ID], "<u2").tobytes()
        served: dict = {}
        for b in batches:
            sources, starts, ns, ids = b.column(1).to_pylist(), [], [], []
            for s, x in zip(sources, e.many(b.column(2).to_pylist()), strict=True):
                x += end
                ids.append(x)
                ns.append(len(x) // 2)
                starts.append(served.get(s, 0))
                served[s] = starts[-1] + ns[-1]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([part] * len(ns), pa.int64()), pa.array(starts, pa.int64()), pa.array(ns, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "source", "part", "start", "n", "ids"])

    kind = docs.schema[id_column].dataType.simpleString()
    table = docs.select(F.col(id_column).alias("doc_id"), queue_of(docs, source_column, named or []).alias("source"), no_null_text(text_column).alias("text"))
    return written(table.mapInArrow(rows, f"doc_id {kind}, source string, part long, start long, n long, ids binary"), "tokens")


class Schedule:
    """The round robin in closed form, in whole numbers. Queues are numbered in the order of `totals`."""

    def __init__(self, totals: list[int], weights: list[Fraction], window: int, burst: int):
        self.window, self.burst, self.totals = window, burst, totals
        #: phases: first window, tokens served of each queue before it, share of each queue as a fraction
        self.starts: list[int] = []
        self.phases: list[tuple[list[int], list[tuple[int, int]]]] = []
        done, k = [0] * len(totals), 0
        while open_ := [i for i, n in enumerate(totals) if done[i] < n]:
            live = {i: weights[i] for i in open_ if weights[i] > 0} or dict.fromkeys(open_, Fraction(1))
            whole = sum(live.values())
            shares = [live.get(i, Fraction(0)) / whole for i in range(len(totals))]
            self.starts.append(k)
            self.phases.append((done, [(s.numerator, s.denominator) for s in shares]))
            k += min(-(-(totals[i] - done[i]) // (window * shares[i])) for i in live)  # until a queue runs dry
            done = [self.served(i, k) for i in range(len(totals))]
        self.windows = k

    def served(self, i: int, k: int) -> int:
        """Tokens of queue i in the windows before k."""
        if not self.phases:
            return 0
        p = max(0, bisect.bisect_left(self.starts, k) - 1)
        before, (up, down) = self.phases[p][0][i], self.phases[p][1][i]
        credit = max(0, k - self.starts[p]) * self.window * up
        if before + credit // down >= self.totals[i]:  # credit for all that is left
            return self.totals[i]
        return before + credit // (down * self.burst) * self.burst

    def window_of(self, i: int, at: int) -> int:
        """The window that serves token `at` of queue i."""
        low, high = 0, self.windows
        while low < high:  # the last k with served(i, k) <= at
            mid = (low + high + 1) // 2
            if self.served(i, mid) <= at:
                low = mid
            else:
                high = mid - 1
        return low

    def base(self, i: int, k: int) -> int:
        """The place in the stream where window k has queue i's tokens."""
        return sum(self.served(j, k + (j < i)) for j in range(len(self.totals)))


def mixture(totals: list[tuple[str | None, int]], weights: dict[str, float] | float) -> list[Fraction]:
    """The weight of each queue of totals (source, tokens)."""
    if isinstance(weights, dict):
        return [Fraction(weights.get(s, 0)).limit_denominator(10**6) for s, _ in totals]
    whole = sum(n**weights for _, n in totals) or 1
    return [Fraction(max(1, round(10**6 * n**weights / whole)), 10**6) for _, n in totals]


def sequences(total: int, length: int) -> tuple[int, list[int]]:
    """The number of full sequences, and the ends of the shorter ones, which have powers of two."""
    full, ends = total // length, []
    at = full * length
    for bit in reversed(range(length.bit_length())):
        if (total - full * length) >> bit & 1:
            at += 1 << bit
            ends.append(at)
    return full, ends


def pack(docs: DataFrame, path: str, length: int = 2048, window_sequences: int = 64, weights: dict[str, float] | float = MIXTURE, tokens: DataFrame | None = None, **columns: str) -> DataFrame:
    """Pieces of documents in sequences: doc_id, source, start, length, ids_crc32, doc_tokens, sequence_id, offset, window.
    weights: of each source, or the power of its tokens that its share is as."""
    prepared(docs.sparkSession)
    tokens = token_table(docs, path, named=list(weights) if isinstance(weights, dict) else [], **columns) if tokens is None else tokens
    spark = tokens.sparkSession
    parts = written(tokens.groupBy("source", "part").agg(F.sum("n").alias("n")), "packing-parts")
    totals = sorted(((r["source"], r["n"]) for r in parts.groupBy("source").agg(F.sum("n").alias("n")).collect()), key=lambda x: (x[0] is None, x[0] or ""))
    number = {s: i for i, (s, _) in enumerate(totals)}
    exact = mixture(totals, weights)
    schedule = Schedule([n for _, n in totals], exact, window_sequences * length, length)
    full, ends = sequences(sum(n for _, n in totals), length)

    # where each part's tokens of a source begin in the source's queue: sums over parts in blocks, so no source is in one task
    width = 64
    block = (F.col("part") / width).cast("long")
    blocks = parts.groupBy("source", block.alias("block")).agg(F.sum("n").alias("n"))
    before = blocks.select("source", "block", (F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("before"))
    inner = parts.select("source", "part", block.alias("block"), F.coalesce(F.sum("n").over(Window.partitionBy("source", block).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("inner"))
    b = before.withColumnsRenamed({"source": "b_source", "block": "b_block"})
    bases = inner.join(b, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("block") == F.col("b_block"))).select(F.col("source").alias("b_source"), F.col("part").alias("b_part"), (F.col("before") + F.col("inner")).alias("queue_base"))
    bases = written(bases, "packing-bases")
    placed = tokens.join(small(bases), F.col("source").eqNullSafe(F.col("b_source")) & (F.col("part") == F.col("b_part"))).select("doc_id", "source", (F.col("start") + F.col("queue_base")).alias("at"), "n", "ids")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds: dict[tuple[int, int], tuple[int, int, int]] = {}

        def window(i: int, k: int) -> tuple[int, int, int]:
            if (i, k) not in bounds:
                if len(bounds) > 100_000:
                    bounds.clear()
                bounds[i, k] = schedule.served(i, k), schedule.served(i, k + 1), schedule.base(i, k)
            return bounds[i, k]

        hint: dict[int, int] = {}
        for b in batches:
            out: list[list] = [[] for _ in range(9)]
            for doc, source, at, n, ids in zip(*(b.column(c).to_pylist() for c in range(5)), strict=True):
                i, wide, start = number[source], np.frombuffer(ids, "<u2").astype("<u4").tobytes(), 0
                k = hint.get(i, -1)
                if k < 0 or not window(i, k)[0] <= at < window(i, k)[1]:
                    k = schedule.window_of(i, at)
                while start < n:
                    low, high, base = window(i, k)
                    if at + start >= high:
                        k += 1
                        continue
                    place = base + at + start - low
                    if place < full * length:
                        s, offset = divmod(place, length)
                        end = (s + 1) * length
                    else:
                        s = bisect.bisect_right(ends, place)
                        offset, end, s = place - (ends[s - 1] if s else full * length), ends[s], full + s
                    take = min(n - start, high - at - start, end - place)
                    for c, x in zip(out, (doc, source, start, take, zlib.crc32(wide[4 * start : 4 * (start + take)]), n, s, offset, k), strict=True):
                        c.append(x)
                    start += take
                hint[i] = k
            kinds = [b.column(0).type, pa.string(), *[pa.int64()] * 7]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=NAMES)

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return placed.mapInArrow(rows, f"doc_id {kind}, source string, " + ", ".join(f"{c} long" for c in NAMES[2:]))


NAMES = ["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window"]
