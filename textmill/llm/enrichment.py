"""Valid-time enrichment of sales with the versions of their clients, as a stateful streaming query over day pages.

Sales and changes arrive in batches; a query is started anew for each batch on one checkpoint. State is kept for a bucket of clients, in two maps from
days to pages: versions (a page has the versions that are valid from that day on) and waiting sales (those sold on that day), with a directory of
how many versions each client has in each page. In a batch a bucket

1. notes changes below their watermark as late, and puts the others into the pages of their days;
2. emits new and waiting sales whose time is below the horizon H, or unknown: the directory names the page of the sale's own day, or else the
   client's nearest earlier page, and only pages named so are read; other sales go into their days' pages;
3. drains the pages up to H: of each client's versions up to H the last goes into one base page, the other pages are dropped.

Every bucket gets one row without data in every batch, so what waits is emitted when H passes it, whether anything arrives or not.

Buckets hold about BUCKET rows of all batches. A client with more than HOT rows is dealt in cells: its versions in blocks, its sales in blocks, and
each two blocks meet in a cell of their own with state of its own. A cell gives the last of its versions for a sale, its base and its counts, and these
are put together over the cells behind the query. Nothing but the number of rows, ten watermarks and a day count goes to the driver; the list of hot
clients (at most a HOT-th of the rows) is joined, by broadcast only if it is counted to be short.

Defined cases: a sale without a time is emitted at once and has no version; rows without a client hold and find nothing, changes of no client can be
late; a sale without an arrival is in the last batch; what arrives before the first day is in batches with numbers below 0, by the same formula; a change without a valid time is left out, equal
rows of changes count once, of sales each; a null seq or change id comes before others; empty tables give no rows; other columns, whatever their
names, are read for nothing but to tell changes apart; texts of any length are only carried.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from textmill.llm.common import discard, prepared, small, written
from textmill.session import new_path, remove

BATCHES, FIRST_DAY, DAYS = 10, 19723, 152
#: Microseconds that a watermark lies behind, and of a day.
DELAY, DAY = 36 * 3_600_000_000, 86_400_000_000
BUCKET, HOT = 1 << 16, 1 << 16
#: The page of what was drained, before all days; stands for no time, client, id or number in feed, state and answers.
BASE, NEVER = -(1 << 31), -(1 << 63)
SALE, CHANGE, TICK = 0, 1, 2

FEED = "bucket long, kind int, hot boolean, row long, id long, client long, at long, seq long, cents long, op string"
_F = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), ("hot", pa.bool_()), *((c, pa.int64()) for c in ("row", "id", "client", "at", "seq", "cents")), ("op", pa.string())])
VERSION = ["client", "at", "seq", "id", "cents", "op"]
_V = pa.schema([("client", pa.int64()), ("at", pa.int64()), ("seq", pa.int64()), ("id", pa.int64()), ("cents", pa.int64()), ("op", pa.string())])
_S = pa.schema([("client", pa.int64()), ("at", pa.int64()), ("row", pa.int64()), ("id", pa.int64()), ("hot", pa.bool_())])
_D = pa.schema([("client", pa.int64()), ("day", pa.int64()), ("n", pa.int64())])
_SIDE = ["at", "seq", "id", "cents", "op"]
ANSWER = "rec string, row long, id long, sold long, hot boolean, batch long, n_rest long, " + ", ".join(f"{side}_{c} {'string' if c == 'op' else 'long'}" for side in ("rest", "base") for c in _SIDE)


def batch_of(day):
    """The batch of a day since 1970; a day before the first has a number below 0."""
    return F.least(F.lit(BATCHES - 1), F.floor((day - FIRST_DAY) * BATCHES / DAYS)).cast("int")


def _micros(c: str):
    """Microseconds since 1970 by the clock that a timestamp shows, whatever the session's zone."""
    seconds = F.hour(c) * 3600 + F.minute(c) * 60
    return F.datediff(F.to_date(F.col(c)), F.lit("1970-01-01").cast("date")).cast("long") * DAY + seconds.cast("long") * 1_000_000 + (F.date_part(F.lit("SECONDS"), F.col(c)) * 1_000_000).cast("long")


def staged(sales: DataFrame, changes: DataFrame) -> DataFrame:
    """batch and the columns of a feed but bucket and hot: sales and distinct changes, written once, in a folder for each batch, so feeding one reads no other."""
    day = lambda c: F.datediff(F.to_date(F.col(c)), F.lit("1970-01-01").cast("date"))
    none = F.lit(NEVER)
    long = lambda c: F.coalesce(c.cast("long"), none)
    s = sales.select(F.coalesce(batch_of(day("arrived_at")), F.lit(BATCHES - 1)).alias("batch"), F.lit(SALE).alias("kind"), F.monotonically_increasing_id().alias("row"), long(F.col("sale_id")).alias("id"), long(F.col("client_id")).alias("client"),
                     F.coalesce(_micros("sold_at"), none).alias("at"), none.alias("seq"), none.alias("cents"), F.lit(None).cast("string").alias("op"))
    shift = F.coalesce(F.pmod(F.crc32(F.col("change_id").cast("string")), F.lit(4)), F.lit(0))
    c = changes.filter(F.col("valid_at").isNotNull()).distinct().select(batch_of(day("valid_at") + shift).alias("batch"), F.lit(CHANGE).alias("kind"), none.alias("row"), long(F.col("change_id")).alias("id"), long(F.col("client_id")).alias("client"),
                     _micros("valid_at").alias("at"), long(F.col("seq")).alias("seq"), long(F.floor(100 * F.col("balance") + 0.5)).alias("cents"), F.col("op").cast("string").alias("op"))
    both, path = s.unionByName(c), new_path(sales.sparkSession, "staged")
    both.write.partitionBy("batch").parquet(path)
    out = sales.sparkSession.read.schema(both.schema).parquet(path)
    out._textmill_path = path
    return out


def horizons(rows: DataFrame) -> list[tuple[int, int, int]]:
    """(number, the changes' watermark, H) of each batch: those from 0 on, and below 0 those that have rows and the next ones. An empty batch behind
    an empty one has the same H, so nothing is due or pruned in it."""
    most = {(r.batch, r.kind): r.t for r in rows.groupBy("batch", "kind").agg(F.max("at").alias("t")).collect()}  # two rows for each batch
    early = {b for b, _ in most if b < 0}
    out, seen = [], {SALE: NEVER, CHANGE: NEVER}
    for b in sorted({*range(BATCHES), *early, *(x + 1 for x in early)}):
        marks = {k: t - DELAY if t > NEVER else NEVER for k, t in seen.items()}
        out.append((b, marks[CHANGE], min(marks.values())))
        seen = {k: max([t, *(x for x in [most.get((b, k))] if x is not None)]) for k, t in seen.items()}
    return out


def dealt(rows: DataFrame, bucket: int = BUCKET, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """rows with bucket and hot, those of hot clients once for each cell that they are in; and the table of all buckets, which is written."""
    per = rows.filter(F.col("client") != NEVER).groupBy("client").agg(F.count_if(F.col("kind") == SALE).alias("s"), F.count_if(F.col("kind") == CHANGE).alias("v")).filter(F.col("s") + F.col("v") > hot)
    of = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / hot)).cast("int")
    large = written(per.select("client", of("s").alias("ks"), of("v").alias("kv")), "hot-clients")
    n = rows.count()
    buckets = max(1, -(-n // bucket))
    own = F.pmod(F.when(F.col("client") == NEVER, F.xxhash64("row", "id")).otherwise(F.xxhash64("client")), F.lit(buckets)).cast("long")
    if not large.limit(1).count():
        out = rows.select(own.alias("bucket"), F.lit(False).alias("hot"), "*")
        return out, written(rows.sparkSession.range(buckets).select(F.col("id").alias("bucket")), "buckets")
    cell = lambda i, j: F.xxhash64("client", i, j).bitwiseOR(F.lit(1 << 62))
    each = lambda k: F.sequence(F.lit(0), F.col(k) - 1)
    mark = lambda c, k: F.pmod(F.xxhash64(c), F.col(k)).cast("int")
    wide = rows.join(small(large), "client", "left")
    cells = F.when(F.col("ks").isNull(), F.array(own)).when(F.col("kind") == SALE, F.transform(each("kv"), lambda i: cell(i, mark("row", "ks")))).otherwise(F.transform(each("ks"), lambda j: cell(mark("id", "kv"), j)))
    out = wide.select(F.col("ks").isNotNull().alias("hot"), F.posexplode(cells).alias("_copy", "bucket"), *rows.columns)
    out = out.withColumn("row", F.when((F.col("kind") == CHANGE) & (F.col("_copy") > 0), F.lit(-1)).otherwise(F.col("row"))).drop("_copy")  # one copy says whether it is late
    all_cells = large.select("client", "ks", F.explode(each("kv")).alias("i")).select("client", "i", F.explode(each("ks")).alias("j")).select(cell(F.col("i"), F.col("j")).alias("bucket"))
    return out, written(rows.sparkSession.range(buckets).select(F.col("id").alias("bucket")).unionByName(all_cells), "buckets")


def _packed(t: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(t)
    return sink.getvalue().to_pybytes()


def _unpacked(raw: bytes) -> pa.Table:
    return pa.ipc.open_stream(raw).read_all()


def _ints(t: pa.Table, c: str) -> np.ndarray:
    return t.column(c).to_numpy()


def _sorted(versions: pa.Table) -> pa.Table:
    """Versions by client and their order."""
    return versions.take(pa.array(np.lexsort((_ints(versions, "id"), _ints(versions, "seq"), _ints(versions, "at"), _ints(versions, "client"))))) if versions.num_rows else versions


def last_before(versions: pa.Table, client: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The place of each client's last version up to a time in sorted versions, or -1."""
    vc, va = _ints(versions, "client"), _ints(versions, "at")
    n = len(vc)
    order = np.lexsort((np.concatenate([np.zeros(n, np.int8), np.ones(len(client), np.int8)]), np.concatenate([va, at]), np.concatenate([vc, client])))
    last = np.maximum.accumulate(np.where(order < n, order, -1)) if len(order) else order
    out = np.full(len(client), -1)
    asked = order >= n
    out[order[asked] - n] = last[asked]
    return np.where((out >= 0) & (vc[out] == client), out, -1) if n else np.full(len(client), -1)


def counted(versions: pa.Table, day: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(client, day, n) of a page."""
    c, n = np.unique(_ints(versions, "client"), return_counts=True)
    return c, np.full(len(c), day), n


class Pages(StatefulProcessor):
    """A batch's work on a bucket's pages. late: changes below this are late; horizon: H; last: emit all that waits."""

    def __init__(self, batch: int, late: int, horizon: int, last: bool):
        self.batch, self.late, self.horizon, self.last = batch, late, horizon, last

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.versions = handle.getMapState("versions", "day long", "page binary")
        self.waiting = handle.getMapState("waiting", "day long", "page binary")
        self.directory = handle.getValueState("directory", "counts binary, waiting binary")

    def close(self) -> None:
        pass

    def _page(self, day: int) -> pa.Table:
        if day not in self.read:
            got = self.versions.getValue((day,))
            self.read[day] = _unpacked(got[0]) if got else _V.empty_table()
        return self.read[day]

    def _put(self, day: int, page: pa.Table) -> None:
        """Changes a page, and the directory with it."""
        self.read[day] = page
        keep = self.dir[1] != day
        self.dir = tuple(np.concatenate([x[keep], y]) for x, y in zip(self.dir, counted(page, day), strict=True))
        if page.num_rows:
            self.versions.updateValue((day,), (_packed(page),))
        else:
            self.versions.removeKey((day,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        t = pa.concat_tables([pa.table([pa.array(x[f.name], f.type, from_pandas=True) for f in _F], _F) for x in rows])
        held = self.directory.get()
        self.read: dict[int, pa.Table] = {}
        d = _unpacked(held[0]) if held else _D.empty_table()
        self.dir = tuple(_ints(d, c) for c in ("client", "day", "n"))
        days = set(np.frombuffer(held[1], np.int64).tolist()) if held else set()
        kind, at = _ints(t, "kind"), _ints(t, "at")
        of = lambda where, names: t.filter(pa.array(where)).select(names)

        below = (kind == CHANGE) & (at < self.late)
        self._add(of((kind == CHANGE) & ~below & (_ints(t, "client") != NEVER), VERSION))
        due = lambda x: np.full(len(x), self.last) | (x < self.horizon) | (x == NEVER)
        out = [of((kind == SALE) & due(at), _S.names)]
        for day in sorted(x for x in days if self.last or x * DAY < self.horizon):
            page = _unpacked(self.waiting.getValue((day,))[0])
            go = due(_ints(page, "at"))
            out.append(page.filter(pa.array(go)))
            self._wait(day, page.filter(pa.array(~go)), days)
        stay = of((kind == SALE) & ~due(at), _S.names)
        for day in np.unique(_ints(stay, "at") // DAY).tolist():
            old = [_unpacked(self.waiting.getValue((day,))[0])] if day in days else []
            self._wait(day, pa.concat_tables([*old, stay.filter(pa.array(_ints(stay, "at") // DAY == day))]), days)

        emitted = pa.concat_tables(out)
        answers = self._answers(emitted) if emitted.num_rows else None
        if self.horizon > NEVER and not self.last:
            self._drain()
        self.directory.update((_packed(pa.table([pa.array(x, pa.int64()) for x in self.dir], _D)), np.array(sorted(days), np.int64).tobytes()))
        late = of(below & (_ints(t, "row") == NEVER), _S.names)
        if late.num_rows:
            none = np.full(late.num_rows, -1)
            yield self._frame("change", late, _V.empty_table(), _V.empty_table(), none, none, none)
        if answers is not None:
            yield answers

    def _add(self, changes: pa.Table) -> None:
        days = _ints(changes, "at") // DAY
        for day in np.unique(days).tolist():
            self._put(day, _sorted(pa.concat_tables([self._page(day), changes.filter(pa.array(days == day))])))

    def _wait(self, day: int, page: pa.Table, days: set[int]) -> None:
        if page.num_rows:
            self.waiting.updateValue((day,), (_packed(page),))
            days.add(day)
        else:
            self.waiting.removeKey((day,))
            days.discard(day)

    def _named(self, client: np.ndarray, day: np.ndarray) -> list[int]:
        """The pages that hold what the sales of clients on days may need: those of their own days, and the nearest earlier ones."""
        dc, dd, _ = self.dir
        order = np.lexsort((dd, dc))
        dc, dd = dc[order], dd[order]
        page = pa.table([pa.array(dc), pa.array(dd)], ["client", "at"])
        own, earlier = last_before(page, client, day), last_before(page, client, day - 1)
        return sorted({*dd[own[own >= 0]].tolist(), *dd[earlier[earlier >= 0]].tolist()})

    def _answers(self, sales: pa.Table) -> pd.DataFrame:
        client, at = _ints(sales, "client"), _ints(sales, "at")
        named = client != NEVER
        timed = named & (at > NEVER)
        days = [d for d in self._named(client[timed], at[timed] // DAY) if d != BASE]
        rest = _sorted(pa.concat_tables([_V.empty_table(), *(self._page(d) for d in days)]))
        dc, dd, dn = self.dir
        base = self._page(BASE) if (dd == BASE).any() else _V.empty_table()
        found, under = np.full(len(at), -1), np.full(len(at), -1)
        found[timed] = last_before(rest, client[timed], at[timed])
        under[named] = last_before(base, client[named], np.full(int(named.sum()), (1 << 63) - 1))
        above = dd != BASE
        some, place = np.unique(dc[above], return_inverse=True)
        sums = np.append(np.bincount(place, dn[above], len(some)).astype(np.int64), 0)
        at_ = np.searchsorted(some, client)
        has = named & (np.append(some, NEVER)[at_] == client)
        return self._frame("sale", sales, rest, base, found, under, np.where(has, sums[at_], 0))

    def _frame(self, rec: str, rows: pa.Table, rest: pa.Table, base: pa.Table, found: np.ndarray, under: np.ndarray, n: np.ndarray) -> pd.DataFrame:
        hot, sold = rows.column("hot").to_numpy(zero_copy_only=False), _ints(rows, "at")
        of = lambda t, c, at: np.append(t.column(c).to_numpy(zero_copy_only=False), [None if c == "op" else NEVER])[at]  # noqa: E731  what isn't found is the last
        sides = {side: {c: of(t, c, at) for c in _SIDE} for side, t, at in (("rest", rest, found), ("base", base, under))}
        # what no other cell adds to is put together here, and what that took isn't written
        r, b = sides["rest"], sides["base"]
        later = (b["at"] > r["at"]) | (b["at"] == r["at"]) & ((b["seq"] > r["seq"]) | (b["seq"] == r["seq"]) & (b["id"] > r["id"]))
        own = ~hot & (under >= 0) & (b["at"] <= sold) & later
        n = n + (~hot & (under >= 0))
        out = {"rec": rec, "row": np.where(hot, _ints(rows, "row"), 0), "id": _ints(rows, "id"), "sold": np.where(hot, sold, 0), "hot": hot, "batch": self.batch, "n_rest": n}
        out |= {f"rest_{c}": np.where(own, b[c], r[c]) for c in _SIDE} | {f"base_{c}": np.where(hot, b[c], None if c == "op" else NEVER) for c in _SIDE}
        for c in ("at", "seq"):
            out[f"rest_{c}"] = np.where(hot | (out[f"rest_{c}"] == NEVER), out[f"rest_{c}"], 0)
        return pd.DataFrame(out)

    def _drain(self) -> None:
        """Of each client's versions up to H the last goes into the base page; the pages before H are dropped."""
        days = [d for d in np.unique(self.dir[1]).tolist() if d != BASE and d * DAY <= self.horizon]
        if not days:
            return
        every = _sorted(pa.concat_tables([self._page(BASE), *(self._page(d) for d in days)]))
        low = _ints(every, "at") <= self.horizon
        client = _ints(every, "client")
        ends = np.append(client[1:] != client[:-1], True) if len(client) else low
        goes_on = np.append(low[1:], False) & ~ends if len(client) else low
        self._put(BASE, every.filter(pa.array(low & ~goes_on)))
        for d in days:
            page = self._page(d)
            self._put(d, page.filter(pa.array(_ints(page, "at") > self.horizon)))


_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # many small stores: what they hold in memory together is bounded, files take the room of what is in them, and a batch uploads its changes only
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def enriched(sales: DataFrame, changes: DataFrame, bucket: int = BUCKET, hot: int = HOT) -> DataFrame:
    """rec ('sale', or 'change' for a late one), id, batch (of emission or lateness) and, for sales, n_held (unpruned versions of the client then),
    change_id, balance_cents and op of the version that is valid at the sale."""
    spark = sales.sparkSession
    prepared(spark)
    rows = staged(sales, changes)
    marks = horizons(rows)
    feed, buckets = dealt(rows, bucket, hot)
    root = new_path(spark, "enrichment")
    source, sink, checkpoint = (f"{root}/{x}" for x in ("feed", "answers", "checkpoint"))
    names = [x.split()[0] for x in FEED.split(", ")]
    tick = buckets.select("bucket", F.lit(TICK).alias("kind"), F.lit(False).alias("hot"), *(F.lit(None if c == "op" else NEVER).cast("string" if c == "op" else "long").alias(c) for c in names[3:]))
    before = {k: spark.conf.get(k, None) for k in _STATE}
    for k, v in _STATE.items():
        spark.conf.set(k, v)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the driver's own Python worker has no files that were sent
    try:
        for b, late, horizon in [*marks, (BATCHES, NEVER, NEVER)]:
            new = tick if b == BATCHES else feed.filter(F.col("batch") == b).select(*names).unionByName(tick)
            new.write.mode("append").parquet(source)
            stream = spark.readStream.schema(FEED).parquet(source)
            answers = stream.groupBy("bucket").transformWithStateInPandas(Pages(b, late, horizon, b == BATCHES), ANSWER, "Append", "None")
            query = answers.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
            query.awaitTermination()
            remove(spark, source)  # what a batch was fed is in the checkpoint now
    finally:
        cloudpickle.unregister_pickle_by_value(sys.modules[__name__])
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    out = combined(spark.read.schema(ANSWER).parquet(sink))
    discard(rows, buckets)
    return out


def combined(answers: DataFrame) -> DataFrame:
    """The answers of all cells of a sale put together: of the cells' bases only the last is unpruned."""
    side = lambda s: F.when(F.col(f"{s}_at") != NEVER, F.struct(*(F.col(f"{s}_{c}").alias(c) for c in _SIDE))).alias(s)
    rows = answers.select("rec", "row", "id", "sold", "batch", "n_rest", side("rest"), side("base"), "hot")
    many = rows.filter(F.col("hot") & (F.col("rec") == "sale")).groupBy("rec", "row", "id", "sold", "batch").agg(F.sum("n_rest").alias("n_rest"), F.max("rest").alias("rest"), F.max("base").alias("base"))
    out = rows.filter(~F.col("hot") | (F.col("rec") == "change")).drop("hot").unionByName(many)
    sale = lambda c: F.when(F.col("rec") == "sale", c)
    none = lambda c: F.nullif(c, F.lit(NEVER))
    v = F.greatest("rest", F.when(F.col("base.at") <= F.col("sold"), F.col("base")))
    out = out.select("rec", none(F.col("id")).alias("id"), "batch", sale(F.col("n_rest") + F.col("base").isNotNull().cast("long")).alias("n_held"), v.alias("v"))
    return out.select("rec", "id", "batch", "n_held", none(F.col("v.id")).alias("change_id"), none(F.col("v.cents")).alias("balance_cents"), F.col("v.op").alias("op"))
