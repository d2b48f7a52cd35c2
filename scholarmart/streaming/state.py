"""Limits and revocation as keyed state with expiry: exact verdicts, and nothing of earlier batches is read again.

**Rate limit** (``run_limits``). The state of a user is one number for each open window, the requests counted so far; a timer takes it away when the
watermark has passed the window's end. Within a batch the first requests by time and id are accepted, as long as the number allows.

**Revocation** (``run_verdicts``). Requests and marks come as one stream, keyed by token or user. A key's state holds the requests that wait for the watermark and the marks that
may still hit one. When the watermark has passed a request, all marks up to its time are there (rows that come later than the delay are late and
dropped), so its verdict is final: rejected if a mark was set at or before it, lives on, and covers it. A mark with a time ``marca``
covers tokens issued before that; a mark without one covers every request of its key. Every request comes out once, with
its flag. Marks leave the state once they and the delay are over, so the state is bounded by what the delay and the life of a mark hold.

A key with very many requests is spread by ``salts``: its requests are dealt by their id and its few marks go to each part. State is kept in
RocksDB below the checkpoint, so it survives lost executors and restarts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from scholarmart.operators.access import window_start
from scholarmart.streaming import jobs

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: stands for "issued whenever"
ALWAYS = (1 << 63) - 1


class Verdicts(StatefulProcessor):
    """Times are microseconds; timers are milliseconds."""

    def __init__(self, delay_seconds: int):
        self.delay = delay_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "pedido long, momento long, emitido long")
        self.marks = handle.getListState("marks", "desde long, hasta long, marca long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for batch in rows:
            for r in batch.itertuples(index=False):
                if r.es_marca:
                    self.marks.appendValue((int(r.momento), int(r.hasta), int(r.marca)))
                    due = int(r.hasta) + self.delay
                else:
                    self.waiting.appendValue((int(r.pedido), int(r.momento), int(r.emitido)))
                    due = int(r.momento)
                first = due if first is None else min(first, due)
        self._wake(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        marks, waiting = list(self.marks.get()), list(self.waiting.get())
        done = [r for r in waiting if r[1] < now]
        if done:
            self._keep(self.waiting, waiting := [r for r in waiting if r[1] >= now])
            hit = [any(a <= at < b and issued < mark for a, b, mark in marks) for _, at, issued in done]
            yield pd.DataFrame({"pedido": [r[0] for r in done], "momento": [r[1] for r in done], "rechazado": hit})
        live = [m for m in marks if m[1] + self.delay >= now]
        if len(live) < len(marks):
            self._keep(self.marks, live)
        self._wake(min([r[1] for r in waiting] + [m[1] + self.delay for m in live], default=None))

    def _wake(self, due: int | None) -> None:
        if due is not None:
            self.handle.registerTimer(due // 1000 + 1)

    @staticmethod
    def _keep(state, rows: list) -> None:
        if rows:
            state.put([tuple(r) for r in rows])
        else:
            state.clear()

    def close(self) -> None: ...


def requests_and_marks(
    requests: DataFrame, marks: DataFrame, key: str, pedido: str = "event_id", ts: str = "ts", issued: str | None = None, until: str = "expires_at",
    mark: str | None = None, salts: int = 1,
) -> DataFrame:
    """One stream of both: requests with an id and, for mass revocation, the time their token was issued; marks with their end.

    Times without a zone are read as UTC.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    nothing: Column = F.lit(0).cast("long")
    asked = requests.select(
        F.col(key).alias("clave"), F.pmod(F.xxhash64(pedido), F.lit(salts)).cast("int").alias("parte"), F.col(ts).cast("timestamp").alias("ts"), F.lit(False).alias("es_marca"),
        F.col(pedido).cast("long").alias("pedido"), micros(ts).alias("momento"), (micros(issued) if issued else nothing).alias("emitido"), nothing.alias("hasta"), nothing.alias("marca"),
    )
    parts = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("parte")
    set_ = marks.select(
        F.col(key).alias("clave"), parts, F.col(ts).cast("timestamp").alias("ts"), F.lit(True).alias("es_marca"), nothing.alias("pedido"), micros(ts).alias("momento"),
        nothing.alias("emitido"), micros(until).alias("hasta"), (micros(mark) if mark else F.lit(ALWAYS)).alias("marca"),
    )
    return asked.unionByName(set_)


def verdicts(rows: DataFrame, delay_seconds: int) -> DataFrame:
    """``pedido, momento, rechazado`` of every request that the watermark has passed, from ``requests_and_marks``."""
    keyed = rows.withWatermark("ts", f"{delay_seconds} seconds").groupBy("clave", "parte")
    out = keyed.transformWithStateInPandas(Verdicts(delay_seconds), "pedido long, momento long, rechazado boolean", "Append", "eventTime")
    return out.select("pedido", F.timestamp_micros("momento").alias("momento"), "rechazado")


class Limits(StatefulProcessor):
    """The numbers of a user's open windows in one value, so that a user costs one call a batch, however many windows; rows of a batch are ordered by time and id.

    The rows that one user sends in one batch are ordered in one task, three numbers each; the size of a batch bounds them
    (``per_trigger`` of ``jobs.event_stream``). ``jobs.limit_verdicts`` spreads such rows.
    """

    def __init__(self, limit: int, seconds: int):
        self.limit, self.seconds = limit, seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.used = handle.getValueState("used", "ventanas array<long>, n array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        used = self._open()
        batch = pd.concat(list(rows), ignore_index=True)
        windows = batch["ventana"].to_numpy()
        order = np.lexsort((batch["pedido"].to_numpy(), batch["momento"].to_numpy(), windows))
        sorted_ = windows[order]
        begun, first, n = np.unique(sorted_, return_index=True, return_counts=True)
        before = np.array([used.get(int(w), 0) for w in begun], np.int64)
        accepted = np.zeros(len(batch), bool)
        accepted[order] = np.arange(len(batch)) - np.repeat(first - before, n) < self.limit
        earliest = min(used, default=None)
        used.update(zip(begun.astype(np.int64).tolist(), (before + n).tolist()))
        self._keep(used, min(used) != earliest)
        yield pd.DataFrame({"clave": batch["clave"], "pedido": batch["pedido"], "ventana": batch["ventana"], "aceptado": accepted})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        self._keep({w: n for w, n in self._open().items() if (w + self.seconds) * 1000 > now}, True)
        return iter(())

    def _open(self) -> dict[int, int]:
        return dict(zip(*self.used.get())) if self.used.exists() else {}

    def _keep(self, used: dict[int, int], wake: bool) -> None:
        """One timer for a user, at the end of the earliest window."""
        if not used:
            self.used.clear()
            return
        self.used.update((list(used), list(used.values())))
        if wake:
            self.handle.registerTimer((min(used) + self.seconds) * 1000)

    def close(self) -> None: ...


def limits(requests: DataFrame, limit: int, seconds: int, delay_seconds: int, user: str = "user_id", ts: str = "ts", pedido: str = "event_id") -> DataFrame:
    """``clave, pedido, ventana, aceptado`` of every request, as soon as it comes; three numbers of each travel to the state."""
    rows = requests.select(
        F.col(user).cast("long").alias("clave"), F.col(pedido).cast("long").alias("pedido"), F.col(ts).cast("timestamp").alias("ts"),
        window_start(ts, seconds).cast("long").alias("ventana"), F.unix_micros(F.col(ts).cast("timestamp")).alias("momento"),
    )
    keyed = rows.withWatermark("ts", f"{delay_seconds} seconds").groupBy("clave")
    return keyed.transformWithStateInPandas(Limits(limit, seconds), "clave long, pedido long, ventana long, aceptado boolean", "Append", "eventTime")


def run_limits(
    requests: DataFrame, path: str, checkpoint: str, limit: int, seconds: int = 60, delay_seconds: int = 3600, user: str = "user_id", ts: str = "ts", pedido: str = "event_id"
) -> StreamingQuery:
    return _with_state(limits(requests, limit, seconds, delay_seconds, user, ts, pedido), path, checkpoint)


def run_verdicts(rows: DataFrame, delay_seconds: int, path: str, checkpoint: str) -> StreamingQuery:
    return _with_state(verdicts(rows, delay_seconds), path, checkpoint)


def _with_state(out: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there and stop; a later call with the same checkpoint goes on with the state."""
    spark = out.sparkSession
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)  # keyed state with timers needs it; a query keeps the setting it was started with
    try:
        return jobs.run(out, path, checkpoint)
    finally:
        spark.conf.set(PROVIDER, before)
