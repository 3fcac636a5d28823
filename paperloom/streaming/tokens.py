"""Answers of a model as their tokens arrive, a request at a time.

The stream's rows are pieces (request_id, seq, content, add_kw, resp_meta), in
any order and any micro-batch. The state of a request is its pieces by place,
and the last reason and the last metadata with their place; a piece that comes
again replaces itself. Every micro-batch puts out the requests that got pieces,
as far as they are; when no piece came for idle_ms, a request is put out once
more as done and its state goes. The result for a request equals
operators.stats.joined_stream over all of its pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

JOINED = "request_id STRING, text STRING, n_chars LONG, last_reason STRING, last_meta STRING, done BOOLEAN"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Requests(StatefulProcessor):
    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pieces = handle.getMapState("pieces", "seq INT", "content STRING")
        self.reason = handle.getValueState("reason", "seq INT, said STRING")
        self.meta = handle.getValueState("meta", "seq INT, said STRING")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        for r in rows:
            if r.content:
                self.pieces.updateValue((r.seq,), (r.content,))
            self._later(self.reason, r.seq, r.add_kw or r.resp_meta)
            self._later(self.meta, r.seq, r.resp_meta)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield self._joined(key, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        row = self._joined(key, True)
        self.pieces.clear()
        self.reason.clear()
        self.meta.clear()
        yield row

    def _later(self, state, seq: int, said: str | None) -> None:
        """What the piece of the greatest place that says something says."""
        if said and (not state.exists() or state.get()[0] <= seq):
            state.update((seq, said))

    def _joined(self, key, done: bool) -> Row:
        text = "".join(content for _, content in sorted((k[0], v[0]) for k, v in self.pieces.iterator()))
        said = [state.get()[1] if state.exists() else None for state in (self.reason, self.meta)]
        return Row(request_id=key[0], text=text, n_chars=len(text), last_reason=said[0], last_meta=said[1], done=done)

    def close(self) -> None:
        pass


def joined(tokens: DataFrame, idle_ms: int = 60_000) -> DataFrame:
    """The requests of a stream of pieces, for output mode update. Sets the session's state store to the one that this needs."""
    spark: SparkSession = tokens.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    pieces = tokens.select("request_id", "seq", "content", "add_kw", "resp_meta").filter("request_id IS NOT NULL AND seq IS NOT NULL")
    return pieces.groupBy("request_id").transformWithState(Requests(idle_ms), JOINED, "Update", "ProcessingTime")
