"""The state log as a stream: every change is checked against the key's state, which Spark keeps and restores."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from docloom.operators.states import RECHECK_MINUTES, is_allowed

OUT = "chunk_id string, seq long, before string, state string, allowed boolean"


def checked_stream(changes: DataFrame) -> DataFrame:
    """Changes (chunk_id string, seq long, state string), each with the state before and whether it was allowed.

    A key's changes are taken in order of seq within a micro-batch; a forbidden one doesn't change the state.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
        before = kept.get[0] if kept.exists else None
        rows = []
        for row in pd.concat(list(batches)).sort_values(["seq", "state"]).itertuples():
            ok = is_allowed(before, row.state)
            rows.append((key[0], row.seq, before, row.state, ok))
            before = row.state if ok else before
        if before is not None:
            kept.update((before,))
        yield pd.DataFrame(rows, columns=["chunk_id", "seq", "before", "state", "allowed"])

    return changes.groupBy("chunk_id").applyInPandasWithState(step, OUT, "state string", "append", GroupStateTimeout.NoTimeout)


RESUMED = "chunk_id string, seq long, before string, state string, allowed boolean, resume_at timestamp"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Resuming(StatefulProcessor):
    """Keeps each key's state and, while a limit pauses it, a timer that makes it ready again."""

    def __init__(self, recheck_seconds: float):
        self.recheck_ms = int(1000 * recheck_seconds)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("state", "state string, resume_ms long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        before, resume = self.kept.get() if self.kept.exists() else (None, None)
        now, out = timerValues.getCurrentProcessingTimeInMs(), []
        for row in pd.concat(list(rows)).sort_values(["seq", "state"]).itertuples():
            ok = is_allowed(before, row.state)
            if ok:
                if resume is not None:  # whatever is taken ends a pause
                    self.handle.deleteTimer(resume)
                    resume = None
                if row.state == "PAUSED_LIMIT":
                    stated = None if pd.isna(row.reset_at) else int(row.reset_at.timestamp() * 1000)
                    resume = stated if stated is not None and stated > now else now + self.recheck_ms
                    self.handle.registerTimer(resume)
            out.append((key[0], row.seq, before, row.state, ok, pd.Timestamp(resume, unit="ms") if ok and resume is not None else pd.NaT))
            before = row.state if ok else before
        if before is not None:
            self.kept.update((before, resume))
        yield self._rows(out)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        before, _ = self.kept.get()
        self.kept.update(("CHUNK_READY", None))
        yield self._rows([(key[0], None, before, "CHUNK_READY", True, pd.NaT)])

    def _rows(self, out: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame(out, columns=["chunk_id", "seq", "before", "state", "allowed", "resume_at"])
        return frame.astype({"seq": "Int64", "resume_at": "datetime64[ns]"})

    def close(self) -> None:
        pass


def resuming_stream(changes: DataFrame, recheck_seconds: float = 60.0 * RECHECK_MINUTES) -> DataFrame:
    """checked_stream() of changes (chunk_id, seq, state, reset_at timestamp) in which a pause ends by itself.

    A step to PAUSED_LIMIT sets a timer at reset_at if that lies ahead, else `recheck_seconds` from now (resume_at);
    when processing time reaches it, the key comes out once more, without a seq, as a step from PAUSED_LIMIT to
    CHUNK_READY. Any other step taken before that ends the pause and its timer. Timers are state: they outlive a restart of the query. A key's changes of one
    micro-batch are sorted in one task, so bound the micro-batches at the source. Output mode is update; the session's
    state store is set to RocksDB, which timers need.
    """
    conf = changes.sparkSession.conf
    name = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in conf.get(name):
        conf.set(name, ROCKSDB)
    slim = changes.select("chunk_id", "seq", "state", "reset_at")
    return slim.groupBy("chunk_id").transformWithStateInPandas(Resuming(recheck_seconds), RESUMED, "Update", "ProcessingTime")
