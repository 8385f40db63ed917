"""Gate counters over documents as they arrive: issues are capped before they are counted (an addition).

A key is a run.  Its state is the number of issues admitted so far (a value), the count of each
code (a map) and a timer that closes a run which has gone quiet.  State grows with the codes of
a run, not with its documents.  The stream needs the RocksDB state store.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
#: What the stream yields: the counts of a run's codes as they stand, and whether the run is closed.
COUNTS = "run string, code string, n long, admitted long, full boolean, closed boolean"


class CappedCounts(StatefulProcessor):
    """Admits the first ``limit`` issues of a run, in order of arrival and of `ord` within a batch, and counts their codes."""

    def __init__(self, limit: int, quiet_ms: int | None = None):
        self.limit, self.quiet_ms = limit, quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.admitted = handle.getValueState("admitted", "n long")
        self.counts = handle.getMapState("counts", "code string", "n long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        admitted = self.admitted.get()[0] if self.admitted.exists() else 0
        taken = batch.sort_values("ord", kind="stable").head(max(0, self.limit - admitted))
        changed = taken.groupby("code").size()
        for code, n in changed.items():
            old = self.counts.getValue((code,))[0] if self.counts.containsKey((code,)) else 0
            self.counts.updateValue((code,), (old + int(n),))
        self.admitted.update((admitted + len(taken),))
        if self.quiet_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.quiet_ms)
        yield self._rows(key[0], admitted + len(taken), [str(c) for c in changed.index], False)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """A quiet run is closed: all its counts once more, then its state goes."""
        codes = [k[0] for k in self.counts.keys()]
        yield self._rows(key[0], self.admitted.get()[0], codes, True)
        self.admitted.clear()
        self.counts.clear()

    def _rows(self, run: str, admitted: int, codes: list[str], closed: bool) -> pd.DataFrame:
        values = [self.counts.getValue((c,))[0] for c in codes]
        whole = {"run": [run] * len(codes), "code": codes, "n": values, "admitted": [admitted] * len(codes), "full": [admitted >= self.limit] * len(codes), "closed": [closed] * len(codes)}
        return pd.DataFrame(whole).astype({"run": object, "code": object, "n": "int64", "admitted": "int64", "full": bool, "closed": bool})

    def close(self) -> None:
        pass


def capped_counts(issues: DataFrame, limit: int, quiet_ms: int | None = None) -> DataFrame:
    """Running counts (`COUNTS`) of a stream of issues (run, code, ord): the last row of a run and code holds.

    The first ``limit`` issues of a run count, as `operators.quality.first_issues` takes them of a table that
    has arrived in order.  With ``quiet_ms``, a run without issues for so long is closed.
    """
    issues.sparkSession.conf.set(*STORE)
    held = issues.select("run", "code", "ord").filter("code IS NOT NULL").groupBy("run")
    return held.transformWithStateInPandas(CappedCounts(limit, quiet_ms), COUNTS, outputMode="Update", timeMode="none" if quiet_ms is None else "ProcessingTime")
