"""What a stream has done (R2, R7): a record per micro-batch, and draining."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

RECORD_TYPE = ("query string, batch bigint, started timestamp, input_rows bigint, files_end bigint, "
               "duration_ms bigint, handler_ms bigint, source_ms bigint")


class Progress(StreamingQueryListener):
    """Records every finished micro-batch of the session's queries.

    ``with Progress(spark) as p: ...`` registers and removes it.  The record grows
    by one small row a batch; ``keep`` bounds it for queries that run on (the oldest
    rows go, ``totals`` keeps their sums)."""

    def __init__(self, spark: SparkSession, keep: int = 100_000):
        self.spark, self.keep = spark, keep
        self._rows: list[tuple] = []
        self._ended: dict[str, str | None] = {}
        self._seen: dict[str, int] = {}
        self.totals: dict[str, tuple[int, int]] = {}
        self._changed = threading.Condition()

    def __enter__(self) -> "Progress":
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    # -- the listener's calls -------------------------------------------------
    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._seen.setdefault(str(event.runId), -1)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        took = dict(p.durationMs)
        with self._changed:
            run = str(p.runId)
            if "addBatch" in took:  # triggers that found nothing report too
                self._rows.append((str(p.id), p.batchId, p.timestamp, p.numInputRows, _end_offset(p), p.batchDuration,
                                   took.get("addBatch", 0), took.get("latestOffset", 0) + took.get("getBatch", 0)))
                batches, rows = self.totals.get(str(p.id), (0, 0))
                self.totals[str(p.id)] = (batches + 1, rows + p.numInputRows)
                del self._rows[:-self.keep]
            self._seen[run] = max(self._seen.get(run, -1), p.batchId)
            self._changed.notify_all()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended[str(event.runId)] = event.exception
            self._changed.notify_all()

    # -- reading ----------------------------------------------------------------
    def wait(self, query: StreamingQuery, timeout: float = 60.0) -> None:
        """Until the record has the last batch that ``query`` reports: listener
        calls come after the batch, in their own thread."""
        last = query.lastProgress
        want = -1 if last is None else last.batchId
        with self._changed:
            if not self._changed.wait_for(lambda: self._seen.get(str(query.runId), -1) >= want, timeout):
                raise TimeoutError(f"batch {want} of query {query.id} was not recorded in {timeout} s")

    def record(self, query: str | None = None) -> DataFrame:
        """The record as a frame: a row per micro-batch that ran the handler."""
        with self._changed:
            rows = [r for r in self._rows if query is None or r[0] == str(query)]
        text = "query string, batch bigint, started string" + RECORD_TYPE.split("started timestamp", 1)[1]
        return self.spark.createDataFrame(rows, text).selectExpr(
            *[f"CAST({c} AS TIMESTAMP) AS {c}" if c == "started" else c for c in text.replace(",", "").split()[::2]])


def _end_offset(progress) -> int | None:
    """The file source's log offset after the batch; null for other sources."""
    import json
    try:
        return int(json.loads(progress.sources[0].endOffset)["logOffset"])
    except (KeyError, TypeError, ValueError, IndexError):
        return None


def drain(query: StreamingQuery, progress: Progress | None = None, timeout: float = 600.0) -> None:
    """Returns when ``query`` has processed all that its sources held when this
    was called (their latest offsets), and, with ``progress``, when that is recorded;
    raises the query's own failure.  No fixed waits: a query whose handler is
    still at work is waited for.  ``timeout`` (seconds) ends the waiting, not the query."""
    failed: list[BaseException] = []

    def wait():
        try:
            query.processAllAvailable()
        except BaseException as e:  # noqa: BLE001 - handed to the caller's thread
            failed.append(e)

    t = threading.Thread(target=wait, daemon=True)
    t.start()
    t.join(timeout)
    if t.is_alive():
        raise TimeoutError(f"query {query.id} has not drained in {timeout} s")
    if failed:
        raise failed[0]
    if progress is not None:
        progress.wait(query)
