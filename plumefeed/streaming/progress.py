"""Progress of running streams as rows."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = (
    "batch_id bigint, input_rows bigint, rows_per_second double, "
    "accepted bigint, rejected bigint, late_rows bigint, state_rows bigint"
)


def progress_row(progress: dict) -> tuple:
    """One row of ``PROGRESS`` from a progress report."""
    observed = progress.get("observedMetrics", {}).get("clean") or {}
    states = progress.get("stateOperators", [])
    return (
        progress["batchId"],
        progress["numInputRows"],
        float(progress.get("processedRowsPerSecond") or 0.0),
        _metric(observed, "accepted"),
        _metric(observed, "rejected"),
        sum(s.get("numRowsDroppedByWatermark", 0) for s in states),
        sum(s.get("numRowsTotal", 0) for s in states),
    )


def _metric(observed, name: str) -> int:
    values = observed if isinstance(observed, dict) else observed.asDict()
    return int(values.get(name, 0))


def progress_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The recent micro-batches of a query: Spark keeps the last 100, see :class:`ProgressLog`."""
    return spark.createDataFrame([progress_row(p) for p in query.recentProgress], PROGRESS)


class ProgressListener(StreamingQueryListener):
    """Hands every finished micro-batch to ``report``; register with ``spark.streams``."""

    def __init__(self, report: Callable[[tuple], None]):
        self.report = report

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.report(progress_row(json.loads(event.progress.json)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


class ProgressLog(ProgressListener):
    """Writes every finished micro-batch of all queries to a folder, ``flush_every`` at a time.

    Nothing is forgotten however long a query runs, and the driver holds a few rows only.
    """

    def __init__(self, spark: SparkSession, path: str, flush_every: int = 100):
        super().__init__(self._keep)
        self.spark, self.path, self.flush_every = spark, path, flush_every
        self._lines: list[str] = []
        self._files = 0
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()
        self._now = ""

    def onQueryProgress(self, event) -> None:
        with self._lock:
            self._now = str(event.progress.runId)
            super().onQueryProgress(event)
            if len(self._lines) >= self.flush_every:
                self._flush()

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._flush()
        self._end(str(event.runId)).set()

    def _end(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def _keep(self, row: tuple) -> None:
        names = [c.split()[0] for c in PROGRESS.split(", ")]
        self._lines.append(json.dumps({"run_id": self._now} | dict(zip(names, row))))

    def _flush(self) -> None:
        if not self._lines:
            return
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batches-{self._files:08d}.json")
        out = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(place, True)
        out.write(bytearray("\n".join(self._lines) + "\n", "utf-8"))
        out.close()
        self._lines, self._files = [], self._files + 1

    def batches(self, query: StreamingQuery, timeout: float = 120.0) -> DataFrame:
        """All micro-batches of a query that has ended, once its last report is written."""
        run_id = str(query.runId)
        if not self._end(run_id).wait(timeout):
            raise TimeoutError(f"no report of the end of query {run_id}")
        if not self._files:
            return self.spark.createDataFrame([], PROGRESS)
        rows = self.spark.read.schema(f"run_id string, {PROGRESS}").json(self.path)
        return rows.where(F.col("run_id") == run_id).drop("run_id")


def run_logged(spark: SparkSession, path: str, run: Callable[[], StreamingQuery]) -> DataFrame:
    """Run a query to its end and return all its micro-batches; ``path`` is the log's folder."""
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    try:
        return log.batches(run())
    finally:
        spark.streams.removeListener(log)
