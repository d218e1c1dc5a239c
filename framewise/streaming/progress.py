"""Rates and latencies of running streams, one row per micro-batch.

A listener takes every progress report of the queries it watches and appends it as one
JSON file below a folder: batch id, rows in, rates, the seconds of each phase, and
the counters that the query observes in passing.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS_SCHEMA = ("query string, run_id string, batch_id long, batch_ts string, rows long, input_rate double, process_rate double, "
                   "duration_s double, phases map<string,long>, observed map<string,map<string,long>>")


class ProgressLog(StreamingQueryListener):
    """Writes what the watched queries (by name; all when none is given) report to ``path``."""

    def __init__(self, spark: SparkSession, path: str, names=()):
        self.spark, self.path, self.names = spark, path.rstrip("/"), set(names)
        self.written: dict[str, int] = {}

    def settle(self, queries, seconds: float = 20.0) -> None:
        """Wait until the last batch of each (stopped) query is written; reports come a little after their batch."""
        end = time.monotonic() + seconds
        for q in queries:
            last = max((p["batchId"] for p in q.recentProgress if p["numInputRows"]), default=-1)
            while self.written.get(q.name, -1) < last and time.monotonic() < end:
                time.sleep(0.1)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        if self.names and p.name not in self.names:
            return
        if not p.numInputRows and not p.observedMetrics:
            return  # the trigger found nothing
        phases = {k: int(v) for k, v in p.durationMs.items()}
        observed = {k: {c: int(v) for c, v in r.asDict().items() if v is not None} for k, r in p.observedMetrics.items()}
        row = {"query": p.name, "run_id": str(p.runId), "batch_id": p.batchId, "batch_ts": p.timestamp, "rows": p.numInputRows,
               "input_rate": p.inputRowsPerSecond, "process_rate": p.processedRowsPerSecond,
               "duration_s": phases.get("triggerExecution", 0) / 1000, "phases": phases, "observed": observed}
        # a batch that is reported again replaces its row
        line = self.spark.createDataFrame([(json.dumps(row),)], "value string")
        line.coalesce(1).write.mode("overwrite").text(f"{self.path}/query={p.name}/run={p.runId}/batch_id={p.batchId}")
        self.written[p.name] = max(p.batchId, self.written.get(p.name, -1))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a :class:`ProgressLog`; a batch that ran again after a restart counts once, by its last run."""
    rows = spark.read.text(f"{path.rstrip('/')}/*/*/*").select(F.from_json("value", PROGRESS_SCHEMA).alias("p")).select("p.*")
    last = rows.groupBy("query", "batch_id").agg(F.max_by(F.struct(*rows.columns), "batch_ts").alias("p"))
    return last.select("p.*")


def stream_latency(progress: DataFrame) -> DataFrame:
    """Per query: micro-batches, rows, seconds and rows a second over all of them, least, mean and greatest seconds of one."""
    return progress.groupBy("query").agg(
        F.count(F.lit(1)).alias("n_batches"), F.sum("rows").alias("n_rows"), F.sum("duration_s").alias("total_s"),
        F.try_divide(F.sum("rows"), F.sum("duration_s")).alias("rows_per_s"), F.min("duration_s").alias("min_s"),
        F.avg("duration_s").alias("avg_s"), F.max("duration_s").alias("max_s"))
