"""Batch sizes and observed counts from a running query (O36, O14 on streams)."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tarmac.functions.cleaning import bad_flag_name


def progress(query: StreamingQuery) -> list[dict]:
    """(batch id, input rows, observed metrics) for each recent micro-batch."""
    out = []
    for p in query.recentProgress:
        out.append({
            "batchId": p.batchId,
            "numInputRows": p.numInputRows,
            "observed": {k: v.asDict() for k, v in (p.observedMetrics or {}).items()},
        })
    return out


BATCHES = "query string, batch_id long, input_rows long, observed map<string,long>"


class BatchLog(StreamingQueryListener):
    """Writes a row per micro-batch of the named query to a table, however many there are.

    Spark itself remembers the newest hundred batches.  Rows are held for at
    most ``every`` batches; a batch that runs again reports the same rows
    again, and an empty trigger reports the coming batch with none, so the
    reader takes each batch's largest report.
    """

    def __init__(self, spark: SparkSession, path: str, query: str, every: int = 64):
        self._spark, self._path, self._query, self._every = spark, path, query, every
        self._held: list[tuple] = []
        self._runs: set[str] = set()
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self._query:
            self._runs.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self._query:
            return
        observed = {f"{name}.{k}": int(v) for name, row in (p.observedMetrics or {}).items() for k, v in row.asDict().items()}
        self._held.append((self._query, p.batchId, p.numInputRows, observed))
        if len(self._held) >= self._every:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) in self._runs:
            self.flush()
            self.ended.set()

    def flush(self) -> None:
        if self._held:
            rows, self._held = self._held, []
            self._spark.createDataFrame(rows, BATCHES).coalesce(1).write.mode("append").parquet(self._path)


def read_batch_log(spark: SparkSession, path: str) -> DataFrame:
    """(query, batch_id, input_rows, observed), a row per micro-batch that read anything."""
    rows = spark.read.schema(BATCHES).parquet(path)
    return (rows.filter("input_rows > 0").groupBy("query", "batch_id")
            .agg(F.max("input_rows").alias("input_rows"), F.max_by("observed", "input_rows").alias("observed")))


def observe_bad_delays(src: DataFrame, name: str = "bad_delays") -> DataFrame:
    """Attach per-batch counts of unparseable delays to a streaming frame."""
    return src.observe(
        name,
        F.count_if(F.col(bad_flag_name("ArrDelay"))).alias("bad_arr_delay"),
        F.count_if(F.col(bad_flag_name("DepDelay"))).alias("bad_dep_delay"),
    )
