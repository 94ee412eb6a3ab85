"""Running versions of the questions.

Each builder returns a ``StreamJob``: a streaming aggregate, its output
mode, and what to do with each micro-batch before it is written to a keyed
table (``tarmac.sinks.tables``).  State has no expiry and no event time,
as in the reference: every row counts whenever it arrives.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarmac.functions.cleaning import bad_flag_name, once, valid_delay
from tarmac.functions.flight import NOON, airport_endpoints, dep_hour, flight_date, padded_dep_time
from tarmac.operators.best import BEST_COLUMNS, BEST_FLIGHT_YEAR
from tarmac.operators.metrics import mean_of
from tarmac.operators.ranking import TOP_N, rank_within_airport
from tarmac.schema import DELAY_COLUMNS
from tarmac.sinks.tables import compact_in_place, expire_batches, snapshot_batch, staged, upsert_batch
from tarmac.streaming.source import accepted, lean_records, parse_records, rejected

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"


@dataclass
class StreamJob:
    """A streaming aggregate plus how its batches become table rows."""

    frame: DataFrame
    mode: str  # "complete", "update", or "append" (every batch stays)
    keys: list[str]
    post: Callable[[DataFrame], DataFrame] = lambda df: df
    large_state: bool = False
    retain: int | None = None  # complete mode: keep only this many finished batches
    snapshot_prefix: str | None = None  # O40: also write each batch as CSV text here
    compact_every: int | None = None  # update mode: fold into a base every N batches

    def output_schema(self):
        """Schema of the table rows (after ``post``), known before any batch runs."""
        spark = self.frame.sparkSession
        return self.post(spark.createDataFrame([], self.frame.schema)).schema

    def write_batch(self, path: str) -> Callable[[DataFrame, int], None]:
        post, retain, mode, prefix = self.post, self.retain, self.mode, self.snapshot_prefix
        every, keys = self.compact_every, self.keys

        def run(batch: DataFrame, batch_id: int) -> None:
            rows = post(batch)
            if prefix:  # written twice: compute the batch once (memory, then disk)
                rows = rows.persist()
            try:
                upsert_batch(rows, batch_id, path)
                if prefix:
                    snapshot_batch(rows, batch_id, prefix)
            finally:
                if prefix:
                    rows.unpersist()
            if retain and mode == "complete":
                expire_batches(batch.sparkSession, path, retain)
            if every and mode == "update" and (batch_id + 1) % every == 0:
                compact_in_place(batch.sparkSession, path, keys)

        return run

    def start(self, path: str, checkpoint: str, trigger: dict | None = None,
              name: str | None = None, state_partitions: int | None = None) -> StreamingQuery:
        """Start writing to the keyed table at ``path`` (O34 checkpoint, O35 trigger).

        ``trigger`` defaults to one-second micro-batches; tests pass
        ``{"availableNow": True}``.  Large-state jobs run on the RocksDB
        state store, which spills to local disk instead of the JVM heap.
        ``state_partitions`` fixes the number of state-store partitions of a
        new checkpoint (a restarted query keeps the number it was started
        with); by default the session's ``spark.sql.shuffle.partitions``.
        The stream copies the session settings when it starts, so the
        temporary settings below do not leak into the session.
        """
        spark = self.frame.sparkSession
        w = (
            self.frame.writeStream.outputMode(self.mode)
            .option("checkpointLocation", checkpoint)
            .foreachBatch(self.write_batch(path))
            .trigger(**(trigger or {"processingTime": "1 second"}))
        )
        if name:
            w = w.queryName(name)
        settings = {}
        if self.large_state:
            settings[STATE_PROVIDER_CONF] = ROCKSDB
        if state_partitions:
            settings["spark.sql.shuffle.partitions"] = str(state_partitions)
        prev = {k: spark.conf.get(k, None) for k in settings}
        for k, v in settings.items():
            spark.conf.set(k, v)
        try:
            return w.start()
        finally:
            for k, v in prev.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stream_popularity(src: DataFrame) -> StreamJob:
    """Running flight count per airport."""
    agg = airport_endpoints(src).groupBy("airport").agg(F.count(F.lit(1)).alias("num_flights"))
    return StreamJob(agg, "complete", ["airport"])


def _totals(src: DataFrame, keys, delay: str) -> DataFrame:
    return valid_delay(src, delay).groupBy(*keys).agg(
        F.sum(delay).alias("total_delay"), F.count(F.lit(1)).alias("num_flights")
    )


def stream_carrier_delay(src: DataFrame) -> StreamJob:
    """Running (sum, count) of arrival delay per carrier, published as mean and count."""
    agg = _totals(src, [F.col("UniqueCarrier").alias("carrier")], "ArrDelay")
    return StreamJob(agg.select("carrier", mean_of(), "num_flights"), "complete", ["carrier"])


def stream_top_n(src: DataFrame, param: str, name: str, n: int = TOP_N) -> StreamJob:
    """Running totals per (airport, parameter); the ``n`` best ranked in each batch.

    Ranking windows are not allowed on a streaming frame, so the flat
    aggregate runs in complete mode and the ranking runs on each batch.
    """
    agg = _totals(src, [F.col("Origin").alias("apt"), F.col(param).alias(name)], "DepDelay")
    agg = agg.select("apt", name, mean_of(), "num_flights")
    return StreamJob(agg, "complete", ["apt", "rank"], post=lambda b: rank_within_airport(b, name, n))


def stream_top_carriers(src: DataFrame, n: int = TOP_N) -> StreamJob:
    return stream_top_n(src, "UniqueCarrier", "airline", n)


def stream_top_destinations(src: DataFrame, n: int = TOP_N) -> StreamJob:
    return stream_top_n(src, "Dest", "dest_airport", n)


def stream_route_delay(src: DataFrame) -> StreamJob:
    """Running mean arrival delay per route."""
    agg = _totals(src, [F.col("Origin").alias("src"), F.col("Dest").alias("dst")], "ArrDelay")
    return StreamJob(agg.select("src", "dst", mean_of(), "num_flights"), "update", ["src", "dst"])


BEST_KEYS = ["src", "dst", "date", "morning"]


def stream_best_flights(src: DataFrame, year: int | None = BEST_FLIGHT_YEAR) -> StreamJob:
    """Lowest arrival delay per (route, date, half-day), kept across batches.

    ``min(struct(delay, padded time, carrier is null, carrier, time))`` is the same total order
    as the batch query.  Update mode writes only the keys a batch changed;
    the table reader takes the newest row per key.
    """
    f = src if year is None else src.filter(F.col("Year") == F.lit(year))
    f = once(
        once(valid_delay(f, "ArrDelay"), *BEST_COLUMNS),
        F.col("Origin").alias("src"),
        F.col("Dest").alias("dst"),
        flight_date().alias("date"),
        (dep_hour("CRSDepTime") < F.lit(NOON)).alias("morning"),
        F.struct(
            F.col("ArrDelay").alias("arr_delay"),
            padded_dep_time("CRSDepTime").alias("dep_order"),
            F.col("UniqueCarrier").isNull().alias("no_carrier"),  # as in the batch order, nulls last
            F.col("UniqueCarrier").alias("carrier"),
            F.col("CRSDepTime").alias("dep_time"),
        ).alias("v"),
    ).filter(F.col("date").isNotNull() & F.col("morning").isNotNull())
    agg = f.groupBy(*BEST_KEYS).agg(F.min("v").alias("best")).select(
        *BEST_KEYS, "best.carrier", "best.dep_time", "best.arr_delay"
    )
    return StreamJob(agg, "update", BEST_KEYS, large_state=True)


def stream_bad_delays(src: DataFrame) -> StreamJob:
    """Unparseable delays counted per batch, one row each; a replayed batch rewrites its own row.

    The counts do not depend on progress reports, which Spark keeps for the
    newest batches only and which a lost driver takes along.
    """
    flags = [bad_flag_name(c) for c in DELAY_COLUMNS]
    return StreamJob(src.select(*flags), "append", [], post=lambda b: b.agg(
        F.count_if("ArrDelay_bad").alias("bad_arr_delay"), F.count_if("DepDelay_bad").alias("bad_dep_delay")))


@dataclass
class IngestJob(StreamJob):
    """Topic lines parsed once per batch into two keyed tables: flights (``rows``) and rejected lines (``rejects``).

    The parsed batch is written to shared storage and both tables are made from it there.  Held as a cached frame
    it took the executors about 285 bytes of heap a line.
    """

    def write_batch(self, path: str) -> Callable[[DataFrame, int], None]:
        def run(batch: DataFrame, batch_id: int) -> None:
            with staged(lean_records(batch), f"{path}/_parsed/batch_id={batch_id}") as records:
                upsert_batch(rejected(records), batch_id, f"{path}/rejects")
                upsert_batch(accepted(records), batch_id, f"{path}/rows")

        return run


def stream_ingest(lines: DataFrame) -> IngestJob:
    """O4 + O11: every line of the topic ends up in one of two tables, none is lost without a trace."""
    return IngestJob(parse_records(lines), "append", [])


JOBS = {
    "stream_popularity": stream_popularity,
    "stream_carrier_delay": stream_carrier_delay,
    "stream_top_carriers": stream_top_carriers,
    "stream_top_destinations": stream_top_destinations,
    "stream_route_delay": stream_route_delay,
    "stream_best_flights": stream_best_flights,
}
