"""Run a stream job over rows derived from the driver tables (registered stream queries).

The cleaned fixture rows are published as CSV lines to text files (the
file-source stand-in for the topic), streamed with ``maxFilesPerTrigger``
so they arrive in several micro-batches, and the keyed result table is
read back.  Scratch paths live under the shared checkpoint directory.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.plans.oracle import BEST_FLIGHTS_YEAR_FIXTURE
from tarmac.schema import CLEAN_COLUMNS, CSV_OPTIONS, MISSING_MARKER
from tarmac.session import scratch_path
from tarmac.sinks.files import publish
from tarmac.sinks.tables import committed_batches, read_all, read_latest, read_snapshot
from tarmac.sources.fixture import clean_flights, table
from tarmac.streaming.jobs import JOBS, StreamJob, stream_bad_delays, stream_ingest, stream_popularity
from tarmac.streaming.progress import BatchLog, read_batch_log
from tarmac.streaming.source import accepted, parse_records, rejected, stream_clean, stream_lines

MICRO_BATCHES = 3
#: rows of a published file, about 70 MB of text
ROWS_PER_FILE = 1_000_000


def files_per_batch(spark: SparkSession, sf_dir: str, batches: int = MICRO_BATCHES) -> int:
    """Files of a micro-batch: one per core at least, more where the flights (one a lineitem) would make them large."""
    rows = table(spark, sf_dir, "lineitem").count()  # of the Parquet footers
    return max(2, spark.sparkContext.defaultParallelism, math.ceil(rows / batches / ROWS_PER_FILE))


def publish_fixture(spark: SparkSession, sf_dir: str, path: str, num_files: int | None = None) -> int:
    """Write the cleaned fixture rows as topic lines into ``num_files`` text files.

    By default at least one file per core for each of the micro-batches, so
    every micro-batch reads with the whole cluster, and of bounded size.
    """
    n = num_files or MICRO_BATCHES * files_per_batch(spark, sf_dir)
    publish(clean_flights(spark, sf_dir).repartition(n), fmt="text", path=path)
    return n


def build_job(spark: SparkSession, name: str, inp: str, files_per_trigger: int) -> StreamJob:
    src = stream_clean(spark, "text", {"maxFilesPerTrigger": str(files_per_trigger)}, inp)
    if name == "stream_best_flights":
        return JOBS[name](src, year=BEST_FLIGHTS_YEAR_FIXTURE)
    return JOBS[name](src)


def run_to_end(job: StreamJob, out: str, checkpoint: str, name: str | None = None,
               state_partitions: int | None = None) -> None:
    q = job.start(out, checkpoint, trigger={"availableNow": True}, name=name,
                  state_partitions=state_partitions)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def run_registered(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base = scratch_path(spark, name)
    inp, out, ckpt = f"{base}/input", f"{base}/table", f"{base}/checkpoint"
    n = publish_fixture(spark, sf_dir, inp)
    job = build_job(spark, name, inp, math.ceil(n / MICRO_BATCHES))
    # A fresh checkpoint: one state partition per core of the cluster.
    run_to_end(job, out, ckpt, state_partitions=spark.sparkContext.defaultParallelism)
    return read_latest(spark, out, None if job.mode == "complete" else job.keys,
                       schema=job.output_schema())


def _feed(spark: SparkSession, sf_dir: str, parts: int, path: str) -> list[DataFrame]:
    """The cleaned fixture rows in ``parts`` by their day of the month, so that a part is a part on every run.

    The rows are joined and cleaned once and written to ``path`` by part, not once for every part.
    """
    clean = clean_flights(spark, sf_dir).withColumn("part", F.col("DayofMonth").cast("int") % parts)
    clean.write.partitionBy("part").parquet(path)
    stored = spark.read.schema(clean.schema).parquet(path)
    return [stored.filter(F.col("part") == k).drop("part") for k in range(parts)]


def run_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run ends, more files come, a second one goes on from its offsets and state."""
    base = scratch_path(spark, "stream_restart")
    inp, out, ckpt = f"{base}/input", f"{base}/table", f"{base}/checkpoint"
    cores = max(2, spark.sparkContext.defaultParallelism)
    n = files_per_batch(spark, sf_dir, 4)
    job = None
    for k, part in enumerate(_feed(spark, sf_dir, 2, f"{base}/feed")):
        publish(part.repartition(2 * n), fmt="text", path=f"{inp}/run{k}")
        job = build_job(spark, "stream_route_delay", f"{inp}/*", n)
        run_to_end(job, out, ckpt, state_partitions=cores)
    return read_latest(spark, out, job.keys, schema=job.output_schema())


def run_clock(spark: SparkSession, sf_dir: str, parts: int = 4) -> DataFrame:
    """A query on a one-second clock, fed while it runs, stopped once all it was given is in the table."""
    base = scratch_path(spark, "stream_clock")
    inp, out = f"{base}/input", f"{base}/table"
    feed = _feed(spark, sf_dir, parts, f"{base}/feed")
    publish(feed[0], fmt="text", path=f"{inp}/part0")
    job = stream_popularity(stream_clean(spark, "text", None, f"{inp}/*"))
    q = job.start(out, f"{base}/checkpoint", trigger={"processingTime": "1 second"},
                  state_partitions=spark.sparkContext.defaultParallelism)
    try:
        q.processAllAvailable()
        for k, part in enumerate(feed[1:], 1):
            publish(part, fmt="text", path=f"{inp}/part{k}")
            q.processAllAvailable()
    finally:
        q.stop()
    if committed_batches(spark, out).count() < parts:
        raise RuntimeError("the query did not run a batch for every part")
    return read_latest(spark, out, schema=job.output_schema())


def run_batch_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of micro-batches and the rows they read, from the log that a listener writes."""
    base = scratch_path(spark, "stream_batch_sizes")
    n = publish_fixture(spark, sf_dir, f"{base}/input")
    job = build_job(spark, "stream_popularity", f"{base}/input", math.ceil(n / MICRO_BATCHES))
    name = base.rsplit("/", 1)[-1]
    log = logged(spark, job, f"{base}/table", f"{base}/checkpoint", f"{base}/log", name)
    return log.agg(F.count(F.lit(1)).alias("num_batches"), F.sum("input_rows").alias("input_rows"), F.max("batch_id").alias("last_batch"))


def logged(spark: SparkSession, job: StreamJob, out: str, checkpoint: str, path: str, name: str, every: int = 64,
           wait: float = 60) -> DataFrame:
    """Run ``job`` to its end with a batch log at ``path``; the log."""
    log = BatchLog(spark, path, name, every)
    spark.streams.addListener(log)
    try:
        run_to_end(job, out, checkpoint, name=name, state_partitions=spark.sparkContext.defaultParallelism)
        if not log.ended.wait(wait):
            raise RuntimeError("no report of the query's end")
    finally:
        spark.streams.removeListener(log)
    return read_batch_log(spark, path)


def run_bad_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unparseable delays over all batches of a stream."""
    base = scratch_path(spark, "stream_bad_delays")
    n = publish_fixture(spark, sf_dir, f"{base}/input")
    job = stream_bad_delays(stream_clean(spark, "text", {"maxFilesPerTrigger": str(math.ceil(n / MICRO_BATCHES))}, f"{base}/input"))
    run_to_end(job, f"{base}/table", f"{base}/checkpoint")
    counts = read_all(spark, f"{base}/table", job.output_schema())
    return counts.agg(*[F.coalesce(F.sum(c), F.lit(0).cast("bigint")).alias(c) for c in ("bad_arr_delay", "bad_dep_delay")])


def run_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest text snapshot of the running popularity."""
    base = scratch_path(spark, "stream_snapshot")
    n = publish_fixture(spark, sf_dir, f"{base}/input")
    job = build_job(spark, "stream_popularity", f"{base}/input", math.ceil(n / MICRO_BATCHES))
    job.snapshot_prefix = f"{base}/snapshots/popularity"
    run_to_end(job, f"{base}/table", f"{base}/checkpoint", state_partitions=spark.sparkContext.defaultParallelism)
    return read_snapshot(spark, job.snapshot_prefix, job.output_schema())


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic lines of the fixture; cancelled flights have a field too many, diverted ones a field too few."""
    short = F.to_csv(F.struct(*CLEAN_COLUMNS[:-1]), {"nullValue": MISSING_MARKER, **CSV_OPTIONS})
    line = F.to_csv(F.struct(*CLEAN_COLUMNS), {"nullValue": MISSING_MARKER, **CSV_OPTIONS})
    return clean_flights(spark, sf_dir).select(
        F.when(F.col("Cancelled") == "1", F.concat(line, F.lit(",more"))).when(F.col("Diverted") == "1", short).otherwise(line).alias("value"))


def run_ingest(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """O4 + O11: (flights, rejected lines) of a damaged topic."""
    base = scratch_path(spark, "stream_ingest")
    n = MICRO_BATCHES * files_per_batch(spark, sf_dir)
    damaged_lines(spark, sf_dir).repartition(n).write.text(f"{base}/input")
    lines = stream_lines(spark, "text", {"maxFilesPerTrigger": str(math.ceil(n / MICRO_BATCHES))}, f"{base}/input")
    run_to_end(stream_ingest(lines), f"{base}/tables", f"{base}/checkpoint")
    records = parse_records(spark.createDataFrame([], "value string"))
    return (read_all(spark, f"{base}/tables/rows", accepted(records).schema).drop("batch_id"),
            read_all(spark, f"{base}/tables/rejects", rejected(records).schema).drop("batch_id"))
