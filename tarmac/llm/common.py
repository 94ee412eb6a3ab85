"""Small shared helpers: table access, lineage cuts, ranks without a global sort."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's setting (4.1 on) that deletes the shuffle files of a run at its end; else they stay until the driver collects garbage
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _written(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and read it back; what it shuffled goes at once, as only the written files are read again."""
    conf = df.sparkSession.conf
    was = conf.get(RELEASE, None)
    conf.set(RELEASE, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(RELEASE) if was is None else conf.set(RELEASE, was)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    This cuts the lineage with files that every executor sees, so a lost
    executor costs its running tasks only.
    """
    return _written(df, scratch_path(df.sparkSession, name))


class Scratch:
    """Tables of one operator below the shared checkpoint folder, which go once nothing unwritten is made of them."""

    def __init__(self, spark: SparkSession, name: str):
        self._spark, self._root, self._paths, self._n = spark, scratch_path(spark, name), {}, 0

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """As the function ``stored``; a table of the same name stays until dropped."""
        self._n += 1
        path = f"{self._root}/{name}-{self._n}"
        self._paths.setdefault(name, []).append(path)
        return _written(df, path)

    def drop(self, *names: str, but_last: bool = False) -> None:
        """Delete the tables of these names; with ``but_last`` the newest of each stays.

        Only for tables whose every use has been written: a task that is run again reads what it reads by path.
        """
        for name in names:
            written = self._paths.get(name, [])
            gone = written[:-1] if but_last else written[:]
            for path in gone:
                at = self._spark._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(at, True)
                written.remove(path)


def kept_by_worker(name: str | None, make: Callable | None = None):
    """A table that a Python worker keeps between tasks (task code is shipped by value, so it stands in ``sys.modules``).

    A worker keeps one at a time: one that is asked for next, or None, takes the former one's place, as workers go from
    one operator's tasks to another's.
    """
    held = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker")).__dict__.setdefault("tables", {})
    if name not in held:
        held.clear()
        if name is not None:
            held[name] = make()
    return held.get(name)


def small_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> None:
    """Let Spark hand whole texts to Python workers in small batches, from now on in this session."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def whole_row(docs: DataFrame) -> Column:
    """All columns as one struct ``row``, so that no name of theirs meets one of an operator's own; ``row.*`` is the rows again."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]).alias("row")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; other letters keep their case."""
    return F.translate(c, UPPER, UPPER.lower())


def bucketed_rank(df: DataFrame, keys: list[str], order: list[str], name: str,
                  buckets: int = 1024) -> DataFrame:
    """Gapless rank from 0 within ``keys`` (few, fixed-size key values).

    Rows of a key are dealt over ``buckets`` by a hash of ``order``, numbered
    inside their bucket and shifted by the size of the buckets before it, so
    no task sees a whole key.  The offsets are at most keys x ``buckets`` rows,
    which is the bound of the broadcast.
    """
    d = df.withColumn("_bk", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        d.groupBy(*keys, "_bk").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(*keys, "_bk").orderBy(*order)
    return (
        d.withColumn("_rn", F.row_number().over(inside))
        .join(F.broadcast(offsets), [*keys, "_bk"])
        .withColumn(name, F.col("_off") + F.col("_rn") - 1)
        .drop("_bk", "_rn", "_off")
    )
