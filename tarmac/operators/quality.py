"""Data-quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.cleaning import bad_flag_name
from tarmac.functions.flight import dep_hour, flight_date
from tarmac.schema import CORRUPT_COLUMN

BAD_COUNTS = ["bad_dep_delay", "bad_arr_delay", "bad_dep_time", "bad_date", "corrupt_rows"]


class DataQualityError(ValueError):
    pass


def quality_report(df: DataFrame, strict: bool = False) -> DataFrame:
    """One-pass counts of the record checks over typed flights (one row).

    When the rows come from ``read_clean`` and still carry
    ``_corrupt_record``, rows with a wrong field count are counted too
    (``corrupt_rows``).  ``strict=True`` runs the report and raises if any bad
    count is non-zero (the reference aborts on these); only the single result
    row reaches the driver.
    """
    def missing(c):
        return F.count_if(F.col(c).isNull() & ~F.col(bad_flag_name(c)))

    rep = df.agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.count_if(F.col("Origin").isNull()).alias("missing_origin"),
        F.count_if(F.col("Dest").isNull()).alias("missing_dest"),
        F.count_if(F.col("UniqueCarrier").isNull()).alias("missing_carrier"),
        missing("DepDelay").alias("missing_dep_delay"),
        F.count_if(F.col(bad_flag_name("DepDelay"))).alias("bad_dep_delay"),
        missing("ArrDelay").alias("missing_arr_delay"),
        F.count_if(F.col(bad_flag_name("ArrDelay"))).alias("bad_arr_delay"),
        F.count_if(dep_hour("CRSDepTime").isNull()).alias("bad_dep_time"),
        F.count_if(flight_date().isNull()).alias("bad_date"),
        *([F.count_if(F.col(CORRUPT_COLUMN).isNotNull()).alias("corrupt_rows")]
          if CORRUPT_COLUMN in df.columns else []),
    )
    if strict:
        row = rep.first()
        bad = {k: row[k] for k in BAD_COUNTS if k in row and row[k]}
        if bad:
            raise DataQualityError(f"bad records: {bad}")
    return rep
