"""tarmac: flight on-time analytics as Spark DataFrame jobs.

Layout
------
- ``sources``   readers: zipped CSV archives, raw CSV by header name,
                cleaned CSV, and the fixture view over the driver tables.
- ``functions`` column expressions: cleaning, delay parsing, flight date,
                half-day flag, airport endpoints.
- ``operators`` the questions: popularity, mean delays, top-N per airport,
                rank-frequency, best row per key, data-quality report.
- ``streaming`` Structured Streaming versions of the same questions.
- ``sinks``     cleaned CSV / Parquet writers, topic publisher, keyed
                per-batch result tables.
- ``plans``     the registered queries and their DuckDB oracle SQL.
"""

import sys as _sys

from tarmac.schema import CLEAN_COLUMNS, CLEAN_SCHEMA, CLEAN_DDL  # noqa: F401

# The few task-side Python functions (archive unpacking, header reads) are
# shipped with the tasks by value, so executors need no copy of this package
# on their path (``--py-files`` works as well).
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # older cloudpickle: ship with --py-files
    pass

__all__ = ["CLEAN_COLUMNS", "CLEAN_SCHEMA", "CLEAN_DDL"]
