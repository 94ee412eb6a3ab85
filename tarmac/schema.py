"""Record layouts.

The cleaned record has twelve text fields in a fixed order; numbers are
made at the point of use (``tarmac.functions.cleaning.typed_flights``).
"""

from pyspark.sql.types import StringType, StructField, StructType

# The twelve cleaned columns, in this order.
CLEAN_COLUMNS = [
    "Year",
    "Month",
    "DayofMonth",
    "DayOfWeek",
    "UniqueCarrier",
    "Origin",
    "Dest",
    "CRSDepTime",
    "DepDelay",
    "ArrDelay",
    "Cancelled",
    "Diverted",
]

# Fixed value: the text written for a missing field in cleaned CSV and topic rows.
MISSING_MARKER = "_"

# Fixed value: first field of a header row, dropped wherever it appears.
HEADER_FIRST_FIELD = "Year"

CLEAN_SCHEMA = StructType([StructField(c, StringType(), True) for c in CLEAN_COLUMNS])
CLEAN_DDL = ", ".join(f"`{c}` STRING" for c in CLEAN_COLUMNS)

CORRUPT_COLUMN = "_corrupt_record"

INT_COLUMNS = ["Year", "Month", "DayofMonth", "DayOfWeek", "Cancelled", "Diverted"]
DELAY_COLUMNS = ["DepDelay", "ArrDelay"]
NAME_COLUMNS = ["UniqueCarrier", "Origin", "Dest"]
KEY_COLUMNS = [*NAME_COLUMNS, "CRSDepTime"]

# One CSV dialect everywhere: a quote inside a quoted field is doubled, a backslash is a plain character.
CSV_OPTIONS = {"quote": '"', "escape": '"'}

# Read buffer (characters) for ``from_csv``.  The CSV parser sets up a new
# input buffer for every value it parses; its default (about a million
# characters per line) makes parsing slow and can exhaust a small heap when
# many tasks parse at once.  Longer lines are still read whole, in chunks.
FROM_CSV_OPTIONS = {"inputBufferSize": "1024", **CSV_OPTIONS}
