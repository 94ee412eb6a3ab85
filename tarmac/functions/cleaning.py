"""Cleaning and typing of flight records.

All of it is built-in column expressions, so it stays inside whole-stage
code generation and Catalyst can prune columns a query does not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.schema import (
    CLEAN_COLUMNS,
    DELAY_COLUMNS,
    HEADER_FIRST_FIELD,
    INT_COLUMNS,
    MISSING_MARKER,
    NAME_COLUMNS,
)

# The suffix removed from every field ("<int>.00" -> "<int>"); as a pattern, with a field that is
# nothing but the missing marker.
ZERO_CENTS = ".00"
ZERO_CENTS_OR_MISSING = r"^_\z|\.00\z"


def clean_value(c: Column | str, filtered: bool = False) -> Column:
    """O6 + O7: strip a trailing ``.00``; empty (also a bare ``.00`` or ``_``) becomes null.

    Plain string functions: a regular expression for every field costs more
    than all else in a fixture row.  They read the field four times, so a field
    that questions filter on (``filtered``) has one ``regexp_replace``, which
    reads it once: Catalyst copies the expression of a pushed filter into every
    reference, and generated code past the method-size limit is not compiled.
    """
    c = F.col(c) if isinstance(c, str) else c
    if filtered:
        return F.nullif(F.regexp_replace(c, ZERO_CENTS_OR_MISSING, ""), F.lit(""))
    bare = F.when(c.endswith(ZERO_CENTS), F.left(c, F.length(c) - len(ZERO_CENTS))).when(c != MISSING_MARKER, c)
    return F.nullif(bare, F.lit(""))


def once(df: DataFrame, *cols: Column | str) -> DataFrame:
    """``df.select(*cols)``, with every column worked out once a row.

    Catalyst pushes a filter below the projection it reads, and then works out
    the filtered column's whole expression again for each reference (measured:
    34 parses of every raw CSV line).  A filter on what a generator puts out
    stays above it.
    """
    return df.select(F.inline(F.array(F.struct(*cols))))


def project_clean(df: DataFrame) -> DataFrame:
    """Keep the twelve cleaned columns, in order."""
    return df.select(*CLEAN_COLUMNS)


def clean_values(df: DataFrame, keep: list[str] | tuple = ()) -> DataFrame:
    """O5-O7 over a raw all-text frame: twelve columns, cleaned values (plus ``keep`` as is)."""
    return df.select(*[clean_value(c, c in DELAY_COLUMNS).alias(c) for c in CLEAN_COLUMNS], *keep)


def drop_header_rows(df: DataFrame, first: str = CLEAN_COLUMNS[0]) -> DataFrame:
    """Drop rows whose first field is the header name; null years are kept."""
    return df.filter(~F.col(first).eqNullSafe(F.lit(HEADER_FIRST_FIELD)))


def parse_int(c: Column | str, type_: str = "bigint") -> Column:
    """Lenient integer parse, sign and digits after trimming; else null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(c).try_cast(type_)


def is_bad(c: Column | str, type_: str = "bigint") -> Column:
    """Text present but not an integer (missing is not bad)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & parse_int(c, type_).isNull()


def parse_delay(df: DataFrame, col: str) -> DataFrame:
    """O10 on a text column: adds ``<col>_value`` (bigint or null) and ``<col>_bad``."""
    return df.withColumn(f"{col}_value", parse_int(col)).withColumn(bad_flag_name(col), is_bad(col))


def bad_flag_name(col: str) -> str:
    return f"{col}_bad"


def typed_flights(clean: DataFrame, keep: list[str] | tuple = ()) -> DataFrame:
    """Typed form of cleaned rows (FIXTURES §2), plus a bad-text flag per delay.

    The flags keep "present but unparseable" apart from "missing" after the
    text is gone, so bad-record counts read two boolean columns instead of
    re-parsing text.  Store this frame once (Parquet, partitioned by Year);
    every query reads it with pruned columns and pushed filters.  Carriers
    and airports are trimmed here, once, so that ``"AA "`` and ``"AA"`` are
    one key in every question (blanks alone are an empty name, not a missing one).
    """
    cols = []
    for c in CLEAN_COLUMNS:
        if c in INT_COLUMNS:
            cols.append(parse_int(c, "int").alias(c))
        elif c in DELAY_COLUMNS:
            cols.append(parse_int(c, "bigint").alias(c))
        elif c in NAME_COLUMNS:
            cols.append(F.trim(c).alias(c))
        else:
            cols.append(F.col(c))
    cols += [is_bad(c, "bigint").alias(bad_flag_name(c)) for c in DELAY_COLUMNS]
    return clean.select(*cols, *keep)


def valid_delay(df: DataFrame, col: str) -> DataFrame:
    """Rows with a usable delay in ``col`` (typed frame)."""
    return df.filter(F.col(col).isNotNull())
