"""European-style CSV source and sink (';' separator, ',' decimal mark).

Read with an explicit all-string schema derived from the header (no
inference pass over the data), then type every column by expression:
``try_cast`` after swapping the decimal comma, so junk becomes NULL instead
of failing the job under ANSI mode.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sensorgrid.functions.columns import drop_by_regex
from sensorgrid.functions.exprs import european_double, parse_two_formats
from sensorgrid.operators.common import q

_AUTO_NAME = re.compile(r"^_c(\d+)$")


def read_eu_csv_raw(spark: SparkSession, path: str, sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """All columns as strings; empty header cells are named 'Unnamed: <i>' (pandas naming)."""
    probe = (spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
             .option("inferSchema", False).csv(path))
    names = [f"Unnamed: {m.group(1)}" if (m := _AUTO_NAME.match(c)) else c for c in probe.columns]
    schema = StructType([StructField(n, StringType(), True) for n in names])
    df = (spark.read.schema(schema).option("header", True).option("sep", sep).option("encoding", encoding)
          .option("mode", "PERMISSIVE").csv(path))
    # blank trailing lines parse as all-NULL rows; drop them (explicit filter: names may hold dots)
    any_value = F.lit(False)
    for c in df.columns:
        any_value = any_value | q(c).isNotNull()
    return df.where(any_value)


def type_eu_frame(df: DataFrame, date_col: str = "Date", time_col: str = "Time", ts: str = "ts",
                  keep_strings=(), drop_pattern: str = r"^Unnamed") -> DataFrame:
    """Drop 'Unnamed' columns, parse Date+Time into ``ts``, decimal-comma parse the rest."""
    df = drop_by_regex(df, drop_pattern)
    if date_col not in df.columns or time_col not in df.columns:
        raise ValueError(f"expected '{date_col}' and '{time_col}' columns, got {df.columns}")
    keep = set(keep_strings)
    cols = [parse_two_formats(q(date_col), q(time_col)).alias(ts)]
    for c in df.columns:
        if c in (date_col, time_col):
            continue
        cols.append(q(c) if c in keep else european_double(q(c)).alias(c))
    return df.select(*cols)


def check_parsed(df: DataFrame, ts: str = "ts", min_valid: int = 100) -> int:
    """Raise if fewer than ``min_valid`` timestamps parsed (one count job)."""
    n = df.agg(F.count(q(ts)).alias("n")).first()["n"]
    if n < min_valid:
        raise RuntimeError(f"too few valid timestamps parsed: {n} < {min_valid}; check Date/Time format")
    return n


def read_eu_csv(spark: SparkSession, path: str, keep_strings=(), min_valid: int | None = None,
                sep: str = ";") -> DataFrame:
    """Typed frame from a raw European CSV (S1 + S2 + F1)."""
    typed = type_eu_frame(read_eu_csv_raw(spark, path, sep=sep), keep_strings=keep_strings)
    if min_valid:
        check_parsed(typed, min_valid=min_valid)
    return typed


def to_eu_strings(df: DataFrame, ts: str = "ts", time_format_col=None, keep_strings=()) -> DataFrame:
    """Render a typed frame as the raw CSV layout: Date dd/MM/yyyy, Time HH.mm.ss (or HH:mm:ss
    where ``time_format_col`` is true), numbers with a decimal comma."""
    t = q(ts)
    dot = F.date_format(t, "HH.mm.ss")
    colon = F.date_format(t, "HH:mm:ss")
    time = dot if time_format_col is None else F.when(time_format_col, colon).otherwise(dot)
    cols = [F.date_format(t, "dd/MM/yyyy").alias("Date"), time.alias("Time")]
    for c in df.columns:
        if c == ts:
            continue
        if c in keep_strings:
            cols.append(q(c))
        else:
            cols.append(F.regexp_replace(q(c).cast("string"), r"\.", ",").alias(c))
    return df.select(*cols)


def write_eu_csv(df: DataFrame, path: str, trailing_empty: int = 2, mode: str = "overwrite") -> None:
    """Write with header, ';' separator and ``trailing_empty`` empty trailing columns.

    Spark cannot write an empty header cell, so the trailing columns carry the
    names pandas would give them ('Unnamed: <i>'); readers drop them by name.
    """
    base = len(df.columns)
    extra = [F.lit(None).cast("string").alias(f"Unnamed: {base + i}") for i in range(trailing_empty)]
    (df.select("*", *extra).write.mode(mode).option("header", True).option("sep", ";")
       .option("nullValue", "").csv(path))
