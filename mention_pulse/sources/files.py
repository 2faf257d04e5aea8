"""File sources."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mention_pulse.functions.keys import PARTS
from mention_pulse.schemas import POSTS_RAW, TICKERS_CSV

CORRUPT = "_corrupt_record"


def read_posts(
    spark: SparkSession, path: str, schema: T.StructType = POSTS_RAW, keep_corrupt: bool = False
) -> DataFrame:
    """Nested posts as JSON lines, with a declared schema; bad lines give nulls.

    With `keep_corrupt` a bad line is kept as text in `_corrupt_record`.
    """
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", CORRUPT).json(path)


def read_tickers(spark: SparkSession, path: str) -> DataFrame:
    """Ticker list as CSV with a header row, renamed to sno, ticker, ticker_name, weight."""
    # declared names replace the header's, and a byte-order mark goes with the header
    reader = spark.read.schema(TICKERS_CSV).option("header", True).option("enforceSchema", True)
    return reader.option("multiLine", True).csv(path)


def read_table(spark: SparkSession, name: str, where: Column | str | None = None) -> DataFrame:
    """A catalog table, or Parquet at a path; `where` on partition columns prunes the scan."""
    # a one-part name is a table unless it has a scheme or a slash; write ./name for a relative path
    is_path = "/" in name
    df = spark.read.parquet(name) if is_path else spark.table(name)
    return df if where is None else df.filter(where)


def is_before_day(run_date: dt.date) -> Column:
    """Partition predicate: days strictly before the run date, over all earlier years."""
    year, month, day = (F.lit(f"{run_date:{fmt}}") for fmt in ("%Y", "%m", "%d"))
    y, m, d = (F.col(p) for p in PARTS[:3])
    return (y < year) | ((y == year) & (m < month)) | ((y == year) & (m == month) & (d < day))


def closed_days(df: DataFrame, run_date: dt.date | None = None) -> DataFrame:
    """Rows of closed days only; today (UTC) is still open."""
    return df.filter(is_before_day(run_date or dt.datetime.now(dt.timezone.utc).date()))


def is_empty(df: DataFrame) -> bool:
    """Whether there is nothing to do (runs a job which stops at the first row)."""
    return df.isEmpty()


def incremental(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "json",
    max_files: int | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Stream of the files under a path; with a checkpoint each file is seen by one run only.

    With `keep_corrupt` a bad line of JSON is kept as text in `_corrupt_record`.
    """
    if keep_corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.readStream.schema(schema).format(fmt).option("columnNameOfCorruptRecord", CORRUPT)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
