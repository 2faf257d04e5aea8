"""Tables written batch by batch, each batch replaced as a whole: a manifest names the files it owns.

A write puts its rows under `batch=<id>/attempt=<new id>`, partitioned below, and commits the list of its
files as one manifest entry afterwards. Readers take, of every batch, the files of the attempt that
was committed last: hours that vanish, rows that change sides, or an empty write leave nothing behind, and an
attempt that failed is never seen. Reads list just the folders of the partitions asked for, from the
manifest, and open no footer to learn the schema.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mention_pulse.schemas import TEXTS_REF
from mention_pulse.sources import tables

BATCH, ATTEMPT = "batch", "attempt"
# below an attempt; readers of its rows pass over it
TEXTS_FOLDER = "_texts"
ENTRIES = T.StructType(
    [
        T.StructField(BATCH, T.StringType()),
        T.StructField(ATTEMPT, T.StringType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("file", T.StringType()),  # below the attempt's folder; null for the entry of the attempt itself
        T.StructField("bytes", T.LongType()),
        T.StructField("schema", T.StringType()),  # of the rows, in the entry of the attempt itself
        T.StructField("keys", T.ArrayType(T.StringType())),
        T.StructField("source", T.StringType()),  # attempt of the same batch elsewhere that it was made from
        T.StructField("texts", T.ArrayType(T.StringType())),  # text columns that lie beside the rows, in TEXTS_FOLDER
    ]
)


def manifest_path(base: str) -> str:
    """Where a table's manifest lies: beside it, so that the table's folder holds rows only."""
    return f"{base.rstrip('/')}_manifest"


def _folder(base: str, batch: str, attempt: str) -> str:
    return f"{base.rstrip('/')}/{BATCH}={batch}/{ATTEMPT}={attempt}"


def _file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, bytes) of the Parquet files below a folder, named from there; contents are not read."""
    system, where = _file_system(spark, folder)
    if not system.exists(where):
        return spark.createDataFrame([], "file string, bytes long")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder)
    name = F.element_at(F.split("path", f"/{ATTEMPT}=[^/]*/"), -1)
    return listed.select(name.alias("file"), F.col("length").alias("bytes"))


def write_batch(
    df: DataFrame, base: str, batch: str, keys: Sequence[str], source: str | None = None, texts: Sequence[str] = ()
) -> None:
    """Write a batch, in place of what it held before, partitioned by `keys`.

    `source` is the attempt, of the batch of that name in another table, that it was made from; see `stale`.
    `texts` are columns that are written beside the rows, and never moved; see `tables.put_texts`.
    """
    if not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError(f"{batch!r} is no name for a batch: letters, digits, _, . and - only")
    spark = df.sparkSession
    attempt = uuid.uuid4().hex
    folder = _folder(base, batch, attempt)
    texts = [c for c in texts if c in df.columns]
    rows = tables.put_texts(df, texts, base, f"{BATCH}={batch}/{ATTEMPT}={attempt}/{TEXTS_FOLDER}") if texts else df
    tables.write_partitioned(rows, folder, keys)
    own = spark.createDataFrame(
        [(None, None, df.schema.json(), list(keys), source, texts)],
        "file string, bytes long, schema string, keys array<string>, source string, texts array<string>",
    )
    entry = own.unionByName(_files(spark, folder), allowMissingColumns=True)
    entry = entry.withColumns({BATCH: F.lit(batch), ATTEMPT: F.lit(attempt), "committed_at": F.current_timestamp()})
    # one file, so an entry is there as a whole or not at all
    entry.select(*ENTRIES.fieldNames()).coalesce(1).write.mode("append").parquet(manifest_path(base))


def is_batched(spark: SparkSession, base: str) -> bool:
    """Whether the table at a path has a manifest."""
    system, where = _file_system(spark, manifest_path(base))
    return system.exists(where)


def entries(spark: SparkSession, base: str) -> DataFrame:
    """All entries of the manifest; none before the first batch."""
    try:
        return spark.read.schema(ENTRIES).parquet(manifest_path(base))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ENTRIES)


def live_entries(spark: SparkSession, base: str) -> DataFrame:
    """Entries of the attempt of each batch that was committed last."""
    found = entries(spark, base)
    when = F.struct("committed_at", ATTEMPT)
    last = found.filter("file IS NULL").groupBy(F.col(BATCH).alias("_batch")).agg(F.max_by(ATTEMPT, when).alias("_attempt"))
    return found.join(last, (F.col(BATCH) == F.col("_batch")) & (F.col(ATTEMPT) == F.col("_attempt"))).drop("_batch", "_attempt")


def stale(spark: SparkSession, src: str, base: str) -> list[tuple[str, str]]:
    """(batch, attempt) of the batches of `src` whose live attempt `base` was not made from, in order of their names."""
    made = live_entries(spark, base).filter("file IS NULL").select(BATCH, F.col("source").alias(ATTEMPT))
    there = live_entries(spark, src).filter("file IS NULL").select(BATCH, ATTEMPT)
    return [tuple(row) for row in there.join(made, [BATCH, ATTEMPT], "left_anti").orderBy(BATCH).collect()]


def _with_keys(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Entries of files with the partition values that their names hold."""
    values = {k: F.regexp_extract("file", rf"(?:^|/){k}=([^/]*)/", 1) for k in keys}
    return found.filter("file IS NOT NULL").withColumns(values)


def live_files(spark: SparkSession, base: str, keys: Sequence[str]) -> DataFrame:
    """(batch, attempt, file, bytes) of all live files, with their partition values as text."""
    return _with_keys(live_entries(spark, base), keys).select(BATCH, ATTEMPT, "file", "bytes", *keys)


def read_batches(spark: SparkSession, base: str, where: Column | None = None, with_texts: bool = True) -> DataFrame:
    """Rows of all live batches; `where` is a predicate on batch, attempt and partition values (as text).

    Texts that lie beside the rows are put in, or, with `with_texts` false and where all batches have them so, stay
    where they are, the rows having TEXTS_AT instead. Only folders whose live files `where` holds for are listed, whole upper folders where it holds for all in
    them. The list of these folders, and no row, passes through the driver. Before the first batch the schema is not known, so that is an error.
    """
    live = live_entries(spark, base).persist()
    try:
        last = live.filter("file IS NULL").orderBy(F.desc("committed_at")).select("schema", "keys").first()
        if last is None:
            raise ValueError(f"no batch has been committed to {base}")
        keys = last["keys"]
        apart = [row["texts"] or [] for row in live.filter("file IS NULL").select("texts").distinct().collect()]
        folder = F.regexp_extract("file", r"^(.*)/[^/]*$", 1)
        found = _with_keys(live, keys).withColumn("whole", F.lit(True) if where is None else F.coalesce(where, F.lit(False)))
        place = F.when(F.col("whole"), folder)
        # a folder of folders that are all wanted stands for them
        for depth in (len(keys) - 1, 1):
            upper = F.substring_index("file", "/", depth)
            all_of = F.min("whole").over(Window.partitionBy(BATCH, ATTEMPT, upper))
            place = F.when(all_of, upper).otherwise(place)
        places = found.select(BATCH, ATTEMPT, place.alias("folder")).filter("folder IS NOT NULL").distinct().collect()
    finally:
        live.unpersist()
    fields = {f.name: f for f in T.StructType.fromJson(json.loads(last["schema"])).fields}
    data = [f for name, f in fields.items() if name not in keys]
    placed = [T.StructField(BATCH, T.StringType()), T.StructField(ATTEMPT, T.StringType()), *(fields[k] for k in keys)]
    texts = max(apart, key=len)
    if not with_texts and all(apart):
        data = [f for f in data if f.name not in texts]
    schema = T.StructType([*data, *([TEXTS_REF] if texts else []), *placed])
    paths = [f"{_folder(base, p[BATCH], p[ATTEMPT])}/{p['folder']}" for p in places]
    if paths:
        rows = spark.read.schema(schema).option("basePath", base).parquet(*sorted(paths))
    else:
        rows = spark.createDataFrame([], schema)
    if not texts or (not with_texts and all(apart)):
        return rows
    return tables.with_texts(rows, texts, base).select(*(f.name for f in [*data, *placed]))


def vacuum(spark: SparkSession, base: str, older_than_hours: float = 168) -> list[str]:
    """Delete attempts that no reader sees any more and that were written long enough ago; gives their folders."""
    system, where = _file_system(spark, base)
    live = {(r[BATCH], r[ATTEMPT]) for r in live_entries(spark, base).filter("file IS NULL").select(BATCH, ATTEMPT).collect()}
    before = (time.time() - 3600 * older_than_hours) * 1000
    gone = []
    for batch in system.listStatus(where):
        for attempt in system.listStatus(batch.getPath()):
            name = tuple(p.split("=", 1)[1] for p in (batch.getPath().getName(), attempt.getPath().getName()))
            if name not in live and attempt.getModificationTime() <= before:
                system.delete(attempt.getPath(), True)
                gone.append(attempt.getPath().toString())
    return sorted(gone)
