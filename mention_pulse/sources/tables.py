"""Sinks: partitioned tables, run snapshots and the pointer to the latest of them."""

from __future__ import annotations

import re
import struct
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mention_pulse.functions.keys import PARTS
from mention_pulse.schemas import TEXTS_AT, TEXTS_REF
from mention_pulse.sources.records import encode_records

RUN = "RUN_ID"
# text columns of the recent-posts table
TEXTS = ("TEXT", "CLEANTEXT")
# bytes of text that a task turns back at once, and files of texts that it holds open
UNPACKED_BYTES = 16 << 20
OPEN_FILES = 256
MANIFEST = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("parts", T.ArrayType(T.StringType())),
        # days whose rows this run holds alone: those of earlier runs are void
        T.StructField("rebuilt", T.ArrayType(T.StringType())),
        # runs whose snapshots add up to the state after this one, itself last; null: this one alone
        T.StructField("chain", T.ArrayType(T.StringType())),
        # bounds of the time keys of its recent posts
        T.StructField("first_key", T.StringType()),
        T.StructField("last_key", T.StringType()),
    ]
)


# ---- rows with texts -----------------------------------------------------------------------
def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system, for tasks that open files of their own; a local one without."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = system.makeQualified(where)
    return found.toUri().getPath() if found.toUri().getScheme() == "file" else found.toString()


def _system_of(place: str) -> Callable[[], tuple[pyarrow.fs.FileSystem, str]]:
    def system() -> tuple[pyarrow.fs.FileSystem, str]:
        if place.startswith("/"):
            return pyarrow.fs.LocalFileSystem(), place
        return pyarrow.fs.FileSystem.from_uri(place)

    return system


def put_texts(df: DataFrame, texts: Sequence[str], root: str, below: str = "") -> DataFrame:
    """Rows with a reference (TEXTS_AT) in place of some text columns, whose values are put into files under a root.

    Every task writes a file of its own in the folder `below` the root, compressed text by text, so that any of them
    can be read alone. A cleaned text repeats its text almost word for word, so both lie together. Rows of one Arrow
    batch that are alike in these columns, such as the mentions of one post, share one entry. A task that is run
    again writes another file: what a reference names never changes.
    """
    spark = df.sparkSession
    system = _system_of(qualified(spark, f"{root.rstrip('/')}/{below}"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, head = zstandard.ZstdCompressor(level=3), struct.Struct(f"<{len(texts)}i")
        name, out, end = f"{uuid.uuid4().hex}.texts", None, 0
        try:
            for batch in batches:
                columns = [batch.column(c).cast(pa.binary()) for c in texts]
                which = np.zeros(batch.num_rows, np.int64)
                for column in columns:
                    codes = column.dictionary_encode()
                    n = len(codes.dictionary)
                    code = codes.indices.fill_null(n).to_numpy(zero_copy_only=False).astype(np.int64)
                    which = np.unique(which * (n + 1) + code, return_inverse=True)[1]
                first = np.unique(which, return_index=True)[1]
                if out is None and batch.num_rows:
                    files, folder = system()
                    files.create_dir(folder, recursive=True)
                    out = files.open_output_stream(f"{folder.rstrip('/')}/{name}", buffer_size=1 << 20)
                at, size = np.zeros(len(first), np.int64), np.zeros(len(first), np.int32)
                for i, row in enumerate(first.tolist()):
                    values = [c[row].as_py() for c in columns]
                    frame = press.compress(
                        b"".join([head.pack(*(-1 if v is None else len(v) for v in values)), *(v for v in values if v)])
                    )
                    out.write(frame)
                    at[i], size[i] = end, len(frame)
                    end += len(frame)
                if out is not None:
                    out.flush()
                file = pa.array([f"{below}/{name}" if below else name] * batch.num_rows, pa.string())
                refs = pa.StructArray.from_arrays([file, pa.array(at[which]), pa.array(size[which])], ["file", "at", "size"])
                yield batch.drop_columns(list(texts)).append_column(TEXTS_AT, refs)
        finally:
            if out is not None:
                out.close()

    left = [f for f in df.schema.fields if f.name not in texts]
    return df.mapInArrow(pack, T.StructType([*left, TEXTS_REF]))


def _texts_at(place: str, n_texts: int) -> Callable[[pa.StructArray], Iterator[tuple[int, list[pa.Array]]]]:
    """For references: numbers of rows, in the order they have, with their texts, some MB of text at a time."""
    system, most, open_files = _system_of(place), UNPACKED_BYTES, OPEN_FILES

    def found(refs: pa.StructArray) -> Iterator[tuple[int, list[pa.Array]]]:
        press, head = zstandard.ZstdDecompressor(), struct.Struct(f"<{n_texts}i")
        files, root = system()
        opened = {}

        def entry(file: str, at: int, size: int) -> list[bytes | None]:
            if file not in opened:
                if len(opened) >= open_files:
                    opened.pop(next(iter(opened))).close()
                opened[file] = files.open_input_file(f"{root.rstrip('/')}/{file}")
            raw = press.decompress(opened[file].read_at(size, at))
            values, begin = [], head.size
            for n in head.unpack_from(raw):
                values.append(None if n < 0 else raw[begin : begin + n])
                begin += max(n, 0)
            return values

        def made(columns: list[list[bytes | None]]) -> list[pa.Array]:
            # texts come back byte by byte, whatever these are
            return [pa.array(c, pa.binary()).cast(pa.string(), safe=False) for c in columns]

        try:
            size, columns, seen = 0, [[] for _ in range(n_texts)], {}
            for ref in zip(*(f.to_pylist() for f in refs.flatten())):
                if ref not in seen:
                    seen[ref] = [None] * n_texts if ref[0] is None else entry(*ref)
                for column, value in zip(columns, seen[ref]):
                    column.append(value)
                    size += len(value or b"")
                if size >= most:
                    yield len(columns[0]), made(columns)
                    size, columns, seen = 0, [[] for _ in range(n_texts)], {}
            if columns[0]:
                yield len(columns[0]), made(columns)
        finally:
            for file in opened.values():
                file.close()

    return found


def with_texts(df: DataFrame, texts: Sequence[str], root: str) -> DataFrame:
    """Rows of `put_texts`, wherever they have been moved and kept, with their texts in place of the reference.

    Texts are opened only where they are asked for; a row without a reference keeps its own.
    """
    found = _texts_at(qualified(df.sparkSession, root), len(texts))
    names = [f"t{i}" for i in range(len(texts))]

    def unpack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for refs in batches:
            for _, columns in found(refs):
                yield pa.StructArray.from_arrays(columns, names)

    kind = T.StructType([T.StructField(n, T.StringType()) for n in names])
    opened = df.withColumn("_opened", F.arrow_udf(unpack, kind)(TEXTS_AT))
    own = [F.coalesce(c, f"_opened.{n}") if c in df.columns else F.col(f"_opened.{n}") for c, n in zip(texts, names)]
    return opened.withColumns(dict(zip(texts, own))).drop("_opened", TEXTS_AT)


def take_texts(df: DataFrame, root: str, other: str) -> DataFrame:
    """Rows of `put_texts` that refer to a root of their own: the files they name are copied there, each at most once."""
    spark = df.sparkSession
    source, target = _system_of(qualified(spark, root)), _system_of(qualified(spark, other))

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (src, src_root), (dst, dst_root) = source(), target()
        for batch in batches:
            dst.create_dir(dst_root, recursive=True)
            for file in batch.column("file").to_pylist():
                there = f"{dst_root}/{file.rsplit('/', 1)[-1]}"
                if dst.get_file_info(there).type == pyarrow.fs.FileType.NotFound:
                    attempt = f"{there}.{uuid.uuid4().hex}"
                    pyarrow.fs.copy_files(f"{src_root}/{file}", attempt, src, dst, chunk_size=4 << 20, use_threads=False)
                    dst.move(attempt, there)
            yield batch

    files = df.select(F.col(f"{TEXTS_AT}.file").alias("file")).filter("file IS NOT NULL").distinct()
    dealt = files.repartition(spark.sparkContext.defaultParallelism)
    dealt.mapInArrow(copy, files.schema).write.format("noop").mode("overwrite").save()
    return df.withColumn(TEXTS_AT, F.col(TEXTS_AT).withField("file", F.substring_index(f"{TEXTS_AT}.file", "/", -1)))


def move_rows(df: DataFrame, texts: Sequence[str], move: Callable[[DataFrame], DataFrame], once: bool = False) -> DataFrame:
    """Rows after a shuffle, without their texts in it: these wait in the shared folder, and are read where the rows end up.

    With `once` the rows lie in a shuffle of their own before, for a move that reads them twice, as one by ranges does.
    Where there is no shared folder the rows move whole.
    """
    texts = [c for c in texts if c in df.columns]
    try:
        root = fresh_folder(df.sparkSession, "texts") if texts else None
    except ValueError:
        root = None
    if root is None:
        return move(df)
    rows = put_texts(df, texts, root)
    if once:
        at = F.col(f"{TEXTS_AT}.at")
        # a column more keeps Spark from taking both shuffles for one
        rows = rows.repartition(TEXTS_AT).withColumn("_at", at)
    return open_texts(move(rows), df.schema, texts, root)


def open_texts(df: DataFrame, schema: T.StructType, texts: Sequence[str], root: str) -> DataFrame:
    """As `with_texts`, in a schema and in one step over whole rows, some MB of text at a time: every text is opened."""
    names, own = schema.fieldNames(), [c for c in texts if c in df.columns]
    found = _texts_at(qualified(df.sparkSession, root), len(texts))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin = 0
            for n, columns in found(batch.column(TEXTS_AT)):
                part, texts_of = batch.slice(begin, n), dict(zip(texts, columns))
                begin += n
                texts_of |= {c: pc.coalesce(part.column(c), texts_of[c]) for c in own}
                yield pa.RecordBatch.from_arrays([texts_of[c] if c in texts_of else part.column(c) for c in names], names)

    return df.mapInArrow(unpack, schema)


# ---- plain tables --------------------------------------------------------------------------
def write_table(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None) -> None:
    """Unpartitioned snappy Parquet; `files` only suits small results, as it narrows the work."""
    df = df if files is None else df.coalesce(files)
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = PARTS,
    mode: str = "append",
    files: int | None = None,
    texts: Sequence[str] = (),
) -> None:
    """Parquet partitioned by `keys`.

    Rows are rebalanced by partition, so a partition gets few files and a very large one still
    spreads over several tasks; `files` instead narrows a small result to that many. The columns
    named as `texts` are left out of that, see `move_rows`.
    """
    texts = [c for c in texts if c in df.columns]
    df = move_rows(df, texts, lambda rows: rows.hint("rebalance", *keys)) if files is None else df.coalesce(files)
    # overwriting replaces the partitions that are written, never the whole table
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).option("compression", "zstd" if texts else "snappy").parquet(path)


def counted(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """The frame with its row count (and further metrics) taken while it is written anyway."""
    seen = Observation(name)
    counts = [F.count(F.lit(1)).alias("n_rows"), *(c.alias(n) for n, c in metrics.items())]
    return df.observe(seen, *counts), seen


def split_paths(base: str, flag: str = "possible_spam") -> tuple[str, str]:
    """Where `split_write` puts the rows with a false and with a true flag."""
    return f"{base}/{flag}=false", f"{base}/{flag}=true"


def split_write(
    df: DataFrame,
    base: str,
    flag: str = "possible_spam",
    keys: Sequence[str] = PARTS,
    mode: str = "append",
) -> tuple[str, str]:
    """Write two tables, by a flag, in one pass over the frame; gives their paths."""
    write_partitioned(df, base, [flag, *keys], mode)
    return split_paths(base, flag)


def write_records(posts: DataFrame, path: str, record_id: str = "recordId") -> None:
    """Encoded records as JSON lines."""
    encode_records(posts, record_id).write.mode("append").json(path)


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder of `spark.checkpoint.dir`, for one call.

    Where none is set and Spark runs on one machine, as in trials, it lies under the local temporary
    folder; on a cluster that folder is another one on every machine, so there it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        base = f"file://{tempfile.gettempdir()}"
    return f"{base.rstrip('/')}/mention_pulse/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """The frame written under the shared folder of `spark.checkpoint.dir` and read back.

    For a costly frame used more than once: later reads take only the columns they need, and no
    lost executor can undo the work. Without such a folder the frame is given back as it is. Every
    call has a path of its own, under the application's id; the files may go once the application
    has ended.
    """
    return kept(df, name) if df.sparkSession.conf.get("spark.checkpoint.dir", None) else df


def kept(df: DataFrame, name: str) -> DataFrame:
    """The frame written to a fresh folder and read back: what led to it is not run again."""
    path = fresh_folder(df.sparkSession, name)
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---- runs ----------------------------------------------------------------------------------
def write_snapshot(
    df: DataFrame,
    base: str,
    run_id: str,
    files: int | None = None,
    order: Sequence[str] = (),
    compression: str = "snappy",
) -> None:
    """One run's rows under RUN_ID=<run>; writing the same run again replaces only that run, with no rows too.

    With `order` files hold ranges of these columns, so a look-up by the first reads few of them.
    """
    if not re.fullmatch(r"[\w.-]+", run_id):
        raise ValueError(f"{run_id!r} is no name for a run: letters, digits, _, . and - only")
    out = df.drop(RUN)
    out = out.repartitionByRange(*order).sortWithinPartitions(*order) if order else out
    out = out if files is None else out.coalesce(files)
    out.write.mode("overwrite").option("compression", compression).parquet(f"{base}/{RUN}={run_id}")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Committed runs; empty before the first."""
    try:
        return spark.read.schema(MANIFEST).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def commit_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    parts: Sequence[str] = (),
    rebuilt: Sequence[str] = (),
    chain: Sequence[str] | None = None,
    bounds: tuple[str | None, str | None] = (None, None),
) -> None:
    """Make a run the current one. Call it after all of its tables are written."""
    row = (run_id, list(parts), list(rebuilt), list(chain or [run_id]), *bounds)
    names = [f for f in MANIFEST.fields if f.name != "committed_at"]
    frame = spark.createDataFrame([row], T.StructType(names))
    frame = frame.withColumn("committed_at", F.current_timestamp()).select(*MANIFEST.fieldNames())
    frame.coalesce(1).write.mode("append").parquet(path)


def current_chain(spark: SparkSession, path: str) -> list[str]:
    """Runs whose snapshots add up to the current state, the current run last; empty before the first."""
    latest = read_manifest(spark, path).agg(F.max_by(F.struct("run_id", "chain"), "committed_at").alias("last")).first()["last"]
    return [] if latest is None else latest["chain"] or [latest["run_id"]]


def current_run(spark: SparkSession, path: str) -> str | None:
    """Id of the run committed last."""
    latest = read_manifest(spark, path).agg(F.max_by("run_id", "committed_at"))
    return latest.first()[0]


def read_snapshot(
    spark: SparkSession, base: str, run_id: str | None, schema: T.StructType
) -> DataFrame:
    """Rows of one run, by a pruned scan; no rows when there is no such run yet."""
    return read_snapshots(spark, base, [] if run_id is None else [run_id], schema)


def read_snapshots(spark: SparkSession, base: str, run_ids: Sequence[str], schema: T.StructType) -> DataFrame:
    """Rows of some runs, by a pruned scan; no rows where there are no runs."""
    if not run_ids:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(base).filter(F.col(RUN).isin(list(run_ids)))


def read_runs(
    spark: SparkSession, base: str, manifest: str, schema: T.StructType, keys: Sequence[str]
) -> DataFrame:
    """Rows of all committed runs together, stamped with the latest run.

    A key that several runs wrote has its rows of the latest of them. Filters on the keys still
    reach the scan, and the manifest, one row a run, is joined rather than listed.
    """
    latest = current_run(spark, manifest)
    if latest is None:
        return spark.createDataFrame([], schema)
    runs = read_manifest(spark, manifest).select(F.col("run_id").alias(RUN), "committed_at")
    rows = spark.read.schema(schema).parquet(base).join(runs, RUN)
    by_run = Window.partitionBy(*keys).orderBy(F.desc("committed_at"), F.xxhash64(*schema.fieldNames()))
    kept = rows.withColumn("_nth", F.row_number().over(by_run)).filter("_nth = 1")
    return kept.drop("_nth", "committed_at").withColumn(RUN, F.lit(latest)).select(*schema.fieldNames())


# ---- keyed tables --------------------------------------------------------------------------
def upsert(
    target: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    newest: Column | None = None,
    again: DataFrame | None = None,
) -> DataFrame:
    """Target with the rows of the delta put in by key, the delta winning.

    If a key can occur more than once in the delta, `newest` orders its rows and the last stays.
    The target is only anti-joined by key: no sort of, or window over, the larger side. Where `again`,
    the keys that both hold, is known to be small, it goes to every task and the target stays in place.
    """
    if newest is not None:
        latest = Window.partitionBy(*keys).orderBy(newest.desc())
        delta = delta.withColumn("_nth", F.row_number().over(latest)).filter("_nth = 1").drop("_nth")
    gone = delta.select(*keys) if again is None else F.broadcast(again)
    return target.join(gone, list(keys), "left_anti").unionByName(delta)


# keys written again that are few enough to go to every task
AGAIN_ROWS = 200_000


def append_recent(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Recent posts with the current batch put in: history is neither read again nor regrouped.

    Which keys the batch writes again is found over keys alone; mostly they are few, and then the
    posts with their texts are only filtered. One job counts them.
    """
    keys = ["PARTITION", "TIMESTAMP", "TICKER"]
    again = target.select(*keys).join(batch.select(*keys), keys, "left_semi").distinct()
    n_again = again.limit(AGAIN_ROWS + 1).count()
    if n_again == 0:
        return target.select(*keys, *(c for c in target.columns if c not in keys)).unionByName(batch)
    return upsert(target, batch, keys, again=again if n_again <= AGAIN_ROWS else None)


def recency_layout(recent: DataFrame, partitions: int | None = None) -> DataFrame:
    """Recent posts ordered for reading newest first per spread key.

    Ranges over (key, time) rather than the few keys alone, so the work splits over any number of
    tasks and files carry narrow time bounds; there is no global sort. Texts are left out of it, see `move_rows`.
    """
    order = [F.asc("PARTITION"), F.desc("TIMESTAMP")]
    n = [partitions] if partitions else []
    return move_rows(recent, TEXTS, lambda rows: rows.repartitionByRange(*n, *order).sortWithinPartitions(*order), once=True)


def write_index(rollup: DataFrame, path: str, partitions: int | None = None) -> None:
    """Second copy of the ticker roll-up, laid out for look-ups by (TickerDetail, TIMESTAMP)."""
    order = ["TickerDetail", "TIMESTAMP"]
    ranged = rollup.repartitionByRange(*([partitions] if partitions else []), *order)
    ranged.sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def read_index(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The roll-up laid out by (TickerDetail, TIMESTAMP): filters on these skip most files."""
    return spark.read.schema(schema).parquet(path)


def write_bounds(spark: SparkSession, folder: str, path: str, columns: Sequence[str], schema: T.StructType) -> None:
    """Beside a table: the smallest and largest value of some columns in each of its files, one row a file.

    Only these columns are read, by tasks; a look-up then asks this small table which files to open at all.
    """
    named = [F.col("_metadata.file_name").alias("file"), *columns]
    spans = [f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)]
    rows = spark.read.schema(schema).parquet(folder).select(*named).groupBy("file").agg(*spans)
    write_table(rows, path, files=1)


def may_hold(column: str, low: object | None, high: object | None) -> Column:
    """On rows of `write_bounds`: whether a file may hold a value from `low` to `high`, None being no bound."""
    above = F.lit(True) if low is None else F.col(f"max_{column}") >= F.lit(low)
    return above if high is None else above & (F.col(f"min_{column}") <= F.lit(high))


def refresh(spark: SparkSession, table: str) -> None:
    """Make new partitions of a catalog table, or new files of a path, visible."""
    if "/" in table:
        spark.catalog.refreshByPath(table)
    else:
        spark.catalog.recoverPartitions(table)
        spark.catalog.refreshTable(table)
