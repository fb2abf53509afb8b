"""Table writers. All leave the work to Spark's committers: a lost executor repeats a task, not a file."""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickframe import schemas
from tickframe.functions.conform import conform
from tickframe.functions.instants import standardize_timestamp

# Partition columns per dataset folder.
LAYOUT = {
    "trading_history": ["fidelity", "ticker", "month"],
    "technicals": ["indicator", "ticker"],
    "corporate_actions": ["action"],
    "fundamentals": ["name"],
    "ticker_lists": ["asset_class", "snapshot_date", "run"],
    "macro": ["series"],
    "filings": ["ticker", "year"],
}


def _save(
    df: DataFrame,
    path: str,
    fmt: str,
    mode: str = "error",
    partitions: Sequence[str] = (),
) -> int:
    """Write once, counting rows on the way; a fresh path that received none is removed. Gives the row count."""
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.save(path)
    rows = seen.get["rows"]
    if rows == 0 and mode in ("error", "errorifexists"):
        target = hadoop_path(df.sparkSession, path)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)
    return rows


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def full_uri(spark: SparkSession, path: str) -> str:
    """``path`` with its file system, for workers: a scheme that ``pyarrow.fs`` knows, as it does ``file`` and ``hdfs``."""
    target = hadoop_path(spark, path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toUri().toString()


def write_csv(df: DataFrame, path: str, mode: str = "error") -> int:
    """Headed CSV; empty input leaves nothing behind. Gives the number of rows."""
    return _save(df, path, "csv", mode)


def write_parquet(df: DataFrame, path: str, timestamp: str | None = "t", mode: str = "error") -> int:
    """Snappy Parquet with the time stamp column standardised; empty input leaves nothing behind."""
    if timestamp and timestamp in df.columns:
        df = standardize_timestamp(df, timestamp)
    return _save(df, path, "parquet", mode)


def write_both(df: DataFrame, parquet_path: str, csv_path: str, timestamp: str = "date", mode: str = "error") -> int:
    """The same table as Parquet, time stamp standardised, and as CSV, left as it came."""
    write_csv(df, csv_path, mode)
    return write_parquet(df, parquet_path, timestamp, mode)


def write_dataset(df: DataFrame, root: str, name: str, mode: str = "append", fmt: str = "parquet") -> int:
    """Write ``df`` under the dataset's folder and partition columns; gives the number of rows.

    Rows are rebalanced by the partition columns, so a folder gets a few files, and a partition that holds much
    of the data is still written by many tasks.
    """
    columns = [column for column in LAYOUT[name] if column in df.columns]
    return _save(spread_by(df, columns), f"{root}/{name}", fmt, mode, columns)


def spread_by(df: DataFrame, columns: Sequence[str], many_files: bool = False) -> DataFrame:
    """Group rows by ``columns`` for writing; the rebalance hint lets adaptive execution split large groups.

    With ``many_files`` the number of files is the work, not their size: rows are dealt to all shuffle partitions, which
    adaptive execution does not merge by size. Each group is then written by one task, so it must not be large.
    """
    if many_files:
        return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)
    return df.hint("rebalance", *[F.col(column) for column in columns])


def write_named(df: DataFrame, root: str, name: str) -> int:
    """Store the rows of each value of ``name`` as one Parquet file of that path below ``root``; gives the number of files.

    For many small files. On a local folder Spark's writer takes 8 ms a file and more, as it starts a process to set the rights of
    each file, check sum and folder; here a file takes some tenths of a millisecond. Rows are dealt to all shuffle partitions by ranges of
    names: a task writes neighbouring folders, a folder of many files is shared by tasks, and a file is written as its rows
    come, whatever their number. It gets its name when it is whole: a task that runs again or twice writes the same files again.
    """
    uri = full_uri(df.sparkSession, root)
    at, path = FileSystem.from_uri(uri)
    at.create_dir(path, recursive=True)
    columns = [column for column in df.columns if column != name]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = FileSystem.from_uri(uri)
        mark, files = uuid.uuid4().hex, 0
        now = inside = draft = sink = writer = None

        def finish() -> None:
            writer.close()
            sink.close()
            store.move(draft, f"{base}/{now}")

        for batch in batches:
            runs = pc.run_end_encode(batch.column(name))
            rows, start = batch.select(columns), 0
            for value, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if value is None:
                    raise ValueError(f"a row without {name}")
                if value != now:
                    if now is not None:
                        finish()
                    now, files = value, files + 1
                    folder, _, file = f"{base}/{value}".rpartition("/")
                    if folder != inside:
                        store.create_dir(inside := folder, recursive=True)
                    sink = store.open_output_stream(draft := f"{folder}/.{file}-{mark}")
                    writer = pq.ParquetWriter(sink, rows.schema, compression="snappy", store_schema=False)
                writer.write_batch(rows.slice(start, end - start))
                start = end
        if now is not None:
            finish()
        yield pa.record_batch({"files": pa.array([files], pa.int64())})

    dealt = df.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), name)
    return dealt.sortWithinPartitions(name).mapInArrow(write, "files bigint").agg(F.sum("files")).first()[0] or 0


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch of a stream as ``batch=<id>``; a batch that is run again replaces its own folder."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def replace_partitions(df: DataFrame, path: str, columns: Sequence[str], fmt: str = "parquet") -> None:
    """Replace exactly the partitions present in ``df``; all others stay."""
    (
        spread_by(df, columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .format(fmt)
        .partitionBy(*columns)
        .save(path)
    )


def replace_job(df: DataFrame, expected: DataFrame, path: str, columns: Sequence[str], fmt: str = "parquet") -> None:
    """Replace all partitions of a job: those in ``df`` by it, and ``expected`` ones that the reload left empty by nothing.

    ``expected`` holds the partition values of one job, as many as it has months.
    """
    spark = df.sparkSession
    replace_partitions(df, path, columns, fmt)
    empty = expected.select(*columns).distinct().join(df.select(*columns).distinct(), list(columns), "left_anti")
    for row in empty.toLocalIterator():
        folder = hadoop_path(spark, "/".join([path, *[f"{name}={row[name]}" for name in columns]]))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def append_filing_sections(records: DataFrame, path: str) -> int:
    """Append section records as JSON under (ticker, year); records without a filing year must be split off first."""
    return _save(spread_by(records, ["ticker", "year"]), path, "json", "append", ["ticker", "year"])


_RUNS, _STAGED = "_runs", "_staged"


def _content(df: DataFrame) -> dict[str, Column]:
    """Aggregates that tell the content of a table apart whatever the order of its rows."""
    row = F.xxhash64(*df.columns)
    return {"rows": F.count(F.lit(1)), "mixed": F.bit_xor(row), "added": F.sum(F.pmod(row, F.lit(1 << 24)))}


def append_once(df: DataFrame, path: str, batch: str, partitions: Sequence[str] = (), fmt: str = "json") -> int:
    """Append a batch of rows that can be sent any number of times; gives the rows that this call added.

    The batch is written whole under a hidden folder, its content is told on the way, and then it is published by one
    rename to ``batch=<batch>``. A file per batch in the ledger beside the data says what was published. A batch that the
    ledger has is not written again; with other content it is refused. A run that stopped anywhere before its entry
    in the ledger is simply repeated. One writer per batch at a time.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", batch):
        raise ValueError(f"batch name {batch!r}")
    spark = df.sparkSession
    entry, staged, target = (hadoop_path(spark, f"{path}/{place}") for place in (f"{_RUNS}/{batch}", f"{_STAGED}/{batch}", f"batch={batch}"))
    fs = entry.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(entry):
        known = json.loads(spark.read.text(entry.toString()).first()[0])
        again = df.agg(*(c.alias(name) for name, c in _content(df).items())).first().asDict()
        if known != again:
            raise ValueError(f"batch {batch} was published with other content: {known}, now {again}")
        return 0
    if df.isEmpty():
        content = {"rows": 0, "mixed": None, "added": None}
    else:
        seen = Observation()
        watched = df.observe(seen, *(c.alias(name) for name, c in _content(df).items()))
        spread_by(watched, partitions).write.mode("overwrite").format(fmt).partitionBy(*partitions).save(staged.toString())
        content = {name: seen.get[name] for name in _content(df)}
    fs.delete(target, True)
    if content["rows"] and not fs.rename(staged, target):
        raise OSError(f"could not publish {target}")
    fs.delete(staged, True)
    fs.mkdirs(entry.getParent())
    with_entry = fs.create(entry, False)
    with_entry.write(json.dumps(content).encode())
    with_entry.close()
    return content["rows"]


def published(spark: SparkSession, path: str) -> DataFrame:
    """The ledger: ``batch`` and the number of ``rows`` of each published batch."""
    lines = spark.read.text(f"{path}/{_RUNS}/*")
    rows = F.get_json_object("value", "$.rows").cast("bigint").alias("rows")
    return lines.select(F.col("_metadata.file_name").alias("batch"), rows)


def next_run(spark: SparkSession, path: str, snapshot_date: dt.date) -> int:
    """First free run number of a snapshot day, 0 for the first."""
    root = hadoop_path(spark, f"{path}/snapshot_date={snapshot_date.isoformat()}")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return 0
    taken = [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(root) if "run=" in s.getPath().getName()]
    return max(taken, default=-1) + 1


def write_run(df: DataFrame, path: str, snapshot_date: dt.date, fmt: str = "csv") -> int:
    """Write a report as a new run of the day, never over an old one; gives the run number, -1 for no rows."""
    run = next_run(df.sparkSession, path, snapshot_date)
    rows = _save(df, f"{path}/snapshot_date={snapshot_date.isoformat()}/run={run}", fmt)
    return run if rows else -1


def error_rows(rejected: DataFrame, script_name: str, logged_at, **columns) -> DataFrame:
    """Rejected rows in the error-log schema; ``columns`` maps log columns to expressions."""
    named = {"log_timestamp_utc": F.date_format(logged_at, "yyyy-MM-dd'T'HH:mm:ss"), "script_name": F.lit(script_name)}
    return conform(rejected.select("*", *[c.alias(f"_{n}") for n, c in {**named, **columns}.items()]).select(
        *[F.col(f"_{name}").alias(name) for name in (*named, *columns)]
    ), schemas.ERROR_LOG)


def append_errors(errors: DataFrame, path: str, source: str) -> int:
    """Append to the one error table, by source; gives the number of errors."""
    return _save(errors.withColumn("source", F.lit(source)), path, "parquet", "append", ["source"])
