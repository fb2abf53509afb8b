"""Readers of landed files: API pages, JSON lines, target lists, tick history, file inventories."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fnmatch import fnmatchcase

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickframe import schemas
from tickframe.operators.history import parse_inventory
from tickframe.operators.refdata import unique_tickers
from tickframe.sinks.tables import LAYOUT, full_uri

CORRUPT = "_corrupt_record"


def flatten_pages(pages: DataFrame, results: Column | None = None) -> DataFrame:
    """Rows of all pages; a page without results, or that is no object, adds none.

    ``results`` is the array to take, ``results`` by default, ``F.col("results.values")`` for indicators.
    """
    rows = pages.select(F.explode(F.col("results") if results is None else results).alias("_row"))
    return rows.filter(F.col("_row").isNotNull()).select("_row.*")


def read_pages(spark: SparkSession, path: str, row: T.StructType, *at: str) -> DataFrame:
    """Landed API pages under ``path`` as one table of ``row``; ``at`` names the way to the array."""
    pages = spark.read.schema(schemas.page_envelope(row, *at)).json(path)
    return flatten_pages(pages, F.col(".".join(at or ("results",))))


def read_answers(
    spark: SparkSession, path: str, row: T.StructType, shape: str = "array", at: tuple[str, ...] = ("results",)
) -> tuple[DataFrame, DataFrame]:
    """(rows, unreadable answers with their file) of landed answers, one answer a line.

    ``shape`` tells where an answer holds its rows: an ``array`` or one ``object`` at ``at``, or a ``root_array``, the
    answer itself. Columns that folder names hold, such as the ticker that was asked for, come with every row of the
    answers below them.
    """
    text = spark.read.text(path)
    folders = [name for name in text.columns if name != "value"]
    rows, rejects = split_answers(answer_lines(text, folders), row, shape, at, folders)
    return rows, rejects.select("file_name", "raw")


def answer_lines(text: DataFrame, folders: Sequence[str] = ()) -> DataFrame:
    """Lines of a text table that hold anything, with their folders' columns and their file; of a stream as well."""
    return text.filter(F.trim("value") != "").select("value", *folders, F.col("_metadata.file_name").alias("file_name"))


def split_answers(
    lines: DataFrame, row: T.StructType, shape: str = "array", at: Sequence[str] = ("results",), folders: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(rows, unreadable answers as ``raw`` with their file and folders) of :func:`answer_lines`."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    if shape == "root_array":
        answers = lines.withColumn("_rows", F.from_json("value", T.ArrayType(row)))
        readable = F.col("_rows").isNotNull()
    else:
        node: T.DataType = T.ArrayType(row) if shape == "array" else row
        for name in reversed(at):
            node = T.StructType([T.StructField(name, node)])
        answers = lines.withColumn("_answer", F.from_json("value", node.add(CORRUPT, "string"), options))
        found = F.col(".".join(("_answer", *at)))
        answers = answers.withColumn("_rows", found if shape == "array" else F.array(found)).withColumn("_found", found)
        readable = F.col("_answer").isNotNull() & F.col(f"_answer.{CORRUPT}").isNull() & F.col("_found").isNotNull()
    own = [name for name in folders if name not in row.names]
    rows = answers.filter(readable).select(*own, F.explode("_rows").alias("_row")).filter(F.col("_row").isNotNull())
    rejects = answers.filter(~F.coalesce(readable, F.lit(False))).select(*folders, "file_name", F.col("value").alias("raw"))
    return rows.select(*own, "_row.*"), rejects


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(readable records, unreadable lines with their file) of JSON lines.

    Lines are read as text and parsed once per branch, so the unreadable ones can be counted without a cache. Columns
    that folder names hold are columns of the records; where the record has one of the same name and a value, that counts.
    ``ordinal`` orders records by file, place of the split in the file and line.
    """
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    text = spark.read.text(path)
    folders = [name for name in text.columns if name != "value"]
    lines = text.select(
        "value",
        *folders,
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line"),
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = lines.filter(F.trim("value") != "").withColumn("_record", F.from_json("value", marked, options))
    unreadable = F.col("_record").isNull() | F.col(f"_record.{CORRUPT}").isNotNull()
    own = [
        F.coalesce(F.col(f"_record.{f.name}"), F.col(f.name).cast(f.dataType)).alias(f.name)
        if f.name in folders
        else F.col(f"_record.{f.name}").alias(f.name)
        for f in schema.fields
    ]
    more = [name for name in folders if name not in schema.names]
    good = parsed.filter(~unreadable).select(*own, *more, F.struct("file_name", "block_start", "line").alias("ordinal"))
    bad = parsed.filter(unreadable).select("file_name", F.col("value").alias("raw"))
    return good, bad


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headed CSV by column name: columns in any order, further ones passed over, absent ones null.

    All columns are read as text, so leading zeros survive, and then cast. One header holds for the files under ``path``.
    """
    found = spark.read.option("header", True).csv(path)
    return found.select(
        *[
            F.col(f"`{field.name}`").try_cast(field.dataType).alias(field.name)
            if field.name in found.columns
            else F.lit(None).cast(field.dataType).alias(field.name)
            for field in schema.fields
        ]
    )


def read_csv_if_present(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """:func:`read_csv`, or an empty table when ``path`` does not exist."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
    return read_csv(spark, path, schema) if exists else spark.createDataFrame([], schema)


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_if_present(spark, path, schemas.TARGETS)


def read_cik_targets(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.CIK_TARGETS)


def read_download_list(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_if_present(spark, path, schemas.DOWNLOAD_LIST)


def read_ticks(spark: SparkSession, root: str, *columns: str) -> DataFrame:
    """Tick history of every ticker at once, only the named columns plus the partition columns."""
    ticks = spark.read.parquet(root)
    return ticks.select(*columns) if columns else ticks


def read_dataset(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A dataset stored under its layout, with the values of its folders as text, as they were written.

    Left to itself, Spark would read a folder ``ticker=0012`` as the number 12.
    """
    path = f"{root}/{name}"
    found = spark.read.parquet(path).schema
    fields = [T.StructField(f.name, T.StringType()) if f.name in LAYOUT[name] else f for f in found.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def _listed(spark: SparkSession, pattern: str) -> list:
    """File states that match ``pattern``; a listing, no file is opened."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return list(target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target) or [])


def latest_ticker_list(spark: SparkSession, root: str, asset_class: str) -> DataFrame:
    """Unique tickers of the newest list of an asset class stored under ``snapshot_date`` and ``run`` folders.

    The run is chosen from folder names and read alone, so lists with other columns beside it don't matter.
    """
    runs = [s.getPath() for s in _listed(spark, f"{root}/asset_class={asset_class}/snapshot_date=*/run=*") if s.isDirectory()]
    if not runs:
        return spark.createDataFrame([], "ticker string")
    newest = max(runs, key=lambda p: (p.getParent().getName(), int(p.getName().partition("=")[2])))
    return unique_tickers(spark.read.option("header", True).csv(newest.toString()))


def latest_file(spark: SparkSession, pattern: str) -> DataFrame:
    """Rows of the most recently changed file among those that match ``pattern``, of the last by name among equals.

    The file is chosen by listing and read alone, under its own header.
    """
    files = _listed(spark, pattern)
    if not files:
        raise FileNotFoundError(pattern)
    newest = max(files, key=lambda s: (s.getModificationTime(), s.getPath().toString()))
    return spark.read.option("header", True).csv(newest.getPath().toString())


def history_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Inventory of history files under ``root``; only paths and sizes are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return parse_inventory(files.select("path", "length"))


def tick_files(inventory: DataFrame) -> DataFrame:
    """Tick files of every ticker, one row per file."""
    return inventory.filter((F.col("fidelity") == "tick") & (F.col("extension") == "parquet"))


#: Files that a task of a listing sends on at once.
_LISTED_AT_ONCE = 10_000


def stored_listing(spark: SparkSession, root: str, pattern: str, path: str) -> DataFrame:
    """``path`` and ``length`` of all files under ``root`` whose names match ``pattern``, stored at ``path`` and read back.

    Spark's own listing holds all files on the driver and plans a few a task, as if it would read them. Here the driver holds what
    lies directly under ``root``; tasks list what is below, a folder at a time. The files are listed once, however often the
    listing is read. As for Spark, names that begin with a dot or an underscore are hidden.
    """
    uri = full_uri(spark, root)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = FileSystem.from_uri(uri)
        found = []

        def listed() -> pa.RecordBatch:
            paths = [root.rstrip("/") + info.path[len(base):] for info in found]
            return pa.record_batch({"path": pa.array(paths, pa.string()), "length": pa.array([info.size for info in found], pa.int64())})

        for batch in batches:
            ahead = store.get_file_info([base + child for child in batch.column("child").to_pylist()])
            while ahead:
                info = ahead.pop()
                if info.base_name.startswith((".", "_")):
                    continue
                if info.type == FileType.Directory:
                    ahead += store.get_file_info(FileSelector(info.path))
                elif info.type == FileType.File and fnmatchcase(info.base_name, pattern):
                    found.append(info)
                if len(found) == _LISTED_AT_ONCE:
                    yield listed()
                    found.clear()
        yield listed()

    store, base = FileSystem.from_uri(uri)
    children = [(info.path[len(base):],) for info in store.get_file_info(FileSelector(base))]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = spark.createDataFrame(children, "child string").repartition(parts)
    dealt.mapInArrow(walk, "path string, length bigint").write.parquet(path)
    return spark.read.schema("path string, length bigint").parquet(path)


def tick_universe(inventory: DataFrame) -> DataFrame:
    """Tickers that have tick files, with the number and size of those files."""
    return tick_files(inventory).groupBy("ticker").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))


def history_universe(inventory: DataFrame) -> DataFrame:
    """Tickers that appear anywhere in the history layout."""
    return unique_tickers(inventory)
