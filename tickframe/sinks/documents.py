"""Documents per ticker, written as ordered part files with a manifest that says which file follows which."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_documents(blocks: DataFrame, order: Sequence[str], path: str, parts: int | None = None) -> None:
    """Write ordered blocks as text under ``ticker=<ticker>``.

    Blocks are range-partitioned by their order, so the part files of a ticker, read by name, are its document,
    and a ticker with very many blocks is spread over many tasks. The text writer ends each row with a line feed,
    so one line feed of the block itself, at its end or else its start, is left to it.
    """
    block = F.col("block")
    written = (
        F.when(block.endswith("\n"), F.expr("left(block, length(block) - 1)"))
        .when(block.startswith("\n"), F.expr("substr(block, 2)"))
        .otherwise(block)
    )
    ranged = blocks.repartitionByRange(parts, *order) if parts else blocks.repartitionByRange(*order)
    (
        ranged.sortWithinPartitions(*order)
        .select("ticker", written.alias("block"))
        .write.mode("error")
        .partitionBy("ticker")
        .text(path)
    )


MANIFEST = "_manifest"


def _ticker_of(path: Column) -> Column:
    """The key that a folder of the path names, as Spark's writer escapes it; null for its name of nulls."""
    raw = F.regexp_extract(path, r"/ticker=([^/]*)/[^/]*$", 1)
    return F.when(raw != "__HIVE_DEFAULT_PARTITION__", F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))))


def write_manifest(spark: SparkSession, path: str) -> DataFrame:
    """List the files of written documents in their order and keep the list beside them.

    ``ticker``, ``sequence`` (from 1), ``file`` (below ``path``), ``bytes`` and ``before`` (bytes of the document ahead of the file). The
    order is that of the tasks that wrote the files, each of which had one range of the documents, and of a task's files
    by number; only names and sizes are read. A ticker has at most a few files per task.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(path)
    own = files.filter(~F.col("path").contains(f"/{MANIFEST}/")).select("path", F.col("length").alias("bytes"))
    name = F.element_at(F.split("path", "/"), -1)
    written = own.select(
        _ticker_of(F.col("path")).alias("ticker"),
        F.array_join(F.slice(F.split("path", "/"), -2, 2), "/").alias("file"),
        "bytes",
        F.regexp_extract(name, r"^part-(\d+)", 1).cast("bigint").alias("_task"),
        F.regexp_extract(name, r"[.-]c(\d+)", 1).cast("bigint").alias("_number"),
    )
    by = Window.partitionBy("ticker").orderBy("_task", "_number")
    before = F.coalesce(F.sum("bytes").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    listed = written.select("ticker", F.row_number().over(by).alias("sequence"), "file", "bytes", before.alias("before"))
    listed.write.mode("overwrite").parquet(f"{path}/{MANIFEST}")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{MANIFEST}")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all documents with their place: ``ticker``, ``line_no`` (from 1), ``line``.

    The order comes from the manifest, not from file names. Lines are numbered within the pieces that tasks read and shifted by the
    lines of the pieces ahead, so no document comes together in one task.
    """
    place = F.col("_metadata.file_path")
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").text(path)
    lines = text.filter(~place.contains(f"/{MANIFEST}/")).select(
        F.col("value").alias("line"),
        # A path in metadata is encoded once more than the one a listing gives.
        F.array_join(F.slice(F.split(F.url_decode(F.replace(place, F.lit("+"), F.lit("%2B"))), "/"), -2, 2), "/").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    piece = ["file", "_block"]
    own = lines.withColumn("_own", F.row_number().over(Window.partitionBy(*piece).orderBy("_line")))
    counts = lines.groupBy(*piece).agg(F.count(F.lit(1)).alias("_n")).join(read_manifest(spark, path), "file")
    ahead = Window.partitionBy("ticker").orderBy("sequence", "_block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("ticker", *piece, F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_shift"))
    return own.join(shifts, piece).select("ticker", (F.col("_shift") + F.col("_own")).alias("line_no"), "line")
