"""Page ingest with Structured Streaming.

Landed pages are read once each (the checkpoint keeps the place), flattened, brought to the fixed schema and
appended. The run ends when nothing is left to read.

Answers under folders named by their key go through :func:`ingest_answers`, which keeps the key and the unreadable ones. Where
rows may come late or twice, :func:`marked_late` keeps apart what is later than the watermark instead of losing it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickframe import fixed, schemas
from tickframe.functions.conform import conform
from tickframe.functions.instants import utc_timestamp
from tickframe.operators.filings import first_wins
from tickframe.sinks.tables import error_rows, write_batch
from tickframe.sources.landed import answer_lines, flatten_pages, split_answers


def page_stream(
    spark: SparkSession,
    path: str,
    row: T.StructType = schemas.TRADES,
    extra: str = "",
    max_files: int | None = None,
) -> DataFrame:
    """Rows of landed pages as a stream; empty pages add none, unknown fields are dropped, absent ones are null.

    ``extra`` names further fields of a row, such as ``ticker string``.
    """
    fields = T.StructType(row.fields + (T.StructType.fromDDL(extra).fields if extra else []))
    reader = spark.readStream.schema(schemas.page_envelope(fields))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return conform(flatten_pages(reader.json(path)), fields)


def with_event_time(rows: DataFrame, ts: str = "sip_timestamp") -> DataFrame:
    """Nanoseconds in ``ts`` become the UTC column ``timestamp``; the raw column stays."""
    return rows.withColumn("timestamp", utc_timestamp(F.col(ts)))


def drop_repeats(rows: DataFrame, keys: Sequence[str], delay: str) -> DataFrame:
    """Drop repeats that arrive within ``delay`` of each other; state is kept that long.

    A row later than the watermark is dropped, so this is for sources whose lateness is known. Where it is not,
    ingest everything and use :func:`without_repeats` on the stored table.
    """
    return rows.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(list(keys))


#: Groups that the seen keys are dealt to; each is cut into slices, about so many in all.
STATE_GROUPS, STATE_SLICES = 256, 4096


def marked_late(
    rows: DataFrame, keys: Sequence[str], delay: str, event_time: str = "timestamp", groups: int = STATE_GROUPS
) -> DataFrame:
    """Rows without the repeats that arrive within ``delay`` of each other, with ``late`` for those behind the watermark.

    The watermark is the latest ``event_time`` of the batches before, less ``delay``; it and the keys seen since are kept by
    the checkpoint, so a restarted run goes on where the last one stopped. Late rows are marked, never dropped, and not
    compared: whether they are repeats is for the reader of the stored rows to tell. A row without ``event_time`` is late. State
    holds keys of the last ``delay`` only, dealt to ``groups`` by hash, so no ticker's keys come together; after the first batch,
    which has no watermark yet, all of that batch's. A group's keys are kept in slices: a state is one row, which Spark and Python
    hold whole and several times, so a row must not grow to a group's share of a large batch.
    """
    slices = max(1, STATE_SLICES // groups)
    watched = rows.withWatermark(event_time, delay)
    micros = F.unix_micros(F.col(event_time).cast("timestamp"))
    work = watched.withColumns(
        {
            "_key": F.to_json(F.struct(*keys)),
            "_ms": F.floor(micros / 1000).cast("bigint"),
            "_group": F.pmod(F.xxhash64(*keys), F.lit(groups)).cast("int"),
            "_slice": F.pmod(F.xxhash64(F.lit(slices), *keys), F.lit(slices)).cast("int"),
        }
    )
    names = rows.columns

    def once(_: tuple, pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        seen = dict(zip(*state.get)) if state.exists else {}
        for piece in pieces:
            late = ~(piece["_ms"] >= watermark)
            timely = piece["_key"].where(~late)
            first = ~late & ~timely.duplicated() & ~timely.isin(seen)
            seen.update(zip(piece["_key"][first], piece["_ms"][first].astype(int)))
            yield piece[first | late][names].assign(late=late[first | late])
        kept = {key: ms for key, ms in seen.items() if ms >= watermark}
        state.update((list(kept), list(kept.values())))

    schema = T.StructType([*rows.schema.fields, T.StructField("late", T.BooleanType())])
    seen_schema = T.StructType([T.StructField("keys", T.ArrayType(T.StringType())), T.StructField("times", T.ArrayType(T.LongType()))])
    marked = work.groupBy("_group", "_slice").applyInPandasWithState(once, schema, seen_schema, "append", GroupStateTimeout.NoTimeout)
    # The projection also turns the state operator's columnar rows into those that partitioned writers take.
    return marked.withColumn("late", F.coalesce("late", F.lit(True)))


def answer_stream(spark: SparkSession, path: str, folders: str, max_files: int | None = None) -> DataFrame:
    """Lines of landed answers under ``path`` as a stream; ``folders`` are the columns of the folder names, as DDL."""
    columns = T.StructType.fromDDL(folders)
    reader = spark.readStream.schema(T.StructType([T.StructField("value", T.StringType()), *columns.fields]))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return answer_lines(reader.format("text").load(path), columns.names)


def ingest_answers(
    lines: DataFrame,
    row: T.StructType,
    folders: Sequence[str],
    rows_path: str,
    errors_path: str,
    checkpoint: str,
    logged_at: Column,
    shape: str = "array",
    at: Sequence[str] = ("results",),
) -> StreamingQuery:
    """Rows of an answer stream, with their folders' columns, and its unreadable answers into two tables.

    Both take a folder per batch, which a batch that is run again replaces, so under one checkpoint both hold every answer
    exactly once. The tables belong to that checkpoint; ``batch`` is one of their columns.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            rows, rejects = split_answers(held, row, shape, at, folders)
            write_batch(rows, rows_path, batch_id)
            named = {"ticker": F.col("ticker")} if "ticker" in folders else {}
            reason = F.concat(F.lit("unreadable answer: "), F.left("raw", F.lit(80)))
            write_batch(error_rows(rejects, "page_ingest", logged_at, reason=reason, **named), errors_path, batch_id)
        finally:
            held.unpersist()

    return lines.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def without_repeats(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Stored rows once per key, exact whatever the order of arrival."""
    return first_wins(rows, keys, order)


def append_parquet(rows: DataFrame, path: str, checkpoint: str, partitions: Sequence[str] = ()) -> StreamingQuery:
    """Append the stream to Parquet, everything available now; file sink and checkpoint make it exactly once."""
    return (
        (rows.writeStream.partitionBy(*partitions) if partitions else rows.writeStream)
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def for_first_batch(action: Callable[[DataFrame], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that acts on the first batch only."""

    def run(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 0:
            action(batch)

    return run


def save_debug_sample(
    rows: DataFrame, order: Sequence[str], path: str, checkpoint: str, limit: int = fixed.DEBUG_SAMPLE_ROWS
) -> StreamingQuery:
    """Write up to ``limit`` first rows of the first batch as one CSV, once."""

    def sample(batch: DataFrame) -> None:
        batch.orderBy(*order).limit(limit).write.mode("overwrite").option("header", True).csv(path)

    return (
        rows.writeStream.foreachBatch(for_first_batch(sample))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
