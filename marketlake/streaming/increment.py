"""STR-1: the daily increment as Structured Streaming.

Landed drops (parquet or JSON Lines files) arrive in a directory.  A
file-source stream with a fixed schema picks up only files it has not seen
(tracked in the checkpoint), removes duplicate keys across all drops
(``dropDuplicates`` keeps the seen keys in the RocksDB state store), removes
keys already in the static target (stream–static ``left_anti`` join), and
appends the rest to the target's parquet directory.

``trigger(availableNow=True)`` processes everything present and stops, so
the same code serves a scheduled daily run and a catch-up; the checkpoint
makes a re-run (or a retry after a lost executor) add nothing twice.  With
``watermark`` set, deduplication becomes ``dropDuplicatesWithinWatermark``
on the event-time column, which bounds the state for unbounded streams.

``run_increment_load`` is the form for a published warehouse: every batch is
one idempotent commit, and late rows go to a table of their own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.temporal import time_id
from ..operators.merge import insert_new
from ..session import materialise, scratch_scope
from ..sinks.publish import Load


def run_increment(spark: SparkSession, landing_dir: str, schema: T.StructType,
                  target: DataFrame, keys: list[str], out_dir: str, checkpoint_dir: str,
                  fmt: str = "parquet", watermark: tuple[str, str] | None = None,
                  max_files_per_trigger: int | None = None) -> None:
    """Run the increment to completion (``availableNow``) and return."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(landing_dir)
    if watermark:
        col, delay = watermark
        stream = stream.withWatermark(col, delay).dropDuplicatesWithinWatermark(keys)
    else:
        stream = stream.dropDuplicates(keys)
    new_rows = stream.join(target.select(*keys), keys, "left_anti")
    query = (new_rows.writeStream.format("parquet")
             .option("path", out_dir)
             .option("checkpointLocation", checkpoint_dir)
             .outputMode("append")
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


class LateRows:
    """Which rows of a batch are late: older than the newest event of the batches before, less a delay."""

    def __init__(self, event_time: str, delay: str):
        self.event_time, self.delay = event_time, delay

    def split(self, batch: DataFrame, newest: str | None) -> tuple[DataFrame, DataFrame]:
        if newest is None:
            return batch, batch.limit(0)
        bound = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {self.delay}")
        late = F.coalesce(F.col(self.event_time) < bound, F.lit(False))
        return batch.where(~late), batch.where(late)


def apply_batch(batch: DataFrame, batch_id: int, stream: str, root: str, name: str, keys: list[str], day_col: str, late: LateRows) -> dict[str, int]:
    """One batch of a stream as one commit: new keys into the day-partitioned table ``name``, those that come late into ``{name}_late``.

    The target is read again for every batch, as of the newest commit, and only the days that the batch touches.  The commit
    also notes the batch id and the newest event time, so a batch that is replayed, after a crash
    or from an older checkpoint, finds its note and adds nothing.  Rows with a null key part or day can't be stored and count as late."""
    spark = batch.sparkSession
    load = Load(spark, root)
    seen, times = f"stream {stream}", f"stream {stream} newest"
    if str(batch_id) in load.notes(seen):
        return {"new": 0, "late": 0}
    with scratch_scope(spark):
        rows = materialise(batch.withColumn(day_col, time_id(late.event_time)), "stream-batch")
        newest = max(load.notes(times), default=None)
        whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in [*keys, day_col]])
        new = insert_new(load.read(name, rows.schema), rows.where(whole), [*keys, day_col], prune_on=day_col)
        timely, tardy = late.split(materialise(new.select(*rows.columns), "stream-new"), newest)
        tardy = tardy.unionByName(rows.where(~whole))
        added = {"new": load.append(name, timely, partition_by=day_col),
                 "late": load.append(f"{name}_late", tardy.withColumn("batch_id", F.lit(batch_id).cast("long")))}
        top = rows.agg(F.max(late.event_time).cast("string")).first()[0]  # one value
        load.note(seen, str(batch_id))
        if top is not None and (newest is None or top > newest):
            load.forget(times)
            load.note(times, top)
        load.commit()
    return added


def run_increment_load(spark: SparkSession, landing_dir: str, schema: T.StructType, root: str, name: str, keys: list[str],
                       event_time: str, delay: str, checkpoint_dir: str, day_col: str = "time_id", fmt: str = "parquet",
                       max_files_per_trigger: int | None = None) -> None:
    """STR-1 into a published warehouse: new files of a directory, batch by batch through :func:`apply_batch`, to completion.

    The source keeps track of files, the table itself of keys (a key belongs to the day of its event), so the stream holds no
    state of its own however long it runs; nothing is dropped silently."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    late = LateRows(event_time, delay)
    query = (reader.load(landing_dir).writeStream
             .foreachBatch(lambda batch, i: apply_batch(batch, i, name, root, name, keys, day_col, late) and None)
             .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
