"""Incremental battle-log ingest with Structured Streaming.

Landed JSON files -> ``foreachBatch`` insert-or-ignore into a Parquet table
partitioned by battle month.  The sink is idempotent for every key without a
NULL part (an anti join against the stored keys of the batch's months), so a
micro-batch replayed after a lost executor or driver adds no such row twice; a
late battle is stored whenever it comes.  Rows with a NULL key part never match
stored ones and each delivery of them is kept, as insert-or-ignore does.
Progress lives in the checkpoint under the shared folder.
``available_now=True`` drains what has landed and stops, which is how a
scheduled daily refresh runs it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.writes import insert_ignore
from ..session import CODEC, shared_dir

MONTH = "battle_month"


def with_month(rows: DataFrame) -> DataFrame:
    """Adds the partition column: the ``yyyyMM`` prefix of the battle time."""
    return rows.withColumn(MONTH, F.substring("battleTime", 1, 6))


def create_target(spark: SparkSession, target_dir: str, schema: str) -> None:
    """Write an empty table so that later reads of a missing or damaged one fail."""
    empty = spark.createDataFrame([], f"{schema}, {MONTH} STRING")
    empty.write.mode("ignore").partitionBy(MONTH).parquet(target_dir)


def stream_insert_ignore(spark: SparkSession, source_dir: str, target_dir: str,
                         checkpoint_dir: str, keys: list[str] | None = None,
                         schema: str = S.PLAYER_BATTLE_LOG, fmt: str = "json",
                         available_now: bool = True, max_files_per_trigger: int | None = None,
                         order: list[Column] | None = None):
    """Within a micro-batch the first row of a key stays, in load ``order`` (by
    default the landing file's path)."""
    keys = keys or S.PLAYER_BATTLE_LOG_KEY
    create_target(spark, target_dir, schema)
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.load(source_dir).withColumn("__file", F.col("_metadata.file_path"))

    def sink(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        table = session.read.schema(f"{schema}, {MONTH} STRING").parquet(target_dir)
        # parsed once: the batch is read for its repeated keys, its months and its rows
        folder = shared_dir(session, "stream-batch")
        batch.write.parquet(folder, compression=CODEC)
        rows = with_month(session.read.schema(batch.schema).parquet(folder))
        new = insert_ignore(table, rows, keys, order=order or [F.col("__file")], prune_on=MONTH, stored=True)
        new.hint("rebalance", MONTH).write.mode("append").partitionBy(MONTH).parquet(target_dir, compression=CODEC)
        path = session._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(session._jsc.hadoopConfiguration()).delete(path, True)

    w = src.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
