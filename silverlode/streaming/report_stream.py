"""The execution history as a stream of files (C11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pyspark.sql import functions as F

from silverlode.operators.report import ATTEMPTS, merged_state, partial_state
from silverlode.sources.history import history_schema, normalise_history
from silverlode.sources.layers import Layer


def history_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """New JSON-lines files as normalised records; broken lines are dropped as in the batch reader."""
    raw = (
        spark.readStream.schema(history_schema())
        .option("mode", "DROPMALFORMED")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(folder)
    )
    return normalise_history(raw)


def refresh_report(spark: SparkSession, folder: str, report: str, checkpoint: str) -> StreamingQuery:
    """Add what is new since the last call to the report and stop. The checkpoint makes every file count once, also
    after a crash; there is no state to keep."""
    return (
        history_stream(spark, folder)
        .writeStream.format("parquet")
        .option("path", report)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def attempt_stream(spark: SparkSession, folder: str, lateness: str, files_per_batch: int = 1000) -> DataFrame:
    """New files of attempts (``ATTEMPTS`` as JSON lines), each record once however often its file is replayed.

    ``lateness``: how much older than the newest record a late one or a replay may be. Ids are remembered for that long, and
    older records are dropped. Records without an id, an execution or a time are dropped.
    """
    raw = spark.readStream.schema(ATTEMPTS).option("mode", "DROPMALFORMED").option("maxFilesPerTrigger", files_per_batch).json(folder)
    whole = raw.where("record_id IS NOT NULL AND execution_id IS NOT NULL AND at IS NOT NULL")
    return whole.withWatermark("at", lateness).dropDuplicatesWithinWatermark(["record_id"])


def refresh_state(spark: SparkSession, folder: str, layer: Layer, checkpoint: str, lateness: str) -> StreamingQuery:
    """Merge what is new since the last call into the report's state, a versioned table, and stop.

    Every micro-batch is one version: its sums per execution are merged into the files that hold these executions, and no
    figure is computed again. A version names the last micro-batch in it, so one that is repeated after a crash is left
    out. Memory holds ids inside the lateness only; the state of the executions is the table.
    """

    def take(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        part = partial_state(batch).withColumn("batch", F.lit(number).cast("long"))
        if not layer.has_data():
            layer.write(part)
        elif layer.files(layer.latest()).agg(F.max("high batch")).first()[0] < number:
            layer.merge_keys(part, ["execution_id"], merged_state())

    return (
        attempt_stream(spark, folder, lateness)
        .writeStream.foreachBatch(take)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
