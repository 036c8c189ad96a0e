"""Starting streams and reading what they wrote.

Results of a micro-batch go to ``out/batch_id=N`` with overwrite, so a batch that is run again after a failure replaces
its own output and every row counts once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

BatchHandler = Callable[[DataFrame, int], None]


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int | None = None, **options) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def start(df: DataFrame, handler: BatchHandler, checkpoint: str, mode: str = "append", continuous: str | None = None) -> StreamingQuery:
    """Start the stream; without ``continuous`` (a processing-time interval) it stops when the available input is done."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(handler)
    return (writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)).start()


def run_to_end(df: DataFrame, handler: BatchHandler, checkpoint: str, mode: str = "append") -> None:
    start(df, handler, checkpoint, mode).awaitTermination()


def write_batch(df: DataFrame, out: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")


def read_batches(spark: SparkSession, out: str, schema: T.StructType | str) -> DataFrame:
    """All batches, with ``batch_id``; the schema is stated so that a stream without output reads as empty."""
    typed = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    return spark.read.schema(T.StructType([*typed.fields, T.StructField("batch_id", T.LongType())])).parquet(out)
