"""Starting streams: replayable sinks, recovery from a shared checkpoint."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from firnline.session import shared_folder

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State store able to hold more state than memory, needed by stateful processors."""
    spark.conf.set(STATE_STORE, ROCKSDB)


@contextmanager
def state_partitions(spark: SparkSession, n: int):
    """State partitions of the streams started inside (fixed at first start)."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def batch_writer(out: str) -> Callable[[DataFrame, int], None]:
    """Writes each batch to its own folder, so a replayed batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return write


def start(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    available_now: bool = True,
    interval: str = "5 seconds",
) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def run_to_table(stream: DataFrame, mode: str = "append", timeout: int | None = None) -> DataFrame:
    """Process all data now there and read the result back as a table."""
    spark = stream.sparkSession
    use_rocksdb(spark)
    folder = shared_folder(spark, "stream")
    query = start(stream, batch_writer(f"{folder}/out"), f"{folder}/checkpoint", mode)
    query.awaitTermination(timeout) if timeout else query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return spark.read.schema(stream.schema).option("recursiveFileLookup", True).parquet(f"{folder}/out")
