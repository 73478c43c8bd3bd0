"""Sessions processed as they arrive, each once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tracewell.sources.files import write_sessions


def process_new_files(spark: SparkSession, source: str, schema: StructType | str, process: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, key: str = "blockname") -> None:
    """Run `process` over the files below `source` that no earlier run has seen and add its result to the
    dataset of sessions at `target`, a commit a batch, then stop. The checkpoint remembers the files; a batch
    that died and runs again, or that was committed before the checkpoint heard of it, is there once."""

    def handle(batch: DataFrame, number: int) -> None:
        write_sessions(process(batch), target, key=key, token=f"{checkpoint}#{number}")

    stream = spark.readStream.schema(schema).parquet(source)
    run = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(handle).start()
    run.awaitTermination()
