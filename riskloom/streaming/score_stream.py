"""Scoring a stream of files with a saved model: the scoring chain is stateless."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from riskloom.plans import bundle


def score_stream(
    spark: SparkSession, bundle_path: str, in_path: str, schema: StructType, out_path: str, checkpoint: str, once: bool = True
) -> StreamingQuery:
    """Each micro-batch is scored as a table and appended as parquet under its batch number.

    A batch that is run again overwrites its own folder, so a restart repeats nothing.
    """
    fitted = bundle.load(spark, bundle_path)

    def score_batch(df, batch_id: int) -> None:
        fitted.score(df).write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch={batch_id}")

    writer = (
        spark.readStream.schema(schema).parquet(in_path).writeStream.foreachBatch(score_batch)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
