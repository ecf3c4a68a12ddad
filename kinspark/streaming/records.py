"""Streaming front end: records are scored as they arrive, against tables that do not change. Entity-side aggregates need all
records of an entity and are left to batch queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def run_available(spark: SparkSession, source: str, schema: str, score: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> DataFrame:
    """Apply score to what the Parquet folder or file pattern source holds and has not given yet, append the result to out;
    both out and checkpoint lie in a shared folder, so a restarted run neither loses nor repeats rows."""
    stream = score(spark.readStream.schema(schema).parquet(source))
    query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
