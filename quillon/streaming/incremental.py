"""Incremental registry refresh: hits arrive as files, and each batch is merged into the registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quillon.operators.registry import newest_hits, upsert


def refresh(spark: SparkSession, incoming: str, schema: str, registry: str, checkpoint: str) -> StreamingQuery:
    """Merge all files that arrived since the last run, then stop.

    incoming holds JSON hits (celex, ord, in_force, publication_date, language). Every batch writes a
    new version of the registry next to the old one, so a batch that is repeated after a failure reads
    the version it read before and comes to the same result.
    """

    def merge(batch: DataFrame, number: int) -> None:
        new = newest_hits(batch).select("celex", "in_force", "publication_date")
        if number > 0:
            new = upsert(spark.read.parquet(f"{registry}/{number - 1}"), new, ["celex"], ["in_force", "publication_date"])
        new.write.mode("overwrite").parquet(f"{registry}/{number}")

    stream = spark.readStream.schema(schema).json(incoming)
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
