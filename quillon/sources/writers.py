"""Sinks: partitioned documents, metadata as JSON, and side effects by partition."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from quillon.functions.ids import celex_base


def write_documents(docs: DataFrame, path: str) -> None:
    """Documents by kind and year of the act, language and version, so that reads of one prune the rest."""
    b = celex_base(F.col("celex"))
    docs.withColumns({"pre": b["pre"], "year": b["year"]}).write.mode("overwrite").partitionBy("pre", "year", "language").parquet(path)


def write_heads(records: DataFrame, path: str) -> None:
    """One JSON object per act; absent values are left out."""
    records.select(F.to_json(F.struct(*records.columns)).alias("value")).write.mode("overwrite").text(path)


def send(rows: DataFrame, connect: Callable[[], Callable[[dict], bool]]) -> DataFrame:
    """rows with `sent`: whether a service took each. One connection a partition; the caller injects address and credentials.

    Calls are made when the result is written, so write it once, and send again what isn't in it or wasn't
    sent. A task that is tried again repeats its calls: the service must take a row twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = None
        for b in batches:
            call = call or connect()
            yield b.append_column("sent", pa.array([bool(call(r)) for r in b.to_pylist()], pa.bool_()))

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("sent", BooleanType())]))


def with_stubs(docs: DataFrame, stub: str) -> DataFrame:
    """Documents without a refined body show a stub, and say so in their state."""
    missing = F.col("refined").isNull()
    return docs.withColumns({"transformation": F.when(missing & F.col("transformation").isNull(), "stubbed").otherwise(F.col("transformation")), "refined": F.coalesce("refined", F.format_string(stub, "celex"))})
