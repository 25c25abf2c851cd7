"""What several training-data operators share: materialised tables, text rules, ranges, components."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import gc
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The white space that separates words: space, tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of a table that are broadcast at most; beyond it the same join is made by shuffling.
BROADCAST_ROWS = 200_000

_written: dict[str, SparkSession] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir or, where it is unset, the checkpoint folder of
    the context or a folder of the warehouse."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or f"{spark.conf.get('spark.sql.warehouse.dir')}/quillon-tables"


def materialise(df: DataFrame, *done: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts the lineage, survives lost executors.

    The table is deleted when this process ends; those in `done`, which nothing reads any more, now.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quillon-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _written:
        atexit.register(_delete_written)
    _written[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._quillon_path = path
    discard(*done)
    return out


@contextlib.contextmanager
def short_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is run meanwhile hands Python batches of so many rows at most: a batch of texts is held by the JVM and by the worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, now = spark.conf.get(name, None), int(spark.conf.get(name))
    spark.conf.set(name, str(min(now, rows) if now > 0 else rows))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def discard(*tables: DataFrame) -> None:
    """Delete materialised tables that nothing reads any more, and have Spark drop the shuffle files of finished plans."""
    for t in tables:
        path = t._quillon_path
        _delete(path, _written.pop(path))
    if tables:
        drop_shuffles(tables[0].sparkSession)


def drop_shuffles(spark: SparkSession) -> None:
    """Spark drops shuffle files once their plans are garbage on the driver; don't wait for it to collect that."""
    for _ in range(2):  # what listeners still hold at first goes in the second round
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def _delete(path: str, spark: SparkSession) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _delete_written() -> None:
    for path, spark in _written.items():
        try:
            _delete(path, spark)
        except Exception:  # the session has ended; the folder's owner clears what is left
            return


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run for mapInArrow; afterwards the worker, which lives on, returns its free memory to the system."""

    @functools.wraps(run)
    def out(batches: Iterator) -> Iterator:
        yield from run(batches)
        release_memory()

    return out


def release_memory() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    ctypes.CDLL(None).malloc_trim(0)


def lower_ascii(c: Column) -> Column:
    """Lower-case A to Z only; the plain lower() serves where every character is one byte."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def wide_hash(c: Column) -> list[Column]:
    """128 bits as two independently seeded xxhash64 values."""
    return [F.xxhash64(c), F.xxhash64(F.lit(0x9E3779B97F4A7C15 - (1 << 64)), c)]


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a materialised table for broadcast only if its counted rows are within the bound."""
    return F.broadcast(df) if df.count() <= rows else df


def splits(df: DataFrame, column: str, parts: int) -> list:
    """Up to parts - 1 ascending values that cut column into ranges of about equal row counts."""
    if parts < 2:
        return []
    at = [k / parts for k in range(1, parts)]
    got = df.agg(F.percentile_approx(column, at, max(10_000, 20 * parts)).alias("q")).first()["q"]
    return sorted(set(got or []))


def range_of(c: Column, cuts: list) -> Column:
    """The number of cuts at or below c (0 for null)."""
    if not cuts:
        return F.lit(0)
    # two levels of about the square root each: one flat comparison with every cut would be slow
    step = max(1, int(len(cuts) ** 0.5))
    heads = cuts[::step]
    top = sum((F.when(c >= h, 1).otherwise(0) for h in heads[1:]), F.when(c >= heads[0], 1).otherwise(0))
    table = F.array(*[F.array(*[F.lit(x) for x in cuts[i * step : (i + 1) * step]]) for i in range(len(heads))])
    block = F.get(table, top - 1)
    inner = F.size(F.filter(block, lambda x: x <= c))
    return F.when(c.isNull() | (top == 0), 0).otherwise((top - 1) * step + inner).cast("int")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges (a, b): (node, component), component = smallest node.

    Alternates large-star and small-star steps. Each step is a minimum per node, taken with partial
    aggregation, and a join of two plainly shuffled tables, so that adaptive execution can split a hub.
    Only nodes that have an edge to another node appear.
    """
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        # large star: each larger neighbour is tied to the smallest of the neighbourhood
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = materialise(large)
        # small star: each smaller neighbour, and the node itself, likewise
        down = materialise(large.groupBy("a").agg(F.min("b").alias("m")))
        joined = large.join(down, "a")
        nxt = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(down.select("a", F.col("m").alias("b")))
        before, now = now, materialise(nxt.where("a <> b").distinct())
        for t in (before, least, large, down):
            _delete(t._quillon_path, _written.pop(t._quillon_path))
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    # a star forest: every node points to its centre, the smallest node
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b"), F.col("b")).distinct())
