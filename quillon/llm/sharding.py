"""Sharding by a minimax contiguous partition of ordered atomic groups."""

from __future__ import annotations

import bisect
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from quillon.llm.common import documents, materialise, range_of, splits, wide_hash

#: Groups that one block of the ordered sequence holds, about, and blocks at most.
BLOCK_GROUPS, MAX_BLOCKS = 20_000, 4096
#: Group sizes that the search holds on the driver at a time, at most.
WINDOW_GROUPS = 1_000_000
#: Documents of one counting bucket, about, and buckets at most.
BUCKET_DOCS, MAX_BUCKETS = 4_000, 4096


class Sequence:
    """Ends of the ordered groups as running totals, of which the driver knows one for each block.

    blocks: (total before the block, total at its end, number of groups) in order; fetch(ks) returns
    the ascending running totals after each group of each block in ks. Only blocks in which a cut may
    fall are asked for, and WINDOW_GROUPS totals are held at most, or one block.
    """

    def __init__(self, blocks: list[tuple[int, int, int]], fetch: Callable[[list[int]], dict[int, list[int]]], largest: int):
        self.blocks, self.fetch, self.largest = blocks, fetch, largest
        self.ends = [b for _, b, _ in blocks]
        self.total = self.ends[-1] if blocks else 0
        self.held: dict[int, list[int]] = {}

    def load(self, blocks: list[int]) -> None:
        if need := [k for k in blocks if k not in self.held]:
            self.held |= self.fetch(need)
        while len(self.held) > 1 and sum(map(len, self.held.values())) > WINDOW_GROUPS:
            self.held.pop(next(k for k in self.held if k != blocks[-1]))

    def ahead(self, low: int, high: int, shards: int) -> None:
        """Load all blocks in which a cut of any capacity from low to high may fall, if they are few groups."""
        ks = set()
        for j in range(1, shards + 1):
            i = bisect.bisect_left(self.ends, j * (low - self.largest))
            ks.update(range(i, min(len(self.ends) - 1, bisect.bisect_left(self.ends, j * high)) + 1))
        if sum(self.blocks[k][2] for k in ks) <= WINDOW_GROUPS:
            self.load(sorted(ks))

    def furthest(self, start: int, capacity: int) -> int:
        """The largest running total that is at most start + capacity."""
        if start + capacity >= self.total:
            return self.total
        k = bisect.bisect_left(self.ends, start + capacity + 1)  # the block in which the limit falls
        self.load([k])
        here = bisect.bisect_right(self.held[k], start + capacity)
        return self.held[k][here - 1] if here else self.blocks[k][0]

    def cuts(self, capacity: int, shards: int) -> list[int] | None:
        """Greedy cuts for a capacity, or None if it is too small."""
        out, at = [], 0
        for _ in range(shards):
            at = self.furthest(at, capacity)
            out.append(at)
            if at >= self.total:
                return out
        return None

    def best(self, shards: int) -> list[int]:
        """Cuts of the smallest capacity under which the greedy check needs at most so many shards."""
        low, high = max(self.largest, -(-self.total // shards)), self.largest + -(-self.total // shards)
        self.ahead(low, high, shards)
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if self.cuts(mid, shards) is not None else (mid + 1, high)
        return self.cuts(low, shards) or []


def shard_by_size(docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Deal documents to contiguous shards whose largest is as small as can be.

    Equal texts are one atomic group (null counts as the empty text); groups are ordered by their
    smallest doc_id, nulls first. A document's size is its UTF-8 bytes plus 1. The capacity is found
    by binary search with a greedy check, which cuts as late as it can, so trailing shards may stay
    empty where groups are few. The driver sees totals of blocks and the groups of the few blocks in
    which a cut may fall. slot numbers a shard's rows from 0 without gaps. Rows that repeat are rows
    of their own. Adds size, text_crc32, shard and slot (input columns of these names are replaced).
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    names = ("size", "text_crc32", "shard", "slot")
    whole = F.coalesce(F.col(text), F.lit(""))
    first, second = wide_hash(whole)
    marked = docs.withColumns({"size": F.octet_length(whole).cast("long") + 1, "text_crc32": F.crc32(whole.cast("binary")), "__h1": first, "__h2": second, "__id": F.col(doc_id)})
    others = [c for c in docs.columns if c not in names and c != text]
    rows = materialise(marked.select(*others, "size", "text_crc32", "__h1", "__h2", "__id"))

    # a hot text is summed before it is shuffled
    nulls = F.max(F.col("__id").isNull())
    groups = materialise(rows.groupBy("__h1", "__h2").agg(F.when(nulls, None).otherwise(F.min("__id")).alias("__first"), F.sum("size").alias("__sum")))
    n, largest = groups.agg(F.count("*"), F.max("__sum")).first()
    if not n:
        return rows.select(*others, "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    parts = max(1, min(MAX_BLOCKS, -(-n // BLOCK_GROUPS), n))
    blocked = groups.withColumn("__b", range_of(F.col("__first"), splits(groups, "__first", max(parts, min(n // 64, 256)))))
    order = Window.partitionBy("__b").orderBy(F.col("__first").asc_nulls_first(), "__h1", "__h2").rowsBetween(Window.unboundedPreceding, 0)
    totals = {r[0]: (r[1], r[2]) for r in blocked.groupBy("__b").agg(F.sum("__sum"), F.count("*")).collect()}
    blocks, at, starts = [], 0, []
    for k in sorted(totals):
        blocks.append((at, at + totals[k][0], totals[k][1]))
        starts.append((k, at))
        at += totals[k][0]
    table = spark.createDataFrame(starts, "__b int, __start long")
    placed = materialise(blocked.withColumn("__run", F.sum("__sum").over(order)).join(F.broadcast(table), "__b").withColumn("__end", F.col("__start") + F.col("__run")).select("__h1", "__h2", "__b", "__end"))
    ids = [k for k, _ in starts]

    def fetch(ks: list[int]) -> dict[int, list[int]]:
        got: dict[int, list[int]] = {k: [] for k in ks}
        back = {ids[k]: k for k in ks}
        for b, end in placed.where(F.col("__b").isin(list(back))).select("__b", "__end").collect():
            got[back[b]].append(end)
        return {k: sorted(v) for k, v in got.items()}

    cuts = Sequence(blocks, fetch, largest).best(shards)
    shard = sum((F.when(F.col("__end") > c, 1).otherwise(0) for c in cuts[:-1]), F.lit(0)).cast("int")
    # both sides are plain shuffles, so adaptive execution can split a hot text
    dealt = materialise(rows.join(placed.select("__h1", "__h2", shard.alias("shard")), ["__h1", "__h2"]).drop("__h1", "__h2"))
    return number(dealt, "shard", "__id").select(*others, "size", "text_crc32", "shard", "slot")


def number(rows: DataFrame, key: str, doc_id: str) -> DataFrame:
    """slot: gapless numbers from 0 within each key, whatever the size of a key.

    Rows are numbered in buckets by a hash of the id; a bucket starts where the smaller ones end.
    """
    buckets = max(1, min(MAX_BUCKETS, rows.count() // BUCKET_DOCS))
    put = rows.withColumn("__bucket", F.pmod(F.xxhash64(F.col(doc_id).cast("string"), F.lit(11)), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(key).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = put.groupBy(key, "__bucket").agg(F.count("*").alias("__c")).withColumn("__base", F.coalesce(F.sum("__c").over(before), F.lit(0))).drop("__c")
    within = Window.partitionBy(key, "__bucket").orderBy(doc_id, "size")
    # at most keys * MAX_BUCKETS rows: a bounded table
    return put.withColumn("__r", F.row_number().over(within)).join(F.broadcast(counts), [key, "__bucket"]).withColumn("slot", (F.col("__base") + F.col("__r") - 1).cast("long")).drop("__bucket", "__base", "__r")


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_by_size(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
