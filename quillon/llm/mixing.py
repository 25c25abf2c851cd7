"""Mixing sources to target weights by pivotal dependent rounding over a reduction tree."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from quillon.llm.common import documents, materialise

#: Rows that one node of the reduction tree combines, on average.
FAN_IN = 512
#: Probabilities nearer to 0 or 1 are integral.
TINY = 1e-12
#: Weights of the sources in code point order, null last, repeating.
WEIGHTS = (3.0, 1.0, 2.0)


def targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> dict[str | None, float]:
    """What each source gives: share of all sizes by weight, at most `most` times its own size.

    What a source can't give is shared by weight among the sources below their limit, until none is
    above it. Where every source is at its limit, the rest stays unassigned.
    """
    names = sorted((k for k in sizes if k is not None), key=lambda k: k) + [k for k in sizes if k is None]
    weight = {k: weights[i % len(weights)] for i, k in enumerate(names)}
    left, full, free = share * sum(sizes.values()), {}, set(names)
    while free:
        unit = left / sum(weight[k] for k in free)
        over = [k for k in names if k in free and weight[k] * unit >= most * sizes[k]]
        if not over:
            return full | {k: weight[k] * unit for k in free}
        for k in over:
            full[k] = most * sizes[k]
            left -= full[k]
            free.discard(k)
        left = max(0.0, left)
    return full


def pivot(prob: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Pivotal rounding: every probability becomes 0 or 1 but for one at most.

    Two fractional documents trade mass until one is integral. The trade keeps the expected copies of
    each, and the sum of size times probability exactly, so what is taken stays at the target.
    """
    p = prob.astype(float).copy()
    draws = rng.random(len(p))
    held = -1
    for j in range(len(p)):
        if not TINY < p[j] < 1 - TINY:
            p[j] = round(p[j])
            continue
        if held < 0:
            held = j
            continue
        i, a, b = held, float(size[held]), float(size[j])
        up = min((1 - p[i]) * a, p[j] * b)  # mass that i can take from j
        down = min(p[i] * a, (1 - p[j]) * b)
        d = up if draws[j] * (up + down) < down else -down
        p[i] += d / a
        p[j] -= d / b
        i_done, j_done = (not TINY < p[k] < 1 - TINY for k in (i, j))
        if i_done:
            p[i] = round(p[i])
        if j_done:
            p[j] = round(p[j])
        held = -1 if i_done and j_done else j if i_done else i
    return p


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", size: str = "size", seed: int = 7, fan_in: int = FAN_IN, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Add source_size, target and copies to docs (doc_id, source, size and whatever columns follow).

    A source's rate is its target over its size: each document gets the whole part in copies and one
    more with the rate's fraction as probability, rounded dependently: the first level of a reduction
    tree pairs documents in random groups of about fan_in, the next pairs what each group leaves over,
    until one document of each source is left, which is drawn by its probability. Documents of size 0
    get no copies (0 words either way). Sums per source are the only thing that the driver sees, so
    sources must be far fewer than documents. Random numbers come from seed, source and document only,
    so that reruns agree; rows that repeat in id, source and size are interchangeable. Null ids and
    sources are values like others. An empty table gives an empty result.
    """
    per = {r[0]: (r[1] or 0, r[2]) for r in docs.groupBy(source).agg(F.sum(size), F.count("*")).collect()}
    goal = targets({k: v[0] for k, v in per.items()}, weights, share, most)
    spark = docs.sparkSession
    rows = [(k, per[k][0], float(goal[k]), goal[k] / per[k][0] if per[k][0] else 0.0, per[k][1]) for k in per]
    table = spark.createDataFrame(rows, "__s string, source_size long, target double, __rate double, __n long")
    taken = [c for c in docs.columns if c not in ("source_size", "target", "copies")]
    base = docs.select(*taken).join(F.broadcast(table), F.col(source).eqNullSafe(F.col("__s")), "left")
    whole = F.floor("__rate")
    base = base.withColumns({"copies": F.when(F.col(size) > 0, whole).otherwise(0).cast("long"), "__p": F.when(F.col(size) > 0, F.col("__rate") - whole).otherwise(F.lit(0.0))})
    base = base.withColumn("__h", F.xxhash64(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.col(size))).drop("__s", "__rate")
    fields = base.withColumn("__b", F.lit(0).cast("long")).schema

    def node(level: int, last: bool):
        def combine(group: pa.Table) -> pa.Table:
            # large documents settle first, so that what is left over at the end is small
            group = group.take(np.lexsort((group["__h"].to_numpy(), -group[size].to_numpy())))
            rng = np.random.default_rng([seed, level, int(group["__h"][0].as_py()) & 0xFFFFFFFF, len(group)])
            p = pivot(group["__p"].to_numpy(), group[size].to_numpy(), rng)
            if last:
                p = np.where((p > TINY) & (p < 1 - TINY), rng.random(len(p)) < p, p).astype(float)
            done = (p < TINY) | (p > 1 - TINY)
            copies = group["copies"].to_numpy() + np.where(done, np.round(p), 0).astype("int64")
            group = group.set_column(group.schema.get_field_index("copies"), "copies", pa.array(copies, pa.int64()))
            return group.set_column(group.schema.get_field_index("__p"), "__p", pa.array(np.where(done, 0.0, p), pa.float64()))

        return combine

    levels = max(1, math.ceil(math.log(max([2, *(n for _, n in per.values())])) / math.log(fan_in)))
    now, out = base, None
    for level in range(levels):
        last = level == levels - 1
        nodes = F.lit(1) if last else F.greatest(F.lit(1), F.ceil(F.col("__n") / fan_in ** (level + 1)))
        keyed = now.withColumn("__b", F.pmod(F.xxhash64(F.lit(level), "__h"), nodes).cast("long"))
        got = materialise(keyed.groupBy(source, "__b").applyInArrow(node(level, last), fields))
        settled, now = got.where(F.col("__p") == 0.0), got.where(F.col("__p") != 0.0).drop("__b")
        out = settled if out is None else out.unionByName(settled)
    return out.drop("__p", "__h", "__b", "__n")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    docs = documents(spark, sf_dir).select("doc_id", "source", words.alias("size"))
    out = mix_sources(docs)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")
