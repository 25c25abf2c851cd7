"""Embedding near-dedup by product quantisation over inverted lists."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from quillon.llm.common import components, materialise, tidied

#: Cosine from which two vectors are linked.
COSINE = 0.93
#: Vectors that the quantisers are fitted on, at most; inverted lists by vectors, at least and at most.
SAMPLE, LIST_SIZE, MIN_LISTS, MAX_LISTS = 20_000, 256, 8, 4096
#: Subspaces and code words of the residual codes.
SUBSPACES, CODES = 8, 256
#: Standard deviations, over random directions, that a linked vector may lie across the border of a list.
SIGMAS = 2.5
#: Members of a list, and queries, that one task compares.
BLOCK = 1024


def kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """Centres of x; fewer than k where x has fewer distinct rows."""
    x = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        a = nearest(x, c)
        n = np.bincount(a, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, a, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None])


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([squares(x[i : i + 4096], c).argmin(1) for i in range(0, len(x), 4096)])


class Quantiser:
    """Coarse centres and, for residuals to them, code words of each subspace. Works on unit vectors."""

    def __init__(self, sample: np.ndarray, lists: int, subspaces: int = SUBSPACES, codes: int = CODES, cosine: float = COSINE):
        self.centres = kmeans(sample, lists)
        self.cuts = np.array_split(np.arange(sample.shape[1]), min(subspaces, sample.shape[1]))
        rest = sample - self.centres[nearest(sample, self.centres)]
        self.words = [kmeans(rest[:, s], codes) for s in self.cuts]
        self.reach = math.sqrt(2 - 2 * cosine)
        self.margin = SIGMAS * self.reach / math.sqrt(sample.shape[1])
        between = np.sqrt(squares(self.centres, self.centres))
        self.between = np.where(between > 0, between, np.inf)

    def lists(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Of each vector its list, and the lists whose border is within the margin, its own included."""
        d = squares(x, self.centres)
        own = d.argmin(1)
        across = (d - d[np.arange(len(x)), own][:, None]) / (2 * self.between[own])
        across[np.arange(len(x)), own] = 0
        return own, [np.flatnonzero(r) for r in across <= self.margin]

    def encode(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the distance of each vector from what they stand for."""
        rest = x - self.centres[own]
        codes = np.stack([nearest(rest[:, s], w) for s, w in zip(self.cuts, self.words)], 1).astype(np.uint8)
        back = np.concatenate([w[codes[:, i]] for i, w in enumerate(self.words)], 1)
        return codes, np.sqrt(((rest - back) ** 2).sum(1))

    def near(self, query: np.ndarray, centre: int, codes: np.ndarray, error: np.ndarray) -> np.ndarray:
        """Members of a list that the query may be linked with: by table lookups, the distance to the coded vector is
        at most the reach and the member's own coding error (so none is lost by the codes)."""
        rest = query - self.centres[centre]
        squared = np.zeros(len(codes))
        for i, (s, w) in enumerate(zip(self.cuts, self.words)):
            squared += ((rest[s] - w) ** 2).sum(1)[codes[:, i]]
        return np.flatnonzero(np.sqrt(squared) <= self.reach + error + 1e-6)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), float)


def near_vectors(vectors: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of vectors linked where labels are equal and the cosine is high enough.

    Vectors that are null, zero, or hold null or non-finite components, and vectors without label or
    id, link with nothing, as do vectors of different lengths. Equal vectors of a label are one class:
    links are found between classes and counted with their sizes, so copies are not paired. Each row
    is a vector, also if its id repeats. component_id is the smallest vec_id that links reach.

    The quantisers are fitted on at most `sample` classes, every class is in an inverted list, and
    every class is looked up in its own list and those whose border lies within SIGMAS deviations of
    the linking distance; a link is missed only if it crosses more than that in both directions.
    Candidates by asymmetric distances are confirmed by the cosine of the full vectors in double
    precision. A long list, or one with many queries, is compared in blocks, each of which returns counts
    and a spanning forest. Other columns don't matter, whatever their names; an empty table gives an empty one.
    """
    spark = vectors.sparkSession
    kind, label_kind = dict(vectors.dtypes)[vec_id], dict(vectors.dtypes)[label]
    e = F.col(embedding)
    fine = e.isNotNull() & F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(e, lambda v: v != 0)
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), e.alias("embedding"), F.coalesce(fine & F.col(label).isNotNull() & F.col(vec_id).isNotNull(), F.lit(False)).alias("fine"))
    classes = materialise(rows.where("fine").groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")))
    found = None
    for length, count in sorted(map(tuple, classes.groupBy(F.size("embedding").alias("length")).count().collect())):
        some = _links(classes.where(F.size("embedding") == length), count, cosine, sample, block, kind, label_kind)
        found = some if found is None else found.unionByName(some)
    if found is None:
        found = spark.createDataFrame([], f"rep {kind}, other {kind}, m long")
    found = materialise(found)
    counted = materialise(found.where("other is null").groupBy("rep").agg(F.sum("m").alias("m")))
    links = found.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b"))
    parts = materialise(components(links).select(F.col("node").alias("rep"), F.col("component").alias("component_id")))
    known = materialise(classes.join(counted, "rep", "left").join(parts, "rep", "left").select("label", "embedding", (F.col("n") - 1 + F.coalesce("m", F.lit(0))).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id")))
    linked = rows.where("fine").join(known, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    lone = rows.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(lone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links(classes: DataFrame, count: int, cosine: float, sample: int, block: int, kind: str, label_kind: str) -> DataFrame:
    """What classes of one vector length and equal labels are linked with: rows (rep, null, m), m to be added up, and
    rows (rep, other, null) of links that join all that are linked: of each block a spanning forest, not all pairs."""
    spark = classes.sparkSession
    drawn = np.array([r[0] for r in classes.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("embedding").collect()], float)
    drawn /= np.linalg.norm(drawn, axis=1)[:, None]
    fitted = spark.sparkContext.broadcast(Quantiser(drawn, max(MIN_LISTS, min(MAX_LISTS, count // LIST_SIZE)), cosine=cosine))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = fitted.value
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column("embedding"))
            x /= np.linalg.norm(x, axis=1)[:, None]
            own, probes = q.lists(x)
            codes, error = q.encode(x, own)
            # a vector is a member of its own list, and a query to each list it probes
            at = np.repeat(np.arange(len(x)), [len(p) + 1 for p in probes])
            lists = np.concatenate([np.r_[o, p] for o, p in zip(own, probes)]).astype(np.int32)
            member = np.concatenate([np.r_[True, np.zeros(len(p), bool)] for p in probes])
            take = b.take(pa.array(at))
            coded = [codes[i].tobytes() if m else None for i, m in zip(at, member)]
            asks = [probes[i].tolist() if m else [own[i]] for i, m in zip(at, member)]
            cols = [*(take.column(c) for c in ("rep", "label", "n", "embedding")), pa.array(lists), pa.array(member), pa.array(coded, pa.binary()), pa.array(error[at]), pa.array(asks, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(cols, names=["rep", "label", "n", "embedding", "list", "member", "codes", "error", "asks"])

    spread = materialise(classes.select("rep", "label", "n", "embedding").mapInArrow(tidied(assign), f"rep {kind}, label {label_kind}, n long, embedding {dict(classes.dtypes)['embedding']}, list int, member boolean, codes binary, error double, asks array<int>"))
    sizes = materialise(spread.groupBy("label", "list").agg(F.ceil(F.count_if("member") / block).cast("int").alias("m"), F.ceil(F.count_if(~F.col("member")) / block).cast("int").alias("q")).where("m > 0 and q > 0"))
    here = F.pmod(F.xxhash64("rep"), F.when(F.col("member"), F.col("m")).otherwise(F.col("q"))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("member"), F.col("q")).otherwise(F.col("m")) - 1))
    dealt = spread.join(sizes, ["label", "list"]).withColumn("here", here).withColumn("there", other)
    dealt = dealt.withColumns({"x": F.when(F.col("member"), F.col("here")).otherwise(F.col("there")), "y": F.when(F.col("member"), F.col("there")).otherwise(F.col("here"))})

    def compare(group: pa.Table) -> pa.Table:
        q, is_member = fitted.value, group["member"].to_numpy()
        members, queries = group.filter(pa.array(is_member)), group.filter(pa.array(~is_member))
        kinds = pa.schema([("rep", group["rep"].type), ("other", group["rep"].type), ("m", pa.int64())])
        if not len(members) or not len(queries):
            return kinds.empty_table()
        x, y = _matrix(members["embedding"]), _matrix(queries["embedding"])
        long_x, long_y = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
        codes = np.array([np.frombuffer(c, np.uint8) for c in members["codes"].to_pylist()])
        error, centre = members["error"].to_numpy(), group["list"][0].as_py()
        names, place = np.unique(np.concatenate([members["rep"].to_numpy(), queries["rep"].to_numpy()]), return_inverse=True)
        mine, asking = place[: len(x)], place[len(x) :]
        size, roots, counts = np.concatenate([members["n"].to_numpy(), queries["n"].to_numpy()]), np.arange(len(names)), np.zeros(len(names), np.int64)
        n_x, n_y, probed = size[: len(x)], size[len(x) :], [set(p) for p in members["asks"].to_pylist()]
        a, b = [], []
        for i, home in enumerate(queries["asks"].to_pylist()):
            some = q.near(y[i] / long_y[i], centre, codes, error)
            some = some[(x[some] @ y[i]) / (long_x[some] * long_y[i]) >= cosine]
            some = some[mine[some] != asking[i]]
            if not len(some):
                continue
            # a pair is counted where the smaller one asks or, if the larger doesn't ask the smaller's list, there
            once = some[(asking[i] < mine[some]) | np.array([home[0] not in probed[j] for j in some.tolist()])]
            counts[asking[i]] += n_x[once].sum()
            np.add.at(counts, mine[once], n_y[i])
            for r in np.unique(roots[mine[some]]).tolist():
                if r != roots[asking[i]]:
                    a.append(asking[i])
                    b.append(mine[some][roots[mine[some]] == r][0])
                    roots[roots == r] = roots[asking[i]]
        there = np.flatnonzero(counts)
        return pa.Table.from_arrays([pa.array(np.concatenate([names[there], names[np.array(a, int)]]), kinds.field(0).type), pa.array([*[None] * len(there), *names[np.array(b, int)].tolist()], kinds.field(1).type), pa.array([*counts[there].tolist(), *[None] * len(a)], pa.int64())], schema=kinds)

    shape = f"rep {kind}, other {kind}, m long"
    return dealt.select("rep", "n", "embedding", "list", "member", "codes", "error", "asks", "label", "x", "y").groupBy("label", "list", "x", "y").applyInArrow(compare, shape)


def op2_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))


ORACLE = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.93
), r AS (SELECT vec_id AS node, vec_id AS root FROM v UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.node),
c AS (SELECT node, min(root) AS component_id FROM r GROUP BY node),
n AS (SELECT a, count(*) AS k FROM l GROUP BY a)
SELECT v.vec_id, coalesce(n.k, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN c ON c.node = v.vec_id LEFT JOIN n ON n.a = v.vec_id
"""
