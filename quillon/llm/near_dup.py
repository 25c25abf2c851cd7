"""MinHash near-dedup with compressed HyperMinHash registers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from quillon.llm.common import components, discard, documents, materialise, small, tidied

#: Words of a shingle, and the similarity from which two documents are linked.
SHINGLE, SIMILARITY = 4, (80, 100)
#: Bands of the signature and registers of a band.
BANDS, ROWS = 32, 5
#: Bits of a register's mantissa; the leading zeros take the six above.
MANTISSA = 10
#: Members of a bucket that are compared with each other in one task.
BLOCK = 256
#: How far the estimate may fall below the similarity before a pair is given up: over six standard deviations.
SLACK = 0.2
LOCAL_WORDS = 300_000

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


class Hashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = xxhash.xxh3_64_intdigest(word)
        return n

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > LOCAL_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles."""

    def __init__(self, size: int = SHINGLE):
        self.size, self.known = size, Hashes()

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if not words:
            return np.empty(0, np.uint64)
        h = self.known.of(words)
        n = max(1, len(h) - self.size + 1)
        out = np.full(n, min(len(h), self.size), np.uint64)
        for i in range(min(len(h), self.size)):
            out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
        return np.unique(out)


def registers(shingles: np.ndarray, count: int = BANDS * ROWS) -> np.ndarray:
    """HyperMinHash: of the least hash of each bucket the leading zeros and the first mantissa bits. 0: an empty bucket."""
    out = np.zeros(count, np.uint16)
    if not len(shingles):
        return out
    h = _mixed(shingles ^ np.uint64(0xD6E8FEB86659FD93))
    bucket = ((h >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)
    low = _mixed(h + np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
    order = np.lexsort((low, bucket))
    bucket, low = bucket[order], low[order]
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    least = low[first]
    # shift the leading one out, keep the next bits
    zeros = np.zeros(len(least), np.uint64)
    rest = least.copy()
    for step in (32, 16, 8, 4, 2, 1):
        free = rest < (np.uint64(1) << np.uint64(64 - step))
        zeros += np.where(free, np.uint64(step), np.uint64(0))
        rest = np.where(free, rest << np.uint64(step), rest)
    mantissa = (rest << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    # the number of leading zeros is below 48 but for sets of over 2 ** 48, so 63 - zeros is not 0 there
    out[bucket[first]] = ((np.uint64(63) - zeros) << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    return out


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from matching registers (rows of a and b), corrected for chance collisions.

    Two independent minima of rates x and y agree in a register with probability about
    c * x * y / (x + y) ** 2 with c = 2 ** -MANTISSA / (2 ln 2).
    """
    used = (a > 0) | (b > 0)
    same = ((a == b) & used).sum(1)
    n_a, n_b = n_a.astype(float), n_b.astype(float)
    chance = 2.0**-MANTISSA * 0.7213475 * n_a * n_b / np.maximum(n_a + n_b, 1) ** 2
    return np.maximum(0.0, (same / np.maximum(used.sum(1), 1) - chance) / (1 - chance))


def band_keys(regs: np.ndarray, bands: int = BANDS) -> list[tuple[int, int]]:
    """Number and key of each band that has a register in use; the key is a hash of number and registers."""
    each = regs.reshape(bands, -1)
    return [(i, xxhash.xxh3_64_intdigest(each[i].tobytes(), seed=i + 1) - (1 << 63)) for i in range(bands) if each[i].any()]


def first_shared(one: np.ndarray, others: np.ndarray, bands: int) -> np.ndarray:
    """The first band in which a signature agrees with each of the others."""
    a, b = one.reshape(bands, -1), others.reshape(len(others), bands, -1)
    return ((a == b).all(2) & a.any(1)).argmax(1)


def sketches(docs: DataFrame, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, digest, regs): one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(size)
        for b in batches:
            sets = [shingle(t.as_py()) for t in b.column(1)]
            columns = [pa.array([len(s) for s in sets], pa.int64()), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([registers(s, bands * rows).tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["doc_id", "n_shingles", "digest", "regs"])

    return docs.select(F.col(doc_id).alias("doc_id"), text).mapInArrow(tidied(run), f"doc_id {dict(docs.dtypes)[doc_id]}, n_shingles long, digest binary, regs binary")


def _column(b: pa.RecordBatch, name: str, kind: str) -> np.ndarray:
    return np.array([np.frombuffer(x, kind) for x in b.column(name).to_pylist()])


def estimated(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose registers and sizes allow the similarity. Each side is joined by a plain shuffle. Materialised."""
    side = lambda n: classes.select(F.col("rep").alias(n), F.col("n_shingles").alias(f"n_{n}"), F.col("regs").alias(f"r_{n}"))
    one = materialise(pairs.join(side("a"), "a"))
    both = one.join(side("b"), "b").where(F.least("n_a", "n_b") * SIMILARITY[1] >= F.greatest("n_a", "n_b") * SIMILARITY[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                score = estimate(_column(b, "r_a", "<u2"), _column(b, "r_b", "<u2"), b.column("n_a").to_numpy(), b.column("n_b").to_numpy())
                yield b.filter(pa.array(score >= least)).select(["a", "b"])

    return materialise(both.mapInArrow(run, pairs.select("a", "b").schema), one)


def verified(pairs: DataFrame, docs: DataFrame, size: int = SHINGLE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Pairs (a, b) whose full shingle sets are similar: 100 * intersection >= 80 * union. Materialised."""
    ids = materialise(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b"))).distinct())
    need = materialise(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")).join(small(ids), "id", "left_semi").dropDuplicates(["id"]))
    one = materialise(pairs.join(need.select(F.col("id").alias("b"), F.col("t").alias("t_b")), "b"))
    both = one.join(need.select(F.col("id").alias("a"), F.col("t").alias("t_a")), "a").select("a", "b", "t_a", "t_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, last, held = Shingler(size), None, np.empty(0, np.uint64)
        for b in batches:
            keep = []
            for a, t_a, t_b in zip(b.column("a").to_pylist(), b.column("t_a"), b.column("t_b")):
                if a != last:
                    last, held = a, shingle(t_a.as_py())
                other = shingle(t_b.as_py())
                common = len(np.intersect1d(held, other, assume_unique=True))
                keep.append(common * SIMILARITY[1] >= (len(held) + len(other) - common) * SIMILARITY[0])
            yield b.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return materialise(both.mapInArrow(tidied(run), pairs.select("a", "b").schema), ids, need, one)


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): connected components of documents that are similar.

    A document's set is its distinct shingles of `size` words (A-Z lower-cased, between white space);
    a shorter text is one shingle. Documents are linked if 100 * intersection >= 80 * union of their
    full sets. Null and empty texts have no shingles and no links. component_id is the smallest doc_id
    that links reach; kept marks it. doc_id is taken to be unique; rows that repeat it with the same
    text come back as often, and null ids are components of their own. Other columns don't matter,
    whatever their names, and an empty table gives an empty one.

    Equal sets are one class and are compared once. Classes meet in buckets of equal bands. First
    each class is compared with the smallest of its bucket. Then, only in buckets that still hold
    several components, members of different components are compared in blocks, by their registers
    and then on full sets, so that no link between components is lost and a bucket of copies costs one
    comparison a member. Every link is confirmed on full sets. At the similarity of 0.8 the bands miss a pair with a
    probability of 3e-6.
    """
    sketch = materialise(sketches(docs, size, bands, rows, text, doc_id))
    valid = sketch.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = materialise(valid.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("regs").alias("regs")))
    kind = dict(sketch.dtypes)["doc_id"]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [band_keys(np.frombuffer(r, "<u2"), bands) for r in b.column("regs").to_pylist()]
            at = np.repeat(np.arange(b.num_rows), [len(k) for k in keys])
            yield pa.RecordBatch.from_arrays([b.column("rep").take(pa.array(at)), pa.array([x for k in keys for _, x in k], pa.int64()), pa.array([i for k in keys for i, _ in k], pa.int32())], names=["rep", "band", "no"])

    def banded() -> DataFrame:
        return classes.select("rep", "regs").mapInArrow(spread, f"rep {kind}, band long, no int")

    heads = materialise(banded().groupBy("band").agg(F.min("rep").alias("head"), F.count("*").alias("n")).where("n > 1"))
    members = materialise(banded().join(heads.select("band", "head"), "band"))
    stars = materialise(members.where("rep <> head").select(F.col("head").alias("a"), F.col("rep").alias("b")).distinct())
    least = SIMILARITY[0] / SIMILARITY[1] - SLACK
    links = verified(estimated(stars, classes, least), docs, size, text, doc_id)
    parts = materialise(components(links))

    # buckets in which several components are left
    placed = materialise(members.join(parts.withColumnRenamed("node", "rep"), "rep", "left").select("band", "no", "rep", F.coalesce("component", "rep").alias("component")))
    mixed = materialise(placed.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n")).where("lo <> hi").select("band", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    some = materialise(placed.join(mixed, "band"))
    left = materialise(some.join(classes.select("rep", "n_shingles", "regs"), "rep"), some)
    links = links.union(_across(left, docs, kind, least, size, bands, text, doc_id))
    final = materialise(components(links))
    discard(heads, members, stars, placed, mixed, left, parts)

    by_class = materialise(classes.select("digest", F.col("rep").alias("node")).join(final, "node", "left").select("digest", F.coalesce("component", "node").alias("component")))
    discard(classes, final)
    linked = valid.select("doc_id", "n_shingles", "digest").join(by_class, "digest").select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    lone = sketch.where(F.col("doc_id").isNull() | (F.col("n_shingles") == 0)).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return materialise(linked.unionByName(lone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))), sketch, by_class)


def _across(left: DataFrame, docs: DataFrame, kind: str, least: float, size: int, bands: int, text: str, doc_id: str) -> DataFrame:
    """Links (a, b) between members of one bucket but of two components, enough to join all that are linked.

    A bucket is dealt to blocks by a hash of its members, and each pair of blocks is a group, so a
    group is of a bounded size whatever the bucket's. A pair that shares several bands is looked at in
    the first of them. First the registers tell which members have any partner; those come again with
    their texts, and their full sets are compared. A group returns a spanning forest of its links, not
    all of them: at most one link less than it has members.
    """
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = left.withColumn("x", block).withColumn("y", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("band", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "x", "no", "rep", "component", "n_shingles", "regs")

    def partners(k: int, two: np.ndarray, group: dict, no: int, apart: np.ndarray) -> np.ndarray:
        """Members of the second block that member k may be linked with."""
        n, regs, rep = group["n"], group["regs"], group["rep"]
        other = two[apart & (np.minimum(n[two], n[k]) * SIMILARITY[1] >= np.maximum(n[two], n[k]) * SIMILARITY[0])]
        if group["same"]:
            other = other[rep[other] > rep[k]]
        if not len(other):
            return other
        score = estimate(np.broadcast_to(regs[k], (len(other), regs.shape[1])), regs[other], np.full(len(other), n[k]), n[other])
        other = other[score >= least]
        return other[first_shared(regs[k], regs[other], bands) == no] if len(other) else other

    def columns(t: pa.Table) -> tuple[dict, np.ndarray, np.ndarray, int]:
        group = {"n": t["n_shingles"].to_numpy(), "regs": np.array([np.frombuffer(r, "<u2") for r in t["regs"].to_pylist()]), "rep": t["rep"].to_numpy(), "same": t["i"][0].as_py() == t["j"][0].as_py()}
        x = t["x"].to_numpy()
        return group, np.flatnonzero(x == t["i"][0].as_py()), np.flatnonzero(x == t["j"][0].as_py()), t["no"][0].as_py()

    def involved(t: pa.Table) -> pa.Table:
        group, one, two, no = columns(t)
        comp, some = t["component"].to_numpy(), np.zeros(len(t), bool)
        for k in one.tolist():
            found = partners(k, two, group, no, comp[two] != comp[k])
            some[found] = True
            some[k] |= len(found) > 0
        return t.filter(pa.array(some))

    def forest(t: pa.Table) -> pa.Table:
        group, one, two, no = columns(t)
        names, roots = np.unique(t["component"].to_numpy(), return_inverse=True)
        shingle, sets, a, b = Shingler(size), {}, [], []
        for k in one.tolist():
            for m in partners(k, two, group, no, roots[two] != roots[k]).tolist():
                if roots[m] == roots[k]:
                    continue
                for x in (k, m):
                    if x not in sets:
                        sets[x] = shingle(t["text"][x].as_py())
                common = len(np.intersect1d(sets[k], sets[m], assume_unique=True))
                if common * SIMILARITY[1] >= (len(sets[k]) + len(sets[m]) - common) * SIMILARITY[0]:
                    roots = np.where(roots == roots[m], roots[k], roots)
                    a.append(group["rep"][k])
                    b.append(group["rep"][m])
        return pa.table({"a": pa.array(a, t["rep"].type), "b": pa.array(b, t["rep"].type)})

    some = materialise(dealt.groupBy("band", "i", "j").applyInArrow(involved, dealt.schema))
    ids = materialise(some.select("rep").distinct())
    bodies = materialise(docs.select(F.col(doc_id).alias("rep"), F.col(text).alias("text")).join(small(ids), "rep", "left_semi").dropDuplicates(["rep"]))
    return materialise(some.join(bodies, "rep").groupBy("band", "i", "j").applyInArrow(forest, f"a {kind}, b {kind}").distinct(), some, ids, bodies)


def op6_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3]) END) AS sh FROM w
), n AS (SELECT doc_id, len(sh) AS n FROM s),
e AS (SELECT doc_id, unnest(sh) AS x FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
r AS (SELECT doc_id AS node, doc_id AS root FROM n UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.node)
SELECT n.doc_id, n.n AS n_shingles, min(r.root) AS component_id, n.doc_id = min(r.root) AS kept
FROM n JOIN r ON r.node = n.doc_id GROUP BY n.doc_id, n.n
"""
