"""Line dedup: lines that many documents share are dropped everywhere. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillon.llm.common import BLANKS, documents, lower_ascii, materialise, wide_hash


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def drop_repeated_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Drop every line whose key is found in at least min_docs documents.

    Lines are split at line feeds; a key is the line without white space at its ends and with A-Z
    lower-cased. Keys shorter than min_chars never count. Each row is one document, also if its id
    or text repeats. Null and empty texts are one empty line and come back as empty text; a text of
    which every line goes becomes empty. The result has the input's columns, with the new text, and
    n_lines and n_dropped (which replace input columns of these names).
    """
    spread = "__h1", "__h2"
    hashed = lambda df, k: df.select(*[c for c in df.columns if c != k], *[h.alias(n) for h, n in zip(wide_hash(F.col(k)), spread)])
    keys = docs.select(F.explode(F.array_distinct(F.filter(F.transform(_lines(F.col(text)), line_key), lambda k: F.length(k) >= min_chars))).alias("__k"))
    # one row per document and key, so a count is a count of documents; partial sums tame a hot key
    hot = materialise(hashed(keys, "__k").groupBy(*spread).agg(F.count("*").alias("__n")).where(F.col("__n") >= min_docs).drop("__n"))

    row = [F.col(doc_id).alias("__id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("__t")]
    lines = docs.select(*row, F.posexplode(F.transform(_lines(F.col(text)), line_key)).alias("__at", "__k")).where(F.length("__k") >= min_chars)
    # both sides are plain shuffles: adaptive execution broadcasts a small side or splits a hot key
    dropped = hashed(lines, "__k").join(hot, list(spread)).groupBy("__id", "__t").agg(F.array_sort(F.collect_set("__at")).alias("__drop"))

    one = F.col("__drop")
    gaps = F.transform(one, lambda at, i: F.concat(F.array_repeat(F.lit(False), at - F.when(i == 0, -1).otherwise(F.get(one, i - 1)) - 1), F.array(F.lit(True))))
    marks = F.flatten(gaps)
    left = docs.withColumns({"__id": F.col(doc_id), "__t": row[1]})
    joined = left.join(dropped.withColumnsRenamed({"__id": "__id2", "__t": "__t2"}), F.col("__id").eqNullSafe(F.col("__id2")) & (F.col("__t") == F.col("__t2")), "left")
    kept = joined.withColumn("__marks", marks).withColumn("__lines", _lines(F.col(text)))
    rest = F.array_join(F.filter("__lines", lambda _, i: ~F.coalesce(F.get("__marks", i), F.lit(False))), "\n")
    out = kept.withColumns({"n_lines": F.size("__lines").cast("long"), "n_dropped": F.coalesce(F.size("__drop"), F.lit(0)).cast("long")})
    out = out.withColumn(text, F.when(F.col("__drop").isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(rest))
    return out.select(*docs.columns, *[c for c in ("n_lines", "n_dropped") if c not in docs.columns])


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeated_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(ls))) AS pos, unnest(ls) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), hot AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT keyed.*, hot.k IS NOT NULL AS gone FROM keyed LEFT JOIN hot ON keyed.k = hot.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
