"""Canonical exact digests of documents. DataFrame functions only."""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from quillon.llm.common import documents, materialise, range_of, small, splits, wide_hash

#: White space that is folded to single blanks.
_SPACE = r"\t-\r\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
#: Documents of one range of ids, about, and ranges at most.
RANGE_DOCS, MAX_RANGES = 2_000, 4096
_HANGUL = 0xAC00


@functools.cache
def _tables() -> tuple[str, str, str, str]:
    """Characters and their canonical decompositions; combining marks and their classes."""
    chars, parts, marks, classes = [], [], [], []
    for cp in range(0x80, sys.maxunicode + 1):
        c = chr(cp)
        if unicodedata.combining(c):
            marks.append(c)
            classes.append(str(unicodedata.combining(c)))
        if not _HANGUL <= cp < _HANGUL + 11172 and not 0xD800 <= cp < 0xE000 and (d := unicodedata.normalize("NFD", c)) != c:
            chars.append(c)
            parts.append(d)
    return "\n".join(chars), "\n".join(parts), "\n".join(marks), "\n".join(classes)


def _char(code: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")


def decomposed(c: Column) -> Column:
    """Unicode's canonical decomposition (NFD). ASCII strings are passed through."""
    chars, parts, marks, classes = _tables()
    keys, values = F.split(F.lit(chars), "\n"), F.split(F.lit(parts), "\n")
    seen = F.array_distinct(F.regexp_extract_all(c, F.lit(r"[^\x00-\x7F]"), F.lit(0)))
    out = F.aggregate(F.array_intersect(seen, keys), c, lambda s, x: F.replace(s, x, F.element_at(values, F.array_position(keys, x).cast("int"))))

    def jamo(x: Column) -> Column:
        at = F.ascii(x) - _HANGUL
        tail = at % 28
        return F.concat(_char(F.floor(at / 588) + 0x1100), _char(F.floor(at % 588 / 28) + 0x1161), F.when(tail > 0, _char(tail + 0x11A7)).otherwise(F.lit("")))

    syllables = F.filter(seen, lambda x: x.between("가", "힣"))
    out = F.when(c.rlike("[가-힣]"), F.aggregate(syllables, out, lambda s, x: F.replace(s, x, jamo(x)))).otherwise(out)
    listed, ranks = F.split(F.lit(marks), "\n"), F.split(F.lit(classes), "\n")

    def ordered(run: Column) -> Column:
        # a mark of class 0 stays where it is: the marks before and after it are sorted apart
        codes = F.transform(F.regexp_extract_all(run, F.lit(r"\p{M}"), F.lit(0)), lambda m, i: F.struct(F.coalesce(F.get(ranks, (F.array_position(listed, m) - 1).cast("int")), F.lit("0")).cast("int").alias("k"), i.alias("i"), m.alias("m")))
        before = lambda i: F.size(F.filter(codes, lambda e: (e["k"] == 0) & (e["i"] <= i)))
        each = F.transform(codes, lambda e: F.struct(before(e["i"]).alias("part"), e["k"].alias("k"), e["i"].alias("i"), e["m"].alias("m")))
        return F.array_join(F.transform(F.array_sort(each), lambda e: e["m"]), "")

    def sorted_marks(s: Column) -> Column:
        # the longest first: no unsorted run is part of a sorted one
        runs = F.array_sort(F.transform(F.array_distinct(F.regexp_extract_all(s, F.lit(r"\p{M}{2,}"), F.lit(0))), lambda r: F.struct((-F.length(r)).alias("n"), r.alias("r"))))
        return F.when(s.rlike(r"\p{M}{2,}"), F.aggregate(runs, s, lambda acc, r: F.replace(acc, r["r"], ordered(r["r"])))).otherwise(s)

    # each step through a one-element array, so that it is evaluated once
    sorted_out = F.get(F.transform(F.array(out), sorted_marks), 0)
    return F.when(F.length(c) == F.octet_length(c), c).otherwise(sorted_out)


def canonical(text: Column) -> Column:
    """Decomposed, case-folded (lower of upper beyond ASCII), runs of white space as one blank, trimmed. Null is empty."""
    c = F.coalesce(text, F.lit(""))
    plain = F.length(c) == F.octet_length(c)
    folded = F.when(plain, F.lower(c)).otherwise(F.lower(F.concat(F.upper(decomposed(c)), F.lit(""))))  # a bare lower(upper()) is planned as lower()
    return F.trim(F.regexp_replace(folded, f"[{_SPACE}]{{2,}}|[{_SPACE.replace(chr(92) + 'x20', chr(92) + 'x1F')}]", " "))


def _digest(pair: list[Column]) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in pair]))


def _hashes(text: Column, bits: int | None) -> list[Column]:
    pair = wide_hash(text)
    return pair if bits is None else [h.bitwiseAND(F.lit((1 << bits) - 1)) for h in pair]


def hashed(docs: DataFrame, text: str, bits: int | None = None) -> DataFrame:
    """docs with __h1 and __h2, the hashes of the canonical text, as a table: folding a text is most of the work."""
    names = [c for c in docs.columns if c not in ("__h1", "__h2")]
    return materialise(docs.select(*names, F.struct(canonical(F.col(text)).alias("c")).alias("__canon")).select(*names, *[h.alias(n) for h, n in zip(_hashes(F.col("__canon.c"), bits), ("__h1", "__h2"))]))


def collisions(rows: DataFrame, text: str = "text") -> DataFrame | None:
    """Compare bytes inside buckets of equal digests: (digest, canonical, rank) of buckets with several texts, or None.

    rows are as of hashed. Only buckets of several rows are looked at. The smallest and the largest
    canonical text of a bucket, taken with partial aggregation whatever the bucket's size, are equal if and only if all are.
    """
    several = materialise(rows.groupBy("__h1", "__h2").agg(F.count("*").alias("__n")).where("__n > 1").select("__h1", "__h2"))
    each = rows.join(small(several), ["__h1", "__h2"]).select("__h1", "__h2", canonical(F.col(text)).alias("__c"))
    mixed = materialise(each.groupBy("__h1", "__h2").agg(F.min("__c").alias("__lo"), F.max("__c").alias("__hi")).where("__lo <> __hi").select("__h1", "__h2"))
    if mixed.isEmpty():
        return None
    texts = each.join(small(mixed), ["__h1", "__h2"]).distinct()
    rank = F.row_number().over(Window.partitionBy("__h1", "__h2").orderBy("__c"))
    return materialise(texts.select(_digest([F.col("__h1"), F.col("__h2")]).alias("__digest"), "__c", rank.alias("__rank")))


def _resolve(rows: DataFrame, digest: str, text: str, mixed: DataFrame | None) -> DataFrame:
    """Append the rank to digests that several texts share."""
    if mixed is None:
        return rows
    names = [c for c in rows.columns if c != digest]
    joined = rows.withColumn("__canon", canonical(F.col(text))).join(mixed, (F.col(digest) == F.col("__digest")) & (F.col("__canon") == F.col("__c")), "left")
    return joined.select(*names, F.when(F.col("__rank") > 1, F.concat(digest, F.lit("-"), F.col("__rank"))).otherwise(F.col(digest)).alias(digest))


def fingerprint(docs: DataFrame, text: str = "text", bits: int | None = None) -> DataFrame:
    """Add fingerprint, equal for two rows if and only if their canonical texts are equal byte by byte.

    It is a 128-bit xxhash in hexadecimal; where a bucket holds several canonical texts, the second
    and later ones by byte order get their rank appended. Null counts as the empty text, rows that
    repeat are alike, an input column named fingerprint is replaced (names that begin with two underscores
    are ours), an empty table stays empty. Texts of any length are folded as a whole.
    """
    rows = hashed(docs, text, bits)
    out = rows.withColumn("fingerprint", _digest([F.col("__h1"), F.col("__h2")]))
    return _resolve(out, "fingerprint", text, collisions(rows, text)).select(*[c for c in docs.columns if c != "fingerprint"], "fingerprint")


def with_next(rows: DataFrame, after: list[str], doc_id: str = "doc_id") -> DataFrame:
    """Add next_<c> for each column c of `after`: that of the next row by id (nulls first) and by these columns.

    After the last row comes the first. Ids are cut into ranges of about equal numbers; each range
    also gets the first rows of the next one, so that no task sees more than a range.
    """
    ids = rows.select(doc_id)
    n = ids.count()
    cuts = splits(ids, doc_id, min(MAX_RANGES, max(n // RANGE_DOCS, min(n // 64, 512))))
    placed = rows.withColumn("__b", range_of(F.col(doc_id), cuts))
    nulls = F.max(F.col(doc_id).isNull())
    first = sorted(placed.groupBy("__b").agg(F.when(nulls, None).otherwise(F.min(doc_id)).alias("m")).collect())
    heads = [(first[i - 1][0], x[1]) for i, x in enumerate(first)]
    table = rows.sparkSession.createDataFrame(heads, f"__b int, __m {dict(ids.dtypes)[doc_id]}")
    halo = rows.join(F.broadcast(table), F.col(doc_id).eqNullSafe(F.col("__m"))).drop("__m").withColumn("__halo", F.lit(1))
    order = Window.partitionBy("__b").orderBy("__halo", F.col(doc_id).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in after])
    both = placed.withColumn("__halo", F.lit(0)).unionByName(halo)
    return both.withColumns({f"next_{c}": F.lead(c).over(order) for c in after}).where("__halo = 0").drop("__halo", "__b")


def edited_texts(text: str = "text", next_text: str = "next_text") -> Column:
    """The text with its last floor(n / 4) of n code points replaced by the first as many, or all, of the next text."""
    n = F.length(text)
    cut = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - cut), F.substring(next_text, F.lit(1), cut))


def op8_fingerprints(spark: SparkSession, sf_dir: str, bits: int | None = None) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = hashed(docs, "text", bits)
    mixed = collisions(known)
    rows = with_next(known.select("doc_id", "text", _digest([F.col("__h1"), F.col("__h2")]).alias("fingerprint")), ["text", "fingerprint"])
    # a struct keeps the planner from folding a text anew for each of its hashes
    rows = rows.select("*", F.length("text").cast("long").alias("n_chars"), edited_texts().alias("edited"))
    rows = rows.select("*", F.struct(canonical(F.col("edited")).alias("c")).alias("__canon")).select(*rows.columns, _digest(_hashes(F.col("__canon.c"), bits)).alias("edited_fingerprint"))
    # equal digests are confirmed byte by byte
    same = lambda a, b, x, y: F.when((F.col(a) == F.col(b)) & ((F.col(x) == F.col(y)) | (canonical(F.col(x)) == canonical(F.col(y)))), 1.0).otherwise(0.0)
    rows = rows.withColumns({"near_edited": same("fingerprint", "edited_fingerprint", "text", "edited"), "near_next": same("fingerprint", "next_fingerprint", "text", "next_text")})
    rows = _resolve(_resolve(rows, "fingerprint", "text", mixed), "edited_fingerprint", "edited", mixed)
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")
