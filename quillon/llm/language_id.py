"""Language identification by compression with one zstandard dictionary for each language."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard as zs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from quillon.llm.common import documents

#: The answer for texts without any letter.
UNDETERMINED = "und"
#: Raw content of each dictionary, and sampled documents of each language that fill it.
DICT_BYTES, SAMPLE_DOCS, LEVEL = 1 << 15, 96, 6
#: A text is compressed in pieces, so that the dictionary weighs as much at its end as at its start.
PIECE = 4096
#: The relative margin below which the answer is rejected: sizes that tell nothing apart.
MIN_MARGIN = 0.0005
#: Letters that are compressed: A-Z lower-cased, other ASCII characters as blanks, the rest as it is.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def folded(text: str) -> bytes:
    """Words of a text, without case, digits and punctuation, which tell no language."""
    return b" " + b" ".join(text.encode("utf-8", "replace").translate(_LETTERS).split()) + b" "


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", dict_bytes: int = DICT_BYTES, sample_docs: int = SAMPLE_DOCS) -> dict[str, bytes]:
    """Raw dictionary content for each non-null language of docs.

    The fit uses a bounded sample: of each language about 2 * sample_docs documents by the smallest
    hashes of their keys, of which the first sample_docs, each with dict_bytes characters at most,
    fill dict_bytes. Null and empty texts teach nothing. An empty table gives no languages. The
    languages come by falling number of documents, then by code point.
    """
    rows = docs.where(F.col(lang).isNotNull() & (F.length(text) > 0))
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    if not counts:
        return {}
    # hashes below the bound of a language: an expected 2 * sample_docs of them
    bound = F.create_map(*[x for k, n in sorted(counts.items()) for x in (F.lit(k), F.lit(min(1.0, 2 * sample_docs / n)))])
    unit = F.xxhash64(F.col(key).cast("string")).cast("double") / F.lit(2.0**64) + F.lit(0.5)
    taken = rows.withColumn("__u", unit).where(F.col("__u") <= F.get(F.array(F.element_at(bound, F.col(lang))), 0))
    found: dict[str, list] = {k: [] for k in counts}
    for r in taken.select(F.col(lang).alias("l"), "__u", F.substring(text, 1, dict_bytes).alias("t")).collect():
        found[r["l"]].append((r["__u"], r["t"]))
    out = {}
    for k, pairs in sorted(found.items(), key=lambda x: (-counts[x[0]], x[0])):
        joined = b"".join(folded(t) for _, t in sorted(pairs)[:sample_docs])
        if joined:
            out[k] = joined[:dict_bytes]
    return out


class Classifier:
    """Chooses the language whose dictionary makes a text smallest."""

    def __init__(self, content: dict[str, bytes], level: int = LEVEL, piece: int = PIECE):
        self.langs, self.piece, self.coders = list(content), piece, []
        for k in self.langs:
            held = zs.ZstdCompressionDict(content[k], dict_type=zs.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=level)
            self.coders.append(zs.ZstdCompressor(level=level, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False).compress)

    def __call__(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        raw = folded(text)
        pieces = [raw[i : i + self.piece] for i in range(0, len(raw), self.piece)]
        sizes = [sum(len(c(p)) for p in pieces) for c in self.coders]
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        best = order[0]
        return self.langs[best], 1.0 if len(order) == 1 else 1.0 - sizes[best] / sizes[order[1]]


def identify_language(docs: DataFrame, content: dict[str, bytes], text: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """Add lang_pred, score and rejected (columns of these names are replaced).

    lang_pred: the language of the dictionary that compresses the whole text best; of equal sizes the
    more frequent language. score: 1 - smallest / second smallest size, 1 with a single language. Null
    texts and texts without letters (Unicode letters), and every text where nothing was learned, are 'und' with score 0.
    rejected: the text is 'und' or its score is below min_margin.
    """
    names = ("lang_pred", "score", "rejected")
    kept = [c for c in docs.columns if c not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        say = Classifier(content)
        for b in batches:
            got = [say(t) for t in b.column(text).to_pylist()]
            marks = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[0] == UNDETERMINED or g[1] < min_margin for g in got], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*b.columns, *marks], names=[*b.schema.names, *names])

    return docs.select(*kept).mapInArrow(run, schema_of(docs.select(*kept), "lang_pred string, score double, rejected boolean"))


def schema_of(df: DataFrame, more: str) -> StructType:
    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])


def part_of(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; null ids count as 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(0)) % parts


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    content = fit(docs.where(part_of("doc_id", 4) != 2))
    out = identify_language(docs.select("doc_id", "text"), content)
    return out.select("doc_id", (part_of("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")
