"""Documents in chunks with a word list each, and answers to what chunks ask about keys of the whole corpus.

A chunk is one row of a bounded size: each of its words once, in groups by how often they occur (frequent
ones have short numbers) and by key within a group, and for every document the places of its words in
that list. So a text is split once, and what is learnt about a word or a run of words
comes back once a chunk and is put where it belongs by position. Chunks ask by buckets of hashed
keys; a key occurs once in a chunk, so no bucket grows by a common word.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from quillon.llm.common import materialise, short_batches, tidied

#: Words and bytes of text that a chunk holds, at most (but for one longer document).
CHUNK_WORDS, CHUNK_BYTES = 500_000, 32 << 20
#: Documents that a worker is handed at once.
BATCH_ROWS = 1_000
#: Bits of a key. Two keys of n are taken for one with a chance of n * n / 2 ** 57.
KEY_BITS = 56
#: Words of all chunks by bucket, about.
BUCKET_WORDS = 1 << 20

CHUNK = "chunk long, n_words long, words binary, tokens binary, lengths binary, rows binary"
ASKED = "bucket int, chunk long, no int, body binary"
ANSWERED = "chunk long, no int, bucket int, body binary"


def squeezed(b: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b)


def widened(b: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(b)


def bundle(parts: list[bytes]) -> bytes:
    return struct.pack(f"<H{len(parts)}Q", len(parts), *map(len, parts)) + b"".join(parts)


def unbundle(b: bytes) -> list[bytes]:
    (n,) = struct.unpack_from("<H", b)
    sizes, at, out = struct.unpack_from(f"<{n}Q", b, 2), 2 + 8 * n, []
    for s in sizes:
        out.append(b[at : at + s])
        at += s
    return out


def pack(a: np.ndarray) -> bytes:
    """Whole numbers from 0 on, byte by byte of equal weight, compressed."""
    a = np.ascontiguousarray(a, "<u8")
    width = (int(a.max()).bit_length() + 7) // 8 if len(a) else 0
    return struct.pack("<QB", len(a), width) + squeezed(np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes())


def unpack(b: bytes) -> np.ndarray:
    n, width = struct.unpack_from("<QB", b)
    out = np.zeros((n, 8), np.uint8)
    if width:
        out[:, :width] = np.frombuffer(widened(b[9:]), np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<u8")


def pack_places(a: np.ndarray) -> bytes:
    """As pack, for numbers of which most are small: those from 255 on are escaped to a second and a third stream."""
    big = a[a >= 255] - 255
    high = big >> 8
    streams = np.minimum(a, 255), np.minimum(high, 255), big & 255
    return bundle([*(squeezed(s.astype(np.uint8).tobytes()) for s in streams), pack(high[high >= 255] - 255)])


def unpack_places(b: bytes) -> np.ndarray:
    *streams, rest = unbundle(b)
    low, high, bits = (np.frombuffer(widened(s), np.uint8).astype(np.int64) for s in streams)
    high[high == 255] += unpack(rest).astype(np.int64)
    low[low == 255] += (high << 8) + bits
    return low


def pack_words(words: list[bytes], groups: np.ndarray) -> bytes:
    """Words and the sizes of their groups."""
    return bundle([pack(np.fromiter(map(len, words), np.uint64, len(words))), squeezed(b"".join(words)), pack(groups)])


def unpack_words(b: bytes) -> tuple[list[bytes], np.ndarray]:
    sizes, joined, groups = unbundle(b)
    ends = np.cumsum(unpack(sizes)).tolist()
    joined = widened(joined)
    return [joined[s:e] for s, e in zip([0, *ends], ends)], unpack(groups).astype(np.int64)


class _Places(dict):
    def __missing__(self, word):
        n = self[word] = len(self)
        return n


def chunked(docs: DataFrame, splitter: Callable[[], Callable[[str], list]], keep: list[str], text: str = "text", most_words: int = CHUNK_WORDS, most_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunks of docs with the columns `keep`; splitter() gives what splits a text into words (strings or UTF-8)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, number = splitter(), TaskContext.get().partitionId() << 32
        places, tokens, rows, held, size = _Places(), [], [], 0, 0

        def chunk() -> pa.RecordBatch:
            nonlocal places, tokens, rows, held, size, number
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows[0].schema) as out:
                for r in rows:
                    out.write_batch(r)
            words = [w.encode() if isinstance(w, str) else w for w in places]
            lengths = np.fromiter(map(len, tokens), np.uint64, len(tokens))
            flat = np.concatenate(tokens)
            group = 63 - np.frexp(np.bincount(flat, minlength=len(words)))[1]  # by powers of two of their counts
            order = np.lexsort((word_keys(words), group))
            rank = np.empty(len(words), np.uint32)
            rank[order] = np.arange(len(words), dtype=np.uint32)
            listed = pack_words([words[i] for i in order.tolist()], np.unique(group, return_counts=True)[1])
            cols = [number], [held], [listed], [pack_places(rank[flat])], [pack(lengths)], [squeezed(sink.getvalue().to_pybytes())]
            places, tokens, rows, held, size, number = _Places(), [], [], 0, 0, number + 1
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), *[pa.binary()] * 4))], names=["chunk", "n_words", "words", "tokens", "lengths", "rows"])

        for b in batches:
            start, texts, b = 0, b.column(0), b.select(list(range(1, b.num_columns)))
            for i in range(b.num_rows):
                t = texts[i].as_py() or ""
                words = split(t)
                tokens.append(np.fromiter(map(places.__getitem__, words), np.uint32, len(words)))
                held, size = held + len(words), size + len(t)
                if held >= most_words or size >= most_bytes:
                    rows.append(b.slice(start, i + 1 - start))
                    start = i + 1
                    yield chunk()
            if start < b.num_rows:
                rows.append(b.slice(start))
        if rows:
            yield chunk()

    with short_batches(docs.sparkSession, BATCH_ROWS):
        return materialise(docs.select(F.col(text).alias("__text"), *[F.col(c) for c in keep]).mapInArrow(tidied(run), CHUNK))


def kept_rows(b: bytes) -> pa.Table:
    return pa.ipc.open_stream(widened(b)).read_all()


def bucket_bits(table: DataFrame) -> int:
    """Bits of a key that name its bucket: a bucket has about BUCKET_WORDS words, whatever the corpus."""
    n = table.agg(F.sum("n_words")).first()[0] or 0
    return max(3, (n // BUCKET_WORDS).bit_length())


def asked(keys: np.ndarray, values: list[np.ndarray], bits: int) -> Iterator[tuple[int, bytes]]:
    """(bucket, body) of ascending distinct keys and their values."""
    firsts = np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(KEY_BITS - bits)
    cuts = np.searchsorted(keys, firsts)
    for i in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
        s, e = cuts[i], cuts[i + 1]
        yield i, bundle([pack(np.diff(keys[s:e], prepend=firsts[i])), *(pack(v[s:e]) for v in values)])


def summed(table: pa.Table, bits: int, enough: Callable[..., np.ndarray], returned: int = 1) -> tuple[pa.Table, np.ndarray]:
    """Answers to the chunks of one bucket, and the first value's totals of its distinct keys.

    Of each key the totals of all values are taken. enough(first total, number of chunks that ask, other
    totals) says for which keys chunks are told the totals of the first `returned` values, and whether
    they are the first to ask (the first stands for the key where each is to count once).
    """
    table = table.sort_by("chunk")
    start = np.uint64(table["bucket"][0].as_py()) << np.uint64(KEY_BITS - bits)
    parts = [unbundle(b) for b in table["body"].to_pylist()]
    keys = [np.cumsum(unpack(p[0])) + start for p in parts]
    every, first, back = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    totals = [np.bincount(back, np.concatenate([unpack(p[j]) for p in parts]), len(every)).astype(np.int64) for j in range(1, len(parts[0]))]
    good, is_first, bodies, at = enough(totals[0], np.bincount(back), *totals[1:]), np.zeros(len(back), bool), [], 0
    is_first[first] = True
    for k in keys:
        own = back[at : at + len(k)]
        there = good[own]
        bodies.append(bundle([struct.pack("<Q", len(k)), np.packbits(there).tobytes(), np.packbits(is_first[at : at + len(k)][there]).tobytes(), *(pack(t[own][there]) for t in totals[:returned])]))
        at += len(k)
    return pa.table({"chunk": table["chunk"], "no": table["no"], "bucket": table["bucket"], "body": pa.array(bodies, pa.binary())}), totals[0]


def answers(told: list[dict], no: int) -> tuple[list[np.ndarray], np.ndarray]:
    """What `summed` says of a chunk's ascending keys: values (0 where not enough), and which of them it stands for."""
    values, owned = [], []
    for t in sorted((t for t in told or () if t["no"] == no), key=lambda t: t["bucket"]):
        size, there, first, *packed = unbundle(t["body"])
        (n,) = struct.unpack("<Q", size)
        there = np.unpackbits(np.frombuffer(there, np.uint8), count=n).astype(bool)
        mine = np.zeros(n, bool)
        mine[there] = np.unpackbits(np.frombuffer(first, np.uint8), count=int(there.sum()))
        owned.append(mine)
        full = np.zeros((len(packed), n), np.int64)
        for row, p in zip(full, packed):
            row[there] = unpack(p)
        values.append(full)
    if not values:
        return [], np.empty(0, bool)
    return list(np.concatenate(values, 1)), np.concatenate(owned)


def told(table: DataFrame, replies: list[DataFrame]) -> DataFrame:
    """Chunks with told, what came back to each."""
    every = replies[0].select("chunk", "no", "bucket", "body")
    for r in replies[1:]:
        every = every.unionByName(r.select("chunk", "no", "bucket", "body"))
    own = every.groupBy("chunk").agg(F.collect_list(F.struct("no", "bucket", "body")).alias("told"))
    return table.join(own, "chunk", "left")


def word_keys(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) >> np.uint64(64 - KEY_BITS)


def schema_with(df: DataFrame, more: str) -> StructType:
    return StructType([*df.schema.fields, *StructType.fromDDL(more).fields])
