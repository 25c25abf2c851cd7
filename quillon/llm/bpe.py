"""Byte-level BPE by one encoding of each distinct word, and decoding by the token-byte table."""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession, functions as F

from quillon.llm.chunks import ANSWERED, ASKED, KEY_BITS, bucket_bits, bundle, chunked, kept_rows, pack, pack_words, schema_with, told, unbundle, unpack, unpack_places, unpack_words, word_keys
from quillon.llm.common import documents, tidied

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Words of a chunk, at most.
ENCODED_WORDS = 4_000_000


@functools.cache
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of pattern in a text, one after the other."""
    found = regex.compile(pattern)
    return (lambda t: [m.group() for m in found.finditer(t)]) if found.groups else found.findall


def by_bucket(words: list[bytes], groups: np.ndarray, bits: int) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """(bucket, its words in the order of the list, how many of each group)."""
    bucket = (word_keys(words) >> np.uint64(KEY_BITS - bits)).astype(np.int64)
    group = np.repeat(np.arange(len(groups)), groups)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange((1 << bits) + 1))
    for k in np.flatnonzero(np.diff(cuts)).tolist():
        own = order[cuts[k] : cuts[k + 1]]
        yield k, [words[i] for i in own.tolist()], np.bincount(group[own], minlength=len(groups))


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The pieces of flat that `at` numbers, by their starts and sizes, one after the other."""
    n = sizes[at]
    ends = np.cumsum(n)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[at] - ends + n, n)]


def listed(parts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From the answers of all buckets: numbers of ids of words, the ids, and of each word of the list its place in these."""
    if not parts:
        return np.empty(0, np.int64), np.empty(0, "<u4"), np.empty(0, np.int64)
    sizes, flat = (np.concatenate([unpack(p[k]) for p in parts]) for k in (0, 1))
    groups = np.array([unpack(p[2]) for p in parts]).astype(np.int64)
    starts = np.cumsum(groups.ravel()) - groups.ravel()
    # answers are by bucket and then by group, the list by group and then by bucket
    place = gathered(np.arange(len(sizes)), starts, groups.ravel(), np.arange(groups.size).reshape(groups.shape).T.ravel())
    return sizes.astype(np.int64), flat.astype("<u4"), place


def encode(docs: DataFrame, ranks_path: str, pattern: str = public_tokenizers.PATTERN, text: str = "text", digest: bool = False, chunk_words: int = ENCODED_WORDS) -> DataFrame:
    """Add n_tokens and ids (array<int>), or with digest, instead of the text, the SHA-256 of the ids and of their bytes.

    Every match of pattern is a word. A text is split once, into the places of its words in the word list
    of a chunk of documents. The words of all chunks meet by a shuffle of their hashes; there each distinct
    word is encoded once, and its ids go back to every chunk that asked. Documents are put together from
    the ids by position. A word is asked for once a chunk, so a common one is no hot key.

    Null and empty texts have no ids, very long ones are a chunk of their own, rows may repeat, an empty
    table stays empty. Input columns with the names of results are replaced; no other name matters.
    """
    ranks = load_ranks(ranks_path)
    names = ("n_tokens", "ids_sha256", "decoded_sha256") if digest else ("n_tokens", "ids")
    kept = [c for c in docs.columns if c not in names and not (digest and c == text)]
    table = chunked(docs, lambda: splitter(pattern), kept, text, chunk_words)
    bits = bucket_bits(table)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, packed in zip(b.column("chunk").to_pylist(), b.column("words")):
                asked = [(k, pack_words(some, sizes)) for k, some, sizes in by_bucket(*unpack_words(packed.as_py()), bits)]
                cols = [k for k, _ in asked], [chunk] * len(asked), [0] * len(asked), [body for _, body in asked]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int32(), pa.binary()))], names=["bucket", "chunk", "no", "body"])

    def answer(group: pa.Table) -> pa.Table:
        coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        known: dict[bytes, np.ndarray] = {}
        bodies = []
        for body in group["body"]:
            words, groups = unpack_words(body.as_py())
            for w in words:
                if w not in known:
                    known[w] = np.array(coder._encode_single_piece(w), np.uint64)
            ids = [known[w] for w in words]
            bodies.append(bundle([pack(np.fromiter(map(len, ids), np.uint64, len(ids))), pack(np.concatenate(ids)), pack(groups)]))
        return pa.table({"chunk": group["chunk"], "no": group["no"], "bucket": group["bucket"], "body": pa.array(bodies, pa.binary())})

    replies = table.select("chunk", "words").mapInArrow(tidied(ask), ASKED).groupBy("bucket").applyInArrow(answer, ANSWERED)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, i in ranks.items():
            pieces[i] = piece
        for b in batches:
            for i in range(b.num_rows):
                row = {c: b.column(c)[i].as_py() for c in ("tokens", "lengths", "rows", "told")}
                lengths = unpack(row["lengths"]).astype(np.int64)
                sizes, flat, place = listed([unbundle(t["body"]) for t in sorted(row["told"] or [], key=lambda t: t["bucket"])])
                at, starts, ends, out = place[unpack_places(row["tokens"])], np.cumsum(sizes) - sizes, np.cumsum(lengths), []
                for s, e in zip((ends - lengths).tolist(), ends.tolist()):
                    out.append(gathered(flat, starts, sizes, at[s:e]))
                rows = kept_rows(row["rows"])
                cols = [*rows.columns, pa.array([len(x) for x in out], pa.int64())]
                if digest:
                    cols.append(pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in out], pa.string()))
                    cols.append(pa.array([hashlib.sha256(b"".join(map(pieces.__getitem__, x.tolist()))).hexdigest() for x in out], pa.string()))
                else:
                    cols.append(pa.array([x.astype(np.int32) for x in out], pa.list_(pa.int32())))
                yield from pa.table(cols, names=[*kept, *names]).combine_chunks().to_batches()

    shape = "n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>")
    return told(table.select("chunk", "tokens", "lengths", "rows"), [replies]).mapInArrow(tidied(assemble), schema_with(docs.select(*kept), shape))


def decode(docs: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """Add decoded (binary): the bytes of the tokens, joined from the token-byte table, in order. Null ids give null."""
    pieces = load_ranks(ranks_path)
    kept = [c for c in docs.columns if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_id = {i: p for p, i in pieces.items()}
        for b in batches:
            out = [None if x is None else b"".join(map(by_id.__getitem__, x)) for x in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names=[*kept, "decoded"])

    return docs.select(*kept).mapInArrow(run, schema_with(docs.select(*kept), "decoded binary"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return encode(docs, public_tokenizers.path(RANKS), digest=True).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
