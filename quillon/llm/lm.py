"""LM scoring by a probabilistic suffix tree over words, with a byte tree that spells new words."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillon.llm.chunks import ANSWERED, ASKED, CHUNK_WORDS, KEY_BITS, answers, asked, bucket_bits, chunked, kept_rows, schema_with, summed, told, unpack, unpack_places, unpack_words, word_keys
from quillon.llm.common import documents, drop_shuffles, materialise, tidied
from quillon.llm.language_id import part_of
from quillon.llm.near_dup import _mixed

#: Words of the longest context.
DEPTH = 2
#: A state counts a next word as its own if it was seen after it so often; what is seen less often is left to shorter suffixes.
LEAST = 2
#: Sightings that a state lends to its suffix, besides those of next words that aren't its own.
LENT = 1.0
#: What a context must tell (in nats, over all its sightings, each foretold without itself) to be a state of the tree.
MIN_GAIN = 1.0
#: Gains are added up in parts of a nat.
PARTS = 1024
#: The end of a text, as a word. No word of a text is empty.
END = b""
BLANK = 0x20


def lower_words(text: str) -> list[bytes]:
    """A-Z lower-cased, words between white space, and the end."""
    return [*text.encode().lower().split(), END]


class Spelling:
    """Probabilities of the bytes of new words and the blank after them, by contexts of two bytes within the word.

    Contexts of two bytes whose next bytes tell less than MIN_GAIN, each foretold without itself, are
    left to their suffix. Its size is bounded: at most 2 ** 16 contexts of 2 ** 8 bytes.
    """

    def __init__(self, rows: list[tuple[int, int, int]]):
        one = np.zeros((256, 256))
        ctx, sym, n = np.array(rows, np.int64).reshape(-1, 3).T
        np.add.at(one, (ctx & 255, sym), n)
        one[BLANK, BLANK] = 0
        uniform = np.full((256, 256), 1 / 256)
        uniform[BLANK] = np.where(np.arange(256) == BLANK, 0, 1 / 255)  # no word is empty
        self.one = (one + LENT * uniform) / (one.sum(1, keepdims=True) + LENT)
        self.states = np.full(1 << 16, -1, np.int64)
        long = ctx >> 8 > 0
        names, at = np.unique(ctx[long], return_inverse=True)
        two = np.zeros((len(names), 256))
        np.add.at(two, (at, sym[long]), n[long])
        base, total = self.one[names & 255], two.sum(1, keepdims=True)
        seen = two > 0
        gain = np.where(seen, two * np.log(np.where(seen, (two - 1 + LENT * base) / (np.maximum(total, 1) - 1 + LENT) / base, 1)), 0).sum(1)
        stay = gain >= MIN_GAIN
        self.two = np.log10((two + LENT * base) / (total + LENT))[stay]
        self.one = np.log10(np.maximum(self.one, 1e-300))
        self.states[names[stay]] = np.arange(stay.sum())

    def __call__(self, words: list[bytes]) -> np.ndarray:
        """log10 probability of each word."""
        if not words:
            return np.empty(0)
        buffer, ctx, word = spelled(words)
        state = self.states[ctx]
        each = self.one[ctx & 255, buffer]
        if len(self.two):
            each = np.where(state >= 0, self.two[state, buffer], each)
        return np.bincount(word, each, len(words))


def spelled(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of words with a blank after each, the two bytes before each within its word (0 before the start), its word."""
    whole = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.int64)
    last, buffer = whole[:-1], whole[1:]
    before = np.where(last == BLANK, 0, np.r_[0, whole[:-2]])
    return buffer, before << 8 | last, np.cumsum(last == BLANK) - 1


class Grams:
    """Runs of words that end at each place of a chunk: their keys and, as far as told, how often training has them."""

    def __init__(self, row: dict, total: int, depth: int):
        self.words, _ = unpack_words(row["words"])
        self.tokens, lengths = unpack_places(row["tokens"]).astype(np.int32), unpack(row["lengths"]).astype(np.int32)
        self.rows, self.told, self.total = kept_rows(row["rows"]), row.get("told"), total
        self.doc = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        self.place = np.arange(len(self.tokens), dtype=np.int32) - np.repeat(np.cumsum(lengths, dtype=np.int32) - lengths, lengths)
        self.learnt = self.rows["__learn"].to_numpy(zero_copy_only=False).astype(bool)[self.doc]
        self.keys, self.n, self.listed = {}, {}, {}
        self.depth = depth

    def list_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Ascending keys of the word list, and the word of each."""
        own = word_keys(self.words)
        order = np.argsort(own, kind="stable")
        return own, order

    def first(self) -> tuple[np.ndarray, np.ndarray]:
        """Sets order 1; (sightings in training of each word of the list, words of which this chunk stands for the count)."""
        own, order = self.list_keys()
        values, owned = answers(self.told, 1)
        n, stands, rank = np.zeros(len(own), np.int64), np.zeros(len(own), bool), np.empty(len(own), np.int32)
        n[order], stands[order], rank[order] = values[0], owned, np.arange(len(own))
        self.keys[1], self.n[1] = own[self.tokens], n[self.tokens]
        self.listed[1] = own[order], values[0], rank[self.tokens]
        return n, stands

    def at(self, order: int) -> np.ndarray:
        """Places where a run of `order` words may be seen LEAST times: both runs within it are."""
        short = self.n[order - 1]
        there = (self.place >= order - 1) & (short >= LEAST)
        there[1:] &= short[:-1] >= LEAST
        return np.flatnonzero(there)

    def key(self, order: int) -> np.ndarray:
        """Keys of the runs that end at each place (of no meaning where one starts before its text)."""
        before = np.r_[np.uint64(0), self.keys[order - 1][:-1]]
        self.keys[order] = _mixed(before * np.uint64(0x9E3779B97F4A7C15) + self.keys[1] + np.uint64(order)) >> np.uint64(64 - KEY_BITS)
        return self.keys[order]

    def learn(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Sets n of an order above 1; places of the runs of which this chunk stands for the count (one each), and their n."""
        at = self.at(order)
        keys, back = np.unique(self.key(order)[at], return_inverse=True)
        values, owned = answers(self.told, order)
        n = values[0] if values else np.zeros(0, np.int64)
        self.n[order], number = np.zeros(len(self.tokens), np.int64), np.full(len(self.tokens), -1, np.int32)
        self.n[order][at], number[at] = n[back], back
        self.listed[order] = keys, n, number
        some = np.empty(len(keys), np.int64)
        some[back] = at
        mine = owned & (n >= LEAST)
        return some[mine], n[mine]

    def contexts(self, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Possible states of `order` - 1 words: places that follow one, which one, the ascending keys of all, sightings of each."""
        there = self.place >= order - 1
        there[1:] &= self.n[order - 1][:-1] >= LEAST
        at = np.flatnonzero(there)
        keys, n, number = self.listed[order - 1]
        which, present = number[at - 1], np.zeros(len(keys), bool)
        present[which] = True
        return at, (np.cumsum(present) - 1)[which], keys[present], n[present]

    def share(self, order: int, at: np.ndarray) -> np.ndarray:
        """How often the last word follows the words before it but the first."""
        return self.n[order - 1][at] / (self.n[order - 2][at - 1] if order > 2 else self.total)


def _batch(bits: int, chunk: int, no: int, keys: np.ndarray, values: list[np.ndarray]) -> pa.RecordBatch:
    got = list(asked(keys, values, bits))
    cols = [k for k, _ in got], [chunk] * len(got), [no] * len(got), [body for _, body in got]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int32(), pa.binary()))], names=["bucket", "chunk", "no", "body"])


def _chunks(batches: Iterator[pa.RecordBatch], total: int, depth: int) -> Iterator[tuple[int, Grams]]:
    for b in batches:
        for i in range(b.num_rows):
            row = {c: b.column(c)[i].as_py() for c in b.schema.names}
            yield row["chunk"], Grams(row, total, depth)


def is_state(n: np.ndarray, own: np.ndarray, gain: np.ndarray) -> np.ndarray:
    """Whether a context seen n times tells enough: own of them are followed by next words of its own, which add to gain."""
    return (own > 0) & (gain / PARTS + (n - own) * math.log(LENT) - n * np.log(np.maximum(n, 1) - 1 + LENT) >= MIN_GAIN)


def _totals(rows: DataFrame, bits: int, enough: Callable, returned: int = 1) -> DataFrame:
    def run(group: pa.Table) -> pa.Table:
        out, n = summed(group, bits, enough, returned)
        first = np.arange(len(out)) == 0
        for name, x in (("total", n.sum()), ("kinds", (n > 0).sum()), ("once", (n == 1).sum())):
            out = out.append_column(name, pa.array(np.where(first, int(x), 0), pa.int64()))
        return out

    return materialise(rows.groupBy("no", "bucket").applyInArrow(run, f"{ANSWERED}, total long, kinds long, once long"))


def score_documents(docs: DataFrame, training: DataFrame | Column, text: str = "text", depth: int = DEPTH, keep: list[str] | None = None, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """Add n_tokens, n_known, train_tokens, base_score and score to docs (their columns `keep`, or all).

    Learns from the rows of docs for which `training` is true, or from the texts of another table.
    Tokens are words (A-Z lower-cased, between white space), then one end. base_score is the sum of
    log10((c + 0.1) / (N + 0.1 * (V + 1))) with a token's count c among the N training tokens of V kinds.

    score is the log10 probability of the text under a suffix tree. Its states are the empty context and
    runs of up to `depth` words. A run s seen n times in training is a state if the log-likelihood ratio of
    the words after it against those after its suffix, each sighting foretold without itself, is MIN_GAIN or
    more. A state foretells a word x seen n(s, x) >= LEAST times after it with n(s, x) / (n + LENT), and hands what is
    left to its longest suffix that is a state, so its distribution sums to 1. Each token is foretold by the longest
    state that ends before it. At the empty context a training word has n / (N + k), k being the number of
    words seen once; k / (N + k) is shared by new words as their spelling is likely, after a byte tree of the words
    seen once. So all texts together have probability 1 (at most).

    Counts are taken over all training texts: chunks send each run once with its count to a bucket by its
    hash and are told the total. Runs are asked for only if both runs within them were seen LEAST times.

    Null and empty texts are one end. Rows may repeat; input columns with the names of results are
    replaced; an empty table stays empty; without training rows all words are new.
    """
    names = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    kept = [c for c in keep or docs.columns if c not in names]
    if isinstance(training, Column):
        rows = docs.select(F.col(text).alias("__text"), *kept, F.coalesce(training, F.lit(False)).alias("__learn"), F.lit(True).alias("__out"))
    else:
        rows = docs.select(F.col(text).alias("__text"), *kept, F.lit(False).alias("__learn"), F.lit(True).alias("__out"))
        empty = [F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in kept]
        rows = rows.unionByName(training.select(F.col(text).alias("__text"), *empty, F.lit(True).alias("__learn"), F.lit(False).alias("__out")))
    table = chunked(rows, lambda: lower_words, [*kept, "__learn", "__out"], "__text", chunk_words)
    bits = bucket_bits(table)

    def ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, c in _chunks(batches, 0, depth):
            own, order = c.list_keys()
            yield _batch(bits, chunk, 1, own[order], [np.bincount(c.tokens[c.learnt], minlength=len(own))[order]])

    replies = [_totals(table.select("chunk", "words", "tokens", "lengths", "rows").mapInArrow(tidied(ask_words), ASKED), bits, lambda n, _: n >= 1)]
    drop_shuffles(docs.sparkSession)
    total, kinds, once = (int(x or 0) for x in replies[0].agg(F.sum("total"), F.sum("kinds"), F.sum("once")).first())

    def asker(order: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for chunk, c in _chunks(batches, total, depth):
                c.first()
                for o in range(2, order):
                    c.learn(o)
                at = c.at(order)
                keys, back = np.unique(c.key(order)[at], return_inverse=True)
                yield _batch(bits, chunk, order, keys, [np.bincount(back[c.learnt[at]], minlength=len(keys))])

        return tidied(run)

    for order in range(2, depth + 2):
        replies.append(_totals(told(table, replies).mapInArrow(asker(order), ASKED), bits, lambda n, _: n >= LEAST))
        drop_shuffles(docs.sparkSession)

    def ask_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, c in _chunks(batches, total, depth):
            c.first()
            for order in range(2, depth + 2):
                mine, n = c.learn(order)
                at, back, names, seen = c.contexts(order)
                # a run is counted by one chunk only, at one place
                number = np.zeros(len(c.tokens), np.int32)
                number[at] = back
                q = c.share(order, mine)
                gain = np.bincount(number[mine], np.rint(PARTS * n * np.log((n - 1 + LENT * q) / q)), len(names))
                yield _batch(bits, chunk, order + depth, names, [np.bincount(number[mine], n, len(names)), gain, seen])

    # all chunks that ask say the same of how often they have seen a context
    replies.append(_totals(told(table, replies).mapInArrow(tidied(ask_states), ASKED), bits, lambda own, asks, gain, seen: is_state(seen // asks, own, gain)))

    def count_spellings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for packed, replied in zip(b.column("words"), b.column("told")):
                words, _ = unpack_words(packed.as_py())
                order = np.argsort(word_keys(words), kind="stable")
                values, owned = answers(replied.as_py(), 1)
                some = [words[i] for i in order[(values[0] == 1) & owned].tolist() if words[i]]
                if some:
                    buffer, ctx, _ = spelled(some)
                    both, n = np.unique(ctx << 8 | buffer, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip((both >> 8, both & 255, n), (pa.int32(), pa.int32(), pa.int64()))], names=["ctx", "sym", "n"])

    drop_shuffles(docs.sparkSession)
    counted = told(table.select("chunk", "words"), replies[:1]).mapInArrow(tidied(count_spellings), "ctx int, sym int, n long").groupBy("ctx", "sym").agg(F.sum("n").alias("n"))
    spelling = Spelling([tuple(r) for r in counted.collect()])  # 2 ** 24 rows at most: two bytes and the next
    drop_shuffles(docs.sparkSession)
    new = max(1, once)
    scale = math.log10(total + new)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, c in _chunks(batches, total, depth):
            n, _ = c.first()
            size = len(c.rows)
            fresh = np.flatnonzero(n == 0)
            first = np.log10(np.maximum(n, 1)) - scale
            # an end that training hasn't takes half of what new words have
            no_end = math.log10(0.5) if total == 0 else 0.0
            first[fresh] = math.log10(new) - scale + no_end
            listed = [c.words[i] for i in fresh.tolist()]
            first[fresh] += np.where([w == END for w in listed], 0, spelling([w or b"-" for w in listed])) if listed else 0
            p = first[c.tokens]
            for order in range(2, depth + 2):
                c.learn(order)
                at, back, _, seen = c.contexts(order)
                values, _ = answers(c.told, order + depth)
                if not values:
                    continue
                own, seen = values[0][back], seen[back].astype(float)
                at, own, seen = at[own > 0], own[own > 0], seen[own > 0]
                # a word that is new is far below the least double at times: stay with logarithms there
                left = np.log10((seen - own + LENT) / (seen + LENT)) + p[at]
                straight = c.n[order][at] / (seen + LENT)
                p[at] = np.where(straight > 0, np.log10(straight + 10.0 ** np.maximum(left, -300)), left)
            base = np.log10((n + 0.1) / (total + 0.1 * (kinds + 1)))
            per = lambda x: np.bincount(c.doc, x, size)
            cols = np.bincount(c.doc, minlength=size), per((n > 0)[c.tokens]), np.full(size, total), per(base[c.tokens]), per(p)
            out = pa.table([*c.rows.select(kept).columns, *(pa.array(x.astype(t)) for x, t in zip(cols, ("i8", "i8", "i8", "f8", "f8")))], names=[*kept, *names])
            yield from out.filter(c.rows["__out"]).combine_chunks().to_batches()

    return told(table, replies).mapInArrow(tidied(score), schema_with(docs.select(*kept), "n_tokens long, n_known long, train_tokens long, base_score double, score double"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", (part_of("doc_id", 10) == 0).alias("held_out"))
    out = score_documents(docs, ~F.col("held_out"), keep=["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
