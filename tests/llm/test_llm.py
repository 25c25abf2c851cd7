"""Training-data operators against plain versions, on small tables with nulls, empty and long texts, ties and repeats."""

import hashlib
import math
import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from quillon.llm import bpe, chunks, fingerprints, language_id, line_dedup, lm, mixing, near_dup, passages, sharding, vector_dedup
from quillon.llm.common import components

WORDS = [f"w{i}" for i in range(400)]
LONG = " ".join(random.Random(3).choices(WORDS, k=6000))
ODD = [None, "", " ", "\n\n", "a", "A  b\tc\n", "é̂ ﬁ Straße ẹ́", "x" * 3000, LONG]


def docs(spark, rows=None):
    """doc_id, text, lang, source and a column whose name operators use."""
    rng = random.Random(1)
    rows = rows if rows is not None else [(i, t) for i, t in enumerate(ODD + [" ".join(rng.choices(WORDS, k=rng.randint(1, 60))) for _ in range(40)] + ["same text of some words here"] * 5)]
    full = [(i, t, None if i % 7 == 3 else ("en", "de")[i % 2], None if i % 11 == 5 else f"s{i % 3}", 1) for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, kept int")


@pytest.fixture(scope="module")
def table(spark):
    return docs(spark).cache()


def texts(df):
    return {r.doc_id: r.text or "" for r in df.collect()}


@pytest.mark.parametrize("run", [
    lambda d: line_dedup.drop_repeated_lines(d), lambda d: fingerprints.fingerprint(d), lambda d: sharding.shard_by_size(d), lambda d: near_dup.near_duplicates(d), lambda d: passages.repeated_passages(d),
    lambda d: vector_dedup.near_vectors(d.select(F.col("doc_id").alias("vec_id"), F.array(F.lit(1.0)).alias("embedding"), F.lit(1).alias("label"))),
    lambda d: language_id.identify_language(d, language_id.fit(d)), lambda d: bpe.encode(d, public_tokenizers.path(bpe.RANKS)), lambda d: lm.score_documents(d, d), lambda d: mixing.mix_sources(d.withColumn("size", F.length(F.coalesce("text", F.lit(""))).cast("long"))),
])
def test_empty_tables(spark, run):
    assert run(docs(spark, [])).count() == 0


def test_line_dedup(spark):
    rows = [(i, f"  Common LINE \nown {i}\n\nrare") for i in range(12)] + [(20, None), (21, ""), (22, "common line"), (23, "common line\ncommon line\nX")]
    rows = [(i, t if i > 3 else t.replace("\nrare", "")) for i, t in rows]
    got = {r.doc_id: r for r in line_dedup.drop_repeated_lines(docs(spark, rows), min_docs=10).collect()}
    assert got[0].text == "own 0\n" and got[0].n_dropped == 1 and got[0].n_lines == 3
    assert got[20].text == "" and got[20].n_lines == 1 and got[22].text == "" and got[23].text == "X" and got[23].n_dropped == 2
    assert got[5].text == "own 5\n\nrare"
    twice = docs(spark, [(1, "a\nb")] * 3)
    assert [r.text for r in line_dedup.drop_repeated_lines(twice, min_docs=3).collect()] == [""] * 3


def test_fingerprints(spark, table):
    got = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(table).collect()}
    plain = {}
    for i, t in texts(table).items():
        folded = t.lower() if t.isascii() else unicodedata.normalize("NFD", t).upper().lower()
        plain[i] = " ".join(folded.split())
    assert len(set(got.values())) == len(set(plain.values()))
    assert len({(got[i], plain[i]) for i in got}) == len(set(got.values()))
    narrow = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(table, bits=2).collect()}
    assert len({(narrow[i], plain[i]) for i in narrow}) == len(set(narrow.values())) == len(set(plain.values()))


def test_next_document(spark):
    rows = docs(spark, [(i * 3, f"t{i}") for i in range(300)]).select("doc_id", "text")
    got = {r.doc_id: r.next_text for r in fingerprints.with_next(rows, ["text"]).collect()}
    assert all(got[i * 3] == f"t{(i + 1) % 300}" for i in range(300))


def test_sharding(spark, table):
    got = sharding.shard_by_size(table, shards=5).collect()
    source = texts(table)
    sizes = Counter()
    slots = {}
    where = {}
    for r in got:
        t = source[r.doc_id]
        assert r["size"] == len(t.encode()) + 1 and r.text_crc32 == zlib.crc32(t.encode())
        sizes[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
        where.setdefault(t, set()).add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(w) == 1 for w in where.values())
    groups = {}
    for i in sorted(source):
        groups.setdefault(source[i], 0)
        groups[source[i]] += len(source[i].encode()) + 1

    def shards_for(c):
        n, held = 1, 0
        for g in groups.values():
            n, held = (n + 1, g) if held + g > c else (n, held + g)
        return n

    best = next(c for c in range(max(groups.values()), sum(groups.values()) + 1) if shards_for(c) <= 5)
    assert max(sizes.values()) == best


def test_capacity_search_by_block():
    rng = random.Random(2)
    sizes = [rng.choice([1, 5, 400]) for _ in range(500)]
    ends, blocks = np.cumsum(sizes).tolist(), []
    for i in range(0, 500, 25):
        blocks.append((ends[i] - sizes[i], ends[i + 24], 25))
    asked = []

    def fetch(ks):
        asked.extend(ks)
        return {k: ends[25 * k : 25 * k + 25] for k in ks}

    cuts = sharding.Sequence(blocks, fetch, max(sizes)).best(7)
    widest = max(b - a for a, b in zip([0, *cuts], cuts))

    def shards_for(c):
        n, held = 1, 0
        for g in sizes:
            n, held = (n + 1, g) if held + g > c else (n, held + g)
        return n

    assert shards_for(widest) <= 7 and shards_for(widest - 1) > 7


def test_mixing(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 3, 40]))) for i in range(900)]
    d = docs(spark, rows).withColumn("size", F.regexp_count("text", F.lit("w")).cast("long"))
    got = mixing.mix_sources(d, fan_in=16).collect()
    per = {}
    for r in got:
        assert 0 <= r.copies <= 2
        per.setdefault(r.source, []).append(r)
    sizes = {s: sum(r["size"] for r in rs) for s, rs in per.items()}
    goal = mixing.targets(sizes)
    assert abs(sum(goal.values()) - 1.5 * sum(sizes.values())) < 1e-6 and len(got) == 900
    for s, rs in per.items():
        assert abs(rs[0].target - goal[s]) < 1e-6 and goal[s] <= 2 * sizes[s] + 1e-9
        assert abs(sum(r["size"] * r.copies for r in rs) - goal[s]) <= 41
    again = {r.doc_id: r.copies for r in mixing.mix_sources(d.repartition(7), fan_in=16).collect()}
    assert again == {r.doc_id: r.copies for r in got}


def test_pivot_keeps_expectation():
    rng = np.random.default_rng(1)
    size = rng.integers(1, 50, 30).astype(float)
    p = rng.random(30)
    runs = np.array([mixing.pivot(p, size, np.random.default_rng(s)) for s in range(3000)])
    assert np.allclose((runs * size).sum(1), (p * size).sum()) and np.abs(runs.mean(0) - p).max() < 0.05
    assert (((runs > 1e-9) & (runs < 1 - 1e-9)).sum(1) <= 1).all()


def test_lm(spark, table):
    train = table.where("doc_id % 4 <> 0")
    got = lm.score_documents(table, train).collect()
    source = {i: t.encode().lower().split() for i, t in texts(table).items()}
    c = Counter(w for i, ws in source.items() if i % 4 for w in ws)
    n_docs = sum(1 for i in source if i % 4)
    total, kinds = sum(c.values()) + n_docs, len(c) + 1
    base = lambda x: math.log10((x + 0.1) / (total + 0.1 * (kinds + 1)))
    for r in got:
        ws = source[r.doc_id]
        assert r.n_tokens == len(ws) + 1 and r.n_known == sum(c[w] > 0 for w in ws) + 1 and r.train_tokens == total
        assert r.base_score == pytest.approx(sum(base(c[w]) for w in ws) + base(n_docs))
        assert math.isfinite(r.score) and r.score < 0
    few = {r.doc_id: r for r in lm.score_documents(table, F.col("doc_id") % 4 != 0, chunk_words=40).collect()}
    assert all(few[r.doc_id].score == pytest.approx(r.score) and few[r.doc_id].n_known == r.n_known for r in got)


def plain_scores(source, learnt, depth):
    """Scores by plain counts of runs of words."""
    token = {i: [*t.encode().lower().split(), b""] for i, t in source.items()}
    runs = Counter(tuple(ws[j : j + k]) for i, ws in token.items() if i in learnt for k in range(1, depth + 2) for j in range(len(ws) - k + 1))
    total = sum(n for r, n in runs.items() if len(r) == 1)
    once = [r[0] for r, n in runs.items() if len(r) == 1 and n == 1]
    counts = Counter()
    for w in once:
        if w:
            buffer, ctx, _ = lm.spelled([w])
            counts.update(zip(ctx.tolist(), buffer.tolist()))
    spelling, new = lm.Spelling([(c, x, n) for (c, x), n in counts.items()]), max(1, len(once))
    after = {}
    for r, n in runs.items():
        if len(r) > 1 and n >= 2:
            after.setdefault(r[:-1], {})[r[-1]] = n
    states = {}
    for s, nexts in after.items():
        n, gain = runs[s], 0.0
        for x, k in nexts.items():
            q = runs[(*s[1:], x)] / (runs[s[1:]] if len(s) > 1 else total)
            gain += k * math.log((k - 1 + q) / (n - 1 + 1) / q)
        rest = n - sum(nexts.values())
        gain += rest * math.log(1 / n)
        if gain >= lm.MIN_GAIN:
            states[s] = n, nexts

    def p(history, x):
        out = runs[x,] / (total + new) if runs[x,] else new / (total + new) * (0.5 if total == 0 else 1) * (1 if x == b"" else 10 ** float(spelling([x])[0]))
        for k in range(1, depth + 1):
            s = tuple(history[-k:])
            if len(s) == k and s in states:
                n, nexts = states[s]
                out = (nexts.get(x, 0) + (n - sum(nexts.values()) + 1) * out) / (n + 1)
        return out

    return {i: sum(math.log10(p(ws[:j], x)) for j, x in enumerate(ws)) for i, ws in token.items()}, p, [r[0] for r in runs if len(r) == 1], states


def sequences():
    """Texts in which a word depends on the one before it, new words in some."""
    rng, follow = random.Random(11), {w: random.Random(w).choices(WORDS[:60], k=3) for w in WORDS[:60]}
    rows = []
    for i in range(160):
        ws = [rng.choice(WORDS[:60])]
        while len(ws) < 40:
            ws.append(rng.choice(follow[ws[-1]]) if rng.random() < 0.9 else rng.choice(WORDS[:60]))
        rows.append((i, " ".join(ws + [f"new{i}"] * (i % 9 == 0))))
    return rows + [(500 + i, t) for i, t in enumerate(ODD)] + [(600 + i, "a phrase that comes again and again in a text") for i in range(4)]


@pytest.mark.parametrize(("depth", "chunk_words"), [(2, 300), (3, 10**6)])
def test_lm_against_plain_counts(spark, depth, chunk_words):
    rows = sequences()
    source = {i: t or "" for i, t in rows}
    learnt = {i for i in source if i % 4}
    want, p, known, states = plain_scores(source, learnt, depth)
    got = {r.doc_id: r for r in lm.score_documents(docs(spark, rows), F.col("doc_id") % 4 != 0, depth=depth, chunk_words=chunk_words).collect()}
    assert len(states) > 50 and any(len(s) == 2 for s in states)
    for i, r in got.items():
        assert r.score == pytest.approx(want[i], rel=1e-6), i
    # all next words of a history: known ones, and the rest of the mass for new ones
    for history in ([], [b"w5"], [b"w5", b"w7"], [b"that", b"comes"], [b"nothing"]):
        assert 0 < p(history, b"zzq") < 1 - sum(p(history, x) for x in known)
    held = [r for i, r in got.items() if i % 4 == 0 and i < 160]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 30
    plain, _, _, _ = plain_scores(source, learnt, 0)
    assert sum(r.score for r in held) > sum(plain[r.doc_id] for r in held) + 100


def test_lm_is_a_distribution():
    words = [w.encode() for w in ["abc", "abd", "abab", "b", "ähm"] * 20]
    buffer, ctx, _ = lm.spelled(words)
    rows = [(c, x, n) for (c, x), n in Counter(zip(ctx.tolist(), buffer.tolist())).items()]
    for known in (rows, []):
        s = lm.Spelling(known)
        assert np.allclose((10.0**s.one).sum(1), 1) and np.allclose((10.0**s.two).sum(1), 1)
        assert (s([b"abc", b"zzzz"])[0] > s([b"zzzz"])[0]) or not known
        # all words of up to two bytes and the mass of longer ones, by the chance of no blank
        short = 10.0 ** s([bytes([a]) for a in range(256) if a not in b" "])
        assert 0 < short.sum() < 1
    _, p, known, _ = plain_scores(dict(sequences()[:160]), set(range(160)), 2)
    for history in ([], [b"w5"], [b"w5", b"w7"]):
        rest = 1 - sum(p(history, x) for x in known)
        # what known words leave is what new words share: twice the spelling, twice the share
        s = [p(history, w) for w in (b"zzq", b"new77")]
        assert rest > 0 and all(0 < x < rest for x in s)


def jaccard_components(sets, least=0.8):
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j]:
                k = len(sets[i] & sets[j])
                if k >= least * (len(sets[i]) + len(sets[j]) - k):
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, n=4):
    ws = text.lower().split()
    return {tuple(ws[i : i + n]) for i in range(max(1, len(ws) - n + 1))} if ws else set()


@pytest.mark.parametrize("block", [512, 4])
def test_near_duplicates(spark, block):
    rng = random.Random(7)
    rows, base = [], [rng.choices(WORDS, k=k) for k in (8, 60, 300)]
    for i in range(90):
        b = list(base[i % 3])
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            b[rng.randrange(len(b))] = rng.choice(WORDS)
        rows.append((i, " ".join(b)))
    rows += [(100 + i, t) for i, t in enumerate(ODD)] + [(200 + i, "the same") for i in range(4)]
    got = {r.doc_id: r for r in near_dup.near_duplicates(docs(spark, rows), block=block).collect()}
    sets = {i: shingles(t or "") for i, t in rows}
    want = jaccard_components(sets)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.n_shingles == len(sets[i]) and r.kept == (r.doc_id == r.component_id) for i, r in got.items())


def test_estimate():
    rng = np.random.default_rng(2)
    for share in (0.5, 0.8, 0.95):
        common = rng.integers(0, 2**63, int(4000 * share), dtype=np.uint64)
        rest = [rng.integers(0, 2**63, int(4000 * (1 - share) / 2), dtype=np.uint64) for _ in range(2)]
        a, b = (np.unique(np.r_[common, r]) for r in rest)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        got = near_dup.estimate(near_dup.registers(a)[None], near_dup.registers(b)[None], np.array([len(a)]), np.array([len(b)]))[0]
        assert abs(got - true) < 0.15


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(140)] + [(0, i) for i in range(300, 340)] + [(i, i + 1) for i in range(400, 430)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: find(i) for e in edges if e[0] != e[1] for i in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def linked_components(links):
    out = {}
    for i in sorted(links):
        todo = [i]
        while todo:
            j = todo.pop()
            if j not in out:
                out[j] = i
                todo += links[j]
    return out


def test_vectors_of_64_dimensions(spark):
    """Recall on planted links: groups of near copies, one of them large, among vectors that link with nothing."""
    rng, rows = np.random.default_rng(8), []
    unit = lambda: rng.normal(size=64) / 8
    for size in [1] * 300 + [2, 3, 5] * 30 + [150]:
        centre = unit()
        rows += [(len(rows) + k, [float(x) for x in centre + 0.18 * unit()], 1) for k in range(size)]
    x = np.array([v for _, v, _ in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = (x @ x.T >= 0.93) & ~np.eye(len(x), dtype=bool)
    links = {i: set(np.flatnonzero(r).tolist()) for i, r in enumerate(near)}
    for block in (1024, 32):
        got = {r.vec_id: r for r in vector_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), block=block).collect()}
        assert all(got[i].n_links <= len(links[i]) for i in links)
        assert sum(r.n_links for r in got.values()) >= 0.995 * near.sum() and near.sum() > 10_000
        components = linked_components(links)
        assert sum(got[i].component_id == components[i] for i in links) >= 0.995 * len(links)


def test_vectors(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(160):
        v = rng.normal(size=16) if i % 4 == 0 else np.array(rows[i - i % 4][1]) + rng.normal(size=16) * rng.choice([0, 0.05, 0.2])
        rows.append((i, [float(np.float32(x)) for x in v], i % 3 if i % 13 else None))
    rows += [(200, None, 1), (201, [0.0] * 16, 1), (202, [float("nan")] * 16, 1), (203, [None] * 16, 1), (204, [], 1), (205, rows[4][1][:8], 1)] + [(210 + i, rows[1][1], 1) for i in range(6)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    ok = [(i, np.array(v, float), k) for i, v, k in rows if k is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    links = {i: set() for i, *_ in rows}
    for i, v, k in ok:
        for j, w, m in ok:
            if i != j and k == m and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= 0.93:
                links[i].add(j)
    for block in (1024, 16):
        got = {r.vec_id: r for r in vector_dedup.near_vectors(d, block=block).collect()}
        found = sum(r.n_links for r in got.values())
        want = sum(map(len, links.values()))
        assert all(got[i].n_links <= len(links[i]) for i in links) and found >= 0.99 * want and want > 50
        if found == want:
            assert {i: r.component_id for i, r in got.items()} == linked_components(links)
        assert all(r.kept == (r.vec_id == r.component_id) for r in got.values()) and len(got) == len(rows)


def test_passages(spark):
    rng = random.Random(9)
    passage = rng.choices(WORDS, k=70)
    rows = []
    for i in range(30):
        p = list(passage)
        if i % 3 == 2:
            p[20], p[45:47] = "changed", []
        rows.append((i, " ".join(rng.choices([f"{i}x{j}" for j in range(500)], k=50) + p + rng.choices([f"{i}y{j}" for j in range(500)], k=30))))
    rows += [(100 + i, " ".join(rng.choices([f"{i}z{j}" for j in range(900)], k=200))) for i in range(10)] + [(200 + i, t) for i, t in enumerate(ODD[:7])]
    got = passages.repeated_passages(docs(spark, rows)).collect()
    first = [r for r in got if r.ref_doc_id == 0]
    assert {r.doc_id for r in first} == set(range(1, 30)) and max(r.doc_id for r in got) < 30
    for r in first:
        assert r.start_word == 50 and r.end_word == (118 if r.doc_id % 3 == 2 else 120) and r.ref_start_word == 50 and r.ref_end_word == 120


def test_passages_changed(spark):
    """Recall by brute force: of pairs whose passages differ in 5 to 20 % of their words and are 0.8 alike or more."""
    rng, rows, alike = random.Random(4), [], {}
    for n, share in [(60, 0.05), (60, 0.1), (60, 0.15), (80, 0.1), (100, 0.15), (100, 0.2)]:
        for case in range(40):
            i, first = len(rows), [f"p{len(rows)}x{j}" for j in range(n)]
            second = [f"c{i}x{j}" if rng.random() < share else w for j, w in enumerate(first)]
            rows += [(i + d, " ".join([f"a{i + d}x{j}" for j in range(30)] + p + [f"b{i + d}x{j}" for j in range(30)])) for d, p in enumerate((first, second))]
            if sum(map(str.__eq__, first, second)) >= 0.8 * n:
                alike.setdefault((n, share), []).append((i + 1, i))
    got = {(r.doc_id, r.ref_doc_id) for r in passages.repeated_passages(docs(spark, rows)).collect()}
    recall = {k: sum(p in got for p in pairs) / len(pairs) for k, pairs in alike.items()}
    assert min(recall.values()) >= 0.8 and recall[60, 0.05] == 1 and sum(recall.values()) >= 0.95 * len(recall), recall


def test_passages_behind_other_holders(spark):
    passage = [f"p{j}" for j in range(60)]
    filled = lambda i, words: (i, " ".join([f"a{i}x{j}" for j in range(30)] + words + [f"b{i}x{j}" for j in range(30)]))
    # every seed is first held by a document with a part of the passage
    rows = [filled(i, passage[12 * i : 12 * i + 24]) for i in range(5)] + [filled(i, passage) for i in (10, 11, 12)]
    got = {(r.doc_id, r.ref_doc_id): r for r in passages.repeated_passages(docs(spark, rows)).collect()}
    assert set(got) == {(11, 10), (12, 10)} and all((r.start_word, r.end_word, r.ref_start_word, r.similarity) == (30, 90, 30, 1.0) for r in got.values())


def test_passages_changed_behind_other_holders(spark):
    """Passages of two later documents whose seeds all have an earlier first holder without the passage, and a common line."""
    passage = [f"p{j}" for j in range(64)]
    changed = [f"c{j}" if j % 13 == 6 else w for j, w in enumerate(passage)]
    filled = lambda i, words: (i, " ".join([f"a{i}x{j}" for j in range(60)] + words + [f"b{i}x{j}" for j in range(60)]))
    rows = [filled(i, passage[8 * i : 8 * i + 20]) for i in range(7)] + [filled(10, passage), filled(12, changed)]
    rows += [filled(20 + i, [f"l{j}" for j in range(16)]) for i in range(600)]  # more than a block of holders
    got = [(r.doc_id, r.ref_doc_id, r.start_word, r.end_word, r.ref_start_word, r.ref_end_word, r.matched) for r in passages.repeated_passages(docs(spark, rows)).collect()]
    assert got == [(12, 10, 60, 124, 60, 124, 59)]


def test_words_around_against_plain_subsequences():
    rng = np.random.default_rng(5)
    reach, look = passages.LOOK + passages.MORE, passages.LOOK
    sigs = rng.integers(0, 6, (40, 2 * reach)).astype(np.uint8)
    sigs[20:] = np.where(rng.random((20, 2 * reach)) < rng.uniform(0.5, 1, (20, 1)), sigs[:20], rng.integers(6, 99, (20, 2 * reach)))

    def common(x, y):
        row = [0] * (len(y) + 1)
        out = [0]
        for w in x:
            before, row = row, [0]
            for j, v in enumerate(y):
                row.append(max(row[-1], before[j + 1], before[j] + (w == v and w > 0)))
            out.append(row[-1])
        return out

    p, q = np.arange(20, 40), np.arange(20)
    got, want = passages.around_alike(sigs, p, q, 50, 0.8), []
    for x, y in zip(sigs[p].tolist(), sigs[q].tolist()):
        ahead, behind = common(x[reach : reach + look], y[reach:]), common(x[reach - look : reach][::-1], y[:reach][::-1])
        want.append(any(100 * (ahead[a] + behind[b]) >= 70 * (a + b) for a in range(look + 1) for b in range(look + 1) if a + b >= 50))
    assert got.tolist() == want and 0 < sum(want) < 20


@pytest.mark.parametrize("rows", [20, 90])
def test_bound_on_words_around(rows):
    """A bound on pairs of many rows leaves out none that is alike, whether one block or two are compared."""
    rng = np.random.default_rng(6)
    sigs = rng.integers(0, 9, (rows, 2 * (passages.LOOK + passages.MORE))).astype(np.uint8)
    sigs[1:] = np.where(rng.random((rows - 1, 1)) < 0.5, np.where(rng.random((rows - 1, 1)) < 0.3, sigs[:-1], sigs[:1]), sigs[1:])
    sigs = np.where(rng.random(sigs.shape) < rng.uniform(0, 0.6, (rows, 1)), rng.integers(9, 250, sigs.shape), sigs).astype(np.uint8)
    for sides in (None, rng.integers(3, 5, rows), np.full(rows, 3)):
        p, q = np.tril_indices(rows, -1)
        ok = passages.around_alike(sigs, p, q, 50, 0.8) & (True if sides is None else sides[p] != sides[q])
        got = [pair for a, b in passages._candidates(sigs, sides, 50, 0.8) for pair in zip(a.tolist(), b.tolist())]
        assert len(got) == len(set(got)) and {*zip(p[ok].tolist(), q[ok].tolist())} <= set(got) and all(sides is None or sides[a] != sides[b] for a, b in got)
        assert ok.any() or sides is not None and len(set(sides)) == 1


def test_short_common_runs_make_no_pairs(spark):
    """Places that share a line of 45 words and nothing else are no pairs, though 0.7 of the words around are alike; a passage
    that goes on behind a gap is one, and of copies only the first is named."""
    line = [f"l{j}" for j in range(45)]
    filled = lambda i, words: (i, " ".join([f"a{i}x{j}" for j in range(60)] + words + [f"b{i}x{j}" for j in range(60)]))
    rows = [filled(i, line) for i in range(100)] + [filled(200 + i, line + [f"g{i}x{j}" for j in range(14)] + [f"m{j}" for j in range(60)]) for i in range(2)]
    rows += [filled(300 + i, line + [f"n{j}" for j in range(9)]) for i in range(80)]
    d = docs(spark, rows).select("doc_id", "text")
    tied = passages.materialise(d.select(F.lit(7).cast("long").alias("seed"), "doc_id", F.lit(80).alias("pos"), F.col("doc_id").alias("ref"), F.lit(80).alias("at")))
    got = {(r.doc_id, r.ref): [tuple(m) for m in r.matches] for r in passages._paired(tied, d, 50, 0.8, "bigint").collect()}
    wanted = {(201, 200): [(80, 80)]} | {(300 + i, 300): [(80, 80)] for i in range(1, 80)}
    assert wanted.items() <= got.items() and len(got) - len(wanted) < 0.1 * 102 * (101 + 2 * 80) / 2  # words of like hashes leave some


def test_runs_of_one_word_make_few_pairs(spark):
    """Runs of one word, of which each has other words around it, make a pair or two each, however many they are; each
    is a passage of an earlier document as far as any has it."""
    filled = lambda i, n: (i, " ".join([f"a{i}x{j}" for j in range(70)] + ["the"] * n + [f"b{i}x{j}" for j in range(70)]))
    lengths = {10 + i: 50 + i * 7 % 41 for i in range(120)}
    rows = [filled(0, 9)] + [filled(i, n) for i, n in lengths.items()] + [filled(200 + i, 30 + i % 20) for i in range(120)]
    seed = [(7, i, p, i, 70) for i, n in lengths.items() for p in (70, 65 + n)] + [(7, 200 + i, p, 200 + i, 70) for i in range(120) for p in (70, 95 + i % 20)]
    d = docs(spark, rows).select("doc_id", "text")
    tied = passages.materialise(spark.createDataFrame(seed, "seed long, doc_id long, pos int, ref long, at int"))
    got = [(r.doc_id, r.ref) for r in passages._paired(tied, d, 50, 0.8, "bigint").collect()]
    assert len(got) <= 3 * 120 and {i for i, _ in got} >= set(lengths) - {10}
    found = {}
    for r in passages.repeated_passages(d).collect():
        assert r.doc_id > r.ref_doc_id and r.doc_id in lengths and r.ref_doc_id in lengths
        found[r.doc_id] = max(found.get(r.doc_id, 0), r.end_word - r.start_word)
    assert found == {i: min(n, max(lengths[j] for j in range(10, i))) for i, n in lengths.items() if i > 10}


def test_runs_of_one_word_leave_no_passage_out():
    """Against alignments of all places: what is left out is within two runs of one word that are as long as passages."""
    rng, known, reach = random.Random(8), passages._Bytes(), passages.LOOK + passages.MORE + passages.BEYOND
    some = [[w] * rng.randint(5, 60) for w in ("a", "b", "c") for _ in range(3)]
    texts_, places = [], {}
    for i in range(60):
        runs = [rng.choice(some) if rng.random() < 0.3 else [rng.choice("abc")] * rng.randint(1, 70) if rng.random() < 0.6 else [f"u{i}x{rng.randint(0, 99)}" if rng.random() < 0.7 else rng.choice("defabc") for _ in range(rng.randint(1, 40))] for _ in range(6)]
        texts_.append([w.encode() for run in runs for w in run])
        for p, seed in zip(*map(np.ndarray.tolist, passages.Seeds().runs(" ".join(w for run in runs for w in run)))):
            if len(set(texts_[i][p : p + passages.K])) == 1:
                places.setdefault(seed, []).append((i, p))
    kept, whole = {}, {}
    for of_seed in places.values():
        wide, held = np.zeros((len(of_seed), 2 * reach), np.uint16), []
        for row, (i, p) in enumerate(of_seed):
            line = [0] * reach + [known[w] for w in texts_[i]] + [0] * reach
            wide[row] = line[p : p + 2 * reach]
            a, b = p, p
            while a > 0 and texts_[i][a - 1] == texts_[i][p]:
                a -= 1
            while b < len(texts_[i]) and texts_[i][b] == texts_[i][p]:
                b += 1
            own = [x for j, x in of_seed if j == i and a <= x < b]
            held.append((b - a, a, min(own), max(own), len(own)))
        may = passages.OneWord(wide, np.array([p for _, p in of_seed]), dict(zip(passages.RUN, np.array(held, np.int32).T)), 50, 0.8, passages.K)
        ok = may(np.arange(len(of_seed))[:, None], np.arange(len(of_seed)))
        for x, y in np.argwhere(np.tri(len(of_seed), k=-1)).tolist():
            (i, p), (j, q) = of_seed[x], of_seed[y]
            if i != j:
                whole.setdefault((i, j), []).append((p, q))
                if ok[x, y]:
                    kept.setdefault((i, j), []).append((p, q))
    left_out = 0
    for (i, j), matches in whole.items():
        found = [span for ms in (matches, kept.get((i, j), [])) for span in [[s for c in passages.chains(ms) for s in passages.spans(texts_[i], texts_[j], c, passages.K, 50, 0.8)]]]
        for s in found[0]:
            if not any(t[0] < s[1] and s[0] < t[1] and t[2] < s[3] and s[2] < t[3] for t in found[1]):
                left_out += 1
                assert len(set(texts_[i][s[0] : s[1]])) == 1 == len(set(texts_[j][s[2] : s[3]])) and min(s[1] - s[0], s[3] - s[2]) >= 50
    assert left_out > 20 and sum(map(len, kept.values())) < sum(map(len, whole.values()))


@pytest.mark.parametrize("period", [1, 12, 30])
def test_passages_with_a_period(spark, period):
    run = [f"p{j}" for j in range(period)] * (60 // period)
    rows = [(i, " ".join([f"a{i}x{j}" for j in range(30)] + run + [f"b{i}x{j}" for j in range(30)])) for i in range(3)]
    got = [(r.doc_id, r.ref_doc_id, r.start_word, r.end_word, r.matched) for r in passages.repeated_passages(docs(spark, rows)).collect()]
    assert sorted(got) == [(1, 0, 30, 90, 60), (2, 0, 30, 90, 60)]


def test_chains_against_all_pairs():
    rng = random.Random(6)
    for _ in range(40):
        matches = sorted({(rng.randrange(40), rng.randrange(40)) for _ in range(rng.randint(1, 14))})
        best = {}
        for a, b in matches:
            best[a, b] = max([5.0] + [5.0 + best[c, d] - 0.1 * (a - c + b - d) for c, d in best if c < a and d < b])
        path = passages.chains(matches, 5, 0.1)[0]
        score = 5.0 * len(path) - 0.1 * sum(c - a + d - b for (a, b), (c, d) in zip(path, path[1:]))
        assert score == pytest.approx(max(best.values())) and all(a < c and b < d for (a, b), (c, d) in zip(path, path[1:]))


def test_language(spark):
    rng = random.Random(8)
    vocabulary = {"en": "the of and that with this which would people thing".split(), "de": "der und nicht eine sich werden über haben schön straße".split()}
    rows = [(i, " ".join(rng.choices(vocabulary[k], k=30)), k) for i in range(120) for k in (("en", "de")[i % 2],)]
    d = spark.createDataFrame(rows + [(500, None, "en"), (501, "12 34 !", "de"), (502, "", None)], "doc_id long, text string, lang string")
    content = language_id.fit(d.where("doc_id % 3 <> 0"))
    got = {r.doc_id: r for r in language_id.identify_language(d, content).collect()}
    assert sum(got[i].lang_pred == k for i, _, k in rows if i % 3 == 0) >= 39
    assert all(got[i].lang_pred == "und" and got[i].rejected and got[i].score == 0 for i in (500, 501, 502)) and all(0 <= r.score <= 1 for r in got.values())


@pytest.mark.parametrize("chunk_words", [bpe.ENCODED_WORDS, 50])
def test_bpe(spark, table, chunk_words):
    path = public_tokenizers.path(bpe.RANKS)
    coder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    more = docs(spark, [(900 + i, t) for i, t in enumerate(["a  b", "a   b", " \n  b", "a\n \nb", "  a", "x \n", "don't 's", "<|endoftext|>"])])
    both = table.unionByName(more)
    source = texts(both)
    for r in bpe.encode(both, path, digest=True, chunk_words=chunk_words).collect():
        ids = np.array(coder.encode_ordinary(source[r.doc_id]), "<u4")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest() and r.decoded_sha256 == hashlib.sha256(source[r.doc_id].encode()).hexdigest()
    assert bpe.encode(both, path, chunk_words=chunk_words).count() == len(source)
    for r in bpe.decode(bpe.encode(both, path, chunk_words=chunk_words), path).collect():
        assert bytes(r.decoded).decode() == source[r.doc_id]


def test_chunks_take_short_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, None)
    d = docs(spark, [(i, f"w{i % 7} of text") for i in range(2 * chunks.BATCH_ROWS + 300)]).coalesce(1)
    table = chunks.chunked(d, lambda: str.split, ["doc_id"])
    held = [len(c) for r in table.collect() for c in chunks.kept_rows(bytes(r.rows)).column("doc_id").chunks]
    assert sum(held) == d.count() and max(held) <= chunks.BATCH_ROWS and spark.conf.get(name, None) == before
    spark.conf.set(name, "50")
    try:
        small = chunks.chunked(d, lambda: str.split, ["doc_id"]).first()
        assert max(len(c) for c in chunks.kept_rows(bytes(small.rows)).column("doc_id").chunks) <= 50 and spark.conf.get(name) == "50"
    finally:
        spark.conf.unset(name)


def test_pipeline_stages(spark):
    """Each stage against a plain version of it, on nulls, empty texts, repeats and an empty table."""
    rng = random.Random(12)
    words = {"en": "the of and that with this which would people thing".split(), "de": "der und nicht eine sich werden über haben schön straße".split()}
    rows = [(i, " ".join(rng.choices(words[k], k=40)) + "\nShared line here\n" + f"tail {i}", k, f"s{i % 2}") for i in range(60) for k in (("en", "de")[i % 2],)]
    rows += [(100, rows[0][1] + " x", "en", "s0"), (101, rows[0][1], "en", "s1"), (102, None, "en", "s0"), (103, "", None, None), (104, "12 34", "de", "s1")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language_id"](spark, d, "")
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} >= set(range(60)) and not {r.doc_id for r in kept.collect()} & {102, 103, 104}
    cut = {r.doc_id: r for r in stages["line_dedup"](spark, d, "").collect()}
    plain = {i: "\n".join(x for x in (t or "").split("\n") if x != "Shared line here") for i, t, *_ in rows}
    assert {i: r.text for i, r in cut.items()} == plain and all(r.n_chars == len(r.text) for r in cut.values())
    sets = {i: shingles(t or "", 5) for i, t, *_ in rows}
    want = jaccard_components(sets)
    assert {r.doc_id for r in stages["near_dup"](spark, d, "").collect()} == {i for i in want if want[i] == i}
    mixed = Counter(r.doc_id for r in stages["mix_sources"](spark, d, "").collect())
    assert set(mixed.values()) <= {1, 2} and sum(len((t or "").split()) * mixed[i] for i, t, *_ in rows) == pytest.approx(1.5 * sum(len((t or "").split()) for _, t, *_ in rows), abs=90)
    coder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path(bpe.RANKS)), special_tokens={})
    assert all(r.n_tokens == len(coder.encode_ordinary(dict((i, t) for i, t, *_ in rows)[r.doc_id] or "")) for r in stages["byte_bpe"](spark, d, "").collect())
    empty = d.where("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, "")
        assert out.count() == 0 and (name == "byte_bpe" or out.columns == d.columns)


def test_op8_columns(spark, tmp_path):
    rows = [(3, "abcdefghij"), (1, None), (7, "É b  C"), (5, "xy"), (9, "é B c")]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in fingerprints.op8_fingerprints(spark, str(tmp_path)).collect()}
    ordered = sorted((i, t or "") for i, t in rows)
    for (i, t), (j, following) in zip(ordered, ordered[1:] + ordered[:1]):
        cut = len(t) // 4
        edited = t[: len(t) - cut] + following[:cut]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (got[i].near_next == 1) == (got[i].fingerprint == got[j].fingerprint) and (got[i].near_edited == 1) == (got[i].fingerprint == got[i].edited_fingerprint)
    assert got[7].fingerprint == got[9].fingerprint != got[3].fingerprint and got[7].near_next == 1 and got[3].near_next == 0


def test_near_duplicates_with_clashing_names(spark):
    d = docs(spark, [(1, "a b c d e f"), (2, "a b c d e f"), (3, "other words in this text")]).withColumnsRenamed({"source": "rep", "lang": "id"})
    assert {r.doc_id: r.component_id for r in near_dup.near_duplicates(d).collect()} == {1: 1, 2: 1, 3: 3}
