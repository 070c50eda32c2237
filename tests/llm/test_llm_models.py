"""Learned operators, near duplicates, archives and the pipeline."""
import io
import itertools
import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sponsorlens.llm import components, embedding_dedup, hmm_scores, minhash_dedup, quality_crf, warc

SF = "/root/testdata/sf0.001"


# -- archives

@pytest.mark.parametrize("compressed", [True, False])
def test_salvage_recovers_what_is_whole(compressed):
    r = random.Random(1)
    rows = [warc.record("response", f"urn:page:{i}", (f"WARC/1.1\r\nContent-Length: 3\r\n {i} " * r.randint(0, 99)).encode() + r.randbytes(50), "u", None)
            for i in range(100)]
    parts = [warc.member(x) if compressed else x for x in rows]
    at = [0, *itertools.accumulate(map(len, parts))]
    data = bytearray(b"".join(parts))
    assert [g[2] for g in warc.salvage(io.BytesIO(bytes(data)))] == [None] * 100
    hurt = {0, 5, 6, 50, 99}
    for i in hurt:
        data[(at[i] + at[i + 1]) // 2] ^= 0xFF
    data[at[80] : at[80]] = b"garbage" * 1000
    got = list(warc.salvage(io.BytesIO(bytes(data))))
    ids = {int(g[3]["warc-record-id"].strip("<>").rpartition(":")[2]) for g in got if g[2] is None}
    assert ids == set(range(100)) - hurt
    assert sum(g[1] for g in got) == len(data)            # every byte is in a record or in a gap
    assert (at[79 + 1], 7000) in [(g[0], g[1]) for g in got if g[2]]


def test_salvage_of_truncated_empty_and_foreign_files():
    whole = warc.member(warc.record("response", "urn:page:1", b"x" * 5000, "", None))
    got = list(warc.salvage(io.BytesIO(whole + whole[:-20])))
    assert [g[2] is None for g in got] == [True, False]
    assert list(warc.salvage(io.BytesIO(b""))) == []
    assert [g[1] for g in warc.salvage(io.BytesIO(b"no archive"))] == [10]


class Counted(io.BytesIO):
    """A stream that knows how much was read from it."""
    told = 0

    def read(self, n=-1):
        got = super().read(n)
        self.told += len(got)
        return got


def test_a_damaged_length_does_not_read_the_rest():
    small = [warc.record("response", f"urn:page:{i}", b"x" * 500, "", None) for i in range(3)]
    data = small[0].replace(b"Content-Length: 500", b"Content-Length: 9000000") + small[1] + small[2] + b"z" * (10 << 20)
    stream = Counted(data)
    got = warc.salvage(stream)
    assert [next(got)[:2], next(got)[0]] == [(0, len(small[0]) + 4), len(small[0]) + 4]
    assert stream.told <= 3 << 20
    for length in (b"9" * 5000, "²".encode(), b"-1"):
        found = list(warc.salvage(io.BytesIO(small[0].replace(b"Content-Length: 500", b"Content-Length: " + length) + small[1])))
        assert [g[2] is None for g in found] == [False, True]


def test_salvage_of_a_large_file_with_a_damaged_start():
    for kind in (warc.member, bytes):
        rows = [kind(warc.record("response", f"urn:page:{i}", random.Random(i).randbytes(1 << 20), "", None)) for i in range(4)]
        got = list(warc.salvage(io.BytesIO(b"?" * (3 << 20) + b"".join(rows))))
        assert [g[2] is None for g in got] == [False, True, True, True, True] and got[0][:2] == (0, 3 << 20)


def test_read_salvages_damaged_members_of_a_file(spark):
    pages = spark.createDataFrame([(i, f"page {i} " * 500, "u") for i in range(50)], "page_id long, html string, url string").coalesce(1)
    for row in warc.write(pages).collect():
        fs, name = warc.open_store(row.file)
        with fs.open_input_file(name) as f:
            data = bytearray(f.read())
        assert len(data) == row.bytes
        if row.records < 3:
            continue
        # The second member's middle.
        second = data.index(warc.GZIP, 10)
        data[(second + data.index(warc.GZIP, second + 10)) // 2] ^= 0xFF
        hurt = row.file.replace(".warc.gz", "-hurt.warc.gz")
        with fs.open_output_stream(warc.open_store(hurt)[1], compression=None) as f:
            f.write(bytes(data))
        got = warc.read(spark.createDataFrame([(hurt,)], "file string")).collect()
        assert sum(r.gap is None for r in got) == row.records - 1 and sum(r.gap is not None for r in got) == 1
        assert sum(r.length for r in got) == len(data)


@pytest.mark.parametrize("least", [0, 3])
def test_warc_revisits(spark, least):
    rows = [(1, "same"), (2, "same"), (None, "same"), (3, None), (4, ""), (5, "own"), (5, "own"), (None, "alone"), (6, "ü" * 9000)]
    pages = spark.createDataFrame([(i, h, "u", 1) for i, h in rows], "page_id long, html string, url string, payload int")
    got = warc.read(warc.write(pages, revisit_bytes=least)).collect()
    assert all(r.gap is None for r in got) and len(got) == len(rows)
    kinds = sorted((r.record_id, r.record_type, r.refers_to or "", r.payload_bytes) for r in got)
    p = "urn:page:"
    empty = [(p + "3", "revisit", p + "4", 0)] if least == 0 else [(p + "3", "response", "", 0)]
    assert kinds == sorted([(p, "response", "", 5), (p, "revisit", p + "2", 4), (p + "1", "revisit", p + "2", 4), (p + "2", "response", "", 4),
                            (p + "4", "response", "", 0), (p + "5", "response", "", 3), (p + "5", "response", "", 3), (p + "6", "response", "", 18000)] + empty)
    assert warc.read(warc.write(pages.limit(0))).count() == 0


# -- language model

def test_forward_and_expected_counts_equal_brute_force():
    m = hmm_scores.Model([" ", "a"], hashed=2, states=3)
    r = np.random.default_rng(1)
    m.start, m.move, m.emit = r.dirichlet([1] * 3), r.dirichlet([1] * 3, 3), r.dirichlet([1] * 4, 3)
    seqs = [r.integers(0, 4, n) for n in (1, 4, 2, 5, 1)]
    into = {"move": np.zeros((3, 3)), "emit": np.zeros((3, 4)), "start": np.zeros(3), "ll": 0.0}
    hmm_scores.expected(m, seqs, into)
    want = {"move": np.zeros((3, 3)), "emit": np.zeros((3, 4)), "start": np.zeros(3)}
    order, classes, begin = hmm_scores.by_step(seqs)
    got = dict(zip(order, hmm_scores.forward(m, classes, begin)))
    for k, s in enumerate(seqs):
        paths = {}
        for z in itertools.product(range(3), repeat=len(s)):
            p = m.start[z[0]] * m.emit[z[0], s[0]]
            for t in range(1, len(s)):
                p *= m.move[z[t - 1], z[t]] * m.emit[z[t], s[t]]
            paths[z] = p
        total = sum(paths.values())
        assert math.isclose(got[k], math.log(total), rel_tol=1e-9)
        for z, p in paths.items():
            want["start"][z[0]] += p / total
            for t, x in enumerate(s):
                want["emit"][z[t], x] += p / total
                if t:
                    want["move"][z[t - 1], z[t]] += p / total
    for k, v in want.items():
        assert np.allclose(into[k], v, rtol=1e-4), k


def test_scores_are_probabilities_and_base_is_exact(spark):
    docs = [(1, "A b a"), (2, None), (2, None), (3, "b\x0bc d"), (None, "a a"), (4, "new words here"), (5, "x " * 3000)]
    df = spark.createDataFrame([(i, t, "z") for i, t in docs], "doc_id long, text string, token string")
    train = df.filter("doc_id in (1, 3, 5)")
    rows = hmm_scores.score(df, train, states=2, top=2, hashed=4).collect()
    assert len(rows) == len(docs)
    counts = {}
    for i, t in docs:
        if i in (1, 3, 5):
            for w in [*(t or "").encode().lower().split(), b" "]:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for r in rows:
        w = [*(dict(docs)[r.doc_id] or "").encode().lower().split(), b" "]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(x in counts for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((counts.get(x, 0) + 0.5) / (n + 0.5 * (v + 1))) for x in w))
        assert r.score < 0
    assert hmm_scores.score(df.limit(0), train).count() == 0
    assert all(r.n_known == 0 for r in hmm_scores.score(df, df.limit(0), states=2, top=2, hashed=4).collect())


def test_scores_equal_all_state_paths(spark):
    """Untrained models, so that starts, moves and emissions are known: each text's score is the sum over all
    state paths, times its words' shares of their classes."""
    docs = [(i, t) for i, t in enumerate(["a b c a", "b", "c c dd ee", "", "a new word", "b b"])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    counts = {}
    for _, t in docs[:4]:
        for w in [*t.encode().split(), b" "]:
            counts[w] = counts.get(w, 0) + 1
    got = {r.doc_id: r.score for r in hmm_scores.score(df, F.col("doc_id") < 4, states=2, top=2, hashed=3, rounds=0).collect()}
    own = hmm_scores.own_words(spark.createDataFrame([(w.decode(), c) for w, c in counts.items()], "token string, c long"), 2)
    m = hmm_scores.Model(own, 3, 2)
    kind = lambda w: hmm_scores.class_of(w, m.own, 3)
    total = np.zeros(m.n)
    distinct = np.zeros(m.n)
    for w, c in counts.items():
        total[kind(w)] += c
        distinct[kind(w)] += 1
    m.begin(total)
    for i, t in docs:
        words = [*t.encode().split(), b" "]
        p = 0.0
        for z in itertools.product(range(2), repeat=len(words)):
            q = m.start[z[0]]
            for k, w in enumerate(words):
                q *= m.emit[z[k], kind(w)] * (m.move[z[k - 1], z[k]] if k else 1)
            p += q
        share = sum(math.log10((counts.get(w, 0) + 0.5) / (total[kind(w)] + 0.5 * (distinct[kind(w)] + 1))) for w in words)
        assert math.isclose(got[i], math.log10(p) + share, rel_tol=1e-9), t


# -- quality

def test_marginals_equal_brute_force():
    r = np.random.default_rng(2)
    move = r.standard_normal((2, 2))
    odds = r.standard_normal(7)
    at, begin = quality_crf.layout([4, 1, 2])
    p, moves = quality_crf.marginals(odds, move, at, begin)
    want, want_moves = np.zeros(7), np.zeros((2, 2))
    for lo, n in ((0, 4), (4, 1), (5, 2)):
        total, good, m = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=n):
            s = math.exp(sum(odds[lo + t] * y[t] for t in range(n)) + sum(move[y[t - 1], y[t]] for t in range(1, n)))
            total += s
            good += s * np.array(y)
            for t in range(1, n):
                m[y[t - 1], y[t]] += s
        want[lo : lo + n] = good / total
        want_moves += m / total
    assert np.allclose(p, want) and np.allclose(moves, want_moves)


def test_quality_on_held_out_rows(spark):
    got = quality_crf.op3_quality_crf(spark, "/root/testdata/sf0.01").toPandas()
    told = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    x = got[got.held_out].merge(told, on="doc_id")
    assert len(x) > 30 and (x.predicted == x.quality).mean() > 0.95
    assert got.score.between(0, 1).all() and not got.score.isna().any()


def test_quality_odd_texts_and_labels(spark):
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate([None, "", "\n\n", "a\n" * 3000, "x" * 50_000, "One line.", "One line."])],
                                 "doc_id long, text string, Score int")
    for rows in ([], [(1, None), (2, 1), (2, 0), (None, 1)], [(5, 1), (6, 1)], [(3, 0), (5, 1), (3, 0)]):
        told = spark.createDataFrame(rows, "doc_id long, quality int")
        got = quality_crf.score(docs, quality_crf.train(docs, told)).collect()
        assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert got[0].score == got[1].score == got[2].score and got[5].score == got[6].score
    assert quality_crf.score(docs.limit(0), quality_crf.train(docs, told)).count() == 0


def test_quality_sample_is_bounded_in_lines(spark):
    assert quality_crf.within([(1, 0, 5), (2, 1, 9), (3, 0, 4), (4, 0, 2), (5, 1, 1), (6, 0, 1)], 8) == [1, 4, 5, 6]
    rows = [(i, ("Good line here.\n" if i % 2 else "!!! $$ 11\n") * (5000 if i == 4 else 3)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    told = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality_crf.score(docs, quality_crf.train(docs, told, lines=60)).collect()}
    assert all((got[i] > 0.5) == bool(i % 2) for i in range(40))
    assert not quality_crf.train(docs, told, lines=1).fitted


# -- near duplicates

def near_texts(seed=1):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(900)]
    out = []
    for _ in range(12):
        base = [r.choice(vocabulary) for _ in range(r.randint(40, 150))]
        for _ in range(r.choice((1, 2, 5, 30))):
            copy = list(base)
            for _ in range(r.randint(0, 3)):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            out.append(" ".join(copy))
    return out + [None, "", "", "  .,", "one two", "One, two!", "three"] + [out[0]] * 40


def test_near_duplicates_equal_brute_force(spark):
    rows = near_texts()
    ids = list(range(100, 100 + len(rows)))
    random.Random(5).shuffle(ids)
    docs = spark.createDataFrame([(i, t, 1) for i, t in zip(ids, rows)], "doc_id long, text string, node int").repartition(7)
    got = {r.doc_id: r for r in minhash_dedup.near_duplicates(docs).collect()}
    cut = minhash_dedup.Shingler()
    sets = {i: np.unique(cut(t), return_counts=True) for i, t in zip(ids, rows)}
    df = {}
    for s, _ in sets.values():
        for x in s.tolist():
            df[x] = df.get(x, 0) + 1
    t = max(2, int(2 * minhash_dedup.RARE * len(rows)))
    heavy = [(k, v) for k, v in df.items() if v >= t]
    w = minhash_dedup.Weights(np.array([k for k, _ in heavy], np.uint64), np.array([v for _, v in heavy]), len(rows), t)
    feats = {i: ((s >> np.uint64(32)).astype("<u4").tobytes(), w.of(s, c).astype("<f4").tobytes()) for i, (s, c) in sets.items()}
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    text = dict(zip(ids, (x or "" for x in rows)))
    sure, maybe = [], []
    for a, b in itertools.combinations(sorted(ids), 2):
        if text[a] == text[b] or (len(sets[a][0]) and len(sets[b][0]) and minhash_dedup.similarity(feats[a], feats[b]) >= 0.8):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert {i: got[i].class_id for i in ids} == {i: find(i) for i in ids}
    assert sum(r.kept for r in got.values()) == len({find(i) for i in ids})
    assert not sure and not maybe
    left = minhash_dedup.one_of_each(docs)
    assert sorted(r.doc_id for r in left.collect()) == sorted({find(i) for i in ids}) and left.columns == docs.columns


def test_near_duplicates_null_and_repeated_ids(spark):
    text = "a long enough text of some ten words or rather more"
    docs = spark.createDataFrame([(None, text), (3, text), (3, text), (None, "other words"), (9, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.class_id or 0, r.kept) for r in minhash_dedup.near_duplicates(docs).collect())
    assert got == [(0, 0, True), (0, 3, False), (3, 3, True), (3, 3, True), (9, 9, True)]
    assert sorted(r.doc_id or 0 for r in minhash_dedup.one_of_each(docs).collect()) == [0, 3, 9]
    assert minhash_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_consistent_samples_agree_as_often_as_texts_are_similar():
    r = np.random.default_rng(1)
    sample = minhash_dedup.Sampler(2000)
    s = np.sort(r.integers(0, 1 << 63, 200).astype(np.uint64))
    a, b = r.uniform(0.5, 3, 200), r.uniform(0.5, 3, 200)
    a[:30] = 0.001
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    got = (sample(s, a) == sample(s, b)).mean()
    assert abs(got - want) < 0.04


def test_large_buckets_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK", 8)
    r = random.Random(2)
    base = [f"w{r.randrange(5000)}" for _ in range(200)]
    rows = []
    for k in range(90):
        copy = list(base)
        copy[r.randrange(200)] = f"own{k}"
        rows.append((k, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x.class_id for x in minhash_dedup.near_duplicates(docs).collect()} == {0}


def variants(n=1000, words=210, seed=3):
    """Copies of one text with some words of their own, so that many pairs lie close to 0.8 on either side."""
    r = random.Random(seed)
    base = [f"w{r.randrange(5000)}" for _ in range(words)]
    out = []
    for k in range(n):
        copy = list(base)
        for at in r.sample(range(words), r.choice((2, 3, 3, 4, 4))):
            copy[at] = f"own{k}x{at}"
        out.append(" ".join(copy))
    return out


def components_by_hand(texts, least=0.8):
    """Smallest index of each text's component: over all pairs, and over those that
    share a band and agree in MAYBE of the samples; and how many links there are."""
    cut = minhash_dedup.Shingler()
    sets = [np.unique(cut(t), return_counts=True) for t in texts]
    names, df = np.unique(np.concatenate([s for s, _ in sets]), return_counts=True)
    t = max(2, int(2 * minhash_dedup.RARE * len(texts)))
    w = minhash_dedup.Weights(names[df >= t], df[df >= t], len(texts), t)
    total = np.array([w.of(s, c).sum() for s, c in sets])
    shared = names[df > 1]                                # a shingle of one text adds to no other's overlap
    m = np.zeros((len(texts), len(shared)), np.float32)
    for i, (s, c) in enumerate(sets):
        hit = np.isin(s, shared)
        m[i, np.searchsorted(shared, s[hit])] = w.of(s, c)[hit]
    sample = minhash_dedup.Sampler()
    z = np.stack([sample(s, w.of(s, c)) for s, c in sets])
    key, low = z.reshape(len(z), minhash_dedup.BANDS, minhash_dedup.ROWS), z.astype(np.uint16)
    root, met, links = np.arange(len(texts)), np.arange(len(texts)), 0
    for i in range(len(texts)):
        both = np.minimum(m[i], m[i + 1 :]).sum(1, dtype=float)
        near = i + 1 + np.flatnonzero(both / (total[i] + total[i + 1 :] - both) >= least)
        links += len(near)
        for j in near:
            root[root == max(root[i], root[j])] = min(root[i], root[j])
            if (key[i] == key[j]).all(1).any() and (low[i] == low[j]).mean(dtype=np.float32) >= minhash_dedup.MAYBE:
                met[met == max(met[i], met[j])] = min(met[i], met[j])
    return root.tolist(), met.tolist(), links


@pytest.mark.parametrize("block", [minhash_dedup.BLOCK, 150])
def test_a_large_group_close_to_the_threshold_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash_dedup, "BLOCK", block)
    texts = variants()
    want, met, links = components_by_hand(texts)
    assert 100 < links < 250_000 and 10 < len(set(want)) < 900  # not one component, nor none
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.class_id for r in minhash_dedup.near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(texts))] == met      # no candidate is left out
    assert sum(got[i] != want[i] for i in range(len(texts))) <= 5  # the recall of bands and MAYBE


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200), (202, 201)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), **dict.fromkeys((200, 201, 202), 200)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- embeddings

def links_by_hand(rows):
    n = len(rows)
    links, root = [0] * n, [r[0] for r in rows]
    vs = [embedding_dedup.usable(r[1]) if r[2] is not None else None for r in rows]
    for _ in range(n):
        for i, j in itertools.permutations(range(n), 2):
            if vs[i] is not None and vs[j] is not None and rows[i][2] == rows[j][2] and len(vs[i]) == len(vs[j]) and vs[i] @ vs[j] >= 0.98:
                root[i] = min(root[i], root[j])
    for i, j in itertools.permutations(range(n), 2):
        links[i] += vs[i] is not None and vs[j] is not None and rows[i][2] == rows[j][2] and len(vs[i]) == len(vs[j]) and vs[i] @ vs[j] >= 0.98
    return {(r[0], links[k], root[k], r[0] == root[k]) for k, r in enumerate(rows)}


def test_embedding_links_equal_brute_force(spark):
    r = np.random.default_rng(1)
    base = r.standard_normal((6, 32))
    rows = [(i, (base[i % 6] + 0.08 * r.standard_normal(32)).astype(np.float32).tolist(), int(i % 2)) for i in range(40)]
    rows += [(50, rows[0][1], 0), (51, rows[0][1], 0), (52, rows[0][1], None), (53, None, 1), (54, [0.0] * 32, 1), (55, [], 1),
             (56, [None, 1.0], 1), (57, [float("nan")] * 32, 1), (58, [float("inf")] * 32, 0), (59, [1.0, 2.0], 1), (60, [2.0, 4.0], 1)]
    df = spark.createDataFrame([(*x, "clash") for x in rows], "vec_id long, embedding array<float>, label int, rep string")
    got = {(x.vec_id, x.n_links, x.component_id, x.kept) for x in embedding_dedup.link(df).collect()}
    want = links_by_hand(rows)
    assert {x[0] for x in got} == {x[0] for x in want}
    assert sum(x[1] for x in got) >= 0.9 * sum(x[1] for x in want)
    small = {x for x in want if x[0] >= 52}
    assert small <= got
    assert embedding_dedup.link(df.limit(0)).count() == 0


def test_embedding_recall_on_pairs_at_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    r = np.random.default_rng(4)
    rows = []
    for k in range(150):
        v = r.standard_normal(64)
        v /= np.linalg.norm(v)
        o = r.standard_normal(64)
        o -= (o @ v) * v
        o /= np.linalg.norm(o)
        rows += [(2 * k, v.tolist(), 0), (2 * k + 1, (0.981 * v + math.sqrt(1 - 0.981**2) * o).tolist(), 0)]
    got = embedding_dedup.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    found = sum(x.n_links for x in got) / len(rows)
    assert 0.9 <= found <= 1


@pytest.mark.parametrize("clustered", [False, True])
@pytest.mark.parametrize("share", [0.34, 0.4, 0.5])
def test_embedding_recall_inside_a_group_of_much_of_the_rows(share, clustered):
    x = one_group(4000, share, clustered)
    keys = embedding_dedup.Tables(list(x)).keys(x)
    i, j = np.nonzero(np.triu(x[:1500] @ x[:1500].T >= 0.98, 1))
    assert len(i) > 50_000 and (keys[i] == keys[j]).any(1).mean() > 0.99


def one_group(n, share, clustered, d=64):
    """Unit vectors; a share of them is near (mean cosine 0.99), not equal."""
    r = np.random.default_rng(1)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    m = int(share * n)
    group = unit(unit(r.standard_normal(d)) + 0.1 / math.sqrt(d) * r.standard_normal((m, d)))
    other = r.standard_normal((n - m, d))
    if clustered:
        other = unit(r.standard_normal((10, d)))[r.integers(0, 10, n - m)] + 0.5 / math.sqrt(d) * other
    return r.permutation(np.concatenate([group, unit(other)]))


def test_embedding_links_of_a_group_of_half_of_the_rows(spark):
    x = one_group(1000, 0.5, True)
    got = embedding_dedup.link(spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int"))
    assert sum(r.n_links for r in got.collect()) >= 0.99 * ((x @ x.T >= 0.98).sum() - len(x))


# -- pipeline

def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = corpus_pipeline.written(stage(spark, docs, SF), "test_stage")
        after = {r.doc_id: r for r in docs.collect()}
        sizes.append(len(after))
        assert set(after) <= set(before)
        if stage is corpus_pipeline.encode:
            assert all(after[i].n_tokens == len(after[i].ids) and after[i].decoded == before[i].text for i in after)
        else:
            assert docs.columns == columns
            assert all(r.n_chars == len(r.text) for r in after.values() if r.text != before[r.doc_id].text)
    assert sizes[0] > sizes[1] >= sizes[2] == sizes[3] == sizes[4] == sizes[5] > 0


def test_pipeline_takes_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, None, "s", None), (None, "", "en", None, 0), (2, "a text", "en", "s", 6), (2, "a text", "en", "s", 6)],
                                 spark.read.parquet(f"{SF}/documents.parquet").schema)
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = corpus_pipeline.written(stage(spark, docs, SF), "test_odd")
    assert sorted((r.doc_id or 0) for r in docs.collect()) in ([0, 1, 2], [0, 2], [1, 2])


def test_op1_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    want = con.execute(warc.OP1_SQL).fetchall()
    got = [tuple(r) for r in warc.op1_warc(spark, SF).collect()]
    assert sorted(got) == sorted(want)


def test_shingles_of_local_groups_are_not_counted_everywhere(spark, monkeypatch):
    """Groups of near copies that lie together make shingles that are frequent in a block only; those over a
    larger task's share are counted, and the heavy ones are as by brute force."""
    monkeypatch.setattr(minhash_dedup, "RARE", 0.05)
    monkeypatch.setattr(minhash_dedup, "BLOCK_DOCUMENTS", 20)
    monkeypatch.setattr(minhash_dedup, "COUNT_DOCUMENTS", 200)
    text = [" ".join(f"w{i // 10}x{k}" for k in range(60)) + (" one line that all of some share" if i % 3 == 0 else "") for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(text)), "doc_id long, text string").repartitionByRange(20, "doc_id")
    counted, count = [], minhash_dedup._document_counts
    monkeypatch.setattr(minhash_dedup, "_document_counts", lambda docs, wanted, *a: counted.append(len(wanted)) or count(docs, wanted, *a))
    got = minhash_dedup.weigh(docs.select("text"))
    cut = minhash_dedup.Shingler()
    df = Counter(int(s) for t in text for s in set(cut(t).tolist()))
    want = {s: c for s, c in df.items() if c >= 40}
    assert want and dict(zip(got.heavy.tolist(), got.df.tolist())) == want
    assert counted[-1] < 50 < counted[0]
