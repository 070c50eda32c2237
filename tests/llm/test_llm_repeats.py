"""Repeated strings against a dictionary of all windows."""
import hashlib
import random

import numpy as np
import pytest

from sponsorlens.llm import repeated_text

COLUMNS = "doc_id long, text string, shard int, kept string"


def expected(rows):
    first = {}
    texts = [(repeated_text.LAST if r[0] is None else r[0], (r[1] or "").encode()) for r in rows]
    for d, x in texts:
        for i in range(len(x) - 99):
            w = x[i : i + 100]
            first[w] = min(first.get(w, (d, i)), (d, i))
    out = []
    for d, x in texts:
        gone = np.zeros(len(x) + 1, bool)
        for i in range(len(x) - 99):
            if first[x[i : i + 100]] < (d, i):
                gone[i : i + 100] = True
        gone = gone[: len(x)]
        kept = bytes(b for b, g in zip(x, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((None if d == repeated_text.LAST else d, len(x), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n=60):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé\x00 日") for _ in range(r.randint(1, 9)))
    passages = [" ".join(word() for _ in range(r.randint(10, 80))) for _ in range(4)]
    rows = []
    for k in range(n):
        parts = [" ".join(word() for _ in range(r.randint(0, 60))) if r.random() < 0.6 else r.choice(passages) for _ in range(r.randint(1, 5))]
        text = "".join(parts)
        if rows and r.random() < 0.3:                                # a copy with an edit
            text = list(r.choice(rows)[1] or "x")
            text[r.randrange(len(text))] = "#"
            text = "".join(text)
        rows.append((k, text, 1, "x"))
    return rows


ODD = [(100, None, 1, "x"), (101, "", 1, "x"), (102, "a" * 99, 1, "x"), (103, "a" * 100, 1, "x"), (104, "a" * 1000, 1, "x"), (105, "ab" * 400, 1, "x"),
       (106, "long text of its own " * 3000, 1, "x"), (None, "a" * 150, 1, "x"), (None, "a" * 150, 1, "x"), (107, "é" * 60, 1, "x"), (107, "é" * 60, 1, "x"),
       (107, "x" + "é" * 60, 1, "x"), (-5, "ab" * 60, 1, "x")]


def got(df, **more):
    return sorted((tuple(r) for r in repeated_text.dedup(df, **more).collect()), key=repr)


@pytest.mark.parametrize("seed, more", [(1, {}), (2, {"shard": 3000, "bucket": 5000}), (3, {"hot": 300, "shard": 20_000})])
def test_equals_all_windows(spark, seed, more):
    rows = corpus(seed) + ODD
    random.Random(seed).shuffle(rows)
    assert got(spark.createDataFrame(rows, COLUMNS).repartition(5), **more) == expected(rows)


def test_small_blocks_and_texts(spark, monkeypatch):
    monkeypatch.setattr(repeated_text, "HELD", 2000)
    rows = corpus(4, 25)
    df = repeated_text.dedup(spark.createDataFrame(rows, COLUMNS), text=True)
    for r in df.collect():
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed
    assert sorted((tuple(r) for r in df.drop("kept").collect()), key=repr) == expected(rows)


def test_empty_table(spark):
    assert repeated_text.dedup(spark.createDataFrame([], COLUMNS)).count() == 0


@pytest.mark.parametrize("alphabet", [b"ab", b"\x00\xff", bytes(range(256))])
def test_transforms_and_their_merge(alphabet):
    r = random.Random(len(alphabet))
    for _ in range(8):
        base = [bytes(r.choice(alphabet) for _ in range(r.randint(100, 168))) for _ in range(4)]
        shards = []
        for _ in range(r.randint(1, 4)):
            some = [bytearray(r.choice(base)) for _ in range(r.randint(1, 12))]
            for x in some:
                if r.random() < 0.6:
                    x[r.randrange(len(x))] = r.choice(alphabet)
            shards.append([bytes(x) for x in some])
        for strings in shards:
            t = repeated_text.Transform(strings)
            rows = sorted((x[p:], i, p) for i, x in enumerate(strings) for p in range(len(x) + 1))
            assert [(i, p) for _, i, p in rows] == list(zip(t.string.tolist(), t.place.tolist()))
            assert all(strings[i][p - 1] == b for (_, i, p), b in zip(rows, t.last.tolist()) if p)
        windows, found = {}, {}
        for k, strings in enumerate(shards):
            for i, x in enumerate(strings):
                for p in range(len(x) - 99):
                    windows.setdefault(x[p : p + 100], []).append((k, i, p))
        for run, *at in zip(*(c.tolist() for c in repeated_text.repeated_windows(shards))):
            found.setdefault(run, []).append(tuple(at))
        assert sorted(map(sorted, found.values())) == sorted(v for v in windows.values() if len(v) > 1)
