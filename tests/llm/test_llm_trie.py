"""The prefix trie against a plain dictionary of prefixes."""
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from sponsorlens.llm import prefix_trie

COLUMNS = "conv_id long, turn long, role string, text string, DEPTH int, at string"


def expected(rows):
    convs = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    for c in convs:
        convs[c] = [x[2:] for x in sorted(convs[c])]
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(convs.get(c - c % 20, [])[:h] + own[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = []
    for p, cs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        saved = sum((len(members[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in below if q)
        leaves = sum(1 for q in below if not any(len(o) == len(q) + 1 and o[: len(q)] == q for o in below))
        ends = ",".join(str(c) for c in sorted(cs) if len(built[c]) == len(p))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), sum(1 for q in below if len(q) == len(p) + 1),
                    leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in prefix_trie.trie(df).collect()), key=repr)


def conversations(n, seed, longest=7, texts=("a", "b c", "", None)):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(n * 2), n):
        rows += [(c, r.choice([t, t, None if t == 0 else t]), r.choice(["u", None]), r.choice(texts), 1, "x") for t in range(r.randint(1, longest))]
    return rows


@pytest.mark.parametrize("block", [2, 8])
def test_closes_equals_a_stack(block, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    r = random.Random(3)
    for n in [1, 2, 5, 40, 300]:
        for _ in range(10):
            bits, depth = [], 0
            for k in range(2 * n):
                left = 2 * n - k
                up = depth == 0 or (depth < left and r.random() < 0.55)
                bits.append(up)
                depth += 1 if up else -1
            stack, want = [], [-1] * len(bits)
            for k, up in enumerate(bits):
                if up:
                    stack.append(k)
                else:
                    want[stack.pop()] = k
            assert prefix_trie.closes(np.array(bits)).tolist() == want


@pytest.mark.parametrize("seed, texts", [(1, ("a", "b c", "", None)), (2, ("same words",))])
def test_trie_equals_dictionary(spark, seed, texts):
    rows = conversations(60, seed, texts=texts)
    assert got(spark.createDataFrame(rows, COLUMNS).repartition(4)) == expected(rows)


def test_long_copies_ties_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 4)
    long = [(c, t, "u", f"w{t} x", 1, "x") for c in (1, 40, 41, 5000) for t in range(30)]
    some = [(41, 30, "u", "more", 1, "x"), (None, 1, "u", "a", 1, "x"), (7, None, None, None, 1, "x"), (7, None, None, None, 1, "x"), (-3, 0, "u", "a", 1, "x")]
    assert got(spark.createDataFrame(long + some, COLUMNS).repartition(3)) == expected(long + some)


def test_textless_and_empty_tables(spark):
    rows = [(c, 0, "u", "a", 1, "x") for c in range(1, 20)]          # no base: some lose their only turn
    assert got(spark.createDataFrame(rows, COLUMNS)) == expected(rows)
    lost = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4]
    assert got(spark.createDataFrame(lost, COLUMNS)) == expected(lost) and len(expected(lost)) == 1
    assert prefix_trie.trie(spark.createDataFrame([], COLUMNS)).count() == 0
