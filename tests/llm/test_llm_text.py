"""Operators on texts, held against the libraries and brute force."""
import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest

from sponsorlens.llm import decontaminate, secret_scan, sentencepiece_codec, token_counts, token_files

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "  a", " a ", "a\nb\n", "▁a▁ b", "日本 語 \U0001F600x  ", "<s> </s>", "\x00 a", "\t\t a", "a" * 3000 + " b",
       "word " * 4000, "<|endoftext|> x<|endoftext|>", "é́ ﬁ Å", "don't  stop", "a", "a"]


def texts(spark, rows, extra=""):
    """A table with columns whose names clash with those of the operators."""
    return spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(rows)], "doc_id long, text string, IDS int, n_words string")


def noise(n, alphabet, most, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, most))) for _ in range(n)]


PIECES = ["a", "b", "é", " ", "\n", "\t", "1", "<|endoftext|>", "'s", "  ", "\xa0", "\x1c", "!!", "日", "\n ", "don't", " ", "▁", "\x85", "Σ"]


def test_sentencepiece_equals_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = ODD + noise(300, PIECES, 30)
    got = {r.doc_id: r for r in sentencepiece_codec.encode(texts(spark, rows), MODEL, decoded="decoded").collect()}
    for i, t in enumerate(rows):
        want = sp.encode(t or "")
        assert got[i].ids == want and got[i].decoded == sp.decode(want), t


def test_sentencepiece_decode_null_ids_and_empty_table(spark):
    ids = sentencepiece_codec.ChunkTable(MODEL).encode(["two words"])[0]
    df = spark.createDataFrame([(1, None), (2, ids)], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in sentencepiece_codec.decode(df, MODEL).collect()} == {1: "", 2: "two words"}
    assert sentencepiece_codec.encode(texts(spark, []), MODEL).count() == 0


def test_chunk_table_is_bounded_and_starts_anew():
    t = sentencepiece_codec.ChunkTable(MODEL, entries=5)
    rows = noise(50, PIECES, 20, seed=4)
    assert [t.encode([x]) for x in rows] == [[t.sp.encode(x)] for x in rows]


@pytest.mark.parametrize("chunk, overlap", [(100, 8), (64, 1), (16_384, 256)])
def test_token_counts_equal_library(spark, chunk, overlap):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORDS)
    rows = ODD + noise(100, PIECES, 300, seed=2) + noise(10, "abcde12!é", 900, seed=3)
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(texts(spark, rows), WORDS, chunk=chunk, overlap=overlap).collect()}
    assert got == {i: len(tok.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(rows)}


def test_token_counts_empty_table_and_repeated_rows(spark):
    assert token_counts.count_tokens(texts(spark, []), WORDS).count() == 0
    df = spark.createDataFrame([(1, "a b " * 100)] * 3, "doc_id long, text string")
    assert [r.n_tokens for r in token_counts.count_tokens(df, WORDS, chunk=50, overlap=4).collect()] == [200] * 3


def test_sides_of_a_boundary_in_two_batches(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORDS)
    rows = noise(6, "ab1 \n", 4000, seed=7)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(texts(spark, rows), WORDS, chunk=200, overlap=4).collect()}
    finally:
        spark.conf.set(key, before)
    assert got == {i: len(tok.encode(t, add_special_tokens=False).ids) for i, t in enumerate(rows)}


def test_splice_needs_a_common_boundary():
    assert token_counts.splice(([1], [3]), ([1], [3]), "abc", 3) is None
    assert token_counts.splice(([1, 2], [3, 5]), ([9, 2], [3, 5]), "a bc", 3) == 2


def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BYTES)
    rows = ODD + noise(150, PIECES, 40, seed=5)
    docs = texts(spark, rows).repartition(5)
    want = [tok.encode(t or "", add_special_tokens=False).ids + [0] for t in rows]
    manifest = token_files.write(docs, BYTES, shard_ids=500)
    got = {r.doc_id: r for r in token_files.read(manifest).collect()}
    digest = {r.doc_id: r.ids_crc32 for r in token_files.read(manifest, digest=True).collect()}
    start = 0
    for i, w in enumerate(want):
        assert (got[i].start, got[i].n_tokens, list(got[i].ids)) == (start, len(w), w)
        assert digest[i] == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in w))
        start += len(w)


def test_token_files_null_ids_repeats_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "b"), (3, "x y"), (3, "x y"), (None, None)], "doc_id long, text string")
    got = token_files.read(token_files.write(docs, BYTES)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 3, 3] and got[2].ids == got[3].ids
    assert token_files.read(token_files.write(docs.limit(0), BYTES)).count() == 0


def test_re_pair_ranges_decode_alone():
    import numpy as np

    r = random.Random(1)
    for n, k in ((1, 2), (2, 1), (5000, 2), (5000, 40), (3000, 5000)):
        ids = np.array([r.randrange(k) for _ in range(n)], np.uint32)
        for first in (50257, 70000):
            s = token_files.Shard(token_files.pack([7], [n], ids, first))
            assert (s.decode() == ids).all() and s.n_ids == n
            for _ in range(10):
                a = r.randint(0, n)
                b = r.randint(a, n)
                assert (s.decode_range(a, b) == ids[a:b]).all()
    assert len(s.rules) == 0 or s.size.min() >= 2


def count_pairs(seq):
    """Occurrences of each pair that don't overlap themselves, from left to right."""
    last, count = {}, {}
    for i, pair in enumerate(zip(seq, seq[1:])):
        if last.get(pair, -2) < i - 1:
            last[pair] = i
            count[pair] = count.get(pair, 0) + 1
    return count


def test_re_pair_goes_on_until_no_pair_is_frequent():
    import numpy as np

    r = random.Random(2)
    passage = [r.randrange(50000) for _ in range(300)]
    cases = [passage * 5000, [7] * 100_003, [r.randrange(6) for _ in range(20000)],
             [int(r.paretovariate(0.7)) % 50000 for _ in range(60000)], [1, 1, 2, 1, 1] * 3000]
    for ids in cases:
        ids = np.array(ids, np.uint32)
        rules, rest = token_files.re_pair(ids, 50257)
        assert max(count_pairs(rest.tolist()).values(), default=0) < token_files.LEAST
        flat, ends = token_files.expansions(rules, 50257)
        assert (token_files.gather(flat, ends, rest.astype(np.int64))[0] == ids).all()
        assert len({tuple(x) for x in rules.tolist()}) == len(rules)      # no pair has two rules
    rules, rest = token_files.re_pair(np.array(cases[0], np.uint32), 50257)
    assert len(token_files.pack([1], [len(cases[0])], np.array(cases[0], np.uint32), 50257)) < 6000 and len(rest) < 16
    many = np.array([r.randrange(40) for _ in range(200_000)], np.uint32)     # symbols of more than 16 bits
    s = token_files.Shard(token_files.pack([1], [len(many)], many, 65_000))
    assert s.first + len(s.rules) > 1 << 16 and (s.decode() == many).all() and (s.decode_range(777, 99_999) == many[777:99_999]).all()


def test_words_encoded_together_equal_words_alone():
    enc = token_files.ChunkEncoder(BYTES, entries=40)
    rows = noise(400, [*PIECES, "\u3000", "\x1f ", "\x85 ", "the", "<|endoftext|> "], 30, seed=9)
    for at in range(0, len(rows), 50):                                       # the table starts anew between batches
        got = enc.encode(rows[at : at + 50])
        assert [g.tolist() for g in got] == enc.plain(rows[at : at + 50])
    enc.lead[:] = False                                                      # no word start known: each word goes alone
    enc.clear()
    assert [g.tolist() for g in enc.encode(rows)] == enc.plain(rows)
    assert enc.encode([]) == []


def test_op7_query_by_hand(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BYTES)
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.op7_token_files(spark, folder).collect()}
    start, want = 0, {}
    for d in spark.read.parquet(folder + "/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect():
        ids = tok.encode(d.text or "", add_special_tokens=False).ids + [0]
        want[d.doc_id] = (start, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)))
        start += len(ids)
    assert got == want


def spans_by_hand(t):
    t = t or ""
    assign = r"(?:password|passwd|secret|token|api_?key)"
    assign = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in assign.replace("(?:", "<").replace(")", ">")).replace("<", "(?:").replace(">", ")")
    found = [(m.start(), m.end(), 0) for m in re.finditer(assign + r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t) if len(m[1]) >= 8]
    found += [(m.start(), m.end(), 1) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    found += [(m.start(), m.end(), 2) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted((s, k, e) for s, e, k in found)


def test_secret_base_spans_by_hand(spark):
    h = hashlib.sha1(b"x").hexdigest()
    rows = [None, "", f"é😀 token = \"{h}\" and ApI_KeY:abcdefgh.", "secret=api_key :longvalue12345", f"AKIA{'A1' * 8} AKIA12 {h[:31]} {h[:32]}",
            "password = short", "secret=token=abcdefghij", f"{h}{h}", "PASSWORD:'a.b=c-d_e/f+g'", "x " * 50_000 + h] + noise(
                300, ["token", "secret", "=", ":", " ", "'", "abcdefgh", "AKIA", "ABCDEFGH1234", "0123456789abcdef", "é", "api_key", "APIKEY"], 12, seed=6)
    got = {r.doc_id: r for r in secret_scan.scan(texts(spark, rows)).collect()}
    for i, t in enumerate(rows):
        assert [(x.s, x.k, x.e) for x in got[i].spans if x.k < 3] == spans_by_hand(t), t


def test_secret_models_tell_random_strings_from_names(spark):
    r = random.Random(3)
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(r.choice(alnum) for _ in range(32)) for _ in range(5)]
    names = ["get_user_account_settings", "internationalization-of-words", "the_quick_brown_fox_jumps_over_13", "20241231235959000123456"] * 100
    docs = texts(spark, [f"see {n} in the text" for n in names] + [f"key {k} end" for k in keys])
    got = secret_scan.scan(docs).collect()
    added = {r.doc_id for r in got if any(x.k == 3 for x in r.spans)}
    assert added == set(range(len(names), len(names) + len(keys)))
    hidden = {r.doc_id: r.text for r in secret_scan.redact(secret_scan.scan(docs)).collect()}
    assert hidden[len(names)] == "key [SECRET] end" and hidden[0] == "see get_user_account_settings in the text"


def scan_by_hand(rows):
    """All spans: the base ones, and runs by the ratio of two models of letter pairs."""
    import base64
    import math

    base = [spans_by_hand(t) for t in rows]
    touched = lambda i, m: any(s < m.end() and m.start() < e for s, _, e in base[i])
    told = [(base64.b64encode(hashlib.sha256(f"sample {i}".encode()).digest()).decode(), True) for i in range(secret_scan.SYNTHETIC)]
    for i, t in enumerate(rows):
        for m in re.finditer(r"[A-Za-z0-9_+/=-]{12,}", t or ""):
            if touched(i, m) or not re.search("[0-9]", m[0]) or not re.search("[A-Za-z]", m[0]):
                told.append((m[0], touched(i, m)))
    pairs = {True: {}, False: {}}
    for x, kind in told:
        for a, b in zip(x, x[1:]):
            pairs[kind].setdefault(a, []).append(b)
    p = lambda kind, a, b: (pairs[kind].get(a, []).count(b) + 1) / (len(pairs[kind].get(a, [])) + 67)
    out = []
    for i, t in enumerate(rows):
        added = [(m.start(), 3, m.end()) for m in re.finditer(r"[A-Za-z0-9_+/=-]{20,}", t or "")
                 if not touched(i, m) and re.search("[0-9]", m[0])
                 and sum(math.log(p(True, a, b) / p(False, a, b)) for a, b in zip(m[0], m[0][1:])) >= secret_scan.MIN_RATIO]
        out.append(sorted(base[i] + added))
    return out


def test_secret_spans_of_both_models_equal_brute_force(spark):
    r = random.Random(8)
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    key = lambda n: "".join(r.choice(alnum) for _ in range(n))
    word = lambda: "_".join(r.choice(["load", "user", "table", "index", "row", "2024", "v2"]) for _ in range(r.randint(2, 7)))
    some = [lambda: key(r.randint(18, 40)), word, lambda: f"token={key(12)}", lambda: r.randbytes(20).hex(), lambda: "AKIA" + "Q7" * 8,
            lambda: f"{r.randbytes(16).hex()}-{key(9)}", lambda: "plain words", lambda: "é😀", word, word]
    rows = [None, "", *(" ".join(r.choice(some)() for _ in range(r.randint(1, 12))) for _ in range(60)),
            *(" ".join(word() for _ in range(40)) for _ in range(60))]
    got = {x.doc_id: sorted((s.s, s.k, s.e) for s in x.spans) for x in secret_scan.scan(texts(spark, rows)).collect()}
    want = scan_by_hand(rows)
    assert got == dict(enumerate(want)) and 5 < sum(k == 3 for x in want for _, k, _ in x)


def test_secrets_of_a_text_full_of_them(spark):
    n = 5_000
    hashes = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(n)]
    found = secret_scan.scan(texts(spark, [" ".join(hashes), "token=abcdefgh1"]))
    got = {r.doc_id: [(x.s, x.e, x.k) for x in r.spans] for r in found.select("doc_id", "spans").collect()}
    assert got == {0: [(41 * i, 41 * i + 40, 2) for i in range(n)], 1: [(0, 15, 0)]}
    hidden = {r.doc_id: r.text for r in secret_scan.redact(found).collect()}
    assert hidden == {0: " ".join(["[SECRET]"] * n), 1: "[SECRET]"}


def test_secret_empty_table(spark):
    assert secret_scan.scan(texts(spark, [])).count() == 0


def hits_by_hand(docs, items, window=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))

    phrases = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1)) if w else ():
            phrases.setdefault(tuple(w[k : k + window]), set()).add("" if i is None else str(i))
    out = []
    for t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(p) for p in phrases}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in phrases:
                    hit |= set(range(k, k + n))
                    found |= phrases[tuple(w[k : k + n])]
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("options", [{}, {"shard_words": 50}, {"block_words": 20}])
def test_decontamination_by_hand(spark, options):
    r = random.Random(1)
    docs = [None, "", "A-b c"] + [" ".join(r.choice(["a", "B", "é,", "x9"]) for _ in range(r.randint(0, 60))) for _ in range(40)]
    items = [(None, "x9 a"), (5, None), (6, ""), (7, "!!")] + [(i, " ".join(r.choice(["a", "b", "é", "zz"]) for _ in range(r.randint(0, 14)))) for i in range(10, 60)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {x.doc_id: x for x in decontaminate.find(texts(spark, docs).withColumnRenamed("n_words", "word_spans"), bench, **options).collect()}
    for i, want in enumerate(hits_by_hand(docs, items)):
        x = got[i]
        assert (x.n_words, sum(s.e - s.s for s in x.word_spans), x.item_ids) == want


def test_decontamination_in_blocks_of_a_shuffled_input(spark):
    r = random.Random(4)
    docs = [" ".join(r.choice(["a", "b", "c"]) for _ in range(r.randint(0, 40))) for _ in range(300)]
    items = [(i, " ".join(r.choice(["a", "b", "c"]) for _ in range(7))) for i in range(40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    mixed = texts(spark, docs).drop("n_words").repartition(7)
    got = {x.doc_id: x for x in decontaminate.find(mixed, bench, block_words=15).collect()}
    for i, want in enumerate(hits_by_hand(docs, items)):
        assert (got[i].n_words, sum(s.e - s.s for s in got[i].word_spans), got[i].item_ids) == want


def test_decontamination_cuts_the_passage_only(spark):
    passage = "One two, three four five six; seven eight nine ten eleven."
    docs = texts(spark, [f"Before it. {passage} After it.", "clean text", None])
    bench = spark.createDataFrame([(1, passage.upper())], "item_id long, text string")
    for options in ({}, {"block_words": 1}):
        left = {r.doc_id: r.left for r in decontaminate.find(docs, bench, cleaned="left", **options).collect()}
        assert left == {0: "Before it. . After it.", 1: "clean text", 2: None}
    assert decontaminate.find(docs.limit(0), bench).count() == 0
    assert decontaminate.find(docs, bench.limit(0)).filter("size(word_spans) > 0").count() == 0


def test_fm_index_counts_and_places():
    import numpy as np

    r = np.random.default_rng(1)
    s = np.concatenate([[0], r.integers(0, 4, 2000)])
    index = decontaminate.FMIndex(s)
    for n in (1, 2, 3, 5):
        rows = r.integers(1, 5, (20, n))
        lo, hi = index.search(rows, np.full(20, n))
        for p, a, b in zip(rows, lo, hi):
            want = [i for i in range(len(s) - n + 1) if (s[i : i + n] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist() if a < b else []) == want
