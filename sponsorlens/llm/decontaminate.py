"""Benchmark decontamination with an FM-index per shard of documents.

A task cuts its documents into shards of whole texts. Of a shard's word
sequence only runs that could take part in a match are indexed: words whose
q-gram (q: up to 4, no longer than the shortest phrase) occurs in some phrase;
runs are kept apart by separators. The index is the suffix order, its
Burrows-Wheeler transform in a wavelet matrix (one rank table per bit of the
alphabet) and every 8th suffix position. All phrases are searched backwards at
once; the rows found are walked to a sampled position; the occurrences are
merged into removal spans.

Phrases are windows of ``window`` consecutive words of an item; an item of
fewer words is one phrase. The items are a stated query set: they reach the
tasks in blocks of at most ``BLOCK_WORDS`` words, one broadcast after another,
however many there are, and the hits of all blocks are merged by document.

Null texts have no words. Documents without a hit come back with empty arrays;
repeated rows stay; input columns named like an output column are replaced. An
item id that is null counts as the item "".
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Shared, add_columns, fresh_name, table, with_outputs, words_of, written

WINDOW = 10
SHARD_WORDS = 500_000
BLOCK_WORDS = 2_000_000
SAMPLE_EVERY = 8
LOCATE_ROWS = 1_000_000
#: A word before A-Z are lowered.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


class Phrases:
    """The distinct windows of a block of items, as rows of word numbers (0: past the end)."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.ids: list[str] = []
        self.word: dict[bytes, int] = {}
        rows: dict[tuple, set] = {}
        for item, text in items:
            w = [self.word.setdefault(x, len(self.word) + 1) for x in words_of((text or "").encode())]
            if not w:
                continue
            k = len(self.ids)
            self.ids.append("" if item is None else str(item))
            for i in range(max(1, len(w) - window + 1)):
                rows.setdefault(tuple(w[i : i + window]), set()).add(k)
        self.size = np.array([len(r) for r in rows], np.int64)
        self.rows = np.zeros((len(rows), window), np.int64)
        for i, r in enumerate(rows):
            self.rows[i, : len(r)] = r
        self.item_at = np.cumsum([0, *(len(x) for x in rows.values())])
        self.items = np.array([k for x in rows.values() for k in sorted(x)], np.int64)
        self.q = int(min(4, self.size.min())) if len(rows) else 1
        grams = [self.gram(self.rows[:, i : i + self.q])[self.size >= i + self.q] for i in range(window - self.q + 1)]
        self.seen = np.zeros(1 << 22, bool)
        if len(rows):
            self.seen[np.concatenate(grams)] = True

    @staticmethod
    def gram(parts: np.ndarray) -> np.ndarray:
        """Slots of q-grams (columns) in the filter; chance hits only lengthen the index."""
        h = np.zeros(len(parts), np.uint64)
        for i in range(parts.shape[1]):
            h = (h ^ parts[:, i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return (h & np.uint64((1 << 22) - 1)).astype(np.int64)

    def candidates(self, seq: np.ndarray) -> np.ndarray:
        """True for words of ``seq`` that are part of a q-gram of some phrase."""
        n, q = len(seq), self.q
        out = np.zeros(n, bool)
        if n < q:
            return out
        parts = np.stack([seq[i : n - q + 1 + i] for i in range(q)], 1)
        live = np.flatnonzero((parts > 0).all(1))
        hit = live[self.seen[self.gram(parts[live])]]
        for i in range(q):
            out[hit + i] = True
        return out


def suffix_order(s: np.ndarray) -> np.ndarray:
    """Order of the suffixes by prefix doubling; every 0 is a separator, smaller
    than all words and than the separators after it, so suffixes end there."""
    n = len(s)
    seps = s == 0
    rank = s + int(seps.sum())
    rank[seps] = np.arange(int(seps.sum()))
    rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        nxt = np.zeros(n, np.int64)
        nxt[: n - step] = rank[step:] + 1 if step < n else 0
        key = rank * np.int64(n + 2) + nxt
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        step *= 2


class WaveletMatrix:
    """Access and rank over a sequence of small numbers, one bit a level."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.bits = max(1, int(values.max()).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (values >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int(self.n - self.ones[-1][-1]))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each i."""
        lo, hi = np.zeros_like(i), i
        for level, ones, zeros in zip(range(self.bits - 1, -1, -1), self.ones, self.zeros):
            bit = (symbol >> level) & 1 == 1
            lo = np.where(bit, zeros + ones[lo], lo - ones[lo])
            hi = np.where(bit, zeros + ones[hi], hi - ones[hi])
        return hi - lo

    def step(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each i and its rank there."""
        lo, hi, symbol = np.zeros_like(i), i, np.zeros_like(i)
        for ones, zeros in zip(self.ones, self.zeros):
            bit = ones[hi + 1] - ones[hi] == 1
            symbol = symbol * 2 + bit
            lo = np.where(bit, zeros + ones[lo], lo - ones[lo])
            hi = np.where(bit, zeros + ones[hi], hi - ones[hi])
        return symbol, hi - lo


class FMIndex:
    """Full-text index of a sequence that starts with the separator 0."""

    def __init__(self, s: np.ndarray):
        order = suffix_order(s)
        before = s[order - 1]
        self.tree = WaveletMatrix(before)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(s))]).astype(np.int64)
        # A walk never passes a separator: what follows one is sampled too.
        self.sampled = (order % SAMPLE_EVERY == 0) | (before == 0)
        self.sample_at = np.concatenate([[0], np.cumsum(self.sampled)])
        self.positions = order[self.sampled]

    def search(self, rows: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end row of the suffixes that each phrase begins."""
        lo, hi = np.zeros(len(rows), np.int64), np.full(len(rows), self.tree.n, np.int64)
        for back in range(1, rows.shape[1] + 1):
            live = np.flatnonzero((size >= back) & (lo < hi))
            symbol = rows[live, size[live] - back]
            known = symbol < len(self.below) - 1
            start = self.below[np.where(known, symbol, 0)]
            lo[live] = np.where(known, start + self.tree.rank(np.where(known, symbol, 0), lo[live]), 0)
            hi[live] = np.where(known, start + self.tree.rank(np.where(known, symbol, 0), hi[live]), 0)
        return lo, hi

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Positions of suffixes, walking back to a sampled one."""
        out, steps, todo = np.empty(len(row), np.int64), 0, np.arange(len(row))
        row = row.copy()
        while len(todo):
            there = self.sampled[row]
            out[todo[there]] = self.positions[self.sample_at[row[there]]] + steps
            todo, row = todo[~there], row[~there]
            symbol, rank = self.tree.step(row)
            row = self.below[symbol] + rank
            steps += 1
        return out


def search_shard(texts: list[list[bytes]], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, phrase) of every occurrence, documents by number."""
    none = np.zeros(0, np.int64)
    if not len(phrases.rows):
        return none, none, none
    get = phrases.word.get
    starts = np.cumsum([0, *(len(w) + 1 for w in texts)])
    seq = np.zeros(starts[-1] + 1, np.int64)
    for at, w in zip(starts, texts):
        seq[at + 1 : at + 1 + len(w)] = [get(x, 0) for x in w]
    keep = phrases.candidates(seq)
    at = np.flatnonzero(keep)
    if not len(at):
        return none, none, none
    first = np.concatenate([[True], np.diff(at) > 1])
    place = np.arange(len(at)) + np.cumsum(first)            # one separator before each run
    text = np.zeros(place[-1] + 1, np.int64)
    text[place] = seq[at]
    origin = np.zeros(len(text), np.int64)
    origin[place] = at
    index = FMIndex(text)
    lo, hi = index.search(phrases.rows, phrases.size)
    found = np.flatnonzero(lo < hi)
    out: list[tuple] = []
    counts = hi[found] - lo[found]
    ends = np.cumsum(counts)
    for b in range(0, int(ends[-1]) if len(ends) else 0, LOCATE_ROWS):
        k = np.arange(b, min(b + LOCATE_ROWS, int(ends[-1])))
        which = np.searchsorted(ends, k, side="right")
        rows = lo[found[which]] + (k - (ends[which] - counts[which]))
        out.append((found[which], origin[index.locate(rows)]))
    if not out:
        return none, none, none
    phrase, where = np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])
    doc = np.searchsorted(starts, where, side="left") - 1
    return doc, where - starts[doc] - 1, phrase


def merged(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Union of spans, in order."""
    if not len(start):
        return []
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    return list(zip(start[new].tolist(), reach[np.concatenate([new[1:], [True]])].tolist()))


def _hits(docs: DataFrame, text: str, phrases: Phrases, shard_words: int, cleaned: str | None = None) -> DataFrame:
    """``docs`` with n_words, word_spans and item_ids for one block of items,
    and with the text without its removal spans in ``cleaned``."""
    full, kept = with_outputs(docs, "n_words long, word_spans array<struct<s:int,e:int>>, item_ids array<string>"
                              + (f", `{cleaned}` string" if cleaned else ""))
    arrow = to_arrow_schema(full)
    shared = Shared(docs.sparkSession, phrases)

    def answer(rows: pa.Table, words: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        doc, at, phrase = search_shard(words, p)
        order = np.argsort(doc, kind="stable")
        doc, at, phrase = doc[order], at[order], phrase[order]
        cut = np.searchsorted(doc, np.arange(len(words) + 1))
        spans: list[list] = []
        items: list[list] = []
        for a, b in zip(cut, cut[1:]):
            spans.append([{"s": s, "e": e} for s, e in merged(at[a:b], at[a:b] + p.size[phrase[a:b]])])
            ks = {k for x in np.unique(phrase[a:b]) for k in p.items[p.item_at[x] : p.item_at[x + 1]].tolist()}
            items.append(sorted({p.ids[k] for k in ks}))
        cols = [rows.column(c).combine_chunks().cast(arrow.field(c).type) for c in kept]
        made = {"n_words": [len(w) for w in words], "word_spans": spans, "item_ids": items}
        if cleaned:
            made[cleaned] = [without(t, x) for t, x in zip(rows.column(text).to_pylist(), spans)]
        out = pa.Table.from_arrays([*cols, *(pa.array(made[f.name], f.type) for f in list(arrow)[len(kept):])], schema=arrow)
        yield from out.to_batches(max_chunksize=2000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[pa.RecordBatch] = []
        words: list[list[bytes]] = []
        n = 0
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                rows.append(b)
                more = [words_of((t or "").encode()) for t in b.column(text).to_pylist()]
                words += more
                n += sum(map(len, more))
                if n >= shard_words:
                    yield from answer(pa.Table.from_batches(rows), words)
                    rows, words, n = [], [], 0
        if rows:
            yield from answer(pa.Table.from_batches(rows), words)

    return docs.mapInArrow(run, full)


def find(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
         window: int = WINDOW, shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS, cleaned: str | None = None) -> DataFrame:
    """``docs`` with n_words, word_spans (merged, word numbers, end exclusive) and
    item_ids (sorted strings); ``cleaned``: a column for the text without its spans."""
    some = items.select(F.col(item).cast("string").alias("i"), F.col(item_text).alias("t")).filter(F.col("t").isNotNull())
    total = some.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-int(total) // (4 * block_words)))
    part = lambda k: some.filter(F.pmod(F.hash("i", "t"), F.lit(blocks)) == k) if blocks > 1 else some
    phrases = lambda k: Phrases([(r.i, r.t) for r in part(k).toLocalIterator()], window)
    if blocks == 1:
        return _hits(docs, text, phrases(0), shard_words, cleaned)
    key = fresh_name(docs, "row_key")
    # Written: the keys must stay the same in every block.
    keyed = written(docs.withColumn(key, F.monotonically_increasing_id()), "keyed_texts")
    found = None
    for k in range(blocks):
        hits = written(_hits(keyed.select(key, text), text, phrases(k), shard_words)
                       .filter(F.size("word_spans") > 0).select(key, "word_spans", "item_ids"), "hits")
        found = hits if found is None else found.union(hits)
    # A document has at most one row for each block here.
    by_doc = found.groupBy(key).agg(
        F.array_sort(F.flatten(F.collect_list("word_spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("items"))
    merge = F.aggregate(
        F.col("spans"), F.expr("cast(array() as array<struct<s:int,e:int>>)"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (x["s"] <= F.try_element_at(acc, F.lit(-1))["e"]),
            F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(
                F.try_element_at(acc, F.lit(-1))["s"].alias("s"),
                F.greatest(F.try_element_at(acc, F.lit(-1))["e"], x["e"]).alias("e")))))
        .otherwise(F.concat(acc, F.array(x))))
    empty = _hits(keyed, text, Phrases([], window), shard_words).drop("word_spans", "item_ids")
    none = F.expr("cast(array() as array<struct<s:int,e:int>>)")
    found = (empty.join(by_doc.select(key, merge.alias("word_spans"), F.col("items").alias("item_ids")), key, "left")
             .withColumn("word_spans", F.coalesce("word_spans", none))
             .withColumn("item_ids", F.coalesce("item_ids", F.expr("cast(array() as array<string>)"))).drop(key))
    if not cleaned:
        return found
    return add_columns(found.withColumn(cleaned, F.struct(F.col(text).alias("t"), F.col("word_spans").alias("x"))), cleaned,
                       lambda rows, _: {cleaned: [without(r["t"], r["x"]) for r in rows]}, f"`{cleaned}` string")


def without(text: str | None, spans: list) -> str | None:
    """``text`` without the words of its spans, and without what stands between them."""
    if not spans:
        return text
    at = [m.span() for m in WORD.finditer(text)]
    left, end = [], 0
    for x in spans:
        left.append(text[end : at[x["s"]][0]])
        end = at[x["e"] - 1][1]
    return "".join([*left, text[end:]])


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words",
        F.aggregate("word_spans", F.lit(0).cast("long"), lambda a, x: a + (x["e"] - x["s"])).alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("word_spans") > 0).alias("contaminated"))
