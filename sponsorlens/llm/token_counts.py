"""Token counts by overlap resynchronisation.

Texts of up to ``chunk`` characters are encoded by the task that reads them.
A longer text is cut into overlapping chunks, which are shuffled apart, so that
no task encodes a huge text alone. Each chunk reports how many tokens it has
and, for both its overlaps, the ids and offsets there. Neighbours are spliced
at a stable boundary: a whitespace character inside the overlap, where a
tokenizer that drops whitespace before it merges must start anew, and after
which both sides give the same tokens as far as whole words go. The tokens
that both have are then taken off once. Where an overlap holds no such place,
its text goes through again with overlaps twice as wide, at last with one chunk.

Only tokenizers that drop whitespace are accepted (their words are independent
of each other, so a task encodes each distinct word once, in a bounded table).
Null and empty texts have no tokens; repeated rows stay; input columns named
like an output column are replaced.
"""
from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, fresh_name, quiet_gc, table, worker_cache, written

CHUNK = 16_384
OVERLAP = 256
TABLE_ENTRIES = 500_000
LONG_WORD = 64
#: All of these are whitespace to the tokenizer; others may stay inside a word.
SPACES = str.maketrans("\n\t\r", "   ")


class WordCounter:
    """Token counts of texts from a table of distinct words, filled by the library."""

    def __init__(self, tokenizer: str, entries: int = TABLE_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(tokenizer)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.entries = entries
        self.known: dict[str, int] = {}
        a, b, both = (self.tok.encode(x, add_special_tokens=False).ids for x in ("ab", "cd", "ab \n\tcd "))
        if a + b != both:
            raise ValueError("the tokenizer keeps whitespace: words are not independent")

    def encode(self, words: list[str]) -> list:
        return self.tok.encode_batch(words, add_special_tokens=False)

    def count(self, texts: list[str | None]) -> list[int]:
        cut = [(t or "").translate(SPACES).split(" ") for t in texts]
        if len(self.known) > self.entries:
            self.known = {}
        new = list(set(chain.from_iterable(cut)).difference(self.known))
        found = {w: len(e.ids) for w, e in zip(new, self.encode(new))}
        long = {w: found.pop(w) for w in new if len(w) > LONG_WORD}
        self.known.update(found)
        look = {**self.known, **long} if long else self.known
        return [sum(map(look.__getitem__, c)) for c in cut]

    def tokens(self, text: str, offset: int) -> tuple[list[int], list[int]]:
        """Ids of a short text and where each starts, from ``offset`` on."""
        e = self.tok.encode(text, add_special_tokens=False)
        return e.ids, [offset + s for s, _ in e.offsets]


def counter(tokenizer: str) -> WordCounter:
    return quiet_gc(worker_cache(("words", tokenizer), lambda: WordCounter(tokenizer)))


def cut_points(n: int, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """Spans of at most ``chunk`` + ``overlap`` characters that cover n, each
    beginning ``overlap`` characters before the last one's end."""
    out, at = [], 0
    while True:
        end = min(n, at + chunk + overlap)
        out.append((at, end))
        if end == n:
            return out
        at = end - overlap


def splice(left: tuple[list, list], right: tuple[list, list], overlap: str, start: int) -> int | None:
    """What the two chunks that share ``overlap`` (which starts at ``start``)
    count too much, or None. left, right: (ids, offsets) of their tokens there."""
    spaces = [i for i, c in enumerate(overlap) if c in " \n\t\r"]
    if not spaces:
        return None
    first, last = start + spaces[0], start + spaces[-1]
    within = lambda t: [(i, s) for i, s in zip(*t) if first <= s < last]
    if within(left) != within(right):
        return None
    return sum(s >= first for s in left[1]) + sum(s < first for s in right[1])


def _resync(huge: DataFrame, key: str, text: str, tokenizer: str, chunk: int, overlap: int, parts: int) -> DataFrame:
    """(key, n, failed) of each huge text with this overlap."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                spans = cut_points(len(t), chunk, overlap)
                for i in range(0, len(spans), 64):
                    some = spans[i : i + 64]
                    yield pa.RecordBatch.from_pydict({
                        "k": [k] * len(some), "i": list(range(i, i + len(some))), "at": [a for a, _ in some],
                        "last": [e == len(t) for _, e in some], "piece": [t[a:e] for a, e in some]},
                        schema=pa.schema([("k", pa.int64()), ("i", pa.int64()), ("at", pa.int64()), ("last", pa.bool_()), ("piece", pa.string())]))

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = counter(tokenizer)
        for df in frames:
            rows = []
            for k, i, at, last, piece, n in zip(df.k, df.i, df["at"], df["last"], df.piece, words.count(df.piece.tolist())):
                rows.append((k, -1 - i, "", n, [], [], 0, False))
                if i:
                    # The word after the overlap's end belongs to what is encoded here.
                    seen = piece[: overlap + LONG_WORD]
                    ids, starts = words.tokens(seen, at)
                    rows.append((k, i, piece[:overlap], 0, *_till(ids, starts, at + overlap), at, True))
                if not last:
                    at_end = max(0, len(piece) - overlap)
                    back = max(piece.rfind(c, 0, at_end) for c in " \n\t\r")
                    ids, starts = words.tokens(piece[back + 1 :], at + back + 1)
                    keep = [x for x, s in enumerate(starts) if s >= at + at_end]
                    rows.append((k, i + 1, piece[at_end:], 0, [ids[x] for x in keep], [starts[x] for x in keep], at + at_end, False))
            yield pd.DataFrame(rows, columns=["k", "b", "overlap", "n", "ids", "starts", "at", "is_right"])

    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The two sides of a boundary follow each other, maybe in two batches.
        left = None
        for df in frames:
            rows = []
            for r in df.itertuples(index=False):
                if r.b < 0:
                    rows.append((r.k, r.n, False))
                elif not r.is_right:
                    left = r
                else:
                    twice = splice((list(left.ids), list(left.starts)), (list(r.ids), list(r.starts)), r.overlap, r.at)
                    rows.append((r.k, -(twice or 0), twice is None))
            yield pd.DataFrame(rows, columns=["k", "n", "failed"])

    pieces = huge.select(F.col(key).alias("k"), F.col(text).alias("piece")).mapInArrow(
        cut, "k long, i long, at long, last boolean, piece string").repartition(parts, "k", "i")
    sides = pieces.mapInPandas(
        encode, "k long, b long, overlap string, n long, ids array<long>, starts array<long>, at long, is_right boolean")
    dealt = sides.repartition(parts, "k", "b").sortWithinPartitions("k", "b", "is_right")
    return dealt.mapInPandas(join, "k long, n long, failed boolean").groupBy("k").agg(
        F.sum("n").alias("n"), F.max("failed").alias("failed"))


def _till(ids: list, starts: list, end: int) -> tuple[list, list]:
    n = sum(s < end for s in starts)
    return ids[:n], starts[:n]


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text", n_tokens: str = "n_tokens",
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``docs`` with the number of tokens of each whole text."""
    spark = docs.sparkSession
    docs = docs.drop(n_tokens) if n_tokens != text else docs
    long = F.length(F.coalesce(F.col(text), F.lit(""))) > chunk
    key = fresh_name(docs, "row_key")
    short = add_columns(docs.filter(~long), text, lambda v, w: {n_tokens: w.count(v)}, f"`{n_tokens}` long",
                        make=lambda: counter(tokenizer))
    # Written: the keys must stay the same in every round.
    huge = written(docs.filter(long).withColumn(key, F.monotonically_increasing_id()), "huge_texts")
    if huge.isEmpty():
        return short
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    longest = huge.agg(F.max(F.length(text))).first()[0]
    left, rounds = huge, []
    while True:
        got = written(_resync(left, key, text, tokenizer, max(chunk, overlap), overlap, parts), "resync")
        rounds.append(got.filter(~F.col("failed")).select(F.col("k").alias(key), F.col("n").alias(n_tokens)))
        failed = got.filter("failed").select(F.col("k").alias(key))
        if overlap > longest or failed.isEmpty():
            break
        overlap *= 2
        left = huge.join(failed, key, "left_semi")
    done = rounds[0]
    for r in rounds[1:]:
        done = done.union(r)
    counted = huge.join(done, key).drop(key)
    return short.unionByName(counted.select(*short.columns))


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > 2048).alias("over_limit"))
