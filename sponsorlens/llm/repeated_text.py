"""Bytes that long repeated strings cover, by merged Burrows-Wheeler transforms.

A byte goes if it lies in a string of ``LEAST`` bytes that also starts earlier
(a smaller doc_id, or the same and an earlier place).

Every window of ``LEAST`` bytes has an anchor, its ``GRAM`` bytes with the least
hash (leftmost of equals); equal windows have equal anchors. Consecutive windows
with the same anchor make a context, the text they span (at most
2 * LEAST - GRAM bytes). Only contexts whose anchor occurs twice in the corpus
can hold a repeated window. Equal contexts of a block of documents are one.

The contexts go to buckets by anchor, and those of each group of shards make a
multi-string transform: suffixes sorted within the shard, its last column, and
the mapping to the row of the suffix one byte longer. A bucket's transforms are
merged by refining their interleave: rows that agree in their first k bytes,
kept in that order, are sorted, stably, by the bytes that precede them, read from
the last columns, and mapped, which orders the longer suffixes by k + 2 bytes. Rows that
agree with no other are settled and leave. After ``LEAST`` bytes the runs of
agreeing rows are the intervals with a common prefix of ``LEAST``, that is the
repeated windows; all but the earliest of each are hit. No suffixes of different
shards are compared. An anchor with more than ``HOT`` bytes of contexts has its
windows counted one by one in a shuffle instead, by 128-bit names.

Null texts are empty. Rows of the same doc_id are one document in the order
above: none of two equal rows, or of windows at the same place, is the earlier
one. Rows without doc_id come after all others. An empty table has no rows.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written

LEAST = 100
GRAM = 32
SHARD = 16_000_000             # bytes of text in a shard, at most on average
HELD = 1_000_000               # bytes of text gone through together
BUCKET = 2_000_000             # bytes of contexts in a bucket, on average
RUNS = 8                       # transforms that are merged in a bucket
HOT = 8_000_000                # bytes of contexts of one anchor beyond which they are split
LAST = np.iinfo(np.int64).max  # in place of a null doc_id
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def scattered(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M2
    return x ^ (x >> np.uint64(29))


class Scan:
    """Contexts of a block of texts: document, first window, windows, and a 64-bit name of the anchor."""

    def __init__(self, texts: list[bytes]):
        lens = np.array([len(t) for t in texts], np.int64)
        self.text = b"".join(texts)
        self.begin = np.cumsum(lens) - lens
        self.doc = self.first = self.windows = np.zeros(0, np.int64)
        self.anchor = np.zeros(0, np.uint64)
        n = len(self.text)
        if n < LEAST:
            return
        a = np.frombuffer(self.text, np.uint8).astype(np.uint64)
        u = a[:-1] | a[1:] << np.uint64(8)
        u = u[:-2] | u[2:] << np.uint64(16)
        u = u[:-4] | u[4:] << np.uint64(32)
        m = n - GRAM + 1
        h = u[:m] * M1
        for k in range(8, GRAM, 8):
            h ^= h >> np.uint64(31)
            h ^= u[k : k + m]
            h *= M2
        h ^= h >> np.uint64(29)
        # The leftmost least hash of each window: 32 bits of the hash, then the place.
        least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(m, dtype=np.uint64)
        width, wanted = 1, LEAST - GRAM + 1
        while 2 * width <= wanted:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < wanted:
            least = np.minimum(least[: width - wanted], least[wanted - width :])
        place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        ok = np.zeros(n + 1, np.int64)
        some = lens >= LEAST                                         # windows that stay in their text
        np.add.at(ok, self.begin[some], 1)
        np.add.at(ok, (self.begin + lens)[some] - LEAST + 1, -1)
        ok = np.cumsum(ok)[: len(place)] > 0
        place = np.where(ok, place, -1)
        cut = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        count = np.diff(np.append(cut, len(place)))
        real = place[cut] >= 0
        cut, count = cut[real], count[real]
        self.doc = np.searchsorted(self.begin, cut, "right") - 1
        self.first, self.windows = cut, count
        self.anchor = scattered(h[place[cut]])

    def spelled(self, some: np.ndarray) -> np.ndarray:
        """Numbers of some contexts; equal texts have the same."""
        number: dict[bytes, int] = {}
        out = np.empty(len(some), np.int64)
        e = self.first[some] + self.windows[some] + LEAST - 1
        for k in range(0, len(some), 20_000):
            part = some[k : k + 20_000]
            out[k : k + 20_000] = [number.setdefault(self.text[x:y], len(number)) for x, y in zip(self.first[part].tolist(), e[k : k + 20_000].tolist())]
        return out


def blocks_of(rows: Iterator[tuple], held: int = HELD) -> Iterator[list[tuple]]:
    """Rows, whose last field is a text, in blocks of some bytes (or one longer text)."""
    block, size = [], 0
    for r in rows:
        if block and size + len(r[-1]) > held:
            yield block
            block, size = [], 0
        block.append(r)
        size += len(r[-1])
    if block:
        yield block


def repeated_anchors(docs: DataFrame) -> DataFrame:
    """(shard, anchor) of the anchors of ``docs`` (doc, doc_id, shard, text) that occur twice anywhere."""
    schema = pa.schema([("anchor", pa.int64()), ("shard", pa.int32()), ("n", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(((s, t) for b in batches for s, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))):
            scan = Scan([t for _, t in block])
            shard = np.array([s for s, _ in block], np.int64)[scan.doc]
            order = np.lexsort((shard, scan.anchor))
            a, s = scan.anchor[order], shard[order]
            first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (s[1:] != s[:-1])])) if len(a) else np.zeros(0, np.int64)
            n = np.minimum(np.diff(np.append(first, len(a))), 2)
            for k in range(0, len(first), 20_000):
                i = first[k : k + 20_000]
                cols = [a[i].view(np.int64), s[i].astype(np.int32), n[k : k + 20_000].astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], schema=schema)

    found = docs.select("shard", "text").mapInArrow(run, "anchor long, shard int, n int")
    total = F.sum("n").over(Window.partitionBy("anchor"))
    return found.select("anchor", "shard", total.alias("total")).filter("total > 1").select("shard", "anchor")


def streamed(rows: DataFrame, docs: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` and ``docs`` of the same shards in one partition, in order of ``key``, the rows before the
    documents: a merge join for a task that reads them as a stream."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = rows.withColumn("kind", F.lit(0)).unionByName(docs.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return both.repartition(n, "shard").sortWithinPartitions(*key, "kind")


CONTEXTS = "hit boolean, anchor long, shard int, doc_id long, doc long, s long, e long, context binary"
CONTEXT_ARROW = pa.schema([("hit", pa.bool_()), ("anchor", pa.int64()), ("shard", pa.int32()), ("doc_id", pa.int64()), ("doc", pa.int64()),
                           ("s", pa.int64()), ("e", pa.int64()), ("context", pa.binary())])


def later(group: np.ndarray, doc_id: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which items are later than the earliest (doc_id, start) of their group."""
    order = np.lexsort((start, doc_id, group))
    g, d, s = group[order], doc_id[order], start[order]
    first = np.maximum.accumulate(np.where(np.concatenate([[True], g[1:] != g[:-1]]), np.arange(len(g)), 0)) if len(g) else np.zeros(0, np.int64)
    out = np.zeros(len(g), bool)
    out[order] = (d != d[first]) | (s != s[first])
    return out


def spans_of(owner: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of intervals by owner."""
    order = np.lexsort((s, owner))
    owner, s, e = owner[order], s[order], e[order]
    if not len(s):
        return owner, s, e
    wide = int(e.max()) + 1                                          # owners side by side on one line
    line = np.unique(owner, return_inverse=True)[1] * wide
    reach = np.maximum.accumulate(e + line)
    new = np.concatenate([[True], (s + line)[1:] > reach[:-1]])
    last = np.append(np.flatnonzero(new)[1:], len(s)) - 1
    return owner[new], s[new], (reach - line)[last]


def contexts(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """Contexts whose anchors are repeated, one of those that are equal within a block, and spans
    (hit) of the others, which equal an earlier one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: list[np.ndarray] = []
        names = np.zeros(0, np.uint64)
        held: list[tuple] = []
        size, shard = 0, None

        def flush() -> Iterator[pa.RecordBatch]:
            for block in blocks_of(iter(held)):
                scan = Scan([t for *_, t in block])
                i = np.flatnonzero(np.isin(scan.anchor, names)) if len(names) else np.zeros(0, np.int64)
                if not len(i):
                    continue
                d = scan.doc[i]
                doc_id = np.array([x for x, *_ in block], np.int64)[d]
                doc = np.array([x for _, x, _ in block], np.int64)[d]
                at = scan.first[i]
                s = at - scan.begin[d]
                e = s + scan.windows[i] + LEAST - 1
                gone = later(scan.spelled(i), doc_id, s)
                hd, hs, he = spans_of(doc[gone], s[gone], e[gone])
                m = len(hd)
                yield pa.RecordBatch.from_arrays([pa.array([True] * m, pa.bool_()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64()),
                                                  pa.array(hd), pa.array(hs), pa.array(he), pa.nulls(m, pa.binary())], schema=CONTEXT_ARROW)
                kept = np.flatnonzero(~gone)
                for k in range(0, len(kept), 5000):
                    j = kept[k : k + 5000]
                    text = [scan.text[x:y] for x, y in zip(at[j].tolist(), (at[j] + e[j] - s[j]).tolist())]
                    cols = [pa.array([False] * len(j)), pa.array(scan.anchor[i[j]].view(np.int64)), pa.array(np.full(len(j), shard, np.int32)),
                            pa.array(doc_id[j]), pa.array(doc[j]), pa.array(s[j]), pa.array(e[j]), pa.array(text, pa.binary())]
                    yield pa.RecordBatch.from_arrays(cols, schema=CONTEXT_ARROW)

        for b in batches:
            of, kind = (b.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "kind"))
            edge = np.append(np.concatenate([[0], np.flatnonzero((of[1:] != of[:-1]) | (kind[1:] != kind[:-1])) + 1]), len(of))
            for x, y in zip(edge[:-1].tolist(), edge[1:].tolist()):
                if y == x:
                    continue
                part = b.slice(x, y - x)
                if of[x] != shard:
                    yield from flush()
                    held, size, known, names, shard = [], 0, [], np.zeros(0, np.uint64), int(of[x])
                if kind[x] == 0:
                    known.append(part.column("anchor").to_numpy().astype(np.int64).view(np.uint64))
                    continue
                if known:
                    names, known = np.unique(np.concatenate([names, *known])), []
                for row in zip(part.column("doc_id").to_pylist(), part.column("doc").to_pylist(), part.column("text").to_pylist()):
                    held.append(row)
                    size += len(row[-1])
                    if size > HELD:
                        yield from flush()
                        held, size = [], 0
        yield from flush()

    both = streamed(anchors, docs, ["shard"]).select("shard", "kind", "anchor", "doc_id", "doc", "text")
    return both.mapInArrow(run, CONTEXTS)


class Transform:
    """Burrows-Wheeler transform of a shard's strings; ends of strings sort before all bytes, in the strings' order.

    ``last``: the byte before each suffix, ``longer``: the row of the suffix with that byte (-1 at a
    string's start); ``string`` and ``place`` tell where a row's suffix begins."""

    def __init__(self, strings: list[bytes]):
        lens = np.array([len(x) for x in strings], np.int64)
        m, n = len(strings), int(lens.sum()) + len(strings)
        begin = np.cumsum(lens + 1) - lens - 1
        text = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
        owner = np.repeat(np.arange(m), lens + 1)
        place = np.arange(n) - begin[owner]
        order = self.sorted(text, lens[owner] - place, owner)
        begins = place[order] == 0
        self.last = text[order - 1]
        inner = np.flatnonzero(~begins)
        self.longer = np.full(n, -1, np.int64)
        # Suffixes with the same first byte are in the order of what follows it.
        self.longer[inner[np.argsort(self.last[inner], kind="stable")]] = m + np.arange(len(inner))
        self.string, self.place = np.empty(n, np.int64), np.empty(n, np.int64)
        row, which, at = np.arange(m), np.arange(m), lens.copy()
        while len(row):                                              # from the ends of the strings backwards
            self.string[row], self.place[row] = which, at
            more = self.longer[row]
            on = more >= 0
            row, which, at = more[on], which[on], at[on] - 1

    @staticmethod
    def sorted(text: np.ndarray, left: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Suffixes in order. left: bytes of the string from each place on."""
        n = len(text)
        wide = np.concatenate([text.astype(np.uint64) + np.uint64(1), np.zeros(7, np.uint64)])
        key = np.zeros(n, np.uint64)
        for k in range(7):                                           # 7 bytes, 0 from the string's end on
            key = key << np.uint64(9) | wide[k : k + n]
        cut = (np.clip(7 - left, 0, 7) * 9).astype(np.uint64)
        key = key >> cut << cut
        order = np.argsort(key)
        ranked = key[order]
        start = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        rank = np.empty(n, np.int64)
        rank[order] = np.maximum.accumulate(np.where(start, np.arange(n), 0))
        size, most = 7, int(left.max()) + 1
        while size < most:                                           # by twice as many bytes, where undecided
            count = np.bincount(rank, minlength=n)
            open_ = np.flatnonzero((count[rank] > 1) & (left >= size))
            if not len(open_):
                break
            # Those that end within the first part are equal to it and come first.
            some = np.flatnonzero(count[rank] > 1)
            on = left[some] >= size
            next_ = np.where(on, rank[np.minimum(some + size, n - 1)] + 1, 0)
            both = rank[some] << 32 | next_
            by = np.argsort(both)
            some, both = some[by], both[by]
            old = np.concatenate([[True], both[1:] >> 32 != both[:-1] >> 32])
            new = np.concatenate([[True], both[1:] != both[:-1]])
            i = np.arange(len(some))
            rank[some] += np.maximum.accumulate(np.where(new, i, 0)) - np.maximum.accumulate(np.where(old, i, 0))
            size *= 2
        return np.argsort(rank << 32 | owner)


def repeated_windows(shards: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(interval, shard, string, place) of all windows of ``LEAST`` bytes that occur twice in the strings
    of some shards, by merging the shards' transforms."""
    made = [Transform(x) for x in shards]
    shift = np.cumsum([0] + [len(t.last) for t in made])
    last = np.concatenate([t.last for t in made])
    longer = np.concatenate([np.where(t.longer < 0, -1, t.longer + o) for t, o in zip(made, shift)])
    place = np.concatenate([t.place for t in made])
    # Two bytes a step; rows too close to their string's start for a window are never followed.
    two = last[longer].astype(np.uint16) << 8 | last
    twice = longer[longer].astype(np.int32)
    row = np.flatnonzero(place >= LEAST).astype(np.int32)            # in order of shard and of the shard's suffixes
    run = np.zeros(len(row), np.int32)
    for _ in range(LEAST // 2):
        byte = two[row]
        order = np.argsort(byte, kind="stable")
        byte, run = byte[order], run[order]
        row = twice[row[order]]
        if not len(row):
            break
        run = np.cumsum(np.concatenate([[False], (byte[1:] != byte[:-1]) | (run[1:] != run[:-1])]), dtype=np.int32)
        alone = np.bincount(run)[run] == 1
        if alone.any():                                              # settled
            row, run = row[~alone], run[~alone]
    shard = np.searchsorted(shift, row, "right") - 1
    string = np.concatenate([t.string for t in made])[row] if len(row) else row
    return run, shard, string, place[row]


def bucket_hits(df: pd.DataFrame) -> pd.DataFrame:
    """(doc, s, e) of a bucket's contexts that are repeated earlier."""
    text = df.context.to_list()
    doc_id, doc, s = (df[c].to_numpy(np.int64) for c in ("doc_id", "doc", "s"))
    e = df.e.to_numpy(np.int64)
    number = {x: k for k, x in enumerate(dict.fromkeys(text))}
    gone = later(np.fromiter(map(number.__getitem__, text), np.int64, len(text)), doc_id, s)
    found = [(doc[gone], s[gone], e[gone])]
    kept = np.flatnonzero(~gone)
    # Equal windows have equal anchors, so a context whose anchor is left with no other can't repeat one.
    anchor = df["anchor"].to_numpy(np.int64)[kept]
    _, at, count = np.unique(anchor, return_inverse=True, return_counts=True)
    kept = kept[count[at] > 1]
    run = df["shard"].to_numpy(np.int64)[kept] % RUNS
    shards = [kept[run == k] for k in np.unique(run)]
    if shards:
        interval, shard, string, place = repeated_windows([[text[i] for i in x] for x in shards])
        which = np.empty(len(interval), np.int64)
        for k, x in enumerate(shards):
            which[shard == k] = x[string[shard == k]]
        start = s[which] + place
        hit = later(interval, doc_id[which], start)
        found.append(spans_of(doc[which[hit]], start[hit], start[hit] + LEAST))
    return pd.DataFrame({c: np.concatenate(x) for c, x in zip(("doc", "s", "e"), zip(*found))})


def hot_hits(some: DataFrame) -> DataFrame:
    """(doc, s, e) of the windows of very frequent anchors, each by its own name."""
    schema = pa.schema([(c, pa.int64()) for c in ("n1", "n2", "doc_id", "doc", "s")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                rows = []
                for doc_id, doc, s, x in zip(*(c.to_pylist() for c in whole.slice(at, 200).columns)):
                    for k in range(len(x) - LEAST + 1):
                        n = xxhash.xxh3_128_digest(x[k : k + LEAST])
                        rows.append((*np.frombuffer(n, np.int64).tolist(), doc_id, doc, s + k))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)

    windows = written(some.select("doc_id", "doc", "s", "context").mapInArrow(run, "n1 long, n2 long, doc_id long, doc long, s long"), "windows")
    first = windows.groupBy("n1", "n2").agg(F.min(F.struct("doc_id", "s")).alias("first"))
    hit = windows.join(first, ["n1", "n2"]).filter(F.struct("doc_id", "s") > F.col("first"))
    return hit.select("doc", "s", (F.col("s") + LEAST).alias("e"))


def kept_texts(docs: DataFrame, hits: DataFrame, text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs`` without the bytes of
    ``hits`` (doc, shard, s, e), and what is left (kept, binary) if ``text``."""
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    schema = pa.schema(fields + [("kept", pa.binary())] * text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans: list[tuple[int, int]] = []
        last = None
        for b in batches:
            rows = []
            for doc, kind, doc_id, s, e, x in zip(*(b.column(c).to_pylist() for c in ("doc", "kind", "doc_id", "s", "e", "text"))):
                if doc != last:
                    spans, last = [], doc
                if kind == 0:                                        # in order of s
                    if spans and s <= spans[-1][1]:
                        spans[-1] = (spans[-1][0], max(e, spans[-1][1]))
                    else:
                        spans.append((s, e))
                    continue
                sha, at, parts = hashlib.sha256(), 0, []
                for p, q in [*spans, (len(x), len(x))]:
                    sha.update(x[at:p])
                    if text:
                        parts.append(x[at:p])
                    at = q
                gone = sum(q - p for p, q in spans)
                rows.append((None if doc_id == LAST else doc_id, len(x), gone, len(spans), sha.hexdigest()) + (b"".join(parts),) * text)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    both = streamed(hits, docs, ["shard", "doc", "kind", "s"]).select("doc", "kind", "doc_id", "s", "e", "text")
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * text
    return both.mapInArrow(run, ddl)


def dedup(docs: DataFrame, text: bool = False, shard: int = SHARD, bucket: int = BUCKET, hot: int = HOT) -> DataFrame:
    """``kept_texts`` of ``docs`` (doc_id, text) without the bytes of repeated strings."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Some shards a partition, so that partitions are alike.
    shards = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // shard))
    body = F.coalesce("text", F.lit(""))
    name = F.xxhash64("doc_id", body)
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_id"), name.alias("doc"),
                       F.pmod(name, F.lit(shards)).cast("int").alias("shard"), body.cast("binary").alias("text"))
    made = written(contexts(docs, written(repeated_anchors(docs), "anchors")), "contexts")
    some = made.filter(~F.col("hit"))
    sizes = some.groupBy("anchor").agg(F.sum(F.octet_length("context")).alias("size"))
    frequent = written(sizes.filter(F.col("size") > hot).select("anchor"), "frequent")
    n = max(1, -(-(some.agg(F.sum(F.octet_length("context"))).first()[0] or 0) // bucket))
    even = some
    hits = made.filter("hit").select("doc", "s", "e")
    if not frequent.isEmpty():
        hits = hits.unionByName(hot_hits(some.join(frequent, "anchor", "left_semi")))
        even = some.join(frequent, "anchor", "left_anti")
    even = even.withColumn("bucket", F.pmod("anchor", F.lit(n))).select("bucket", "anchor", "shard", "doc_id", "doc", "s", "e", "context")
    hits = hits.unionByName(even.groupBy("bucket").applyInPandas(bucket_hits, "doc long, s long, e long"))
    hits = written(hits.withColumn("shard", F.pmod("doc", F.lit(shards)).cast("int")), "hits")
    return kept_texts(docs, hits, text)


def op12_repeated_text(spark, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"))


OP12_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
c AS (
  SELECT doc_id, unnest(list_transform(range(0, len(x) // 2, 500), lambda a: {'a': a, 'y': x[2 * a + 1 : 2 * a + 1198]}), recursive := true)
  FROM d),
w AS (
  SELECT doc_id, unnest(list_transform(range(0, greatest(len(y) // 2 - 99, 0)), lambda i: {'i': a + i, 'h': md5_number(y[2 * i + 1 : 2 * i + 200])}), recursive := true)
  FROM c),
f AS (SELECT h, min({'d': doc_id, 'i': i}) AS first FROM w GROUP BY h HAVING count(*) > 1),
hit AS (SELECT DISTINCT doc_id, i FROM w JOIN f USING (h) WHERE {'d': doc_id, 'i': i} > first),
mark AS (SELECT *, i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, -1) AS new FROM hit),
run AS (SELECT *, count(*) FILTER (WHERE new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM mark),
span AS (SELECT doc_id, min(i) AS s, max(i) + 100 AS e FROM run GROUP BY doc_id, k),
piece AS (SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS before FROM span),
gone AS (
  SELECT doc_id, sum(e - s) AS n, count(*) AS spans, max(e) AS last, string_agg(d.x[2 * before + 1 : 2 * s], '' ORDER BY s) AS kept
  FROM piece JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || x[2 * coalesce(last, 0) + 1 :])) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""
