"""Near-duplicate documents by consistent weighted sampling of TF-IDF shingles.

A text's set is its shingles of five words (a shorter text is one shingle),
weighted (1 + ln count) * idf, where idf falls from 1 + ``IDF`` for rare
shingles to 1 for one in every document:

    idf = 1 + IDF * ln(N / max(df, T)) / ln(N / T),   T = max(2, 2 * RARE * N)

N counts all documents, df those that hold the shingle. Only shingles with df
of T or more need a count of their own. Each task emits those that reach its
share of T among its own documents, which every such shingle must do in some
task; these candidates are counted exactly, over all documents, if they are many
after one more such look by larger tasks. At most
(shingles of a mean document) / (2 * RARE) can reach T, so the table is bounded.

Signatures are improved consistent weighted sampling (Ioffe 2010): two texts
agree in a sample with the probability of their weighted Jaccard similarity.
``BANDS`` bands of ``ROWS`` samples are buckets. Equal texts are one class
first. Pairs of a bucket that agree in ``MAYBE`` of the samples are candidates,
tried in two passes. First the pairs of a forest of the best agreements, and each
class's ``BEST`` best; large buckets are cut into salted blocks, of whose clusters
``BEST`` members each are compared by block pairs. Then the verified components
are contracted, and every other candidate between different components is tried,
by block pairs of all members. A candidate is verified by the exact weighted
Jaccard similarity of its shingles, and pairs of ``LEAST`` or more are the links;
their components are the near-duplicate classes. So each candidate is verified or
joins classes that other links join already; not every link is listed.

Null and empty texts are equal; texts without words are near nothing but their
copies. Repeated rows share a class. The class id is its smallest doc_id, null
if none has one.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_BYTES, Shared, fresh_name, table, written
from .components import components

WORDS = 5
LEAST = 0.8
ROWS, BANDS = 4, 10
MAYBE, BEST = 0.55, 3
IDF = 0.5
RARE = 0.001
BLOCK = 400                  # classes compared in one task
HELD_SHINGLES = 2_500_000    # of documents counted together by a task
BLOCK_DOCUMENTS = 2000       # that a task should count together, on average
COUNT_DOCUMENTS = 16_000   # documents of a counting task, on average: it emits a row for each candidate that it meets
BLOCK_TEXT = 1_000_000       # bytes of text hashed together
WANTED_BOUND = 2_000_000     # classes whose ids may be broadcast (16 bytes each)
HEAVY_BLOCK = 1_000_000      # candidates counted in one pass (8 bytes each)
BLOCK_BYTES = 16_000_000     # of features in a block, on average


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers, scattered."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashes of word shingles. Words are hashed without being cut out: a polynomial of a word's bytes
    is a difference of running sums over a block of texts, so a block costs a few passes of numpy."""

    def __init__(self):
        r = np.random.default_rng(11)
        lowered = np.frombuffer(WORD_BYTES, np.uint8)
        self.part = lowered != 32
        self.value = np.where(self.part, r.integers(1, 1 << 63, 256, np.uint64)[lowered], np.uint64(0))
        self.grow(BLOCK_TEXT)

    def grow(self, n: int) -> None:
        m = 0xD1342543DE82EF95
        self.power = np.cumprod(np.full(n + 1, np.uint64(m)))
        self.inverse = np.cumprod(np.full(n + 1, np.uint64(pow(m, -1, 1 << 64))))

    def words(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of a text's words, and where they start."""
        a = np.frombuffer(text, np.uint8)
        if len(a) > len(self.power):
            self.grow(len(a))
        edge = np.flatnonzero(np.diff(self.part[a], prepend=False, append=False))
        s, e = edge[::2], edge[1::2]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(self.value[a] * self.power[: len(a)])])
        return mixed((sums[e] - sums[s]) * self.inverse[s]), s

    def pieces(self, text: bytes) -> Iterator[bytes]:
        """A long text in parts that don't cut words."""
        at = 0
        while len(text) - at > BLOCK_TEXT:
            end = at + BLOCK_TEXT
            while end < len(text) and self.part[text[end]]:
                end += 1
            yield text[at:end]
            at = end
        yield text[at:]

    def __call__(self, text: str | bytes | None) -> np.ndarray:
        """Shingles in order of place, repeated ones too."""
        return next(self.many([text]))

    def many(self, texts: list[str | bytes | None]) -> Iterator[np.ndarray]:
        """Shingles of each text."""
        block: list[bytes] = []
        size = 0
        for t in texts:
            t = t.encode() if isinstance(t, str) else t or b""
            if block and size + len(t) > BLOCK_TEXT:
                yield from self.block(block)
                block, size = [], 0
            if len(t) > BLOCK_TEXT:
                yield self.shingles(np.concatenate([self.words(p)[0] for p in self.pieces(t)]))
                continue
            block.append(t)
            size += len(t) + 1
        yield from self.block(block)

    def block(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        if not texts:
            return
        w, s = self.words(b" ".join(texts))
        lens = np.array([len(t) + 1 for t in texts])
        cut = np.searchsorted(s, np.concatenate([[0], np.cumsum(lens)]))
        whole = self.shingles(w) if len(w) >= WORDS else None
        for x, y in zip(cut[:-1].tolist(), cut[1:].tolist()):
            yield whole[x : y - WORDS + 1] if y - x >= WORDS else self.shingles(w[x:y])

    @staticmethod
    def shingles(w: np.ndarray) -> np.ndarray:
        if not len(w):
            return np.zeros(0, np.uint64)
        n = max(1, len(w) - WORDS + 1)
        out = np.zeros(n, np.uint64)
        for i in range(min(WORDS, len(w))):
            out = (out ^ w[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(32)
        return mixed(out)


class Weights:
    """idf by shingle: the heavy ones' document counts, and what holds for all others."""

    def __init__(self, heavy: np.ndarray, df: np.ndarray, n: int, t: int):
        order = np.argsort(heavy)
        self.heavy, self.df = heavy[order], df[order]
        self.n, self.t = max(n, 1), t
        self.slot = np.zeros(1 << 22, bool)
        self.slot[(self.heavy & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def of(self, shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
        idf = np.full(len(shingles), 1.0 + IDF)
        if self.n <= self.t:
            idf[:] = 1.0
        elif len(self.heavy):
            maybe = np.flatnonzero(self.slot[(shingles & np.uint64((1 << 22) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.heavy, shingles[maybe]), len(self.heavy) - 1)
            hit = self.heavy[at] == shingles[maybe]
            idf[maybe[hit]] = 1 + IDF * np.log(self.n / self.df[at[hit]]) / np.log(self.n / self.t)
        return (1 + np.log(counts)) * idf


class Sampler:
    """Improved consistent weighted sampling; Gamma(2, 1) and uniform draws come
    from 16 bits each of a hash of the shingle and the sample's number."""

    def __init__(self, samples: int = ROWS * BANDS):
        p = (np.arange(1 << 16) + 0.5) / (1 << 16)
        lo, hi = np.zeros(1 << 16), np.full(1 << 16, 40.0)
        for _ in range(60):                               # the quantiles, by halving
            mid = (lo + hi) / 2
            below = 1 - (1 + mid) * np.exp(-mid) < p
            lo, hi = np.where(below, mid, lo), np.where(below, hi, mid)
        self.gamma = ((lo + hi) / 2).astype(np.float32)
        self.log_gamma = np.log(self.gamma)
        self.seeds = mixed(np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]

    def __call__(self, shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One 64-bit number a sample: the chosen shingle and level. shingles: sorted, distinct."""
        n = len(self.seeds)
        best, out = np.full(n, np.inf, np.float32), np.zeros(n, np.uint64)
        low, row = np.uint64(0xFFFF), np.arange(n)
        for at in range(0, len(shingles), 2048):
            s, lw = shingles[at : at + 2048], np.log(weights[at : at + 2048]).astype(np.float32)
            z = (s ^ self.seeds) * np.uint64(0xFF51AFD7ED558CCD)
            z ^= z >> np.uint64(29)
            z *= np.uint64(0xC4CEB9FE1A85EC53)
            r = self.gamma[z >> np.uint64(48)]
            u = ((z >> np.uint64(16)) & low).astype(np.float32) / np.float32(1 << 16)
            level = np.floor(lw / r + u)
            a = self.log_gamma[(z >> np.uint64(32)) & low] - r * (level - u + 1)
            k = a.argmin(1)
            least = a[row, k]
            new = least < best
            best[new] = least[new]
            out[new] = mixed(s[k[new]] ^ (level[row, k][new].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        return out


def node(text: str = "text") -> Column:
    """A 64-bit name of a text; equal texts have the same."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _block_shingles(docs: DataFrame, n: int, t: int) -> DataFrame:
    """Distinct shingles that reach their share of ``t`` in some block of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Shingler()
        held: list[np.ndarray] = []
        full: list[np.ndarray] = []
        size = 0

        def out(block):
            distinct, count = np.unique(np.concatenate(block), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(distinct[count > (t - 1) * len(block) // n].view(np.int64))], names=["s"])

        for b in batches:
            for s in cut.many(b.column(0).to_pylist()):
                held.append(np.unique(s))
                size += len(held[-1])
                if size > HELD_SHINGLES:
                    if full:
                        yield out(full)
                    full, held, size = held, [], 0
        # What is left is counted with the last full block: few documents by themselves would
        # have a share below one, and emit every shingle.
        if full or held:
            yield out(full + held)

    # The same holds for tasks of few documents.
    return docs.select("text").coalesce(max(1, n // BLOCK_DOCUMENTS)).mapInArrow(run, "s long").distinct()


def _document_counts(docs: DataFrame, wanted: np.ndarray, tasks: int, over: tuple[int, int] | None = None) -> DataFrame:
    """(s, df) of the shingles in a sorted array, counted in at most some tasks. With ``over`` (t, n),
    only those that reach their share of t in some task, with their counts in such tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, wanted = Shingler(), shared.value
        mask = np.uint64((1 << 24) - 1)
        slot = np.zeros(1 << 24, bool)
        slot[(wanted & mask).astype(np.int64)] = True
        df = np.zeros(len(wanted), np.int64)
        seen = 0
        for b in batches:
            seen += b.num_rows
            for s in cut.many(b.column(0).to_pylist()):
                s = np.unique(s[slot[(s & mask).astype(np.int64)]])
                at = np.minimum(np.searchsorted(wanted, s), len(wanted) - 1)
                df[at[wanted[at] == s]] += 1
        some = np.flatnonzero(df > ((over[0] - 1) * seen // over[1] if over else 0))
        for k in range(0, len(some), 100_000):
            i = some[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(wanted[i].view(np.int64)), pa.array(df[i])], names=["s", "n"])

    return docs.select("text").coalesce(tasks).mapInArrow(run, "s long, n long").groupBy("s").agg(F.sum("n").alias("df"))


def _passes(found: DataFrame) -> Iterator[np.ndarray]:
    """The shingles of ``found`` (s) in sorted arrays of HEAVY_BLOCK or so numbers of 8 bytes."""
    passes = max(1, -(-found.count() // HEAVY_BLOCK))
    for k in range(passes):
        part = found.filter(F.pmod(F.xxhash64("s"), F.lit(passes)) == k) if passes > 1 else found
        wanted = np.sort(part.toArrow().column("s").to_numpy().view(np.uint64))    # as Arrow buffers
        if len(wanted):
            yield wanted


def weigh(docs: DataFrame) -> Weights:
    """The corpus statistics of the shingles of ``docs`` (text)."""
    n = docs.count()
    t = max(2, int(2 * RARE * n))
    if not n:
        return Weights(np.zeros(0, np.uint64), np.zeros(0, np.int64), 0, t)
    found = written(_block_shingles(docs, n, t), "candidates")
    tasks = max(1, n // COUNT_DOCUMENTS)
    if found.count() > n // 2:
        # Many are frequent in a block only. What reaches T reaches its share in some counting task too,
        # whose documents are more: the others are never sent on.
        parts = [written(_document_counts(docs, wanted, tasks, (t, n)).select("s"), "narrowed") for wanted in _passes(found)]
        found = reduce(DataFrame.union, parts)
    heavy: list[tuple[int, int]] = []
    for wanted in _passes(found):
        heavy += [(r.s, r.df) for r in _document_counts(docs, wanted, tasks).filter(F.col("df") >= t).collect()]
    both = np.array(heavy, np.int64).reshape(-1, 2)
    return Weights(both[:, 0].copy().view(np.uint64), both[:, 1], n, t)


def signatures(docs: DataFrame, weights: Weights) -> DataFrame:
    """(doc_id, node, sig, bands) of every document; sig and bands are null for texts without words."""
    shared = Shared(docs.sparkSession, weights)
    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("sig", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, sample, weights = Shingler(), Sampler(), shared.value
        number = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        last: dict[int, tuple] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                b = whole.slice(at, 2000)
                ids, nodes, texts = (c.to_pylist() for c in b.columns)
                if len(last) > 20_000:
                    last.clear()
                new = {k: x for k, x in zip(nodes, texts) if k not in last}
                for k, shingles in zip(new, cut.many(list(new.values()))):
                    s, c = np.unique(shingles, return_counts=True)
                    got = (None, None)
                    if len(s):
                        z = sample(s, weights.of(s, c))
                        key = number.copy()
                        for i in range(ROWS):
                            key = mixed(key ^ z.reshape(BANDS, ROWS)[:, i])
                        got = ((z & np.uint64(0xFFFF)).astype("<u2").tobytes(), key.view(np.int64))
                    last[k] = got
                rows = [(d, k, *last[k]) for d, k in zip(ids, nodes)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), node().alias("node"), "text").mapInArrow(run, "doc_id long, node long, sig binary, bands array<long>")


def agreement(sigs: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Share of equal samples of every two signatures."""
    same = np.zeros((len(sigs), len(others)), np.uint8)
    for i in range(sigs.shape[1]):
        same += sigs[:, i][:, None] == others[:, i][None, :]
    return same / np.float32(sigs.shape[1])


def joined(root: np.ndarray, edges: list[tuple[int, int]]) -> np.ndarray:
    """Components (each the smallest index) after some edges between components."""
    up = root.copy()

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for x, y in edges:
        x, y = find(x), find(y)
        up[max(x, y)] = min(x, y)
    return np.array([find(i) for i in range(len(up))])


def bucket_pairs(nodes: np.ndarray, sigs: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Pairs to verify among the classes of a block, and its clusters (smallest
    indices). The pairs are a forest of the best agreements (of every group that
    isn't joined yet, its best pair with another, again and again) and each
    class's ``BEST`` best, so they grow with the classes, not with their square."""
    est = agreement(sigs, sigs)
    np.fill_diagonal(est, 0)
    est[est < MAYBE] = 0
    m = len(nodes)
    root, clusters, pairs = np.arange(m), np.arange(m), set()
    while True:
        out = np.where(root[:, None] != root[None, :], est, 0)
        best = out.argmax(1)
        value = out[np.arange(m), best]
        order = np.lexsort((-value, root))
        first = order[np.concatenate([[True], root[order][1:] != root[order][:-1]])]
        first = first[value[first] > 0]
        if not len(first):
            break
        edges = list(zip(first.tolist(), best[first].tolist()))
        pairs.update((min(e), max(e)) for e in edges)
        root = joined(root, edges)
        clusters = joined(clusters, [e for e in edges if est[e] >= LEAST])
    k = min(BEST, m - 1)
    for i, js in enumerate(np.argpartition(-est, k - 1, 1)[:, :k].tolist() if k else []):
        pairs.update((min(i, j), max(i, j)) for j in js if est[i, j] > 0)
    return [(int(nodes[x]), int(nodes[y])) for x, y in pairs], clusters


def candidate_pairs(classes: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of ``classes`` (node, sig, bands) that may be near."""
    entries = classes.select("node", "sig", F.explode("bands").alias("key"))
    shared = written(entries.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "buckets")
    g = F.ceil(F.col("size") / BLOCK).cast("int")
    blocks = entries.join(shared, "key").withColumn("g", g).withColumn("mine", F.pmod(F.xxhash64("node", "key"), F.col("g")).cast("int"))

    schema = pa.schema([("leads", pa.bool_()), *((c, pa.int64()) for c in ("a", "b", "key")), ("mine", pa.int32()), ("g", pa.int32()), ("sig", pa.binary())])

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks come in order; those of two, nearly all, are compared in one step."""
        def rows(leads, a, b, key, mine, g, sig):
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((leads, a, b, key, mine, g, sig), schema)], schema=schema)

        def answer(t: pa.Table) -> Iterator[pa.RecordBatch]:
            key, mine, g, node = (t.column(c).to_numpy() for c in ("key", "mine", "g", "node"))
            sigs = np.frombuffer(b"".join(t.column("sig").to_pylist()), "<u2").reshape(len(key), -1)
            edge = np.append(np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (mine[1:] != mine[:-1])])), len(key))
            size = np.diff(edge)
            two = edge[:-1][(size == 2) & (g[edge[:-1]] == 1)]
            two = two[(sigs[two] == sigs[two + 1]).mean(1) >= MAYBE]
            pairs = [np.stack([node[two], node[two + 1]], 1)]
            many = (size > 2) | (g[edge[:-1]] > 1)
            for x, y in zip(edge[:-1][many].tolist(), edge[1:][many].tolist()):
                found, root = bucket_pairs(node[x:y], sigs[x:y])
                pairs.append(np.array(found, np.int64).reshape(-1, 2))
                if g[x] > 1:                              # some of every cluster meet other blocks
                    order = np.argsort(root, kind="stable")
                    place = np.arange(len(order)) - np.searchsorted(root[order], root[order])
                    i = x + order[place < BEST]
                    m = len(i)
                    yield rows([True] * m, node[i], np.zeros(m, np.int64), key[i], mine[i], g[i], [sigs[k].tobytes() for k in i])
            both = np.concatenate(pairs)
            zero = np.zeros(len(both), np.int64)
            yield rows([False] * len(both), both.min(1), both.max(1), zero, zero, zero, [b""] * len(both))

        held: pa.Table | None = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            if len(held) < 20_000:
                continue
            key, mine = (held.column(c).to_numpy() for c in ("key", "mine"))
            last = np.flatnonzero((key != key[-1]) | (mine != mine[-1]))
            if len(last):                                 # the last block may go on
                yield from answer(held.slice(0, last[-1] + 1).combine_chunks())
                held = held.slice(last[-1] + 1)
        if held is not None and len(held):
            yield from answer(held.combine_chunks())

    def across(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        x, y = df[df.mine == key[1]], df[df.mine == key[2]]
        if not len(x) or not len(y):
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        est = agreement(*(np.stack([np.frombuffer(s, "<u2") for s in d.sig]) for d in (x, y)))
        best = est >= np.maximum(MAYBE, np.minimum(est.max(0)[None, :], est.max(1)[:, None]))
        i, j = np.nonzero(best)
        a, b = x.a.to_numpy(np.int64)[i], y.a.to_numpy(np.int64)[j]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    # A block of one member has no pairs, but its member may lead it to other blocks.
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt_out = blocks.select("key", "mine", "g", "node", "sig").repartition(n, "key", "mine").sortWithinPartitions("key", "mine", "node")
    got = written(dealt_out.mapInArrow(inside, "leads boolean, a long, b long, key long, mine int, g int, sig binary"), "clusters")
    leaders = (got.filter("leads").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
               .filter("other <> mine").select("a", "key", "mine", "sig", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")))
    met = leaders.groupBy("key", "i", "j").applyInPandas(across, "a long, b long")
    return written(got.filter("not leads").select("a", "b").union(met).distinct(), "pairs")


def checked(small: DataFrame, bound: int = WANTED_BOUND) -> DataFrame:
    """``small`` marked for broadcast if it has no more than ``bound`` rows (of two numbers)."""
    return F.broadcast(small) if small.count() <= bound else small


def features(docs: DataFrame, wanted: DataFrame, weights: Weights) -> DataFrame:
    """(node, shingles, weights) of the classes in ``wanted`` (node, first: the id of one of its documents)."""
    shared = Shared(docs.sparkSession, weights)
    rows = docs.select(F.col("doc_id").cast("long").alias("first"), node().alias("node"), "text").join(checked(wanted), ["node", "first"])
    schema = pa.schema([("node", pa.int64()), ("s", pa.binary()), ("w", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, weights = Shingler(), shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                made = []
                names, texts = (c.to_pylist() for c in whole.slice(at, 500).columns)
                for name, shingles in zip(names, cut.many(texts)):
                    s, c = np.unique(shingles, return_counts=True)
                    # 32 bits tell the shingles of two texts apart well enough.
                    made.append((name, (s >> np.uint64(32)).astype("<u4").tobytes(), weights.of(s, c).astype("<f4").tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), schema)], schema=schema)

    # Repeated rows made the same features: one of each.
    return written(rows.select("node", "text").mapInArrow(run, "node long, s binary, w binary")
                   .groupBy("node").agg(F.min("s").alias("s"), F.min("w").alias("w")), "features")


def similarity(a: tuple[bytes, bytes], b: tuple[bytes, bytes]) -> float:
    """Weighted Jaccard similarity of two (shingles, weights)."""
    sa, wa, sb, wb = (np.frombuffer(x, k) for x, k in zip((*a, *b), ("<u4", "<f4", "<u4", "<f4")))
    at = np.minimum(np.searchsorted(sb, sa), len(sb) - 1)
    hit = sb[at] == sa
    both = float(np.minimum(wa[hit], wb[at[hit]]).sum(dtype=float))
    return both / (float(wa.sum(dtype=float)) + float(wb.sum(dtype=float)) - both)


def verified(pairs: DataFrame, feats: DataFrame) -> DataFrame:
    """(a, b, similarity) of all ``pairs``."""
    one = pairs.join(feats.select(F.col("node").alias("a"), F.col("s").alias("sa"), F.col("w").alias("wa")), "a")
    two = one.join(feats.select(F.col("node").alias("b"), F.col("s").alias("sb"), F.col("w").alias("wb")), "b")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("similarity", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                t = whole.slice(at, 500)
                sim = [similarity((sa, wa), (sb, wb)) for sa, wa, sb, wb in zip(*(t.column(c).to_pylist() for c in ("sa", "wa", "sb", "wb")))]
                yield pa.RecordBatch.from_arrays([t.column("a"), t.column("b"), pa.array(sim)], schema=schema)

    return two.select("a", "b", "sa", "wa", "sb", "wb").mapInArrow(run, "a long, b long, similarity double")


def untried(a: pd.DataFrame, b: pd.DataFrame, at: int) -> np.ndarray:
    """Which classes of a and b are candidates of table ``at``: they agree in ``MAYBE``
    of the samples, are in different components and share no earlier table."""
    est = agreement(*(np.stack([np.frombuffer(s, "<u2") for s in d.sig]) for d in (a, b)))
    pairs = (est >= MAYBE) & (a.component.to_numpy(np.int64)[:, None] != b.component.to_numpy(np.int64)[None, :])
    x, y = np.stack(a.bands.to_list()), np.stack(b.bands.to_list())
    for k in range(at):
        pairs &= x[:, k][:, None] != y[:, k][None, :]
    return pairs


def dealt(entries: DataFrame) -> DataFrame:
    """``entries`` (key, component, node, share: of a block's room) in block pairs (i, j)
    of their bucket. All meet all, but those of its largest component not each other."""
    count = entries.groupBy("key", "component").agg(F.count("*").alias("m"), F.sum("share").alias("load"))
    sizes = count.groupBy("key").agg(F.sum("m").alias("size"), F.count("*").alias("parts"), F.sum("load").alias("load"),
                                     F.max(F.struct("m", "component", "load")).alias("top"))
    whole = F.col("load") <= 1
    sizes = written(sizes.filter("parts > 1").select(
        "key", "size", F.col("top.component").alias("top"),
        F.when(whole, 1).otherwise(F.ceil(F.col("load") - F.col("top.load") + 1e-9)).cast("int").alias("rest"),
        F.when(whole, 0).otherwise(F.ceil(F.col("top.load"))).cast("int").alias("big")), "sizes")
    is_top = (F.col("component") == F.col("top")) & (F.col("big") > 0)
    salt = F.xxhash64("node", "key")
    mine = F.when(is_top, F.col("rest") + F.pmod(salt, F.greatest("big", F.lit(1)))).otherwise(F.pmod(salt, F.col("rest"))).cast("int")
    last = F.when(is_top, F.col("rest")).otherwise(F.col("rest") + F.col("big")) - 1
    return (entries.join(sizes, "key").withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
            .withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other")).drop("share", "other", "top", "rest", "big"))


def exact_links(a: pd.DataFrame, b: pd.DataFrame | None, at: int, least: float) -> list[tuple[int, int]]:
    """Links that join the components of all candidates of a and b (else of a) that are near enough."""
    both = a if b is None else pd.concat([a, b])
    lo = 0 if b is None else len(a)
    pairs = untried(a, a if b is None else b, at)
    nodes = both.node.to_numpy(np.int64)
    _, root = np.unique(both.component.to_numpy(np.int64), return_inverse=True)
    shingles = [np.frombuffer(x, "<u4") for x in both.s]
    weights = [np.frombuffer(x, "<f4") for x in both.w]
    names, place = np.unique(np.concatenate(shingles), return_inverse=True)
    place = np.split(place, np.cumsum([len(x) for x in shingles])[:-1])
    total = np.array([x.sum(dtype=float) for x in weights])
    dense = np.zeros(len(names), np.float32)
    found = []
    for x in np.argsort(-pairs.sum(1), kind="stable"):
        ys = np.flatnonzero(pairs[x]) + lo
        ys = ys[root[ys] != root[x]]
        if not len(ys):
            continue
        dense[place[x]] = weights[x]
        held = [np.minimum(dense[place[y]], weights[y]).sum(dtype=float) for y in ys]
        dense[place[x]] = 0
        for y in ys[np.array(held) / (total[x] + total[ys] - held) >= least]:
            if root[y] != root[x]:
                found.append((int(nodes[x]), int(nodes[y])))
                root[root == root[y]] = root[x]
    return found


def links_of_the_rest(docs: DataFrame, classes: DataFrame, links: DataFrame, feats: DataFrame, weights: Weights, least: float) -> DataFrame | None:
    """(a, b) that join the components of ``links`` over all candidates that aren't tried yet."""
    entries = classes.select("node", "first", "sig", "bands", F.posexplode("bands").alias("at", "key"))
    # A smaller bucket's pairs are all among each class's best.
    large = written(entries.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > BEST + 1).select("key"), "large")
    if large.isEmpty():
        return None
    some = entries.join(large, "key").join(components(links), "node", "left").withColumn("component", F.coalesce("component", "node"))
    some = written(some.withColumn("share", F.lit(1 / BLOCK)), "entries")

    def left(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("node")
        a, b = df[df.mine == key[1]], df[df.mine == key[2]]
        if not len(a) or not len(b):
            return pd.DataFrame({"key": [], "node": []}).astype("int64")
        pairs = untried(a, b, int(df["at"].iloc[0]))
        if len(df) == df["size"].iloc[0] and len(df) <= BLOCK and pairs.any():  # the block of the first pass
            nodes = df.node.to_numpy(np.int64)
            tried, _ = bucket_pairs(nodes, np.stack([np.frombuffer(s, "<u2") for s in df.sig]))
            for x, y in np.searchsorted(nodes, np.array(tried, np.int64).reshape(-1, 2)):
                pairs[x, y] = pairs[y, x] = False
        hit = np.concatenate([a.node[pairs.any(1)], b.node[pairs.any(0)]]).astype(np.int64)
        return pd.DataFrame({"key": np.full(len(hit), key[0], np.int64), "node": hit})

    wide = dealt(some).select("key", "i", "j", "mine", "size", "at", "node", "component", "sig", "bands")
    needed = written(wide.groupBy("key", "i", "j").applyInPandas(left, "key long, node long").distinct(), "untried")
    if needed.isEmpty():
        return None
    more = written(needed.select("node").distinct().join(feats.select("node"), "node", "left_anti")
                   .join(classes.select("node", "first"), "node"), "wanted")
    if not more.isEmpty():
        feats = feats.unionByName(features(docs, more, weights))
    load = feats.select("node", F.greatest(F.lit(1 / BLOCK), (F.length("s") + F.length("w")) / BLOCK_BYTES).alias("share"))
    full = dealt(some.drop("share", "first").join(needed, ["key", "node"]).join(load, "node")).join(feats, "node")

    def verify(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        a, b = df[df.mine == key[1]], df[df.mine == key[2]]
        alone = key[1] == key[2]
        found = exact_links(a, None if alone else b, int(df["at"].iloc[0]), least) if len(a) and len(b) else []
        return pd.DataFrame({"a": [x for x, _ in found], "b": [y for _, y in found]}).astype("int64")

    return written(full.select("key", "i", "j", "mine", "at", "node", "component", "sig", "bands", "s", "w")
                   .groupBy("key", "i", "j").applyInPandas(verify, "a long, b long"), "links")


def near_duplicates(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """(doc_id, node, class_id, kept) of every row of ``docs`` (doc_id, text)."""
    weights = weigh(docs)
    signed = written(signatures(docs, weights), "signatures")
    classes = written(signed.groupBy("node").agg(F.min("doc_id").alias("first"), F.min("sig").alias("sig"), F.min("bands").alias("bands")), "classes")
    worded = classes.filter(F.col("sig").isNotNull() & F.col("first").isNotNull())
    pairs = candidate_pairs(worded)
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = written(ends.join(classes.select("node", "first"), "node"), "wanted")
    feats = features(docs, wanted, weights)
    links = written(verified(pairs, feats).filter(F.col("similarity") >= least).select("a", "b"), "links")
    rest = links_of_the_rest(docs, worded, links, feats, weights, least)
    comp = components(links if rest is None else links.union(rest))
    named = classes.select("node", "first").join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = written(named, "named")
    ids = written(named.groupBy("component").agg(F.min("first").alias("class_id")), "class_ids")
    by_node = written(named.join(ids, "component").select("node", "class_id"), "by_node")
    return (signed.select("doc_id", "node").join(by_node, "node", "left")
            .select("doc_id", "node", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept")))


def one_of_each(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """``docs`` with one document of each class, the one with the smallest id
    (of rows that repeat its id and text, one)."""
    found = written(near_duplicates(docs, least), "classes")
    name = fresh_name(docs, "node")
    ids = found.groupBy("doc_id", "node", "kept").agg(F.count("*").alias("n"))
    gone = checked(written(ids.filter(~F.col("kept")).select(F.col("doc_id").alias("gone"), "node"), "gone"))
    again = written(ids.filter(F.col("kept") & (F.col("n") > 1)).select(F.col("doc_id").alias("again"), "node"), "again")
    named = docs.withColumn(name, node())
    left = named.join(gone, (named[name] == gone["node"]) & named["doc_id"].cast("long").eqNullSafe(gone["gone"]), "left_anti")
    if not again.isEmpty():
        again = checked(again)
        on = (left[name] == again["node"]) & left["doc_id"].cast("long").eqNullSafe(again["again"])
        left = left.join(again, on, "left_anti").unionByName(left.join(again, on, "left_semi").dropDuplicates(["doc_id", name]))
    return left.drop(name)


def op6_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("node")
