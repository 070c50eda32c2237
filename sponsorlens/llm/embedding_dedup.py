"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

A rotation of the principal axes is learned (ITQ: it alternates between the
nearest binary codes and the rotation nearest to them) on a bounded sample, from
several starts. The sample is thinned first: a cell of near vectors counts no more
than ``CELL`` of it, so that a large group draws no axis or threshold to itself.
Each bit's threshold is near the median of the thinned sample, where few vectors of
the whole one are, so codes are about balanced and groups keep their bits. Every
vector is encoded. The codes are cut into substrings of
``TABLE_BITS`` bits, each a hash table: vectors of a label that share a whole
substring are candidates, and are reranked by the cosine of their original
vectors in double precision.

Equal vectors are one class first. A bucket is cut into blocks of about
``BLOCK`` classes, and each pair of blocks is one matrix product in one task; a
pair of classes counts only in the first table where it meets. The tasks return
a number of links for each class and a spanning forest, never the pairs.
Missed links are those whose codes share no substring; tests measure the recall.

Vectors that are null, empty, zero or hold null or non-finite numbers, and those
without a label, link with nothing. Vectors of different lengths don't either.
Rows that repeat an id count as vectors of their own; a null id comes last.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, written
from .components import components

LEAST_COSINE = 0.98
SAMPLE = 5000
ITQ_ROUNDS = 40
TABLE_BITS = 16
TABLES = 12
BLOCK = 1024
CELL, CELL_COSINE = 0.005, 0.95


def thinned(x: np.ndarray) -> np.ndarray:
    """Of the vectors within ``CELL_COSINE`` of one that comes first, a share of ``CELL`` of all at most."""
    most = max(1, int(CELL * len(x)))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    free, kept = np.ones(len(x), bool), []
    for i in range(len(x)):
        if free[i]:
            cell = np.flatnonzero(free & (unit @ unit[i] >= CELL_COSINE))
            free[cell] = False
            free[i] = False
            kept.append(cell[:most] if len(cell) else [i])
    return x[np.sort(np.concatenate(kept))] if kept else x


def sparse_middle(few: np.ndarray, all_: np.ndarray, reach: float) -> float:
    """A number near the median of ``few`` with few of ``all_`` within ``reach``."""
    at = np.quantile(few, np.linspace(0.3, 0.7, 41))
    at = np.concatenate([at, (at[1:] + at[:-1]) / 2])
    all_ = np.sort(all_)
    about = (np.searchsorted(all_, at + reach) - np.searchsorted(all_, at - reach)) / len(all_)
    few = np.sort(few)
    return float(at[np.argmin(about + 0.5 * np.abs(np.searchsorted(few, at) / len(few) - 0.5))])


class Quantiser:
    """Balanced binary codes of vectors of one length."""

    def __init__(self, sample: np.ndarray, seed: int):
        d = sample.shape[1]
        few = thinned(sample)
        self.mean = few.mean(0)
        x = few - self.mean
        axes = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, : min(d, 64)]
        r = np.linalg.qr(np.random.default_rng(seed).standard_normal((axes.shape[1],) * 2))[0]
        v = x @ axes
        for _ in range(ITQ_ROUNDS):
            u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
            r = (u @ w).T
        self.turn = axes @ r
        spread = (sample - self.mean) @ self.turn
        self.middle = np.array([sparse_middle(a, b, 0.25 / np.sqrt(d)) for a, b in zip((x @ self.turn).T, spread.T)])

    def keys(self, x: np.ndarray) -> np.ndarray:
        """The codes' substrings, one column a table."""
        bits = ((x - self.mean) @ self.turn >= self.middle).astype(np.int64)
        width = min(TABLE_BITS, bits.shape[1])
        n = bits.shape[1] // width
        return bits[:, : n * width].reshape(len(x), n, width) @ (1 << np.arange(width))


class Tables:
    """Enough quantisers for ``TABLES`` substrings, for each vector length of the sample."""

    def __init__(self, sample: list[np.ndarray]):
        by_length: dict[int, list] = {}
        for x in sample:
            by_length.setdefault(len(x), []).append(x)
        self.of = {d: self.made(np.stack(xs)) for d, xs in by_length.items()}

    @staticmethod
    def made(xs: np.ndarray) -> list[Quantiser]:
        per = max(1, min(xs.shape[1], 64) // TABLE_BITS)
        return [Quantiser(xs, seed) for seed in range(-(-TABLES // per))]

    def keys(self, x: np.ndarray) -> np.ndarray:
        if x.shape[1] not in self.of:                     # a length that the sample hasn't: axes of noise
            self.of[x.shape[1]] = self.made(np.random.default_rng(x.shape[1]).standard_normal((max(100, 2 * x.shape[1]), x.shape[1])))
        return np.concatenate([q.keys(x) for q in self.of[x.shape[1]]], 1)


def usable(x: list | None) -> np.ndarray | None:
    """The vector scaled to length 1, or None."""
    if not x or any(v is None for v in x):
        return None
    v = np.array(x, np.float64)
    top = np.abs(v).max()
    if not np.isfinite(v).all() or top == 0:
        return None
    v = v / top
    return v / np.sqrt(v @ v)


def block_links(a: pd.DataFrame, b: pd.DataFrame | None, at: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of the classes of a (and b, else a with itself) that meet in table ``at``
    first: by class, how many vectors; by class, its component's smallest index."""
    both = a if b is None else pd.concat([a, b])
    n, m = len(a), len(both)
    x = np.stack([np.frombuffer(v) for v in both.vec])
    keys = np.stack(both["keys"].to_list())
    size = both.n.to_numpy(np.int64)
    lo = 0 if b is None else n
    near = x[:n] @ x[lo:].T >= least
    for k in range(at):
        near &= keys[:n, k][:, None] != keys[lo:, k][None, :]
    if b is None:
        np.fill_diagonal(near, False)
    links = np.zeros(m, np.int64)
    links[:n] += near @ size[lo:]
    if b is not None:
        links[n:] += near.T @ size[:n]
    root = np.arange(m)
    i, j = np.nonzero(near)
    j = j + lo
    while len(i):
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return links, root, both.rep.to_numpy(np.int64)


def link(vectors: DataFrame, least: float = LEAST_COSINE, sample: int = SAMPLE, vec_id: str = "vec_id",
         embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors``."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("x"),
                          F.col(label).cast("string").alias("label"))
    some = (rows.filter(F.col("x").isNotNull()).select("x", F.xxhash64("vec_id", "x").alias("h")).orderBy("h").limit(sample).collect())
    found = [v for v in (usable(r["x"]) for r in some) if v is not None]
    tables = Tables(found)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("dim", pa.int32()), ("own", pa.binary()),
                            ("keys", pa.list_(pa.int64())), ("vec", pa.binary())])
        for whole in batches:
            for at in range(0, whole.num_rows, 4000):
                b = whole.slice(at, 4000)
                ids, raw, labels = (c.to_pylist() for c in b.columns)
                vs = [usable(x) if y is not None else None for x, y in zip(raw, labels)]
                keys: list = [None] * len(vs)
                for d in {len(v) for v in vs if v is not None}:
                    which = [i for i, v in enumerate(vs) if v is not None and len(v) == d]
                    for i, k in zip(which, tables.keys(np.stack([vs[i] for i in which]))):
                        keys[i] = k
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array([None if v is None else len(v) for v in vs], pa.int32()),
                    pa.array([None if v is None else hashlib.blake2b((v + 0.0).tobytes(), digest_size=16).digest() for v in vs], pa.binary()),
                    pa.array(keys, schema.field(4).type), pa.array([None if v is None else v.tobytes() for v in vs], pa.binary())], schema=schema)

    coded = written(rows.mapInArrow(encode, "vec_id long, label string, dim int, own binary, keys array<long>, vec binary"), "codes")
    live = coded.filter(F.col("own").isNotNull())
    cls = ["label", "dim", "own"]
    # A class without any id can't be named as a component; its rows stand alone.
    classes = written(live.groupBy(*cls).agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.min("keys").alias("keys"), F.min("vec").alias("vec")), "classes")
    named = classes.filter(F.col("rep").isNotNull())
    bucket = ["label", "dim", "at", "key"]
    entries = named.select("rep", "own", "label", "dim", F.posexplode("keys").alias("at", "key"))
    shared = written(entries.groupBy(*bucket).agg(F.count("*").alias("size")).filter("size > 1"), "buckets")
    g = F.ceil(F.col("size") / BLOCK).cast("int")
    blocks = (entries.join(shared, bucket).withColumn("g", g).withColumn("mine", F.pmod(F.xxhash64("own"), F.col("g")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
              .select("rep", "own", *bucket, "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")))
    full = blocks.join(named.select("label", "dim", "own", "n", "keys", "vec"), cls)

    def rerank(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        at, i, j = int(key[2]), int(key[4]), int(key[5])
        # Blocks of their own size: a chunk against itself and the ones after it.
        left = df[df.mine == i]
        right = None if i == j else df[df.mine == j]
        if not len(left) or (right is not None and not len(right)) or len(df) < 2:
            return pd.DataFrame({"rep": [], "to": [], "links": []}).astype("int64")
        links, root, rep = block_links(left, right, at, least)
        hit = links > 0
        return pd.DataFrame({"rep": rep[hit], "to": rep[root[hit]], "links": links[hit]})

    met = written(full.groupBy(*bucket, "i", "j").applyInPandas(rerank, "rep long, to long, links long"), "links")
    links = met.groupBy("rep").agg(F.sum("links").alias("links"))
    comp = components(met.select(F.col("rep").alias("a"), F.col("to").alias("b")))
    joined = classes.select(*cls, "rep", "n").join(links, "rep", "left").join(
        comp.select(F.col("node").alias("rep"), "component"), "rep", "left")
    by_class = written(joined.select(*cls, (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                                     F.coalesce("component", "rep").alias("component_id")), "by_class")
    linked = live.select("vec_id", *cls).join(by_class, cls).select("vec_id", "n_links", "component_id")
    alone = coded.filter(F.col("own").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op10_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "embeddings"))
