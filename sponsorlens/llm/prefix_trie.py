"""Prefix trie of conversations, as balanced parentheses per shard.

A node is a distinct sequence of first turns; its name is its depth and the
exclusive or of 128 bits hashed from each turn's place, role and text, so a
prefix's name is a running aggregate that long conversations share out among
tasks. Conversations that are equal are one path. Nodes on one path only are the
path's tail: their figures are running sums, and a shard holds the whole tail as
one leaf with its summed savings. Nodes on several paths are the path's head.

Heads are sorted as byte strings, which is the order of a depth-first walk, and
dealt by ranges, each a shard. A shard writes its walk as parentheses and keeps
the running excess with the least and greatest of each block and a tree over
them; findclose of all opening brackets then delimits their subtrees, ranks of
"()" at both ends count leaves, and differences of cumulative arrays give the
savings. Nodes on a shard's first or last path, its spine, may have parts in
other shards: their parts are added up, and the spines themselves make a small
trie of the same kind, (2 x shards) paths, in one task.

Null role or text become empty. Rows without conv_id belong to no conversation
and are left out. Equal turn numbers of a conversation follow the hashes of
their role and text, and repeated rows are turns of their own. An empty table has no nodes.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written
from .ranks import ranked

EVERY, HEAD = 20, 4                 # base conversations; heads are shorter than HEAD turns
CHUNK = 1024                        # turns of a conversation that are summed in one window
IDS = 4096                          # conversation ids in a chunk of a hashed list
BLOCK = 256                         # brackets in a block of the excess
WORDS = r"[^\x20\x09-\x0D]+"
NONE = hashlib.sha256(b"").hexdigest()


def closes(bits: np.ndarray) -> np.ndarray:
    """findclose of every opening bracket (1) of a balanced row of brackets, by place.

    A bracket's partner is the first place after it where the excess is one less
    than at it. It is looked for in the bracket's block, then in a tree of the
    blocks' least excesses (up to the first right neighbour that goes as low, and
    down to the block), then in that block.
    """
    n = len(bits)
    excess = np.cumsum(np.where(bits, 1, -1))
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
    padded[:n] = excess
    grid = padded.reshape(blocks, BLOCK)
    opens = np.flatnonzero(bits)
    goal = excess[opens] - 1
    found = np.full(len(opens), -1)
    places = np.arange(BLOCK)

    def inside(which: np.ndarray, block: np.ndarray, after: np.ndarray) -> None:
        """First place of the goal in a block, beyond ``after``."""
        for at in range(0, len(which), 4096):
            w, b = which[at : at + 4096], block[at : at + 4096]
            hit = (grid[b] <= goal[w][:, None]) & (places > after[at : at + 4096][:, None])
            some = hit.any(1)
            found[w[some]] = b[some] * BLOCK + hit[some].argmax(1)

    inside(np.arange(len(opens)), opens // BLOCK, opens % BLOCK)
    left = np.flatnonzero(found < 0)
    if len(left):
        size = 1 << int(blocks - 1).bit_length()
        least = np.full(2 * size, np.iinfo(np.int64).max)
        least[size : size + blocks] = grid.min(1)
        for level in range(size.bit_length() - 1):                  # the tree, from the blocks up
            lo = size >> (level + 1)
            least[lo : 2 * lo] = np.minimum(least[2 * lo : 4 * lo : 2], least[2 * lo + 1 : 4 * lo : 2])
        node = opens[left] // BLOCK + size
        moving = np.arange(len(left))
        while len(moving):                                           # up, to a right neighbour that goes as low
            x = node[moving]
            right = (x % 2 == 0) & (least[np.minimum(x + 1, 2 * size - 1)] <= goal[left[moving]])
            node[moving] = np.where(right, x + 1, x // 2)
            moving = moving[~right]
        while (inner := np.flatnonzero(node < size)).size:           # down, to its first block
            x = node[inner] * 2
            node[inner] = np.where(least[x] <= goal[left[inner]], x, x + 1)
        inside(left, node - size, np.full(len(left), -1))
    out = np.full(n, -1)
    out[opens] = found
    return out


class Trie:
    """Subtrees of a tree whose nodes come in depth-first order with their depths.
    ``leaf`` tells which childless nodes are leaves (others go on elsewhere)."""

    def __init__(self, depths: np.ndarray, leaf: np.ndarray):
        n = len(depths)
        ups = np.append(depths[:-1] - depths[1:], depths[-1:] - depths[:1]) + 1     # brackets closed after each node
        self.opens = np.arange(n) + np.cumsum(ups) - ups
        self.bits = np.zeros(2 * n, bool)
        self.bits[self.opens] = True
        self.close = closes(self.bits)[self.opens]
        rank = np.concatenate([[0], np.cumsum(self.bits)])           # opening brackets before a place
        self.first, self.end = np.arange(n), rank[self.close]        # nodes of the subtree: first to end - 1
        pair = np.append(self.bits[:-1] & ~self.bits[1:], False)
        pair[self.opens] &= leaf
        self.pairs = np.concatenate([[0], np.cumsum(pair)])          # "()" that open before a place

    def leaves(self) -> np.ndarray:
        """Leaves of each subtree, by ranks of "()"."""
        return self.pairs[self.close] - self.pairs[self.opens]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum of each subtree's values, by differences of their cumulative array."""
        up = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return up[self.end] - up[self.first]


class Walk:
    """Nodes in depth-first order, from paths in that order."""

    def __init__(self):
        self.names: list[bytes] = [bytes(16)]
        self.depths, self.parents, self.own, self.leaf = [0], [-1], [0], [False]
        self.path = [0]                                              # nodes of the last path, the root first

    def add(self, name: bytes, own: int, leaf: bool = False) -> int:
        """A child of the last path's end."""
        self.names.append(name)
        self.depths.append(self.depths[self.path[-1]] + 1)
        self.parents.append(self.path[-1])
        self.own.append(own)
        self.leaf.append(leaf)
        self.path.append(len(self.names) - 1)
        return self.path[-1]

    def follow(self, names: list[bytes], own: list[int]) -> None:
        """The path of some names, as far as it is new."""
        k = 1
        while k < len(self.path) and k <= len(names) and self.names[self.path[k]] == names[k - 1]:
            k += 1
        del self.path[k:]
        for name, value in zip(names[k - 1 :], own[k - 1 :]):
            self.add(name, value)


FIGURES = "at long, x1 long, x2 long, leaves long, saved long, children long, own long, shard long, turn long"


def shard_figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Figures of a shard's nodes from its sorted paths (key, owns, tail, weight).

    A node off the spine gets its whole figures and a null shard. Those on the
    first (turn 0) and last path (turn 1) get the shard's part: without their own savings
    and without children on the spine; what both paths hold has its part in the first.
    """
    from pyspark import TaskContext

    walk, first = Walk(), None
    for b in batches:
        for key, owns, tail, weight in zip(*(c.to_pylist() for c in b.columns)):
            names = [key[i : i + 16] for i in range(0, len(key), 16)]
            walk.follow(names, owns)
            if first is None:
                first = list(walk.path)
            if tail:
                walk.add(b"", weight, True)
                walk.path.pop()
    if first is None:
        return
    last = list(walk.path)
    n = len(walk.names)
    depths, parents = np.array(walk.depths, np.int64), np.array(walk.parents, np.int64)
    own, leaf = np.array(walk.own, np.int64), np.array(walk.leaf)
    spine = np.zeros(n, bool)
    spine[first] = spine[last] = True
    trie = Trie(depths, leaf)
    leaves, saved = trie.leaves(), trie.sums(np.where(spine, 0, own))
    children = np.bincount(parents[1:][~spine[1:]], minlength=n)
    raw = np.frombuffer(b"".join(x or bytes(16) for x in walk.names), ">i8").astype(np.int64).reshape(-1, 2)
    shard = TaskContext.get().partitionId()

    def rows(at: np.ndarray, turn: int | None, part: np.ndarray) -> pa.RecordBatch:
        m, none = len(at), turn is None
        cols = [depths[at], raw[at, 0], raw[at, 1], leaves[at] * part, saved[at] * part, children[at] * part, own[at]]
        tags = [pa.nulls(m, pa.int64())] * 2 if none else [pa.array(np.full(m, shard)), pa.array(np.full(m, turn))]
        return pa.RecordBatch.from_arrays([*map(pa.array, cols), *tags], schema=FIGURE_ARROW)

    inner = np.flatnonzero(~spine & ~leaf)
    for k in range(0, len(inner), 50_000):
        yield rows(inner[k : k + 50_000], None, np.int64(1))
    yield rows(np.array(first), 0, np.int64(1))
    yield rows(np.array(last), 1, 1 - np.isin(last, first).astype(np.int64))


FIGURE_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in FIGURES.split(", ")])


def spine_figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole figures of the spines' nodes, from their parts in order of (shard, turn, at)."""
    walk, parts = Walk(), [[0, 0, 0]]
    names: list[bytes] = []
    held: list[tuple] = []

    def path() -> None:
        walk.follow([x[0] for x in held[1:]], [x[1] for x in held[1:]])
        parts.extend([0, 0, 0] for _ in range(len(walk.names) - len(parts)))
        for node, (_, _, *part) in zip(walk.path, held):
            parts[node] = [a + b for a, b in zip(parts[node], part)]

    for b in batches:
        cols = [b.column(c).to_pylist() for c in ("at", "x1", "x2", "own", "leaves", "saved", "children")]
        for at, x1, x2, own, *part in zip(*cols):
            if at == 0 and held:
                path()
                held = []
            held.append((x1.to_bytes(8, "big", signed=True) + x2.to_bytes(8, "big", signed=True), own, *part))
    if not held:
        return
    path()
    n = len(walk.names)
    depths = np.array(walk.depths, np.int64)
    trie = Trie(depths, np.zeros(n, bool))
    raw = np.frombuffer(b"".join(walk.names), ">i8").astype(np.int64).reshape(-1, 2)
    part = np.array(parts, np.int64)
    saved = trie.sums(np.array(walk.own, np.int64)) + part[:, 1]
    children = np.bincount(np.array(walk.parents[1:], np.int64), minlength=n) + part[:, 2]
    cols = [depths, raw[:, 0], raw[:, 1], part[:, 0], saved, children]
    for k in range(0, n, 50_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[k : k + 50_000]) for c in cols], names=["at", "x1", "x2", "leaves", "saved", "children"])


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, k1, k2, words): what a turn adds to a prefix's name, and its words."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return written(conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.xxhash64(F.lit(1), role, text).alias("k1"),
        F.xxhash64(F.lit(2), text, role).alias("k2"), F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words")), "turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, at, k1, k2, words, length) of the turns of rebuilt conversations, and (conv_id, length) of all."""
    numbered = written(ranked(turns, ["conv_id"], ["turn", "k1", "k2"]), "numbered")
    numbered = (numbered.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD)
                .withColumn("base", F.col("conv_id") - F.col("conv_id") % EVERY))
    starts = numbered.filter((F.col("conv_id") == F.col("base")) & (F.col("pos") < HEAD - 1))
    sizes = starts.filter("pos = 0").select("base", F.col("total").alias("base_total"))
    kept = F.least("h", F.coalesce("base_total", F.lit(0)))
    length = (kept + F.greatest(F.col("total") - F.col("h"), F.lit(0))).alias("length")
    sized = numbered.join(sizes, "base", "left")
    own = sized.filter("pos >= h").select("conv_id", (kept + F.col("pos") - F.col("h") + 1).alias("at"), "k1", "k2", "words", length)
    convs = sized.filter("pos = 0")
    head = convs.select("conv_id", "base", "h", length).join(starts.select("base", "pos", "k1", "k2", "words"), "base")
    head = head.filter("pos < h").select("conv_id", (F.col("pos") + 1).alias("at"), "k1", "k2", "words", "length")
    return own.unionByName(head), convs.select("conv_id", length)


def running(rows: DataFrame) -> DataFrame:
    """(conv_id, at, x1, x2, p1, p2, words, spent, length): the names of each prefix and of the one
    before it, and the words up to it. Conversations are summed in chunks."""
    rows = rows.select("conv_id", "at", F.xxhash64("at", "k1", "k2").alias("z1"), F.xxhash64("k2", "at", "k1").alias("z2"),
                       "words", "length", F.floor((F.col("at") - 1) / CHUNK).alias("chunk"))
    rows = written(rows, "rebuilt")
    sums = rows.groupBy("conv_id", "chunk").agg(F.bit_xor("z1").alias("o1"), F.bit_xor("z2").alias("o2"), F.sum("words").alias("o"))
    past = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    past = sums.select("conv_id", "chunk", F.bit_xor("o1").over(past).alias("o1"), F.bit_xor("o2").over(past).alias("o2"),
                       F.sum("o").over(past).alias("o")).filter("chunk > 0")
    so_far = Window.partitionBy("conv_id", "chunk").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = (rows.withColumn("x1", F.bit_xor("z1").over(so_far)).withColumn("x2", F.bit_xor("z2").over(so_far))
            .withColumn("spent", F.sum("words").over(so_far)).join(past, ["conv_id", "chunk"], "left"))
    zero = F.lit(0).cast("long")
    for k in "12":
        rows = rows.withColumn(f"x{k}", F.col(f"x{k}").bitwiseXOR(F.coalesce(f"o{k}", zero)))
    return rows.select("conv_id", "at", "x1", "x2", F.col("x1").bitwiseXOR(F.col("z1")).alias("p1"), F.col("x2").bitwiseXOR(F.col("z2")).alias("p2"),
                       "words", (F.col("spent") + F.coalesce("o", zero)).alias("spent"), "length")


def list_hashes(members: DataFrame) -> DataFrame:
    """(at, x1, x2, ends): SHA-256 of the ids of ``members`` (at, x1, x2, conv_id) by node, ascending and joined
    by commas. Ids come in chunks of ``IDS`` consecutive numbers and are hashed one chunk after another."""
    chunks = members.groupBy("at", "x1", "x2", F.shiftright("conv_id", 12).alias("chunk")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["at", "x1", "x2"]
    schema = pa.schema([(c, pa.int64()) for c in keys] + [("ends", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sha = None, None
        for b in batches:
            done = []
            for *node, ids in zip(*(b.column(c).to_pylist() for c in (*keys, "ids"))):
                if node == last:
                    sha.update(b"," + ids.encode())
                else:
                    if last:
                        done.append((*last, sha.hexdigest()))
                    last, sha = node, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
        if last:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((*last, sha.hexdigest()), schema)], schema=schema)

    return chunks.repartition(n, *keys).sortWithinPartitions(*keys, "chunk").mapInArrow(run, "at long, x1 long, x2 long, ends string")


def trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node."""
    spark = conversations.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, convs = rebuilt(turns_of(conversations))
    convs = written(convs, "lengths")
    rows = written(running(rows), "prefixes")
    zero = F.lit(0).cast("long")
    ends = rows.filter("at = length").select("at", "x1", "x2", "conv_id", "spent").unionByName(
        convs.filter("length = 0").select(zero.alias("at"), zero.alias("x1"), zero.alias("x2"), "conv_id", zero.alias("spent")))
    paths = written(ends.groupBy("at", "x1", "x2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("m"), F.min("spent").alias("spent")), "paths")
    hashes = written(list_hashes(ends.drop("spent")), "ends")
    # One conversation of each path, with the path's members and words.
    walks = written(rows.drop("length").join(paths.select("conv_id", F.col("at").alias("length"), "m", F.col("spent").alias("all")), "conv_id"), "walks")
    node = ["at", "x1", "x2"]
    shared = walks.groupBy(*node).agg(F.count("*").alias("n"), F.sum("m").alias("n_convs"), F.min("conv_id").alias("first"),
                                      F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("words").alias("words")).filter("n > 1").drop("n")
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("first")).filter("n_convs > 0").select(
        *(zero.alias(c) for c in node), "n_convs", "first", zero.alias("p1"), zero.alias("p2"), zero.alias("words"))
    shared = written(shared.unionByName(root), "shared")
    marked = written(walks.join(shared.select(*node, "n_convs"), node, "left"), "marked")

    owned = ((F.col("n_convs") - 1) * F.col("words")).alias("own")
    heads = marked.filter(F.col("n_convs").isNotNull()).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "x1", "x2", owned, "spent"))).alias("head"))
    name = "transform(head, s -> concat(lpad(hex(s.x1), 16, '0'), lpad(hex(s.x2), 16, '0')))"
    held = paths.select("conv_id", "m", "spent", F.col("at").alias("length")).join(heads, "conv_id", "left")
    held = held.select("conv_id", F.expr(f"unhex(coalesce(array_join({name}, ''), ''))").alias("key"),
                       F.expr("coalesce(transform(head, s -> s.own), cast(array() as array<bigint>))").alias("owns"),
                       (F.col("length") > F.coalesce(F.size("head"), F.lit(0))).alias("tail"),
                       ((F.col("m") - 1) * (F.col("spent") - F.expr("coalesce(try_element_at(head, -1).spent, 0)"))).alias("weight"))
    held = held.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    figures = written(held.select("key", "owns", "tail", "weight").mapInArrow(shard_figures, FIGURES), "figures")
    spines = figures.filter(F.col("shard").isNotNull()).repartition(1).sortWithinPartitions("shard", "turn", "at")
    whole = figures.filter(F.col("shard").isNull()).select(*node, "leaves", "saved", "children").unionByName(
        spines.mapInArrow(spine_figures, "at long, x1 long, x2 long, leaves long, saved long, children long"))

    above = shared.select((F.col("at") + 1).alias("at"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("first").alias("parent"))
    up = ["at", "p1", "p2"]
    # Only a tree of textless conversations has a root without children.
    inner = shared.join(whole, node).join(above, up, "left").select(
        *node, F.col("first").alias("conv_id"), F.col("parent").alias("parent_conv_id"), "n_convs", F.col("children").alias("n_children"),
        F.greatest("leaves", F.lit(1)).alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    tails = marked.filter(F.col("n_convs").isNull()).drop("n_convs").join(above, up, "left").select(
        *node, "conv_id", F.coalesce("parent", "conv_id").alias("parent_conv_id"), F.col("m").alias("n_convs"),
        (F.col("at") < F.col("length")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("m") - 1) * (F.col("all") - F.col("spent") + F.col("words"))).alias("saved_tokens"))
    return inner.unionByName(tails).join(hashes, node, "left").select(
        "conv_id", F.col("at").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(NONE)).alias("ends_sha256"))


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


OP11_SQL = """
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, n, c - c % 20 AS base, xor(inverse, 4294967295) % 4 AS h FROM (
    SELECT c, count(*) AS n, list_reduce(
      list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                            lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END)) AS inverse
    FROM t GROUP BY c)),
turns AS (
  SELECT v.c, t.p AS depth, r, x FROM convs v JOIN t ON t.c = v.base AND t.p <= v.h
  UNION ALL
  SELECT v.c, t.p - v.h + least(v.h, coalesce(b.n, 0)), r, x FROM convs v JOIN t ON t.c = v.c AND t.p > v.h LEFT JOIN convs b ON b.c = v.base),
prefixes AS (
  SELECT c, depth, string_agg(sha256(strlen(r) || ':' || r || x), '') OVER (PARTITION BY c ORDER BY depth) AS name,
    len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words
  FROM turns
  UNION ALL SELECT c, 0, '', 0 FROM convs),
nodes AS (SELECT name, depth, min(c) AS first, count(*) AS n, any_value(words) AS words FROM prefixes GROUP BY name, depth),
lasts AS (SELECT c, max_by(name, depth) AS name FROM prefixes GROUP BY c),
ends AS (SELECT name, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends FROM lasts GROUP BY name),
ups AS (SELECT d.*, left(d.name, strlen(d.name) - 64) AS parent FROM nodes d),
children AS (SELECT parent, count(*) AS n FROM ups WHERE depth > 0 GROUP BY parent),
subtrees AS (
  SELECT a.name, count(*) FILTER (WHERE k.n IS NULL) AS leaves, sum((d.n - 1) * d.words) AS saved
  FROM nodes d JOIN prefixes a ON a.c = d.first AND a.depth <= d.depth LEFT JOIN children k ON k.parent = d.name
  GROUP BY a.name)
SELECT d.first AS conv_id, d.depth, CASE WHEN d.depth > 0 THEN u.first END AS parent_conv_id, d.n AS n_convs,
  coalesce(k.n, 0) AS n_children, s.leaves AS n_leaves, s.saved::BIGINT AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM ups d JOIN subtrees s ON s.name = d.name LEFT JOIN nodes u ON u.name = d.parent
LEFT JOIN children k ON k.parent = d.name LEFT JOIN ends e ON e.name = d.name
"""
