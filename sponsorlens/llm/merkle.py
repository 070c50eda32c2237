"""Merkle manifest of a table: levels kept as concatenated hex strings.

The leaves of a group, in order, are cut into aligned blocks of ``BLOCK``. A
block holds each of its levels as one string, the hex digests of the nodes side
by side; the parents of a level are hashes of its substrings of two digests'
width (the last one may be of one digest: a node without a partner is hashed
alone). The digests on top of the blocks are the leaves of the next round, until
a group has one node, its root. On the way down the digests that flank a node's
place in each level string are its segment of siblings, and the segments of the
rounds, one after another, are its proof. Nodes are numbered by ranges, so
neither a large group nor its proofs pass through one task; all of it is SQL
expressions.

H is the lowercase hex SHA-256 of its inputs one after another. A value enters a
leaf as ``-`` if null, else as its length in bytes, ``:`` and the value.

Rows of one id come in the order of their digests; repeated rows are leaves of
their own, null ids come first. An empty table has no root and no rows. Columns
beside the named ones are left out of the leaves.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table, written
from .ranks import ranked

BLOCK_BITS = 10
BLOCK = 1 << BLOCK_BITS          # leaves of a block: 64 kB a level
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: The level above level ``x``: hashes of every two digests of 64 characters.
PARENTS = ("cast(array_join(transform(sequence(0L, cast(ceil(octet_length(x) / 128) as bigint) - 1L), "
           "i -> sha2(substring(x, cast(i * 128 + 1 as int), 128), 256)), '') as binary)")


def digest(*values: Column) -> Column:
    """H of the values, as they enter a leaf."""
    def entered(c: Column) -> Column:
        s = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))

    return F.sha2(F.concat(*(entered(c) for c in values)), 256)


def levels_of(leaves: str, total: str, bits: int) -> Column:
    """All levels of a block, from the string of its leaves to that of its top."""
    steps = ", ".join(str(k) for k in range(1, bits + 1))
    # A group of one block ends where one node is left; other blocks are of full height.
    height = f"least({bits}, cast(ceil(log2({total})) as int))"
    above = PARENTS.replace("(x", "(element_at(acc, -1)")
    return F.expr(f"aggregate(filter(array({steps}), l -> l <= {height}), array({leaves}), (acc, l) -> concat(acc, array({above})))")


def grown(nodes: DataFrame, bits: int = BLOCK_BITS) -> list[DataFrame]:
    """Written block tables from the leaves up, of ``nodes`` (g: group, pos, total, hash, row).
    The blocks of the last table are whole groups and their tops are the roots."""
    tables: list[DataFrame] = []
    while True:
        block = F.shiftright("pos", bits)
        held = nodes.groupBy("g", block.alias("block")).agg(
            F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("pos", "hash", "row"))).alias("nodes"))
        held = held.withColumn("leaves", F.expr("cast(array_join(transform(nodes, x -> x.hash), '') as binary)"))
        held = held.withColumn("levels", levels_of("leaves", "total", bits)).drop("leaves")
        tables.append(written(held.withColumn("top", F.expr("cast(element_at(levels, -1) as string)")), "blocks"))
        if (tables[-1].agg(F.max("total")).first()[0] or 0) <= 1 << bits:
            return tables
        nodes = tables[-1].select("g", F.col("block").alias("pos"), F.ceil(F.col("total") / (1 << bits)).alias("total"),
                                  F.col("top").alias("hash"), F.lit(0).alias("row"))


#: The digest beside node ``j`` of level string ``lv``: on its left or on its right, empty if there is none.
SEGMENT = ("transform(slice(levels, 1, size(levels) - 1), (lv, l) -> named_struct("
           "'l', case when shiftright({i}, l) % 2 = 1 then cast(substring(lv, cast((shiftright({i}, l) - 1) * 64 + 1 as int), 64) as string) else '' end, "
           "'r', case when shiftright({i}, l) % 2 = 0 then cast(substring(lv, cast((shiftright({i}, l) + 1) * 64 + 1 as int), 64) as string) else '' end))")


def proved(tables: list[DataFrame], roots: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """(columns of ``roots``, pos, hash, row, path) of every leaf. ``roots`` has g and the path above
    each group's root; a path is an array of (l, r), the digests left and right of a node."""
    more = [c for c in roots.columns if c not in ("g", "path")]
    cur = roots.select(F.col("g").alias("g_"), F.lit(0).cast("long").alias("at"), *more, "path")
    for k in reversed(range(len(tables))):
        held = tables[k].join(cur, F.col("g").eqNullSafe(F.col("g_")) & (F.col("block") == F.col("at")))
        segment = SEGMENT.format(i=f"(x.pos % {1 << bits})")
        leaf = F.explode(F.expr(f"transform(nodes, x -> named_struct('pos', x.pos, 'hash', x.hash, 'row', x.row, 'path', concat({segment}, path)))"))
        cur = held.select("g_", *more, leaf.alias("leaf")).select("g_", *more, "leaf.*")
        if k:
            cur = cur.withColumnRenamed("pos", "at").drop("hash", "row")
    return cur.withColumnRenamed("g_", "g")


def manifest(docs: DataFrame, tampered: Column, bits: int = BLOCK_BITS) -> DataFrame:
    """(doc_id, lang, leaf, changed, subroot, root, path) of every row of ``docs``: leaves ascend by doc_id
    within lang, the roots of the langs, null first, make one tree. ``changed`` is the leaf with ``tampered``
    in place of n_chars, null where ``tampered`` is null."""
    fields = [F.col(c) for c in FIELDS]
    changed = digest(*(tampered if c == "n_chars" else F.col(c) for c in FIELDS))
    leaves = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").alias("g"), digest(*fields).alias("hash"),
                                 F.when(tampered.isNotNull(), changed).alias("changed")), "leaves")
    placed = ranked(leaves, ["g"], ["doc_id", "hash"])
    below = grown(placed.select("g", "pos", "total", "hash", F.struct("doc_id", "changed").alias("row")), bits)
    subroots = written(below[-1].select(F.col("g").alias("lang"), "top"), "subroots")
    placed = ranked(subroots, [], ["lang"])
    above = grown(placed.select(F.lit(0).alias("g"), "pos", "total", F.col("top").alias("hash"), F.struct("lang").alias("row")), bits)
    start = above[-1].select("g", F.col("top").alias("root"), F.expr("cast(array() as array<struct<l: string, r: string>>)").alias("path"))
    paths = proved(above, start, bits)
    paths = paths.select(F.col("row.lang").alias("g"), "root", F.col("hash").alias("subroot"), "path")
    rows = proved(below, paths, bits)
    return rows.select(F.col("row.doc_id").alias("doc_id"), F.col("g").alias("lang"), F.col("hash").alias("leaf"),
                       F.col("row.changed").alias("changed"), "subroot", "root", "path")


def proof_digest(path: str = "path") -> Column:
    """H of a path's digests, from the leaf up."""
    return F.expr(f"sha2(array_join(transform({path}, s -> concat(s.l, s.r)), ''), 256)")


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(F.col(path), leaf, lambda acc, s: F.sha2(F.concat(s["l"], acc, s["r"]), 256))


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """The manifest of ``documents``, each row verified by its proof; where 7 divides the crc32 of the id
    (never for a null id), the row verified has one more in n_chars."""
    docs = table(spark, sf_dir, "documents")
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    # A null n_chars stays null: its leaf is not changed.
    made = manifest(docs, F.when(struck & F.col("n_chars").isNotNull(), F.col("n_chars") + 1))
    made = made.withColumn("folded_root", folded(F.coalesce("changed", "leaf")))
    return made.select("doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


OP13_SQL = """
WITH RECURSIVE docs AS (
  SELECT doc_id, lang, n_chars, list_reduce(
      list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                            lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END)) AS inverse,
    concat(CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END,
           CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END,
           CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END) AS head,
    CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS tail
  FROM documents),
leaves AS (
  SELECT doc_id, lang, sha256(head || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END || tail) AS leaf,
    CASE WHEN xor(inverse, 4294967295) % 7 = 0 AND n_chars IS NOT NULL
         THEN sha256(head || strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1) || tail) END AS changed,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n
  FROM docs),
low AS (
  SELECT 0 AS l, lang, pos, n, leaf AS h FROM leaves
  UNION ALL
  SELECT l + 1, lang, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM low WHERE n > 1 GROUP BY l, lang, pos // 2, n),
subroots AS (
  SELECT lang, h, l AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 0 AS l, pos, n, h FROM subroots
  UNION ALL
  SELECT l + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY l, pos // 2, n),
root AS (SELECT h AS root FROM high WHERE n = 1),
places AS (
  SELECT d.doc_id, d.leaf, d.changed, s.h AS subroot, d.lang, d.pos, s.pos AS upper, s.height, root.root,
    s.height + (SELECT max(l) FROM high) AS top
  FROM leaves d JOIN subroots s ON d.lang IS NOT DISTINCT FROM s.lang, root),
steps AS (
  SELECT p.doc_id, p.leaf, k.l, (CASE WHEN k.l < height THEN p.pos >> k.l ELSE p.upper >> (k.l - height) END) AS place,
    coalesce(a.h, b.h, '') AS sibling
  FROM places p, range(64) k(l)
  LEFT JOIN low a ON k.l < height AND a.l = k.l AND a.lang IS NOT DISTINCT FROM p.lang AND a.pos = xor(p.pos >> k.l, 1)
  LEFT JOIN high b ON k.l >= height AND b.l = k.l - height AND b.pos = xor(p.upper >> (k.l - height), 1)
  WHERE k.l < top),
fold AS (
  SELECT doc_id, leaf, 0 AS l, top, root, coalesce(changed, leaf) AS h FROM places
  UNION ALL
  SELECT f.doc_id, f.leaf, f.l + 1, f.top, f.root, sha256(CASE WHEN s.place % 2 = 1 THEN s.sibling || f.h ELSE f.h || s.sibling END)
  FROM fold f JOIN steps s ON f.doc_id IS NOT DISTINCT FROM s.doc_id AND f.leaf = s.leaf AND f.l = s.l),
proofs AS (SELECT doc_id, leaf, sha256(string_agg(sibling, '' ORDER BY l)) AS proof_sha256 FROM steps GROUP BY ALL)
SELECT p.doc_id, p.leaf, p.subroot, p.root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256,
  f.h AS folded_root, f.h = p.root AS verified
FROM places p
JOIN fold f ON f.doc_id IS NOT DISTINCT FROM p.doc_id AND f.leaf = p.leaf AND f.l = p.top
LEFT JOIN proofs q ON q.doc_id IS NOT DISTINCT FROM p.doc_id AND q.leaf = p.leaf
"""
