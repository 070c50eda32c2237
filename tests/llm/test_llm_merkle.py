"""The Merkle manifest against a plain recursive tree."""
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sponsorlens.llm import merkle

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, HASH int, leaf string"


def h(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(row):
    _, text, lang, source, n, *_ = row
    out = ""
    for v in (row[0], source, lang, n, text):
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(out)


def tree(nodes):
    """Root of a list of digests, and each one's (digest before, digest after) by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(at):
            other = nodes[p ^ 1] if p ^ 1 < len(nodes) else ""
            paths[k].append((other, "") if p % 2 else ("", other))
        nodes = [h("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
        at = [p // 2 for p in at]
    return nodes[0], paths


def expected(rows):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    order = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    lower = []
    for lang in order:
        leaves = sorted(((r[0] is not None, r[0] or 0, leaf(r), r) for r in by_lang[lang]), key=lambda x: x[:3])
        lower.append(([x[3] for x in leaves], *tree([x[2] for x in leaves])))
    root, upper = tree([sub for _, sub, _ in lower])
    return sorted((repr(r[0]), leaf(r), sub, root, h("".join(a + b for a, b in below + above)))
                  for (rs, sub, paths), above in zip(lower, upper) for r, below in zip(rs, paths))


def table(n, langs, seed=5):
    r = random.Random(seed)
    return [(i, r.choice(["", "é" * r.randint(0, 9), "x" * 2000, None, "a|b:1"]), r.choice(langs), r.choice([None, "s", ""]),
             r.choice([None, 0, 7, -3]), 1, "x") for i in range(n)]


@pytest.mark.parametrize("n, langs, bits", [(1, ["en"], 2), (2, ["en"], 2), (70, ["en"], 2), (67, [None, "de", "en", "", "é", "z"], 2), (40, [None, "a"], 3)])
def test_manifest_equals_recursive_tree(spark, n, langs, bits):
    rows = table(n, langs)
    df = spark.createDataFrame(rows, COLUMNS).repartition(5)
    got = merkle.manifest(df, F.when(F.col("doc_id") % 3 == 0, F.col("n_chars") + 1), bits).withColumn("proof", merkle.proof_digest())
    got = got.withColumn("whole", merkle.folded(F.col("leaf"))).withColumn("after", merkle.folded(F.coalesce("changed", "leaf"))).collect()
    assert sorted((repr(r.doc_id), r.leaf, r.subroot, r.root, r.proof) for r in got) == expected(rows)
    by_id = {r[0]: r for r in rows}
    for r in got:
        struck = r.doc_id % 3 == 0 and by_id[r.doc_id][4] is not None
        assert r.whole == r.root and (r.after == r.root) == (not struck)


def test_many_langs_make_rounds_of_their_own(spark):
    rows = table(45, [f"l{k}" for k in range(30)])
    got = merkle.manifest(spark.createDataFrame(rows, COLUMNS), F.lit(None).cast("long"), 1).withColumn("proof", merkle.proof_digest())
    assert sorted((repr(r.doc_id), r.leaf, r.subroot, r.root, r.proof) for r in got.collect()) == expected(rows)


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(None, "a", "en", "s", 1, 1, "x")] * 3 + [(4, "a", "en", "s", 1, 1, "x")] * 4 + [(4, None, None, None, None, 1, "x")]
    got = merkle.manifest(spark.createDataFrame(rows, COLUMNS), F.lit(None).cast("long"), 1).withColumn("proof", merkle.proof_digest())
    assert sorted((repr(r.doc_id), r.leaf, r.subroot, r.root, r.proof) for r in got.collect()) == expected(rows)
    assert merkle.manifest(spark.createDataFrame([], COLUMNS), F.lit(None).cast("long")).count() == 0


def test_query_on_a_folder(spark, tmp_path):
    rows = table(50, ["en", None])
    spark.createDataFrame(rows, COLUMNS).drop("HASH", "leaf").write.parquet(str(tmp_path / "documents.parquet"))
    import zlib

    got = merkle.op13_merkle_manifest(spark, str(tmp_path)).collect()
    for r in got:
        struck = zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and rows[r.doc_id][4] is not None
        assert r.verified == (not struck) == (r.folded_root == r.root)
    assert sorted((repr(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256) for r in got) == expected(rows)
