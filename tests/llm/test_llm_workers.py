"""The operators on workers that don't have the repository on their path."""
import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_operators_run_without_the_repository_on_the_workers_path(tmp_path):
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
                 .config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate())
        from sponsorlens.llm import queries
        for name in ("op2_hmm_scores", "op5_decontaminate", "op6_minhash_dedup", "op11_prefix_trie", "op12_repeated_text"):
            print(name, queries.QUERIES[name](spark, "/root/testdata/sf0.001").count(), flush=True)
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[0] for line in done.stdout.splitlines() if line.startswith("op")] == [
        "op2_hmm_scores", "op5_decontaminate", "op6_minhash_dedup", "op11_prefix_trie", "op12_repeated_text"]
