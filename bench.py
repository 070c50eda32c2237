"""Benchmark: build the warehouse from $BENCH_SF_DIR (default sf0.1), then
run every registered query once, fully materialised (noop sink), on
local[$BENCH_CPUS]. Prints one JSON line.

The load (raw fixture -> staged -> dimensions -> fact -> extracts) is timed
as ``load_warehouse``; ``value`` is the load plus all query times.

Before timing, the same load and queries run once, untimed, on the smallest
test folder (sf0.001) so the JVM has compiled the hot code paths: the timed
numbers are steady-state, not JIT warm-up. ``warmup`` in the output says
which folder was used (null when it does not exist).
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [a for a in sys.argv[1:]]
    from sponsorlens.session import get_spark
    from sponsorlens.plans import context, registry

    spark = get_spark("sponsorlens-bench", cpus=cpus)
    spark.range(1).count()
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    warm = warm_dir if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir) else None
    if warm:                                                 # untimed warm-up pass
        context.build_fresh(spark, warm)
        for name, fn in registry.queries().items():
            fn(spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    t0 = time.time()
    context.build_fresh(spark, sf_dir)                       # a full load, never a cached build
    times["load_warehouse"] = round(time.time() - t0, 3)
    for name, fn in registry.queries().items():
        if only and not any(o in name for o in only):
            continue
        t = time.time()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "load_plus_all_queries_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "n_queries": len(times) - 1,
        "query_sec_total": round(sum(v for k, v in times.items() if k != "load_warehouse"), 3),
        "warmup": warm,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
