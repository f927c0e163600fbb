"""Benchmark: the warehouse ETL and every registered query at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line. ``etl_build`` runs the whole ETL from the driver
tables (merges K1-K5 with contract resolution and daily summary) into a
fresh warehouse; ``resolve_contract_only`` is the contract resolution alone
registered query to completion through the ``noop`` sink (full execution, no
rows to the driver). The metric is the sum over all entries.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from paydw.session import get_session

    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, cpus * 2))))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=parts, app="paydw-bench",
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})

    from paydw.operators.contracts import resolve_contract
    from paydw.plans.registry import QUERIES
    from paydw.plans.warehouse import warehouse_for_sf
    from paydw.sources.driver import staging_contratos, staging_transacoes

    times: dict[str, float] = {}
    t = time.time()
    warehouse_for_sf(spark, sf_dir, rebuild=True)
    times["etl_build"] = time.time() - t

    t = time.time()
    resolve_contract(staging_transacoes(spark, sf_dir), staging_contratos(spark, sf_dir)) \
        .write.format("noop").mode("overwrite").save()
    times["resolve_contract_only"] = time.time() - t

    errors: dict[str, str] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = time.time() - t
        except Exception as e:  # record and go on: one failure must not hide the rest
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
