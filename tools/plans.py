"""Write the physical plans of key queries as they would look at scale.

    python tools/plans.py [sf_dir] > docs/plans_at_scale.md

Size-based broadcasts are switched off (as when every table is large); the
calendar keeps its explicit broadcast, whose size is bounded by the period.
Each plan is printed after the query ran, so AQE's final plan is shown.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NAMES = ["resolve_contract", "daily_summary", "revenue_day", "segment_day", "usage_dense",
         "usage_client_day_type", "usage_window", "usage_pivot_type", "usage_gaps", "volume_moving_avg", "event_use_days",
         "trend_value_type", "trend_segment_value", "acf", "pacf"]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from paydw.session import get_session

    spark = get_session("local[4]", 8, extra={"spark.sql.autoBroadcastJoinThreshold": "-1",
                                              "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    from paydw.operators.contracts import resolve_contract
    from paydw.plans.registry import QUERIES
    from paydw.sources.driver import staging_contratos, staging_transacoes

    print("# Physical plans with size-based broadcast off\n")
    print(f"Input `{sf_dir}`; AQE on; `spark.sql.autoBroadcastJoinThreshold=-1`.\n")
    for name in NAMES:
        if name == "resolve_contract":
            df = resolve_contract(staging_transacoes(spark, sf_dir), staging_contratos(spark, sf_dir))
            title = "resolve_contract (J5 from staging, as in the ETL)"
        else:
            df, title = QUERIES[name](spark, sf_dir), name
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"## {title}\n")
        shuffles = plan.count("Exchange ") - plan.count("BroadcastExchange ")
        print(f"shuffle exchanges: {shuffles}, broadcast exchanges: {plan.count('BroadcastExchange ')}, "
              f"sort-merge joins: {plan.count('SortMergeJoin')}, broadcast joins: {plan.count('BroadcastHashJoin')}\n")
        print("```")
        print(plan.rstrip())
        print("```\n")


if __name__ == "__main__":
    main(sys.argv)
