"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. The base fact is
built from the tables and stored; the later facts start from the stored base
and the statement lines from the stored account aggregate, as the jobs do.
With BENCH_FORMS=1 the lines are also timed as a union of 23 roll-ups.
"""

from __future__ import annotations

import json
import os
import time

from ledgermill import chart, testmap
from ledgermill.catalogue.queries import QUERIES
from ledgermill.functions import calendar
from ledgermill.operators import lines, rollup
from ledgermill.plans import gl as gl_plan
from ledgermill.plans.trial_balance import trial_balance
from ledgermill.session import build_session, stage


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="20g", spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    dim = testmap.dimensions(spark, d)
    seconds: dict[str, float] = {}

    def timed(name, action):
        start = time.time()
        result = action()
        seconds[name] = round(time.time() - start, 3)
        return result

    base = timed("base_fact", lambda: stage(QUERIES["base_fact"](spark, d), "bench-base"))
    periods = calendar.list_periods(base)
    frame = calendar.periods_frame(spark, periods)
    timed("trial_balance", lambda: run(trial_balance(
        base, dim.legal_entity, dim.customer, dim.contracts, periods, testmap.GROUP)))
    timed("customer_aggregate", lambda: run(rollup.customer_aggregate(base, dim.domain, dim.gl_accounts)))
    timed("gl_fact", lambda: run(gl_plan.gl_fact(base, None, frame, dim)))
    gl = stage(gl_plan.gl_base(base, None, frame, dim), "bench-gl")
    timed("statement_lines", lambda: run(lines.statement_lines(gl, dim.gl_accounts, dim.profit_centre)))
    total = round(sum(seconds.values()), 3)
    if os.environ.get("BENCH_FORMS", "0") == "1":
        def union_all():
            parts = [lines.statement_lines(gl, dim.gl_accounts, dim.profit_centre, {k: v})
                     for k, v in chart.STATEMENT_LINES.items()]
            whole = parts[0]
            for part in parts[1:]:
                whole = whole.unionByName(part)
            run(whole)
        timed("statement_lines_union_all", union_all)
    print(json.dumps({
        "metric": "headline queries, wall time", "value": total, "unit": "sec",
        "queries": seconds, "sf": os.path.basename(d.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
