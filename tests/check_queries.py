"""Run registered queries against their SQL twins: ``python tests/check_queries.py [sf] [names]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare, connect  # noqa: E402

from sitegrade.bindings import registry  # noqa: E402
from sitegrade.session import build_session  # noqa: E402


def main() -> int:
    args = sys.argv[1:]
    sf = args[0] if args else "0.01"
    wanted = args[1:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = registry.oracle_sql()
    bad = 0
    for name, query in registry.queries().items():
        if wanted and not any(w == name or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            problems = compare(df, oracles[name], con) if name in oracles else [] if df.count() >= 0 else []
        except Exception as exc:  # report every query
            problems = [f"{type(exc).__name__}: {str(exc)[:1500]}"]
            if os.environ.get("TRACE"):
                traceback.print_exc()
        n = "" if name in oracles else " (no twin)"
        print(f"{'FAIL' if problems else 'ok  '} {name}{n} {time.time() - start:.2f}s", flush=True)
        for p in problems:
            print("    ", p, flush=True)
        bad += bool(problems)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(main())
