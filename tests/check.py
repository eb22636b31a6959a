"""Compare named queries with their oracle: ``python tests/check.py [prefix ...]``."""

import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))
import __spark_entry__ as entry  # noqa: E402
from compare import diff, duck, duck_table, spark_table  # noqa: E402
from conftest import make_session  # noqa: E402

if __name__ == "__main__":
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = make_session()
    con, sql, bad, shown = duck(sf), entry.oracle_sql(), 0, 0
    for name, fn in entry.queries().items():
        if sys.argv[1:] and not any(name.startswith(p) for p in sys.argv[1:]):
            continue
        shown += 1
        t0 = time.time()
        try:
            got = spark_table(fn(spark, sf))
            t1 = time.time()
            why = diff(got, duck_table(con, sql[name])) if name in sql else "no oracle"
        except Exception as e:  # noqa: BLE001 - a report of every failure is wanted
            t1, got, why = time.time(), ([], []), f"{type(e).__name__}: {str(e)[:600]}"
        bad += why not in (None, "no oracle")
        print(f"{'ok ' if why is None else '-- '} {name} rows={len(got[1])} {t1 - t0:.2f}s"
              + (f"\n     {why}" if why else ""), flush=True)
    print(f"{shown} queries, {bad} differ")
