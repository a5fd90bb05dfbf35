"""Compare registered queries with their SQL: python tests/run_catalog.py [sf] [name part ...]"""

import sys
import time
import traceback

sys.path.insert(0, __file__.rsplit("/", 2)[0])

from tests.harness import TESTDATA, connect, differences  # noqa: E402
from tramline.catalog import ORACLES, QUERIES  # noqa: E402
from tramline.session import get_session  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.001"
    wanted = sys.argv[2:]
    spark = get_session("catalog", "local[8]", **{"spark_sql_shuffle_partitions": "8", "spark_ui_enabled": "false", "spark_ui_showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    folder = f"{TESTDATA}/{sf}"
    con = connect(folder)
    bad = 0
    for name, run in QUERIES.items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in ORACLES:
                problem = differences(df, con, ORACLES[name])
            else:
                problem = None if df.count() > 0 else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
            if "-v" in wanted:
                traceback.print_exc()
        took = time.time() - start
        mark = "ok  " if problem is None else "FAIL"
        bad += problem is not None
        print(f"{mark} {took:6.2f}s {'' if name in ORACLES else '(rows only) '}{name} {problem or ''}", flush=True)
    print(f"{bad} failed")
