"""``python tests/run_checks.py [pattern] [scale]``: compare queries with their SQL."""

from __future__ import annotations

import os
import re
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from checks import ORACLES, QUERIES  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402


def main():
    pattern = sys.argv[1] if len(sys.argv) > 1 else "."
    sf = f"/root/testdata/sf{sys.argv[2] if len(sys.argv) > 2 else '0.01'}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", os.environ.get("CHECK_TZ", "UTC"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    failed = []
    for name, query in QUERIES.items():
        if not re.search(pattern, name):
            continue
        start = time.time()
        try:
            if name in ORACLES:
                report, n = compare(spark, con, sf, query, ORACLES[name])
            else:
                report, n = None, query(spark, sf).count()
        except Exception as e:  # noqa: BLE001
            report, n = "".join(traceback.format_exception_only(e))[:1500], -1
        took = time.time() - start
        mark = "ok  " if report is None else "FAIL"
        kind = "sql " if name in ORACLES else "rows"
        print(f"{mark} {kind} {took:6.2f}s {n:8d} {name}" + (f"\n       {report}" if report else ""), flush=True)
        if report:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main()
