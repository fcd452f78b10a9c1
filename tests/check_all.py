"""Compare every query with its SQL: ``python -m tests.check_all [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
import traceback

import __spark_entry__ as contract
from respondry.plans.session import session
from tests.compare import difference, duck, duck_result, spark_result


def main(sf_dir: str, names: list[str]) -> int:
    spark = session(
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.driver.memory": "12g", "spark.master": "local[8]"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql = duck(sf_dir), contract.oracle_sql()
    failed = 0
    for name, run in contract.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            actual = spark_result(run(spark, sf_dir))
            spent = time.time() - start
            if name in sql:
                problem = difference(duck_result(connection, sql[name]), actual)
            else:
                problem = "" if actual[1] else "no rows"
        except Exception as error:  # noqa: BLE001
            spent, problem = time.time() - start, f"{type(error).__name__}: {str(error)[:1500]}"
            if names:
                traceback.print_exc()
        kind = "sql " if name in sql else "rows"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {kind} {spent:6.2f}s {name} {problem}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    arguments = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sys.exit(main(arguments[0], arguments[1:]))
