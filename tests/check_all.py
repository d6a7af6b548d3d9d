"""Every query against its SQL: python tests/check_all.py [sf] [names ...]"""

from __future__ import annotations

import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

import __spark_entry__ as entry_points  # noqa: E402
from tests.compare import connect, differences  # noqa: E402
from tests.session import local_session  # noqa: E402


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = local_session(), connect(sf_dir)
    sql, bad = entry_points.oracle_sql(), 0
    assert set(sql) <= set(entry_points.queries())
    for name, build in entry_points.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in sql:
                found = differences(build(spark, sf_dir), con, sql[name])
                state = "ok" if not found else f"DIFFERS {found}"
            else:
                found, state = [], f"rows only: {len(build(spark, sf_dir).collect())}"
        except Exception as problem:  # report and go on with the next query
            found, state = [problem], f"FAILED {type(problem).__name__}: {str(problem)[:600]}"
        bad += bool(found)
        print(f"{name:28s} {time.time() - start:6.2f}s {state}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
