"""Run registered queries against their SQL oracles and print one line per query.

    python tests/check_queries.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tests import compare  # noqa: E402
from tests.conftest import local_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(entry.queries())
    spark, oracle, failed = local_session(), compare.duck(sf), 0
    for name in wanted:
        start = time.time()
        try:
            result, sql = entry.queries()[name](spark, sf), entry.oracle_sql().get(name)
            problem = compare.difference(result, oracle, sql) if sql else None
            if not sql:
                print(f"     {name}: {result.count()} rows, no SQL")
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok':<5}{name:<30}{time.time() - start:6.2f}s {problem or ''}", flush=True)
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
