"""Run every registered query against its DuckDB oracle and print a JSON line per key.

    python -m tests.run_oracle [sf_dir] [key ...]
"""

from __future__ import annotations

import json
import sys
import time

from tests.compare import compare, duck
from wardline.session import build_session


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    import __spark_entry__ as entry
    qs, sqls = entry.queries(), entry.oracle_sql()
    keys = argv[1:] or list(qs)
    spark = build_session()
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        t0 = time.time()
        try:
            res = compare(qs[k](spark, sf_dir), con, sqls[k])
        except Exception as e:  # report and continue
            res = {"ok": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        res["sec"] = round(time.time() - t0, 2)
        bad += not res["ok"]
        print(json.dumps({"query": k, **res}), flush=True)
    print(json.dumps({"failed": bad, "total": len(keys)}))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
