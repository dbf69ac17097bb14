"""Run registered queries against their DuckDB oracles and print a summary.

usage: python check_oracles.py [sf_dir] [name ...]
"""

from __future__ import annotations

import json
import sys
import time

from ledgerlens.plans.compare import compare, duck_connect
from ledgerlens.plans.queries import oracle_sql, queries
from ledgerlens.session import get_session


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck_connect(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        if name in sqls:
            res = compare(df, con, sqls[name])
        else:
            res = {"spark_rows": df.count(), "ok": None, "rows_only": True}
        res["sec"] = round(time.time() - t0, 2)
        bad += res.get("ok") is False
        print(name, json.dumps(res, default=str), flush=True)
    print(f"FAILED {bad}" if bad else "ALL OK")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
