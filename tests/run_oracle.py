"""Command line: compare every driver query with its oracle at one scale.

    python tests/run_oracle.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from casebook.session import local_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = local_session(shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and not any(o in name for o in only):
            continue
        if name not in sqls:
            print(f"{name:32s} (no oracle)")
            continue
        t0 = time.time()
        try:
            r = compare(spark, con, fn, sqls[name], sf_dir)
        except Exception as exc:  # report and continue
            bad += 1
            print(f"{name:32s} ERROR {type(exc).__name__}: {str(exc)[:400]}")
            continue
        ok = r["names_match"] and r["values_match"]
        bad += not ok
        if ok and not r["types_match"]:
            print(f"{name:32s} TYPES spark {r['spark_types']}\n{'':32s}       duck  {r['oracle_types']}")
        types = "" if ok else f"\n   spark {r['spark_types']}\n   duck  {r['oracle_types']}"
        diff = "" if ok else f"\n   only_spark {r.get('only_spark')}\n   only_oracle {r.get('only_oracle')}"
        print(f"{name:32s} {'OK ' if ok else 'BAD'} rows {r['spark_rows']}/{r['oracle_rows']} "
              f"{time.time() - t0:.1f}s{types}{diff}")
    print("mismatches:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
