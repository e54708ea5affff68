"""Compare every registered query with its oracle (CLI): python tests/run_oracles.py [sf_dir] [names...]"""

import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from oracle import compare, duck  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from tillbook.session import local_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
only = set(sys.argv[2:])
spark = local_session()
qs, os_ = E.queries(), E.oracle_sql()
con = duck(sf)
bad = 0
for name, fn in qs.items():
    if only and name not in only:
        continue
    t0 = time.time()
    if name not in os_:
        try:
            n = fn(spark, sf).count()
            print(f"ROWS  {name}: {n} rows ({time.time()-t0:.1f}s)", flush=True)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERROR {name}: {type(e).__name__}: {str(e)[:400]}", flush=True)
        continue
    try:
        ok, msg = compare(spark, name, fn, os_[name], sf, con)
    except Exception as e:  # noqa: BLE001
        ok, msg = False, f"{type(e).__name__}: {str(e)[:600]}"
    bad += not ok
    print(f"{'OK   ' if ok else 'FAIL '} {name}: {msg} ({time.time()-t0:.1f}s)", flush=True)
print(f"{len(qs)} queries, {len(os_)} oracles, {bad} failing")
