"""Run every binding against its oracle SQL: python tests/run_oracle.py [sf_dir] [key ...]"""

import sys
import time

sys.path.insert(0, ".")
from hearth.session import build_session  # noqa: E402
from hearth.bindings import load_all  # noqa: E402
from tests.oracle import duck, compare  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
only = set(sys.argv[2:])
spark = build_session("local[8]", 8)
con = duck(sf)
bad = []
for name, b in sorted(load_all().items()):
    if only and name not in only:
        continue
    t = time.time()
    try:
        df = b.fn(spark, sf)
        if b.sql is None:
            n = df.count()
            print(f"{name:28s} rows-only n={n} {time.time()-t:.1f}s")
            continue
        r = compare(df, con, b.sql)
    except Exception as e:  # noqa: BLE001
        bad.append(name)
        print(f"{name:28s} ERROR {type(e).__name__}: {str(e)[:300]}")
        continue
    if not r["ok"]:
        bad.append(name)
    print(f"{name:28s} {'OK ' if r['ok'] else 'BAD'} rows={r.get('rows')} types={r.get('types')} "
          f"{'' if r['ok'] else r.get('diff', (r['spark_cols'], r['duck_cols']))} {time.time()-t:.1f}s")
print("FAILED:", bad)
