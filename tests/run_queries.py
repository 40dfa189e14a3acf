"""Run registered queries by name prefix: python tests/run_queries.py <sf> [prefix…]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry
from compare import difference, oracle
from tabulon.session import local_session

sf = sys.argv[1]
prefixes = sys.argv[2:]
spark = local_session(8)
spark.sparkContext.setLogLevel("ERROR")
sf_dir = f"/root/testdata/{sf}"
con = oracle(sf_dir)
sqls = entry.oracle_sql()
bad = 0
for name, fn in entry.queries().items():
    if prefixes and not any(name.startswith(p) for p in prefixes):
        continue
    start = time.time()
    try:
        df = fn(spark, sf_dir)
        if name in sqls:
            text = difference(df, con, sqls[name]) or "ok"
        else:
            rows = df.collect()
            text = f"rows-only {len(rows)} {rows[:2]}"[:300]
            if not rows:
                text += " EMPTY"
    except Exception as error:  # noqa: BLE001
        text = f"ERROR {type(error).__name__}: {str(error)[:700]}"
    if text != "ok" and not text.startswith("rows-only"):
        bad += 1
    print(f"{name:36s} {time.time() - start:6.2f}s {text}", flush=True)
print("failing:", bad)
