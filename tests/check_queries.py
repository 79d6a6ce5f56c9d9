"""Compare registered queries with their SQL: check_queries.py <folder> [name part ...]."""

import sys
import time

sys.path.insert(0, __file__.rsplit("/", 2)[0])
sys.path.insert(0, __file__.rsplit("/", 1)[0])

from harness import duck, duck_result, spark_result  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from curata.session import local_session  # noqa: E402


def main(folder: str, parts: list[str]) -> int:
    spark = local_session(8, 8)
    con = duck(folder)
    sql = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        t0 = time.time()
        try:
            names, rows = spark_result(build(spark, folder))
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: {str(e)[:1500]}")
            continue
        took = time.time() - t0
        if name not in sql:
            print(f"rows {name}: {len(rows)} rows {took:.1f}s (no SQL)")
            continue
        try:
            want_names, want = duck_result(con, sql[name])
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"SQL  {name}: {str(e)[:800]}")
            continue
        if names != want_names:
            bad += 1
            print(f"COLS {name}: {names} vs {want_names}")
        elif rows != want:
            bad += 1
            have, need = set(rows), set(want)
            extra = sorted(have - need, key=repr)[:2]
            missing = sorted(need - have, key=repr)[:2]
            print(f"DIFF {name}: {len(rows)} vs {len(want)} rows\n  {names}\n  spark {extra}\n  sql   {missing}")
        else:
            print(f"ok   {name}: {len(rows)} rows {took:.1f}s")
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
