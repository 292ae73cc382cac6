"""Check registered queries by hand: python tests/check.py sf0.01 [name ...]"""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskloom.session import local_session  # noqa: E402
from tests.oracle import DATA, connect, difference  # noqa: E402


def main() -> None:
    sf, names = sys.argv[1], sys.argv[2:]
    from __spark_entry__ import oracle_sql, queries

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = queries(), oracle_sql()
    con = connect(sf)
    bad = 0
    for name in names or qs:
        if name.endswith("*"):
            continue
        t, clock = time.time(), []
        try:
            df = qs[name](spark, os.path.join(DATA, sf))
            if name in sqls:
                diff = difference(df, con, sqls[name], clock)
                state = "ok" if diff is None else f"DIFF {diff}"
            else:
                state = f"rows {len(df.collect())} (no SQL)"
        except Exception as e:
            diff = str(e)
            state = "FAIL " + "".join(traceback.format_exception_only(e))[:1500]
            print("".join(traceback.format_tb(e.__traceback__)[-3:]))
        bad += state.startswith(("DIFF", "FAIL"))
        clock.append(time.time())
        print(f"{clock[0] - t:6.2f}s {name}: {state[:1800]}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
