"""Command line check: python tests/run_oracle.py sf0.01 [query ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent.parent))
sys.path.insert(0, str(Path(__file__).parent))

from compare import compare, duck  # noqa: E402

from tests.conftest import session  # noqa: E402

if __name__ == "__main__":
    import __spark_entry__ as entry

    folder = f"/root/testdata/{sys.argv[1]}"
    # names of queries may follow; without them all run
    names = sys.argv[2:]
    spark = session()
    con = duck(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracles:
                problem = compare(df, con, oracles[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        if problem or names:
            print(f"{name} {time.time() - start:.1f}s {'OK' if problem is None else problem}", flush=True)
    print(f"{len(names or queries)} queries, {bad} bad", flush=True)
