"""Compare queries with their oracles: python tests/run_oracles.py [sf_dir] [name prefix ...]"""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from corpusmap.session import local_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = local_session("oracles", cpus=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name, run in entry.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            sql = entry.oracle_sql().get(name)
            df = run(spark, sf_dir)
            problems = compare(df, con, sql) if sql else ([] if df.count() else ["no rows"])
        except Exception as error:
            problems = [str(error)[:1500] or traceback.format_exc()[-1500:]]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s{'' if sql else ' (rows only)'}", *problems, flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
