"""Compare every registered query with its SQL: ``python tests/check_all.py [sf_dir] [name ...]``."""

import logging
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
from corpusflow.session import local_session  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    logging.disable(logging.CRITICAL)
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    wanted = sys.argv[2:] or list(queries)
    bad = 0
    for name in wanted:
        begin = time.time()
        try:
            df = queries[name](spark, sf_dir)
            problems = compare(df, con, oracles[name]) if name in oracles else [] if df.count() else ["no rows"]
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {time.time() - begin:6.1f}s {name}", *problems, sep="\n       " if problems else " ", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main()))
