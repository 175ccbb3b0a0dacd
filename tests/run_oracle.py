"""Run queries beside their twins: python -m tests.run_oracle [sf_dir] [name part ...]."""

from __future__ import annotations

import sys
import time
import traceback

import __spark_entry__ as entry
from tests.compare import difference, duck
from tests.session import local_session

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, connection = local_session(), duck(sf_dir)
    oracles, failed = entry.oracle_sql(), []
    for name, run in entry.queries().items():
        if wanted and not any(part in name for part in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = difference(run(spark, sf_dir), connection, oracles[name])
                outcome = "same" if problem is None else f"DIFFERENT {problem}"
            else:
                outcome = f"{run(spark, sf_dir).count()} rows, no twin"
        except Exception as error:
            outcome = f"ERROR {str(error)[:1500]}"
            if wanted:
                traceback.print_exc()
        if outcome.startswith(("DIFF", "ERR")):
            failed.append(name)
        print(f"{name}: {outcome} ({time.time() - start:.1f}s)", flush=True)
    print("failed:", failed)
