"""Run registered queries against their SQL: ``python tests/run_oracle.py [sf] [name-prefix ...]``."""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tests.oracle import connect, differences, rows_of  # noqa: E402
from tidewright.plans.registry import load_all, runner  # noqa: E402
from tidewright.session import local_session  # noqa: E402


def main() -> int:
    sf, prefixes = sys.argv[1], tuple(sys.argv[2:])
    folder = f"/root/testdata/sf{sf}"
    spark, con, bad = local_session(8), connect(folder), 0
    for name, q in load_all().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = runner(q)(spark, folder)
            if q.sql:
                found = differences(df, q.sql, con)
                note = "" if not found else " ".join(found)[:900]
                n = con.execute(f"select count(*) from ({q.sql}) x").fetchall()[0][0]
                if n == 0:
                    note += " EMPTY"
            else:
                n, found, note = len(rows_of(df.toArrow())), [], "(no sql)"
        except Exception as err:  # noqa: BLE001
            found, n = [str(err)], -1
            note = "ERROR " + str(err)[:700]
            if "-v" in prefixes:
                traceback.print_exc()
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} rows={n} {time.time() - start:.2f}s {note}", flush=True)
    print(f"failed: {bad}")
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
