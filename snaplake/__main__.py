"""Command line: ``python -m snaplake <command> ...`` (or via spark-submit).

  ingest   --landing DIR --root DIR --periods 2026-01,2026-02 --date 2026-02-20
  build    --root DIR [--targets a,b] [--uf SP] [--full-refresh] [--snapshot as_loaded] [--refresh-months 2026-02]
  run-by   --root DIR [--states AC,AL,...]      batch the active mart by state
  check    --root DIR                            the declared data tests
  vacuum   --root DIR [--keep 2]
  periods  --landing DIR                         months available in landing
"""

from __future__ import annotations

import argparse
import os
import sys


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="snaplake")
    p.add_argument("command", choices=["ingest", "build", "run-by", "check", "vacuum", "periods"])
    p.add_argument("--root")
    p.add_argument("--landing")
    p.add_argument("--periods", default="")
    p.add_argument("--date")
    p.add_argument("--targets", default="")
    p.add_argument("--uf")
    p.add_argument("--states", default="")
    p.add_argument("--keep", type=int, default=2)
    p.add_argument("--full-refresh", action="store_true")
    p.add_argument("--snapshot", default="latest", choices=["as_loaded", "latest"])
    p.add_argument("--refresh-months", default="", help="re-issued months, comma-separated")
    p.add_argument("--master", default=os.environ.get("SNAPLAKE_MASTER"))
    a = p.parse_args(argv)

    from snaplake.plans.runner import Lakehouse
    from snaplake.schemas import STATES
    from snaplake.session import build_session
    from snaplake.sources import landing

    spark = build_session(a.master, shuffle_partitions=None if a.master is None else 8)
    split = (lambda s: [x for x in s.split(",") if x])
    if a.command == "periods":
        for r in landing.periods(spark, a.landing).collect():
            print(r["pasta"])
        return 0
    lh = Lakehouse(spark, a.root, snapshot=a.snapshot, refresh_months=split(a.refresh_months))
    if a.command == "ingest":
        periods = split(a.periods) or [landing.latest_period(spark, a.landing)]
        lh.ingest(a.landing, periods, a.date).show(100, truncate=False)
    elif a.command == "build":
        for row in lh.build(split(a.targets) or None, uf=a.uf, full_refresh=a.full_refresh):
            print(*row)
    elif a.command == "run-by":
        ok, failed = lh.run_by(split(a.states) or STATES)
        print(f"{len(ok)}/{len(ok) + len(failed)} ok")
        for uf, err in failed:
            print("failed", uf, err)
        return 1 if failed else 0
    elif a.command == "check":
        report = lh.check().collect()
        for r in report:
            print(r.status, r.model, r.column_name, r.test_name, r.failures)
        return 1 if any(r.status == "FAIL" for r in report) else 0
    elif a.command == "vacuum":
        for path in lh.vacuum(a.keep):
            print("removed", path)
    return 0


if __name__ == "__main__":
    sys.exit(main())
