"""Command line for scheduled runs (one run date per invocation, like the
reference's DAG runs).  Submit with ``spark-submit -m calyx ...`` or
``python -m calyx ...``.

  python -m calyx specs     --specs monthly|path.json --ds 2024-01-20 \\
                            --events /data/events.parquet --warehouse /wh [--exports /ex]
  python -m calyx daily     --landing /landing --ds 2024-01-10 --warehouse /wh [--exports /ex]
  python -m calyx new-users --landing /landing --ds 2024-01-10 --warehouse /wh [--exports /ex]
  python -m calyx backfill  --events /data/events.parquet --kind day|week|month \\
                            --start 2024-01-01 --end 2024-02-01 --warehouse /wh
"""

from __future__ import annotations

import argparse
import json
import os
import sys


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="calyx")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("specs", help="run a declared set of aggregates for one run date")
    s.add_argument("--specs", required=True, help="bundled set name, or a JSON file on any storage Spark reads")
    s.add_argument("--events", required=True, help="events Parquet path (attempts source)")
    for name in ("daily", "new-users"):
        j = sub.add_parser(name)
        j.add_argument("--landing", required=True, help="folder of JSON attempt records")
    b = sub.add_parser("backfill", help="A1 for every period of a range in one job")
    b.add_argument("--events", required=True)
    b.add_argument("--kind", choices=("day", "week", "month"), default="day")
    b.add_argument("--start", required=True)
    b.add_argument("--end", required=True)
    for sp in (s, *[sub.choices[n] for n in ("daily", "new-users")]):
        sp.add_argument("--ds", required=True)
        sp.add_argument("--exports")
    for sp in sub.choices.values():
        sp.add_argument("--warehouse", required=True)
    return p


def main(argv=None) -> int:
    args = _parser().parse_args(argv)
    from .session import build_session
    spark = build_session()
    if args.cmd == "specs":
        from .plans import specs as S
        from .sources.tables import attempts_from_events
        specs = S.read_specs(spark, args.specs)
        att = attempts_from_events(spark.read.parquet(args.events))
        res = S.run_aggregates(spark, specs, args.ds, {"attempts": att}, args.warehouse,
                               args.exports, {"attempts": "created_at"})
        out = [{"spec": r.spec.name, "path": r.path, "export": r.exported, "checks": r.checks}
               for r in res]
    elif args.cmd == "daily":
        from .plans.jobs import daily_load
        out = daily_load(spark, args.landing, args.ds, args.warehouse, args.exports)
    elif args.cmd == "new-users":
        from .plans.jobs import weekly_new_users
        out = weekly_new_users(spark, args.landing, args.ds, args.warehouse, args.exports)
    else:
        from .operators.aggregates import backfill_user_type
        from .operators.writes import replace_periods
        from .sources.tables import attempts_from_events
        att = attempts_from_events(spark.read.parquet(args.events))
        df = backfill_user_type(att, args.kind, args.start, args.end)
        path = os.path.join(args.warehouse, f"backfill_{args.kind}")
        replace_periods(spark, df, path, ["period_start"])
        out = {"table": path}
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
